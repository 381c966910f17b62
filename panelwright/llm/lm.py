"""LM scoring: class-based bigrams. Exchange clustering deals frequent words to classes; a text's probability is the
product of class transitions and of words within their classes.

Words are known by a 64-bit hash of their bytes. Counts cover all training documents. The HOT most frequent words go to
every executor (a bounded table), and the exchange deals every one of them to a class: the CLUSTERED most frequent ones
one at a time, then all of them in rounds that are Spark jobs. Counts of all other words, which share one class, come by
a join, so nothing that grows with the corpus is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import discard, held_out, materialize, others, short_batches, table
from .textvec import LOWER, SPACE, Words, buffers, chunks, per_doc

#: Words in the table that all executors hold, which the exchange clusters; those that begin it, one at a time, and sweeps
#: over them; classes; rounds over all.
HOT, CLUSTERED, SWEEPS, CLASSES, ROUNDS = 131_072, 1024, 6, 48, 2
#: Added to each count of a class transition; tokens in a row of the encoded texts.
ALPHA, RUN = 0.5, 1 << 18
#: The hash that stands for the end of a text.
END = np.uint64(0x5EED0E4D0F7E87E5)
_END = int(END.view(np.int64))
#: Tokens that a counting task gathers before it sums them up.
GATHER = 2_000_000


def _token_hashes(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Runs of whole texts: hashes of their words with END after each text, the text of each token, the first text."""
    data, offsets = buffers(texts)
    data = LOWER[data]
    for a, b in chunks(offsets):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACE)
        out = np.full(len(words.doc) + b - a, END, np.uint64)
        doc = np.empty(len(out), np.int64)
        at = np.arange(len(words.doc)) + words.doc
        out[at], doc[at] = words.hashes(), words.doc
        doc[words.first[1:] + np.arange(b - a)] = np.arange(b - a)
        yield out, doc, a


def _counts(train: DataFrame) -> DataFrame:
    """(hash, n) of every token of the training texts; each task sums what it has seen before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["hash", "n"])

        for b in batches:
            held += [h for h, _, _ in _token_hashes(b.column("text"))]
            if sum(map(len, held)) > GATHER:
                yield flush()
        if held:
            yield flush()

    return train.select("text").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent words, `most` at most: a histogram over count ranges gives the cut."""
    words = counts.where(F.col("hash") != _END)
    band = F.floor(F.log2("n") * 64)
    seen, cut = 0, None
    for b, n in sorted(words.groupBy(band.alias("b")).agg(F.count("*").alias("n")).collect(), reverse=True):
        if seen + n > most:
            break
        seen, cut = seen + n, b
    if cut is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = words.where(band >= cut).orderBy(F.desc("n"), "hash").toArrow()
    return got["hash"].to_numpy().view(np.uint64), got["n"].to_numpy()


class _Ids:
    """Token hash to unit: the rank of a frequent word, then one unit for END and one for all other words."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.sorted, self.rank = hashes[order], order
        self.counts = counts
        self.end, self.rare = len(hashes), len(hashes) + 1

    def look_up(self, h: np.ndarray) -> np.ndarray:
        unit = np.full(len(h), self.rare)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
            same = self.sorted[at] == h
            unit[same] = self.rank[at[same]]
        unit[h == END] = self.end
        return unit


def _encoded(train: DataFrame, ids) -> DataFrame:
    """The training texts as rows of unsigned 32-bit units: the unit before, then up to RUN units of whole texts in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, _, _ in _token_hashes(b.column("text")):
                unit = np.concatenate([[ids.value.end], ids.value.look_up(h)]).astype("<u4")
                yield pa.RecordBatch.from_arrays([pa.array([unit[i : i + RUN + 1].tobytes() for i in range(0, len(h), RUN)], pa.binary())], names=["units"])

    return train.select("text").mapInArrow(run, "units binary")


def _sums(encoded: DataFrame, cells: int, count) -> DataFrame:
    """(cell, n): count(total, units) adds a row's units to a task's array of `cells` numbers; what isn't zero is summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int32)
        for b in batches:
            for units in b.column("units"):
                count(total, np.frombuffer(units.as_buffer(), "<u4").astype(np.int64))
        seen = np.flatnonzero(total)
        for i in range(0, len(seen), 500_000):
            part = seen[i : i + 500_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["cell", "n"])

    return encoded.mapInArrow(run, "cell int, n int").groupBy("cell").agg(F.sum("n").alias("n"))


def _table(sums: DataFrame, size: int) -> np.ndarray:
    """Sums as a square table on the driver; for tables whose size is bounded."""
    got = sums.toArrow()
    out = np.zeros(size * size, np.int64)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(size, size)


def _top_pairs(encoded: DataFrame, words: int, end: int) -> np.ndarray:
    """How often the most frequent `words`, END and the rest follow each other."""
    size = words + 2

    def count(total: np.ndarray, units: np.ndarray) -> None:
        of = np.where(units < words, units, np.where(units == end, words, words + 1))
        np.add.at(total, of[:-1] * size + of[1:], 1)

    return _table(_sums(encoded, size * size, count), size)


def _class_pairs(encoded: DataFrame, of, classes: int) -> np.ndarray:
    def count(total: np.ndarray, units: np.ndarray) -> None:
        c = of.value[units]
        np.add.at(total, c[:-1] * classes + c[1:], 1)

    return _table(_sums(encoded, classes * classes, count), classes)


def _exchange_all(encoded: DataFrame, of: np.ndarray, pairs: np.ndarray, words: int) -> np.ndarray:
    """One round of the exchange over all frequent words, as a Spark job: each word's neighbours are counted by class, and
    each word moves to the class under which those counts are likeliest. Counts and classes of the round before stay
    fixed meanwhile; a word's own counts are taken out of its class first."""
    spark = encoded.sparkSession
    k = len(pairs)
    shared, fixed = spark.sparkContext.broadcast(of), spark.sparkContext.broadcast(pairs.astype(np.float64))

    def count(total: np.ndarray, units: np.ndarray) -> None:
        c = shared.value[units]
        before, after = units[:-1], units[1:]
        use = before < words
        np.add.at(total, before[use] * 2 * k + c[1:][use], 1)
        use = after < words
        np.add.at(total, after[use] * 2 * k + k + c[:-1][use], 1)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = fixed.value
        log = lambda n, total: np.log(n + ALPHA) - np.log(total + ALPHA * k)
        sides = [(table, table.sum(axis=1)), (table.T, table.sum(axis=0))]
        likely = np.concatenate([log(t, total[:, None]) for t, total in sides], axis=1)[: k - 2].T
        for b in batches:
            word = b.column("word").to_numpy()
            size = b.column("slots").value_lengths().to_numpy()
            own = np.zeros((len(word), 2 * k))
            own[np.repeat(np.arange(len(word)), size), b.column("slots").flatten().to_numpy()] = b.column("ns").flatten().to_numpy()
            gain = own @ likely
            at = shared.value[word]
            stays = np.zeros(len(word))
            for (t, total), n in zip(sides, (own[:, :k], own[:, k:]), strict=True):
                stays += (n * log(np.maximum(t[at] - n, 0), (total[at] - n.sum(axis=1))[:, None])).sum(axis=1)
            put = np.flatnonzero(at < k - 2)
            gain[put, at[put]] = stays[put]
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(gain.argmax(axis=1).astype(np.int32))], names=["word", "class"])

    sums = _sums(encoded, words * 2 * k, count).select(F.expr(f"cell div {2 * k}").cast("int").alias("word"), (F.col("cell") % (2 * k)).alias("slot"), "n")
    vectors = sums.groupBy("word").agg(F.collect_list("slot").alias("slots"), F.collect_list("n").alias("ns"))  # 2 k numbers at most
    got = vectors.mapInArrow(choose, "word int, class int").toArrow()
    new = of.copy()
    new[got["word"].to_numpy()] = got["class"].to_numpy()
    return new


def exchange(pairs: np.ndarray, words: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """A class for each unit: the first `words` move, one at a time, to the class that raises the likelihood of the
    class bigrams most, until a sweep moves none; every further unit keeps a class of its own."""
    n = len(pairs)
    classes = min(classes, max(words, 1))
    of = np.concatenate([np.arange(words) % classes, classes + np.arange(n - words)])
    k = classes + n - words

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    table = np.zeros((k, k))
    np.add.at(table, (of[:, None], of[None, :]), pairs)
    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            right = np.bincount(of, pairs[w], k)
            left = np.bincount(of, pairs[:, w], k)
            own, old = pairs[w, w], of[w]
            right[old] -= own
            left[old] -= own
            table[old] -= right
            table[:, old] -= left
            table[old, old] -= own
            rows, cols = table[:classes], table[:, :classes].T
            gain = (f(rows + right) - f(rows)).sum(axis=1) + (f(cols + left) - f(cols)).sum(axis=1)
            c = np.arange(classes)
            d = table[c, c]
            gain += f(d + right[c] + left[c] + own) - f(d + right[c]) - f(d + left[c]) + f(d)
            out, into = table[:classes].sum(axis=1), table[:, :classes].sum(axis=0)
            gain -= f(out + right.sum() + left[c] + own) - f(out) + f(into + left.sum() + right[c] + own) - f(into)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table[new] += right
            table[:, new] += left
            table[new, new] += own
            of[w] = new
            moved += new != old
        if not moved:
            break
    return of


@dataclass
class Model:
    """What scoring needs: the frequent words (ids), the class of every unit (of), and log10 probabilities: step between
    classes, within a class and plain by unit, and the totals by which words that aren't frequent are scored."""

    ids: _Ids
    of: np.ndarray
    step: np.ndarray
    within: np.ndarray
    plain: np.ndarray
    end_known: bool
    tokens: int
    base_total: float
    rare_total: float


def fit(train: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the training texts (binary, no nulls), and their words' counts (hash, n)."""
    spark = train.sparkSession
    counts = materialize(_counts(train))
    tokens, distinct, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("hash") == _END, F.col("n"))), F.lit(0))).first()
    ids = _Ids(*_frequent(counts, HOT))
    encoded = materialize(_encoded(train, spark.sparkContext.broadcast(ids)))
    hot, top = len(ids.counts), min(CLUSTERED, len(ids.counts))
    classes = min(CLASSES, max(top, 1))
    of = np.full(hot + 2, classes + 1)
    of[hot] = classes
    of[:top] = exchange(_top_pairs(encoded, top, hot), top, classes)[:top]
    for _ in range(ROUNDS if hot else 0):
        pairs = _class_pairs(encoded, spark.sparkContext.broadcast(of), classes + 2)
        of = _exchange_all(encoded, of, pairs, hot)
    k = classes + 2
    pairs = _class_pairs(encoded, spark.sparkContext.broadcast(of), k)
    discard(encoded)
    step = np.log10((pairs + ALPHA) / (pairs.sum(axis=1, keepdims=True) + ALPHA * k))
    n = np.concatenate([ids.counts, [ends, 0]])
    size = np.bincount(of, n, k)
    size[k - 1] += tokens - n.sum()
    kinds = np.bincount(of[:-1], minlength=k)
    kinds[k - 1] += max(0, distinct - hot - (ends > 0))
    per_class = size + kinds + 1
    base_total = float(tokens + distinct + 1)
    plain, within = np.log10((n + 1) / base_total), np.log10((n + 1) / per_class[of])
    plain[-1] = within[-1] = 0.0  # words that aren't frequent get theirs by a join
    return Model(ids, of, step, within, plain, ends > 0, tokens, base_total, float(per_class[k - 1])), counts


def score(docs: DataFrame, train: DataFrame) -> DataFrame:
    """docs (doc_id, text, held_out, ...) with n_tokens, n_known, train_tokens, base_score, score and perplexity.

    score is the log10 probability of the text: over its tokens (words, then one end), log10 of the class transition
    (ALPHA added to each count) times the word within its class (one added to each count, and one unseen word). Texts
    that are null count as empty: one token, the end. With no training text all counts are zero. Rows are scored one by
    one, repeated ids too; other columns of any type stay, ones named like the new ones are replaced. A long text is scored
    whole, in batches of one text if need be; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    short_batches(spark)
    text = F.coalesce("text", F.lit("")).cast("binary")
    model, counts = fit(train.select(text.alias("text")))
    shared = spark.sparkContext.broadcast(model)
    made = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    kept = others(docs, ["text", *made])
    source = docs.select(F.struct(*kept, F.lit(0).alias("_")).alias("doc"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    schema = StructType.fromDDL("row long, hash long, times long")
    schema = StructType([*schema.fields, StructField("doc", source.schema["doc"].dataType), *StructType.fromDDL("n_tokens long, n_known long, base double, score double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            row = b.column("row").to_numpy()
            sums = np.zeros((4, b.num_rows))
            hashes, docs_of, times = [], [], []
            for h, doc, a in _token_hashes(b.column("text")):
                unit = m.ids.look_up(h)
                c = m.of[unit]
                border = np.searchsorted(doc, np.arange(doc[-1] + 2))
                part = sums[:, a : a + len(border) - 1]
                known = (unit < m.ids.end) | ((unit == m.ids.end) & m.end_known)
                part[0] = np.diff(border)
                part[1] = per_doc(known, border)
                for k, x in ((2, m.plain[unit]), (3, m.step[np.concatenate([[m.of[m.ids.end]], c[:-1]]), c] + m.within[unit])):
                    part[k] = np.add.reduceat(x, border[:-1])
                cold = np.flatnonzero(unit == m.ids.rare)
                order = cold[np.lexsort((h[cold], doc[cold]))]
                new = np.ones(len(order), bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                begin = np.flatnonzero(new)
                hashes.append(h[order[begin]])
                docs_of.append(row[a + doc[order[begin]]])
                times.append(np.diff(np.append(begin, len(order))))
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("row"), pa.array(np.zeros(n, np.int64)), b.column("doc"), *(pa.array(sums[k].astype(np.int64)) for k in (0, 1)), *(pa.array(sums[k]) for k in (2, 3))], names=names)
            h, of_row, often = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, docs_of, times))
            for i in range(0, len(h), 50_000):
                part = slice(i, i + 50_000)
                size = len(h[part])
                yield pa.RecordBatch.from_arrays([pa.array(of_row[part]), pa.array(h[part].view(np.int64)), pa.array(often[part]), pa.nulls(size, b.column("doc").type), *(pa.nulls(size, pa.int64()) for _ in range(2)), *(pa.nulls(size, pa.float64()) for _ in range(2))], names=names)

    names = ["row", "hash", "times", "doc", "n_tokens", "n_known", "base", "score"]
    parts = source.mapInArrow(run, schema)
    # rows of documents (times = 0) carry their own number as hash; they pass the join without a partner
    joined = parts.join(counts.select("hash", "n").withColumn("cold", F.lit(True)), (parts["hash"] == counts["hash"]) & (parts["times"] > 0), "left").select("row", "doc", "n_tokens", "times", F.coalesce("n", F.lit(0)).alias("n"), "n_known", "base", "score")
    cold = F.col("times") > 0
    summed = joined.groupBy("row").agg(
        F.any_value(F.when(~cold, F.col("doc")), True).alias("doc"),  # one row for each document, so any type will do
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.when(cold, F.when(F.col("n") > 0, F.col("times")).otherwise(0)).otherwise(F.col("n_known"))).alias("n_known"),
        F.sum(F.when(cold, F.col("times") * F.log10((F.col("n") + 1) / F.lit(model.base_total))).otherwise(F.col("base"))).alias("base_score"),
        F.sum(F.when(cold, F.col("times") * F.log10((F.col("n") + 1) / F.lit(model.rare_total))).otherwise(F.col("score"))).alias("score"),
    )
    return summed.select(*(F.col("doc").getField(f.name).alias(f.name) for f in source.schema["doc"].dataType.fields[:-1]), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 7, 2).alias("held_out"))
    return score(docs, docs.where("not held_out"))
