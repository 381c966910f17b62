"""Quality rules: an isolation forest over rule statistics of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import quantiles
from .common import discard, materialize, others, short_batches, table, text_map
from .textvec import NEWLINE, SPACE, Words, buffers, chunks, mix, per_doc, windows

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Documents of poor quality weigh at most so much in the forest, as a share of what the good ones weigh.
CONTAMINATION = 0.03
TREES, SAMPLE, SHRINK = 100, 256, 30
#: Steps that the threshold goes by; different rows in a task that counts leaves (their number sets the number of tasks).
STEPS, IN_TASK = 10_000, 20_000
#: Share of good labelled documents that the threshold may reject.
FALSE_REJECTS = 0.003
#: The columns of features.
_X = [f"x{k}" for k in range(4)]
_X_DDL = ", ".join(f"{c} double" for c in _X)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_LOUD = np.zeros(256, bool)
_LOUD[list(b"!?")] = True


def _tally(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text: the columns of BASE, then upper-case, lower-case and loud characters, and
    words equal to the word before."""
    words = Words(data, offsets, SPACE)
    hashes = words.hashes()
    out = np.zeros((len(offsets) - 1, 9), np.int64)
    out[:, 0] = words.n
    out[:, 1] = per_doc(words.inside & ((data & 0xC0) != 0x80), offsets)
    out[:, 2] = per_doc(_SYMBOL[data], offsets)
    lines = Words(data, offsets, NEWLINE)
    with_word = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    key = mix(lines.hashes() + mix(lines.doc.astype(np.uint64)))[with_word]
    first = np.unique(key, return_index=True)[1]
    out[:, 3] = np.bincount(lines.doc[with_word], minlength=len(out)) - np.bincount(lines.doc[with_word][first], minlength=len(out))
    at, found = windows(words, hashes, 8)
    key = mix(found + mix(words.doc[at].astype(np.uint64)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 9, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + 8, -1)
    out[:, 4] = per_doc(np.cumsum(change)[: len(hashes)] > 0, words.first)
    for k, chars in enumerate((_UPPER, _LOWER, _LOUD)):
        out[:, 5 + k] = per_doc(chars[data], offsets)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1]))
    out[:, 8] = np.bincount(words.doc[again], minlength=len(out))
    return out


def tally(texts: pa.Array) -> np.ndarray:
    data, offsets = buffers(texts)
    if not len(texts):
        return np.zeros((0, 9), np.int64)
    return np.concatenate([_tally(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets)])


def fails(t: np.ndarray) -> np.ndarray:
    """The plain rules: too few words, or too many in repeated windows."""
    return (t[:, 0] < 20) | (100 * t[:, 4] > 30 * t[:, 0])


def features(t: np.ndarray) -> np.ndarray:
    """What rules measure: shares of symbols, capitals, loud marks and stuttered words. SHRINK words without any are added to
    each text, as a share over a few words says little. Length and repeats are left to the plain rules: a letterhead
    above and below a short good text is a repeat too."""
    t = t.astype(np.float64)
    words, cased = t[:, 0] + SHRINK, t[:, 5] + t[:, 6] + 5 * SHRINK
    return np.stack([t[:, 2] / words, t[:, 5] / cased, t[:, 7] / words, t[:, 8] / words], axis=1)


class IsolationForest:
    """Random splits between the least and the largest value of a random feature, over small draws of all rows (SAMPLE rows a tree:
    without them the method fails, as extreme rows hide the others).

    usual: for each feature, the value below which differences don't count. Rows are given with their values raised to it.
    """

    def __init__(self, drawn: list[np.ndarray], usual: np.ndarray, sample: float, seed: int = 7):
        self.usual, self.sample = usual, sample
        self.depth = max(1, int(np.ceil(np.log2(max(2, sample)))))
        size = 2 ** (self.depth + 1) - 1
        self.feature = np.full((len(drawn), size), -1, np.int8)
        self.cut, self.length = np.zeros((len(drawn), size)), np.zeros((len(drawn), size))
        rng = np.random.default_rng(seed)
        for t, x in enumerate(drawn):
            self._grow(t, 0, 0, x, rng)

    @staticmethod
    def _mean_path(n: float) -> float:
        """Mean depth at which one of n rows stands alone."""
        return max(0.0, 2 * (np.log(n - 0.5) + np.euler_gamma) - 2 * (n - 1) / n) if n > 1 else 0.0

    def _grow(self, t: int, node: int, depth: int, x: np.ndarray, rng) -> None:
        wide = np.flatnonzero(x.max(axis=0) > x.min(axis=0)) if len(x) else np.zeros(0, int)
        if depth >= self.depth or not len(wide):
            return
        f = int(rng.choice(wide))
        cut = rng.uniform(x[:, f].min(), x[:, f].max())
        self.feature[t, node], self.cut[t, node] = f, cut
        self._grow(t, 2 * node + 1, depth + 1, x[x[:, f] <= cut], rng)
        self._grow(t, 2 * node + 2, depth + 1, x[x[:, f] > cut], rng)

    def nodes(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """For each tree, the leaf of each row."""
        rows = np.arange(len(x))
        for feature, cut in zip(self.feature, self.cut, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = np.where(f < 0, node, 2 * node + 1 + (x[rows, f] > cut[node]))
            yield node

    def weigh(self, leaves: np.ndarray, weights: tuple[float, float]) -> None:
        """Tree, node, and how many of all rows are in that leaf, of both weights (1 for all together): its path length is its depth
        and what its share of a draw would take to stand alone."""
        for tree, node, *n in leaves:
            self.length[int(tree), int(node)] = int(node + 1).bit_length() - 1 + self._mean_path(self.sample * float(np.dot(n, weights)))

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 for what few splits set apart."""
        found = self.nodes(np.maximum(x, self.usual))
        return 2.0 ** (-sum(length[node] for length, node in zip(self.length, found, strict=True)) / len(self.length) / max(self._mean_path(self.sample), 1e-9))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, good, x0 to x3): a hash of the id and the features of every labelled document that the plain rules pass. An id that is labelled or stands
    several times is one row, with its lowest quality and smallest counts. Texts are counted where they lie, and only counts are joined."""
    chosen = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    tallies = [f"t{k}" for k in range(9)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = tally(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(t[:, k]) for k in range(9))], names=["doc_id", *tallies])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = np.stack([b.column(c).to_numpy() for c in tallies], axis=1) if b.num_rows else np.zeros((0, 9), np.int64)
            passed = ~fails(t)
            x = features(t[passed])
            yield pa.RecordBatch.from_arrays([*(b.column(c).filter(pa.array(passed)) for c in ("key", "good")), *(pa.array(x[:, k]) for k in range(4))], names=["key", "good", *_X])

    counted = rows.mapInArrow(count, "doc_id long, " + ", ".join(f"{t} long" for t in tallies)).groupBy("doc_id").agg(F.min(F.struct(*tallies)).alias("t"))
    return counted.join(chosen, "doc_id").select(F.xxhash64("doc_id").alias("key"), (F.col("quality") == 1).alias("good"), "t.*").mapInArrow(measure, "key long, good boolean, " + _X_DDL)


def _values(b: pa.RecordBatch) -> np.ndarray:
    return np.stack([b.column(c).to_numpy() for c in _X], axis=1)


def grow(each: DataFrame, rows: DataFrame, usual: np.ndarray, weights: tuple[float, float], total: float) -> IsolationForest:
    """The forest. each: every labelled row, of which each tree draws SAMPLE or so by weight and a hash of tree and id. rows: all of
    them (x0 to x3, good, poor: how many there are of each), whose numbers in the leaves give the path lengths. weights: of a good
    and a poor row, total their sum. What comes to the driver goes with the size of the forest, not with the rows."""
    seeds = mix(np.arange(1, TREES + 1, dtype=np.uint64))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chance = SAMPLE / total * np.where(b.column("good").to_numpy(zero_copy_only=False), *weights)
            key = b.column("key").to_numpy().view(np.uint64)
            tree, row = np.nonzero((mix(key[None, :] ^ seeds[:, None]) >> np.uint64(11)) / 2.0**53 < chance[None, :])
            x = np.maximum(_values(b), usual)[row]
            yield pa.RecordBatch.from_arrays([pa.array(tree), *(pa.array(x[:, k]) for k in range(len(_X)))], names=["tree", *_X])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, *forest.feature.shape), np.int64)
        for b in batches:
            of = [b.column(c).to_numpy() for c in ("good", "poor")]
            for t, node in enumerate(forest.nodes(_values(b))):
                for k, counts in zip(n, of, strict=True):
                    np.add.at(k[t], node, counts)
        tree, node = np.nonzero(n.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(node), *(pa.array(k[tree, node]) for k in n)], names=["tree", "node", "good", "poor"])

    got = each.mapInArrow(draw, "tree long, " + _X_DDL).toPandas().to_numpy(np.float64)
    got = got[np.lexsort(got.T[::-1])]
    forest = IsolationForest([got[got[:, 0] == t, 1:] for t in range(TREES)], usual, min(SAMPLE, total))
    counts = rows.mapInArrow(leaves, "tree long, node long, good long, poor long").groupBy("tree", "node").agg(F.sum("good"), F.sum("poor"))
    forest.weigh(counts.toPandas().to_numpy(np.float64), (weights[0] / total, weights[1] / total))
    return forest


def fit(docs: DataFrame, labels: DataFrame) -> tuple[IsolationForest | None, float]:
    """The forest and the score above which a document goes, from all labelled documents that the plain rules pass.

    Poor ones weigh CONTAMINATION of the good ones at most, so that they are rare and early to be set apart. The threshold is
    the one (of STEPS) with the most poor documents above it, less good ones, with at most FALSE_REJECTS of the good ones
    above; it lies midway between the scores beside it. Without labelled rows of both kinds nothing is rejected.
    """
    each = materialize(labelled(docs, labels))
    n = {r.good: r.n for r in each.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        discard(each)
        return None, np.inf
    values = each.where("good").select(F.posexplode(F.array(*_X)).alias("k", "x"))
    # the value that at most FALSE_REJECTS of the good ones exceed: none of few
    last = max(1, n[True] - 1)
    found = {r.k: r.q[0] for r in quantiles(values, ["k"], "x", [min(1.0, np.ceil((1 - FALSE_REJECTS) * last) / last)]).collect()}
    usual = np.array([found[k] for k in range(len(_X))])
    raised = [F.greatest(c, F.lit(float(u))).alias(c) for c, u in zip(_X, usual, strict=True)]
    # rows without anything unusual are one
    rows = materialize(each.select("good", *raised).groupBy(*_X).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("poor")))
    some = rows.coalesce(1 + rows.count() // IN_TASK)
    weight = min(1.0, CONTAMINATION * n[True] / n[False])
    forest = grow(each, some, usual, (1.0, weight), n[True] + weight * n[False])
    discard(each)
    edges = np.arange(STEPS + 1) / STEPS

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.searchsorted(edges, forest.score(_values(b)), side="left")  # the first edge that is no smaller
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), b.column("good"), b.column("poor")], names=["step", "good", "poor"])

    got = some.mapInArrow(steps, "step long, good long, poor long").groupBy("step").agg(F.sum("good").alias("good"), F.sum("poor").alias("poor")).toPandas().sort_values("step")
    discard(rows)
    cuts = got["step"].to_numpy()
    above_good, above_poor = (1 - np.cumsum(got[c].to_numpy()) / got[c].sum() for c in ("good", "poor"))
    fits = np.flatnonzero(above_good <= FALSE_REJECTS)
    best = fits[np.argmax((above_poor - above_good)[fits])]
    return forest, float(edges[(cuts[best] + cuts[best + 1] - 1) // 2]) if best + 1 < len(cuts) else np.inf


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with the columns of BASE, base_failed, anomaly (the forest's score) and kept.

    Null and empty texts have no words and fail; a long text is counted whole. Extra columns stay as they are; ones with the
    names made here are replaced. Repeated rows and ids are judged row by row; of an id with several texts the one with the
    smallest counts trains. An empty table gives an empty table, and without labels nothing but the rules rejects.
    """
    short_batches(docs.sparkSession)
    forest, limit = fit(docs, labels)

    def work(texts: pa.Array) -> list[pa.Array]:
        t = tally(texts)
        failed = fails(t)
        score = forest.score(features(t)) if forest is not None and len(t) else np.zeros(len(t))
        return [*(pa.array(t[:, k]) for k in range(5)), pa.array(failed), pa.array(score), pa.array(~failed & (score <= limit))]

    return text_map(docs, f"{', '.join(f'{c} long' for c in BASE)}, base_failed boolean, anomaly double, kept boolean", lambda: work)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, table(spark, sf_dir, "labels")).drop("text")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stage: documents that fail a rule or look anomalous go, null and empty texts among them. Repeated rows and ties are
    judged alike; an empty table stays empty; all columns stay as they are."""
    whole = docs.select(F.struct(*others(docs, [])).alias("_doc"), "doc_id", "text")
    return judge(whole, table(spark, sf_dir, "labels")).where("kept").select("_doc.*")
