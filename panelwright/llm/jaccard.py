"""N-gram Jaccard join: MinHash bands find candidates, pairs are verified on their full sets of word n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import components, discard, grouped, materialize, short_batches, table
from .textvec import SPACE, Words, buffers, chunks, mix, windows

#: Words in an n-gram; the least similarity, as a fraction.
SIZE, LEAST = 5, (4, 5)
#: Of pairs at the least similarity, the share that the bands may miss; minima in a band.
MISS, ROWS = 1e-5, 6
#: Texts and n-grams (32 MB of them) that are compared in one task, or as two such blocks; texts of one bucket whose minima are.
#: Larger components and buckets are dealt out as pairs of blocks. A longer text is a block of its own.
BLOCK, GRAMS = 256, 4_000_000
#: From so many screened pairs of one bucket on, two blocks are compared whole.
DENSE = 16
#: Tasks that a large bucket's first text is sent to.
SALTS = 16
#: Columns of the incidence matrix that are in memory at once.
COLUMNS = 8192


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that find a pair of this similarity with a probability of 1 - miss."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


def equal_minima(total: int, similarity: float, miss: float = MISS / 100) -> int:
    """Of so many minima, how many two texts of this similarity share at least, but for a chance of `miss`."""
    chance, k = 0.0, -1
    while True:
        more = chance + math.comb(total, k + 1) * similarity ** (k + 1) * (1 - similarity) ** (total - k - 1)
        if more > miss:
            return k + 1
        chance, k = more, k + 1


def shingles(texts: pa.Array, size: int = SIZE) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Runs of whole texts: hash and text of every n-gram (repeats stay), number of texts, the first text.

    A text of fewer words than `size`, but one at least, has one n-gram: all its words.
    """
    data, offsets = buffers(texts)
    for a, b in chunks(offsets):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACE)
        hashes = words.hashes()
        at, found = windows(words, hashes, size)
        short = np.flatnonzero((words.n > 0) & (words.n < size))
        extra = np.array([mix(np.array([_fold(hashes[words.first[d] : words.first[d + 1]])], np.uint64))[0] for d in short], np.uint64)
        doc = np.concatenate([words.doc[at], short])
        order = np.argsort(doc, kind="stable")
        yield np.concatenate([found, extra])[order], doc[order], b - a, a


def _fold(hashes: np.ndarray) -> int:
    out = len(hashes)
    for h in hashes.tolist():
        out = (out * 0x100000001B3 + h) & 0xFFFFFFFFFFFFFFFF
    return out


def _parameters(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(97)
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def signatures(docs: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """(doc_id, digest, bands, minima, n_grams): one 64-bit number for each band, null for texts without a word; a byte of each
    minimum; how many n-grams the text has."""
    mul, add = _parameters(rows * bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[int] | None] = []
            minima: list[bytes] = []
            sizes: list[int] = []
            for h, doc, n, _ in shingles(b.column("text"), size):
                border = np.searchsorted(doc, np.arange(n + 1))
                sizes += np.diff(border).tolist()
                low = np.full((n, rows * bands), np.iinfo(np.uint64).max, np.uint64)
                for d in np.flatnonzero(np.diff(border)):
                    own = h[border[d] : border[d + 1]]
                    for i in range(0, len(own), 512):
                        x = own[None, i : i + 512] * mul[:, None] + add[:, None]
                        low[d] = np.minimum(low[d], x.min(axis=1))
                band = np.zeros((n, bands), np.uint64)
                for r in range(rows):
                    band = band * np.uint64(0x100000001B3) + (low[:, r::rows] >> np.uint64(16))
                band = mix(band + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                empty = np.diff(border) == 0
                out += [None if e else x for e, x in zip(empty.tolist(), band, strict=True)]
                minima += map(bytes, (low >> np.uint64(16)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("digest"), pa.array(out, pa.list_(pa.int64())), pa.array(minima, pa.binary()), pa.array(sizes, pa.int64())], names=["doc_id", "digest", "bands", "minima", "n_grams"])

    return docs.select("doc_id", "digest", "text").mapInArrow(run, "doc_id long, digest binary, bands array<long>, minima binary, n_grams long")


def _screen(least: int):
    """Of the texts of one bucket, those that share `least` minima with another: the text and the smallest that such
    pairs reach. No pair of the similarity asked for is lost, but for the chance that `least` stands for."""

    def run(key, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = np.concatenate([b.column("node").to_numpy() for b in batches])
        minima = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for b in batches for x in b.column("minima")])
        node, first = np.unique(node, return_index=True)
        root = _least_reached(np.stack([(minima[k] == minima[first]).sum(axis=1) >= least for k in first]))
        moved = np.flatnonzero(root != np.arange(len(node)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], names=["a", "b"])

    return run


def _least_reached(link: np.ndarray) -> np.ndarray:
    """The smallest row that each row of a square table of links reaches."""
    root = np.arange(len(link))
    while True:
        low = np.minimum(root, np.where(link, root[None, :], len(link)).min(axis=1))
        low = np.minimum(low, low[low])
        if (low == root).all():
            return root
        root = low


def _like_first(least: int):
    """Rows of (band, node, low, minima, first): first becomes whether node and the bucket's first text share `least` minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, first = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("minima", "first"))
            near = (own == first).sum(axis=1) >= least if b.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("band", "node", "low", "minima")), pa.array(near)], names=["band", "node", "low", "minima", "near"])

    return run


def _between(link: np.ndarray, node: np.ndarray, block: np.ndarray, dense: int) -> Iterator[pa.RecordBatch]:
    """Screened pairs of one bucket, or part of one, by the blocks (i, j) of their texts: the pairs (a, b), or a row with a = -1
    where `dense` or more lie between two blocks."""
    a, b = np.nonzero(np.triu(link, 1))
    if not len(a):
        return
    ends = np.stack([np.minimum(block[a], block[b]), np.maximum(block[a], block[b])], axis=1)
    pairs, at, times = np.unique(ends, axis=0, return_inverse=True, return_counts=True)
    at = at.reshape(-1)
    few, many = np.flatnonzero(times[at] < dense), np.flatnonzero(times >= dense)
    rows = np.concatenate([np.column_stack([ends[few], np.minimum(node[a[few]], node[b[few]]), np.maximum(node[a[few]], node[b[few]])]), np.column_stack([pairs[many], np.full((len(many), 2), -1)])])
    yield pa.RecordBatch.from_arrays([pa.array(rows[:, c]) for c in range(4)], names=["i", "j", "a", "b"])


def _held(batches: list[pa.RecordBatch], *columns: str) -> tuple[np.ndarray, ...]:
    """Different nodes, their minima, and further columns of each."""
    node, first = np.unique(np.concatenate([b.column("node").to_numpy() for b in batches]), return_index=True)
    minima = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for b in batches for x in b.column("minima")])
    return node, minima[first], *(np.concatenate([b.column(c).to_numpy() for b in batches])[first] for c in columns)


def _pairs(least: int):
    """Screened pairs of the texts of one bucket that lie in large components."""
    dense = DENSE

    def run(key, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, minima, block = _held(batches, "block")
        yield from _between(np.stack([(minima[k] == minima).sum(axis=1) >= least for k in range(len(node))]), node, block, dense)

    return run


def _across(batches: list[pa.RecordBatch], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, links between the strangers (side 0) and all rows, and the place of each row's node."""
    raw = np.concatenate([b.column("node").to_numpy() for b in batches])
    side = np.concatenate([b.column("side").to_numpy() for b in batches])
    node, minima = _held(batches)
    at = np.searchsorted(node, raw)
    stranger = np.zeros(len(node), bool)
    stranger[at[side == 0]] = True
    link = np.zeros((len(node), len(node)), bool)
    for k in np.flatnonzero(stranger):
        link[k] = (minima[k] == minima).sum(axis=1) >= least
    return node, link | link.T, at


def _screen_across(least: int):
    """Like _screen, between the rows of a block of strangers (side 0) and those of a block of the bucket (side 1)."""

    def run(key, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, link, _ = _across(batches, least)
        root = _least_reached(link)
        moved = np.flatnonzero(root != np.arange(len(node)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], names=["a", "b"])

    return run


def _pairs_across(least: int):
    """Like _pairs, between the rows of a block of strangers and those of a block of the bucket."""
    dense = DENSE

    def run(key, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, link, _ = _across(batches, least)
        _, _, block = _held(batches, "block")
        yield from _between(link, node, block, dense)

    return run


def _strangers(marked: DataFrame, *more: str) -> DataFrame:
    """The texts of large buckets that are unlike their bucket's first one, beside all texts of the bucket, as pairs of blocks
    (band, i, j): side 0 and side 1."""
    parts = marked.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.ceil(F.count_if(~F.col("near")) / BLOCK).alias("strange"))
    dealt = marked.join(parts.where("strange > 0"), "band")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    first = dealt.where(~F.col("near")).select("band", F.pmod(F.xxhash64("node", F.lit(2)), "strange").alias("i"), F.explode(upto("blocks")).alias("j"), F.lit(0).alias("side"), "node", "minima", *more)
    second = dealt.select("band", F.explode(upto("strange")).alias("i"), F.pmod(F.xxhash64("node", F.lit(3)), "blocks").alias("j"), F.lit(1).alias("side"), "node", "minima", *more)
    return first.unionByName(second)


def _mark(held: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Texts of the buckets of more than BLOCK texts, and whether they share `least` minima with the bucket's first text. Such
    ones hang together through it. The first text is sent to SALTS tasks, so no bucket's texts need meet in one."""
    minima = texts.select("node", "minima")
    salted = held.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    firsts = held.select("low").distinct().join(minima.withColumnRenamed("node", "low"), "low").select("low", F.col("minima").alias("first"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = salted.join(firsts, ["low", "salt"]).join(minima, "node")
    return materialize(rows.select("band", "node", "low", "minima", "first").mapInArrow(_like_first(least), "band long, node long, low long, minima binary, near boolean"))


def _buckets(texts: DataFrame) -> DataFrame:
    """Texts by bucket (band, node), with the bucket's smallest text and its number of texts. Buckets with the same texts count
    once."""
    band = texts.select("node", F.explode("bands").alias("band"))
    buckets = band.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.shiftright(F.xxhash64(F.lit(1), "node"), 20)).alias("y"))
    buckets = buckets.where("low < high").groupBy("low", "n", "x", "y").agg(F.min("band").alias("band"))
    return materialize(band.join(buckets.select("band", "low", "n"), "band"))


def _links(held: DataFrame, marked: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Links (a, b) along which all screened pairs hang together. A bucket of near copies costs one comparison a text."""
    small = held.where(F.col("n") <= BLOCK).join(texts.select("node", "minima"), "node").select("band", "node", "minima")
    near = grouped(small, ["band"], _screen(least), "a long, b long")
    across = grouped(_strangers(marked), ["band", "i", "j"], _screen_across(least), "a long, b long")
    return marked.where(F.col("near") & (F.col("node") != F.col("low"))).select(F.col("node").alias("a"), F.col("low").alias("b")).unionByName(across).unionByName(near)


def _in_blocks(candidates: DataFrame, held: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, block, large): a component of BLOCK texts and GRAMS n-grams at most is one block. The texts of a larger one lie by
    the smallest text that one of their buckets holds, so near copies are together and a chain's texts near each other."""
    sized = candidates.join(texts.select("node", "n_grams"), "node")
    sizes = sized.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_grams").alias("g"))
    large = (F.col("n") > BLOCK) | (F.col("g") > GRAMS)
    members = sized.join(sizes.select("root", large.alias("large")), "root")
    near = held.groupBy("node").agg(F.min("low").alias("key"))
    spread = members.where("large").join(near, "node")
    parts = spread.groupBy("root", "key").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_grams") / GRAMS)).alias("parts"))
    spread = spread.join(parts, ["root", "key"]).select("node", F.xxhash64("root", "key", F.pmod(F.xxhash64("node"), "parts")).alias("block"), F.lit(True).alias("large"))
    return members.where("NOT large").select("node", F.xxhash64("root").alias("block"), F.lit(False).alias("large")).unionByName(spread)


def _screened(held: DataFrame, marked: DataFrame, blocks: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """What has to be verified in large components: blocks (i, j) to compare whole (a = -1), and pairs (a, b) of texts."""
    large = blocks.where("large").select("node", "block")
    small = held.where(F.col("n") <= BLOCK).join(large, "node").join(texts.select("node", "minima"), "node").select("band", "node", "block", "minima")
    pairs = grouped(small, ["band"], _pairs(least), "i long, j long, a long, b long")
    rows = marked.join(large, "node")
    across = grouped(_strangers(rows, "block"), ["band", "i", "j"], _pairs_across(least), "i long, j long, a long, b long")
    # texts that are like the first one of a large bucket are likely like each other: all pairs of their blocks
    alike = rows.where("near").select("band", "block").distinct()
    each = alike.select("band", F.col("block").alias("i")).join(alike.select("band", F.col("block").alias("j")), "band").where("i <= j").select("i", "j", F.lit(-1).cast("long").alias("a"), F.lit(-1).cast("long").alias("b"))
    return materialize(pairs.unionByName(across).unionByName(each).distinct())


def _verify(least: tuple[int, int]):
    """Counts links of one group, in which i = j means all pairs of a block and i < j pairs across two blocks."""

    def run(key, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = key
        node = np.concatenate([b.column("node").to_numpy() for b in batches])
        copies = np.concatenate([b.column("copies").to_numpy() for b in batches])
        block = np.concatenate([b.column("block").to_numpy() for b in batches])
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for b in batches for x in b.column("grams")]
        node, first = np.unique(node, return_index=True)  # a row that stands twice in the input comes twice
        copies, block, sets = copies[first], block[first], [sets[k] for k in first]
        m = len(node)
        if m < 2:
            return
        sizes = np.array([len(s) for s in sets])
        grams, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(m), sizes)
        shared = times > 1  # others are in one set only
        number = np.cumsum(shared) - 1
        use = shared[column]
        row, column = row[use], number[column[use]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((m, m), np.float32)
        for c in range(0, int(shared.sum()), COLUMNS):
            a, b = np.searchsorted(column, [c, c + COLUMNS])
            part = np.zeros((m, min(COLUMNS, int(shared.sum()) - c)), np.float32)
            part[row[a:b], column[a:b] - c] = 1
            both += part @ part.T
        both = both.astype(np.int64)
        link = both * (least[0] + least[1]) >= least[0] * (sizes[:, None] + sizes[None, :])
        np.fill_diagonal(link, False)
        if i != j:
            link &= block[:, None] != block[None, :]
        linked = np.flatnonzero(link.any(axis=1))
        if not len(linked):
            return
        root = _least_reached(link)
        yield pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[root[linked]]), pa.array((link @ copies)[linked])], names=["node", "root", "links"])

    return run


def _verify_pairs(least: tuple[int, int]):
    """Links of single pairs (a, b, their copies and n-grams), told from both ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, b, ca, cb, x, y in zip(*(batch.column(c) for c in ("a", "b", "copies_a", "copies_b", "grams_a", "grams_b")), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both * (least[0] + least[1]) >= least[0] * (len(x) + len(y)):
                    a, b = a.as_py(), b.as_py()
                    rows += [(a, min(a, b), cb.as_py()), (b, min(a, b), ca.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["node", "root", "links"])

    return run


def join(docs: DataFrame, size: int = SIZE, least: tuple[int, int] = LEAST, miss: float = MISS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Links of all documents whose sets of word n-grams have a Jaccard similarity of `least` (a fraction) or more.

    Returns (classes, members). members: doc_id, digest (of the text) for each row of docs. classes: one row for each
    different text with a word: digest, first_id (smallest doc_id of the text), copies, class_id (smallest doc_id that
    links reach, itself included), class_digest (the text that stands for the class) and n_links (documents linked to
    each of these, copies included).

    Words are split at ASCII white space. Copies are one node, so a text that a third of all rows share costs no more
    than any other. Candidates are texts that share a band and, by their minima, may be similar enough; candidates that
    hang together form a component. A component of at most BLOCK texts and GRAMS n-grams is verified whole on the full sets. In a
    larger one only screened pairs are: two blocks with many of them are compared whole in one task, and other pairs one by
    one, so a group of near copies goes in blocks and a long chain costs in proportion to its length. Null, empty and
    wordless texts link with nothing, not even with each other. A long text is compared whole; an empty table gives empty
    tables; columns beside doc_id and text are not read. Rows with a null doc_id take part; a class of such rows
    alone has a null id.
    """
    spark = docs.sparkSession
    short_batches(spark)
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", F.unhex(F.md5(text.cast("binary"))).alias("digest"), text.cast("binary").alias("text"))
    bands = bands_for(least[0] / least[1], rows, miss)
    signed = signatures(docs, size, rows, bands)
    texts = signed.groupBy("digest").agg(F.first("bands").alias("bands"), F.first("minima").alias("minima"), F.first("n_grams").alias("n_grams"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    texts = materialize(texts.where("bands is not null").withColumn("node", F.monotonically_increasing_id()))
    screen = equal_minima(bands * rows, least[0] / least[1])
    held = _buckets(texts)
    marked = _mark(held.where(F.col("n") > BLOCK), texts, screen)
    candidates = components(_links(held, marked, texts, screen))
    blocks = materialize(_in_blocks(candidates, held, texts))
    wanted = blocks.join(texts.select("node", "digest", F.col("first_id").alias("id"), "copies"), "node")
    rows_of = docs.join(wanted, (docs["digest"] == wanted["digest"]) & docs["doc_id"].eqNullSafe(wanted["id"])).select("text", "node", "copies", "block", "large")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h, doc, n, _ in shingles(b.column("text"), size):
                border = np.searchsorted(doc, np.arange(n + 1))
                out += [np.unique(h[border[d] : border[d + 1]]).tobytes() for d in range(n)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("node", "copies", "block", "large")), pa.array(out, pa.binary())], names=["node", "copies", "block", "large", "grams"])

    # texts are brought to their candidates once; what follows reads the candidates' n-grams alone
    sets = materialize(rows_of.mapInArrow(grams, "node long, copies long, block long, large boolean, grams binary"))
    columns, pairs = ["node", "copies", "block", "grams"], None
    whole = sets.where("NOT large").select(F.col("block").alias("i"), F.col("block").alias("j"), *columns)
    if not blocks.where("large").isEmpty():
        spread = sets.where("large").select(*columns)
        screened = _screened(held, marked, blocks, texts, screen)
        dense = screened.where("a < 0").select("i", "j").distinct()
        ends = dense.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
        whole = whole.unionByName(spread.join(ends, "block").select("i", "j", *columns))
        single = screened.where("a >= 0").join(dense, ["i", "j"], "left_anti").select("a", "b").distinct()
        end = lambda c: spread.select(F.col("node").alias(c), F.col("copies").alias(f"copies_{c}"), F.col("grams").alias(f"grams_{c}"))
        pairs = single.join(end("a"), "a").join(end("b"), "b").mapInArrow(_verify_pairs(least), "node long, root long, links long")
    found = grouped(whole, ["i", "j"], _verify(least), "node long, root long, links long")
    found = materialize(found if pairs is None else found.unionByName(pairs))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classed = texts.select("node", "digest", "first_id", "copies").join(reached, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classed = materialize(classed)
    for done in (found, texts, sets):
        discard(done)
    low = F.struct(F.col("first_id").isNull().alias("a"), F.col("first_id").alias("b"), F.col("digest").alias("c"))
    heads = classed.groupBy("root").agg(F.min(low).alias("low")).select("root", F.col("low.b").alias("class_id"), F.col("low.c").alias("class_digest"))
    classes = classed.join(heads, "root").select("digest", "first_id", "copies", "class_id", "class_digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return classes, docs.select("doc_id", "digest")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (smallest doc_id that links reach), n_links (documents linked directly), kept (first of its class)."""
    classes, members = join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = members.join(classes.select("digest", "class_id", "n_links"), "digest", "left")
    alone = F.col("n_links").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.when(alone, F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stage: of each class the document with the smallest id stays, once; wordless documents all stay."""
    classes, _ = join(docs)
    names = docs.columns
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    heads = classes.select("digest", F.col("first_id").alias("_id"), (F.col("digest") == F.col("class_digest")).alias("_head"))
    keyed = docs.withColumn("_digest", digest)
    joined = keyed.join(heads, (F.col("_digest") == heads["digest"]) & keyed["doc_id"].eqNullSafe(heads["_id"]), "left")
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # repeated rows may differ in other columns: the first by these stays
    nth = F.row_number().over(Window.partitionBy("_digest", "doc_id").orderBy(F.to_json(F.struct(*(F.col(f"`{c}`") for c in names if c != "text")))))
    first = joined.where(wordless | F.col("_head")).withColumn("_nth", F.when(wordless, 1).otherwise(nth))
    return first.where("_nth = 1").select(*names)
