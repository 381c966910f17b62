"""Embedding near-dedup: a forest of random-projection trees whose splits overlap; pairs are compared inside leaves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, discard, grouped, materialize, short_batches, table

#: Vectors are linked from this cosine on.
LEAST = 0.95
#: Trees; vectors in a leaf, on average. A node stays whole if comparing within its children would take more than this share
#: of comparing within the node; cuts are tried at these quantiles.
TREES, LEAF, WORTH, CUTS = 6, 400, 0.85, np.linspace(0.1, 0.9, 17)
#: At most so many vectors (chosen by a hash) shape the trees; a node with fewer than LEAST_SAMPLE of them is cut where the
#: whole sample would be, so that trees can be as deep as the number of vectors asks for.
SAMPLE, LEAST_SAMPLE = 20_000, 40
#: A leaf of more vectors is dealt out as pairs of blocks.
BLOCK = 1024


class Forest:
    """Trees of random directions. What lies within half the distance of two linked vectors from a cut goes to both children,
    so a pair is parted only if its shadow on the direction is longer than that distance. A node that no cut divides by this
    rule (a dense group) is a leaf."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int = TREES, least: float = LEAST, seed: int = 19):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.depth = depth
        self.own = min(depth, int(np.log2(max(1, len(sample) / LEAST_SAMPLE))))  # levels whose nodes have cuts of their own
        self.directions = rng.normal(size=(trees, max(depth, 1), dim))
        self.margin = np.sqrt(2 - 2 * least) / 2  # a shadow of length 1 on these directions has a deviation of 1
        # one direction for each level of a tree, a cut of its own for each node
        self.cut = np.zeros((trees, 2**self.own))
        self.whole = np.zeros((trees, 2**self.own), bool)
        self.level = np.zeros((trees, max(depth, 1)))
        for t in range(trees):
            held = {1: np.arange(len(sample))}
            for level in range(depth):
                shadow = sample @ self.directions[t, level]
                self.level[t, level] = self._best(shadow)[0]
                if level >= self.own:
                    continue
                below = {}
                for node, own in held.items():
                    x = shadow[own]
                    self.cut[t, node], work = self._best(x)
                    self.whole[t, node] = work > WORTH
                    if not self.whole[t, node]:
                        below[2 * node] = own[x <= self.cut[t, node] + self.margin]
                        below[2 * node + 1] = own[x >= self.cut[t, node] - self.margin]
                held = below

    def _best(self, shadow: np.ndarray) -> tuple[float, float]:
        """The cut that leaves least to compare, and what it leaves as a share."""
        if not len(shadow):
            return 0.0, 0.0
        shadow = np.sort(shadow)
        cuts = np.quantile(shadow, CUTS)
        left = np.searchsorted(shadow, cuts + self.margin, "right") / len(shadow)
        right = 1 - np.searchsorted(shadow, cuts - self.margin, "left") / len(shadow)
        work = left**2 + right**2
        k = int(np.argmin(work))
        return float(cuts[k]), float(work[k])

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, tree, leaf) of every leaf that each vector falls into; several of one tree where it lies near a cut."""
        rows, trees, leaves = [], [], []
        for t in range(len(self.directions)):
            row, node = np.arange(len(x)), np.ones(len(x), np.int64)
            for level in range(self.depth):
                if level < self.own:
                    stay = self.whole[t, node]
                    rows.append(row[stay])
                    leaves.append(node[stay])
                    row, node = row[~stay], node[~stay]
                shadow = (x @ self.directions[t, level])[row]
                cut = self.cut[t, node] if level < self.own else self.level[t, level]
                left, right = shadow <= cut + self.margin, shadow >= cut - self.margin
                row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
            rows.append(row)
            leaves.append(node)
            trees.append(np.full(sum(map(len, rows)) - sum(map(len, trees)), t))
        return np.concatenate(rows), np.concatenate(trees), np.concatenate(leaves)


def _compare(least: float, kind: str):
    """Links between the vectors of one leaf (i = j), or across two blocks of it; a pair that an earlier leaf (of this
    tree or another) holds too is left to that one."""

    def run(key, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, leaf, i, j = key
        node = np.concatenate([b.column("node").to_numpy() for b in batches])
        first = np.unique(node, return_index=True)[1]
        node = node[first]
        copies = np.concatenate([b.column("copies").to_numpy() for b in batches])[first]
        block = np.concatenate([b.column("block").to_numpy() for b in batches])[first]
        x = _units(np.stack([np.frombuffer(v.as_buffer(), kind) for b in batches for v in b.column("raw")])[first].astype(np.float64))
        earlier = [own for b in batches for own in np.split(b.column("leaves").flatten().to_numpy(), np.cumsum(b.column("leaves").value_lengths().to_numpy())[:-1])]
        earlier = [earlier[k] for k in first]
        m = len(node)
        if m < 2:
            return
        # leaves before this one that two vectors hold, as bits
        code = np.concatenate(earlier).astype(np.int64)
        holder = np.repeat(np.arange(m), [len(own) for own in earlier])
        _, code, held_by = np.unique(code, return_inverse=True, return_counts=True)
        shared = held_by > 1
        place = np.cumsum(shared) - 1
        bits = np.zeros((m, -(-max(1, int(shared.sum())) // 64) * 64), bool)
        bits[holder[shared[code]], place[code[shared[code]]]] = True
        bits = np.packbits(bits, axis=1).view(np.uint64)
        links, root = np.zeros(m), np.arange(m)
        for lo in range(0, m, 512):
            cosine = x[lo : lo + 512] @ x.T
            r, c = np.nonzero(cosine >= least - 1e-9)
            keep = r + lo < c
            if i != j:
                keep &= block[r + lo] != block[c]
            r, c = r[keep], c[keep]
            a, b, near_by = r + lo, c, cosine[r, c]
            fresh = np.ones(len(a), bool)
            for k in np.flatnonzero(near_by < least + 1e-9).tolist():
                fresh[k] = np.einsum("i,i", x[a[k]], x[b[k]]) >= least
            for k in range(0, len(a), 100_000):
                fresh[k : k + 100_000] &= ~(bits[a[k : k + 100_000]] & bits[b[k : k + 100_000]]).any(axis=1)
            a, b = a[fresh], b[fresh]
            links += np.bincount(a, copies[b], m) + np.bincount(b, copies[a], m)
            while True:
                apart = root[a] != root[b]
                a, b = a[apart], b[apart]
                if not len(a):
                    break
                low = root.copy()
                np.minimum.at(low, root[a], root[b])
                np.minimum.at(low, root[b], root[a])
                while (low[low] != low).any():
                    low = low[low]
                root = low[root]
        if not links.any():
            return
        linked = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[root[linked]]), pa.array(links[linked].astype(np.int64))], names=["node", "root", "links"])

    return run


def near(vectors: DataFrame, least: float = LEAST, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding).

    Equal vectors are one node, so a vector that a third of all rows share costs no more than others. Null and empty
    vectors, zero ones and ones with a null or non-finite component link with nothing. Vectors of different lengths don't
    link; each length is compared in a pass of its own. Every node is indexed in every tree; a pair is found if one leaf
    of one tree holds both, and linked if its cosine in double precision is `least` or more. A row with a null vec_id
    takes part and has its own null as component unless links reach an id. Repeated rows count as vectors of their own.
    Vectors at exactly `least` link; an empty table gives an empty one; other columns are not read.
    """
    spark = vectors.sparkSession
    short_batches(spark)
    # single precision travels as such: half the bytes, and the same doubles when a task reads them
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    sound = F.coalesce(F.size("v") > 0, F.lit(False)) & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists("v", lambda c: c != 0)
    rows = vectors.withColumn("v", F.when(sound, F.transform("v", lambda c: c + F.lit(0.0))))
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sizes = sorted(r.d for r in rows.where("v is not null").groupBy(F.size("v").alias("d")).agg(F.count("*")).collect())
    out = alone
    for dim in sizes:
        out = out.unionByName(_near(rows.where(F.size("v") == dim), dim, kind, least, trees, leaf))
    return out


def _near(rows: DataFrame, dim: int, kind: str, least: float, trees: int, leaf: int) -> DataFrame:
    """near() for sound vectors of one length."""
    spark = rows.sparkSession
    keyed = rows.withColumn("digest", F.struct(F.xxhash64(F.lit(1), "v").alias("x"), F.xxhash64(F.lit(2), "v").alias("y")))
    nodes = keyed.groupBy("digest").agg(F.first("v").alias("v"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()))
    n = nodes.count()
    share = min(1.0, SAMPLE / n)
    sample = _units(np.array([r.v for r in nodes.where(F.pmod(F.xxhash64("digest"), F.lit(1_000_000)) < share * 1_000_000).select("v").collect()]).reshape(-1, dim))
    depth = int(np.ceil(np.log2(max(1, n / leaf)))) if len(sample) else 0
    forest = spark.sparkContext.broadcast(Forest(sample, depth, trees, least))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            x = _units(raw)
            row, tree, node = forest.value.leaves(x)
            code = (tree << 48) + node
            order = np.argsort(row, kind="stable")
            ends = np.searchsorted(row[order], np.arange(len(x) + 1))
            leaves = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(code[order]))
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("copies"), pa.array([u.tobytes() for u in raw.astype(kind)], pa.binary()), leaves], names=["node", "copies", "raw", "leaves"])

    routed = nodes.select("node", "copies", "v").mapInArrow(route, "node long, copies long, raw binary, leaves array<long>")
    placed = materialize(routed)
    held = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1")
    each = placed.select("*", F.explode("leaves").alias("leaf")).join(held, "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    each = each.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    each = each.select(F.shiftright("leaf", 48).alias("tree"), "leaf", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "copies", "block", "raw", F.filter("leaves", lambda x: x < F.col("leaf")).alias("leaves"))
    found = materialize(grouped(each, ["tree", "leaf", "i", "j"], _compare(least, kind), "node long, root long, links long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classed = materialize(nodes.select("node", "digest", "copies", "low").join(links, "node", "left").join(whole, "node", "left").withColumn("root", F.coalesce("root", "node")))
    for done in (nodes, placed, found):
        discard(done)
    heads = classed.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = classed.join(heads, "root").select("digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = keyed.select("vec_id", "digest").join(classes, "digest")
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _units(x: np.ndarray) -> np.ndarray:
    """Length 1; scaled by the largest component first, so that nothing overflows or vanishes."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 5e-324)
    return np.ascontiguousarray(x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None])


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
