"""A Merkle manifest of a dataset: a tree of SHA-256 digests for each group, one above the groups, and a proof for each row.

A row's place among its group's ids is found by rank queries on bitmaps, so rows are never sorted; slot arrays keyed by
place then reduce ten levels of a tree at once. All of it is columns and SQL functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, others, table

#: Ids in a bitmap; bytes between two entries of its popcount directory; nodes in a slot array (a power of two, and its power).
BITS, STEP, WIDE, LEVELS = 32_768, 64, 1024, 10
#: The columns of a leaf, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(*values: Column) -> Column:
    """H of the values laid end to end: `-` for null, else the UTF-8 byte count, `:`, the value as text."""
    text = [v.cast("string") for v in values]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    up = lambda acc, p: digest(F.when(p["left"], p["hash"]).otherwise(""), acc, F.coalesce(F.when(~p["left"], p["hash"]), F.lit("")))
    return F.aggregate(proof, leaf, up)


def _below(column: str, *by: str, order: str) -> Column:
    """Sum of `column` over the rows before this one."""
    return F.coalesce(F.sum(column).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _directory(ids: DataFrame) -> DataFrame:
    """ids (tree, high, low) as one bitmap for each tree and block of BITS ids: bits, its popcount directory, n, distinct, base
    (rows of the tree in earlier blocks) and total (rows of the tree).

    Bitmaps are built in the tasks, merged by block and travel compressed. Blocks are counted along three digits of 16 bits (17
    the first), so no window holds more than 131,073 rows, however ids are spread.
    """
    blocks = ids.groupBy("tree", "high").agg(F.count("*").alias("n"), F.bitmap_construct_agg("low").alias("bits"))
    blocks = materialize(blocks.withColumns({"distinct": F.bitmap_count("bits"), "g1": F.shiftright("high", 16), "g2": F.shiftright("high", 32)}))
    first = blocks.groupBy("tree", "g2", "g1").agg(F.sum("n").alias("m"))
    second = first.groupBy("tree", "g2").agg(F.sum("m").alias("k"))
    upper = second.select("tree", "g2", _below("k", "tree", order="g2").alias("b2")).join(second.groupBy("tree").agg(F.sum("k").alias("total")), "tree")
    middle = first.select("tree", "g2", "g1", _below("m", "tree", "g2", order="g1").alias("b1")).join(upper, ["tree", "g2"])
    lower = blocks.withColumn("b0", _below("n", "tree", "g1", order="high")).join(middle.drop("g2"), ["tree", "g1"])
    steps = F.transform(F.sequence(F.lit(0), F.lit(BITS // 8 // STEP - 1)), lambda i: F.bitmap_count(F.substring(F.col("bits"), F.lit(1), i * STEP)))
    return materialize(lower.select("tree", "high", "bits", steps.alias("steps"), "n", "distinct", (F.col("b0") + F.col("b1") + F.col("b2")).alias("base"), "total"))


def _rank() -> Column:
    """Ids of the block below `low`: the directory's entry, whole bytes after it, and bits of the last byte."""
    byte, step = F.shiftright("low", 3), F.shiftright("low", 3) / STEP
    entry = F.floor(step).cast("int")
    whole = F.bitmap_count(F.substring(F.col("bits"), entry * STEP + 1, byte - entry * STEP))
    last = F.conv(F.hex(F.substring(F.col("bits"), byte + 1, F.lit(1))), 16, 10).cast("int")
    return F.get("steps", entry) + whole + F.bit_count(last.bitwiseAND(F.pow(F.lit(2), F.col("low") % 8).cast("int") - 1))


def _indexed(rows: DataFrame) -> DataFrame:
    """rows (tree, high, low, hash, ...) with index, the place in the tree (by id, nulls first, then by hash), and total."""
    directory = _directory(rows.select("tree", "high", "low"))
    repeats = not directory.where("n > distinct").isEmpty()
    rows = materialize(rows) if repeats else rows
    joined = rows.join(directory, ["tree", "high"])
    out = joined.where("n = distinct").withColumn("index", F.col("base") + _rank()).select(*rows.columns, "index", "total")
    if repeats:  # blocks in which an id stands more than once: rows are counted by id, and numbered inside their own id
        again = rows.join(directory.where("n > distinct").select("tree", "high", "base", "total"), ["tree", "high"])
        counts = again.groupBy("tree", "high", "low").agg(F.count("*").alias("c"))
        before = counts.select("tree", "high", "low", _below("c", "tree", "high", order="low").alias("b"))
        own = F.row_number().over(Window.partitionBy("tree", "high", "low").orderBy("hash")) - 1
        out = out.unionByName(again.withColumn("o", own).join(before, ["tree", "high", "low"]).withColumn("index", F.col("base") + F.col("b") + F.col("o")).select(*rows.columns, "index", "total"))
    return out


def _height(n: Column) -> Column:
    """Levels above n nodes."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _levels(slots: Column, total: Column) -> Column:
    """The nodes of a slot array, level by level: as many levels as the tree has, LEVELS at most."""
    pair = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / 2).cast("int")), lambda i: digest(F.get(x, 2 * i), F.coalesce(F.get(x, 2 * i + 1), F.lit(""))))
    steps = F.slice(F.array(*map(F.lit, range(LEVELS))), F.lit(1), F.least(F.lit(LEVELS), _height(total)))
    return F.aggregate(steps, F.array(F.transform(slots, lambda s: s["hash"])), lambda done, _: F.concat(done, F.array(pair(F.element_at(done, -1)))))


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of every round, and each tree's root. nodes: tree, index, total, hash, body."""
    rounds = []
    while True:
        slot = F.struct((F.col("index") % WIDE).cast("int").alias("slot"), "hash", "body")
        keyed = nodes.groupBy("tree", F.floor(F.col("index") / WIDE).alias("chunk"), "total").agg(F.collect_list(slot).alias("slots"))
        keyed = keyed.withColumn("slots", F.array_sort("slots", lambda a, b: a["slot"] - b["slot"]))
        keyed = materialize(keyed.withColumn("node", F.get(F.element_at(_levels(F.col("slots"), F.col("total")), -1), F.lit(0))))
        rounds.append(keyed)
        if (keyed.agg(F.max("total")).first()[0] or 0) <= WIDE:
            break
        nodes = keyed.where(F.col("total") > WIDE).select("tree", F.col("chunk").alias("index"), F.ceil(F.col("total") / WIDE).alias("total"), F.col("node").alias("hash"), F.lit(None).cast("int").alias("body"))
    roots = [keyed.where(F.col("total") <= WIDE).select("tree", F.col("node").alias("root")) for keyed in rounds]
    return rounds, reduce(DataFrame.unionByName, roots)


def _paths(levels: Column) -> Column:
    """The slots of an array with what stands beside them at each of its levels; the last level is the array's own node."""

    def path(s: Column) -> Column:
        place = lambda j: F.floor(s["slot"] / F.pow(F.lit(2), j)).cast("int")
        beside = lambda j: F.struct((place(j) % 2 == 1).alias("left"), F.get(F.get(levels, j), place(j).bitwiseXOR(F.lit(1))).alias("hash"))
        return F.slice(F.transform(F.sequence(F.lit(0), F.size(levels) - 1), beside), F.lit(1), F.size(levels) - 1)

    return F.transform("slots", lambda s: F.struct(s["slot"].alias("slot"), s["hash"].alias("hash"), s["body"].alias("body"), path(s).alias("path")))


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Every node of the first round with its proof: the other node of its pair at each level (null where it has none), and
    whether that stands on the left. above: tree, proof (from the tree's root up), seal (columns that all nodes of a tree get)."""
    up = None
    for keyed in reversed(rounds):
        ends = keyed.where(F.col("total") <= WIDE).select("tree", "chunk").join(above, "tree")
        up = ends if up is None else ends.unionByName(up)

        # levels are bound once for all slots of an array
        paths = F.flatten(F.transform(F.array(_levels(F.col("slots"), F.col("total"))), _paths))
        here = keyed.select("tree", "chunk", F.explode(paths).alias("s")).join(up, ["tree", "chunk"])
        up = here.select("tree", (F.col("chunk") * WIDE + F.col("s.slot")).alias("chunk"), F.concat("s.path", "proof").alias("proof"), "seal", F.col("s.hash").alias("_hash"), F.col("s.body").alias("_body"))
        leaves, up = up, up.drop("_hash", "_body")
    return leaves.select("tree", F.col("_hash").alias("hash"), F.col("_body").alias("body"), "proof", "seal")


def manifest(docs: DataFrame) -> DataFrame:
    """Each row of docs (without text) with leaf, subroot (its lang's root), root, and proof: from the leaf to the root, the
    digest that is hashed together with the node (null where the node stands alone) and whether it comes first.

    Rows of a lang ascend by doc_id, nulls first; rows with one doc_id ascend by leaf, so repeated rows are leaves of their own,
    in a fixed order. A null lang is a group, before all others. A long text is hashed whole. An empty table has no root and
    gives no rows. Columns named like the new ones are replaced; all others stay.
    """
    made = ["leaf", "subroot", "root", "proof"]
    kept = [c for c in docs.select(*others(docs, [*made, "text"])).columns]
    body = F.struct(*(F.col(f"`{c}`") for c in kept), F.lit(0).alias("_"))
    tree = F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0"))  # null before all, then bytewise
    far = -(1 << 49)  # nulls are a block of their own, below all blocks of ids
    rows = docs.select(tree.alias("tree"), F.coalesce(F.shiftright(F.col("doc_id").cast("long"), 15), F.lit(far)).alias("high"), F.coalesce(F.pmod(F.col("doc_id").cast("long"), F.lit(BITS)), F.lit(0)).alias("low"), leaf_of(*(F.col(c) for c in FIELDS)).alias("hash"), body.alias("body"))
    nodes = _indexed(rows).select("tree", "index", "total", "hash", "body")
    trees, roots = _climb(nodes)
    roots = materialize(roots)
    # places of the subroots: inside runs of a common beginning, and then over those, of which there are 65,793 at most
    start = roots.select("tree", "root", F.substring(F.encode("tree", "utf-8"), 1, 3).alias("start"))
    offsets = start.groupBy("start").agg(F.count("*").alias("m"))
    offsets = offsets.select("start", _below("m", order="start").alias("b"), F.sum("m").over(Window.partitionBy()).alias("total"))
    placed = start.withColumn("r", F.row_number().over(Window.partitionBy("start").orderBy("tree")) - 1).join(offsets, "start")
    top = placed.select(F.lit("").alias("tree"), (F.col("b") + F.col("r")).alias("index"), "total", F.col("root").alias("hash"), F.struct("tree", F.col("root").alias("subroot")).alias("body"))
    rounds, root = _climb(top)
    none = F.array().cast("array<struct<left:boolean,hash:string>>")
    above = _descend(rounds, root.select("tree", none.alias("proof"), F.struct(F.col("root")).alias("seal")))
    above = above.select("body.tree", "proof", F.struct("body.subroot", "seal.root").alias("seal"))
    out = _descend(trees, above)
    return out.select(*(F.col("body").getField(c).alias(c) for c in kept), F.col("hash").alias("leaf"), "seal.subroot", "seal.root", "proof")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with proofs hashed, and every leaf (tampered where 7 divides crc32 of its id) folded
    along its proof and held against the root."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_of(*(more if c == "n_chars" else F.col(c) for c in FIELDS)))
    made = manifest(docs.select(*FIELDS, tampered.alias("tampered")))
    hashed = digest(F.array_join(F.transform("proof", lambda p: p["hash"]), ""))
    out = made.select("doc_id", "leaf", "subroot", "root", hashed.alias("proof_sha256"), fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR))::VARCHAR || ':' || CAST({value} AS VARCHAR), '-')"


_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda d, k: xor(d >> 1, CASE WHEN d & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295::BIGINT)"

OP12_SQL = f"""WITH RECURSIVE l AS (SELECT doc_id, lang, sha256({" || ".join(_field(c) for c in FIELDS)}) AS leaf,
    CASE WHEN {_CRC} % 7 = 0 THEN sha256({" || ".join(_field("(n_chars::HUGEINT + 1)" if c == "n_chars" else c) for c in FIELDS)}) END AS tampered FROM documents),
  b AS (SELECT *, row_number() OVER () AS id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM l),
  t AS (SELECT g, 0 AS lvl, i, leaf AS h, n FROM b UNION ALL SELECT g, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY g, lvl, i // 2, n),
  s AS (SELECT g, h AS subroot FROM t WHERE n = 1),
  u AS (SELECT 0 AS lvl, g AS i, subroot AS h, (SELECT count(*) FROM s) AS n FROM s UNION ALL SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, i // 2, n),
  height AS (SELECT g, max(lvl) AS top FROM t GROUP BY g),
  a AS (SELECT g, lvl, i, h FROM t WHERE n > 1 UNION ALL SELECT e.g, e.top + u.lvl, u.i, u.h FROM u, height e WHERE u.n > 1),
  j AS (SELECT g, top, unnest(range(top + (SELECT max(lvl) FROM u))) AS j FROM height),
  w AS (SELECT b.id, j.j, b.g, CASE WHEN j.j < j.top THEN b.i >> j.j ELSE b.g >> (j.j - j.top) END AS pos FROM b JOIN j USING (g)),
  p AS (SELECT w.id, string_agg(a.h, '' ORDER BY w.j) AS hashes, list(CASE WHEN a.h IS NULL THEN 'N' WHEN a.i < w.pos THEN 'L' || a.h ELSE 'R' || a.h END ORDER BY w.j) AS path
    FROM w LEFT JOIN a ON a.g = w.g AND a.lvl = w.j AND a.i = xor(w.pos, 1) GROUP BY w.id),
  f AS (SELECT b.*, s.subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(coalesce(p.hashes, '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(p.path, [])), lambda c, x: CASE x[1] WHEN 'L' THEN sha256(x[2:] || c) WHEN 'R' THEN sha256(c || x[2:]) ELSE sha256(c) END) AS folded_root
    FROM b JOIN s USING (g) LEFT JOIN p ON p.id = b.id)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f"""
