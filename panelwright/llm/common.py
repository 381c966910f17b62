"""What the operators share: tables, the shared folder, and links to components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch. Texts can be long, so batches are short.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes in an Arrow batch.
BATCH_BYTES = 8 << 20


def short_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python worker: few rows and few bytes in each Arrow batch.

    Spark reads these settings when a plan runs, which is after an operator has returned it, so they stay; what the
    session has set lower stays as it is.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).removesuffix("b").removesuffix("B")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. One is made only in local mode (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, *partition_by: str, compression: str = "zstd") -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors, and runs the work once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    writer = df.write.option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    hadoop_path(spark, path, lambda fs, p: fs.deleteOnExit(p))
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str, do):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return do(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p)


def discard(df: DataFrame) -> None:
    """Delete a table that materialize() wrote."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/table-" in path:
            hadoop_path(df.sparkSession, path, lambda fs, p: fs.delete(p, True))


def held_out(doc_id: str, parts: int, part: int):
    """crc32(doc_id as text) mod parts = part; a null doc_id is in no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


#: A node is a hub if it has more than this share of all links: so there are few hubs (twice as many as one over this, at most).
HUB_SHARE = 1e-4


def _with_least(links: DataFrame, n: int, own: bool) -> DataFrame:
    """links (a, b) with m, the least b of each a (and a itself, if own). A hub's rows don't meet in one task: its m is
    broadcast, and only the links of other nodes are joined on the node."""
    stats = links.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", (F.least("a", "m") if own else F.col("m")).alias("m"), "n")
    hub = F.col("n") > n * HUB_SHARE
    marked = links.join(F.broadcast(stats.where(hub).select("a", F.col("m").alias("_m"))), "a", "left")
    rest = marked.where("_m is null").join(stats.where(~hub).select("a", "m"), "a").select("a", "b", "m")
    return marked.where("_m is not null").select("a", "b", F.col("_m").alias("m")).unionByName(rest)


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Smallest node that each node reaches over undirected links.

    edges: a, b of one orderable type, any order, repeats allowed. Returns (node, root) for every node with a link to
    another one. Each round sends every node's smallest neighbour to its larger neighbours and to itself (the
    large-star and small-star contraction), so a chain of n links takes about log2(n) rounds and a hub's links move
    to its smallest member instead of being joined with each other. Every round is written to the shared folder.
    """
    plain = "snappy"  # small tables in many rounds: native buffers of stronger compression would add up in executors
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), compression=plain)
    n = now.count()
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, 2 * n, True).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        step = materialize(large.where("a <> b").distinct(), compression=plain)
        small = _with_least(step, n, False).select(F.explode(F.when(F.col("b") == F.col("m"), F.array(F.struct("a", F.col("m").alias("b")))).otherwise(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))).alias("e")).select("e.a", "e.b")
        after = materialize(small.where("a <> b").distinct(), compression=plain)
        was, n = n, after.count()
        same = was == n and now.exceptAll(after).isEmpty()
        discard(step)
        discard(now)
        now = after
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    # a star: every node links to its root alone
    members = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())


def grouped(df: DataFrame, keys: list[str], run, schema: str) -> DataFrame:
    """Like groupBy(keys).applyInArrow(run), but many small groups pass through one worker call.

    run(key values, list of record batches of one group) yields record batches. Keys are whole numbers without nulls.
    Rows are dealt out by the keys and sorted by them, and one group at a time is in memory.
    """
    import numpy as np
    import pyarrow as pa

    def stream(batches):
        now, held = None, []
        for b in batches:
            k = np.stack([b.column(c).to_numpy() for c in keys], axis=1) if b.num_rows else np.zeros((0, len(keys)), np.int64)
            cut = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(k)]
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                if i == j:
                    continue
                key = tuple(k[i].tolist())
                if key != now and held:
                    yield from run(now, held)
                    held = []
                now = key
                held.append(b.slice(i, j - i))
        if held:
            yield from run(now, held)

    def gather(batches):
        rows, kind = [], None
        for out in stream(batches):
            rows.append(out)
            kind = out.schema
            if sum(x.num_rows for x in rows) > 20_000:
                yield from pa.Table.from_batches(rows, kind).combine_chunks().to_batches()
                rows = []
        if rows:
            yield from pa.Table.from_batches(rows, kind).combine_chunks().to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(gather, schema)


def others(docs: DataFrame, made: list[str]) -> list:
    """The columns of docs whose names the operator doesn't make itself (names differ by more than case)."""
    taken = {c.lower() for c in made}
    return [docs[f"`{c}`"] for c in docs.columns if c.lower() not in taken]


def text_map(docs: DataFrame, made: str, start, drop: tuple[str, ...] = ()) -> DataFrame:
    """docs with the columns of the schema string `made`, worked out from whole texts (null: empty) in Arrow batches.

    start() runs once a task and returns a function from a binary array of texts to the new columns as arrays. All other
    columns travel in one struct, so none of their names can clash; columns named like new ones are replaced, and those in `drop` go.
    """
    import pyarrow as pa
    from pyspark.sql.types import StructField, StructType

    short_batches(docs.sparkSession)
    new = StructType.fromDDL(made)
    names = new.names
    source = docs.select(F.struct(*others(docs, [*names, *drop]), F.lit(0).alias("_")).alias("doc"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def run(batches):
        work = start()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc"), *work(b.column("text"))], names=["doc", *names])

    kept = StructField("doc", source.schema["doc"].dataType)
    out = source.mapInArrow(run, StructType([kept, *new.fields]))
    return out.select(*(F.col("doc").getField(f.name).alias(f.name) for f in kept.dataType.fields[:-1]), *names)
