"""Sources and sinks: partitioned files, text tables, listings, XML filings, exports."""

from __future__ import annotations

import tempfile
import time
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def workspace(spark: SparkSession) -> str:
    """A new folder that driver and executors share; on a cluster under spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/')}/files-{uuid.uuid4().hex}" if base else tempfile.mkdtemp(prefix="spark-") + "/files"


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def states(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """(path, length, time of the last change) of files, by one listing of each folder."""
    wanted, out = set(paths), []
    for folder in sorted({p.rsplit("/", 1)[0] for p in paths}):
        fs, at = hadoop(spark, folder)
        out += [(path, s.getLen(), s.getModificationTime()) for s in fs.listStatus(at) if (path := s.getPath().toUri().toString()) in wanted or s.getPath().toString() in wanted]
    return tuple(sorted(out)) if len(out) == len(wanted) else (tuple(sorted(wanted)), time.time_ns())


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def read_partitioned(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Hive-partitioned Parquet; columns are united by name, partitions are pruned by filters."""
    reader = spark.read.option("mergeSchema", True)
    return (reader.schema(schema) if schema else reader).parquet(path)


def snake(name: str) -> str:
    import re

    return re.sub(r"[^a-z0-9]+", "_", name.replace("﻿", "").replace("**", "").strip().lower()).strip("_")


def read_text_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """All columns as trimmed text under plain names; headers may run over lines and start with a byte-order mark."""
    df = spark.read.options(header=True, inferSchema=False, multiLine=True, **options).csv(path)
    df = df.toDF(*(snake(c) for c in df.columns))
    return df.select(*(F.nullif(F.trim(c), F.lit("")).alias(c) for c in df.columns))


def read_listing(spark: SparkSession, path: str, required: Sequence[str], dates: Sequence[str], pattern: str = "dd-MMM-yyyy") -> DataFrame:
    """A listing with text dates, "-" for none, and the symbol in the file's name (SYMBOL_listing.csv)."""
    df = read_text_csv(spark, path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"the listing lacks {missing}")
    df = df.withColumns({c: F.nullif(c, F.lit("-")) for c in df.columns})
    return df.withColumns({c: F.to_date(F.try_to_timestamp(F.col(c), F.lit(pattern))) for c in dates} | {"symbol": F.regexp_extract(F.input_file_name(), r"([^/_]+)_[^/]*$", 1)})


def union_dedupe(frames: Sequence[DataFrame], key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows of all frames, the first of each key."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


FACT = "filing_id string, concept string, context_ref string, unit_ref string, decimals string, raw_value string, is_nil boolean, is_numeric boolean, sequence int, error string"


def parse_filings(files: DataFrame) -> DataFrame:
    """Facts of many XML instances (filing_id, content), one row each. A file that can't be parsed becomes one row with
    its error, and the others go on."""

    def facts(filing_id: str, content: str | bytes) -> list[tuple]:
        root = ET.fromstring(content)
        out = []
        for e in root:
            context = e.get("contextRef")
            if context is None:
                continue
            nil = e.get("{http://www.w3.org/2001/XMLSchema-instance}nil") == "true"
            out.append((filing_id, e.tag.rpartition("}")[2], context, e.get("unitRef"), e.get("decimals"), None if nil else e.text, nil, e.get("unitRef") is not None, len(out), None))
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in FACT.split(", ")]
        for f in frames:
            rows = []
            for filing_id, content in zip(f["filing_id"], f["content"]):
                try:
                    rows += facts(filing_id, content)
                except (ET.ParseError, TypeError, ValueError) as e:
                    rows.append((filing_id, *[None] * 8, type(e).__name__))
            yield pd.DataFrame(rows, columns=names)

    return files.select("filing_id", "content").mapInPandas(run, FACT)


def quarantine(parsed: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rows of what failed."""
    return parsed.where(F.col(error).isNull()).drop(error), parsed.where(F.col(error).isNotNull())


def dimension_key(members: Column) -> Column:
    """AxisA=x|AxisB=y of an array of (axis, member) structs, axes in order and without prefixes."""
    local = lambda c: F.element_at(F.split(c, ":"), -1)
    return F.array_join(F.array_sort(F.transform(members, lambda m: F.concat(local(m["axis"]), F.lit("="), local(m["member"])))), "|")


def split_long_text(facts: DataFrame, text: str, concept: str, most: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Facts, and text blocks: by name, or longer than `most`."""
    long = F.coalesce(F.col(concept).endswith("TextBlock") | (F.length(text) > most), F.lit(False))
    return facts.where(~long), facts.where(long)


def filing_summary(facts: DataFrame, filing: str, concept: str, unit: str, numeric: Column, nil: Column) -> DataFrame:
    return facts.groupBy(filing).agg(F.count("*").alias("n_facts"), F.count_if(numeric).alias("n_numeric"), F.count_if(~numeric).alias("n_text"), F.count_if(nil).alias("n_nil"), F.countDistinct(concept).alias("n_concepts"), F.countDistinct(unit).alias("n_units"))


def main_period(contexts: DataFrame, filing: str, start: str, end: str, n_facts: str, context: str) -> DataFrame:
    """The duration with the latest end; ties: most facts, earliest start, smallest id. Its length in months."""
    order = Window.partitionBy(filing).orderBy(F.col(end).desc(), F.col(n_facts).desc(), F.col(start), F.col(context))
    first = contexts.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    return first.withColumn("period_months", F.round((F.datediff(end, start) + 1) / 30.4375).cast("int"))


def replace_keys(spark: SparkSession, path: str, new: DataFrame, key: str, partition: str) -> DataFrame:
    """Write rows of `new` over those of the same keys, wherever these stand; other keys stay, and only partitions that
    held or get one of the keys are written.

    These partitions are staged beside the table first. A run that is lost while they replace the old ones is made good
    by the next call, which finds the whole stage.
    """
    stage = path + "-next"
    _take_over(spark, path, stage, partition)
    remove(spark, stage)
    rows, touched = new, new.select(partition)
    if exists(spark, path):
        old = spark.read.schema(new.schema).parquet(path)
        keys = new.select(key).distinct()
        told = workspace(spark)
        touched.unionByName(old.join(keys, key, "left_semi").select(partition)).distinct().write.parquet(told)  # found once, read twice
        touched = spark.read.schema(touched.schema).parquet(told)
        rows = old.join(touched.distinct(), partition, "left_semi").join(keys, key, "left_anti").select(*new.columns).unionByName(new)
    rows.write.partitionBy(partition).parquet(f"{stage}/rows")
    touched.distinct().write.parquet(f"{stage}/touched")  # written last: with it the stage is whole
    _take_over(spark, path, stage, partition)
    return spark.read.schema(new.schema).parquet(path)


def _take_over(spark: SparkSession, path: str, stage: str, partition: str) -> None:
    """Put a whole stage in the place of the partitions that it touches; those that are empty now go."""
    if not exists(spark, f"{stage}/touched/_SUCCESS"):
        return
    if any(r for r in spark.read.parquet(f"{stage}/touched").limit(1).collect()):
        rows = spark.read.parquet(f"{stage}/rows")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        touched = spark.read.parquet(f"{stage}/touched").select(F.col(partition).cast("string"))
        for r in touched.join(rows.select(F.col(partition).cast("string")), partition, "left_anti").collect():  # names of folders
            remove(spark, f"{path}/{partition}={r[0] if r[0] is not None else '__HIVE_DEFAULT_PARTITION__'}")
    remove(spark, stage)


def intake(files: DataFrame, listing: DataFrame, universe: DataFrame) -> DataFrame:
    """Status of received files (file_name, content, own_isin): duplicate of the same content, unmatched, ambiguous or
    received; the identifier by priority: own, same symbol in the listing, universe."""
    hashed = files.withColumn("sha256", F.sha2("content", 256)).drop("content")
    w = Window.partitionBy("sha256").orderBy("file_name")
    hashed = hashed.withColumn("_first", F.first("file_name").over(w))
    names = listing.groupBy("file_name").agg(F.count("*").alias("_matches"), F.min("symbol").alias("symbol"), F.min("listed_isin").alias("listed_isin"))
    out = hashed.join(names, "file_name", "left").join(universe.select("symbol", F.col("isin").alias("universe_isin")), "symbol", "left")
    status = F.when(F.col("_first") != F.col("file_name"), "duplicate").when(F.col("_matches").isNull(), "unmatched").when(F.col("_matches") > 1, "ambiguous").otherwise("received")
    isin = F.coalesce("own_isin", "listed_isin", "universe_isin")
    source = F.when(F.col("own_isin").isNotNull(), "own").when(F.col("listed_isin").isNotNull(), "listing").when(F.col("universe_isin").isNotNull(), "universe")
    conflict = F.coalesce(F.col("own_isin") != F.col("universe_isin"), F.lit(False))
    return out.select("file_name", "sha256", "symbol", status.alias("status"), isin.alias("isin"), source.alias("isin_source"), conflict.alias("isin_conflict"))


def digests(lines: DataFrame) -> DataFrame:
    """(file_name, sha256) of files that come as lines (file_name, line): of the number of lines and the sums of two 64-bit hashes of
    each, so no task holds a file, and the lines' order doesn't count."""
    sums = (F.sum(F.xxhash64(F.lit(i), "line").cast("decimal(38,0)")) for i in range(2))
    return lines.groupBy("file_name").agg(F.sha2(F.concat_ws("/", F.count("*").cast("string"), *(s.cast("string") for s in sums)), 256).alias("sha256"))


def take_in(spark: SparkSession, manifest: str, received: DataFrame, order: Sequence[str], batch: int | None = None) -> DataFrame:
    """Received files (file_name, content, or sha256 instead) against the manifest of what was taken in before, by the hash of their content:
    taken in before, duplicate (of an earlier one of this batch), or new; nth is a file's place among those of its
    content. What is new becomes the batch's part of the manifest.

    A batch that comes again (after a failure behind this step) is held against the other batches alone and replaces its own
    part, so its files are new again. Without a number a batch is a new one.
    """
    hashed = received if "sha256" in received.columns else received.withColumn("sha256", F.sha2("content", 256)).drop("content")
    hashed = hashed.withColumn("nth", F.row_number().over(Window.partitionBy("sha256").orderBy(*order)))
    schema = "sha256 string, file_name string, batch long"
    known = spark.read.schema(schema).parquet(manifest) if exists(spark, manifest) else spark.createDataFrame([], schema)
    batch = known.agg(F.coalesce(F.max("batch") + 1, F.lit(0))).first()[0] if batch is None else batch
    known = known.where(F.col("batch") != batch)
    hashed = hashed.join(known.select("sha256").distinct().withColumn("_known", F.lit(True)), "sha256", "left")
    status = F.when(F.col("_known"), "taken in before").when(F.col("nth") > 1, "duplicate").otherwise("new")
    path = workspace(spark)
    hashed.withColumn("status", status).drop("_known").write.parquet(path)  # the manifest is read before it grows
    out = spark.read.parquet(path)
    out.where("status = 'new'").select("sha256", "file_name").write.mode("overwrite").parquet(f"{manifest}/batch={batch}")
    return out


def replace_newer(spark: SparkSession, path: str, new: DataFrame, key: str, revision: Sequence[str], partition: str) -> DataFrame:
    """replace_keys() with the latest row of each key, by the revision columns (nulls last), of those that come and the one that
    is there: a late, older revision changes nothing."""
    came, best = workspace(spark), workspace(spark)
    rows = new
    if exists(spark, path):
        new.write.parquet(came)  # read twice below, and files may be costly to parse
        new, old = (spark.read.schema(new.schema).parquet(p) for p in (came, path))
        rows = new.unionByName(old.join(new.select(key).distinct(), key, "left_semi").select(*new.columns))
    order = Window.partitionBy(key).orderBy(*(F.col(c).desc_nulls_last() for c in revision))
    rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(*new.columns).write.parquet(best)  # read before the table changes
    out = replace_keys(spark, path, spark.read.schema(new.schema).parquet(best), key, partition)
    for folder in (came, best):
        remove(spark, folder)
    return out


def star_export(spark: SparkSession, path: str, tables: Mapping[str, DataFrame], facts: str, period: str, periods: DataFrame) -> None:
    """Each table in a folder of its own; the facts only for periods that have data, in order inside each file."""
    for name, df in tables.items():
        if name == facts:
            df = df.join(periods.select(period), period, "left_semi").select(*df.columns).sortWithinPartitions(*df.columns[:2])
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def filing_status(listing: DataFrame, received: DataFrame, key: Sequence[str], available: Column) -> DataFrame:
    got = received.select(*key).distinct().withColumn("_got", F.lit(True))
    return listing.join(got, list(key), "left").withColumn("status", F.when(F.col("_got"), "received").when(available, "missing").otherwise("listed_unavailable")).drop("_got")


def versions(headers: DataFrame, href: str, on_disk: DataFrame, pattern: str) -> DataFrame:
    """Versions named in schema references and versions at hand; both sides stay."""
    used = headers.withColumn("version", F.nullif(F.regexp_extract(href, pattern, 1), F.lit(""))).where("version is not null").groupBy("version").agg(F.count("*").alias("n_used"))
    return used.join(on_disk.select("version").distinct().withColumn("on_disk", F.lit(True)), "version", "full_outer").select("version", F.coalesce("n_used", F.lit(0)).alias("n_used"), F.coalesce("on_disk", F.lit(False)).alias("on_disk"))


def tree_leaves(spark: SparkSession, edges: DataFrame, root: str, most_levels: int = 1000) -> DataFrame:
    """All descendants of a heading that have no children of their own, with their depth. edges: parent, child.

    One join a level, each written to the shared folder, so neither rows nor levels are bounded by a recursion's limits;
    a tree of more than most_levels levels (a circle) is an error.
    """
    edges = edges.select("parent", "child")
    level = edges.where(F.col("parent") == root).select(F.col("child").alias("node"), F.lit(1).alias("depth"))
    base, out = workspace(spark), None
    for depth in range(1, most_levels + 1):
        level.write.parquet(f"{base}/{depth}")
        level = spark.read.schema("node string, depth int").parquet(f"{base}/{depth}")
        if level.isEmpty():
            break
        out = level if out is None else out.unionByName(level)
        level = edges.join(level, edges["parent"] == level["node"]).select(F.col("child").alias("node"), (F.col("depth") + 1).alias("depth"))
    else:
        raise ValueError(f"more than {most_levels} levels below {root}")
    return (out if out is not None else level).join(edges.select(F.col("parent").alias("node")), "node", "left_anti")


def tree_rows(spark: SparkSession, edges: DataFrame, heading: str, reportable: DataFrame, excluded: str | None = None, most_levels: int = 1000) -> DataFrame:
    """What can be reported under a heading: indicator (a child of the heading), indicator_seq, concept (the indicator or one of
    its descendants) and position (its place under the indicator). edges: parent, child, ord; reportable: node.

    Places follow the tree from top to bottom: a node's key is the path of (ord, name) that leads to it, so a whole level is
    made by one join, and the order comes from the keys alone. A child of several parents stands once under each indicator, at
    its first place. Names that match `excluded` are left out (as indicators with all that is below them), and so are
    indicators without anything to report. A circle is an error.
    """
    edges = edges.select("parent", "child", "ord")
    step = F.struct("ord", F.col("child").alias("name"))
    level = edges.where(F.col("parent") == heading).select(F.col("child").alias("indicator"), F.col("child").alias("node"), F.array(step).alias("path"))
    level = level.where(~F.col("node").rlike(excluded)) if excluded else level
    schema, base, levels = level.schema, workspace(spark), []
    for depth in range(most_levels):
        level.groupBy("indicator", "node").agg(F.min("path").alias("path")).write.parquet(f"{base}/{depth}")  # shared children once a level
        level = spark.read.schema(schema).parquet(f"{base}/{depth}")
        if level.isEmpty():
            break
        levels.append(level)
        nxt = edges.join(level, edges["parent"] == level["node"])
        level = nxt.select("indicator", F.col("child").alias("node"), F.concat("path", F.array(step)).alias("path"))
        if not nxt.where(F.array_contains(F.transform("path", lambda p: p["name"]), F.col("child"))).isEmpty():
            raise ValueError(f"a circle below {heading}")
    else:
        raise ValueError(f"more than {most_levels} levels below {heading}")
    if not levels:
        return spark.createDataFrame([], "indicator string, indicator_seq int, concept string, position int")
    rows = reduce(DataFrame.unionByName, levels).groupBy("indicator", "node").agg(F.min("path").alias("path"))
    rows = rows.join(reportable.select("node").distinct(), "node", "left_semi")
    rows = rows.where(~F.col("node").rlike(excluded)) if excluded else rows
    first = rows.groupBy("indicator").agg(F.min(F.get("path", F.lit(0))).alias("_first"))  # children of one heading
    seq = first.withColumn("indicator_seq", F.row_number().over(Window.orderBy("_first"))).drop("_first")
    placed = rows.withColumn("position", F.row_number().over(Window.partitionBy("indicator").orderBy("path")))
    return placed.join(seq, "indicator").select("indicator", "indicator_seq", F.col("node").alias("concept"), "position")


def build_concept_map(shortlist: DataFrame, defined: DataFrame, used: DataFrame, renames: DataFrame) -> DataFrame:
    """For each version and wanted concept: itself if defined and used there, else its renamed predecessor if that is."""
    both = defined.join(used, ["version", "concept"], "left_semi").select("version", "concept")
    wanted = shortlist.select("metric", "concept").withColumn("_place", F.lit(0)).unionByName(shortlist.join(renames, "concept").select("metric", F.col("predecessor").alias("concept"), F.lit(1).alias("_place")))
    hits = wanted.join(both, "concept")
    return hits.withColumn("_n", F.row_number().over(Window.partitionBy("metric", "version").orderBy("_place", "concept"))).where("_n = 1").drop("_n", "_place")


def typed_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A rule table with declared types; codes keep their leading zeros."""
    return spark.read.schema(schema).options(header=True, mode="FAILFAST").csv(path)


def write_export(df: DataFrame, path: str, decimals: int = 6, most_rows: int = 5_000_000) -> DataFrame:
    """One file with plain types and a total order, the same bytes whatever the partitioning. For report tables: all rows
    pass one task, so more than most_rows are refused."""
    n = df.count()
    if n > most_rows:
        raise ValueError(f"{n} rows; one file takes {most_rows} at most")
    plain = df.select(*(F.round(F.col(f.name).cast("double"), decimals).alias(f.name) if f.dataType.typeName() in ("decimal", "double", "float") else F.col(f.name) for f in df.schema))
    plain.coalesce(1).sortWithinPartitions(*plain.columns).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_results(results: Mapping[str, DataFrame], path: str, kind: str = "csv") -> None:
    """Named results, each in a folder of its own."""
    for name, df in results.items():
        writer = df.write.mode("overwrite")
        writer.option("header", True).csv(f"{path}/{name}") if kind == "csv" else writer.json(f"{path}/{name}")


def day_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
