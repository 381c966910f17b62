"""URL filters: a sorted array of 64-bit digests, memory-mapped, with the full strings beside it. Spark hashes the rules."""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import hadoop_path, others, shared_dir, short_batches, table

#: (host, path, verdict): the rules of the registered query.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: The verdict for a url that no rule fits.
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _columns(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(digest, key, allow) of every rule and (digest, host, lengths of its paths) of every host, by Spark. A key is host +
    path; of repeated keys the first holds, or the one that blocks if rules have no place."""
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), (F.col("verdict") == "allow").alias("allow"), F.col("place") if "place" in rules.columns else F.when(F.col("verdict") == "allow", 1).otherwise(0).alias("place")).where("host is not null")
    keys = rules.groupBy(F.concat("host", "path").alias("key")).agg(F.min_by("allow", "place").alias("allow"))
    hosts = rules.groupBy("host").agg(F.array_sort(F.collect_set(F.length("path"))).alias("lengths"))
    return keys.select(F.xxhash64("key").alias("digest"), "key", "allow"), hosts.select(F.xxhash64("host").alias("digest"), "host", "lengths")


def _digest(text: str) -> int:
    """What Spark's xxhash64 says of a text, as unsigned."""
    return xxhash.xxh64_intdigest(text.encode(), seed=42)


class DigestArray:
    """Texts by their sorted 64-bit digests. build() writes flat arrays into a folder; they are memory-mapped, so every
    worker of a machine shares the same pages."""

    def __init__(self, folder: str):
        self.digests, self.starts, self.text = (self._map(f"{folder}/{n}", t) for n, t in (("digests", np.uint64), ("starts", np.int64), ("text", np.uint8)))
        self.folder = folder

    @staticmethod
    def _map(path: str, kind) -> np.ndarray:
        return np.memmap(path, kind, mode="r") if os.path.getsize(path) else np.zeros(0, kind)

    @staticmethod
    def build(folder: str, digests: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Writes the arrays; returns the order of the texts."""
        os.makedirs(folder)
        order = np.argsort(digests, kind="stable")
        texts = texts.take(pa.array(order)).cast(pa.large_binary())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        digests[order].tofile(f"{folder}/digests")
        np.cumsum(np.append(0, sizes), dtype=np.int64).tofile(f"{folder}/starts")
        data = texts.buffers()[2]
        with open(f"{folder}/text", "wb") as f:
            f.write(data if data is not None else b"")
        return order

    def find(self, keys: list[str]) -> np.ndarray:
        """For each key its place in the array, or -1: binary search for all at once, then the strings are compared."""
        wanted = np.fromiter(map(_digest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, wanted)
        out = np.full(len(keys), -1, np.int64)
        for i in np.flatnonzero((at < len(self.digests)) & (self.digests[np.minimum(at, len(self.digests) - 1)] == wanted) if len(self.digests) else np.zeros(len(keys), bool)):
            j, key = int(at[i]), keys[i].encode()
            while j < len(self.digests) and self.digests[j] == wanted[i]:
                if self.text[self.starts[j] : self.starts[j + 1]].tobytes() == key:
                    out[i] = j
                    break
                j += 1
        return out


class Index:
    """The rules of an executor: keys with their verdicts, and hosts with the lengths of their paths."""

    def __init__(self, folder: str):
        self.keys, self.hosts = DigestArray(f"{folder}/keys"), DigestArray(f"{folder}/hosts")
        self.allow, self.lengths, self.lengths_at = (DigestArray._map(f"{folder}/{n}", t) for n, t in (("allow", bool), ("lengths", np.int64), ("lengths_at", np.int64)))

    @staticmethod
    def of(name: str, tables: tuple[list[str], list[str]]) -> Index:
        """From the files that Spark wrote and fetched to this machine. The first worker there makes the arrays and the others
        open them; a worker that can't open them, or can't share its own, goes on with its own."""
        done = f"{os.path.abspath(SparkFiles.getRootDirectory())}/{name}"
        try:
            return Index(done)
        except OSError:  # not there yet, or not whole
            made = tempfile.mkdtemp(dir=os.path.dirname(done))
            keys, hosts = (pa.concat_tables([pq.read_table(SparkFiles.get(f)) for f in own]) for own in tables)
            raw = lambda t: t["digest"].to_numpy().view(np.uint64)
            order = DigestArray.build(f"{made}/keys", raw(keys), keys["key"].combine_chunks() if keys.num_rows else pa.array([], pa.string()))
            keys["allow"].to_numpy(zero_copy_only=False).astype(bool)[order].tofile(f"{made}/allow")
            order = DigestArray.build(f"{made}/hosts", raw(hosts), hosts["host"].combine_chunks() if hosts.num_rows else pa.array([], pa.string()))
            lengths = hosts["lengths"].take(pa.array(order)).combine_chunks() if hosts.num_rows else pa.array([], pa.list_(pa.int32()))
            lengths.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tofile(f"{made}/lengths")
            np.cumsum(np.append(0, lengths.value_lengths().to_numpy(zero_copy_only=False)), dtype=np.int64).tofile(f"{made}/lengths_at")
            index = Index(made)  # mapped before it moves, so it holds whatever becomes of the names
            try:
                os.rename(made, done)
            except OSError:
                with contextlib.suppress(OSError):  # another worker was faster
                    index = Index(done)
                shutil.rmtree(made, ignore_errors=True)
            return index

    def best(self, hosts: list[str], paths: list[str]) -> list[tuple[str, bool] | None]:
        """For each url the longest rule that fits (the longer host of equal ones) and whether it allows."""
        parts, owner = [], []
        for i, part in enumerate(hosts):
            while part:
                parts.append(part)
                owner.append(i)
                part = part.partition(".")[2]
        keys, of, size = [], [], []
        for p, h in enumerate(self.hosts.find(parts).tolist()):
            if h >= 0:
                path = paths[owner[p]]
                for n in self.lengths[self.lengths_at[h] : self.lengths_at[h + 1]].tolist():
                    if n > len(path):
                        break
                    keys.append(parts[p] + path[:n])
                    of.append(owner[p])
                    size.append((len(parts[p]) + n, len(parts[p])))
        out: list[tuple[str, bool] | None] = [None] * len(hosts)
        longest: dict[int, tuple[int, int]] = {}
        for k, at in enumerate(self.keys.find(keys).tolist()):
            if at >= 0 and size[k] > longest.get(of[k], (-1, -1)):
                longest[of[k]] = size[k]
                out[of[k]] = (keys[k], bool(self.allow[at]))
        return out


def _ship(rules: DataFrame) -> tuple[str, tuple[list[str], list[str]]]:
    """Write the tables to the shared folder; Spark fetches their files to each executor once."""
    spark = rules.sparkSession
    name, shipped = f"urls-{uuid.uuid4().hex}", []
    path = f"{shared_dir(spark)}/{name}"
    for part, df in zip(("keys", "hosts"), _columns(rules), strict=True):
        df.write.parquet(f"{path}/{part}")
        files = spark.read.schema(df.schema).parquet(f"{path}/{part}").inputFiles()
        for f in files:
            spark.sparkContext.addFile(f)
        shipped.append([f.rpartition("/")[2] for f in files])
    hadoop_path(spark, path, lambda fs, p: fs.deleteOnExit(p))
    return name, (shipped[0], shipped[1])


def judge(pages: DataFrame, rules: DataFrame | Sequence[tuple[str, str, str]], default: str = DEFAULT, url: str = "url") -> DataFrame:
    """pages with host, path, rule (host + path of the longest rule that fits, else null) and verdict.

    A rule fits its host and all subdomains if the path starts with the rule's. A null url or one without :// has an
    empty host and path, which no rule fits. Equally long rules: the one with the longer host wins. Columns named like
    the new ones are replaced; all others stay. Repeated pages are judged one by one, a long url whole; an empty table gives
    an empty table, and without rules every page gets the default.

    rules is a table (host, path, verdict) of any size that an executor's disk holds, or a short list of such rows, whose
    first one holds where keys repeat. Spark hashes and groups the rules; none of them passes through the driver.
    """
    spark = pages.sparkSession
    short_batches(spark)
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(*r, i) for i, r in enumerate(rules)], "host string, path string, verdict string, place int")
    name, shipped = _ship(rules)
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    own = others(pages, ["host", "path", "rule", "verdict"])
    kept = pages.select(*own).columns
    split = pages.select(*own, rest.alias("_rest"))
    split = split.select(*(split[f"`{c}`"] for c in kept), "_rest", F.regexp_extract("_rest", r"^[^/?#]*", 0).alias("_host"))
    split = split.select(*(split[f"`{c}`"] for c in kept), F.translate("_host", _UPPER, _LOWER).alias("host"), F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), r"^[^?#]*", 0).alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.of(name, shipped)
        for b in batches:
            hits = index.best(b.column("host").to_pylist(), b.column("path").to_pylist())
            rules_of = [hit[0] if hit else None for hit in hits]
            verdicts = [("allow" if hit[1] else "block") if hit else default for hit in hits]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*kept, "host", "path")), pa.array(rules_of, pa.string()), pa.array(verdicts, pa.string())], names=[*kept, "host", "path", "rule", "verdict"])

    return split.mapInArrow(run, StructType([*split.schema.fields, *StructType.fromDDL("rule string, verdict string").fields]))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).drop("url")


OP4_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
parts AS (SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
fits AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
                row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.host || r.path) DESC NULLS LAST, length(r.host) DESC) AS n
         FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM fits WHERE n = 1
"""
