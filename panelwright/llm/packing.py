"""Best-fit packing: Martello and Toth's dominance rules fix small sets of pieces, best fit packs what is left.

Only lengths matter to a packing, and there are at most LIMIT of them. Spark tokenizes, counts pieces of each length, and
later deals out places; the packing itself works on the table of counts, whose size doesn't grow with the corpus.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .common import materialize, others, short_batches, table

#: Tokens in a sequence; the id after each document; the vocabulary.
LIMIT, LAST_ID, VOCABULARY = 1024, 2, "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def encoder(path: str, added: bool = False):
    """A function from a text to its ids as bytes (unsigned 32-bit, little-endian).

    The vocabulary's ranks are read with tiktoken, whose ids equal those of the tokenizers library over the same
    vocabulary (tests hold them against each other) at a third of its time. With `added`, the added tokens of
    the JSON file beside the ranks are found in texts, as that library does by default; else they are ordinary text.
    """
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    special = {t["content"]: t["id"] for t in json.loads(Path(path).with_suffix(".json").read_text(encoding="utf-8"))["added_tokens"]} if added else {}
    core = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: core.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


def pieces(docs: DataFrame, limit: int, path: str) -> DataFrame:
    """Every document as pieces of at most `limit` tokens: kept columns, piece, start, length, ids_crc32; and part and nth:
    the task, and the piece's number among those of its length there."""
    own = others(docs, ["text", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "part", "nth", "before", "_text"])
    kept = docs.select(*own).columns
    source = docs.select(*own, F.coalesce("text", F.lit("")).alias("_text"))
    last = np.array([LAST_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, part = encoder(path, added=True), np.zeros(limit + 1, np.int64), TaskContext.get().partitionId()
        for b in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(b.column("_text")):
                ids = encode(text.as_py()) + last
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % limit + 1, n, limit), n]
                for p, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    rows.append(k)
                    piece.append(p)
                    start.append(i)
                    length.append(j - i)
                    crc.append(zlib.crc32(ids[4 * i : 4 * j]))
            at, n = pa.array(rows, pa.int64()), np.array(length, np.int64)
            order = np.argsort(n, kind="stable")
            nth = np.empty(len(n), np.int64)
            nth[order] = np.arange(len(n)) - np.searchsorted(n[order], n[order])
            nth += seen[n]
            seen += np.bincount(n, minlength=limit + 1)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in kept), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, np.full(len(n), part), nth))], names=[*kept, "piece", "start", "length", "ids_crc32", "part", "nth"])

    new = StructType.fromDDL("piece int, start long, length long, ids_crc32 long, part long, nth long")
    return source.mapInArrow(run, StructType([*source.schema.fields[:-1], *new.fields]))


def _beside(left: np.ndarray, n: int, room: int) -> list[int] | None:
    """What may stand for good with a piece of length n, of which one is left at least; None if no rule tells."""
    have = left.copy()
    have[n] -= 1
    sizes = np.flatnonzero(have)
    fits = sizes[sizes <= room]
    if not len(fits):
        return []
    longest = int(fits[-1])
    small = np.repeat(sizes[:3], np.minimum(have[sizes[:3]], 3))[:3].tolist()
    if longest == room or sum(small[:2]) > room or len(small) < 2:
        return [longest]
    if len(small) > 2 and sum(small) <= room:
        return None
    # two more fit at most: the pair with the largest sum
    best = np.maximum.accumulate(np.where(have[: room + 1] > 0, np.arange(room + 1), 0))
    second = best[np.minimum(fits, room - fits)]
    second = np.where((second == fits) & (have[fits] < 2), best[fits - 1], second)
    total = np.where(second > 0, fits + second, 0)
    if total.max() <= longest:
        return [longest]
    if second[-1] > 0 and total[-1] == total.max():
        above = sizes[sizes > second[-1]]
        two = np.repeat(above[:2], np.minimum(have[above[:2]], 2))[:2]
        if len(two) < 2 or two.sum() > room:  # no pair that fits has both its members larger than this one's second
            return [longest, int(second[-1])]
    return None


def pack_lengths(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, list[int]]]:
    """(how many sequences, the lengths in each) for so many pieces of each length.

    Dominance, longest piece first. A set with this piece is fixed for good if whatever else could stand beside the piece
    fits into the set's other pieces: nothing fits; the longest that fits fills the sequence, or no two fit, or no two
    that fit are longer than it; or, where no three fit, the longest with its best second, if no pair has a longer
    second. What no rule fixes is packed best fit, longest first: each piece into the fullest open sequence with room.
    """
    left = np.zeros(limit + 1, np.int64)
    for n, c in counts.items():
        left[n] += c
    out: list[tuple[int, list[int]]] = []
    for n in range(limit, 0, -1):
        while left[n]:
            more = _beside(left, n, limit - n)
            if more is None:
                break
            need = np.bincount([n, *more], minlength=limit + 1)
            times = int((left[need > 0] // need[need > 0]).min())
            left -= times * need
            out.append((times, [n, *more]))
    # best fit; open sequences with equal contents are one entry
    by_room: list[list[tuple[int, list[int]]]] = [[] for _ in range(limit + 1)]
    for n in range(limit, 0, -1):
        need = int(left[n])
        while need:
            room = next((r for r in range(n, limit) if by_room[r]), limit)
            times, held = by_room[room].pop() if room < limit else (need, [])
            each = min(room // n, need)
            used = min(times, need // each)
            if used < times and room < limit:
                by_room[room].append((times - used, held))
            by_room[room - each * n].append((used, held + [n] * each))
            need -= used * each
    return out + [entry for entries in by_room for entry in entries]


def pack(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """Pieces of all documents with their place: sequence_id (from 0) and offset, gapless from 0.

    Text columns go, all others stay; columns named like the new ones are replaced. A null or empty text is one piece
    of one token, the last id. Repeated rows are packed one by one. An empty table gives an empty table.
    """
    short_batches(docs.sparkSession)
    spark = docs.sparkSession
    cut = materialize(pieces(docs, limit, path or public_tokenizers.path(VOCABULARY)))

    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # for each length, its places in runs of sequences with equal contents: (sequences, the first, offset)
    runs: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for times, lengths in pack_lengths(totals, limit):
        offset = 0
        for n in sorted(lengths, reverse=True):
            runs.setdefault(n, []).append((times, sequence, offset))
            offset += n
        sequence += times
    shared = spark.sparkContext.broadcast({n: (np.cumsum([0, *(t for t, _, _ in r)]), np.array([s for _, s, _ in r]), np.array([o for _, _, o in r])) for n, r in runs.items()})
    before = counts.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    kept = cut.drop("part", "nth")
    names = kept.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, nth = b.column("length").to_numpy(), b.column("nth").to_numpy()
            out = np.zeros((2, len(n)), np.int64)
            for size in np.unique(n):
                begin, seq, off = shared.value[size]
                at = np.flatnonzero(n == size)
                k = np.searchsorted(begin, nth[at], side="right") - 1
                out[0, at], out[1, at] = seq[k] + nth[at] - begin[k], off[k]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(out[0]), pa.array(out[1])], names=[*names, "sequence_id", "offset"])

    placed = cut.join(before, ["part", "length"]).withColumn("nth", F.col("nth") + F.col("before"))
    return placed.select(*(placed[f"`{c}`"] for c in names), "nth").mapInArrow(place, StructType([*kept.schema.fields, *StructType.fromDDL("sequence_id long, offset long").fields]))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: the packed pieces of the documents that are left. Null and empty texts are one piece of one token, repeated
    rows are packed one by one, an empty table gives no pieces."""
    return pack(docs.select("doc_id", "text"))
