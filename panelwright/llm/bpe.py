"""Byte-level BPE: frequent words are merged by Spark's higher-order functions over a literal rank map, and texts are put
together from them.

The method folds ranked merges over the bytes of distinct words. It does so here for the FREQUENT most frequent words of
the corpus, which make up most of all texts; their ids (a bounded table) go to every executor. The same merges are applied
inside the task to the words that are left: joining every distinct word back to each text that holds it would shuffle a
multiple of the input (see the README).
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from functools import lru_cache
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table, text_map

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Words whose merges Spark folds, at most, and bytes in each of them, at most.
FREQUENT, LONGEST = 65_536, 48
#: Parts of the rank map: a look-up compares a few keys of one part, as Spark looks through a map from end to end.
PARTS = 16_384
#: Words, with what stands around them between two spaces, that a worker remembers.
REMEMBERED = 300_000


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}


def rank_map(ranks: dict[bytes, int]):
    """A function from a binary column to its rank (null: none), by a literal array of maps, chosen by crc32."""
    parts: list[dict[str, int]] = [{} for _ in range(PARTS)]
    for piece, rank in ranks.items():
        parts[zlib.crc32(piece) % PARTS][piece.hex().upper()] = rank
    literal = F.from_json(F.lit(json.dumps(parts, separators=(",", ":"))), "array<map<string,int>>")
    return lambda c: F.try_element_at(F.get(literal, (F.crc32(c) % PARTS).cast("int")), F.hex(c))


def fold(word: Column, rank) -> Column:
    """Ids of one pre-token: its own rank if it has one; else the adjacent pair of least rank, the leftmost of equals, is
    merged until no pair has a rank."""
    data = F.encode(word, "UTF-8")
    pieces = F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.substring(data, i, F.lit(1)))
    step_type = "struct<p:array<binary>,done:boolean>"

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def step(acc: Column, _: Column) -> Column:
        p = acc.getField("p")
        pairs = F.transform(F.sequence(F.lit(0), F.size(p) - 2), lambda i: rank(F.concat(F.get(p, i), F.get(p, i + 1))))

        def merge(r: Column) -> Column:
            at = F.array_position(r, F.array_min(r)).cast("int")
            joined = F.concat(F.slice(p, F.lit(1), at - 1), F.array(F.concat(F.get(p, at - 1), F.get(p, at))), F.slice(p, at + 2, F.size(p)))
            return F.when(F.array_min(r).isNull(), F.struct(p.alias("p"), F.lit(True).alias("done"))).otherwise(F.struct(joined.alias("p"), F.lit(False).alias("done")))

        return F.when(acc.getField("done") | (F.size(p) < 2), acc).otherwise(let(pairs, merge)).cast(step_type)

    start = F.struct(pieces.alias("p"), F.lit(False).alias("done")).cast(step_type)
    merged = F.transform(F.aggregate(F.sequence(F.lit(2), F.octet_length(word)), start, step).getField("p"), rank)
    whole = rank(data)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(merged)


def frequent_words(docs: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The most frequent pre-tokens of all texts, `most` at most (those of one frequency class come or stay together)."""
    pattern = "(?U)" + public_tokenizers.PATTERN
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("word"))
    counts = materialize(words.where(F.octet_length("word").between(1, LONGEST)).groupBy("word").agg(F.count("*").alias("n")))
    band = F.floor(F.log2("n") * 64)
    seen, cut = 0, None
    for b, n in sorted(counts.groupBy(band.alias("b")).agg(F.count("*").alias("n")).collect(), reverse=True):
        if seen + n > most:
            break
        seen, cut = seen + n, b
    return counts.where(band >= cut if cut is not None else F.lit(False)).select("word")


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one word, inside a task."""
    if word in ranks:
        return [ranks[word]]
    pieces = [word[i : i + 1] for i in range(len(word))]
    if len(pieces) > 500:
        return _merge_long(pieces, ranks)
    none = len(ranks)
    pairs = [ranks.get(a + b, none) for a, b in zip(pieces, pieces[1:])]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(pieces[i] + pieces[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(pieces[i - 1] + pieces[i], none)
    return [ranks[p] for p in pieces]


def _merge_long(pieces: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """For words of any length: a heap of pairs and links to both sides, n log n."""
    from heapq import heapify, heappop, heappush

    n = len(pieces)
    right, left = [*range(1, n), -1], [-1, *range(n - 1)]
    held: list[bytes | None] = list(pieces)
    heap = [(r, i, held[i] + held[i + 1]) for i in range(n - 1) if (r := ranks.get(held[i] + held[i + 1])) is not None]
    heapify(heap)
    while heap:
        _, i, pair = heappop(heap)
        j = right[i] if held[i] is not None else -1
        if j < 0 or held[i] + held[j] != pair:
            continue
        held[i], held[j] = pair, None
        right[i] = right[j]
        if right[i] >= 0:
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b >= 0 and (r := ranks.get(held[a] + held[b])) is not None:
                heappush(heap, (r, a, held[a] + held[b]))
    return [ranks[p] for p in held if p is not None]


_FIRST, _SECOND = itemgetter(0), itemgetter(1)


class Merges:
    """The same merges for many words at once: words of similar length are rows of a matrix, and each step joins one pair in
    every row that still has one. Pieces are known by their ranks, pairs by a hash table from two ranks to the joined one."""

    #: What stands for "no rank"; words of up to so many bytes share a matrix, longer ones are merged one by one, as are
    #: fewer words than FEW.
    NONE, WIDTHS, FEW = np.int32(2**31 - 1), (4, 6, 8, 12, 16, 24, 32, 48, 64), 48

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = [(x << 32 | y, r) for piece, r in ranks.items() for i in range(1, len(piece)) if (x := ranks.get(piece[:i])) is not None and (y := ranks.get(piece[i:])) is not None]
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        bits = max(4, (2 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64), np.full(1 << bits, self.NONE, np.int32)
        key, value = np.array([k for k, _ in pairs], np.uint64), np.array([v for _, v in pairs], np.int32)
        at = self._slot(key)
        while len(key):
            _, first = np.unique(at, return_index=True)
            put = first[self.values[at[first]] == self.NONE]
            self.keys[at[put]], self.values[at[put]] = key[put], value[put]
            left = np.ones(len(key), bool)
            left[put] = False
            key, value, at = key[left], value[left], (at[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def joined(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The rank of each pair of pieces, or NONE."""
        key = x.astype(np.uint64) << np.uint64(32) | y.astype(np.uint64)
        at = self._slot(key)
        out = self.values[at]
        open_ = np.flatnonzero((self.keys[at] != key) & (out != self.NONE))
        out[open_] = self.NONE
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            value = self.values[at[open_]]
            same = self.keys[at[open_]] == key[open_]
            out[open_[same]] = value[same]
            open_ = open_[~same & (value != self.NONE)]
        return out

    def merge(self, words: list[bytes]) -> list[list[int]]:
        if len(words) < self.FEW:
            return [merge(w, self.ranks) for w in words]
        out: list[list[int]] = [[r] if (r := self.ranks.get(w)) is not None else [] for w in words]
        size = np.array([len(w) if not o else 0 for w, o in zip(words, out, strict=True)], np.int64)
        low = 1
        for width in self.WIDTHS:
            rows = np.flatnonzero((size > low) & (size <= width))
            low = width
            for i in range(0, len(rows), 16_384):
                own = rows[i : i + 16_384]
                for k, ids in zip(own.tolist(), self._matrix([words[k] for k in own.tolist()], size[own], width), strict=True):
                    out[k] = ids
        for k in np.flatnonzero(size > low).tolist():
            out[k] = merge(words[k], self.ranks)
        return out

    def _matrix(self, words: list[bytes], size: np.ndarray, width: int) -> list[list[int]]:
        n, none = len(words), self.NONE
        # one more column on each side, so that every piece has neighbours
        pieces = np.zeros((n, width + 2), np.int32)
        pieces[:, 1:-1] = self.byte[np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(n, width)]
        rank = np.full((n, width + 2), none, np.int32)  # of the pair that begins here
        column = np.arange(1, width)
        real = column[None, :] < size[:, None]
        rank[:, 1:width][real] = self.joined(pieces[:, 1:width][real], pieces[:, 2 : width + 1][real])
        right = np.tile(np.arange(1, width + 3, dtype=np.int32), (n, 1))
        left = right - 2
        alive = np.arange(width + 2)[None, :] <= size[:, None]
        alive[:, 0] = False
        last = size.astype(np.int32)
        row = np.arange(n)
        while len(row):
            at = rank[row].argmin(axis=1)
            value = rank[row, at]
            go = value != none
            row, at, value = row[go], at[go], value[go]
            gone = right[row, at]
            after, before = right[row, gone], left[row, at]
            pieces[row, at], right[row, at] = value, after
            alive[row, gone], rank[row, gone] = False, none
            inner = after <= last[row]
            left[row[inner], after[inner]] = at[inner]
            rank[row, at] = none
            rank[row[inner], at[inner]] = self.joined(value[inner], pieces[row[inner], after[inner]])
            inner = before > 0
            rank[row[inner], before[inner]] = self.joined(pieces[row[inner], before[inner]], value[inner])
        ids, end = pieces[alive].tolist(), np.cumsum(alive.sum(axis=1)).tolist()
        return [ids[i:j] for i, j in zip([0, *end[:-1]], end, strict=True)]


class Encoder:
    """Encodes texts word by word. A text without longer runs of white space is cut at its spaces (no pre-token holds
    what stands on both sides of a single space). What stands between is worked out once for all texts of a batch, and
    remembered: its ids in decimal, and the bytes of their pieces, so that a text's decoding is a concatenation."""

    def __init__(self, ranks: dict[bytes, int], frequent: dict[str, list[int]]):
        self.ranks, self.frequent = ranks, frequent
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.piece = {r: p for p, r in ranks.items()}
        self.merges = Merges(ranks)
        self.usual = {word: self._pair(ids) for word, ids in frequent.items()}
        self.known: dict[str, tuple[str, bytes]] = {}

    def _pair(self, ids: list[int]) -> tuple[str, bytes]:
        return ",".join(map(str, ids)), self.decode(ids)

    def ids(self, text: str) -> list[int]:
        words = self.pattern.findall(text)
        new = [w for w in dict.fromkeys(words) if w not in self.frequent]
        own = dict(zip(new, self.merges.merge([w.encode() for w in new]), strict=True))
        return [i for w in words for i in (own[w] if w in own else self.frequent[w])]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.piece[i] for i in ids])

    def _learn(self, parts: list[str]) -> None:
        """Remember what stands between two spaces, for many such parts at once."""
        words = self.pattern.findall(" " + " ".join(parts)) if parts else []
        new = [w for w in dict.fromkeys(words) if w not in self.usual]
        own = {w: self._pair(ids) for w, ids in zip(new, self.merges.merge([w.encode() for w in new]), strict=True)}
        got: list[tuple[str, bytes]] = []
        for w in words:
            pair = own.get(w) or self.usual[w]
            if w[0] == " ":  # a part begins
                got.append(pair)
            else:
                got[-1] = (f"{got[-1][0]},{pair[0]}", got[-1][1] + pair[1])
        self.known.update(zip(parts, got, strict=True))

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text: number of ids, SHA-256 of the ids in decimal joined by commas, SHA-256 of the bytes that the ids
        decode to."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, split, new = self.known, [t.split(" ") for t in texts], set()
        for parts in split:
            new |= set(parts[1:]).difference(known)
        odd = {p for p in new if not p or p[0].isspace() or p[-1].isspace()}
        self._learn([*(new - odd)])
        out = []
        for text, parts in zip(texts, split, strict=True):
            first = parts[0]
            if not first or first[0].isspace() or first[-1].isspace() or (odd and not odd.isdisjoint(parts)):
                ids, data = self._pair(self.ids(text))
            else:
                all_ = [self._pair(self.ids(first)), *map(known.__getitem__, parts[1:])]
                ids, data = ",".join(map(_FIRST, all_)), b"".join(map(_SECOND, all_))
            out.append((ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(data).hexdigest()))
        return out

    def digest(self, text: str) -> tuple[int, str, str]:
        return self.digests([text])[0]


@lru_cache(maxsize=1)
def _worker_encoder(path: str, key: str, shared) -> Encoder:
    return Encoder(ranks_of(path), shared.value)


def _dictionary(docs: DataFrame, path: str) -> dict[str, list[int]]:
    words = frequent_words(docs.where("text is not null"))
    words = words.repartition(32, "word").select("word", fold(F.col("word"), rank_map(ranks_of(path))).alias("ids"))
    return {r.word: list(r.ids) for r in words.collect()}


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with ids (array of int), the whole text's ids without special tokens; null texts count as empty.

    Columns named like the new ones are replaced, all others stay; repeated rows are encoded one by one. A long text is
    encoded whole; bytes that are no UTF-8 are read as U+FFFD; an empty table gives an empty table.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    shared = docs.sparkSession.sparkContext.broadcast(_dictionary(docs, path))

    def start():
        encoder = Encoder(ranks_of(path), shared.value)
        return lambda texts: [pa.array([encoder.ids(t.as_buffer().to_pybytes().decode("utf-8", "replace")) for t in texts], pa.list_(pa.int32()))]

    return text_map(docs, "ids array<int>", start)


def decode(ids: Column, path: str | None = None) -> Column:
    """The bytes of an array of ids: binary pieces from a literal array, concatenated."""
    ranks = ranks_of(path or public_tokenizers.path(VOCABULARY))
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    literal = F.from_json(F.lit(json.dumps(pieces, separators=(",", ":"))), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(literal, i)), ""))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256, as Encoder.digest() has them; else like encode()."""
    path = path or public_tokenizers.path(VOCABULARY)
    shared = docs.sparkSession.sparkContext.broadcast(_dictionary(docs, path))
    key = hashlib.sha256(repr(shared.value).encode()).hexdigest()

    def start():
        encoder = _worker_encoder(path, key, _Held(shared, key))

        def work(texts: pa.Array) -> list[pa.Array]:
            rows = encoder.digests([t.as_buffer().to_pybytes().decode("utf-8", "replace") for t in texts])
            return [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.string()) for k in (1, 2))]

        return work

    return text_map(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string", start)


class _Held:
    """A broadcast that equals others of the same contents, so that a reused worker keeps what it remembers."""

    def __init__(self, shared, key: str):
        self.shared, self.key = shared, key

    @property
    def value(self):
        return self.shared.value

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other) -> bool:
        return self.key == other.key


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
