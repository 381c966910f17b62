"""Token counts: texts are encoded in Arrow functions that return lengths only."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_map

#: The vocabulary, bytes of text that one call of the library encodes, and the most tokens of a document within the limit.
VOCABULARY, CALL_BYTES, LIMIT = "word_bpe_49k.json", 1 << 18, 2048
#: A piece longer than this is cut again; pieces up to this length whose counts a task keeps, and how many of them.
LONG, KEEP, KEPT = 1 << 14, 64, 1 << 20
_BEFORE_DIGIT = re.compile(rb"(?=[0-9])")


@lru_cache(maxsize=2)
def counter(path: str):
    """A function from pieces of text (bytes) to their numbers of tokens, as the vocabulary's own library has them.

    A .json file is for tokenizers, a .model file for sentencepiece. No special tokens are added; special strings inside a
    text are handled as is the library's default. Bytes that are no UTF-8 count as U+FFFD.
    """
    if Path(path).suffix == ".model":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda pieces: [len(x) for x in model.encode([p.decode("utf-8", "replace") for p in pieces], num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda pieces: [len(x) for x in model.encode_batch_fast([p.decode("utf-8", "replace") for p in pieces], add_special_tokens=False)]


def balanced(pieces: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """Runs of pieces of about `size` bytes each, whatever their number; a longer piece is a run of its own."""
    held: list[bytes] = []
    total = 0
    for p in pieces:
        if held and total + len(p) > size:
            yield held
            held, total = [], 0
        held.append(p)
        total += len(p)
    if held:
        yield held


def split_words(text: bytes) -> list[bytes]:
    """Cuts for a vocabulary of words: at ASCII white space, which stands in no token, and in long runs without any also before
    ASCII digits, each of which is a token by itself. All are starters of their own under NFC, so no cut changes what stands
    beside it, and no special string holds one."""
    pieces = text.split()
    if len(text) > LONG and any(len(p) > LONG for p in pieces):
        pieces = [x for p in pieces for x in ([p] if len(p) <= LONG else filter(None, _BEFORE_DIGIT.split(p)))]
    return pieces


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs without text, with n_bytes (UTF-8) and n_tokens of the whole text.

    Texts are cut where no token can span the cut, so any text is counted in pieces, however long it is; a run without a safe
    boundary stays whole. Calls of the library are balanced by bytes, as are the Arrow batches, and a piece that a task has
    counted before isn't encoded again. White space means nothing to a vocabulary of words; others (.model) have no boundary
    that is safe by itself and get whole texts. A null text is empty and has 0 of both. Repeated rows are counted one by one; an
    empty table gives an empty table; other columns stay, and those named like the new ones are replaced.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    cut = (lambda text: [text] if text else []) if path.endswith(".model") else split_words

    def start():
        count, known = counter(path), {}

        def work(texts: pa.Array):
            pieces = [cut(t.as_py()) for t in texts]
            fresh = {p for own in pieces for p in own if p not in known}
            if len(known) + len(fresh) > KEPT:
                known.clear()
                fresh = {p for own in pieces for p in own}
            now = known
            for run in balanced(sorted(fresh, key=len), CALL_BYTES):
                now.update(zip(run, count(run), strict=True))
            n = [sum(map(now.__getitem__, own)) for own in pieces]
            for p in fresh:
                if len(p) > KEEP:
                    del known[p]
            return [pa.array([len(t.as_py()) for t in texts], pa.int64()), pa.array(np.array(n, np.int64))]

        return work

    return text_map(docs, "n_bytes long, n_tokens long", start, drop=("text",))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than LIMIT tokens."""
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
