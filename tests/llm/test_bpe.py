import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={})


def check(rows, library):
    for r in rows:
        text = r.text or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows_and_documents(spark, odd, clashing, none, sf, library):
    for docs in (odd, clashing, none, spark.read.parquet(f"{sf}/documents.parquet")):
        out = bpe.digests(docs)
        rows = out.collect()
        assert len(rows) == docs.count() and set(docs.columns) <= set(out.columns)
        check(rows, library)


def test_fold_is_the_librarys_merging(spark, sf, library):
    words = spark.read.parquet(f"{sf}/documents.parquet").select(F.explode(F.regexp_extract_all("text", F.lit("(?U)" + public_tokenizers.PATTERN), F.lit(0))).alias("w")).distinct().orderBy(F.xxhash64("w")).limit(1500)
    extra = spark.createDataFrame([(x,) for x in ("a", " ", "\n\n", "é", "日本", "\U0001f600", "'s", " unbelievably", "x" * 48, "!?!?")], "w string")
    got = words.union(extra).select("w", bpe.fold(F.col("w"), bpe.rank_map(bpe.ranks_of(PATH))).alias("ids")).collect()
    for r in got:
        assert r.ids == library.encode_ordinary(r.w), r.w


def test_round_trip_in_columns(spark, odd, library):
    rows = bpe.encode(odd).withColumn("back", bpe.decode(F.col("ids"))).collect()
    for r in rows:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab' ,.\n\té日0s\U0001f600\x1c t"), max_size=40))
def test_any_text(text):
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={})
    encoder = _encoder()
    ids = lib.encode_ordinary(text)
    assert encoder.ids(text) == ids
    assert encoder.digest(text)[:2] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def _encoder(held=[]):
    if not held:
        held.append(bpe.Encoder(bpe.ranks_of(PATH), {}))
    return held[0]


def test_long_words_merge_alike():
    ranks = bpe.ranks_of(PATH)
    word = ("the of and " * 60).replace(" ", "").encode()
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert bpe.merge(word, ranks) == lib.encode_ordinary(word.decode())
