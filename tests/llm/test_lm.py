import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelwright.llm import lm
from panelwright.llm.common import held_out


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def check(rows):
    train = Counter(t for r in rows if not r.held_out for t in tokens(r.text))
    n, v = sum(train.values()), len(train)
    for r in rows:
        t = tokens(r.text)
        assert r.train_tokens == n
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known) == (len(t), sum(train[x] > 0 for x in t))
        assert r.base_score == pytest.approx(sum(math.log10((train[x] + 1) / (n + v + 1)) for x in t), rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


@pytest.mark.parametrize("hot", [4, lm.HOT])
def test_base_score_on_odd_rows(odd, clashing, none, hot, monkeypatch):
    monkeypatch.setattr(lm, "HOT", hot)
    for docs in (odd, clashing, none):
        docs = docs.withColumns({"held_out": held_out("doc_id", 7, 2), "same": F.col("text")})
        got = lm.score(docs, docs.where("not held_out")).withColumnRenamed("same", "text").collect()
        assert len(got) == docs.count()
        check(got)


@pytest.mark.parametrize("hot", [40, lm.HOT])
def test_score_is_brute_force(spark, sf, hot, monkeypatch):
    """Score against the model's formula worked out word by word from the classes that the exchange made."""
    monkeypatch.setattr(lm, "HOT", hot)
    monkeypatch.setattr(lm, "RUN", 1000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({"held_out": held_out("doc_id", 7, 2), "same": F.col("text")})
    got = lm.score(docs, docs.where("not held_out")).withColumnRenamed("same", "text").collect()
    model, _ = lm.fit(docs.where("not held_out").select(F.coalesce("text", F.lit("")).cast("binary").alias("text")))
    train = [tokens(r.text) for r in got if not r.held_out]
    counts = Counter(t for text in train for t in text)
    words = sorted({t for r in got for t in tokens(r.text) if t is not None})
    hashes = next(lm._token_hashes(pa.array([" ".join(words).encode()])))[0][:-1]
    of = {w: int(model.of[u]) for w, u in zip(words, model.ids.look_up(hashes))} | {None: int(model.of[model.ids.end])}
    pairs = Counter((of[a], of[b]) for text in train for a, b in zip([None, *text], text))
    before, size, kinds, k = Counter(), Counter(), Counter(), len(model.step)
    for (a, _), n in pairs.items():
        before[a] += n
    for w, n in counts.items():
        size[of[w]] += n
        kinds[of[w]] += 1
    for r in got:
        t = tokens(r.text)
        want = sum(math.log10((pairs[of[a], of[b]] + lm.ALPHA) / (before[of[a]] + lm.ALPHA * k)) + math.log10((counts[b] + 1) / (size[of[b]] + kinds[of[b]] + 1)) for a, b in zip([None, *t], t))
        assert r.score == pytest.approx(want, rel=1e-9)
    assert len(set(of.values())) > 20 if hot > 100 else True


def test_every_frequent_word_is_clustered(spark, monkeypatch):
    """Two kinds of words that follow each other in turn; most of them are clustered by the rounds over all words."""
    monkeypatch.setattr(lm, "CLUSTERED", 8)
    monkeypatch.setattr(lm, "CLASSES", 2)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"{'ab'[i % 2]}{rng.integers(60)}" for i in range(400)) for _ in range(40)]
    model, _ = lm.fit(spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "text binary"))
    words = [f"{k}{i}" for k in "ab" for i in range(60)]
    of = model.of[model.ids.look_up(next(lm._token_hashes(pa.array([" ".join(words).encode()])))[0][:-1])]
    assert len(set(of[:60])) == 1 and len(set(of[60:])) == 1 and of[0] != of[60]


def test_no_training_text(odd):
    docs = odd.withColumn("held_out", F.lit(True))
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in lm.score(docs, docs.limit(0)).collect())


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({"held_out": held_out("doc_id", 7, 2), "same": F.col("text")})
    got = lm.score(docs, docs.where("not held_out")).withColumnRenamed("same", "text").collect()
    check(got)
    better = [r.score > r.base_score for r in got if r.n_tokens > 50]
    assert np.mean(better) > 0.9  # classes of words beat single words, on held-out texts too
    assert np.mean([r.score > r.base_score for r in got if r.n_tokens > 50 and r.held_out]) > 0.8


def test_exchange_finds_planted_classes():
    # words 0-9 and 10-19 follow each other in turn
    pairs = np.zeros((21, 21), np.int64)
    rng = np.random.default_rng(1)
    for i in range(10):
        for j in range(10, 20):
            pairs[i, j], pairs[j, i] = rng.integers(1, 9, 2)
    of = lm.exchange(pairs, 20, classes=2)
    assert len(set(of[:10])) == 1 and len(set(of[10:20])) == 1 and of[0] != of[10] and of[20] == 2


def test_columns_of_any_type_stay(spark):
    from panelwright.llm import lm

    docs = spark.sql("SELECT * FROM VALUES (1L, 'a b', map('k', 1)), (2L, 'a c', map('k', 2)), (3L, null, null) AS t(doc_id, text, m)")
    got = {r.doc_id: r.m for r in lm.score(docs, docs).collect()}
    assert got == {1: {"k": 1}, 2: {"k": 2}, 3: None}
