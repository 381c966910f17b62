import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import jaccard
from panelwright.llm.common import components


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Links and smallest reachable id of each row, all pairs."""
    sets = [grams(r.text) for r in rows]
    links, up = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
            links[i] += 1
            links[j] += 1
            up[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min((x for x in (low.get(find(i)), r.doc_id) if x is not None), default=None)
    return sorted(((r.doc_id, links[i], low[find(i)]) for i, r in enumerate(rows)), key=repr)


def got(docs):
    classes, members = jaccard.join(docs)
    out = members.join(classes.select("digest", "class_id", "n_links"), "digest", "left").collect()
    return sorted(((r.doc_id, r.n_links or 0, r.doc_id if r.n_links is None else r.class_id) for r in out), key=repr)


def near(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base[:k], f"x{i}", *base[k + 1 :]])) for i, k in enumerate(range(2, 119, 3), start=100)]
    rows += [(300, "only three words"), (301, "only three words"), (302, "only three word"), (303, "a b c d e"), (304, "a b c d e f")]
    return spark.createDataFrame(rows + rows[:3], "doc_id long, text string")


def test_odd_rows(odd, clashing, none):
    want = brute(odd.collect())
    assert got(odd) == want and got(clashing) == want and got(none) == []


@pytest.mark.parametrize("block,grams,dense", [(4, 1000, 1), (4, 1000, 3), (4, 10**6, 10**6), (16, 500, 4), (jaccard.BLOCK, jaccard.GRAMS, jaccard.DENSE)])
def test_near_copies_in_blocks(spark, block, grams, dense, monkeypatch):
    """Whole blocks only, blocks and pairs, pairs only, blocks cut by their n-grams, one block."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "GRAMS", grams)
    monkeypatch.setattr(jaccard, "DENSE", dense)
    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    docs = near(spark)
    assert got(docs) == brute(docs.collect())


def test_large_bucket_of_unlike_texts(spark):
    """One bucket of four groups of like minima, the first text alone: strangers to it still find each other."""
    rng = np.random.default_rng(3)
    kinds = rng.integers(0, 256, (5, 228), np.uint8)
    rows = []
    for node in range(900):
        kind = 4 if node == 0 else node % 4
        minima = np.where(rng.random(228) < 0.1, rng.integers(0, 256, 228, np.uint8), kinds[kind])
        rows.append((node, [7], bytes(minima.astype(np.uint8))))
    texts = spark.createDataFrame(rows, "node long, bands array<long>, minima binary")
    least, held = jaccard.equal_minima(228, 0.8), jaccard._buckets(texts)
    marked = jaccard._mark(held, texts, least)
    found = {r.node: r.root for r in components(jaccard._links(held, marked, texts, least)).collect()}
    assert found == {n: n % 4 or 4 for n in range(1, 900)}
    # what is to be verified holds every pair of a group, and no pair of two
    blocks = texts.select("node", (F.col("node") % 7).alias("block"), F.lit(True).alias("large"))
    rows = jaccard._screened(held, marked, blocks, texts, least).collect()
    single, dense = {(r.a, r.b) for r in rows if r.a >= 0}, {(r.i, r.j) for r in rows if r.a < 0}
    assert all((a - b) % 4 == 0 for a, b in single)
    assert all((a, b) in single or tuple(sorted((a % 7, b % 7))) in dense for a in range(1, 900, 5) for b in range(a + 4, 900, 4))


def test_a_chain_costs_in_proportion_to_its_length(spark, monkeypatch):
    """4,000 texts, each like the next one alone: one component, whose pairs are verified one by one."""
    monkeypatch.setattr(jaccard, "BLOCK", 64)
    n, seen, materialize = 4000, [], jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, *a, **k: seen.append(materialize(df, *a, **k)) or seen[-1])
    docs = spark.range(n).select((F.col("id") * 7919 % n).alias("doc_id"), F.array_join(F.transform(F.sequence(F.col("id") * 3, F.col("id") * 3 + 39), lambda x: F.concat(F.lit("w"), x)), " ").alias("text"))
    place = {i * 7919 % n: i for i in range(n)}
    out = got(docs.repartition(8))
    assert len(out) == n and all(links == (1 if place[i] in (0, n - 1) else 2) and low == 0 for i, links, low in out)
    (marks,) = [d for d in seen if d.columns == ["i", "j", "a", "b"]]
    assert marks.where("a >= 0").select("a", "b").distinct().count() + marks.where("a < 0").count() < 4 * n


def test_families_that_share_half_their_words(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    shared = [f"s{i}" for i in range(60)]
    rows = [(f * 100 + k, " ".join([*shared, *(f"f{f}w{i}" for i in range(60)), f"x{k}"])) for f in range(3) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes, members = jaccard.join(docs, rows=2)
    out = members.join(classes.select("digest", "class_id", "n_links"), "digest").collect()
    assert sorted(((r.doc_id, r.n_links, r.class_id) for r in out), key=repr) == brute(docs.collect())


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(docs) == brute(docs.collect())


def test_bands_reach_the_recall():
    n = jaccard.bands_for(0.8)
    assert 1 - (1 - 0.8**jaccard.ROWS) ** n >= 1 - jaccard.MISS


def test_stage_keeps_one_of_each_class(spark, odd, sf):
    for docs in (odd, spark.read.parquet(f"{sf}/documents.parquet")):
        docs = docs.withColumn("extra", F.lit(1))
        out = jaccard.keep_first(spark, docs, sf)
        assert out.columns == docs.columns
        rows = out.collect()
        want = brute(docs.collect())
        classes = {low for _, _, low in want if low is not None}
        assert {r.doc_id for r in rows if r.doc_id is not None} == classes
        assert len(rows) == len(classes) + len({r.text for r in docs.where("doc_id is null").collect()})
