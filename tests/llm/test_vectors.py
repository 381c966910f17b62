import numpy as np
import pytest

from panelwright.llm import vectors
from panelwright.llm.vectors import near


def brute(rows):
    """Links and components by all pairs."""
    x = [None if r.embedding is None or any(c is None or not np.isfinite(c) for c in r.embedding) or not any(r.embedding) else np.array(r.embedding, float) for r in rows]
    n = len(rows)
    links, up = [0] * n, list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.95:
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), r.vec_id), r.vec_id)
    return sorted((r.vec_id, links[i], low[find(i)], r.vec_id == low[find(i)]) for i, r in enumerate(rows))


def got(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near(df).collect())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.1, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [nan, 1.0, 1.0]), (8, [None, 1.0, 1.0]), (9, [inf, 0.0, 0.0]), (10, [0.0, 1.0, 0.0]), (11, [0.0, 1.0, 0.0]), (11, [0.0, 1.0, 0.0]), (12, [1e-300, 0.0, 0.0]), (13, [1e300, 1e299, 0.0]), (14, [-0.0, 1.0, 0.0]), (15, [-1.0, 0.0, 0.0]), (16, [1.0, 0.0]), (17, [1.0, 0.0]), (18, [3.0, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(df.where("vec_id not in (12, 13)").collect())
    assert got(df.where("vec_id not in (12, 13)").selectExpr("*", "1 as node", "2 as leaf", "3 as v")) == want
    scaled = {r[0]: r for r in got(df)}
    assert scaled[12][2] == scaled[13][2] == 1
    assert got(df.limit(0)) == [] and got(df.where("vec_id = 4")) == [(4, 0, 4, True)]


@pytest.mark.parametrize("leaf,block", [(30, 1024), (400, 64)])
def test_recall_against_brute_force(spark, leaf, block, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 16))
    x = np.concatenate([rng.normal(size=(600, 16)), np.repeat(centres, 8, axis=0) + rng.normal(0, 0.05, (480, 16)), centres[:1] + rng.normal(0, 0.02, (150, 16))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute(df.collect())
    out = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near(df, leaf=leaf).collect())
    assert all(o[1] <= w[1] for o, w in zip(out, want))
    assert sum(o[1] for o in out) >= 0.97 * sum(w[1] for w in want)
    if leaf == 400:
        assert np.mean([o == w for o, w in zip(out, want)]) > 0.97


def test_embeddings(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    want, out = brute(df.collect()), got(df)
    assert sum(o[1] for o in out) >= 0.95 * sum(w[1] for w in want)
    assert np.mean([o == w for o, w in zip(out, want)]) > 0.97


def test_links_inside_a_large_group_of_near_copies():
    rng = np.random.default_rng(4)
    n, group = 80_000, 27_000
    noise = rng.normal(0, 1, (group, 64)) * rng.uniform(0.0025, 0.0215, (group, 1))  # cosines of 0.97 and more to one another
    centre = vectors._units(rng.normal(size=(1, 64)))
    x = vectors._units(np.concatenate([centre + noise, rng.normal(size=(n - group, 64))]))
    forest = vectors.Forest(x[rng.choice(n, vectors.SAMPLE, replace=False)], 8)
    some = rng.choice(group, (20_000, 2))
    some = some[some[:, 0] != some[:, 1]]
    assert (np.einsum("ij,ij->i", x[some[:, 0]], x[some[:, 1]]) >= 0.95).all()
    row, tree, leaf = forest.leaves(x)
    own = [set() for _ in range(n)]
    for r, t, node in zip(row.tolist(), tree.tolist(), leaf.tolist()):
        own[r].add((t, node))
    assert np.mean([not own[a].isdisjoint(own[b]) for a, b in some.tolist()]) >= 0.9
    assert len(row) <= 6 * 4 * n
