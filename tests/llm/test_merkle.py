import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from panelwright.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Levels from the nodes up to one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    """(others of the run, whether they come first) level by level."""
    out = []
    for nodes in levels[:-1]:
        j = i ^ 1
        out.append((nodes[j] if j < len(nodes) else "", j < i))
        i //= 2
    return out


def brute(docs):
    """Rows of the query by sorting and whole trees in memory."""
    groups = {}
    for d in docs:
        leaf = h(*map(field, (d.doc_id, d.source, d.lang, d.n_chars, d.text)))
        tampered = leaf
        if d.doc_id is not None and zlib.crc32(str(d.doc_id).encode()) % 7 == 0 and d.n_chars is not None:
            tampered = h(*map(field, (d.doc_id, d.source, d.lang, d.n_chars + 1, d.text)))
        groups.setdefault(d.lang, []).append((d.doc_id, leaf, tampered))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = tree([r[1] for r in groups[lang]])
    top = tree([trees[lang][-1][0] for lang in langs])
    rows = []
    for g, lang in enumerate(langs):
        for i, (doc_id, leaf, tampered) in enumerate(groups[lang]):
            proof = path(trees[lang], i) + path(top, g)
            folded = tampered
            for other, first in proof:
                folded = h(other, folded) if first else h(folded, other)
            rows.append((doc_id, leaf, trees[lang][-1][0], top[-1][0], h(*(o for o, _ in proof)), folded, folded == top[-1][0]))
    return rows


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def run(spark, docs, folder):
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    out = merkle.op12_merkle_manifest(spark, str(folder))
    return sorted(map(tuple, out.select(*COLUMNS).collect()), key=str)


def test_odd_rows(spark, odd, clashing, none, tmp_path):
    """Null ids, a null lang, repeated rows, one id with several texts, empty and long texts, no rows at all."""
    again = odd.unionByName(odd.where("doc_id = 9").withColumn("text", F.lit("other"))).unionByName(odd.where("doc_id is null")).unionByName(odd.where("doc_id is null").withColumn("text", F.lit("x")))
    for k, docs in enumerate((odd, again, none, odd.where("doc_id = 3"), odd.where("lang = 'fr'"))):
        assert run(spark, docs, tmp_path / str(k)) == sorted(brute(docs.collect()), key=str)
    made = merkle.manifest(clashing.withColumns({"tree": F.lit("kept?"), "leaf": F.lit("gone"), "index": F.lit(1), "body": F.lit(2)}))
    assert {"extra", "kept", "tree", "index", "body"} <= set(made.columns) and "text" not in made.columns
    assert made.where("tree = 'kept?' AND leaf <> 'gone' AND extra = 'kept?'").count() == odd.count()


@pytest.mark.parametrize("ids", ["id", "id * 5000 - 7000000", "xxhash64(id)", "id * 32768", "9223372036854775807 - id"])
def test_spread_of_ids(spark, tmp_path, ids):
    """Dense, sparse, hashed and extreme ids; groups of one, of some and of more rows than a slot array holds."""
    lang = "CASE WHEN id % 3000 = 0 THEN NULL WHEN id % 1500 = 1 THEN concat('l', id) WHEN id % 10 < 3 THEN 'é' ELSE 'en' END"
    docs = spark.range(4000).select(F.expr(ids).alias("doc_id"), F.expr(lang).alias("lang"), F.lit("s").alias("source"), F.expr("if(id % 4 = 0, null, id)").alias("n_chars"), F.expr("repeat('x', cast(id % 7 as int))").alias("text"))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(merkle, "WIDE", 16)
        m.setattr(merkle, "LEVELS", 4)
        assert run(spark, docs, tmp_path) == sorted(brute(docs.collect()), key=str)


def test_query_against_brute_force_and_sql(spark, sf):
    got = sorted(map(tuple, merkle.op12_merkle_manifest(spark, sf).select(*COLUMNS).collect()), key=str)
    assert got == sorted(brute(spark.read.parquet(f"{sf}/documents.parquet").collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({merkle.OP12_SQL})").fetchall(), key=str)


def test_proofs_fold_and_tell_tampering(spark, sf):
    made = merkle.manifest(spark.read.parquet(f"{sf}/documents.parquet"))
    folded = made.select(merkle.fold(F.col("leaf"), F.col("proof")).alias("a"), merkle.fold(F.sha2("leaf", 256), F.col("proof")).alias("b"), "root", "subroot")
    assert folded.where("a <> root OR b = root").isEmpty() and made.select("root").distinct().count() == 1
