import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelwright.llm import pii
from panelwright.llm.common import held_out
from panelwright.llm.jaccard import join
from panelwright.llm.language import LEAST_SCORE, Labeller, train
from panelwright.llm.quality import judge


def test_stages_against_their_operators(spark, sf):
    """Each stage on its own input: which rows stay, and that nothing else about them changes."""
    import pyarrow as pa

    start = spark.read.parquet(f"{sf}/documents.parquet")
    inputs, docs = [], start
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = corpus_pipeline.materialize(stage(spark, docs, sf))
        if name != "best_fit_packing":
            assert docs.columns == start.columns
    one, two, three, four, five = ({r.doc_id: r for r in d.collect()} for d in inputs)
    labeller = Labeller(train(start.where(~held_out("doc_id", 4, 2))))
    ids = sorted(one)
    said = labeller.label(pa.array([(one[i].text or "").encode() for i in ids]))
    assert set(two) == {i for i, (lang, score, _) in zip(ids, said) if lang != "und" and score >= LEAST_SCORE}
    judged = judge(inputs[1], spark.read.parquet(f"{sf}/labels.parquet")).collect()
    assert set(three) == {r.doc_id for r in judged if r.kept}
    assert all(two[i] == one[i] for i in two) and all(three[i] == two[i] for i in three)
    classes, members = join(inputs[2])
    assert set(four) == {r.class_id for r in classes.collect()} and all(four[i] == three[i] for i in four)
    trees = pii.train(inputs[3])
    assert set(five) == set(four)
    for i, r in five.items():
        assert r.text == pii.redact(four[i].text, pii.find(four[i].text, trees)[1])
        assert r.n_chars == len(r.text) and pii.base_spans(r.text) == []
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = docs.collect()
    length = {}
    for p in pieces:
        length[p.doc_id] = length.get(p.doc_id, 0) + p.length
    assert length == {i: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in five.items()}
    ends = {}
    for p in pieces:
        ends[p.sequence_id] = ends.get(p.sequence_id, 0) + p.length
    assert max(ends.values()) <= 1024


def test_most_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    kept = corpus_pipeline.STAGES[1][1](spark, corpus_pipeline.STAGES[0][1](spark, docs, sf), sf).select("doc_id", F.lit(1).alias("kept"))
    rows = docs.join(labels, "doc_id").join(kept, "doc_id", "left").where("size(split(text, ' ')) >= 40").collect()
    good, poor = [r.kept == 1 for r in rows if r.quality == 1], [r.kept == 1 for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(poor) <= 0.3 * len(poor)


def test_whole_run_and_empty_table(spark, sf, none):
    assert corpus_pipeline.run(spark, sf).count() > 0
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf))
    assert docs.count() == 0


def test_odd_rows_pass_every_stage(spark, odd, clashing, sf):
    for docs in (odd, clashing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert name == "best_fit_packing" or out.columns == docs.columns
            assert out.count() <= docs.count() or name == "best_fit_packing"
