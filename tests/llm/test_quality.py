import re
from collections import Counter

from panelwright.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    eights = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    times, marked = Counter(eights), set()
    for k, x in enumerate(eights):
        if times[x] > 1:
            marked.update(range(k, k + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(marked)


def check(rows):
    for r in rows:
        want = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.kept and r.base_failed)


def test_base_counts_on_odd_rows(spark, odd, clashing, none, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for docs in (odd, clashing, none):
        got = quality.judge(docs, labels).collect()
        assert len(got) == docs.count()
        check(got)


def test_without_labels_nothing_more_goes(spark, odd):
    got = quality.judge(odd, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert all(r.kept != r.base_failed for r in got)


def test_labels_with_nulls_and_repeats(spark, odd):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (6, 1, 0), (6, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.judge(odd, labels).count() == odd.count()


def test_verdicts_follow_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.op2_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good, poor = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(poor) <= 0.3 * len(poor)


def test_repeated_ids_train_once(spark, sf):
    """A table in which one id stands very often gives the model of the table without repeats."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    first = labels.orderBy("doc_id").first().doc_id
    again = docs.unionByName(docs.where(docs.doc_id == first).crossJoin(spark.range(500)).drop("id"))
    assert quality.fit(docs, labels)[1] == quality.fit(again, labels)[1]


def test_all_labelled_documents_fit(spark):
    """More labelled documents than any bound of a sample: all that pass are weighed, and only rows beyond such a bound say that
    shouting is poor."""
    from pyspark.sql import functions as F

    order = spark.range(12_000).withColumnRenamed("id", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    late = [r.doc_id for r in order[-2000:] if r.doc_id % 2]
    text = F.concat_ws(" ", *(F.concat(F.lit(f"w{k}x"), "doc_id") for k in range(30)), F.when(F.col("doc_id").isin(late), "! ! ! ! ! ! ! !"))
    docs = spark.range(12_000).withColumnRenamed("id", "doc_id").withColumn("text", text)
    labels = docs.select("doc_id", F.when(F.col("doc_id").isin(late), 0).otherwise(1).alias("quality"))
    got = quality.judge(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.min(F.col("kept").cast("int")), F.max(F.col("kept").cast("int"))).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 0), (1, 1, 1)]
