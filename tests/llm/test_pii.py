import hashlib
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from panelwright.llm import pii

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split(".")) or kind == 2 and 16 <= len(digits) <= 19 and pii.luhn(digits) or kind == 3 and 8 <= len(digits) <= 15:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aB7 0.@-+()%é\n15"), max_size=60))
def test_base_spans_are_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_of_planted_lines():
    text = "mail a.b+c@x-y.co.uk, @no.pe, z@q; 10.0.0.255 and 256.1.1.1 1.2.3.4.5; 4111 1111 1111 1111 or 4111111111111112 +1 (212) 555-0100 +12 é@é.fr a@b.c@d.e"
    assert pii.base_spans(text) == plain(text)
    assert [k for k, _, _ in pii.base_spans(text)].count(2) == 1
    assert pii.base_spans("0" * 6000 + ".1.2.3") == [(1, 0, 6006)] and pii.base_spans("9" * 6000 + ".1.2.3") == []


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 50_000, "+1(" * 50_000, "1.1" * 60_000, "1 " * 100_000, "@a.b" * 40_000):
        pii.find(text, None)
        pii.candidates(text)


def check(rows):
    for r in rows:
        base = plain(r.text or "")
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in range(4)]
        every = r.spans.split(",") if r.spans else []
        assert set(pii.joined(base).split(",")) - {""} <= set(every)
        found = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in every)]
        assert found == sorted(found)


def test_odd_rows_and_documents(spark, odd, clashing, none, sf):
    trees = pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert trees is not None and min(trees.thresholds) < 1
    for docs in (odd, clashing, none, spark.read.parquet(f"{sf}/documents.parquet")):
        out = pii.scan(docs, trees)
        rows = out.collect()
        assert len(rows) == docs.count() and set(docs.columns) <= set(out.columns)
        check(rows)
    assert pii.train(none) is None and pii.train(odd) is None


def test_trees_add_what_the_patterns_miss_and_leave_the_rest(spark):
    trees = pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    two = "au 4539578763621486 4485275742308327 la"  # 32 digits in one run: no plain card
    assert plain(two) == []
    assert pii.joined(pii.find(two, trees)[1]) == "card:3:19,card:20:36"
    for text in ("+33 1 23 45 67 89 4111 1111 1111 1111", "+1 (212) 555-0100 4111-1111-1111-1111"):
        assert pii.joined(pii.find(text, trees)[1]) == "card:18:37,phone:0:17"
    for clean in ("on 2024-01-02 12 30 45", "In 1999 we sold 250 of 3000 units for 4.50 each.", "Version 2.0 of 2021-03-04", "9807915762804491 is no card", "row 1234567 of 7654321"):
        assert pii.find(clean, trees)[1] == plain(clean)


def test_made_numbers_are_what_they_say():
    for seed in (0, 1, 2, 12345, 10**15 + 7):
        assert [k for k, _, _ in plain(pii.made_card(seed))] == [2]
        assert [k for k, _, _ in plain(pii.made_phone(seed))][-1] == 3
    text = "call +1 (212) 555-0100 or 4111 1111 1111 1111 now"
    for made, right in pii.crowded(text, pii.base_spans(text), 5):
        assert right <= set(pii.candidates(made))


def test_redaction():
    assert pii.redact("x a@b.cc y 1.2.3.4", [(0, 2, 8), (1, 11, 18)]) == "x [EMAIL] y [IP]"
    assert pii.redact("12345", [(2, 0, 4), (3, 2, 5)]) == "[CARD]"


def test_stage_keeps_rows_and_columns(spark, odd, clashing, sf):
    for docs in (odd, clashing):
        out = pii.mask(spark, docs, sf)
        assert out.columns == docs.columns and out.count() == docs.count()
        assert not any("@example.com" in (r.text or "") for r in out.collect())


def test_numbers_of_many_groups_are_proposed_whole():
    text = "+33 1 23 45 67 89 4111 1111 1111 1111"
    assert {(3, 0, 17), (2, 18, 37)} <= set(pii.candidates(text))
    card = "41 11 11 11 11 11 11 11"
    assert (2, 9, 9 + len(card)) in pii.candidates(f"12345678 {card} 99")
    assert (3, 0, 13) in pii.candidates("+33 1 - 23 45 67 89"[:13] + " 4111 1111")  # groups without digits are passed over


def test_a_hot_text_leaves_the_training_as_it_is(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    hot = spark.range(20_000).selectExpr("concat('ref 1234567 of 7654321', '') as text")
    one, other = pii.train(docs), pii.train(docs.unionByName(hot.limit(300)))
    assert one is not None and other is not None
    assert pii.train(docs.unionByName(docs)).trees == one.trees


def test_long_addresses_are_proposed_whole():
    local, host = "x" * 300, ".".join(["y" * 30] * 8)
    text = f"see {local} (at) {host}, or {local}@{host}."
    got = [text[a:b] for k, a, b in pii.candidates(text) if k == 0]
    assert got == [f"{local} (at) {host}", f"{local}@{host}"]


def test_spans_are_brute_force(spark, sf):
    """Base spans, then the likeliest candidates that overlap nothing taken, weighed one by one and tried against all."""
    trees = pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))

    def chance(x):
        margin = 0.0
        for weight, tree in zip(trees.weights, trees.trees):
            f, v, left, right = tree[0]
            while f >= 0:
                f, v, left, right = tree[left if x[f] <= v else right]
            margin += weight * v
        return 1 / (1 + math.exp(-2 * margin))

    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    digits = "4539578763621486 4485275742308327 +33 1 23 45 67 89 4111-1111-1111-1111 10.0.0.1 a (at) b.cc +1 (212) 555-0100 "
    texts += [digits, digits * 60, "au 4539578763621486 4485275742308327 la", "+1 212 555 0100 " * 90]
    added = 0
    for text in texts:
        taken = plain(text)
        weighed = [(-chance(pii.features(text, *c)), c) for c in pii.candidates(text) if not any(c[1] < b and a < c[2] for _, a, b in taken)]
        more = []
        for p, c in sorted(weighed):
            if trees.thresholds[c[0]] < 1 and -p >= trees.thresholds[c[0]] and not any(c[1] < b and a < c[2] for _, a, b in more):
                more.append(c)
        assert pii.find(text, trees) == (taken, sorted([*taken, *more]))
        added += len(more)
    assert added


def test_all_candidates_train(spark, monkeypatch):
    """More texts and candidates than any bound of a sample: the weights that the trees get add up to every candidate of that half."""
    from pyspark.sql import functions as F

    docs = spark.range(30_000).selectExpr("concat('row ', 1000000 + id, ' of 3') as text").unionByName(spark.range(60).selectExpr("concat('call +33 1 23 45 67 ', 10 + id) as text"))
    seen = []

    class Fits(pii.GBTClassifier):
        def fit(self, data):
            seen.append(data.agg(F.sum("w") if "w" in data.columns else F.count("*")).first()[0])
            return super().fit(data)

    monkeypatch.setattr(pii, "GBTClassifier", Fits)
    assert pii.train(docs) is not None
    half = docs.withColumn("d", F.xxhash64("text")).where(F.pmod(F.xxhash64("d", F.lit(1)), F.lit(2)) == 0).collect()
    made = [t for r in half for t, _ in pii.crowded(r.text, pii.base_spans(r.text), r.d & 0xFFFFFFFFFFFF)]
    assert seen == [sum(len(pii.candidates(t)) for t in [*(r.text for r in half), *made])]
