"""Given and expected rows for operators whose edge cases the driver's tables don't show."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelwright.functions import clean
from panelwright.operators import aggregate, checks, domain, metrics, stats, window
from panelwright.sources import files


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression(F.col("c")).alias("x")).first().x


@pytest.mark.parametrize("text,want", [("P59D", 59.0), ("P1.5D", 1.5), ("PT5H", None), ("59", None), (None, None)])
def test_iso_duration(spark, text, want):
    assert one(spark, clean.iso_duration_days, text) == want


@pytest.mark.parametrize("text,want", [("1,23,456.5", 123456.5), (" 12 ", 12.0), ("about ten", None), ("", None)])
def test_number_from_text(spark, text, want):
    assert one(spark, clean.number_from_text, text) == want


@pytest.mark.parametrize("text,want", [("NA", True), (" n.a. ", True), ("--", True), ("Nil", False), ("none", False), ("", False), (None, False)])
def test_na_text(spark, text, want):
    assert one(spark, clean.is_na_text, text) is want


@pytest.mark.parametrize("day,want", [(dt.date(2026, 3, 31), "FY2025-26"), (dt.date(2026, 4, 1), "FY2026-27"), (dt.date(1999, 4, 1), "FY1999-00")])
def test_fiscal_year(spark, day, want):
    assert one(spark, clean.fiscal_year_label, day, "date") == want


@pytest.mark.parametrize("value,want", [(0.888, 0.888), (0.0, 0.0), (None, None), (0.1 + 0.2, 0.3)])
def test_round_sig(spark, value, want):
    assert one(spark, clean.round_sig, value, "double") == want


def test_snippet_masks_links(spark):
    text = "a " * 100 + "see http://x.y/z the revised figure " + "b " * 200
    got = one(spark, lambda c: clean.keyword_snippet(c, "revised|restated"), text)
    assert "[link]" in got and "revised" in got and len(got) <= 300
    assert one(spark, lambda c: clean.keyword_snippet(c, "restated"), text) is None


def test_snippets_are_those_of_the_sql(spark):
    """Two words near the start, characters beyond 16 bits, letters that fold, letters and white space that only Java knows."""
    import duckdb

    from panelwright.plans import catalogue

    texts = ["a license, and so on; the token " + "b " * 150, "x " * 70 + "Licensed " + "y " * 40 + "token " + "z " * 150, "\U0001f600" * 200 + " token " + "\U0001f600" * 200, "a to\u212aen", "licen\u017fe", "l\u0131cense", "\u00e9license\u00e9 c", "token_ tokens", "license http://a\x0bb http://c\xa0d", "xlicense" + "a" * 112 + " token", "license" * 18 + " license " + "n" * 300, "\ntoken\n" * 60, "", None]
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = dict(con.execute(catalogue.oracle_sql()["b25_keyword_snippet"]).fetchall())
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", clean.keyword_snippet(F.col("text"), "license|licensed|token").alias("snippet"))
    assert {r.doc_id: r.snippet for r in df.where("snippet is not null").collect()} == want


def test_reweighted_mean_needs_two_parts(spark):
    df = spark.createDataFrame([(1.0, 0.5, None), (1.0, None, None), (None, None, None)], "a double, b double, c double")
    got = [r.x for r in df.select(clean.reweighted_mean([F.col(c) for c in "abc"], [0.5, 0.3, 0.2]).alias("x")).collect()]
    assert got == [pytest.approx(0.8125), None, None]


def test_infer_scale(spark):
    rows = [("a", 1, 1.28e11), ("a", 2, 1.4e11), ("a", 3, 14700.05), ("b", 1, 5.0), ("c", 1, 2e10), ("c", 2, 0.0), ("c", 3, None)]
    got = {(r.e, r.p): r for r in domain.infer_scale(spark.createDataFrame(rows, "e string, p int, v double"), "e", "p", "v").collect()}
    assert got["a", 3].scale == 1e7 and got["a", 3].corrected == pytest.approx(147000500000) and got["a", 3].confidence == "high"
    assert got["b", 1].scale is None and got["b", 1].corrected == 5.0 and got["a", 1].scale is None and got["c", 2].scale is None


def test_period_roles(spark):
    d = dt.date
    main = (d(2024, 4, 1), d(2025, 3, 31))
    rows = [(1, *main, None, *main), (2, d(2023, 4, 1), d(2024, 3, 31), None, *main), (3, d(2022, 4, 1), d(2023, 3, 31), None, *main), (4, None, None, d(2025, 3, 31), *main), (5, None, None, d(2024, 3, 31), *main), (6, None, None, d(2020, 1, 1), *main)]
    got = domain.assign_period_role(spark.createDataFrame(rows, "i int, s date, e date, t date, ms date, me date"), "s", "e", "t", "ms", "me").orderBy("i").collect()
    assert [r.period_role for r in got] == ["CY", "PY", "PY2", "INSTANT_CY", "INSTANT_PY", "OTHER"]


def test_scores(spark):
    parts = {"a": 0.3, "b": 0.3, "c": 0.2, "d": 0.2}
    rows = [(1, "g", 1.0, 1.0, 1.0, 1.0), (2, "g", 1.0, 1.0, 1.0, 0.0), (3, "g", 1.0, 1.0, None, 0.0), (4, "g", 1.0, None, None, None), (5, "g", 0.5, 0.5, 0.5, 0.5), (6, "g", 0.6, 0.6, 0.6, 0.6)]
    got = {r.i: r for r in domain.quality_score(spark.createDataFrame(rows, "i int, g string, a double, b double, c double, d double"), ["i"], ["g"], parts).collect()}
    assert got[1].score == pytest.approx(100) and got[1].grade == "A" and got[1].reasons is None and got[1].place == 1
    assert got[2].score == pytest.approx(80) and got[2].grade == "B" and got[2].reasons == "d"
    assert got[3].score == pytest.approx(75) and got[4].score is None and got[4].grade == "insufficient_data" and got[4].place is None
    assert got[5].reasons == "a|b|c"


def test_restatement_classes(spark):
    rows = [(100.0, 100.0), (100.0, 100.5), (100.0, 104.0), (100.0, 130.0), (100.0, 300.0), (100.0, 1e6), (0.0, 5.0), (None, 5.0), (5.0, None), (None, None)]
    df = spark.createDataFrame(rows, "o double, r double")
    got = df.withColumns(domain.classify_restatement(F.col("o"), F.col("r"), F.lit(False))).collect()
    assert [r.classification for r in got] == ["no change", "rounding", "small", "material", "large", "scale error", "from zero", "added later", "withdrawn", "no value"]
    assert [r.flatters for r in got][-3:] == [None, None, None]


def test_small_groups_hide_statistics_only(spark):
    df = spark.createDataFrame([("a", 4, 0.5), ("b", 5, 0.5)], "g string, n int, s double")
    assert [tuple(r) for r in aggregate.suppress_small_groups(df, ["s"], "n").orderBy("g").collect()] == [("a", 4, None, "fewer than 5"), ("b", 5, 0.5, None)]


def test_scd2_and_its_checks(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (1, 3, None), (1, 4, None), (1, 5, "x")], "k int, t int, a string")
    h = window.scd2_from_runs(df, ["k"], ["t"], ["a"])
    assert [(r.a, r.valid_from, r.valid_to, r.is_current) for r in h.orderBy("version").collect()] == [("x", 1, 3, False), (None, 3, 5, False), ("x", 5, None, True)]
    assert checks.scd2_no_overlap(h, ["k"]).isEmpty() and checks.scd2_one_current(h, ["k"]).isEmpty()


def test_specs_are_checked():
    spec = metrics.MetricSpec
    metrics.validate_specs([spec("n", "count"), spec("s", "average", column="x", is_score=True, gate="n")])
    for bad in ([spec("r", "average", column="x", is_ratio=True)], [spec("Bad", "count")], [spec("r", "ratio_of_sums", numerator="a")], [spec("m", "median", column="x", gate="none")], [spec("m", "median")], [spec("n", "count"), spec("n", "count")]):
        with pytest.raises(ValueError):
            metrics.validate_specs(bad)


def test_exact_tests():
    assert stats.binomial_exact(5, 10) == pytest.approx(1.0) and stats.binomial_exact(0, 10) == pytest.approx(2 / 1024)
    assert stats.fisher_exact(3, 1, 1, 3) == pytest.approx(0.4857142857)


def test_signed_ranks_are_brute_force(spark):
    import itertools
    import random

    rng = random.Random(6)
    groups = {1: [1, 2, 3, 4, 5], 2: [0, 0], 3: [1, -1], 4: [float(i) for i in range(1, 40)], 5: [rng.choice([-3, -2, -1, 0, 1, 2, 3, 4]) for _ in range(13)], 6: [2, 2, 2, -2, 5], 7: [(-1) ** i * (i % 9 + 1) for i in range(60)]}
    df = spark.createDataFrame([(g, float(v)) for g, own in groups.items() for v in own] + [(8, None)], "g int, x double")
    got = {r.g: r for r in stats.wilcoxon_signed_rank(df, "x", ["g"]).collect()}
    assert set(got) == set(groups)
    assert got[1].p == pytest.approx(2 / 32) and got[2].p is None and got[2].n == 0 and got[3].p == 1.0 and 0 < got[4].p < 1e-6 and got[7].p > 0.5
    for g in (1, 5, 6):
        x = [v for v in groups[g] if v]
        rank = [sum(abs(a) < abs(b) for a in x) + (sum(abs(a) == abs(b) for a in x) + 1) / 2 for b in x]
        plus = sum(r for r, v in zip(rank, x) if v > 0)
        low = min(plus, sum(rank) - plus)
        ways = sum(sum(r for r, s in zip(rank, signs) if s) <= low for signs in itertools.product((0, 1), repeat=len(x)))
        assert got[g].n == len(x) and got[g].p == pytest.approx(min(1.0, 2 * ways / 2 ** len(x)))


def test_adjusted_p_is_brute_force(spark):
    import random

    rng = random.Random(2)
    p = [rng.choice([0.0, 1.0, 0.5, 0.013, rng.random(), rng.random() ** 9]) for _ in range(400)] + [None]
    df = spark.createDataFrame(list(enumerate(p)), "i int, p double").repartition(5)
    got = {r.i: r.adjusted_p for r in stats.benjamini_hochberg(df, "p").collect()}
    there = [v for v in p if v is not None]
    raw = {v: v * len(there) / (sum(w < v for w in there) + 1) for v in there}
    assert got[400] is None and len(got) == 401
    for i, v in enumerate(p[:400]):
        assert got[i] == pytest.approx(min(1.0, min(raw[w] for w in raw if w >= v)))


def test_keys_move_between_partitions_and_interrupted_runs_are_made_good(spark, tmp_path):
    from panelwright.sources import files

    path, schema = str(tmp_path / "t"), "k int, v string, part string"
    rows = lambda: sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect())
    make = lambda *r: spark.createDataFrame(list(r), schema)
    files.replace_keys(spark, path, make((1, "old", "a"), (2, "old", "b")), "k", "part")
    files.replace_keys(spark, path, make((1, "new", "b")), "k", "part")
    assert rows() == [(1, "new", "b"), (2, "old", "b")] and not (tmp_path / "t" / "part=a").exists() and not (tmp_path / "t-next").exists()
    # a whole stage that was left behind
    make((2, "late", "c"), (1, "new", "b")).write.partitionBy("part").parquet(path + "-next/rows")
    spark.createDataFrame([("b",), ("c",)], "part string").write.parquet(path + "-next/touched")
    files.replace_keys(spark, path, make((3, "x", "c")), "k", "part")
    assert rows() == [(1, "new", "b"), (2, "late", "c"), (3, "x", "c")]


def test_row_ids_tell_nulls_apart(spark):
    from panelwright.functions import clean

    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "b", None)], "x string, y string, z string")
    assert df.select(clean.stable_row_id("x", "y", "z").alias("i")).distinct().count() == 2


def test_instances(spark):
    from panelwright.sources.instances import parse_instances

    good = '<x:xbrl xmlns:x="http://www.xbrl.org/2003/instance" xmlns:l="http://www.xbrl.org/2003/linkbase" xmlns:k="http://www.w3.org/1999/xlink" xmlns:i="urn:i">{}</x:xbrl>'
    ref = '<l:schemaRef k:href="a.xsd"/>'
    files = {
        "ok": ref + '<x:context id="c"><x:period><x:forever/></x:period></x:context><i:A contextRef="c">1</i:A><i:A contextRef="c">1</i:A>', "tuple": ref + "<i:T><i:A/></i:T>", "period": ref + '<x:context id="c"/>', "none": "<i:A>1</i:A>",
    }
    rows = [(k, bytearray(good.format(v).encode())) for k, v in files.items()] + [("root", bytearray(b"<a/>")), ("null", None), ("bom", bytearray("\ufeff".encode() + good.format(ref + "<i:A>2</i:A>").encode()))]
    got = parse_instances(spark.createDataFrame(rows, "filing_id string, content binary"))
    assert {r.filing_id for r in got["errors"].collect()} == {"tuple", "period", "none", "root", "null"}
    facts = got["facts"].collect()
    assert sorted((r.filing_id, r.raw_value) for r in facts) == [("bom", "2"), ("ok", "1"), ("ok", "1")] and len({r.fact_id for r in facts}) == 3
    assert [(r.period_type, r.dimension_key) for r in got["contexts"].collect()] == [("forever", "")]


def test_cliffs_delta_equals_pairs(spark):
    rows = [("s", v, b) for v, b in ((1.0, True), (2.0, True), (2.0, False), (0.0, False), (3.0, True))]
    got = stats.cliffs_delta(spark.createDataFrame(rows, "s string, v double, l boolean"), "v", "l", ["s"]).first()
    pairs = [(a > b) - (a < b) for _, a, x in rows for _, b, y in rows if x and not y]
    assert got.delta == pytest.approx(sum(pairs) / len(pairs))


def test_replace_keys_twice_gives_the_same(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, p string, v int").select("k", "v", "p")
    new = spark.createDataFrame([(1, "a", 2)], "k int, p string, v int").select("k", "v", "p")
    files.replace_keys(spark, str(tmp_path / "t"), old, "k", "p")
    for _ in range(2):
        assert sorted(map(tuple, files.replace_keys(spark, str(tmp_path / "t"), new, "k", "p").collect())) == [(1, 2, "a"), (2, 1, "b")]


def test_reconcile_and_guard(spark):
    a, b = spark.createDataFrame([(1, 1.0), (2, 2.0), (4, None)], "k int, v double"), spark.createDataFrame([(1, 1.0), (2, 2.5), (3, 1.0), (4, None)], "k int, v double")
    assert sorted((r.k, r.problem) for r in checks.reconcile(a, b, ["k"], "v").collect()) == [(2, "differs"), (3, "right only")]
    extra, small = checks.publication_guard(spark.createDataFrame([(3, 0.1), (9, 0.2)], "n int, s double"), ["n"], ["s"], "n")
    assert extra == ["s"] and small.count() == 1


def test_no_import_of_the_llm_folder():
    import pathlib
    import re

    root = pathlib.Path(__file__).parent.parent / "panelwright"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"^\s*(from|import)\b.*\bllm\b", path.read_text(), re.M), path


def test_panels_are_made_anew_when_a_table_is_written_in_place(spark, tmp_path):
    """Same file names, other contents: the panel that is kept from before is not read again."""
    import shutil

    import pyarrow.parquet as pq

    from panelwright.plans import bindings

    for t in ("lineitem", "supplier", "nation", "region"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    count = lambda: bindings.supplier_year(spark, str(tmp_path)).agg(F.sum("n_lines")).first()[0]
    before, made = count(), len(bindings._stored)
    assert count() == before and len(bindings._stored) == made
    lines = pq.read_table("/root/testdata/sf0.001/lineitem.parquet")
    (tmp_path / "lineitem.parquet").unlink()
    pq.write_table(lines.slice(0, lines.num_rows // 2), tmp_path / "lineitem.parquet")
    assert 0 < count() < before and len(bindings._stored) == made + 1


def test_catalogues_are_held_against_their_table(spark):
    spec = metrics.MetricSpec
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    got = {r.name: (r.problem, r.n_rows) for r in metrics.check_catalogue(df, [spec("r", "ratio_of_sums", numerator="a", denominator="b"), spec("m", "median", column="z"), spec("n", "count")]).collect()}
    assert got == {"r": (None, 1), "m": ("m: no columns ['z']", 0), "n": (None, 2)}


def test_inverse_changes_tie_as_in_the_sql(spark):
    """ln(b / a) and ln(a / b) differ in the last digit or not, by the library's logarithm; ranks and ties follow it."""
    import duckdb

    from panelwright.plans import catalogue
    from panelwright.plans.bindings import SUPPLIER_YEAR

    pairs = [(float(a), float(b)) for a in range(1, 41) for b in range(1, 41)]
    rows = [(e, f"s{e % 2}", year, v) for e, pair in enumerate(pairs) for year, v in zip((1996, 2000), pair)]
    con = duckdb.connect()
    con.execute("CREATE TABLE panel (entity BIGINT, sector VARCHAR, period INTEGER, emissions DOUBLE)")
    con.executemany("INSERT INTO panel VALUES (?, ?, ?, ?)", rows)
    want = con.execute("WITH p AS (SELECT * FROM panel)" + catalogue.oracle_sql()["s07_wilcoxon_signed_rank"].removeprefix(SUPPLIER_YEAR)).fetchall()
    df = spark.createDataFrame(rows, "entity long, sector string, period int, emissions double").repartition(3)
    got = stats.wilcoxon_signed_rank(stats.pair_changes(df, ["entity", "sector"], "period", "emissions", 1996, 2000), "log_change", ["sector"])
    assert sorted((r.sector, r.n, r.plus, r.ties, round(r.z, 6)) for r in got.collect()) == sorted(want)
