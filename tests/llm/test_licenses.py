import re

import pyarrow as pa

from panelwright.llm import licenses
from panelwright.llm.licenses import PHRASES, Scanner, SuffixAutomaton


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    return len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))


def check(rows):
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(r.text)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_base_on_odd_rows(odd, clashing, none):
    for docs in (odd, clashing, none):
        got = licenses.scan(docs).collect()
        assert len(got) == docs.count()
        check(got)


def test_base_on_documents(spark, sf):
    check(licenses.scan(spark.read.parquet(f"{sf}/documents.parquet")).collect())


def test_automaton_matches_brute_force():
    import random

    rng = random.Random(3)
    sequences = [[rng.randrange(4) for _ in range(12)] for _ in range(4)]
    automaton = SuffixAutomaton(sequences)
    text = [rng.randrange(5) for _ in range(200)]
    inside = lambda run: any(s[i : i + len(run)] == run for s in sequences for i in range(len(s)))
    longest = [max((n for n in range(i + 2) if n == 0 or inside(text[i + 1 - n : i + 1]))) for i in range(len(text))]
    ends = {end: n for end, n, _ in automaton.runs(text)}
    for end, n in ends.items():
        assert longest[end - 1] == n
    for i, n in enumerate(longest):
        if n and (i + 1 == len(longest) or longest[i + 1] <= n):
            assert ends[i + 1] == n
    for end, n, state in automaton.runs(text):
        for k, at in automaton.ends[state].items():
            assert sequences[k][at - n : at] == text[end - n : end]


def test_template_with_gap_is_one_chain():
    text = "Hello. Permission is hereby granted, free of charge, to any XX YY person obtaining a copy of this software. Bye"
    (row,) = Scanner().scan(pa.array([text.encode()]))
    (span,) = [s for s in row[5] if s[0] == "mit"][-1:]
    assert span[1] == 1 and span[2] == 18 and row[1] == 0


def test_plain_prose_has_no_label():
    (row,) = Scanner().scan(pa.array([b"The work of the day was to get a copy of the book and to use it in any form that the publisher liked."]))
    assert row[5] == []


def test_one_passage_is_one_span():
    """Two gaps in a passage: one span, not one for each part that it begins with."""
    text = "Permission is hereby granted, free of charge, to any XX YY person obtaining a copy of this software and ZZ associated documentation files, to deal in the Software"
    (row,) = Scanner().scan(pa.array([text.encode()]))
    assert [(s[0], s[1], s[2]) for s in row[5]] == [("mit", 0, 27)]


def test_whole_texts_are_templates(spark, tmp_path):
    body = " ".join(f"term{i} of section {i * 7 % 31}" for i in range(200))
    (tmp_path / "Made-1.0").write_text(body)
    (tmp_path / "Made").symlink_to(tmp_path / "Made-1.0")
    templates = licenses.read_templates(str(tmp_path))
    assert templates == [("made-1", body)] and licenses.read_templates(str(tmp_path / "none")) == []
    docs = spark.createDataFrame([(1, "preface " + body + " end"), (2, body[: len(body) // 2]), (3, "term1 of section 7 alone")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, templates).collect()}
    assert got[1].labels == "made-1" and got[1].score == 1.0 and [(s.first_word, s.last_word) for s in got[1].spans] == [(1, 800)]
    assert 0.4 < got[2].score < 0.6 and got[3].labels == ""


def test_notices_are_found_and_prose_gets_no_label(spark):
    """All documents of a table whose notices are known: the method labels those that no base phrase tells, and no others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rows = licenses.scan(docs).collect()
    gpl = [r for r in rows if r.text and "GNU General Public License, version 3." in r.text]
    assert len(gpl) > 50 and sum("gpl" in r.labels.split(",") and not r.base_labels for r in gpl) >= 0.95 * sum(not r.base_labels for r in gpl)
    assert sum("gpl" in r.labels.split(",") for r in gpl) >= 0.95 * len(gpl)
    prose = [r for r in rows if not r.text or "licen" not in r.text.lower()]
    assert len(prose) > 9000 and not any(r.labels or r.score for r in prose)


def test_every_short_notice_is_told_from_the_others():
    """Each notice inside prose gets its own label; a word too many or too few inside it gives none of its own."""
    scanner = Scanner()
    short = [(label, t) for label, t in licenses.TEMPLATES if len(t.split()) < licenses.LEAST_WORDS]
    assert len(short) > 25
    for label, t in short:
        (row,) = scanner.scan(pa.array([f"We say it here {t.upper()}, and so on.".encode()]))
        assert label in {s[0] for s in row[5]} | set(row[4]), t
    rows = scanner.scan(pa.array([x.encode() for x in ("the GNU Lesser General Public License", "a general public license of the state", "GNU very General Public License", "the Public License", "under the old BSD style License")]))
    assert [sorted({s[0] for s in r[5]}) for r in rows] == [["lgpl"], [], [], [], []]


def test_templates_do_not_depend_on_the_machine(spark, monkeypatch):
    monkeypatch.setattr(licenses.Path, "glob", lambda *_: (_ for _ in ()).throw(AssertionError("a folder was read")))
    docs = spark.createDataFrame([(1, "under the GNU General Public License")], "doc_id long, text string")
    assert licenses.scan(docs).first().labels == "gpl"


def test_whole_sequences_are_found_inside_longer_runs():
    import random

    rng = random.Random(1)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randint(1, 6))] for _ in range(5)]
        text = [rng.randrange(4) for _ in range(60)]
        want = sorted((i + len(s), len(s), k) for k, s in enumerate(sequences) for i in range(len(text)) if text[i : i + len(s)] == s)
        assert sorted(SuffixAutomaton(sequences).wholes(text)) == want
