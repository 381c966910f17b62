import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from panelwright.llm import language
from panelwright.llm.language import Labeller, _learn, identify, op5_language_id


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op5_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").where("held_out").collect()
    right = [r.lang_pred == r.lang for r in got if len(r.text) > 100]
    assert np.mean(right) > 0.97


def test_odd_rows(spark, odd, clashing, none, sf):
    model = _learn(spark.read.parquet(f"{sf}/documents.parquet"))
    for docs in (odd, clashing, none):
        out = identify(docs, model)
        rows = out.collect()
        assert len(rows) == docs.count() and set(docs.columns) <= set(out.columns)
        for r in rows:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
            assert r.lang_pred in (*model["langs"], "und") and 0 <= r.score <= 1
    nothing = _learn(none)
    assert {r.lang_pred for r in identify(odd, nothing).collect()} == {"und"}


def test_mixed_text_is_split_and_path_is_best(spark, sf, sf_docs):
    labeller = Labeller(_learn(spark.read.parquet(f"{sf}/documents.parquet")))
    one = {lang: " ".join(sf_docs[(sf_docs.lang == lang) & (sf_docs.n_chars > 500)].text.iloc[0].split()[:60]) for lang in ("en", "de")}
    ((_, _, spans),) = labeller.label(pa.array([f"{one['en']} {one['de']}".encode()]))
    assert [s[0] for s in spans] == ["en", "de"] and abs(spans[0][2] - 59) <= 3

    rng = np.random.default_rng(5)
    labeller.langs = ["a", "b", "c"]
    for _ in range(60):
        score = rng.normal(0, 12, (7, 3))
        worth = lambda p: score[np.arange(7), p].sum() - language.SWITCH * (np.diff(p) != 0).sum()
        best = max(worth(np.array(p)) for p in np.ndindex(*[3] * 7))
        assert abs(worth(labeller.path(score)) - best) < 1e-9


def test_scripts_narrow_the_candidates():
    model = {"langs": ["el", "en"], "grams": {}, "table": np.log([[0.1, 0.1]]), "scripts": {"Latin": np.array([False, True]), "Greek": np.array([True, False])}}
    got = Labeller(model).label(pa.array(["κόσμε καλημέρα".encode(), b"hello", "日本".encode(), b"12 !"]))
    assert [g[0] for g in got[:2]] == ["el", "en"] and got[3][0] == "und" and got[2][0] in ("el", "en")


def test_long_text_without_ascii_spaces_is_labelled_throughout(spark, sf, sf_docs):
    labeller = Labeller(_learn(spark.read.parquet(f"{sf}/documents.parquet")))
    one = {lang: " ".join(" ".join(sf_docs[(sf_docs.lang == lang) & (sf_docs.n_chars > 500)].text).split()[:200]) for lang in ("en", "de")}
    letters = {lang: sum(map(str.isalpha, text)) for lang, text in one.items()}
    for space in (" ", "　", ""):
        before = len(labeller.known)
        en, de = (one[lang].replace(" ", space) for lang in ("en", "de"))
        ((lang, score, spans),) = labeller.label(pa.array([f"{en}{space}{de}".encode()]))
        assert [s for s in spans] == [("en", 0, 0), ("de", 0, 0)] and len(labeller.known) == before
        assert lang == max(letters, key=letters.get) and abs(score - max(letters.values()) / sum(letters.values())) < 0.05
        # a short word in front, the middle of the run in another language than both ends
        ((lang, score, spans),) = labeller.label(pa.array([f"the {en}{space}{de}{space}{de}{space}{en} and the end".encode()]))
        assert [s[0] for s in spans] == ["en", "de", "en"] and spans[0][1:] == (0, 1) and spans[1][1:] == (1, 1) and spans[2][1:] == (1, 4) and score < 0.7


def test_pieces_end_at_changes_of_script():
    assert language.pieces("a" * 30 + "日の本") == [(0, 20), (20, 30), (30, 33)]
    model = {"langs": ["el", "en"], "grams": {}, "table": np.log([[0.1, 0.1]]), "scripts": {"Latin": np.array([False, True]), "Greek": np.array([True, False])}}
    ((lang, score, spans),) = Labeller(model).label(pa.array([("κ" * 100 + "x" * 300 + "κ" * 50).encode()]))
    assert (lang, score, [s[0] for s in spans]) == ("en", 300 / 450, ["el", "en", "el"])


def test_whole_query_is_brute_force(spark, sf, sf_docs):
    """Counts, script shares and the best path worked out word by word, for every document."""
    split = lambda text: re.findall(r"[^\x20\x09-\x0D]+", text)
    learned = [(r.lang, r.text) for r in sf_docs.itertuples() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text is not None]
    langs = sorted({lang for lang, _ in learned})
    counts, scripts = {lang: Counter() for lang in langs}, {lang: Counter() for lang in langs}
    low = lambda w: "".join(c for c in w.lower() if c.isalpha())
    three = lambda w: [f" {w} "[i : i + 3] for i in range(len(w))]
    for lang, text in learned:
        for w in split(text):
            assert len(low(w)) <= language.LONGEST  # longer ones have tests of their own
            counts[lang].update(three(low(w)))
            scripts[lang].update(map(language.script_of, low(w)))
    seen = set().union(*counts.values())
    total = {lang: sum(counts[lang].values()) + language.ALPHA * (len(seen) + 1) for lang in langs}
    every = sum(scripts.values(), Counter())
    own = {s: [scripts[lang][s] >= language.SCRIPT_SHARE * max(1, sum(scripts[lang].values())) for lang in langs] for s in every}
    got = {r.doc_id: r for r in op5_language_id(spark, sf).collect()}
    assert len(got) == len(sf_docs)
    for r in sf_docs.itertuples():
        words = split(r.text or "")
        letters = [len(low(w)) for w in words]
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not sum(letters):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        value, back = np.zeros(len(langs)), []
        for w in words:
            score = np.array([sum(math.log((counts[lang][g] + language.ALPHA) / total[lang]) for g in three(low(w))) for lang in langs])
            if low(w):
                fits = np.array(own.get(Counter(map(language.script_of, low(w))).most_common(1)[0][0], [True] * len(langs)))
                score -= language.WRONG_SCRIPT * (~fits if fits.any() else 0 * fits)
            step = value[None, :] - language.SWITCH * (1 - np.eye(len(langs)))
            back.append(step.argmax(axis=1))
            value = step.max(axis=1) + score
        k = int(value.argmax())
        share = np.zeros(len(langs))
        for n, b in zip(reversed(letters), reversed(back)):
            share[k] += n
            k = int(b[k])
        assert got[r.doc_id].lang_pred == langs[int(share.argmax())]
        assert abs(got[r.doc_id].score - share.max() / share.sum()) < 1e-9


def test_a_language_with_few_documents_keeps_its_grams(spark, monkeypatch):
    """The bound on n-grams holds for each language, and scripts don't count against it."""
    monkeypatch.setattr(language, "GRAMS_EACH", 12)
    rows = [("en", "the quick brown fox jumps over the lazy dog and the cat " * 50)] * 40 + [("el", "και το σπίτι είναι μεγάλο")]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"))
    at = model["langs"].index("el")
    greek = [g for g in model["grams"] if any("α" <= c <= "ω" for c in g)]
    assert len(greek) == 12 and set(model["scripts"]) == {"Latin", "Greek"} and model["scripts"]["Greek"][at]
    got = language.identify(spark.createDataFrame([(1, "το σπίτι"), (2, "the dog")], "doc_id long, text string"), model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == ["el", "en"]
