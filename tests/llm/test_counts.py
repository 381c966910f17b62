import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelwright.llm import counts

WORDS = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole(text):
    return len(WORDS.encode(text or "", add_special_tokens=False).ids)


def test_odd_rows(odd, clashing, none):
    for docs in (odd, clashing, none):
        rows = counts.count_tokens(docs).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == sorted((d.doc_id or -1, len((d.text or "").encode()), whole(d.text)) for d in docs.collect())
    assert {"extra", "kept"} <= set(counts.count_tokens(clashing).columns) and "text" not in counts.count_tokens(clashing).columns


def test_query_against_whole_texts(spark, sf, sf_docs):
    got = {r.doc_id: r for r in counts.op11_token_counts(spark, sf).collect()}
    assert len(got) == len(sf_docs)
    for d in sf_docs.itertuples():
        r = got[d.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((d.text or "").encode()), whole(d.text), whole(d.text) > 2048)


PARTS = ["<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", " ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "　", "​", "a", "B", "é", "é", "́", "1", "23", "٣", "'s", "'S", "'", "İ", "Σ", "日本", "\U0001f600", "-", ".", "word"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=24).map("".join))
def test_no_token_spans_a_cut(text):
    count = counts.counter(public_tokenizers.path("word_bpe_49k.json"))
    data = text.encode()
    assert sum(count(counts.split_words(data))) == whole(text)
    cut = [x for p in data.split() for x in filter(None, counts._BEFORE_DIGIT.split(p))]
    assert sum(count(cut)) == whole(text)


def test_long_runs_without_white_space(spark, monkeypatch):
    texts = ["日本" * 30_000, "ab1" * 40_000, "x" * 50_000 + " " + "y" * 50_000, "<|endoftext|>" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in counts.count_tokens(docs).collect()} == {k: whole(t) for k, t in enumerate(texts)}


def test_pieces_that_are_forgotten_are_counted_anew(spark, odd, monkeypatch):
    monkeypatch.setattr(counts, "KEPT", 3)  # in this process; the tasks' own functions are tried below
    want = [(d.doc_id, whole(d.text)) for d in odd.collect()]
    assert sorted(((r.doc_id, r.n_tokens) for r in counts.count_tokens(odd).collect()), key=str) == sorted(want, key=str)


def test_balanced_runs():
    pieces = [b"a" * n for n in (5, 1, 1, 9, 40, 2)]
    runs = list(counts.balanced(pieces, 10))
    assert [p for r in runs for p in r] == pieces and all(sum(map(len, r)) <= 10 or len(r) == 1 for r in runs)


@pytest.mark.parametrize("text", ["", "a b", " x\n\ny ", "日本語 text"])
def test_pieces_vocabulary(spark, text):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert counts.count_tokens(docs, path).first().n_tokens == len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
