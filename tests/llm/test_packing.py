import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelwright.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, docs, tokenizer):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    texts = {}
    for d in docs:
        texts.setdefault(d.doc_id, []).append(d.text or "")
    assert by_doc.keys() == texts.keys()
    for doc_id, own in texts.items():
        want = []
        for text in own:
            ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
            first = (len(ids) - 1) % 1024 + 1
            cuts = [0, *range(first, len(ids), 1024), len(ids)]
            want += [(p, i, j - i, zlib.crc32(np.array(ids[i:j], "<u4").tobytes())) for p, (i, j) in enumerate(zip(cuts[:-1], cuts[1:]))]
        assert sorted(want) == sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc_id])
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024
    return len(sequences)


def test_odd_rows(odd, clashing, none, tokenizer):
    for docs in (odd, clashing, none):
        rows = packing.pack(docs).collect()
        check(rows, docs.collect(), tokenizer)
    assert {"extra", "kept"} <= set(packing.pack(clashing).columns)


def test_added_token_in_texts(spark, tokenizer):
    """The vocabulary's added token inside a text, at both ends of one, alone, repeated, broken off, in a long text."""
    end = "<|endoftext|>"
    texts = [f"x {end} y", f"{end}y", f"x{end}", end, end * 3, f" {end} ", "<|endoftext|", f"a {end[:-1]} {end} b", f"word {end} " * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [87, 220, 50256, 331]
    check(packing.pack(docs).collect(), docs.collect(), tokenizer)


def test_documents(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs.repartition(5)).collect()
    used = check(rows, docs.collect(), tokenizer)
    assert used <= -(-sum(r.length for r in rows) // 1024) * 1.02 + 1


def test_white_space_and_special_strings(tokenizer):
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", " a  b", "x\x1c y", "<|endoftext|> a <|endoftext|>", "it's we'll 's 's x's", "a\tb \tc", "　 a b", "tail \n", "1 2 3,4 ,5 é ñ 日本 語"]
    encode = packing.encoder(public_tokenizers.path(packing.VOCABULARY), added=True)
    assert [np.frombuffer(encode(x), "<u4").tolist() for x in texts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def fewest(lengths, limit):
    """Sequences of the best packing, by exhaustive search."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0] and i < len(lengths):
            if len(rooms) > best[0]:
                return
        if i == len(lengths):
            best[0] = min(best[0], len(rooms))
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            go(i + 1, (*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]))
        if len(rooms) + 1 <= best[0]:
            go(i + 1, (*rooms, limit - lengths[i]))

    go(0, ())
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_dominance_never_costs_a_sequence(lengths):
    counts = {n: lengths.count(n) for n in lengths}
    packed = packing.pack_lengths(counts, 20)
    flat = sorted(n for times, held in packed for n in held * times)
    assert flat == sorted(lengths) and all(sum(held) <= 20 for _, held in packed)
    # what the rules fixed is part of a best packing: with the rest packed as well as can be, nothing is lost
    left = np.zeros(21, np.int64)
    for n, c in counts.items():
        left[n] += c
    fixed = 0
    for n in range(20, 0, -1):
        while left[n]:
            more = packing._beside(left, n, 20 - n)
            if more is None:
                break
            for x in (n, *more):
                left[x] -= 1
            fixed += 1
    rest = [n for n in range(21) for _ in range(left[n])]
    assert fixed + (fewest(rest, 20) if rest else 0) == fewest(lengths, 20)


PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", "|>", "<|", " ", "\n", "a", " b", "é", "12", "<|startoftext|>"]), max_size=12).map("".join))
def test_added_tokens_in_texts_are_those_of_the_library(text):
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), added=True)
    for t in (text, "a <|endoftext|> b"):
        assert np.frombuffer(encode(t), "<u4").tolist() == PLAIN.encode(t, add_special_tokens=False).ids


def test_pieces_hold_added_tokens(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "<|endoftext|>" * 1500)], "doc_id long, text string")
    check(packing.pack(docs).collect(), docs.collect(), PLAIN)
