"""Language ID: the script of a word's letters narrows the candidates, character n-grams score each word, and a Viterbi
path with a penalty for switching labels the spans of a text."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, others, short_batches, table, text_map
from .textvec import SPACE, Words, buffers, chunks

#: Training documents of each language at most (chosen by a hash), n-grams of each language that the model keeps at most.
DOCS_EACH, GRAMS_EACH = 1500, 100_000
#: Longest n-gram; added to each count; share of a language's letters from which a script counts as its own.
ORDER, ALPHA, SCRIPT_SHARE = 3, 0.5, 0.01
#: Cost, in log-probability, of going from one language to another; cost of a word in a script that isn't the language's.
SWITCH, WRONG_SCRIPT = 12.0, 30.0
#: Words that a worker remembers; letters of the longest word that is labelled as one; letters at most in a piece of a longer
#: one (or of text that no ASCII white space parts); letters of a long word that are taken up at once.
REMEMBERED, LONGEST, PIECE, AT_ONCE = 250_000, 60, 20, 60_000
#: Scripts that one language mixes from letter to letter: a change between them ends no piece.
MIXED = {"Kana": "Han"}
#: Share of the letters below which the stage rejects a document: none of its languages prevails.
LEAST_SCORE = 0.5

#: First code point of each block and its script.
BLOCKS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"),
    (0x31F0, "Kana"), (0x3200, "Han"), (0xA000, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFF21, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"), (0x32000, "Other"),
]
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_STARTS, _SCRIPTS = [a for a, _ in BLOCKS], [s for _, s in BLOCKS]


def script_of(letter: str) -> str:
    return _SCRIPTS[bisect_right(_STARTS, ord(letter)) - 1]


def letters_of(word: str) -> str:
    word = word.lower()
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def grams(letters: str) -> Iterator[str]:
    """Runs of ORDER characters of the word between two spaces."""
    padded = f" {letters} "
    return (padded[i : i + ORDER] for i in range(max(1, len(padded) - ORDER + 1)))


def runs_of(word: str) -> list[str]:
    """The letters of a word; of one of more than LONGEST letters, those between Unicode white space."""
    letters = letters_of(word)
    return [letters] if 0 < len(letters) <= LONGEST else [x for x in map(letters_of, word.split()) if x] if letters else []


def pieces(letters: str) -> list[tuple[int, int]]:
    """Borders of the pieces of a long run of letters: PIECE letters at most, each in one script (or in MIXED ones)."""
    scripts = [MIXED.get(s, s) for s in map(script_of, letters)]
    out, begin = [], 0
    for i in range(1, len(letters) + 1):
        if i == len(letters) or i - begin == PIECE or scripts[i] != scripts[begin]:
            out.append((begin, i))
            begin = i
    return out


def train(docs: DataFrame) -> dict:
    """The model, from documents with a text and a language: n-gram log-probabilities and scripts by language.

    At most DOCS_EACH documents of each language, chosen by a hash of their text, are counted; n-grams are summed by
    Spark, and the GRAMS_EACH most frequent ones of each language make the model, so one with few documents keeps its own.
    How many letters of each script a language has is kept apart from these, and whole.
    """
    short_batches(docs.sparkSession)
    docs = docs.where("lang is not null and text is not null")
    share = {r.lang: min(1.0, DOCS_EACH / r.n) for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return {"langs": [], "grams": {}, "table": np.zeros((1, 0)), "scripts": {}}
    pick = F.create_map(*(F.lit(x) for kv in share.items() for x in kv))[F.col("lang")]
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < pick * 1_000_000).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                own = total.setdefault(lang, Counter())
                for word, n in Counter(_WORD.findall(text)).items():
                    for letters in runs_of(word):
                        for g in grams(letters):
                            own[g] += n
                        for s, k in Counter(map(script_of, letters)).items():
                            own["#" + s] += n * k
        rows = [(lang, g, n) for lang, own in total.items() for g, n in own.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "gram", "n"])

    sums = some.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    nth = F.row_number().over(Window.partitionBy("lang", F.col("gram").startswith("#")).orderBy(F.desc("n"), "gram"))
    rows = sums.withColumn("nth", nth).where(F.col("gram").startswith("#") | (F.col("nth") <= GRAMS_EACH)).select("lang", "gram", "n").collect()
    langs = sorted(share)
    at = {lang: k for k, lang in enumerate(langs)}
    counts: dict[str, np.ndarray] = {}
    letters: dict[str, np.ndarray] = {}
    for lang, gram, n in rows:
        (letters if gram[0] == "#" else counts).setdefault(gram, np.zeros(len(langs)))[at[lang]] += n
    total = sum(counts.values(), np.zeros(len(langs))) + ALPHA * (len(counts) + 1)
    every = sum(letters.values(), np.zeros(len(langs)))
    own = {s[1:]: n >= SCRIPT_SHARE * np.maximum(every, 1) for s, n in letters.items()}
    table = np.log((np.stack([*counts.values(), np.zeros(len(langs))]) + ALPHA) / total)  # the last row: n-grams not seen
    return {"langs": langs, "grams": {g: i for i, g in enumerate(counts)}, "table": table, "scripts": own}


class Labeller:
    """Labels the words of many texts; each different word is scored once and remembered."""

    def __init__(self, model: dict):
        self.model, self.langs = model, model["langs"]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.scores = np.zeros((1024, max(1, len(self.langs))))
        self.letters = np.zeros(1024, np.int64)

    def _learn(self, words: list[str], first: int) -> None:
        """Score new words, which get the rows from `first` on."""
        n = first + len(words)
        while n > len(self.letters):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        letters = [letters_of(w) for w in words]
        self.letters[first:n] = [len(x) for x in letters]
        known, unseen = self.model["grams"], len(self.model["table"]) - 1
        rows, sizes = [], []
        for x in letters:
            own = [known.get(g, unseen) for g in grams(x)] if x else ()
            rows += own
            sizes.append(len(own))
        sizes = np.array(sizes)
        full = np.flatnonzero(sizes)
        self.scores[first:n] = 0
        if len(full):
            self.scores[first + full] = np.add.reduceat(self.model["table"][rows], (np.cumsum(sizes) - sizes)[full])
        self._narrow(letters, self.scores[first:n])

    def _narrow(self, letters: list[str], scores: np.ndarray) -> None:
        for i, x in enumerate(letters):
            if x:
                script = "Latin" if max(x) < "\u0370" else Counter(map(script_of, x)).most_common(1)[0][0]
                allowed = self.model["scripts"].get(script)
                if allowed is not None and not allowed.all() and allowed.any():
                    scores[i, ~allowed] -= WRONG_SCRIPT

    def _long(self, word: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Scores and letters of the pieces of a word of more than LONGEST letters, else None. Every n-gram counts, in the
        piece that its middle letter falls into. Such pieces aren't remembered."""
        parts = runs_of(word)
        if sum(map(len, parts)) <= LONGEST:
            return None
        known, unseen = self.model["grams"], len(self.model["table"]) - 1
        scores, sizes = [], []
        for part in parts:
            padded = f" {part} "
            for lo in range(0, len(part), AT_ONCE):
                own = part[lo : lo + AT_ONCE]
                cuts = pieces(own)
                rows = [known.get(padded[i : i + ORDER], unseen) for i in range(lo, lo + len(own))]
                score = np.add.reduceat(self.model["table"][rows], [a for a, _ in cuts])
                self._narrow([own[a:b] for a, b in cuts], score)
                scores.append(score)
                sizes += [b - a for a, b in cuts]
        return np.concatenate(scores), np.array(sizes, np.int64)

    def _ids(self, words: Words, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self._forget()
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        raw, known, start, new = words.data.tobytes(), self.known, len(self.known), []
        ids = [known.get(h, -1) for h in unique.tolist()]
        for k, i in enumerate(ids):
            if i < 0:
                ids[k] = known[int(unique[k])] = len(known)
                w = at[first[k]]
                new.append(raw[words.start[w] : words.end[w]].decode("utf-8", "replace"))
        if new:
            self._learn(new, start)
        return np.array(ids, np.int64)[inverse]

    def path(self, score: np.ndarray) -> np.ndarray:
        """The language of each word on the best path. If no stretch of words gains more in other languages than one
        switch costs, the language with the best sum holds for all words; else the path is searched."""
        best = int(np.argmax(score.sum(axis=0)))
        if len(self.langs) < 2 or not len(score):
            return np.full(len(score), best)
        gain = np.cumsum(np.delete(score, best, axis=1).max(axis=1) - score[:, best])
        if (gain - np.minimum(np.minimum.accumulate(np.concatenate([[0.0], gain[:-1]])), 0)).max() <= SWITCH:
            return np.full(len(score), best)
        value, back = [0.0] * len(self.langs), []
        for row in score.tolist():
            top = max(value)
            lead = value.index(top)
            top -= SWITCH
            back.append([k if v >= top else lead for k, v in enumerate(value)])
            value = [(v if v >= top else top) + s for v, s in zip(value, row, strict=True)]
        out = np.empty(len(score), np.int64)
        k = value.index(max(value))
        for i in range(len(score) - 1, -1, -1):
            out[i] = k
            k = back[i][k]
        return out

    def label(self, texts: pa.Array) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
        """For each text: the language of most letters, its share of them, and (language, first word, last word)."""
        if not self.langs:
            return [("und", 0.0, [])] * len(texts)
        data, offsets = buffers(texts)
        out: list[tuple[str, float, list]] = []
        for a, b in chunks(offsets):
            words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACE)
            raw = words.data
            long = {w: got for w in np.flatnonzero(words.end - words.start > LONGEST).tolist() if (got := self._long(raw[words.start[w] : words.end[w]].tobytes().decode("utf-8", "replace")))}
            times = np.ones(len(words.start), np.int64)
            times[list(long)] = 0
            usual = np.flatnonzero(times)
            ids = self._ids(words, words.hashes()[usual], usual)
            score, letters = self.scores[ids], self.letters[ids]
            word, first = np.arange(len(words.start)), words.first
            if long:
                # a long word stands as its pieces, each other one as itself
                for w, (_, sizes) in long.items():
                    times[w] = len(sizes)
                begin = np.concatenate([[0], np.cumsum(times)])
                word, first = np.repeat(word, times), begin[words.first]
                score_all, letters_all = np.empty((begin[-1], score.shape[1])), np.empty(begin[-1], np.int64)
                score_all[begin[usual]], letters_all[begin[usual]] = score, letters
                for w, (own, sizes) in long.items():
                    score_all[begin[w] : begin[w + 1]], letters_all[begin[w] : begin[w + 1]] = own, sizes
                score, letters = score_all, letters_all
            for i, j, nth in zip(first[:-1].tolist(), first[1:].tolist(), words.first[:-1].tolist(), strict=True):
                if not letters[i:j].any():
                    out.append(("und", 0.0, []))
                    continue
                path = self.path(score[i:j])
                weight = np.bincount(path, letters[i:j], len(self.langs))
                k = int(np.argmax(weight))
                cut = np.flatnonzero(np.diff(path)) + 1
                spans = [(self.langs[path[s]], int(word[i + s]) - nth, int(word[i + e - 1]) - nth) for s, e in zip([0, *cut.tolist()], [*cut.tolist(), j - i], strict=True)]
                out.append((self.langs[k], float(weight[k] / weight.sum()), spans))
        return out


#: The labeller of the model that a worker used last, with the words that it remembers.
_reused: dict[str, Labeller] = {}


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """docs with lang_pred, score (share of the letters that are in this language) and lang_spans (words from 0).

    Words end at ASCII white space. Where the language changes inside a long one, that word ends one span and begins the
    next.

    Only the text is looked at. Null, empty and letterless texts are "und" with score 0 and no span, as is every text
    if nothing was learned. Columns with these names are replaced, others stay; repeated rows are labelled one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())]))

    key = hashlib.sha256(repr([*model.values()]).encode()).hexdigest()

    def start():
        labeller = _reused.get(key)
        if labeller is None:
            _reused.clear()
            labeller = _reused[key] = Labeller(shared.value)

        def work(texts: pa.Array) -> list[pa.Array]:
            rows = labeller.label(texts)
            spans = [[dict(zip(("lang", "first_word", "last_word"), s, strict=True)) for s in r[2]] for r in rows]
            return [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array(spans, kind)]

        return work

    return text_map(docs, "lang_pred string, score double, lang_spans array<struct<lang:string,first_word:long,last_word:long>>", start)


def _learn(docs: DataFrame) -> dict:
    return train(docs.where(~held_out("doc_id", 4, 2)))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = _learn(docs)
    return identify(docs.select("doc_id", "text", held_out("doc_id", 4, 2).alias("held_out")), model).drop("text", "lang_spans")


def keep_known(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stage: documents without letters go (null and empty texts too), and those in which no language has LEAST_SCORE of the
    letters. Rows are judged one by one, repeated ones alike; an empty table stays empty; all columns stay as they are."""
    kept = identify(docs.select(F.struct(*others(docs, [])).alias("_doc"), "text"), _learn(docs)).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.select("_doc.*")
