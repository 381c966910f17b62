"""PII: generators propose overlapping spans, boosted trees weigh format and context, calibrated thresholds decide.

Plain patterns give the base spans, which always stand. The trees learn from them what such data looks like (format and
context, not the pattern itself), and add spans that the patterns miss, such as the two cards in a run of 32 digits.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, others, short_batches, table, text_map

KINDS = ["email", "ip", "card", "phone"]
TREES, DEPTH = 30, 4
#: Precision that a kind's threshold must reach on the held-out half of the candidates; the least threshold; steps that thresholds go by.
PRECISION, LEAST, STEPS = 0.95, 0.5, 10_000
#: Different candidates in a task that fits the trees: their number sets the number of tasks.
IN_TASK = 20_000
#: Digits that joined groups may have.
DIGITS = 19

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_RUN = re.compile(r"\+?\(?[0-9][0-9\x20().-]*[0-9]")
_GROUP = re.compile(r"[^\x20]+")
_SIGN = re.compile(r"\s?(?:@|\(at\)|\[at\])\s?", re.I)
_BEFORE, _AFTER = re.compile(r"[^\s@<>\"]+\Z"), re.compile(r"[^\s@<>\"]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_RUN_BEFORE, _RUN_AFTER = re.compile(r"[0-9\x20().-]*\Z"), re.compile(r"[0-9\x20().-]*")
#: Where classes of the largest dotted part begin.
_PART = [0, 10, 100, 256, 1000, 1900, 2100]
_CONTEXT = re.compile(r"tel|phone|call|fax|mobile|mail|contact|card|visa|account|pay|address|server|host|ip\b", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start, in code points.

    An address is found from its @: its local part reaches back as far as its characters go, but not into the address
    before. So long runs without an @ cost nothing, and the spans are those of the plain pattern.
    """
    out: list[tuple[int, int, int]] = []
    if not _ANY.search(text):
        return out
    end, seen = 0, 0
    if "@" in text:
        for m in _AT.finditer(text):
            local = _reach(_LOCAL, text, max(end, seen), m.start())
            seen = m.start() + 1
            if local < m.start():
                out.append((0, local, m.end()))
                end = m.end()
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def _reach(run: re.Pattern, text: str, least: int, at: int) -> int:
    """Start of the run of characters that ends at `at`, `least` at the lowest. Looks back in growing steps, so its time
    goes with the run's length."""
    step = 64
    while True:
        low = max(least, at - step)
        m = run.search(text[low:at])
        if not m:
            return at
        if m.start() > 0 or low == least:
            return low + m.start()
        step *= 4


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Overlapping (kind, start, end): loose addresses, dotted numbers, and groups of digits joined in every way."""
    out: set[tuple[int, int, int]] = set()
    if not _ANY.search(text):
        return []
    if "@" in text or "at)" in text.lower() or "at]" in text.lower():
        signs = [m.span() for m in _SIGN.finditer(text)]
        # what stands around each sign, up to the signs beside it
        for k, (i, j) in enumerate(signs):
            a = _reach(_BEFORE, text, signs[k - 1][1] if k else 0, i)
            m = _AFTER.match(text, j, signs[k + 1][0] if k + 1 < len(signs) else len(text))
            if a == i or not m:
                continue
            b = m.end()
            while b > a and text[b - 1] in ".,;:!?)]}'":
                b -= 1
            out.add((0, a, b))
    for run in _RUN.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = [(m.start() + run.start(), m.end() + run.start()) for m in _GROUP.finditer(run[0])]
        sizes = [len(_NOT_DIGIT.sub("", text[a:b])) for a, b in groups]
        groups, sizes = [g for g, n in zip(groups, sizes, strict=True) if n], [n for n in sizes if n]
        for i in range(len(groups)):
            digits = 0
            for j in range(i, len(groups)):  # a group has a digit, so this ends
                digits += sizes[j]
                if digits > DIGITS:
                    break
                a, b = groups[i][0], groups[j][1]
                while b > a and not text[b - 1].isdigit():
                    b -= 1
                if i == j and text.count(".", a, b) == 3:
                    out.add((1, a, b))
                if digits >= 13:
                    out.add((2, a, b))
                if 7 <= digits <= 15:
                    out.add((3, a, b))
    return sorted(out)


def _side(text: str, i: int) -> int:
    if not 0 <= i < len(text):
        return 0
    c = text[i]
    return 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def _rest(digits: str) -> tuple[int, bool]:
    """Of what a run holds beside a span: its digits (one more than a card's at most), and whether they are a card's."""
    return min(len(digits), DIGITS + 1), 13 <= len(digits) <= DIGITS and luhn(digits)


def _step(n: int) -> int:
    """A count up to 24 as it is, a larger one by its order of magnitude: 32 values at most."""
    return n if n < 25 else 25 + min(6, (n // 25).bit_length())


def features(text: str, kind: int, a: int, b: int) -> list[int]:
    """Format and context as whole numbers below 32, so that most candidates share theirs with others and can be counted."""
    span = text[a:b]
    left, right = (_NOT_DIGIT.sub("", x) for x in (_RUN_BEFORE.search(text[max(0, a - 40) : a])[0], _RUN_AFTER.match(text, b, b + 40)[0]))
    digits = _NOT_DIGIT.sub("", span)
    parts = span.split(".")
    local, _, domain = span.partition("@")
    top = domain.rsplit(".", 1)[-1]
    counts = [
        b - a, len(digits), span.count(" "), span.count("."), span.count("-"), span.count("("), span.count("@"), len(parts),
        max((len(g) for g in re.findall("[0-9]+", span)), default=0), len(local), len(domain), len(top) if top.isalpha() else 0,
    ]
    return [
        kind, *map(_step, counts), int(span.startswith("+")), 16 * sum(map(str.isalpha, span)) // (b - a), int(luhn(digits)) if digits else 0,
        bisect_right(_PART, max((int(p[:6]) for p in parts if p.isdecimal()), default=-1)), _side(text, a - 1), _side(text, b),
        int(text[a - 1 : a] == "+"), int(bool(_CONTEXT.search(text, max(0, a - 24), a))), int(digits[:1] in ("4", "5")), *map(int, (*_rest(left), *_rest(right))),
    ]


WIDTH = len(features("1", 1, 0, 1))


def made_card(seed: int) -> str:
    """A card number that nobody has: 16 digits from a seed, the last one by Luhn, in one of three formats."""
    digits = f"4{seed % 10**14:014d}"
    digits += next(c for c in "0123456789" if luhn(digits + c))
    return ("" if seed % 3 == 0 else " " if seed % 3 == 1 else "-").join(digits[i : i + 4] for i in (0, 4, 8, 12))


def made_phone(seed: int) -> str:
    """A phone number from a seed, its groups parted by spaces in one of three ways."""
    digits, at, groups = f"{seed % 10**12 + 10**12:013d}"[1:], 0, []
    for n in ((2, 1, 2, 2, 2, 2), (1, 3, 3, 4), (2, 4, 6))[seed % 3]:
        groups.append(digits[at : at + n])
        at += n
    return "+" + " ".join(groups)


def crowded(text: str, base: list[tuple[int, int, int]], seed: int) -> Iterator[tuple[str, set[tuple[int, int, int]]]]:
    """Short texts in which a number of this text stands beside a made one with only a space between, and their right
    spans: plain patterns can't part them, so they show the trees which cuts of a run are right. Numbers without a sign and
    dates in the same place are none."""
    for kind, a, b in base:
        if kind not in (2, 3):
            continue
        before, after, number = text[max(0, a - 24) : a], text[b : b + 24], text[a:b]
        for form in range(3):
            other = 3 * (seed + a) + form
            pairs = [(kind, number, made_card(other))]
            if kind == 2:
                pairs += [(2, made_card(other), number), (3, made_phone(other), number)]
            for first, one, two in pairs:  # a card comes second: the sign of a phone would part the run
                at = len(before) + len(one) + 1
                yield f"{before}{one} {two}{after}", {(first, len(before), at - 1), (2, at, at + len(two))}
            for none in (made_phone(other)[1:], f"{1970 + other % 90}-{other % 12 + 1:02d}-{other % 28 + 1:02d} {other % 24:02d} {other % 60:02d} {other % 59:02d}"):
                yield f"{before}{none}{after}", set()


class Trees:
    """A fitted Spark GBT model as arrays, to weigh candidates inside a task."""

    def __init__(self, model, thresholds: list[float]):
        self.thresholds = thresholds
        self.weights = list(model.treeWeights)
        self.trees = [self._flat(t._call_java("rootNode")) for t in model.trees]
        self.arrays = [[np.array([n[k] for n in tree], t) for k, t in enumerate((np.int64, np.float64, np.int64, np.int64))] for tree in self.trees]

    def _flat(self, node) -> list[tuple[int, float, int, int]]:
        """Feature (-1: a leaf), cut or prediction, left and right child of each node."""
        out: list = []

        def visit(n) -> int:
            at = len(out)
            out.append(None)
            if n.getClass().getSimpleName() == "LeafNode":
                out[at] = (-1, float(n.prediction()), 0, 0)
            else:
                feature, cut = n.split().featureIndex(), float(n.split().threshold())
                out[at] = (feature, cut, visit(n.leftChild()), visit(n.rightChild()))
            return at

        visit(node)
        return out

    def chances(self, x: list[list[float]] | np.ndarray) -> list[float]:
        """For many candidates at once: all of them go down each tree step by step."""
        rows = np.asarray(x, np.float64).reshape(-1, WIDTH)
        margin, each = np.zeros(len(rows)), np.arange(len(rows))
        for weight, (feature, value, left, right) in zip(self.weights, self.arrays, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                down = np.where(rows[each, np.maximum(f, 0)] <= value[at], left[at], right[at])
                at = np.where(f >= 0, down, at)
            margin += weight * value[at]
        return (1 / (1 + np.exp(-2 * margin))).tolist()


def _unpacked(x: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, WIDTH)


def counted(docs: DataFrame) -> DataFrame:
    """(half, label, x, w): how often the candidates of all different texts have the features x (a byte each) and are right
    (label 1: equal to a base span) or not. A text's half goes by a hash. Numbers of half 0 are also set beside made ones (`crowded`)."""
    short_batches(docs.sparkSession)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("d", F.xxhash64("text"))

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, d, half in zip(*(b.column(c).to_pylist() for c in ("text", "d", "half")), strict=True):
                found = candidates(text)
                if not found:
                    continue
                base = base_spans(text)
                right = set(base)
                own = Counter((int(c in right), bytes(features(text, *c))) for c in found)
                for t, spans in crowded(text, base, d & 0xFFFFFFFFFFFF) if half == 0 else ():
                    own.update((int(c in spans), bytes(features(t, *c))) for c in candidates(t))
                rows += [(d, half, *key, n) for key, n in own.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))], names=["d", "half", "label", "x", "n"])

    found = texts.withColumn("half", F.pmod(F.xxhash64("d", F.lit(1)), F.lit(2))).mapInArrow(propose, "d long, half long, label long, x binary, n long")
    # copies of a text count once
    return found.groupBy("d", "half", "label", "x").agg(F.min("n").alias("n")).groupBy("half", "label", "x").agg(F.sum("n").alias("w"))


def train(docs: DataFrame) -> Trees | None:
    """Trees over the candidates of all different texts, each as often as it was counted; those that equal a base span are the
    right ones. Half of the texts train, with made numbers beside theirs. The other half is held out, as it is: each kind's
    threshold is the least of STEPS steps from which PRECISION of all its candidates are right. None where there are too few
    candidates, or none of one sort. Only sums by step of chance come to the driver."""
    tallied = materialize(counted(docs))
    sums = tallied.where("half = 0").groupBy("label").agg(F.sum("w").alias("w"), F.count("*").alias("n")).collect()
    if len(sums) < 2 or sum(r.w for r in sums) < 20:
        discard(tallied)
        return None

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.FixedSizeListArray.from_arrays(pa.array(_unpacked(b.column("x")).astype(np.float64).ravel()), WIDTH)
            yield pa.RecordBatch.from_arrays([b.column("label").cast(pa.float64()), x.cast(pa.list_(pa.float64())), b.column("w").cast(pa.float64())], names=["label", "x", "w"])

    # in the order of their features, so the same counts give the same sums
    rows = tallied.where("half = 0").coalesce(1 + sum(r.n for r in sums) // IN_TASK).sortWithinPartitions("x", "label")
    data = rows.select("label", "x", "w").mapInArrow(unpack, "label double, x array<double>, w double").select("label", array_to_vector("x").alias("features"), "w").cache()
    trees = Trees(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=5, stepSize=0.3, weightCol="w").fit(data), [1.0] * len(KINDS))
    data.unpersist()
    edges = np.arange(STEPS) / STEPS

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unpacked(b.column("x"))
            steps = np.searchsorted(edges, trees.chances(x), side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].astype(np.int64)), pa.array(steps.astype(np.int64)), b.column("label"), b.column("w")], names=["kind", "step", "label", "w"])

    held = tallied.where("half = 1").select("x", "label", "w").mapInArrow(weigh, "kind long, step long, label long, w long")
    steps = held.where(F.col("step") >= LEAST * STEPS).groupBy("kind", "step").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("label")).alias("right")).collect()
    every, right = [0] * len(KINDS), [0] * len(KINDS)
    for r in sorted(steps, key=lambda r: -r.step):
        every[r.kind] += r.w
        right[r.kind] += r.right
        if right[r.kind] >= PRECISION * every[r.kind]:
            trees.thresholds[r.kind] = float(edges[r.step])
    discard(tallied)
    return trees


def find(text: str, trees: Trees | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans: what the trees add overlaps no base span and no likelier candidate."""
    base = base_spans(text)
    if trees is None:
        return base, base
    taken = [(a, b) for _, a, b in base]
    free = [c for c in candidates(text) if not any(c[1] < b and a < c[2] for a, b in taken)] if len(taken) < 50 else _free(candidates(text), taken)
    if not free:
        return base, base
    chances = trees.chances([features(text, *c) for c in free])
    more: list[tuple[int, int, int]] = []
    begins: list[int] = []
    for _, c in sorted((-p, c) for p, c in zip(chances, free, strict=True) if p >= trees.thresholds[c[0]] and trees.thresholds[c[0]] < 1):
        k = bisect_right(begins, c[1])  # spans taken so far stand apart: only the ones on both sides can overlap
        if (k == 0 or more[k - 1][1] <= c[1]) and (k == len(more) or c[2] <= more[k][0]):
            begins.insert(k, c[1])
            more.insert(k, (c[1], c[2], c[0]))
    return base, sorted([*base, *((kind, a, b) for a, b, kind in more)])


def _free(found: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The candidates that overlap nothing taken, for texts with many spans."""
    merged: list[list[int]] = []
    for a, b in sorted(taken):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    starts, ends = np.array([a for a, _ in merged]), np.array([b for _, b in merged])
    return [c for c in found if not ((k := int(np.searchsorted(ends, c[1], side="right"))) < len(starts) and starts[k] < c[2])]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each stretch of overlapping spans becomes the kind of its first span in brackets."""
    out, end, at = [], 0, 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= end:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans and redacted (the text without them).

    Positions are code points. Null texts count as empty: no spans, an empty redacted text. Repeated rows are scanned one
    by one; columns named like the new ones are replaced, others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def work(texts: pa.Array) -> list[pa.Array]:
        counts, shas, spans, clean = [[0] * len(texts) for _ in KINDS], [], [], []
        for i, raw in enumerate(texts):
            text = raw.as_buffer().to_pybytes().decode("utf-8", "replace")
            base, every = find(text, shared.value)
            for k, _, _ in base:
                counts[k][i] += 1
            shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(every))
            clean.append(redact(text, every) if every else text)
        return [*(pa.array(c, pa.int64()) for c in counts), *(pa.array(x, pa.string()) for x in (shas, spans, clean))]

    return text_map(docs, ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, redacted string", lambda: work)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, train(docs)).drop("text", "redacted")


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stage: every document stays, with its personal data masked; n_chars follows the new text. Nulls stay null, repeated
    rows are masked alike, an empty table stays empty, and other columns stay as they are."""
    found = scan(docs.select(F.struct(*others(docs, [])).alias("_doc"), "text"), train(docs))
    new = {"text": F.when(F.col("_doc.text").isNotNull(), F.col("redacted")), "n_chars": F.when(F.col("_doc.n_chars").isNotNull(), F.length("redacted").cast("long"))}
    return found.select(*(new.get(c.lower(), F.col("_doc").getField(c)).alias(c) for c in docs.columns))
