"""Resampling in one scan: tasks hold one number for each replicate and emit them once, so what is shuffled depends on the
number of tasks and replicates, not on the number of rows.

Draws are whole numbers from a few fifth powers modulo a prime, which permute the numbers below it. They depend on (seed,
replicate, key) alone: on no partitioning, and any engine with 64-bit numbers can draw the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..sources.files import workspace
from .ordering import any_large
from .stats import cliffs_delta, pooled_rho, spearman, with_ranks

#: Draws are below this prime; a number added between two powers.
P, STEP = (1 << 31) - 1, 40692
#: Rows that are dealt out together, at most about so many; numbers in a matrix of replicates by rows; of a group whose x are
#: dealt out by a task (16 MB for x and weights); numbers that are drawn and sorted at a time, so that they stay in the cache.
LEAF, CELLS, HELD, CACHED = 4096, 1 << 21, 1 << 20, 1 << 14
#: Cumulative chances of 0, 1, 2, ... events of a Poisson distribution with mean 1.
POISSON_1 = [0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676, 0.99998975, 0.99999887]
#: How many draws of P reach each count of a Poisson number with mean 1.
REACHES = [int(c * P) + 1 for c in POISSON_1]


def fifth(x):
    """x to the fifth modulo P: of a number, an array or a Column."""
    y = x * x % P
    return y * y % P * x % P


def number(key: Column | str, seed: int, *more: Column | str) -> Column:
    """What a row's key brings to all its draws."""
    x = F.lit(fifth(seed + 1)).cast("long")
    for k in (key, *more):
        x = fifth((x + F.coalesce(F.pmod((F.col(k) if isinstance(k, str) else k).cast("long"), F.lit(P)), F.lit(0)) + 1) % P)  # no key: as 0
    return x


def draw(numbers, replicate):
    """A draw below P for a row's number and a replicate; both may be arrays or Columns."""
    return fifth((fifth((numbers + fifth(replicate)) % P) + STEP) % P)


def draws(numbers: np.ndarray, first: int, last: int) -> np.ndarray:
    """draw(): replicates first to last - 1 by rows. As 2 ** 31 is 1 modulo P, what is above 31 bits is added to what is below them
    instead of dividing; bounds are such that no product reaches 2 ** 64."""
    x = numbers.astype(np.uint64)[None, :] + fifth(np.arange(first, last, dtype=np.int64)).astype(np.uint64)[:, None]
    y, high = np.empty_like(x), np.empty_like(x)

    def fold(z):
        np.right_shift(z, 31, out=high)
        np.bitwise_and(z, P, out=z)
        np.add(z, high, out=z)

    for step in (0, STEP):
        x += np.uint64(step)
        fold(x)  # 2 ** 31 at most
        np.multiply(x, x, out=y)
        fold(y)  # below 2 ** 32
        np.multiply(y, y, out=y)
        fold(y)
        fold(y)  # 2 ** 31 + 3 at most
        np.multiply(x, y, out=x)
        fold(x)  # 2 ** 32 + 3 at most
    fold(x)
    np.subtract(x, P, out=x, where=x >= P)
    return x.view(np.int64)


def poisson(drawn: np.ndarray) -> np.ndarray:
    """How often a replicate takes each row: Poisson numbers with mean 1."""
    return np.searchsorted(np.array(REACHES), drawn, side="right").astype(np.float64)


def poisson_of(drawn: Column) -> Column:
    return sum((F.when(drawn >= c, 1).otherwise(0) for c in REACHES), F.lit(0))


def _chunks(n: int, rows: int) -> Iterator[tuple[int, int]]:
    size = max(1, CELLS // max(rows, 1))
    for first in range(1, n + 1, size):
        yield first, min(first + size, n + 1)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _told(sums: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if sums is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, len(sums) + 1)), pa.array(list(sums), pa.list_(pa.float64()))], names=["replicate", "sums"])


def _added(parts: DataFrame) -> DataFrame:
    """(replicate, sums) of all tasks, added up."""
    long = parts.select("replicate", F.posexplode("sums").alias("i", "x")).groupBy("replicate", "i").agg(F.sum("x").alias("x"))
    return long.groupBy("replicate").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("sums"))


def bootstrap_sums(units: DataFrame, key: Sequence[str], values: Sequence[Column], n: int, seed: int) -> DataFrame:
    """(replicate, sums): the sums of values over units that are drawn anew, each as often as a Poisson number with mean 1
    says. One scan; a task emits n rows."""
    rows = units.select(number(key[0], seed, *key[1:]).alias("k"), F.array(*(F.coalesce(v.cast("double"), F.lit(0.0)) for v in values)).alias("w"))

    def run(batches):
        sums = None
        for b in batches:
            if b.num_rows:
                k, w = b.column("k").to_numpy(), _matrix(b.column("w"))
                sums = np.zeros((n, w.shape[1])) if sums is None else sums
                for first, last in _chunks(n, len(k)):
                    sums[first - 1 : last - 1] += poisson(draws(k, first, last)) @ w
        yield from _told(sums)

    return _added(rows.mapInArrow(run, "replicate long, sums array<double>"))


def _split(counts: np.ndarray, take: int, seed: int, group: str, level: int, prefix: int) -> np.ndarray:
    """Of each replicate's labels (replicates by labels), those that a node's left child gets, which has `take` places: one
    hypergeometric number after another. Any task draws the same for the same node."""
    name = f"{seed}/{group}/{level}/{prefix}".encode()
    rng = np.random.Generator(np.random.PCG64(int.from_bytes(hashlib.md5(name).digest(), "little")))
    out = np.zeros_like(counts)
    rest, left = counts.sum(axis=1), np.full(len(counts), take)
    for c in range(counts.shape[1]):
        rest = rest - counts[:, c]
        out[:, c] = rng.hypergeometric(counts[:, c], rest, left) if counts[:, c].any() else 0
        left = left - out[:, c]
    return out


def dealt(numbers: np.ndarray, counts: np.ndarray, first: int, last: int) -> np.ndarray:
    """Replicates by rows: the label of each row of a leaf. counts: of each label, for all replicates or (a table) for each.
    Rows are ranked by their draws, and labels dealt out in order."""
    order = np.argsort(draws(numbers, first, last), axis=1, kind="stable")
    ends, places = np.cumsum(counts, axis=-1), np.arange(len(numbers))
    if counts.ndim == 1:
        labels = np.broadcast_to(np.searchsorted(ends, places, side="right"), order.shape)
    else:
        labels = np.zeros(order.shape, np.int64)
        for c in range(counts.shape[1] - 1):
            labels += places[None, :] >= ends[:, c : c + 1]
    out = np.empty(order.shape, np.int64)
    np.put_along_axis(out, order, labels, axis=1)
    return out


def permuted_sums(units: DataFrame, by: Sequence[str], key: str, label: Column, weight: Column, n: int, seed: int, dot: bool = False) -> DataFrame:
    """(replicate, sums): the sum over all units of label times weight (arrays<double>, multiplied place by place; a label of one
    place goes with any weight; `dot`: added up over the places, whose number may then differ between groups), where the labels of each group are dealt out anew among its units: a uniform permutation.

    A group's units lie in the leaves of a binary tree, by a hash of their key, at most some LEAF in each. A node's labels are
    counts of each different label; how many of each go to the left child is a hypergeometric draw, and inside a leaf labels
    follow the order of the rows' own draws. A task that holds a leaf draws the nodes above it by itself, so a group of any
    size has as many tasks as leaves; a group of one leaf is the same with no node above. Different labels of a group should be
    few (their counts travel to each leaf), and a group has fewer than a billion units.
    """
    group = F.to_json(F.struct(*by)) if by else F.lit("")
    rows = units.select(group.alias("g"), number(key, seed).alias("k"), F.col(key).cast("long").alias("key"), label.alias("label"), weight.alias("w"))
    kinds = rows.groupBy("g", "label").agg(F.count("*").alias("c")).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("label", "c"))).alias("kinds"), F.sum("c").alias("m"))
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.col("m") * 2 / LEAF))).cast("int")
    kinds = kinds.withColumn("d", F.when(F.col("m") > LEAF, depth).otherwise(0))
    # a place in the tree by bits of a draw that no replicate has
    placed = rows.drop("label").join(kinds.select("g", "d"), "g").withColumn("leaf", F.floor(draw(F.col("k"), F.lit(0).cast("long")) / F.pow(F.lit(2.0), 31 - F.col("d"))).cast("long"))
    leaves = placed.groupBy("g", "d", "leaf").agg(F.count("*").alias("c"))
    level = F.explode(F.when(F.col("d") > 0, F.sequence(F.lit(1), "d"))).alias("l")
    above = lambda l: F.floor(F.col("leaf") / F.pow(F.lit(2.0), F.col("d") - l)).cast("long")  # noqa: E731, E741
    nodes = leaves.select("g", "d", "leaf", "c", level).groupBy("g", "l", above(F.col("l")).alias("p")).agg(F.sum("c").alias("size"))
    steps = leaves.select("g", "d", "leaf", level).select("g", "leaf", "l", (above(F.col("l") - 1) * 2).alias("p"), (above(F.col("l")) % 2).alias("right"))
    path = steps.join(nodes, ["g", "l", "p"], "left").groupBy("g", "leaf").agg(F.array_sort(F.collect_list(F.struct("l", F.coalesce("size", F.lit(0).cast("long")).alias("left"), "p", "right"))).alias("path"))
    heads = leaves.select("g", "leaf").join(path, ["g", "leaf"], "left").join(kinds.select("g", "kinds"), "g").withColumn("row", F.lit(0))
    both = heads.unionByName(placed.select("g", "leaf", "k", "key", "w").withColumn("row", F.lit(1)), allowMissingColumns=True)
    both = both.repartition("g", "leaf").sortWithinPartitions("g", "leaf", "row", "key").select("g", "leaf", "row", "path", "kinds", "k", "w")

    def run(batches):
        sums, held, head = None, [], None

        def leaf():
            nonlocal sums
            k, w = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            sums = np.zeros((n, 1 if dot else w.shape[1])) if sums is None else sums
            name, path, kinds = head
            a, counts = np.array([x["label"] for x in kinds], np.float64), np.array([x["c"] for x in kinds], np.int64)
            if path:
                counts = np.tile(counts, (n, 1))
                for step in path:
                    left = _split(counts, step["left"], seed, name, step["l"], step["p"])
                    counts = counts - left if step["right"] else left
            for first, last in _chunks(n, len(k)):
                got, own = dealt(k, counts[first - 1 : last - 1] if path else counts, first, last), sums[first - 1 : last - 1]
                if len(a) <= 8:
                    for c in np.flatnonzero(a.any(axis=1)):
                        each = w * a[c]
                        own += (got == c).astype(np.float64) @ (each.sum(axis=1, keepdims=True) if dot else each)
                else:
                    for v in range(w.shape[1]):
                        own[:, 0 if dot else v] += (a[:, min(v, a.shape[1] - 1)][got] * w[:, v]).sum(axis=1)

        for b in batches:
            kind = b.column("row").to_numpy()
            cut = [*np.flatnonzero(kind == 0).tolist(), b.num_rows]
            if cut[0] and held is not None:
                part = b.slice(0, cut[0])
                held.append((part.column("k").to_numpy(zero_copy_only=False).astype(np.int64), _matrix(part.column("w"))))
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                if held:
                    leaf()
                head, held = tuple(b.column(c)[i].as_py() for c in ("g", "path", "kinds")), []
                if j > i + 1:
                    part = b.slice(i + 1, j - i - 1)
                    held.append((part.column("k").to_numpy(zero_copy_only=False).astype(np.int64), _matrix(part.column("w"))))
        if held:
            leaf()
        yield from _told(sums)

    return _added(both.mapInArrow(run, "replicate long, sums array<double>"))


def permutation_p(observed: DataFrame, drawn: DataFrame, statistic: str, n: int) -> DataFrame:
    """observed (one row) with the two-sided share of replicates at least as far out, one added to both counts. Replicates
    without a statistic don't count."""
    seen = F.broadcast(observed.select(F.col(statistic).alias("_seen")))  # one row
    far = drawn.crossJoin(seen).agg(F.count_if(F.abs(F.col(statistic)) >= F.abs(F.col("_seen")) - 1e-12).alias("_far"), F.count(statistic).alias("_n"))
    return observed.crossJoin(F.broadcast(far)).withColumn("p", (F.col("_far") + 1) / (F.col("_n") + 1)).drop("_far", "_n")


def percentile_ends(drawn: DataFrame, statistic: str, level: float = 0.95) -> DataFrame:
    """One row: low and high ends of an interval over replicates, and their variance."""
    ends = F.percentile(statistic, F.array(F.lit((1 - level) / 2), F.lit((1 + level) / 2)))
    return drawn.agg(ends.alias("_e"), F.var_pop(statistic).alias("variance")).select(F.get("_e", F.lit(0)).alias("low"), F.get("_e", F.lit(1)).alias("high"), "variance")


def hash_ranks(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str, size: str, ranges: int = 64) -> DataFrame:
    """df with `out`, the place of a row in its group by order[0], a draw, and then the other columns; size: a column with the
    group's number of rows. Draws are even, so a group's ranges of draws (about `ranges` rows in each) are counted and added up,
    and each is numbered in a task of its own."""
    parts = F.greatest(F.lit(1), F.floor(F.col(size) / ranges))
    ranged = df.withColumn("_range", F.floor(F.col(order[0]) * parts / P))
    counts = ranged.groupBy(*by, "_range").agg(F.count("*").alias("_m"))
    before = counts.select(*by, "_range", F.coalesce(F.sum("_m").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order))
    return ranged.withColumn("_nth", nth).join(before, [*by, "_range"]).withColumn(out, F.col("_before") + F.col("_nth")).drop("_range", "_nth", "_before")


def paired(numbers: np.ndarray, weights: np.ndarray, x: np.ndarray, first: int, last: int) -> np.ndarray:
    """For each replicate the sum of weights times x, when the x of rank i goes to the row with the i-th draw (of equal draws the
    earlier row first). A draw and the row's place in one number sort faster than places by draws."""
    x, places, out = np.sort(x), np.arange(len(numbers)), np.empty(last - first)
    size = max(1, CACHED // len(numbers))
    for r in range(first, last, size):
        end = min(r + size, last)
        both = draws(numbers, r, end)
        np.left_shift(both, 32, out=both)
        np.bitwise_or(both, places, out=both)
        both.sort(axis=1)
        np.bitwise_and(both, (1 << 32) - 1, out=both)
        out[r - first : end - first] = np.take(weights, both) @ x
    return out


def _paired_sums(rows: DataFrame, by: Sequence[str], n: int, block: int) -> DataFrame:
    """(replicate, _x): paired() over all groups. A task holds a group for `block` replicates of it, so a group is copied once for
    each block, and emits one number for each replicate of its blocks."""
    blocks = F.explode(F.sequence(F.lit(0), F.lit((n - 1) // block))).alias("_block")
    copies = rows.select(F.to_json(F.struct(*by)).alias("_g"), blocks, "_key", "_k", "_rx", "_w").repartition("_g", "_block").sortWithinPartitions("_g", "_block", "_key")

    def run(batches):
        sums, held, now = {}, [], None

        def close():
            first, last = now[1] * block + 1, min((now[1] + 1) * block, n) + 1
            k, w, x = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("_k", "_w", "_rx"))
            sums[now[1]] = sums.get(now[1], 0.0) + paired(k, w, x, first, last)

        for key, b in _segments(batches, ["_g", "_block"]):
            if key != now:
                if held:
                    close()
                now, held = key, []
            held.append(b)
        if held:
            close()
        for at, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own)) + at * block + 1), pa.array(own)], names=["replicate", "_x"])

    return copies.mapInArrow(run, "replicate long, _x double")


def stratified_permutation(df: DataFrame, x: str, y: str, by: Sequence[str], key: str, n: int = 10_000, seed: int = 1, least: int = 5, block: int = 1000) -> DataFrame:
    """The pooled rank correlation of x and y, and its p when x is dealt out anew inside each group: the x of rank i goes to the
    row with the i-th draw.

    A group of at most HELD rows is dealt out in tasks of `block` replicates, which draw by themselves: no rows are made for
    replicates. In a larger group each replicate has rows of its own, and places are counted over ranges of draws: no task
    holds or sorts such a group.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(key).cast("long").alias("_key"), x, y)
    ranked = with_ranks(both, by, {"_rx": x, "_ry": y}).withColumn("_k", number("_key", seed)).drop(x, y)
    whole = ranked.groupBy(*by).agg(F.count("*").alias("_n"), F.avg("_rx").alias("_mx"), F.avg("_ry").alias("_my"), F.stddev_pop("_rx").alias("_sx"), F.stddev_pop("_ry").alias("_sy"))
    whole = whole.where((F.col("_n") >= least) & (F.col("_sx") > 0) & (F.col("_sy") > 0))
    # the pooled correlation of a replicate is a sum over rows of its rank of x times a number of the row, less a constant
    each = (F.col("_n") - 1) / (F.col("_sx") * F.col("_sy"))
    rows = ranked.join(whole, list(by)).withColumn("_w", F.col("_ry") * each / F.col("_n"))
    sums = _paired_sums(rows.where(F.col("_n") <= HELD), by, n, block)
    if any_large(both, by, HELD):
        large = rows.where(F.col("_n") > HELD)
        low, ties = F.col("_rx") - (F.col("_t") - 1) / 2.0, large.groupBy(*by, "_rx").agg(F.count("*").alias("_t"))
        items = ties.select(*by, F.col("_rx").alias("_got"), F.explode(F.sequence(F.round(low).cast("long"), F.round(low).cast("long") + F.col("_t") - 1)).alias("_place"))
        drawn = large.select(*by, "_key", "_k", "_w", "_n", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long"))).alias("replicate"))
        placed = hash_ranks(drawn.withColumn("_h", draw(F.col("_k"), F.col("replicate"))), ["replicate", *by], ["_h", "_key"], "_place", "_n")
        sums = sums.unionByName(placed.join(items, [*by, "_place"]).groupBy("replicate").agg(F.sum(F.col("_got") * F.col("_w")).alias("_x")))
    const = F.broadcast(whole.agg(F.sum(F.col("_mx") * F.col("_my") * each).alias("_c"), F.sum(F.col("_n") - 1).alias("_all")))  # one row
    pooled = sums.groupBy("replicate").agg(F.sum("_x").alias("_x")).crossJoin(const).select(((F.col("_x") - F.col("_c")) / F.col("_all")).alias("pooled_rho"))
    return permutation_p(pooled_rho(df, x, y, by, least=least), pooled, "pooled_rho", n)


def _with_delta(sums: DataFrame, sizes: DataFrame) -> DataFrame:
    """(replicate, delta) from each stratum's number of labelled rows (even places of sums) and the sum of their ranks."""
    long = sums.select("replicate", F.posexplode("sums").alias("i", "x")).groupBy("replicate", F.floor(F.col("i") / 2).alias("s")).agg(F.max(F.when(F.col("i") % 2 == 0, F.col("x"))).alias("n1"), F.max(F.when(F.col("i") % 2 == 1, F.col("x"))).alias("r"))
    n0 = F.col("size") - F.col("n1")
    wins = 2 * F.col("r") - F.col("n1") * (F.col("n1") + 1) - F.col("n1") * n0
    return long.join(sizes, "s").groupBy("replicate").agg((F.sum(wins) / F.nullif(F.sum(F.col("n1") * n0), F.lit(0.0))).alias("delta"))


def label_permutation(df: DataFrame, entity: str, value: str, label: str, strata: Sequence[str], n: int = 10_000, seed: int = 1, within: Sequence[str] = ()) -> DataFrame:
    """Cliff's delta counted inside strata (wins less losses over pairs), and its p when labels pass between entities, all of
    them or those of one group of `within`. An entity's label is one in all its rows; strata are few (years)."""
    there = df.where(F.col(value).isNotNull() & F.col(label).isNotNull()).select(*dict.fromkeys([*within, *strata]), entity, F.col(value).alias("_v"), F.col(label).alias("_l"))
    ranked = with_ranks(there, strata, {"_r": "_v"}).withColumn("_s", F.struct(*strata))
    sizes = ranked.groupBy("_s").agg(F.count("*").alias("size")).withColumn("s", (F.row_number().over(Window.orderBy("_s")) - 1).cast("long"))
    places = F.broadcast(sizes.agg(F.count("*").alias("_places")))  # one row
    own = ranked.join(sizes.select("_s", "s"), "_s").groupBy(*within, entity).agg(F.first("_l").alias("_l"), F.map_from_entries(F.collect_list(F.struct("s", "_r"))).alias("_m")).crossJoin(places)
    weight = F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_places") - 1), lambda s: F.array(F.when(F.map_contains_key("_m", s), 1.0).otherwise(0.0), F.coalesce(F.try_element_at("_m", s), F.lit(0.0)))))
    drawn = _with_delta(permuted_sums(own, within, entity, F.array(F.col("_l").cast("double")), weight, n, seed), sizes.select("s", "size"))
    return permutation_p(cliffs_delta(df, value, label, [], strata).select("delta"), drawn, "delta", n)


def cluster_permutation(df: DataFrame, cluster: str, period: str, label: str, flag: str, n: int = 10_000, seed: int = 1) -> DataFrame:
    """Does the flag go with the label? Whole label histories pass between clusters that have the same periods. Returns the
    difference of the flagged shares of labelled and other rows, and p."""
    rows = df.where(F.col(label).isNotNull()).select(cluster, period, F.col(label).cast("double").alias("_l"), F.coalesce(F.col(flag).cast("double"), F.lit(0.0)).alias("_f"))
    entry = F.array_sort(F.collect_list(F.struct(period, "_l", "_f")))
    history = rows.groupBy(cluster).agg(entry.alias("_h")).select(cluster, F.array_join(F.transform("_h", lambda h: h[period]), ",").alias("_pattern"), F.transform("_h", lambda h: h["_l"]).alias("_l"), F.transform("_h", lambda h: h["_f"]).alias("_f"))
    drawn = permuted_sums(history, ["_pattern"], cluster, F.col("_l"), F.col("_f"), n, seed, dot=True)
    totals = F.broadcast(rows.agg(F.sum("_l").alias("_n1"), F.sum(1 - F.col("_l")).alias("_n0"), F.sum("_f").alias("_all"), F.sum(F.col("_l") * F.col("_f")).alias("_seen")))  # one row
    gap = lambda dot: dot / F.nullif("_n1", F.lit(0.0)) - (F.col("_all") - dot) / F.nullif("_n0", F.lit(0.0))
    return permutation_p(totals.select(gap(F.col("_seen")).alias("difference")), drawn.crossJoin(totals).select(gap(F.get("sums", F.lit(0))).alias("difference")), "difference", n)


def cluster_bootstrap_share(df: DataFrame, cluster: str, flag: str, n: int = 10_000, seed: int = 1, level: float = 0.95) -> DataFrame:
    """Share of flagged rows with a percentile interval from drawing whole clusters; the two-sided p against one half (twice the
    smaller share of replicates on a side of it); the design effect (the share's variance over that of as many single rows; one
    where all rows agree) and how many independent rows the rows amount to."""
    sums = df.groupBy(cluster).agg(F.count_if(flag).alias("_k"), F.count("*").alias("_m"))
    share = F.get("sums", F.lit(0)) / F.nullif(F.get("sums", F.lit(1)), F.lit(0.0))
    shares = bootstrap_sums(sums, [cluster], [F.col("_k"), F.col("_m")], n, seed).select(share.alias("_s"))
    side = shares.agg(F.avg(F.when(F.col("_s") <= 0.5, 1.0).when(F.col("_s").isNotNull(), 0.0)).alias("_under"), F.avg(F.when(F.col("_s") >= 0.5, 1.0).when(F.col("_s").isNotNull(), 0.0)).alias("_over"))
    seen = sums.agg((F.sum("_k") / F.sum("_m")).alias("share"), F.sum("_m").alias("n_rows"), F.count("*").alias("n_clusters"))
    out = seen.crossJoin(F.broadcast(percentile_ends(shares, "_s", level))).crossJoin(F.broadcast(side))  # one row each
    single = F.col("share") * (1 - F.col("share")) / F.col("n_rows")
    effect = F.when(single > 0, F.col("variance") / single).otherwise(1.0)
    p = F.least(F.lit(1.0), 2 * F.least("_under", "_over"))
    return out.select("share", "n_rows", "n_clusters", "low", "high", p.alias("p"), effect.alias("design_effect"), F.greatest(F.lit(1), F.round(F.col("n_rows") / F.greatest(effect, F.lit(1.0)))).cast("long").alias("n_effective"))


def _ordered(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """rows in ranges of (by, value), each a part; kept as a table, as both passes over it need the same ranges."""
    spark = rows.sparkSession
    path = workspace(spark)
    rows.repartitionByRange(*by, value).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(StructType([*rows.schema.fields, StructField("_part", IntegerType())])).parquet(path)


def _segments(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows with equal keys, as they come."""
    for b in batches:
        own = list(zip(*(b.column(c).to_pylist() for c in keys), strict=True))
        cut = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1]), len(own)]
        for i, j in zip(cut[:-1], cut[1:], strict=True):
            if j > i:
                yield own[i], b.slice(i, j - i)


def _pieces(column: pa.Array, size: int) -> Iterator[slice]:
    for i in range(0, len(column), size):
        yield slice(i, i + size)


def _fields(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)


def bootstrap_delta(df: DataFrame, entity: str, value: str, label: str, strata: Sequence[str], n: int = 10_000, seed: int = 1, level: float = 0.95) -> DataFrame:
    """Cliff's delta counted inside strata, with a percentile interval from drawing entities anew by Poisson weights.

    Wins are counted along each stratum's values: a task passes over its range of values with a number of drawn rows for each
    replicate; ranges are then joined by their totals. What leaves a task doesn't depend on how many rows its range has.
    """
    some = df.where(F.col(value).isNotNull() & F.col(label).isNotNull()).select(*strata, F.col(value).alias("_v"), F.col(label).alias("_l"), number(entity, seed).alias("_k"))
    keys = [*strata, "_part"]
    ranged = _ordered(some, strata, "_v").repartition(*keys).sortWithinPartitions(*keys, "_v").select(*keys, "_v", "_l", "_k")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(schema)
        now = one = none = wins = tie_one = tie_none = last = None

        def close_tie():
            nonlocal one, none, wins
            wins += tie_one * (none + tie_none / 2)
            one, none = one + tie_one, none + tie_none

        def told():
            close_tie()
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, (*now, one.tolist(), none.tolist(), wins.tolist()), strict=True))], kind)

        for key, b in _segments(batches, keys):
            if key != now:
                if now is not None:
                    yield from told()
                now, last = key, None
                one, none, wins, tie_one, tie_none = (np.zeros(n) for _ in range(5))
            v, l, k = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_v", "_l", "_k"))
            for at in _pieces(b.column("_v"), 256):
                ties = np.flatnonzero(np.r_[True, v[at][1:] != v[at][:-1]])
                counts = np.empty((n, 2, len(ties)))
                for first, last_r in _chunks(n, len(v[at])):
                    w = poisson(draws(k[at], first, last_r))
                    counts[first - 1 : last_r - 1, 0] = np.add.reduceat(w * l[at], ties, axis=1)
                    counts[first - 1 : last_r - 1, 1] = np.add.reduceat(w * ~l[at].astype(bool), ties, axis=1)
                for c, t in enumerate(ties):
                    if last is not None and v[at][t] != last:
                        close_tie()
                        tie_one, tie_none = np.zeros(n), np.zeros(n)
                    tie_one, tie_none, last = tie_one + counts[:, 0, c], tie_none + counts[:, 1, c], v[at][t]
        if now is not None:
            yield from told()

    made = _fields(ranged, keys) + ", one array<double>, none array<double>, wins array<double>"
    schema = StructType.fromDDL(made)
    parts = ranged.mapInArrow(run, made)
    long = parts.select(*keys, F.posexplode(F.arrays_zip("one", "none", "wins")).alias("replicate", "x")).select(*keys, "replicate", "x.*")
    below = F.coalesce(F.sum("none").over(Window.partitionBy(*strata, "replicate").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    sums = long.withColumn("u", F.col("wins") + F.col("one") * below).groupBy(*strata, "replicate").agg(F.sum("u").alias("u"), F.sum("one").alias("n1"), F.sum("none").alias("n0"))
    pairs = F.col("n1") * F.col("n0")
    deltas = sums.groupBy("replicate").agg((F.sum(2 * F.col("u") - pairs) / F.nullif(F.sum(pairs), F.lit(0.0))).alias("_d"))
    return cliffs_delta(df, value, label, [], strata).select("delta").crossJoin(F.broadcast(percentile_ends(deltas, "_d", level).drop("variance")))  # one row


def bootstrap_median(df: DataFrame, value: str, by: Sequence[str], key: Sequence[str], n: int = 10_000, seed: int = 1, level: float = 0.95) -> DataFrame:
    """Median of each group with a percentile interval from drawing its rows anew by Poisson weights.

    Rows lie in ranges of values. A first pass adds up each range's drawn rows; a second one starts each range with the
    totals of those before it, and a replicate's median is told by the ranges in which half of its rows are reached.
    """
    some = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"), number(key[0], seed, *key[1:]).alias("_k"))
    keys = [*by, "_part"]
    ranged = _ordered(some, by, "_v")

    def totals(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kind, now, sums = to_arrow_schema(schema), None, np.zeros(n)
        told = lambda: pa.RecordBatch.from_pylist([dict(zip(kind.names, (*now, sums.tolist()), strict=True))], kind)
        for group, b in _segments(batches, keys):
            if group != now:
                if now is not None:
                    yield told()
                now, sums = group, np.zeros(n)
            k = b.column("_k").to_numpy()
            for first, last in _chunks(n, len(k)):
                sums[first - 1 : last - 1] += poisson(draws(k, first, last)).sum(axis=1)
        if now is not None:
            yield told()

    schema = StructType.fromDDL(_fields(ranged, keys) + ", drawn array<double>")
    parts = ranged.select(*keys, "_v", "_k").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(totals, schema)
    long = parts.select(*keys, F.posexplode("drawn").alias("replicate", "x"))
    w = Window.partitionBy(*by, "replicate")
    before = F.coalesce(F.sum("x").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    starts = long.select(*keys, "replicate", before.alias("before"), F.sum("x").over(w).alias("total")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("replicate", "before", "total"))).alias("s"))
    heads = starts.select(*keys, F.lit(0).alias("_row"), F.transform("s", lambda s: s["before"]).alias("before"), F.transform("s", lambda s: s["total"]).alias("total"))
    both = heads.unionByName(ranged.select(*keys, "_v", "_k").withColumn("_row", F.lit(1)), allowMissingColumns=True)
    both = both.repartition(*keys).sortWithinPartitions(*keys, "_row", "_v").select(*keys, "_row", "before", "total", "_v", "_k")

    def cross(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kind, reached, marks = to_arrow_schema(found), None, None
        for group, b in _segments(batches, keys):
            rows = b
            if b.column("_row")[0].as_py() == 0:
                reached, total = np.array(b.column("before")[0].as_py()), np.array(b.column("total")[0].as_py())
                marks = (np.floor((total + 1) / 2), np.ceil((total + 1) / 2))
                rows = b.slice(1)
            v, k = rows.column("_v").to_numpy(zero_copy_only=False), rows.column("_k").to_numpy(zero_copy_only=False).astype(np.int64)
            for at in _pieces(rows.column("_v"), 256):
                out = []
                for first, last in _chunks(n, len(v[at])):
                    own = slice(first - 1, last - 1)
                    upto = reached[own, None] + np.cumsum(poisson(draws(k[at], first, last)), axis=1)
                    for mark in marks:
                        hit = (upto >= mark[own, None]) & (total[own, None] > 0)
                        some = np.flatnonzero((reached[own] < mark[own]) & hit.any(axis=1))
                        out += zip((some + first).tolist(), v[at][hit[some].argmax(axis=1)].tolist(), strict=True)
                    reached[own] = upto[:, -1]
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(kind.names, (*group[:-1], r, x), strict=True)) for r, x in out], kind)

    found = StructType.fromDDL(", ".join([*([_fields(ranged, by)] if by else []), "replicate long", "x double"]))
    medians = both.mapInArrow(cross, found).groupBy(*by, "replicate").agg(F.avg("x").alias("_m"))
    ends = medians.groupBy(*by).agg(F.percentile("_m", F.array(F.lit((1 - level) / 2), F.lit((1 + level) / 2))).alias("_e"))
    seen = some.groupBy(*by).agg(F.count("*").alias("n"), F.median("_v").alias("median"))
    joined = seen.join(ends, list(by), "left") if by else seen.crossJoin(F.broadcast(ends))
    return joined.select(*by, "n", "median", F.get("_e", F.lit(0)).alias("low"), F.get("_e", F.lit(1)).alias("high"))


def _weighted_ranks(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Average ranks of each replicate's drawn rows: w is replicates by rows."""
    _, tie = np.unique(v, return_inverse=True)
    order = np.argsort(tie, kind="stable")
    drawn = np.add.reduceat(w[:, order], np.flatnonzero(np.r_[True, np.diff(tie[order]) > 0]), axis=1)
    return (np.cumsum(drawn, axis=1) - drawn + (drawn + 1) / 2)[:, tie]


def _weighted_rho(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rank correlation of each replicate's drawn rows; nan where one of both is flat."""
    rx, ry, total = _weighted_ranks(x, w), _weighted_ranks(y, w), w.sum(axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        dx, dy = rx - (w * rx).sum(axis=1, keepdims=True) / total, ry - (w * ry).sum(axis=1, keepdims=True) / total
        vx, vy = (w * dx * dx).sum(axis=1), (w * dy * dy).sum(axis=1)
        return np.where((vx > 1e-9) & (vy > 1e-9), (w * dx * dy).sum(axis=1) / np.sqrt(vx * vy), np.nan)


def bootstrap_pooled_rho(df: DataFrame, x: str, y: str, by: Sequence[str], key: str, n: int = 10_000, seed: int = 1, level: float = 0.95, least: int = 5, block: int = 1000, tries: int = 200) -> DataFrame:
    """The pooled rank correlation with a percentile interval from drawing each group's rows anew; a group whose drawn rows are
    flat is drawn again (at most `tries` times), and how often is told.

    Ranks of drawn rows need the whole group, so a task holds one group and `block` replicates of it; a group is copied once
    for each block, not for each replicate.
    """
    some = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), number(key, seed).alias("_k"))
    fit = spearman(df, x, y, by).where((F.col("n") >= least) & F.col("rho").isNotNull()).select(*by)
    blocks = F.explode(F.sequence(F.lit(0), F.lit((n - 1) // block))).alias("_block")
    rows = some.join(fit, list(by)).select(F.to_json(F.struct(*by)).alias("_g"), "_x", "_y", "_k", blocks)

    def run(frame):
        import pandas as pd

        frame = frame.sort_values("_k")
        v, u, k, start = frame["_x"].to_numpy(), frame["_y"].to_numpy(), frame["_k"].to_numpy(), int(frame["_block"].iloc[0]) * block
        todo, rho, again = np.arange(start + 1, min(start + block, n) + 1), np.full(block, np.nan), 0
        for attempt in range(tries):
            left = todo[np.isnan(rho[todo - start - 1])]
            if not len(left):
                break
            again += len(left) if attempt else 0
            for i in range(0, len(left), max(1, CELLS // len(k))):
                r = left[i : i + max(1, CELLS // len(k))]
                rho[r - start - 1] = _weighted_rho(v, u, poisson(draw(k[None, :], (r + attempt * n)[:, None])))
        return pd.DataFrame({"replicate": todo, "rho": rho[: len(todo)], "n": len(k), "redraws": np.where(np.arange(len(todo)) == 0, again, 0)})

    drawn = rows.groupBy("_g", "_block").applyInPandas(run, "replicate long, rho double, n long, redraws long")
    known = drawn.where(~F.isnan("rho"))
    pooled = known.groupBy("replicate").agg((F.sum(F.col("rho") * (F.col("n") - 1)) / F.sum(F.col("n") - 1)).alias("_r"))
    out = pooled_rho(df, x, y, by, least=least).crossJoin(F.broadcast(percentile_ends(pooled, "_r", level).drop("variance")))  # one row
    return out.crossJoin(F.broadcast(drawn.agg(F.sum("redraws").alias("redraws"))))
