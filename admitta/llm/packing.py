"""Filling containers of fixed capacity (problem 6).

The instance is held as a histogram of sizes (at most one entry per size up to the capacity, however
many documents there are). A dominance reduction fixes containers that some optimal packing can be
made to contain, which shrinks the histogram; the rest is packed by best fit, largest sizes first.
The result is a list of slots: for a size and a range of ranks, the containers they go to. Each piece
then finds its container from its rank among the pieces of its size.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitta.llm.tokens import VOCABULARY, sized_documents
from admitta.operators.ranking import salted_rank
from admitta.session import materialize
from admitta.sources.tables import table

#: Pieces of one size in one rank cell, about.
CELL_ROWS = 200_000


class Histogram:
    """Counts by size, with the sizes present kept sorted."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        left = self.count[size] - n
        if left < 0:
            raise ValueError(f"{n} of size {size} taken, {left + n} there")
        if left:
            self.count[size] = left
        else:
            del self.count[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def others(self, size: int, but: int) -> int:
        """Items of a size, not counting one item of size ``but``."""
        return self.count.get(size, 0) - (size == but)

    def smallest(self, k: int, but: int, above: int = 0) -> list[int]:
        """The k smallest items larger than ``above``, not counting one item of size ``but``."""
        out: list[int] = []
        at = bisect_right(self.sizes, above)
        while at < len(self.sizes) and len(out) < k:
            s = self.sizes[at]
            out += [s] * min(k - len(out), self.others(s, but))
            at += 1
        return out

    def largest_fitting(self, room: int, but: int) -> int:
        at = bisect_right(self.sizes, room) - 1
        while at >= 0 and not self.others(self.sizes[at], but):
            at -= 1
        return self.sizes[at] if at >= 0 else 0

    def best_pair(self, room: int, but: int) -> tuple[int, int] | None:
        """Sizes a >= b of two items whose sum is the largest within ``room``."""
        best, hi = None, bisect_right(self.sizes, room) - 1
        lo = 0
        while lo <= hi:
            b, a = self.sizes[lo], self.sizes[hi]
            if not self.others(b, but):
                lo += 1
            elif not self.others(a, but):
                hi -= 1
            elif a + b > room:
                hi -= 1
            else:
                if (lo < hi or self.others(a, but) > 1) and (best is None or a + b > sum(best)):
                    best = (a, b)
                lo += 1
        return best


def dominating_set(h: Histogram, j: int, capacity: int) -> tuple[int, ...] | None:
    """Sizes, starting with ``j``, of a container that dominates every other one holding an item of size j."""
    low = h.smallest(3, j)
    sums = [j + sum(low[: i + 1]) for i in range(len(low))]
    k = sum(s <= capacity for s in sums)
    if k == 0:
        return (j,)
    fits = h.largest_fitting(capacity - j, j)
    if k == 1 or j + fits == capacity:
        return (j, fits)
    if k == 2:
        pair = h.best_pair(capacity - j, j)
        if pair is None or fits >= sum(pair):
            return (j, fits)
        a, b = pair
        if fits == a:
            between = h.smallest(2, j, above=b)
            between = [s for s in between if s < a]
            if len(between) < 2 or j + sum(between) > capacity:
                return (j, a, b)
    return None


def reduce_dominated(h: Histogram, capacity: int) -> Iterable[tuple[tuple[int, ...], int]]:
    """Containers to fix, as (sizes, how many), until no size has a dominating set.

    Taking a container away only removes items, so a set that dominates stays dominating while its
    items last, and all copies can be fixed at once.
    """
    changed = True
    while changed:
        changed = False
        for j in reversed(list(h.sizes)):
            while j in h.count:
                found = dominating_set(h, j, capacity)
                if found is None:
                    break
                times = min(h.count[s] // found.count(s) for s in set(found))
                for s in found:
                    h.take(s, times)
                changed = True
                yield found, times


@dataclass
class Packing:
    """Slots (size, rank_from, per_container, container_from, containers) and the room left by container range."""

    capacity: int
    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    fixed: int = 0
    containers: int = 0
    room: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    used: dict[int, int] = field(default_factory=dict)

    def put(self, size: int, per: int, first: int, n: int) -> None:
        at = self.used.get(size, 0)
        self.slots.append((size, at, per, first, n))
        self.used[size] = at + per * n

    def open(self, n: int) -> int:
        self.containers += n
        return self.containers - n


def best_fit(h: Histogram, p: Packing) -> None:
    """Largest sizes first, each into the open container with the least room that suffices.

    A container keeps being the best one until the size no longer fits, so equal containers are
    filled together; ``p.room`` holds ranges of open containers by room.
    """
    rooms = sorted(p.room)
    for size in reversed(list(h.sizes)):
        n = h.count[size]
        at = bisect_left(rooms, size)
        while n and at < len(rooms):
            room = rooms[at]
            per, ranges = room // size, p.room[room]
            while n and ranges:
                first, there = ranges.pop()
                full = min(there, n // per)
                if full:
                    p.put(size, per, first, full)
                    n -= per * full
                    _add(p, rooms, room - per * size, first, full)
                    first, there = first + full, there - full
                if there and 0 < n < per:
                    p.put(size, n, first, 1)
                    _add(p, rooms, room - n * size, first, 1)
                    first, there, n = first + 1, there - 1, 0
                if there:
                    ranges.append((first, there))
            if not ranges:
                del p.room[room]
                rooms.pop(bisect_left(rooms, room))
            at = bisect_left(rooms, size)
        if n:
            per = p.capacity // size
            if n // per:
                first = p.open(n // per)
                p.put(size, per, first, n // per)
                _add(p, rooms, p.capacity - per * size, first, n // per)
            if n % per:
                first = p.open(1)
                p.put(size, n % per, first, 1)
                _add(p, rooms, p.capacity - n % per * size, first, 1)


def _add(p: Packing, rooms: list[int], room: int, first: int, n: int) -> None:
    if room not in p.room:
        p.room[room] = []
        insort(rooms, room)
    p.room[room].append((first, n))


def pack(counts: dict[int, int], capacity: int) -> Packing:
    """Pack a histogram of sizes (1 to capacity)."""
    if any(not 0 < s <= capacity for s in counts):
        raise ValueError("sizes must lie between 1 and the capacity")
    h, p = Histogram(counts), Packing(capacity)
    for sizes, times in reduce_dominated(h, capacity):
        first = p.open(times)
        for s in sorted(set(sizes), reverse=True):
            p.put(s, sizes.count(s), first, times)
        p.room.setdefault(capacity - sum(sizes), []).append((first, times))
    closed, p.room, p.fixed = p.room, {}, p.containers
    best_fit(h, p)
    for room, ranges in closed.items():
        p.room.setdefault(room, []).extend(ranges)
    return p


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer containers: total size, and items of which no two share one."""
    return max(-(-sum(s * n for s, n in counts.items()) // capacity), sum(n for s, n in counts.items() if 2 * s > capacity))


def pieces(sized: DataFrame, budgets: list[tuple[int, int]]) -> DataFrame:
    """One row per budget and piece: whole documents, or runs of ``capacity`` tokens of those too long.

    A document of no tokens is one piece of size 0.
    """
    each = F.explode(F.array(*(F.struct(F.lit(b).alias("budget_id"), F.lit(c).alias("capacity")) for b, c in budgets)))
    wide = sized.select("doc_id", "n_tokens", each.alias("_b")).select("doc_id", "n_tokens", "_b.*")
    n = F.greatest(F.ceil(F.col("n_tokens") / F.col("capacity")), F.lit(1)).cast("int")
    wide = wide.withColumn("piece_no", F.explode(F.sequence(F.lit(0), n - 1)))
    start = F.col("piece_no") * F.col("capacity").cast("long")
    return wide.select("budget_id", "doc_id", "piece_no", start.alias("token_from"), F.least(F.col("n_tokens") - start, F.col("capacity").cast("long")).cast("int").alias("size"))


def budget_list(budgets: DataFrame) -> list[tuple[int, int]]:
    """(budget_id, capacity) by id; rows without a positive capacity are left out, repeated ids keep the smallest.

    A parameter table, refused beyond 1,000 rows.
    """
    rows = budgets.where(F.col("budget_id").isNotNull() & (F.col("capacity_tokens") > 0)).groupBy("budget_id").agg(F.min("capacity_tokens").alias("c")).limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1,000 budgets")
    return sorted((r[0], r[1]) for r in rows)


@dataclass
class Plan:
    """The packings of all budgets, and the pieces they were made from."""

    items: DataFrame
    total: int
    packings: dict[int, Packing]
    counts: dict[int, dict[int, int]]


def plan_containers(documents: DataFrame, budgets: DataFrame, vocabulary: str = VOCABULARY) -> Plan:
    listed = budget_list(budgets)
    sized = materialize(sized_documents(documents, ["doc_id"], vocabulary))
    if not listed:
        listed_items = sized.sparkSession.createDataFrame([], "budget_id int, doc_id bigint, piece_no int, token_from bigint, size int")
        return Plan(listed_items, 0, {}, {})
    items = pieces(sized, listed)
    counts: dict[int, dict[int, int]] = {b: {} for b, _ in listed}
    for r in items.where("size > 0").groupBy("budget_id", "size").count().collect():  # at most one row per budget and size
        counts[r[0]][r[1]] = r[2]
    total = sum(sum(c.values()) for c in counts.values())
    return Plan(items, total, {b: pack(counts[b], c) for b, c in listed}, counts)


class _Places:
    """The slots of one packing as sorted arrays: sizes, the stretch of slots of each size, and the rooms left."""

    def __init__(self, packing: Packing):
        slots = np.array(sorted((size, at, per, first) for size, at, per, first, _ in packing.slots), dtype="int64").reshape(-1, 4)
        self.size, self.at, self.per, self.first = slots.T
        rooms = np.array(sorted((first, room) for room, ranges in packing.room.items() for first, n in ranges if n), dtype="int64").reshape(-1, 2)
        self.from_container, self.room = rooms.T

    def of(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Container and room left there of pieces by their rank among equal sizes; each size is searched in its own slots."""
        number = np.zeros(len(size), dtype="int64")
        order = np.argsort(size, kind="stable")
        kinds, begins = np.unique(size[order], return_index=True)
        for one, rows in zip(kinds, np.split(order, begins[1:])):
            low, high = np.searchsorted(self.size, [one, one + 1])
            slot = low + np.searchsorted(self.at[low:high], rank[rows], side="right") - 1
            number[rows] = self.first[slot] + (rank[rows] - self.at[slot]) // self.per[slot]
        return number, self.room[np.searchsorted(self.from_container, number, side="right") - 1]


def assign(plan: Plan) -> DataFrame:
    """(budget_id, doc_id, piece_no, token_from, n_tokens, container_id, unused_tokens).

    ``unused_tokens`` is the space left in that container. Documents of no tokens take no space and
    get a null container.
    """
    tables = {b: _Places(p) for b, p in plan.packings.items()}

    @F.pandas_udf("container long, unused long")
    def container(budget: pd.Series, size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        b, s, r = budget.to_numpy(), size.to_numpy(), rank.to_numpy()
        number, left = np.zeros(len(b), dtype="int64"), np.zeros(len(b), dtype="int64")
        for one in np.unique(b):
            rows = b == one
            number[rows], left[rows] = tables[one].of(s[rows], r[rows])
        return pd.DataFrame({"container": number, "unused": left})

    cells = max(1, plan.total // CELL_ROWS + 1)
    some = plan.items.where("size > 0").withColumn("_cell", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(cells)))
    ranked = salted_rank(some, ["budget_id", "size"], ["_cell"], ["doc_id", "piece_no"])
    put = ranked.withColumn("_c", container("budget_id", "size", "rank0"))
    out = put.select("budget_id", "doc_id", "piece_no", "token_from", F.col("size").alias("n_tokens"), F.col("_c.container").alias("container_id"), F.col("_c.unused").alias("unused_tokens"))
    none = plan.items.where("size <= 0").select("budget_id", "doc_id", "piece_no", "token_from", F.col("size").alias("n_tokens"), F.lit(None).cast("long").alias("container_id"), F.lit(None).cast("long").alias("unused_tokens"))
    return out.unionByName(none)


def report(plan: Plan, spark: SparkSession) -> DataFrame:
    """Per budget: containers, those fixed by dominance, the lower bound, tokens and unused space."""
    rows = []
    for b, p in sorted(plan.packings.items()):
        tokens = sum(s * n for s, n in plan.counts[b].items())
        rows.append((b, p.capacity, sum(plan.counts[b].values()), p.containers, p.fixed, lower_bound(plan.counts[b], p.capacity), tokens, p.containers * p.capacity - tokens))
    return spark.createDataFrame(rows, "budget_id int, capacity_tokens int, pieces long, containers long, fixed_containers long, lower_bound long, tokens long, unused_tokens long")


def p6_containers(spark: SparkSession, folder: str) -> DataFrame:
    return assign(plan_containers(table(spark, folder, "documents"), table(spark, folder, "token_budgets")))


def p6_report(spark: SparkSession, folder: str) -> DataFrame:
    return report(plan_containers(table(spark, folder, "documents"), table(spark, folder, "token_budgets")), spark)


QUERIES = {"p6_containers": p6_containers, "p6_report": p6_report}
SQL: dict[str, str] = {}
