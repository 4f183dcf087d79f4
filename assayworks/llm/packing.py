"""Packing of pieces into sequences by a configuration linear program over the length histogram."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import free_name, running, written

ROUNDS = 150
LEARNING = 12.0
NEAR_BEST = 0.02
SLACK = 0.002
LAST_SLACKS = (0.0, 0.2)
FEW, MANY = 50, 500_000

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


def priced(prices: np.ndarray, capacity: int, rng: np.random.Generator | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack by dynamic programming: the best value for each capacity, and a length that attains it (0: none).

    Of equal values the longest length is picked, or with ``rng`` a random one, rather a long one.
    """
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(prices > 0)
    worth = prices[lengths]
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        n = upto[c]
        best[c] = best[c - 1]
        if n:
            value = best[c - lengths[:n]] + worth[:n]
            tied = value if rng is None else value + lengths[:n] * rng.random(n) * (1e-7 * value[-1])
            k = n - 1 - int(tied[::-1].argmax())
            if value[k] > best[c]:
                best[c], pick[c] = value[k], lengths[k]
    return best, pick


def _filled(anchor: int, pick: np.ndarray, capacity: int) -> Pattern:
    counts: dict[int, int] = {anchor: 1}
    room = capacity - anchor
    while room > 0:
        length = int(pick[room])
        if length == 0:
            room -= 1
            continue
        counts[length] = counts.get(length, 0) + 1
        room -= length
    return tuple(sorted(counts.items(), reverse=True))


def learned(need: np.ndarray, capacity: int, rounds: int = ROUNDS, seed: int = 1) -> tuple[dict[Pattern, float], np.ndarray]:
    """A near-optimal solution of the program, and prices: min sum x, each length covered as often as needed.

    Multiplicative weights: the price of a length starts at its size and falls with the share of its
    pieces that is covered. In each round the knapsack prices the patterns; for every length the best
    pattern that holds it is taken, if its value comes near the best of all, as far as the round's
    part of the need goes. The prices are averaged over the later rounds.
    """
    lengths = np.flatnonzero(need > 0)
    covered = np.zeros(capacity + 1)
    prices, logs = np.zeros(capacity + 1), np.zeros(len(lengths))
    x: dict[Pattern, float] = defaultdict(float)
    for t in range(1, rounds + 1):
        lag = np.clip(covered[lengths] / need[lengths] - (t - 1) / rounds, -1, 1)
        prices[lengths] = lengths * np.exp(-LEARNING * lag)
        if t > rounds // 2:
            logs += np.log(prices[lengths])
        best, pick = priced(prices, capacity)
        quota = need * (t / rounds) - covered
        for anchor in lengths[np.argsort(quota[lengths] * -lengths)]:
            if quota[anchor] <= 0 or prices[anchor] + best[capacity - anchor] < (1 - NEAR_BEST) * best[capacity]:
                continue
            pattern = _filled(int(anchor), pick, capacity)
            amount = min(max(quota[n], 0.25 * need[n] / rounds) / k for n, k in pattern)
            x[pattern] += amount
            for n, k in pattern:
                covered[n] += k * amount
                quota[n] -= k * amount
    prices[lengths] = np.exp(logs / max(1, rounds - rounds // 2))
    return x, prices


def lower_bound(need: np.ndarray, prices: np.ndarray, capacity: int) -> int:
    """No plan has fewer sequences: the value of the need at prices that no pattern exceeds."""
    best, _ = priced(prices, capacity)
    return int(np.ceil(need @ prices / best[capacity] - 1e-6)) if best[capacity] else 0


@dataclass
class Plan:
    """Patterns with the number of sequences each fills."""

    capacity: int
    fills: dict[Pattern, int] = field(default_factory=lambda: defaultdict(int))

    @property
    def sequences(self) -> int:
        return sum(self.fills.values())

    def slots(self) -> dict[int, np.ndarray]:
        """By length: rows of (first rank, copies in a sequence, first sequence, offset there), by first rank."""
        taken: dict[int, int] = defaultdict(int)
        rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        sequence = 0
        for pattern, fills in sorted(self.fills.items(), reverse=True):
            offset = 0
            for length, copies in pattern:
                rows[length].append((taken[length], copies, sequence, offset))
                taken[length] += copies * fills
                offset += length * copies
            sequence += fills
        return {length: np.array(r, np.int64) for length, r in rows.items()}


def best_fit(need: np.ndarray, capacity: int, plan: Plan) -> None:
    """What rounding leaves, longest first, each piece into the fullest open sequence that takes it."""
    spaces: dict[int, list[list[int]]] = defaultdict(list)
    open_spaces = 0  # bit r: some sequence has room r
    for length in np.flatnonzero(need)[::-1]:
        for _ in range(int(need[length])):
            fitting = open_spaces >> int(length)
            if fitting:
                room = int(length) + (fitting & -fitting).bit_length() - 1
                held = spaces[room].pop()
                if not spaces[room]:
                    open_spaces &= ~(1 << room)
            else:
                room, held = capacity, []
            held.append(int(length))
            rest = room - int(length)
            spaces[rest].append(held)
            open_spaces |= 1 << rest
            if rest == 0:
                open_spaces &= ~1
    for groups in spaces.values():
        for held in groups:
            counts = defaultdict(int)
            for length in held:
                counts[length] += 1
            plan.fills[tuple(sorted(counts.items(), reverse=True))] += 1


def rounded(need: np.ndarray, capacity: int, x: dict[Pattern, float], prices: np.ndarray,
            last: float) -> Plan:
    """Whole sequences: the whole parts of x, then patterns of nearly the best price for what is left, then best fit.

    Patterns fall short of the best price by ``last`` at most, or more while over MANY pieces are left.
    """
    plan, need = Plan(capacity), need.copy()
    best, _ = priced(prices, capacity)

    def take(pattern: Pattern, most: int) -> None:
        fills = min(most, *(int(need[n]) // k for n, k in pattern), 1 << 62)
        if fills > 0:
            plan.fills[pattern] += fills
            for n, k in pattern:
                need[n] -= k * fills

    for pattern, amount in sorted(x.items()):
        if sum(prices[n] * k for n, k in pattern) >= (1 - SLACK) * best[capacity]:
            take(pattern, int(amount))
    slack, again, rng = 0.0, 0, np.random.default_rng(0)
    while need.sum() > (FEW if slack <= last else MANY):
        left = np.flatnonzero(need)
        now = np.zeros(capacity + 1)
        now[left] = prices[left]
        best, pick = priced(now, capacity, rng if again else None)
        again += 1
        before = int(need.sum())
        for anchor in left[::-1]:
            least = (1 - slack - 1e-9) * best[capacity]
            if need[anchor] and now[anchor] + best[capacity - anchor] >= least:
                there = [(n, min(k, int(need[n]))) for n, k in _filled(int(anchor), pick, capacity)]
                if sum(now[n] * k for n, k in there) >= least:
                    take(tuple((n, k) for n, k in there if k), int(need[anchor]))
        if (before - int(need.sum())) * 500 < before:
            slack = min(1.0, slack * 1.5 + 0.0005)
    best_fit(need, capacity, plan)
    return plan


def _fewest(need: np.ndarray, capacity: int, x: dict[Pattern, float], prices: np.ndarray) -> Plan:
    plans = [rounded(need, capacity, x, prices, last) for last in LAST_SLACKS]
    return min(plans, key=lambda p: p.sequences)


def solve(histogram: dict[int, int], capacity: int) -> Plan:
    """A plan for all pieces of a length histogram. Its work and size depend on the capacity, not on the counts.

    Rounded at the prices that the weights start from and at those they have learned, each with patterns
    of the best price only and with cheaper ones; the plan with fewest sequences is returned.
    """
    need = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        need[length] = count
    whole, need[capacity] = int(need[capacity]), 0
    plan = Plan(capacity)
    if need.sum():
        sizes = np.where(need > 0, np.arange(capacity + 1), 0).astype(float)
        plan = _fewest(need, capacity, {}, sizes)
        if plan.sequences > lower_bound(need, sizes, capacity):
            x, prices = learned(need.astype(float), capacity)
            plan = min(plan, _fewest(need, capacity, x, prices), key=lambda p: p.sequences)
    if whole:
        plan.fills[((capacity, 1),)] = whole
    return plan


def pack(pieces: DataFrame, length: str, capacity: int) -> DataFrame:
    """Adds sequence_id and offset: every piece has its place, no sequence holds more than ``capacity``.

    Offsets in a sequence are gapless from 0. Lengths are 1 to ``capacity``; another length, also NULL, is an
    error, as leaving a piece out would lose data. All columns are kept; repeated rows are pieces of their own. An empty
    table gives no rows. The driver holds the histogram and the plan, whose size depends
    on the capacity. Ranks within a length are counted in task-sized buckets, so a
    frequent length does not meet in one task.
    """
    key, rank, place = (free_name(pieces, x) for x in ("key", "rank", "place"))
    table = written(pieces.withColumn(key, F.monotonically_increasing_id()), "pieces")
    histogram = {row[0]: row[1] for row in table.groupBy(length).count().collect()}
    wrong = [n for n in histogram if n is None or not 0 < n <= capacity]
    if wrong:
        raise ValueError(f"lengths outside 1 to {capacity}: {wrong[:5]}")
    slots = solve(histogram, capacity).slots()

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def placed(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths.to_numpy(), kind="stable")
        n, r = lengths.to_numpy()[order], ranks.to_numpy()[order]
        for low, high in zip(*_runs(n), strict=True):
            rows = slots[int(n[low])]
            at = rows[np.searchsorted(rows[:, 0], r[low:high], "right") - 1]
            step = r[low:high] - at[:, 0]
            sequence[order[low:high]] = at[:, 2] + step // at[:, 1]
            offset[order[low:high]] = at[:, 3] + step % at[:, 1] * n[low]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = running(table, [length], key, F.lit(1), rank, sum(histogram.values()))
    return ranked.withColumn(place, placed(F.col(length), F.col(rank))).select(
        *pieces.columns, F.col(place)["sequence_id"].alias("sequence_id"), F.col(place)["offset"].alias("offset"))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return starts, np.r_[starts[1:], len(values)] if len(values) else starts
