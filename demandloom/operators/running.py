"""Order statistics of all values of a key before each day, in one pass over the key's days.

Values are kept in order in short blocks with their sums. A day's value is put in its place and a rank is looked up in a
time that hardly grows with the days, where a growing window frame would sort them again for every day.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from fractions import Fraction
from math import isfinite, isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.windows import by_key

BLOCK = 512
#: Factor of a median deviation that makes it comparable to a standard deviation.
NORMAL = 1.4826
#: Part of a limit within which rounding may decide a comparison with it.
NEAR = 1e-12
#: What can be asked for, with the types.
STATISTICS = {"qty_all_mode": "double", "qty_all_median": "double", "gap_median": "double", "gap_mode": "int", "n_spikes": "int", "qty_mean_ad": "double", "qty_median_ad": "double"}


class Ordered:
    """Numbers in order, in blocks of at most 2 * BLOCK."""

    def __init__(self) -> None:
        self.blocks: list[list[float]] = [[]]
        self.sums, self.n, self.total = [0.0], 0, 0.0

    def add(self, x: float) -> None:
        k = 0
        if len(self.blocks) > 1:
            while k + 1 < len(self.blocks) and self.blocks[k][-1] < x:
                k += 1
        block = self.blocks[k]
        insort(block, x)
        self.sums[k] += x
        self.n += 1
        self.total += x
        if len(block) > 2 * BLOCK:
            self.blocks[k : k + 1] = [block[:BLOCK], block[BLOCK:]]
            self.sums[k : k + 1] = [sum(block[:BLOCK]), sum(block[BLOCK:])]

    def at(self, rank: int) -> float:
        for block in self.blocks:
            if rank < len(block):
                return block[rank]
            rank -= len(block)
        raise IndexError(rank)

    def below(self, x: float) -> tuple[int, float]:
        """How many numbers are smaller than ``x``, and their sum."""
        n, total = 0, 0.0
        for block, s in zip(self.blocks, self.sums, strict=True):
            if not block or block[-1] >= x:
                k = bisect_left(block, x)
                return n + k, total + sum(block[:k])
            n += len(block)
            total += s
        return n, total

    def above(self, x: float) -> int:
        """How many numbers are larger than ``x``."""
        n = 0
        for block in reversed(self.blocks):
            if block and block[0] <= x:
                return n + len(block) - bisect_right(block, x)
            n += len(block)
        return n

    def median(self) -> float:
        return (self.at((self.n - 1) // 2) + self.at(self.n // 2)) / 2

    def mean_deviation(self) -> float:
        mean = self.total / self.n
        few, low = self.below(mean)
        return (self.total - 2 * low + mean * (2 * few - self.n)) / self.n

    def median_deviation(self) -> float:
        """The median distance from the median: distances rise to either side of it, so a rank among them is found by halving."""
        middle = self.median()
        left = self.below(middle)[0]

        def distance(rank: int) -> float:
            low, high = max(0, rank - (self.n - left)), min(rank, left)  # so many of the smaller distances are on the left
            while low < high:
                k = (low + high) // 2
                if middle - self.at(left - 1 - k) < self.at(left + rank - k - 1) - middle:
                    low = k + 1
                else:
                    high = k
            near = []
            if low < left:
                near.append(middle - self.at(left - 1 - low))
            if rank - low < self.n - left:
                near.append(self.at(left + rank - low) - middle)
            return min(near)

        return (distance((self.n - 1) // 2) + distance(self.n // 2)) / 2


class Mode:
    """The most frequent number, the largest of several."""

    def __init__(self) -> None:
        self.counts: dict[float, int] = {}
        self.most, self.value = 0, None

    def add(self, x: float) -> None:
        n = self.counts[x] = self.counts.get(x, 0) + 1
        if n > self.most or (n == self.most and x > self.value):
            self.most, self.value = n, x


class Spread:
    """Exact sums of numbers and of their squares, as whole multiples of a power of two."""

    def __init__(self) -> None:
        self.n, self.sum, self.squares, self.unit, self.finite = 0, 0, 0, 1, True

    def add(self, x: float) -> None:
        self.n += 1
        if not isfinite(x):
            self.finite = False
            return
        part, unit = x.as_integer_ratio()
        if unit > self.unit:
            more = unit // self.unit
            self.sum, self.squares, self.unit = self.sum * more, self.squares * more * more, unit
        part *= self.unit // unit
        self.sum += part
        self.squares += part * part

    def beyond(self, x: float, low: float, high: float) -> bool:
        """Whether ``x`` is more than 2 population deviations above the mean of ``low`` and ``high``: true for no number exactly at the limit."""
        twice = 2 * Fraction(x) - Fraction(low) - Fraction(high)  # twice the distance
        return twice > 0 and (twice * self.n * self.unit) ** 2 > 16 * (self.n * self.squares - self.sum * self.sum)

    def deviation(self) -> float:
        return isqrt((self.n * self.squares - self.sum * self.sum) << 128) / (self.n * self.unit << 64)


def spikes(values: Ordered, spread: Spread) -> int:
    """How many numbers are above median + 2 deviations. Those so close to that limit that rounding would decide are compared exactly."""
    if not spread.finite:
        return 0
    low, high = values.at((values.n - 1) // 2), values.at(values.n // 2)
    limit = low / 2 + high / 2 + 2 * spread.deviation()
    sure, most = values.above(limit * (1 + NEAR)), values.above(limit * (1 - NEAR))
    while sure < most:  # the limit divides the ordered numbers, so halving finds it
        k = (sure + most) // 2
        if spread.beyond(values.at(values.n - 1 - k), low, high):
            sure = k + 1
        else:
            most = k
    return sure


class Day:
    """What is known of a key before a day. Answers are kept until a value is added that they depend on."""

    def __init__(self, wanted: Sequence[str]):
        self.wanted = tuple(wanted)
        self.all, self.all_mode, self.gaps, self.gap_mode = Ordered(), Mode(), Ordered(), Mode()
        self.positive, self.spread, self.seen = Ordered(), Spread(), Ordered()
        self.of_all = bool({"qty_all_mode", "qty_all_median"} & set(wanted))
        self.of_gaps, self.of_spikes = bool({"gap_median", "gap_mode"} & set(wanted)), "n_spikes" in wanted
        self.of_seen = bool({"qty_mean_ad", "qty_median_ad"} & set(wanted))
        self.known: dict[str, float | int] = {}

    def answers(self, qty: float) -> list[float | int]:
        """The values of ``wanted``; the first day's own quantity stands for quantities before it."""
        if self.of_all and not self.all.n:
            return [qty if w in ("qty_all_mode", "qty_all_median") else 0 if STATISTICS[w] == "int" else 0.0 for w in self.wanted]
        known = self.known
        return [known[w] if w in known else known.setdefault(w, self.answer(w)) for w in self.wanted]

    def answer(self, name: str) -> float | int:
        if name == "qty_all_mode":
            return self.all_mode.value
        if name == "qty_all_median":
            return self.all.median()
        if name == "gap_median":
            return self.gaps.median() if self.gaps.n else 0.0
        if name == "gap_mode":
            return 0 if self.gap_mode.value is None else self.gap_mode.value
        if name == "n_spikes":
            return spikes(self.positive, self.spread) if self.positive.n else 0
        if name == "qty_mean_ad":
            return self.seen.mean_deviation() if self.seen.n else 0.0
        return NORMAL * self.seen.median_deviation() if self.seen.n else 0.0

    def add(self, qty: float, gap: float, sold: bool) -> None:
        if self.of_all:
            self.all.add(qty)
            self.all_mode.add(qty)
            self.known.pop("qty_all_mode", None)
            self.known.pop("qty_all_median", None)
        if qty > 0:
            self.known.clear()
            if self.of_gaps:
                self.gaps.add(gap)
                self.gap_mode.add(gap)
            if self.of_spikes:
                self.positive.add(qty)
                self.spread.add(qty)
        if sold and self.of_seen:
            self.known.clear()
            self.seen.add(qty)


def add_order_statistics(panel: DataFrame, levels: Sequence[str], wanted: Sequence[str], placed: bool = False) -> DataFrame:
    """``panel`` with the columns ``wanted`` of STATISTICS, each over the key's days before the row's.

    Needs qty, sold and days_since_prev_sale where they are asked about. ``placed`` says that all rows of a key are in one
    partition already, as they are after a window by key; else they are dealt out by key. The pass holds the values of
    one key, a number for each day of the calendar.
    """
    needs_gap = bool({"gap_median", "gap_mode"} & set(wanted))
    kinds = {"double": pa.float64(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, Day(wanted)
        for batch in batches:
            qty = batch.column("qty").to_pylist()
            gap = batch.column("days_since_prev_sale").to_pylist() if needs_gap else [0] * len(qty)
            sold = batch.column("sold").to_pylist() if "sold" in batch.schema.names else [False] * len(qty)
            rows: list[list] = []
            for k, *row in zip(zip(*(batch.column(c).to_pylist() for c in levels), strict=True), qty, gap, sold, strict=True):
                if k != key:
                    key, state = k, Day(wanted)
                rows.append(state.answers(row[0]))
                state.add(*row)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([x[k] for x in rows], kinds[STATISTICS[w]]) for k, w in enumerate(wanted))], names=[*batch.schema.names, *wanted])

    ordered = (panel if placed else by_key(panel, levels)).sortWithinPartitions(*levels, "date")
    schema = panel.select("*", *(F.lit(0).cast(STATISTICS[w]).alias(w) for w in wanted)).schema
    return ordered.mapInArrow(run, schema)
