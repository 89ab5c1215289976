"""Exact order statistics by narrowing ranges of values from counts: no sort, and no task that holds a table's values."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tilewright.sources.scratch import written

#: Values that are brought to the driver once a range holds no more than so many.
FEW = 4096
#: Relative error of the pivots' sketch; a round leaves about four times this share of a range.
ERROR = 1e-3


@dataclass
class _Search:
    """The value of a rank lies between ``low`` and ``high``, both excluded (None: no bound), where ``inside`` values lie above ``below`` others."""

    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def within(self, v: Column) -> Column:
        ok = v.isNotNull()
        ok = ok if self.low is None else ok & (v > self.low)
        return ok if self.high is None else ok & (v < self.high)

    def narrow(self, pivot: float, less: int, equal: int) -> None:
        """``less`` and ``equal`` count all values below and at the pivot."""
        if less <= self.rank < less + equal:
            self.found = pivot
        elif self.rank < less and (self.high is None or pivot < self.high):
            self.inside, self.high = less - self.below, pivot
        elif self.rank >= less + equal and (self.low is None or pivot > self.low):
            self.inside += self.below - less - equal
            self.below, self.low = less + equal, pivot


def order_statistics(values: DataFrame, value: str, ranks: list[int], few: int = FEW, error: float = ERROR) -> dict[int, float]:
    """The values of the given ranks (0 is the smallest) among the non-null values of a column, exactly.

    Each round takes pivots for all ranks at once from a sketch of what is left of each range, counts the values below and at each
    pivot, and keeps the range between two pivots that holds the rank. Pivots are values that occur, so heavy ties end a search
    at once and every round shrinks each range; with the default error 10**12 values take four rounds of two passes. What comes
    to the driver are counts, pivots, and at last at most ``few`` values of a range.
    """
    v = F.col(value)
    values = written(values.select(v).where(v.isNotNull()), "values")
    n = values.count()
    if any(not 0 <= r < n for r in ranks):
        raise ValueError(f"a rank lies outside of {n} values")
    found = {r: _Search(r, 0, n) for r in ranks}
    while open_ := [s for s in found.values() if s.found is None and s.inside > few]:
        shares = [[min(1.0, max(0.0, (s.rank - s.below + 0.5) / s.inside + d)) for d in (-2 * error, 0.0, 2 * error)] for s in open_]
        row = values.agg(*[F.percentile_approx(F.when(s.within(v), v), p, round(1 / error)).alias(f"p{i}") for i, (s, p) in enumerate(zip(open_, shares, strict=True))]).first()
        pivots = sorted({x for i in range(len(open_)) for x in row[f"p{i}"]})
        counts = values.agg(*[f(c).alias(f"{a}{i}") for i, x in enumerate(pivots) for a, f, c in (("l", F.count_if, v < x), ("e", F.count_if, v == x))]).first()
        for s in open_:
            for i, x in enumerate(pivots):
                if s.found is None:
                    s.narrow(x, counts[f"l{i}"], counts[f"e{i}"])
    if rest := [s for s in found.values() if s.found is None]:
        inside = F.lit(False)
        for s in rest:
            inside |= s.within(v)
        left = sorted((r[0], r["n"]) for r in values.where(inside).groupBy(v).agg(F.count("*").alias("n")).collect())
        for s in rest:
            at = s.below
            for x, k in left:
                if (s.low is None or x > s.low) and (s.high is None or x < s.high):
                    if s.rank < at + k:
                        s.found = x
                        break
                    at += k
    return {r: s.found for r, s in found.items()}


def quantiles(values: DataFrame, value: str, shares: list[float], few: int = FEW, error: float = ERROR) -> tuple[int, list[float | None]]:
    """(count, quantiles) of a column's non-null values, interpolated between neighbours; an empty column has none."""
    n = values.where(F.col(value).isNotNull()).count()
    if not n:
        return 0, [None] * len(shares)
    at = [(math.floor(p * (n - 1)), p * (n - 1) - math.floor(p * (n - 1))) for p in shares]
    known = order_statistics(values, value, sorted({r for k, _ in at for r in (k, min(k + 1, n - 1))}), few, error)
    return n, [known[k] + (known[min(k + 1, n - 1)] - known[k]) * f for k, f in at]
