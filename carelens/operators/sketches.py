"""Mergeable sketches: distinct counts (HLL) and quantiles (KLL) kept as columns, and united without reading facts again.

A sketch of a union is the union of the sketches, so tables of them can be added up over groups, days and snapshots.
Their size is fixed by ``lgk`` and ``k`` whatever goes in; sketching combines in the tasks before the shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LGK, K = 12, 400


@dataclass(frozen=True)
class Distinct:
    """How many different values of a column (nulls are none); 2 ** lgk registers."""
    name: str
    column: str
    lgk: int = LGK

    def sketch(self) -> Column:
        return F.hll_sketch_agg(F.col(f"`{self.column}`").cast("string"), F.lit(self.lgk)).alias(self.name)

    def united(self) -> Column:
        return F.hll_union_agg(F.col(f"`{self.name}`")).alias(self.name)

    def answers(self, probabilities) -> list[Column]:
        return [F.coalesce(F.hll_sketch_estimate(F.col(f"`{self.name}`")), F.lit(0)).alias(self.name)]

    @property
    def bound(self) -> float:
        """Three standard errors of an estimate, as a share of the true count."""
        return 3 * 1.04 / math.sqrt(1 << self.lgk)


@dataclass(frozen=True)
class Quantiles:
    """Quantiles of a numeric column (nulls and NaN are none)."""
    name: str
    column: str
    k: int = K

    def sketch(self) -> Column:
        c = F.col(f"`{self.column}`").cast("double")
        return F.kll_sketch_agg_double(F.when(~F.isnan(c), c), F.lit(self.k)).alias(self.name)

    def united(self) -> Column:
        return F.kll_merge_agg_double(F.col(f"`{self.name}`"), F.lit(self.k)).alias(self.name)

    def answers(self, probabilities) -> list[Column]:
        s = F.col(f"`{self.name}`")
        n = F.kll_sketch_get_n_double(s)
        out = [F.coalesce(n, F.lit(0)).alias(f"{self.name}_n")]
        for p in probabilities:
            out.append(F.when(n > 0, F.kll_sketch_get_quantile_double(s, F.lit(float(p)))).alias(quantile_name(self.name, p)))
        return out

    @property
    def bound(self) -> float:
        """The error of a quantile's rank that 99 of 100 sketches stay under, as a share of the rows."""
        return 2.296 / self.k ** 0.9723


def quantile_name(name: str, p: float) -> str:
    """``hours_p50``, ``hours_p99_9``."""
    return f"{name}_p{100 * p:g}".replace(".", "_")


def sketch(df: DataFrame, by: list[str], specs) -> DataFrame:
    """One row per group: ``by``, ``rows``, and a column per sketch."""
    return df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.count(F.lit(1)).alias("rows"), *[s.sketch() for s in specs])


def unite(sketches: DataFrame, by: list[str], specs) -> DataFrame:
    """Rows of ``sketch`` (of any number of tables) added up to the groups of ``by``."""
    return sketches.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.sum("rows").alias("rows"), *[s.united() for s in specs])


def answer(sketches: DataFrame, by: list[str], specs, probabilities=(0.5, 0.9, 0.99)) -> DataFrame:
    """The estimates of each row: ``by``, ``rows``, a count per :class:`Distinct`, and per :class:`Quantiles` the number of
    values (``name_n``) and the quantiles asked for (``name_p50`` ...; null without values)."""
    bad = [p for p in probabilities if not 0 <= p <= 1]
    if bad:
        raise ValueError(f"not probabilities: {bad}")
    return sketches.select(*[F.col(f"`{c}`") for c in by], "rows", *[a for s in specs for a in s.answers(probabilities)])
