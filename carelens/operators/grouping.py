"""Subtotals of several groupings in one pass: grouping sets, rollup and cube.

Spark expands a row once per grouping and aggregates all in one partial and one final step, so there is one scan and one
exchange however many groupings are asked for, and a group with a third of the rows (the grand total has all) is a row
per task before the exchange.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = "grouping"


def rollup_sets(keys: list[str]) -> list[tuple[str, ...]]:
    """All keys, then one less from the right each, down to none."""
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def cube_sets(keys: list[str]) -> list[tuple[str, ...]]:
    """Every subset of the keys."""
    return [c for n in range(len(keys), -1, -1) for c in combinations(keys, n)]


def subtotals(df: DataFrame, keys: list[str], sets: list[tuple[str, ...]], aggs: dict[str, str]) -> DataFrame:
    """One row per group of each grouping: the keys, ``grouping`` and the aggregates (name -> SQL).

    ``grouping`` names the keys that a row is grouped by (joined by ``+``; ``total`` for none), so a null key of a group
    is told from a key that the row adds up over, which is null as well.  A grouping that is listed twice counts once.
    No rows give no groups, and a total only where ``()`` is asked for (with counts of 0).
    """
    unknown = {k for s in sets for k in s} - set(keys)
    sets = list(dict.fromkeys(tuple(k for k in keys if k in s) for s in sets))
    clash = {LEVEL, *keys} & set(aggs)
    if unknown or clash or not sets:
        raise ValueError(f"unknown keys {sorted(unknown)}, names used twice {sorted(clash)}, {len(sets)} groupings")
    named = {"+".join(s) or "total": s for s in sets}
    if len(named) < len(sets):
        raise ValueError("two groupings have one name")
    # the bit of a key is 1 where a row adds up over it; the first key has the highest
    ids = {sum(0 if k in s else 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)): name for name, s in named.items()}
    label = F.element_at(F.create_map(*[F.lit(x) for pair in ids.items() for x in pair]), F.col("_g").cast("int"))
    found = df.groupingSets([[F.col(f"`{k}`") for k in s] for s in sets], *[F.col(f"`{k}`") for k in keys]).agg(
        F.grouping_id(*[F.col(f"`{k}`") for k in keys]).alias("_g"), *[F.expr(e).alias(n) for n, e in aggs.items()])
    return found.select(*[F.col(f"`{k}`") for k in keys], label.alias(LEVEL), *[F.col(f"`{n}`") for n in aggs])
