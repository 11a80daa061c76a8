"""Range joins by levels of bins: points within intervals, and intervals that overlap.

An interval is kept in bins of about its own length (a level's bins are 2 ** level wide), so it lies in two bins at most
however long it is.  A point looks into one bin of each level in use, at most 64 / STEP of them.  The bins are an equi-join
that Spark shuffles (AQE splits a hot bin), and the range itself is checked on what meets there: no nested loops, and
every pair is found once.

Pairs grow with the square of what meets.  Who wants only aggregates of the points in each interval takes
:func:`range_parts`: the same range join, of intervals cut into runs of bins with the points summed up by bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.operators.sessions import Agg, whole_number

#: Levels are multiples of this: bins are up to 2 ** STEP times as long as an interval, and a point looks into fewer.
STEP = 3

#: The same for the summaries of :func:`range_parts`: wider steps make fewer rows of a point, and more parts of an interval.
SUMMARY = 6


def _whole(df: DataFrame, col: str) -> Column:
    return whole_number(col, df.schema[col].dataType.simpleString())


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _level(length: str) -> str:
    """The least multiple of STEP whose bins are no shorter than the interval."""
    return f"cast(ceil(log2(cast({length} AS DOUBLE)) / {STEP}) AS INT) * {STEP}"


def _fit(df: DataFrame) -> DataFrame:
    """With the level (rounding of log2 made good) and the first and last bin of [_s, _e)."""
    lev = df.withColumn("_l", F.expr(f"greatest({_level('_e - _s')}, 0)")).withColumn("_l", F.expr(f"if(shiftleft(1L, _l) < _e - _s, _l + {STEP}, _l)"))
    return lev.withColumn("_b", F.expr("shiftright(_s, _l)")).withColumn("_b2", F.expr("shiftright(_e - 1, _l)"))


def _levels(df: DataFrame) -> list[int]:
    """The levels in use (64 / STEP numbers at most)."""
    return sorted(r["_l"] for r in df.select("_l").distinct().collect())


def _keys(df: DataFrame, on) -> list[Column]:
    return [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(on)]


def _intervals(df: DataFrame, start: str, end: str, on, low: int, high: int) -> DataFrame:
    """Intervals with (_k*, _s, _e), cut to [low, high] (nothing outside can match); no end is an open one."""
    cut = df.select(*_keys(df, on), _row(df).alias("_i"), F.greatest(_whole(df, start), F.lit(low)).alias("_s"),
                    F.least(F.coalesce(_whole(df, end), F.lit(high + 1)), F.lit(high + 1)).alias("_e"), F.col(f"`{start}`").isNotNull().alias("_ok"))
    return cut.where("_ok AND _s < _e").drop("_ok")


def _span(points: DataFrame, point: str) -> tuple[int, int]:
    """The least and the greatest point (zeros: none)."""
    edge = points.select(_whole(points, point).alias("_t")).agg(F.min("_t").alias("a"), F.max("_t").alias("b")).first()
    return (edge["a"], edge["b"]) if edge["a"] is not None else (0, 0)


def range_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, on: tuple[str, ...] | list[str] = (),
               span: tuple[int, int] | None = None) -> DataFrame:
    """(p, i): rows of points and of intervals, as structs, with start <= point < end and equal ``on`` columns.

    A null end is open, a null start or point matches nothing, nor do null ``on`` columns or an interval that ends at or
    before its start.  Repeated rows match each on their own.  Times or whole numbers.  ``span``: two numbers that all
    points lie between, if the caller knows them; saves a pass over the points.
    """
    p = points.select(*_keys(points, on), _row(points).alias("_p"), _whole(points, point).alias("_t")).where("_t IS NOT NULL")
    low, high = span or _span(points, point)
    i = _fit(_intervals(intervals, start, end, on, low, high))
    levels = _levels(i)
    k = [f"_k{n}" for n in range(len(on))]
    bins = i.select(*k, "_i", "_s", "_e", "_l", F.explode(F.expr("if(_b = _b2, array(_b), array(_b, _b2))")).alias("_b"))
    probes = F.array(*[F.struct(F.lit(n).alias("_l"), F.expr(f"shiftright(_t, {n})").alias("_b")) for n in levels]) if levels else \
        F.expr("cast(array() AS ARRAY<STRUCT<_l: INT, _b: BIGINT>>)")
    looked = p.select(*k, "_p", "_t", F.explode(probes).alias("_x")).select(*k, "_p", "_t", "_x.*")
    met = looked.join(bins, [*k, "_l", "_b"]).where("_s <= _t AND _t < _e")
    return met.select(F.col("_p").alias("p"), F.col("_i").alias("i"))


def _summary_levels(low: int, high: int) -> list[int]:
    """Multiples of SUMMARY, up to the first with 2 ** SUMMARY bins at most from low to high."""
    levels = [0]
    while (high >> levels[-1]) - (low >> levels[-1]) >= 2 ** SUMMARY and levels[-1] + SUMMARY < 64:
        levels.append(levels[-1] + SUMMARY)
    return levels


def _runs(levels: list[int]) -> Column:
    """[_s, _e) as runs [_a, _z) of whole bins of level _m, each of the highest level that fits there: two per level at most."""
    first = {m: f"(shiftright(_s, {m}) + if(shiftleft(shiftright(_s, {m}), {m}) < _s, 1, 0))" for m in levels}
    past = {m: f"shiftright(_e, {m})" for m in levels}
    run = lambda m, a, z: f"named_struct('_m', {m}, '_a', {a}, '_z', {z})"
    parts = []
    for m, up in zip(levels, levels[1:]):
        ends = f"array({run(m, first[m], f'{first[up]} * {2 ** SUMMARY}')}, {run(m, f'{past[up]} * {2 ** SUMMARY}', past[m])})"
        parts.append(f"if({first[up]} <= {past[up]}, {ends}, array({run(m, first[m], past[m])}))")
    parts.append(f"array({run(levels[-1], first[levels[-1]], past[levels[-1]])})")
    return F.expr(f"filter(flatten(array({', '.join(parts)})), x -> x._a < x._z)")


def range_parts(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, aggs: tuple[Agg, ...],
                on: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """(i, aggs): rows of intervals, as structs, each several times, with aggregates of disjoint parts of the points that
    :func:`range_join` pairs it with.  Merged by interval, they are the aggregates of its pairs; a row without pairs has none.

    The points are summed up in the bins of some levels, and each interval is cut into runs of whole bins, wide ones within
    it and narrow ones at its ends.  So a point makes a row per level, and an interval meets fewer than 2 ** SUMMARY bins
    per level and end, however many points lie in it and however close.
    """
    low, high = _span(points, point)
    levels = _summary_levels(low, high)
    k, x = [f"_k{n}" for n in range(len(on))], [f"_x{n}" for n in range(len(aggs))]
    p = points.select(*_keys(points, on), *[F.expr(a.expr).alias(n) for a, n in zip(aggs, x)], _whole(points, point).alias("_t")).where("_t IS NOT NULL")
    bins = p.select(*k, *x, "_t", F.explode(F.array(*[F.lit(m) for m in levels])).alias("_m")).withColumn("_b", F.expr("shiftright(_t, _m)"))
    summed = bins.groupBy(*k, "_m", "_b").agg(*[F.expr(f"{a.kind}({n})").alias(a.name) for a, n in zip(aggs, x)])
    cut = _intervals(intervals, start, end, on, low, high).select(*k, "_i", F.explode(_runs(levels)).alias("_r")).select(*k, "_i", "_r.*")
    span = min(low, low >> levels[-1]), max(high, high >> levels[-1])
    met = range_join(summed, cut, "_b", "_a", "_z", [*k, "_m"], span)
    return met.select(F.col("i._i").alias("i"), *[F.col(f"p.`{a.name}`").alias(a.name) for a in aggs])


def overlap_join(left: DataFrame, right: DataFrame, start: str, end: str, on: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """(l, r): rows of left and right, as structs, whose intervals [start, end) share a moment and whose ``on`` columns are
    equal.  Nulls as in :func:`range_join`.  An interval looks into the bins of its own and all higher levels in use, two
    at most each; a pair that shares two bins is taken at the first one only."""
    edges = [df.agg(F.min(_whole(df, start)).alias("a"), F.max(_whole(df, start)).alias("s"), F.max(_whole(df, end)).alias("e")).first() for df in (left, right)]
    known = [x for e in edges for x in e if x is not None]
    low, high = (min(known), max(known)) if known else (0, 0)
    k = [f"_k{n}" for n in range(len(on))]
    a, b = (_fit(_intervals(df, start, end, on, low, high)) for df in (left, right))
    levels = sorted({*_levels(a), *_levels(b)})

    def bins(df: DataFrame, side: str, above: bool) -> DataFrame:
        """A row per home bin, or per bin at higher levels (``above``)."""
        at = F.array(*[F.lit(n) for n in levels]) if levels else F.expr("cast(array() AS ARRAY<INT>)")
        chosen = F.filter(at, lambda n: n > F.col("_l")) if above else F.array("_l")
        out = df.select(*k, F.col("_i").alias(side), F.col("_s").alias(f"_s{side}"), F.col("_e").alias(f"_e{side}"), F.explode(chosen).alias("_m"))
        out = out.withColumn(f"_f{side}", F.expr(f"shiftright(_s{side}, _m)"))
        return out.withColumn("_b", F.explode(F.expr(f"sequence(_f{side}, shiftright(_e{side} - 1, _m))")))

    # home with home, and the shorter one's higher bins with the longer one's home
    pairs = [bins(a, "l", x).join(bins(b, "r", y), [*k, "_m", "_b"]) for x, y in ((False, False), (True, False), (False, True))]
    met = pairs[0].unionByName(pairs[1]).unionByName(pairs[2])
    met = met.where("_sl < _er AND _sr < _el AND _b = greatest(_fl, _fr)")
    return met.select("l", "r")
