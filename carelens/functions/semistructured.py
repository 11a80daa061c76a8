"""JSON text as typed columns, with nothing lost: documents that don't parse are kept whole, fields that aren't asked for in
a map.  All of it is Spark's own parser and higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED, EXTRA = "_malformed", "_extra"


def _as_struct(schema: T.StructType | str) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def parse_json(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """df without ``column``, with the fields of ``schema``, ``_malformed`` and ``_extra``.

    ``_malformed`` is the text of a document that isn't a JSON object, or one of whose fields is of another type; its other
    fields are there all the same, that one is null.  ``_extra`` maps the names of further fields to their text (null where
    there is none).  Missing fields, null and empty text are null, and neither malformed nor extra.  Of several documents in
    one text the first is read.
    """
    fields = _as_struct(schema)
    names = [f.name for f in fields.fields]
    taken = {MALFORMED, EXTRA, *names} & (set(df.columns) - {column})
    if taken:
        raise ValueError(f"columns are there already: {sorted(taken)}")
    text = F.col(f"`{column}`")
    blank = text.isNull() | (F.trim(text) == "")
    whole = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in fields.fields], T.StructField(MALFORMED, T.StringType())])
    parsed = F.from_json(text, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED})
    every = F.from_json(text, "map<string,string>")
    known = F.array(*[F.lit(n) for n in names])
    extra = F.map_filter(every, lambda k, v: ~F.array_contains(known, k))
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    out = df.withColumns({"_p": parsed, "_x": extra, "_blank": blank})
    not_object = ~F.col("_blank") & every_is_null(text)
    return out.withColumn("_bad", not_object).select(
        *rest, *[F.col(f"_p.`{n}`").alias(n) for n in names],
        F.when(~F.col("_blank"), F.coalesce(F.col(f"_p.`{MALFORMED}`"), F.when(F.col("_bad"), text))).alias(MALFORMED),
        F.when(F.size("_x") > 0, F.col("_x")).alias(EXTRA))


def every_is_null(text: Column) -> Column:
    """Whether the text holds no JSON object."""
    return F.json_object_keys(text).isNull()


def quality(parsed: DataFrame, by: list[str] = ()) -> DataFrame:
    """By the given columns: documents, malformed ones, and those with further fields."""
    return parsed.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.count(F.lit(1)).alias("documents"), F.count(MALFORMED).alias("malformed"),
                                                             F.count(EXTRA).alias("with_extra"))


def items(df: DataFrame, column: str, name: str = "item", at: str = "at") -> DataFrame:
    """One row per entry of an array column, with its place from 0; rows with an empty or null array keep one, of nulls."""
    rest = [c for c in df.columns if c != column]
    return df.select(*[F.col(f"`{c}`") for c in rest], F.posexplode_outer(F.col(f"`{column}`")).alias(at, name))
