"""Numeric parsing and null-safe arithmetic (C7-C10, M1-M3 building blocks).

As in :mod:`carelens.functions.text`, each function has a SQL-text form
(``*_sql``) and a Column form built from it for column names.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.utils import q, sql_str

# Strings a pandas ``to_numeric(errors='coerce')`` accepts: a decimal or
# scientific number with optional sign and surrounding blanks, or inf /
# infinity / nan in any case with optional sign but *no* blanks (pandas
# rejects ' inf').  Spark's cast also takes Java suffixes such as '1.0d' or
# '5f' and hex floats; the guard rejects those so both paths agree.
NUMERIC_TEXT = (
    r"^(\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
    r"|[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?|[+-]?[nN][aA][nN])$"
)


def num_sql(x: str, default: str | None = None) -> str:
    inner = x if default is None else f"coalesce({x}, {sql_str(default)})"
    return f"try_cast({inner} AS DOUBLE)"


def nan_to_null_sql(x: str) -> str:
    return f"nanvl({x}, CAST(NULL AS DOUBLE))"


def to_number_sql(x: str) -> str:
    t = f"CAST({x} AS STRING)"
    return nan_to_null_sql(f"CASE WHEN {t} RLIKE {sql_str(NUMERIC_TEXT)} THEN try_cast(trim({t}) AS DOUBLE) END")


def add_parts_sql(parts, strict: bool = False, prefix: str = "") -> str:
    return " + ".join(num_sql(prefix + q(p), None if strict else "0") for p in parts)


def num(c: Column | str, default: str | None = None) -> Column:
    """``CAST(COALESCE(x, default) AS DOUBLE)`` with non-ANSI cast semantics.

    A missing value becomes ``default`` (when given), a malformed one NULL,
    which is what the legacy (non-ANSI) cast does; ``try_cast`` gives the
    same result with ANSI mode left on.
    """
    if isinstance(c, str):
        return F.expr(num_sql(q(c), default))
    x = c if default is None else F.coalesce(c, F.lit(default))
    return x.try_cast("double")


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL, so ``avg``/``max`` skip it like pandas does."""
    if isinstance(c, str):
        return F.expr(nan_to_null_sql(q(c)))
    return F.nanvl(c, F.lit(None).cast("double"))


def to_number(c: Column | str) -> Column:
    """pandas-style coercing parse of text (C7): bad -> NULL, NaN -> NULL."""
    if isinstance(c, str):
        return F.expr(to_number_sql(q(c)))
    x = c.cast("string")
    return nan_to_null(F.when(x.rlike(NUMERIC_TEXT), F.trim(x).try_cast("double")))


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Apply :func:`to_number` (text) or NaN clean-up (numbers) to ``cols``,
    as one projection."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    exprs = []
    for c in df.columns:
        if c not in cols:
            exprs.append(q(c))
        elif isinstance(types.get(c), T.StringType):
            exprs.append(f"{to_number_sql(q(c))} AS {q(c)}")
        else:
            exprs.append(f"{nan_to_null_sql(f'CAST({q(c)} AS DOUBLE)')} AS {q(c)}")
    return df.selectExpr(*exprs)


def add_parts(parts, strict: bool = False) -> Column:
    """Sum of text parts (column names) as doubles.

    ``strict=False`` (current gold job): a missing part counts 0, a malformed
    one makes the whole sum NULL.  ``strict=True`` (older job): any missing or
    malformed part makes the sum NULL.
    """
    return F.expr(add_parts_sql(parts, strict))


def add_parts_columns(parts, strict: bool = False) -> Column:
    """Same as :func:`add_parts`, composed with the Column API."""
    return reduce(add, [num(F.col(q(p)), None if strict else "0") for p in parts])
