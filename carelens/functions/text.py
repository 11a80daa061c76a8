"""Text clean-up functions.

Each function exists as SQL text (``*_sql``, composable inside one
``selectExpr``) and as a Column function.  Given a column *name* the Column
function is a single ``expr`` over that text; given a Column it composes the
same expression with the Column API.  Both compile to the same Catalyst
expression; the text form just costs the driver one call instead of many.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelens.utils import q, sql_str

# Python's str.strip() removes every character for which str.isspace() holds
# (29 code points: ASCII blanks, the \x1c-\x1f separators, NBSP, the
# U+2000 block, ideographic space, ...); Spark's trim() only U+0020 and Java's
# (?U)\s misses \x1c-\x1f.  btrim over exactly that set matches Python.
PY_WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def strip_sql(x: str) -> str:
    return f"btrim({x}, {sql_str(PY_WHITESPACE)})"


def strip_zeros_sql(x: str) -> str:
    return f"nullif(TRIM(LEADING '0' FROM {x}), '')"


def upper_sql(x: str) -> str:
    return f"upper({x})"


def to_text_sql(x: str, missing: str | None = None) -> str:
    out = f"CAST({x} AS STRING)"
    return out if missing is None else f"coalesce({out}, {sql_str(missing)})"


def strip(c: Column | str) -> Column:
    """Remove Unicode white space at both ends (C1); NULL stays NULL."""
    if isinstance(c, str):
        return F.expr(strip_sql(q(c)))
    return F.btrim(c, F.lit(PY_WHITESPACE))


def strip_zeros(c: Column | str) -> Column:
    """Remove leading '0' characters (C2); an all-zero key becomes NULL.

    A value of zeros only would strip to '' and come back as missing after a
    CSV round trip, so it is NULL in memory too.
    """
    if isinstance(c, str):
        return F.expr(strip_zeros_sql(q(c)))
    return F.nullif(F.ltrim(c, F.lit("0")), F.lit(""))


def upper(c: Column | str) -> Column:
    """Upper case."""
    return F.upper(F.col(c) if isinstance(c, str) else c)


def to_text(c: Column | str, missing: str | None = None) -> Column:
    """Cast to text.

    ``missing=None`` keeps NULL; ``missing='nan'`` renders it the way a
    pandas ``astype(str)`` does.
    """
    if isinstance(c, str):
        return F.expr(to_text_sql(q(c), missing))
    out = c.cast("string")
    return out if missing is None else F.coalesce(out, F.lit(missing))
