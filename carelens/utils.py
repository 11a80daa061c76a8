"""Small shared helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> str:
    """Back-quote a column name that may hold spaces, slashes or dots."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    return F.col(q(name))


def sql_str(s: str) -> str:
    """A Spark SQL string literal for ``s`` (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
