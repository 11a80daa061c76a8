"""SQL over named frames (Q1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def sql_over(spark: SparkSession, query: str, frames: dict[str, DataFrame]) -> DataFrame:
    """Register each frame under its name, then run ``query``.

    Temp views are plan references, not copies; Catalyst optimises the SQL
    together with the frames' own plans.  The views are there only while the
    text is analysed; views of the same names that the caller has come back.
    """
    mine = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    before = {name: spark.table(name) for name in frames if name.lower() in mine}
    try:
        for name, frame in frames.items():
            frame.createOrReplaceTempView(name)
        return spark.sql(query)
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)
        for name, frame in before.items():
            frame.createOrReplaceTempView(name)
