"""Sinks: replacing the two diff tables (K1, K2), the CSV exports (K7)
and the run-date comment (K9).

Writers are Spark's own (parallel, one file per task). Loading through a
CSV ``COPY`` turned every empty field into NULL in the source; ``blanks``
reproduces that on string columns.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_pointer(spark: SparkSession, folder: str, **values: str) -> None:
    """Publish a version: one more row in an append-only table. A crash
    before the commit leaves the versions published so far as they are."""
    row = [(time.time_ns(), *values.values())]
    schema = "written long, " + ", ".join(f"{k} string" for k in values)
    spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(folder)


def newest_pointer(spark: SparkSession, folder: str):
    """The latest published row; None if nothing was ever published. Any
    other failure to read, and an empty table, is an error."""
    try:
        rows = spark.read.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    row = rows.orderBy(F.desc("written")).first()
    if row is None:
        raise RuntimeError(f"{folder}: the pointer table is empty")
    return row


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every string column."""
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c)
                       for c, t in df.dtypes])


def replace_table(df: DataFrame, path: str, blanks: bool = True, table: str | None = None,
                  comment: str | None = None) -> None:
    """K1/K2: overwrite the table at ``path`` (Parquet). With ``table`` it
    is also registered in the catalog and ``comment`` is set on it (K9)."""
    out = blanks_to_null(df) if blanks else df
    w = out.write.mode("overwrite").format("parquet")
    if table:
        w.option("path", path).saveAsTable(table)
        if comment is not None:
            text = comment.replace("'", "''")
            df.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{text}'")
    else:
        w.save(path)


def export_csv(df: DataFrame, path: str) -> None:
    """K7: CSV with a header; quotes doubled, as RFC 4180 readers expect."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
