"""Errors for results that must not be empty or mixed, raised inside the plan."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unless(rows: DataFrame, seen: DataFrame, wrong: Column, message: str | Column) -> DataFrame:
    """rows as they are; if `wrong` is true in seen, a table of one row, the plan raises the message when it is run. The check stands
    in a second branch under a union, which never has a row."""
    text = F.lit(message) if isinstance(message, str) else message
    alarm = seen.withColumn("_place", F.when(wrong, F.length(text) + 1).otherwise(0)).where(F.when(wrong, F.raise_error(text).cast("boolean")).otherwise(False))
    # the place reads all that the message reads, so that nothing is filtered before it is raised;
    # nulls that the optimizer doesn't know to be null: else a later filter or join would prove the branch empty and not run it
    null = lambda kind: F.coalesce(F.get(F.array(F.lit(None).cast(kind)), F.col("_place")), F.get(F.array(F.lit(None).cast(kind)), F.col("_place") + 1))
    return rows.unionByName(alarm.select(*(null(f.dataType).alias(f.name) for f in rows.schema)))


def some_rows(rows: DataFrame, message: str | Column, detail: DataFrame | None = None, of: DataFrame | None = None) -> DataFrame:
    """rows as they are; where there are none, or none in `of` if that is given, the plan raises the message when it is run.

    The check looks at every column of what must have rows, so that Spark makes what both branches shuffle once. message may use the
    columns of detail, a table of one row.
    """
    looked = rows if of is None else of
    seen = looked.agg(F.max(F.xxhash64(*(F.col(f"`{c}`") for c in looked.columns))).alias("_seen"))
    return unless(rows, seen if detail is None else seen.crossJoin(detail), F.col("_seen").isNull(), message)
