"""Numbering and neighbours over a whole order, range by range: no window holds all rows."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestry.session import scratch


def _ranged(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """rows with __range, written by ranges of the order, so that all that is counted later sees the same ranges."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    path = scratch(rows.sparkSession)
    rows.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()).write.parquet(path)
    return rows.sparkSession.read.schema(rows.withColumn("__range", F.lit(0)).schema).parquet(path)


def numbered(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """rows with a number from 1 to n in the order of the columns; rows that tie in all of them are numbered in any order."""
    held = _ranged(rows, order)
    counts = sorted(tuple(r) for r in held.groupBy("__range").agg(F.count(F.lit(1))).collect())  # a row for each range
    starts = dict(zip((r for r, _ in counts), itertools.accumulate((n for _, n in counts), initial=0)))
    table = rows.sparkSession.createDataFrame(list(starts.items()) or [(0, 0)], "__r int, __start long")
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return held.withColumn("__n", inside).join(F.broadcast(table), F.col("__range") == F.col("__r")).withColumn(name, F.col("__start") + F.col("__n")).drop("__range", "__r", "__n", "__start")


def with_previous(rows: DataFrame, order: str, **columns: str) -> DataFrame:
    """rows with new columns: the values of others in the row before, in the order given; null in the first row. The order must be total."""
    held = _ranged(rows, (order,))
    values = F.struct(*columns.values())
    lasts = {r["__range"]: r["last"] for r in held.groupBy("__range").agg(F.max_by(values, order).alias("last")).collect()}  # a row for each range
    before, last = [], None
    for r in sorted(lasts):
        before.append((r, last))
        last = lasts[r]
    kinds = held.select(values.alias("v")).schema["v"].dataType.simpleString()
    table = rows.sparkSession.createDataFrame(before, f"__r int, __last {kinds}")
    w = Window.partitionBy("__range").orderBy(order)
    out = held.withColumns({f"__{name}": F.lag(c).over(w) for name, c in columns.items()}).withColumn("__first", F.row_number().over(w) == 1).join(F.broadcast(table), F.col("__range") == F.col("__r"), "left")
    return out.withColumns({name: F.when(F.col("__first"), F.col("__last")[c]).otherwise(F.col(f"__{name}")) for name, c in columns.items()}).drop("__range", "__r", "__last", "__first", *(f"__{name}" for name in columns))
