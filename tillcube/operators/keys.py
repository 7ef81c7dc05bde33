"""Surrogate keys (W1) without a single-partition window.

``row_number() over (order by k)`` with no partitioning moves every row to
one task.  Instead the rows are range-partitioned on ``k``, sorted and
numbered inside each partition, and shifted by the number of rows in all earlier
partitions.  The offset table has one row per partition (a bound we
choose), so it is broadcast.  The numbered rows are written first so the
partition ids and the counts come from the same materialised data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_table_path


def sequential_key(df: DataFrame, order_col: str, key_col: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = 1, 2, ... in ``order_col`` order (ties broken arbitrarily)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Inside a sorted partition, monotonically_increasing_id() is
    # (partition << 33) + position, so the position needs no window (and no
    # second shuffle on the partition id).
    ranged = (df.repartitionByRange(n, order_col).sortWithinPartitions(order_col)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__local", F.monotonically_increasing_id()
                            - F.shiftleft(F.col("__pid").cast("long"), 33) + F.lit(1)))
    path = new_table_path(spark, f"keys-{key_col}")
    ranged.write.parquet(path)
    numbered = spark.read.schema(ranged.schema).parquet(path)
    counts = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"))
    out = numbered.join(F.broadcast(offsets), "__pid")
    return out.withColumn(key_col, (F.col("__off") + F.col("__local")).cast("long")).drop("__pid", "__local", "__off")
