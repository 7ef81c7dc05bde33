"""Readers for the driver's Parquet tables.

Each reader selects only the columns the mapping needs, so the Parquet scan
gets a pruned ``ReadSchema``; filters added later are pushed to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LINEITEM_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_shipdate"]
PART_COLUMNS = ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS)


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part", PART_COLUMNS)
