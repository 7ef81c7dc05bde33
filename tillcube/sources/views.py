"""Named views (S13) and SQL over them.

The reference keeps six SQL views next to its tables and its endpoints send
SQL text.  Here every warehouse table and each view (a function returning a
DataFrame) is registered as a temporary view, so the same questions can be
asked with ``spark.sql(...)``; Catalyst plans SQL text and DataFrame calls
alike.  Parameters go through ``args=`` (never string formatting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import kpi, layout
from .retail import Warehouse


def view_frames(wh: Warehouse) -> dict[str, DataFrame]:
    """Tables and views by name, as DataFrames."""
    spark = wh.spark
    sales = wh.sales()
    frames = {
        "sales": sales,
        "products": wh.products(),
        "categories": wh.categories(),
        "dim_time": wh.dim_time(),
        "daily_summary": wh.summary(),
        "product_summary": wh.product_summary(),
        # the reference's aggregate views, answered from the exact summaries
        "monthly_sales_summary": kpi.monthly_sales_summary(wh.summary()),
        "category_performance": kpi.category_performance(wh.summary()),
        "top_products": kpi.top_products(wh.product_summary(), None),
        "festival_comparison": kpi.festival_comparison(wh.summary()),
        "sales_unified": sales,
    }
    if wh.basic_table:
        basic, pricing = spark.table(wh.basic_table), spark.table(wh.pricing_table)
        frames.update({"products_basic": basic, "products_pricing": pricing,
                       "products_reconstructed": layout.reconstruct_products(basic, pricing)})
    if wh.master_path:
        frames.update({"products_master": spark.read.parquet(wh.master_path),
                       "products_replica": spark.read.parquet(wh.replica_path)})
    if wh.star:
        frames.update({k: spark.read.parquet(v) for k, v in wh.star.items()})
    return frames


def register_views(wh: Warehouse, prefix: str = "") -> list[str]:
    """``createOrReplaceTempView`` for every table and view, as ``prefix`` + name;
    returns the names.

    The views show the tables as they are at this call (appended batches
    included), so callers register again after an append.  A prefix keeps
    the views of several loads, or a user's own of these names, apart.
    """
    frames = {f"{prefix}{name}": df for name, df in view_frames(wh).items()}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)


def sql(spark: SparkSession, text: str, **args) -> DataFrame:
    """Run SQL text with named parameters (``:name`` markers)."""
    return spark.sql(text, args=args or None)
