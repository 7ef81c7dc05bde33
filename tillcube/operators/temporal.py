"""Valid-time and transaction-time operators.

A product price is valid over the closed interval ``[valid_from,
valid_to]`` with ``9999-12-31`` as the open end.  The price of a product on
a date is a filter.  The price of each *sale* on its date (J8) joins on the
product and a bin of the date.  A version's bins are as wide as the version,
clipped to the sales' span, is long (a power of two days), so it lies in one or
two of them; a sale looks in its bin of every width that occurs, and the
interval is checked in the bin.  So a sale meets few versions, however many
its product has, and a version is listed at most twice, however long it is
valid.  Reports sum the sales by product and day first, so no single sale is
shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, money

# Fixed values of the price-history fixture (FIXTURES.md, C): each product
# gets three versions, (valid_from, valid_to, price factor).
PRICE_VERSIONS = [
    ("1995-01-01", "1996-12-31", "0.9"),
    ("1997-01-01", "1998-12-31", "1.0"),
    ("1999-01-01", "9999-12-31", "1.1"),
]


def price_versions(products: DataFrame, versions: list[tuple[str, str, str]] = PRICE_VERSIONS) -> DataFrame:
    """One row per (product, version); prices scaled and rounded to 2 places.

    Built per product row with ``explode`` of a literal array, so no join.
    """
    arr = F.array(*[F.struct(F.lit(a).cast("date").alias("vf"), F.lit(b).cast("date").alias("vt"),
                             F.lit(f).cast("decimal(2,1)").alias("k")) for a, b, f in versions])
    v = products.select("product_id", "product_name", "cost_price", "selling_price", F.explode(arr).alias("v"))
    return v.select(
        "product_id", "product_name",
        (F.col("cost_price") * F.col("v.k")).cast(money.PRICE).alias("cost_price"),
        (F.col("selling_price") * F.col("v.k")).cast(money.PRICE).alias("selling_price"),
        F.col("v.vf").alias("valid_from"),
        F.col("v.vt").alias("valid_to"),
    )


def price_at_date(versions: DataFrame, on: dt.date) -> DataFrame:
    """The versions valid on ``on`` (``on BETWEEN valid_from AND valid_to``)."""
    d = F.lit(on)
    return versions.filter((F.col("valid_from") <= d) & (d <= F.col("valid_to")))


def _bin(date, first, width_bits) -> F.Column:
    """Number of the date's bin, bins of ``2 ** width_bits`` days from ``first`` on."""
    days = F.datediff(F.col(date) if isinstance(date, str) else date, F.col(first))
    return F.floor(days / F.pow(F.lit(2.0), F.col(width_bits)))


def binned_versions(versions: DataFrame, span: DataFrame) -> DataFrame:
    """The versions once a bin that they touch within ``span`` (one row:
    ``first``, ``last`` day): one or two bins, the narrowest that are no
    shorter than the version within the span."""
    v = versions.withColumn("first", span.select("first").scalar()).withColumn("last", span.select("last").scalar())
    v = v.filter((F.col("valid_from") <= F.col("last")) & (F.col("valid_to") >= F.col("first")) & (F.col("valid_from") <= F.col("valid_to")))
    start, end = F.greatest("valid_from", "first"), F.least("valid_to", "last")
    v = v.withColumn("v_width", F.length(F.bin(F.datediff(end, start))))
    bins = F.sequence(_bin(start, "first", "v_width"), _bin(end, "first", "v_width"))
    return v.select(F.col("product_id").alias("v_product_id"), "v_width", F.explode(bins).alias("v_bin"), "valid_from", "valid_to",
                    F.col("selling_price").alias("price_at_date"), F.col("cost_price").alias("cost_at_date"))


def sales_span(sales: DataFrame, date_col: str = "sale_date") -> DataFrame:
    """First and last day of the sales, one row (Parquet statistics answer it)."""
    return sales.agg(F.min(date_col).alias("first"), F.max(date_col).alias("last"))


def sales_with_price_at_date(sales: DataFrame, versions: DataFrame, span: DataFrame | None = None) -> DataFrame:
    """Each sale (or each row of sums by product and day) with the product
    versions valid on its sale date.

    The versions are never broadcast: Spark takes an exploded table for as
    small as its input, and the driver would hold all of it."""
    span = span if span is not None else sales_span(sales)
    v = binned_versions(versions, span)
    looked = (sales.withColumn("__first", span.select("first").scalar())
              .withColumn("__width", F.explode(v.agg(F.collect_set("v_width")).scalar())))
    cond = ((F.col("product_id") == F.col("v_product_id")) & (F.col("__width") == F.col("v_width"))
            & (_bin("sale_date", "__first", "__width") == F.col("v_bin"))
            & F.col("sale_date").between(F.col("valid_from"), F.col("valid_to")))
    return looked.join(v.hint("merge"), cond, "inner").drop("v_product_id", "v_width", "v_bin", "__first", "__width")


def product_days(sales: DataFrame) -> DataFrame:
    """orders and quantity a (product, day): all that a report at date prices needs."""
    return sales.groupBy("product_id", "sale_date", "year").agg(F.count(F.lit(1)).alias("orders"), F.sum(F.col("quantity").cast("long")).alias("quantity"))


def revenue_at_date_prices(sales: DataFrame, versions: DataFrame) -> DataFrame:
    """J8 report: per year, list revenue and cost at the prices valid on each
    sale date.  Sales are summed by product and day before they meet a price;
    the sums are whole cents, so they equal the sums over single sales."""
    priced = sales_with_price_at_date(product_days(sales), versions, sales_span(sales))
    return priced.groupBy("year").agg(
        F.sum("orders").alias("orders"),
        money.money_sum(F.col("quantity") * F.col("price_at_date")).alias("list_revenue"),
        money.money_sum(F.col("quantity") * F.col("cost_at_date")).alias("list_cost"),
    ).orderBy("year")


def created_after(sales: DataFrame, after: dt.datetime) -> DataFrame:
    """``created_at > after`` (typed compare; pushed to the Parquet scan)."""
    return sales.filter(F.col("created_at") > dates.ntz(after))


def versions_sample(products: DataFrame, n: int = 5) -> DataFrame:
    """Valid-time columns of the first ``n`` products by id."""
    return (products.orderBy("product_id").limit(n)
            .select("product_name", "cost_price", "selling_price", "valid_from", "valid_to"))


def audit_sample(products: DataFrame, n: int = 5) -> DataFrame:
    """Transaction-time columns of the first ``n`` products by id."""
    return products.orderBy("product_id").limit(n).select("product_name", "created_at", "updated_at")
