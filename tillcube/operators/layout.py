"""Data-layout jobs: fragments, replica, upserts and the star-schema load.

The reference splits ``sales`` into per-year tables by hand, splits
``products`` by columns, copies a master table to a replica and fills a
star schema with ``INSERT ... SELECT``.  Here:

* H1 horizontal fragments = one table written ``partitionBy("year")``; a
  fragment is a partition filter (``PartitionFilters`` in the plan).
* H2 vertical fragments = two column groups written bucketed and sorted by
  ``product_id``, so J3's reconstruction join runs without a shuffle.
* S4-S8 = bulk writes (append / merge into a new directory / overwrite),
  never row-at-a-time.
* H4 = dims with sequential surrogate keys + fact load by equi joins.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, money
from ..session import new_table_path, open_writers
from .keys import sequential_key

# The column groups of the product and fact tables.
BASIC_COLUMNS = ["product_id", "product_name", "category_id", "stock_quantity", "created_at"]
PRICING_COLUMNS = ["product_id", "cost_price", "selling_price", "valid_from", "valid_to", "updated_at"]
MASTER_COLUMNS = ["product_id", "product_name", "category_id", "cost_price", "selling_price", "stock_quantity"]
FACT_COLUMNS = ["date_key", "product_key", "category_key", "quantity", "discount_percent",
                "sale_amount", "profit", "cost_amount"]
# Buckets of the vertical fragments: files of a few hundred MB up to some 10^9 products.
BUCKETS = 32
# Access order (H3): bits of a year's days and of the product range that are interleaved.
DAY_BITS = 9
PRODUCT_BITS = 2 * DAY_BITS
# Fixed value: the star schema's category description suffix.
DIM_CATEGORY_SUFFIX = " products"


# ------------------------------------------------------------ H1 / U1 / P9
def read_fragment(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One year's fragment: a partition filter, only that year's files are read."""
    return fragment_of(spark.read.parquet(path), year)


def fragment_of(table: DataFrame, year: int) -> DataFrame:
    """The fragment of an already-opened year-partitioned table (one file listing for all)."""
    return table.filter(F.col("year") == F.lit(year))


def unify(fragments: list[DataFrame]) -> DataFrame:
    """Bag union of fragments, by column name."""
    return functools.reduce(lambda a, b: a.unionByName(b), fragments)


# ------------------------------------------------------------ H2 / J3
def _bucketed_table(df: DataFrame, name: str, key: str, buckets: int) -> str:
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:10]}"
    path = new_table_path(spark, name)
    # one task a bucket, so a bucket is one file and its sort order is known
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet")
       .saveAsTable(table))
    return table


def split_products(products: DataFrame, buckets: int = BUCKETS) -> tuple[str, str]:
    """H2: write the identity and the pricing column groups, both keyed by ``product_id``.

    Both are bucketed and sorted by the key into the same number of buckets,
    one file each, so that J3 is a merge join without a shuffle.  Returns the
    two table names.
    """
    basic = _bucketed_table(products.select(*BASIC_COLUMNS), "products_basic", "product_id", buckets)
    pricing = _bucketed_table(products.select(*PRICING_COLUMNS), "products_pricing", "product_id", buckets)
    return basic, pricing


def reconstruct_products(basic: DataFrame, pricing: DataFrame) -> DataFrame:
    """1:1 join on the key; ``created_at`` from the identity side, ``updated_at`` from pricing."""
    whole = basic.join(pricing, "product_id")
    audit = ["created_at", "updated_at"]
    return whole.select(*[c for c in whole.columns if c not in audit], *audit)


# ------------------------------------------------------------ S4 / S5 / S6 / S7
def append(df: DataFrame, path: str) -> str:
    """Bulk append to a Parquet table."""
    df.write.mode("append").parquet(path)
    return path


def one_per_key(rows: DataFrame, key: str, order_col: str | None, last: bool) -> DataFrame:
    """One row per key: the last or the first by ``order_col``.

    A NULL order comes before every other one, as in an ascending sort.  Rows
    of one order are told apart by their values, so the choice does not
    depend on partitioning.  NULL is a key like any other.
    """
    row = F.struct(*([F.col(order_col).isNotNull(), F.col(order_col)] if order_col else []), F.struct(*[F.col(c) for c in rows.columns]).alias("row"))
    pick = F.max(row) if last else F.min(row)
    return rows.groupBy(F.col(key).alias("__key")).agg(pick.alias("r")).select("r.row.*")


def upsert(base: DataFrame, incoming: DataFrame, key: str, id_col: str | None = None,
           update_columns: list[str] | None = None, order_col: str | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET <update_columns>``.

    Existing keys keep their row, with ``update_columns`` taken from the
    incoming row (the reference updates only the key itself, so by default
    nothing changes).  New keys are appended; if ``id_col`` is given they get
    ids after the current maximum, in key order.  An incoming NULL overwrites,
    as ``DO UPDATE SET`` does.  Of incoming rows with one key the last by
    ``order_col`` counts (without it, the greatest by its values).  A NULL key
    conflicts with nothing, so all its rows are new, as under a UNIQUE
    constraint.  The result is meant to be written to a *new* directory.
    """
    update_columns = update_columns or []
    unkeyed = incoming.filter(F.col(key).isNull())
    inc = one_per_key(incoming.filter(F.col(key).isNotNull()), key, order_col, last=True)
    cols = base.columns
    hit = base.alias("b").join(inc.withColumn("__hit", F.lit(True)).alias("i"), key, "left")
    kept = hit.select(*[
        (F.when(F.col("i.__hit"), F.col(f"i.{c}")).otherwise(F.col(f"b.{c}")) if c in update_columns else F.col(f"b.{c}")).alias(c)
        if c != key else F.col(key) for c in cols])
    new = inc.join(base.select(key), key, "left_anti").unionByName(unkeyed)
    if id_col:
        top = base.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()  # scalar subquery
        new = sequential_key(new.drop(id_col) if id_col in new.columns else new, key, "__seq")
        new = new.withColumn(id_col, (top + F.col("__seq")).cast("long"))
    for c in cols:
        if c not in new.columns:
            new = new.withColumn(c, F.lit(None).cast(base.schema[c].dataType))
    return kept.unionByName(new.select(*cols))


def insert_absent(base: DataFrame, incoming: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``base`` (one per key, the
    first by ``order_col``; all rows of a NULL key, which conflicts with nothing)."""
    keyed = one_per_key(incoming.filter(F.col(key).isNotNull()), key, order_col, last=False).join(base.select(key), key, "left_anti")
    return keyed.unionByName(incoming.filter(F.col(key).isNull()))


def insert_absent_into(spark: SparkSession, path: str, incoming: DataFrame, key: str) -> int:
    """S6 as a sink: append only the absent keys to the table at ``path``."""
    todo = insert_absent(spark.read.parquet(path), incoming, key)
    staged = new_table_path(spark, "staged")
    todo.write.parquet(staged)          # fix the rows before appending to the table they came from
    rows = spark.read.parquet(staged)
    rows.write.mode("append").parquet(path)
    return rows.count()


def replicate(master: DataFrame, replica_path: str) -> str:
    """Full refresh of the replica from the master, stamped ``replicated_at``."""
    (master.select(*MASTER_COLUMNS).withColumn("replicated_at", F.current_timestamp())
           .write.mode("overwrite").parquet(replica_path))
    return replica_path


def replication_status(master: DataFrame, replica: DataFrame) -> DataFrame:
    """Row counts of both sides and the last refresh time."""
    m = master.agg(F.count(F.lit(1)).alias("master_records"))
    return m.select("master_records",
                    replica.agg(F.count(F.lit(1))).scalar().alias("replica_records"),
                    replica.agg(F.max("replicated_at")).scalar().alias("last_replicated"))


# ------------------------------------------------------------ W1 / H4 / J4
def dim_category_rows(categories: DataFrame) -> DataFrame:
    """The star schema's categories, without their surrogate key."""
    return categories.select("category_id", "category_name", F.concat("category_name", F.lit(DIM_CATEGORY_SUFFIX)).alias("description"))


def dim_product_rows(products: DataFrame, categories: DataFrame) -> DataFrame:
    """The star schema's products, without their surrogate key."""
    cats = categories.select("category_id", "category_name")
    return products.join(cats, "category_id").select("product_id", "product_name", "category_name", "cost_price", "selling_price")


def dim_category(categories: DataFrame) -> DataFrame:
    """Star-schema category dimension; key in ``category_id`` order."""
    rows = dim_category_rows(categories)
    return sequential_key(rows, "category_id", "category_key").select("category_key", *rows.columns)


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Star-schema product dimension; key in ``product_id`` order, no global sort window."""
    rows = dim_product_rows(products, categories)
    return sequential_key(rows, "product_id", "product_key").select("product_key", *rows.columns)


def assert_unique(df: DataFrame, key: str) -> None:
    """A duplicated dimension key would multiply fact rows."""
    dup = df.groupBy(key).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"dimension key {key} is not unique")


def fact_sales(sales: DataFrame, dim_prod: DataFrame | None = None, dim_cat: DataFrame | None = None) -> DataFrame:
    """Swap natural keys for surrogate keys; ``date_key`` computed (dim_time not joined).

    Sales that the load has written carry their surrogate keys and need no
    join; for others both dimensions are joined without a hint (Spark chooses
    by bytes).
    """
    if dim_prod is not None:
        sales = sales.drop("product_key", "category_key").join(dim_prod.select("product_key", "product_id"), "product_id")
        sales = sales.join(dim_cat.select("category_key", "category_id"), "category_id")
    return sales.select(
        dates.date_key("sale_date").alias("date_key"), "product_key", "category_key", "quantity",
        "discount_percent", "sale_amount", "profit",
        money.cost_amount("sale_amount", "profit").alias("cost_amount"),
        "year")


def load_dimensions(products: DataFrame, categories: DataFrame, root: str) -> dict[str, str]:
    """H4, first half: write the dimensions (a rerun writes a new root)."""
    paths = {"dim_category": f"{root}/dim_category", "dim_product": f"{root}/dim_product"}
    dim_category(categories).write.parquet(paths["dim_category"])
    dim_product(products, categories).write.parquet(paths["dim_product"])
    for name, key in (("dim_category", "category_id"), ("dim_product", "product_id")):
        assert_unique(products.sparkSession.read.parquet(paths[name]), key)
    return paths


def load_facts(keyed_sales: DataFrame, root: str) -> dict[str, str]:
    """H4, second half: the fact table from sales that carry their surrogate
    keys.  They stand in (year, access) order already, so nothing is moved, nor
    sorted: a task writes its few years side by side."""
    with open_writers(keyed_sales.sparkSession):
        (fact_sales(keyed_sales).withColumn("fact_id", F.monotonically_increasing_id())
            .write.partitionBy("year").parquet(f"{root}/fact_sales"))
    return {"fact_sales": f"{root}/fact_sales"}


# ------------------------------------------------------------ H3
def access_order(date_col: str, product_col: str, low, high):
    """H3: place of a sale on a space-filling curve over (day of the year,
    product between ``low`` and ``high``), two product bits a day bit.

    Rows in this order lie in blocks that are narrow in both: a row group's
    min/max statistics then rule it out for a date range as well as for a
    product.  NULLs count as 0.
    """
    day = F.coalesce(F.dayofyear(date_col), F.lit(0)).cast("long")
    low, high = low.cast("double"), high.cast("double")
    scaled = F.floor((F.col(product_col).cast("double") - low) / (high - low + 1) * F.lit(float(1 << PRODUCT_BITS)))
    prod = F.coalesce(F.least(F.greatest(scaled, F.lit(0)), F.lit((1 << PRODUCT_BITS) - 1)), F.lit(0)).cast("long")
    z = F.lit(0).cast("long")
    for i in range(DAY_BITS):       # three bits each: one of the day, two of the product
        z = z.bitwiseOR(F.shiftleft(F.shiftright(day, i).bitwiseAND(F.lit(1).cast("long")), 3 * i + 2))
        z = z.bitwiseOR(F.shiftleft(F.shiftright(prod, 2 * i).bitwiseAND(F.lit(3).cast("long")), 3 * i))
    return z


# ------------------------------------------------------------ D19 / D20 / D21
def labelled_counts(frames: list[tuple[str, DataFrame]], label_col: str = "relation") -> DataFrame:
    """Row counts of several relations, one row each."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label_col), "row_count")
             for name, df in frames]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def year_fragment_counts(fragments: DataFrame) -> DataFrame:
    """Per-fragment counts of a year-partitioned table in one job."""
    return fragments.groupBy("year").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.concat(F.lit("sales_"), F.col("year").cast("string")).alias("relation"), "row_count")
