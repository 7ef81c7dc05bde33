"""Access paths (H3): row groups that a date range or a product touches, from the Parquet footers; Bloom filters; plans without joins."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillcube.operators import layout, ml, temporal
from tillcube.plans.inspect import plan_text
from tillcube.session import new_table_path
from tillcube.sources import retail


@pytest.fixture(scope="module")
def row_groups(spark):
    """(statistics of date and product) of every row group of the sales of sf0.1, in small groups."""
    wh = retail.load_warehouse(spark, "/root/testdata/sf0.1", layout_tables=False)
    path = retail.write_sales(wh.keyed_sales(), wh.products(), new_table_path(spark, "access"), row_group_bytes=32 << 10)
    out = []
    for file in glob.glob(f"{path.replace('file:', '')}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            out.append([group.column(at[c]).statistics for c in ("sale_date", "product_id")])
    products = [r.product_id for r in wh.products().select("product_id").orderBy("product_id").collect()]
    return path, out, products


def share(groups, k, low, high):
    return sum(g[k].min <= high and g[k].max >= low for g in groups) / len(groups)


def test_a_week_touches_a_tenth_of_the_row_groups(row_groups):
    _, groups, _ = row_groups
    assert len(groups) >= 200
    days = [dt.date(1996, 2, 10), dt.date(1997, 6, 29), dt.date(1998, 12, 25), dt.date(1999, 8, 1)]
    assert max(share(groups, 0, d, d + dt.timedelta(days=6)) for d in days) <= 0.1


def test_a_product_touches_a_tenth_of_the_row_groups(row_groups):
    _, groups, products = row_groups
    shares = [share(groups, 1, p, p) for p in products[:: max(1, len(products) // 40)]]
    assert sum(shares) / len(shares) <= 0.1


def test_bloom_filters_are_written(row_groups, spark):
    path, _, _ = row_groups
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    file = glob.glob(f"{path.replace('file:', '')}/**/*.parquet", recursive=True)[0]
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        has = {columns.get(i).getPath().toDotString(): columns.get(i).getBloomFilterOffset() for i in range(columns.size())}
    finally:
        reader.close()
    # a column whose values all fit a dictionary needs none: it is ruled out by its pages
    assert has["quantity"] < 0 and set(has) >= {"product_id", "category_id"}


def test_order_of_nulls_and_ends(spark):
    df = spark.createDataFrame([(None, None), (dt.date(1997, 1, 1), 1), (dt.date(1997, 12, 31), 100), (dt.date(1997, 12, 31), 999)], "d date, p long")
    got = [r[0] for r in df.select(layout.access_order("d", "p", F.lit(1), F.lit(100))).collect()]
    assert got[0] == 0 and all(0 <= z < 1 << 27 for z in got) and got[3] >= got[2] > got[1]


# ------------------------------------------------------------ one fact shuffle
def no_broadcast(spark, make):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_text(make())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_load_shuffles_facts_by_product_once(spark, wh, sf_dir):
    from tillcube.sources import tables
    star = wh.star
    looked_up = lambda: retail.load_dimension(wh.read(star["dim_product"]), wh.read(star["dim_category"]))
    plan = no_broadcast(spark, lambda: retail.sales_from(tables.lineitem(spark, sf_dir), looked_up(), wh.festival_days()))
    facts = [line for line in plan.splitlines() if "hashpartitioning(product_id" in line or "hashpartitioning(l_partkey" in line]
    assert len(facts) == 2          # one of the facts, one of the products


def test_training_set_and_fact_load_need_no_join(spark, wh):
    for make in (lambda: ml.training_set(wh.keyed_sales()), lambda: layout.fact_sales(wh.keyed_sales())):
        plan = no_broadcast(spark, make)
        assert "Join" not in plan and "Exchange" not in plan


def test_price_report_shuffles_no_single_sale(spark, wh):
    plan = no_broadcast(spark, lambda: temporal.revenue_at_date_prices(wh.sales(), temporal.price_versions(wh.products())))
    # the sales are summed by product and day in the scan's stage already
    tree = plan.split("\n\n\n")[0]
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    lines = tree.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Scan parquet" in line)
    assert any("HashAggregate" in line for line in lines[scan - 6:scan])


def test_reconstruction_needs_no_sort(spark, wh):
    basic, pricing = layout.split_products(wh.products(), 4)
    plan = no_broadcast(spark, lambda: layout.reconstruct_products(spark.table(basic), spark.table(pricing)))
    tree = plan.split("\n\n\n")[0]
    assert "SortMergeJoin" in tree and "Exchange" not in tree
    assert len(spark.table(basic).inputFiles()) <= 4


def test_price_versions_that_overlap_or_end_before_they_begin(spark):
    sales = spark.createDataFrame([(1, dt.date(1997, 1, 31), 1997, 2), (1, dt.date(1997, 2, 1), 1997, 3), (2, dt.date(1997, 2, 1), 1997, 1), (1, None, None, 1)],
                                  "product_id long, sale_date date, year int, quantity int")
    versions = spark.createDataFrame([(1, dt.date(1990, 1, 1), dt.date(1997, 1, 31), 1.0), (1, dt.date(1997, 1, 31), dt.date(9999, 12, 31), 2.0),
                                      (1, dt.date(1997, 3, 1), dt.date(1997, 1, 1), 9.0), (2, dt.date(1998, 1, 1), dt.date(9999, 12, 31), 5.0)],
                                     "product_id long, valid_from date, valid_to date, selling_price double").withColumn("cost_price", F.lit(0.0))
    got = sorted((r.product_id, str(r.sale_date), r.price_at_date) for r in temporal.sales_with_price_at_date(sales, versions).collect())
    assert got == [(1, "1997-01-31", 1.0), (1, "1997-01-31", 2.0), (1, "1997-02-01", 2.0)]
    assert temporal.sales_with_price_at_date(sales.limit(0), versions).count() == 0
