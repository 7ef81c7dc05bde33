"""Edge rows (FIXTURES.md, D) on small in-memory frames, plus invariants."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillcube.operators import calendar, kpi, layout, olap, temporal
from tillcube.operators.keys import sequential_key

SALES_DDL = ("product_id long, category_id long, product_name string, category_name string, quantity int, "
             "discount_percent decimal(5,2), sale_amount decimal(12,2), profit decimal(12,2), sale_date date, "
             "month int, year int, is_festival_month boolean, festival_name string")


def sale(pid, cat, name, qty, amount, profit, d, fest=None, disc="5.00"):
    d = dt.date.fromisoformat(d)
    return (pid, 1, name, cat, qty, Decimal(disc), Decimal(amount), Decimal(profit), d, d.month, d.year,
            None if fest == "null" else fest is not None, None if fest in (None, "null") else fest)


@pytest.fixture
def small_sales(spark):
    rows = [
        sale(1, "A", "rod", 2, "100.00", "20.00", "1997-03-01"),
        sale(2, "A", "rod", 1, "0.00", "-5.00", "1997-03-02"),            # zero amount (T2)
        sale(3, "B", "bolt", 3, "300.00", "30.00", "1997-11-12", "Diwali"),
        sale(4, "B", "nut", 1, "300.00", "60.00", "1998-01-05"),           # ties at the top-k cut
        sale(5, "C", "nut", 1, "50.00", "5.00", "1998-01-06", "null"),     # NULL festival flag (T17)
    ]
    return spark.createDataFrame(rows, SALES_DDL)


def test_zero_sale_amount_is_skipped_by_margin_average(small_sales):
    r = {x.category_name: x for x in kpi.category_performance(small_sales).collect()}
    assert r["A"].profit_margin_percent == 20.0       # only the non-zero row counts
    assert r["A"].total_orders == 2


def test_empty_overview_is_one_row(spark):
    empty = spark.createDataFrame([], SALES_DDL)
    rows = kpi.overview_totals(empty).collect()
    assert len(rows) == 1 and rows[0].total_orders == 0 and rows[0].total_revenue is None


def test_null_festival_is_its_own_group(small_sales):
    groups = {(r.is_festival_month, r.festival_name) for r in kpi.festival_comparison(small_sales).collect()}
    assert (None, None) in groups and (False, None) in groups and (True, "Diwali") in groups
    # NULL flag rows are neither festival nor non-festival days.
    assert kpi.non_festival_sales(small_sales).collect()[0].total_orders == 3


def test_top_k_limits_and_ties(small_sales):
    assert kpi.top_products(small_sales, 0).count() == 0
    assert kpi.top_products(small_sales, -1).count() == 4        # negative = no limit
    top = kpi.top_products(small_sales, 2).collect()
    # equal revenue at the cut: broken by name, so the result is deterministic
    assert [(r.product_name, r.category_name) for r in top] == [("bolt", "B"), ("nut", "B")]


def test_top_products_group_by_names(small_sales):
    r = {(x.product_name, x.category_name): x.times_sold for x in kpi.top_products(small_sales, None).collect()}
    assert r[("rod", "A")] == 2 and r[("nut", "B")] == 1 and r[("nut", "C")] == 1


def test_festival_window_edges(spark):
    cal = calendar.festival_calendar(spark, [("1997-11-12", "Diwali"), ("1997-11-13", "Diwali2"),
                                             ("1997-03-08", "Holi")])
    days = spark.createDataFrame([(dt.date(1997, 3, 3),), (dt.date(1997, 3, 2),), (dt.date(1997, 3, 13),),
                                  (dt.date(1997, 3, 14),), (dt.date(1997, 11, 18),), (dt.date(1997, 11, 7),)],
                                 "d date")
    out = {r.d: r.festival_name for r in calendar.tag_festival(days, "d", calendar.festival_days(cal)).collect()}
    assert out[dt.date(1997, 3, 3)] == "Holi"       # 5 days before
    assert out[dt.date(1997, 3, 2)] is None         # 6 days before
    assert out[dt.date(1997, 3, 13)] == "Holi"      # 5 days after
    assert out[dt.date(1997, 3, 14)] is None
    assert out[dt.date(1997, 11, 18)] == "Diwali2"  # only the second centre is within 5 days
    assert out[dt.date(1997, 11, 7)] == "Diwali"    # both windows: the first listed wins


def test_price_validity_end_points(spark):
    products = spark.createDataFrame(
        [(1, "rod", Decimal("10.00"), Decimal("20.00"))],
        "product_id long, product_name string, cost_price decimal(10,2), selling_price decimal(10,2)")
    v = temporal.price_versions(products)
    for day, price in [("1996-12-31", "18.00"), ("1997-01-01", "20.00"), ("1998-12-31", "20.00"),
                       ("1999-01-01", "22.00"), ("1994-12-31", None)]:
        rows = temporal.price_at_date(v, dt.date.fromisoformat(day)).collect()
        assert ([str(r.selling_price) for r in rows] or [None]) == [price]


def test_upsert_keeps_known_rows_and_numbers_new(spark):
    base = spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "category_id long, category_name string, description string")
    inc = spark.createDataFrame([("B", "new b"), ("C", "c"), ("C", "c again")], "category_name string, description string")
    out = {r.category_name: r for r in layout.upsert(base, inc, "category_name", id_col="category_id").collect()}
    assert out["B"].description == "b" and out["B"].category_id == 2
    assert out["C"].category_id == 3 and len(out) == 3
    upd = {r.category_name: r.description for r in
           layout.upsert(base, inc, "category_name", id_col="category_id", update_columns=["description"]).collect()}
    assert upd["B"] == "new b"


def test_insert_absent(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    inc = spark.createDataFrame([(2,), (3,), (3,)], "k int")
    assert sorted(r.k for r in layout.insert_absent(base, inc, "k").collect()) == [3]


def test_sequential_key_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k"))
    out = sequential_key(df, "k", "key", 7)
    bad = out.withColumn("rn", F.row_number().over(__import__("pyspark.sql").sql.Window.orderBy("k"))) \
             .filter(F.col("rn") != F.col("key")).count()
    assert bad == 0 and out.count() == 5000
    other = sequential_key(df, "k", "key")                       # at the session's width
    assert other.join(out, ["k", "key"]).count() == 5000
    assert sequential_key(df.filter("k < 0"), "k", "key").count() == 0


def test_invariants(wh):
    s = wh.sales()
    total = kpi.overview_totals(s).collect()[0]
    monthly = kpi.monthly_sales_summary(s).agg(F.sum("total_orders"), F.sum("total_quantity")).collect()[0]
    assert monthly[0] == total.total_orders and monthly[1] == total.total_items_sold
    split = kpi.festival_split(s).agg(F.sum("orders")).collect()[0][0]
    assert split == total.total_orders
    roll = {r.year: r.yearly_sales for r in olap.rollup_year(s).collect()}
    drill = olap.drilldown_year(s, 1997).agg(F.sum("monthly_sales")).collect()[0][0]
    assert abs(roll[1997] - drill) < 1e-6
    cats = olap.category_names(wh.categories())
    piv = olap.pivot_month_category(s, cats).filter("year = 1997").fillna(0)
    piv_total = piv.select(sum(F.col(c) for c in cats).alias("t")).agg(F.sum("t")).collect()[0][0]
    assert abs(piv_total - roll[1997]) < 1e-3


def test_fragments_reconstruct_source(spark, wh):
    path = f"{wh.root}/sales"
    years = [r[0] for r in wh.sales().select("year").distinct().collect()]
    unified = layout.unify([layout.read_fragment(spark, path, y) for y in years])
    assert unified.exceptAll(spark.read.parquet(path)).count() == 0
    assert spark.read.parquet(path).exceptAll(unified).count() == 0


def test_latest_months_limits(small_sales):
    monthly = kpi.monthly_sales_summary(small_sales)
    assert kpi.latest_months(monthly, 0).count() == 0
    assert kpi.latest_months(monthly, -1).count() == monthly.count()
    top = kpi.latest_months(monthly, 2).collect()
    assert [(r.year, r.month) for r in top] == [(1998, 1), (1997, 11)]


def test_duplicate_dimension_key_is_refused(spark):
    import pytest as _pytest
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "product_id long, name string")
    with _pytest.raises(ValueError):
        layout.assert_unique(dim, "product_id")
    layout.assert_unique(dim.dropDuplicates(["product_id"]), "product_id")


def test_yearly_festivals_follow_the_data(spark):
    span = spark.sql("SELECT 2002 AS y0, 2003 AS y1")
    days = calendar.festival_days(calendar.yearly_festivals(span))
    sales = spark.sql("SELECT DATE'2003-12-25' AS d UNION ALL SELECT DATE'2003-11-17' UNION ALL SELECT DATE'2003-07-01'")
    got = {str(r.d): r.festival_name for r in calendar.tag_festival(sales, "d", days).collect()}
    assert got == {"2003-12-25": "Christmas", "2003-11-17": "Diwali", "2003-07-01": None}


def test_changed_input_is_loaded_again(spark, sf_dir, tmp_path):
    from tillcube.sources import retail
    for t in ("part", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(50).write.parquet(str(tmp_path / f"{t}.parquet"))
    first = retail.load_warehouse(spark, str(tmp_path), layout_tables=False)
    assert retail.load_warehouse(spark, str(tmp_path), layout_tables=False) is first
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(20).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert retail.load_warehouse(spark, str(tmp_path), layout_tables=False).root != first.root
