"""The registered queries: name -> (Spark callable, DuckDB twin or None).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame built from
the driver tables in ``sf_dir`` (through the written warehouse of
``sources.retail``).  Column names equal the reference's aliases and are
the same in the twin.  Default parameters follow FIXTURES.md.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from . import schemas
from .functions import money
from .operators import calendar, forest, kpi, layout, ml, olap, star, temporal
from .session import new_table_path
from .sources import documents, retail, tables, views
from .sources.batches import BatchTable
from .sources.live import LiveSales

# Default parameters (FIXTURES.md).
YEAR = 1997
CATEGORY = "ECONOMY"
TOP_K = 10
RANGE_START = dt.date(1997, 1, 1)
RANGE_END = dt.date(1997, 12, 31)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def wh(spark: SparkSession, sf_dir: str) -> retail.Warehouse:
    return retail.load_warehouse(spark, sf_dir)


# --------------------------------------------------------------------- sources
@register("scan_sales", O.q(f"select {O.SALES_COLS} from sales"))
def q_scan_sales(spark, sf_dir):
    """The sales table as written by the load."""
    return wh(spark, sf_dir).sales()


@register("sale_economics", O.q("""
select l.l_partkey as product_id, cast(l.l_quantity as int) as quantity,
       cast(l.l_discount * 100 as decimal(5,2)) as discount_percent,
       p.selling_price, p.cost_price,
       cast(cast(l_quantity as int) * p.selling_price * (1 - cast(l_discount as decimal(4,2))) as decimal(12,2)) as sale_amount,
       cast(cast(l_quantity as int) * p.selling_price * (1 - cast(l_discount as decimal(4,2)))
            - cast(l_quantity as int) * p.cost_price as decimal(12,2)) as profit
from lineitem l join products p on l.l_partkey = p.product_id
"""))
def q_sale_economics(spark, sf_dir):
    """P10 on every line item: amount and profit from quantity, prices, discount."""
    w = wh(spark, sf_dir)
    li = tables.lineitem(spark, sf_dir).select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_discount") * 100).cast(money.PERCENT).alias("discount_percent"))
    p = w.products().select("product_id", "selling_price", "cost_price")
    s = li.join(p, "product_id")
    return s.select(
        "product_id", "quantity", "discount_percent", "selling_price", "cost_price",
        money.sale_amount("quantity", "selling_price", "discount_percent").alias("sale_amount"),
        money.sale_profit("quantity", "selling_price", "cost_price", "discount_percent").alias("profit"))


@register("margin_percent", O.q("""
select order_key, line_number, product_id, sale_amount, profit,
       case when sale_amount > 0 then cast(profit as double) / cast(sale_amount as double) * 100 else 0 end as margin_percent
from sales"""))
def q_margin_percent(spark, sf_dir):
    """The guarded margin of every sale."""
    s = wh(spark, sf_dir).sales()
    guarded = money.guarded_percent(F.col("profit").cast("double"), F.col("sale_amount").cast("double"))
    return s.select("order_key", "line_number", "product_id", "sale_amount", "profit", guarded.alias("margin_percent"))


@register("star_join_sales", O.q("""
select s.order_key, s.line_number, s.product_id, p.product_name, s.category_id, c.category_name, s.quantity, s.sale_amount,
       p.selling_price, c.description
from sales s join products p on s.product_id = p.product_id join categories c on s.category_id = c.category_id"""))
def q_star_join_sales(spark, sf_dir):
    """Sales with their product and the category that the sale itself names."""
    w = wh(spark, sf_dir)
    j = kpi.star_join(w.sales(), w.products(), w.categories())
    return j.select("order_key", "line_number", "product_id", "product_name", "category_id", "category_name", "quantity", "sale_amount", "selling_price", "description")


# How the arriving rows are spoiled: order keys of these remainders.
SPOILED_SQL = "order_key % 50"


def _declared(spark, w):
    """The sales as text, some spoiled, read under the declared types and rules."""
    def build():
        rest = F.col("order_key") % 50
        raw = w.sales()
        raw = (raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns], rest.alias("rest"))
               .withColumn("quantity", F.when(F.col("rest") == 7, F.lit("many")).otherwise(F.col("quantity")))
               .withColumn("sale_amount", F.when(F.col("rest") != 8, F.col("sale_amount")))
               .withColumn("month", F.when(F.col("rest") == 9, F.lit("13")).otherwise(F.col("month")))
               .withColumn("year", F.when(F.col("rest") == 9, F.lit("x")).otherwise(F.col("year"))))
        path = new_table_path(spark, "sales_declared")
        return schemas.read_declared(raw, "sales", path)
    return _once(w, "declared", build)


@register("sales_accepted", O.q(f"select {O.SALES_COLS} from sales where {SPOILED_SQL} not in (7, 8, 9)"))
def q_sales_accepted(spark, sf_dir):
    """S3: the arriving rows that meet the declared types, NOT NULL columns and checks."""
    return _declared(spark, wh(spark, sf_dir))[0]


@register("sales_rejected", O.q(f"""
select order_key, line_number, product_id,
       case {SPOILED_SQL} when 7 then 'quantity: not a value of int' when 8 then 'sale_amount: missing'
            else 'year: not a value of int; month: not that of sale_date' end as reject_reason
from sales where {SPOILED_SQL} in (7, 8, 9)"""))
def q_sales_rejected(spark, sf_dir):
    """S3: the other arriving rows, each with its reason."""
    return _declared(spark, wh(spark, sf_dir))[1].select("order_key", "line_number", "product_id", "reject_reason")


@register("festival_tag", O.q("""
select d as sale_date, tag.festival_name is not null as is_festival_month, tag.festival_name
from days left join tag using (d)
"""))
def q_festival_tag(spark, sf_dir):
    """Every distinct sale day tagged with its festival."""
    days = tables.lineitem(spark, sf_dir).select(F.to_date("l_shipdate").alias("sale_date")).distinct()
    return calendar.tag_festival(days, "sale_date", wh(spark, sf_dir).festival_days())


DIM_TIME_SQL = """,
span as (select cast(year(min(l_shipdate)) as int) as y0, cast(year(max(l_shipdate)) as int) as y1 from lineitem),
spine as (select cast(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), interval 1 day)) as date) as d from span),
alltag as (select s.d, min_by(nm, o) as festival_name from spine s join fest on abs(datediff('day', fd, s.d)) <= 5 group by s.d),
dim_time as (
  select cast(strftime(s.d, '%Y%m%d') as int) as date_key, s.d as full_date,
         cast(day(s.d) as int) as day, cast(month(s.d) as int) as month, monthname(s.d) as month_name,
         cast(quarter(s.d) as int) as quarter, cast(year(s.d) as int) as year,
         cast(isodow(s.d) - 1 as int) as day_of_week, dayname(s.d) as day_name,
         isodow(s.d) >= 6 as is_weekend,
         alltag.festival_name is not null as is_festival, alltag.festival_name
  from spine s left join alltag using (d))
"""


def with_dim_time(body: str) -> str:
    return O.q(DIM_TIME_SQL + body)


@register("dim_time", with_dim_time("select * from dim_time"))
def q_dim_time(spark, sf_dir):
    """T-DIM: the calendar over the sales years, festival-tagged."""
    return wh(spark, sf_dir).dim_time()


@register("month_festival_flag", with_dim_time("""
select month, min_by(is_festival, date_key) as is_festival, bool_or(is_festival) as any_festival_day
from dim_time group by month"""))
def q_month_festival_flag(spark, sf_dir):
    """Festival flag per month, deterministic form of ``LIMIT 1``."""
    return calendar.month_festival_flag(wh(spark, sf_dir).dim_time())


# ------------------------------------------------------------------------ KPIs
@register("overview_totals", O.q(f"""
select count(*) as total_orders, {O.msum('sale_amount')} as total_revenue, {O.msum('profit')} as total_profit,
       {O.avg('sale_amount')} as avg_order_value, cast(sum(quantity) as bigint) as total_items_sold
from sales"""))
def q_overview_totals(spark, sf_dir):
    return kpi.overview_totals(wh(spark, sf_dir).summary())


MONTHLY_SQL = f"""
select year, month, count(*) as total_orders, cast(sum(quantity) as bigint) as total_quantity,
       {O.msum('sale_amount')} as total_sales, {O.msum('profit')} as total_profit,
       {O.avg('discount_percent')} as avg_discount,
       cast(sum(case when is_festival_month then sale_amount else 0 end) as double) as festival_sales
from sales group by year, month"""


@register("monthly_sales_summary", O.q(MONTHLY_SQL + " order by year, month"))
def q_monthly(spark, sf_dir):
    return kpi.monthly_sales_summary(wh(spark, sf_dir).summary())


@register("latest_24_months", O.q(f"""
select year, month, total_sales, total_profit from ({MONTHLY_SQL}) m
order by year desc, month desc limit 24"""))
def q_latest_24(spark, sf_dir):
    return kpi.latest_months(kpi.monthly_sales_summary(wh(spark, sf_dir).summary()), 24)


@register("category_performance", O.q(f"""
select c.category_name, count(*) as total_orders, cast(sum(s.quantity) as bigint) as total_quantity,
       {O.msum('s.sale_amount')} as total_sales, {O.msum('s.profit')} as total_profit,
       {O.avg('s.discount_percent')} as avg_discount,
       round(avg(cast(s.profit as double) / nullif(cast(s.sale_amount as double), 0) * 100), 2) as profit_margin_percent
from sales s join categories c on s.category_id = c.category_id
group by c.category_name order by total_sales desc"""))
def q_category_performance(spark, sf_dir):
    return kpi.category_performance(wh(spark, sf_dir).summary())


@register("category_performance_joined", ORACLE["category_performance"])
def q_category_performance_joined(spark, sf_dir):
    """J1 with D3: from the sales' category ids, joined to the categories."""
    w = wh(spark, sf_dir)
    return kpi.category_performance(kpi.with_category_names(w.sales(), w.categories()))


@register("top_products", O.q(f"""
select p.product_name, c.category_name, count(*) as times_sold,
       cast(sum(s.quantity) as bigint) as total_quantity_sold,
       {O.msum('s.sale_amount')} as total_revenue, {O.msum('s.profit')} as total_profit
from sales s join products p on s.product_id = p.product_id
join categories c on s.category_id = c.category_id
group by p.product_name, c.category_name
order by total_revenue desc, p.product_name, c.category_name limit {TOP_K}"""))
def q_top_products(spark, sf_dir):
    return kpi.top_products(wh(spark, sf_dir).product_summary(), TOP_K)


@register("festival_comparison", O.q(f"""
select is_festival_month, festival_name, count(*) as total_orders,
       {O.msum('sale_amount')} as total_sales, {O.msum('profit')} as total_profit,
       {O.avg('sale_amount')} as avg_order_value
from sales group by is_festival_month, festival_name"""))
def q_festival_comparison(spark, sf_dir):
    return kpi.festival_comparison(wh(spark, sf_dir).summary())


@register("festival_split", O.q(f"""
select is_festival_month, count(*) as orders, {O.msum('sale_amount')} as sales, {O.msum('profit')} as profit
from sales group by is_festival_month"""))
def q_festival_split(spark, sf_dir):
    return kpi.festival_split(wh(spark, sf_dir).summary())


FIVE = f"""count(*) as total_orders, {O.msum('sale_amount')} as total_sales, {O.msum('profit')} as total_profit,
       {O.avg('sale_amount')} as avg_order_value, {O.avg('discount_percent')} as avg_discount"""


@register("festival_sales", O.q(f"""
select festival_name, {FIVE} from sales where is_festival_month group by festival_name"""))
def q_festival_sales(spark, sf_dir):
    return kpi.festival_sales(wh(spark, sf_dir).summary())


@register("non_festival_sales", O.q(f"select {FIVE} from sales where not is_festival_month"))
def q_non_festival_sales(spark, sf_dir):
    return kpi.non_festival_sales(wh(spark, sf_dir).summary())


@register("category_monthly", O.q(f"""
select s.year, s.month, count(*) as total_orders, {O.msum('s.sale_amount')} as total_sales,
       {O.msum('s.profit')} as total_profit, {O.avg('s.discount_percent')} as avg_discount
from sales s join categories c on s.category_id = c.category_id
where c.category_name = '{CATEGORY}' group by s.year, s.month"""))
def q_category_monthly(spark, sf_dir):
    return kpi.category_monthly(wh(spark, sf_dir).summary(), CATEGORY)


@register("sales_summary_range", O.q(f"""
select count(*) as total_orders, {O.msum('sale_amount')} as total_revenue, {O.msum('profit')} as total_profit,
       {O.avg('sale_amount')} as avg_order_value, cast(sum(quantity) as bigint) as total_items_sold
from sales where sale_date between date '{RANGE_START}' and date '{RANGE_END}'"""))
def q_sales_summary_range(spark, sf_dir):
    return kpi.sales_summary_range(wh(spark, sf_dir).summary(), RANGE_START, RANGE_END)


@register("sales_date_range", O.q(f"""
select {O.SALES_COLS} from sales where sale_date between date '{RANGE_START}' and date '{RANGE_END}'"""))
def q_sales_date_range(spark, sf_dir):
    return kpi.sales_in_range(wh(spark, sf_dir).sales(), RANGE_START, RANGE_END)


@register("category_list", O.q("select category_name from categories order by category_name"))
def q_category_list(spark, sf_dir):
    return kpi.category_list(wh(spark, sf_dir).categories())


@register("category_avg_price", O.q(f"""
select category_id, {O.avg('cost_price')} as c, {O.avg('selling_price')} as s
from products group by category_id"""))
def q_category_avg_price(spark, sf_dir):
    return kpi.category_avg_price(wh(spark, sf_dir).products())


# ------------------------------------------------------------------------ OLAP
@register("olap_rollup", O.q(f"""
select year, {O.msum('sale_amount')} as yearly_sales, {O.msum('profit')} as yearly_profit
from sales group by year order by year"""))
def q_olap_rollup(spark, sf_dir):
    return olap.rollup_year(wh(spark, sf_dir).summary())


@register("olap_drilldown", O.q(f"""
select month, {O.msum('sale_amount')} as monthly_sales, {O.msum('profit')} as monthly_profit, count(*) as orders
from sales where year = {YEAR} group by month order by month"""))
def q_olap_drilldown(spark, sf_dir):
    return olap.drilldown_year(wh(spark, sf_dir).summary(), YEAR)


@register("olap_slice", O.q(f"""
select c.category_name, count(*) as orders, {O.msum('s.sale_amount')} as total_sales, {O.msum('s.profit')} as total_profit
from sales s join categories c on s.category_id = c.category_id
where s.year = {YEAR} group by c.category_name order by total_sales desc"""))
def q_olap_slice(spark, sf_dir):
    return olap.slice_year(wh(spark, sf_dir).summary(), YEAR)


@register("olap_dice", O.q(f"""
select s.month, count(*) as orders, {O.msum('s.sale_amount')} as total_sales, {O.msum('s.profit')} as total_profit,
       {O.avg('s.discount_percent')} as avg_discount
from sales s join categories c on s.category_id = c.category_id
where s.year = {YEAR} and c.category_name = '{CATEGORY}' group by s.month order by s.month"""))
def q_olap_dice(spark, sf_dir):
    return olap.dice_year_category(wh(spark, sf_dir).summary(), YEAR, CATEGORY)


# Pivot columns: the six category names of the driver's part table.
PIVOT_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("olap_pivot", O.q("select year, month, " + ", ".join(
    f"cast(sum(case when category_name = '{c}' then sale_amount end) as double) as \"{c}\""
    for c in PIVOT_CATEGORIES) + " from sales group by year, month order by year, month"))
def q_olap_pivot(spark, sf_dir):
    w = wh(spark, sf_dir)
    return olap.pivot_month_category(w.summary(), olap.category_names(w.categories()))


@register("olap_pivot_month", O.q("select month, " + ", ".join(
    f"cast(sum(case when category_name = '{c}' then sale_amount end) as double) as \"{c}\""
    for c in PIVOT_CATEGORIES) + " from sales group by month order by month"))
def q_olap_pivot_month(spark, sf_dir):
    """The twelve months as rows, over all years."""
    w = wh(spark, sf_dir)
    return olap.pivot_month_category(w.summary(), olap.category_names(w.categories()), ("month",))


# -------------------------------------------------------------------- temporal
PRICE_DATE = dt.date(1998, 6, 1)
CREATED_AFTER = dt.datetime(1999, 1, 1)

VERSIONS_SQL = """,
versions as (
  select product_id, product_name,
         cast(cost_price * v.k as decimal(10,2)) as cost_price,
         cast(selling_price * v.k as decimal(10,2)) as selling_price,
         v.vf as valid_from, v.vt as valid_to
  from products cross join (values (date '1995-01-01', date '1996-12-31', cast(0.9 as decimal(2,1))),
                                   (date '1997-01-01', date '1998-12-31', cast(1.0 as decimal(2,1))),
                                   (date '1999-01-01', date '9999-12-31', cast(1.1 as decimal(2,1)))) v(vf, vt, k))
"""


@register("sales_created_after", O.q(f"""
select {O.SALES_COLS} from sales where created_at > timestamp '{CREATED_AFTER}'"""))
def q_sales_created_after(spark, sf_dir):
    """Transaction-time lower bound (strict)."""
    return temporal.created_after(wh(spark, sf_dir).sales(), CREATED_AFTER)


@register("price_at_date", O.q(VERSIONS_SQL + f"""
select * from versions where date '{PRICE_DATE}' between valid_from and valid_to"""))
def q_price_at_date(spark, sf_dir):
    """Every product's price version valid on the given date."""
    return temporal.price_at_date(temporal.price_versions(wh(spark, sf_dir).products()), PRICE_DATE)


@register("sales_price_asof", O.q(VERSIONS_SQL + f"""
select s.year, count(*) as orders,
       {O.msum('s.quantity * v.selling_price')} as list_revenue,
       {O.msum('s.quantity * v.cost_price')} as list_cost
from sales s join versions v on s.product_id = v.product_id
 and s.sale_date between v.valid_from and v.valid_to
group by s.year order by s.year"""))
def q_sales_price_asof(spark, sf_dir):
    """Sales priced at the version valid on each sale date, per year."""
    w = wh(spark, sf_dir)
    return temporal.revenue_at_date_prices(w.sales(), temporal.price_versions(w.products()))


@register("sales_price_rows", O.q(VERSIONS_SQL + """
select s.order_key, s.line_number, s.product_id, s.sale_date, s.quantity, v.selling_price as price_at_date,
       v.cost_price as cost_at_date, v.valid_from
from sales s join versions v on s.product_id = v.product_id and s.sale_date between v.valid_from and v.valid_to"""))
def q_sales_price_rows(spark, sf_dir):
    """Every sale with the price and cost valid on its date."""
    w = wh(spark, sf_dir)
    priced = temporal.sales_with_price_at_date(w.sales(), temporal.price_versions(w.products()))
    return priced.select("order_key", "line_number", "product_id", "sale_date", "quantity", "price_at_date", "cost_at_date", "valid_from")


@register("product_versions_sample", O.q("""
select product_name, cost_price, selling_price, valid_from, valid_to from products order by product_id limit 5"""))
def q_product_versions_sample(spark, sf_dir):
    return temporal.versions_sample(wh(spark, sf_dir).products())


@register("product_audit_sample", O.q("""
select product_name, created_at, updated_at from products order by product_id limit 5"""))
def q_product_audit_sample(spark, sf_dir):
    return temporal.audit_sample(wh(spark, sf_dir).products())


# ---------------------------------------------------------------------- layout
FRAGMENT_YEAR = 1997
FRAGMENT_MONTH_YEAR, FRAGMENT_MONTH = 1996, 11

_BUILT: dict[tuple[str, str], object] = {}
_BUILD_LOCK = threading.RLock()


def _once(w: retail.Warehouse, what: str, build):
    """Jobs that write (appends, upserts, exports, training, scoring) run once
    per warehouse load; later calls read what they wrote."""
    key = (w.root, what)
    with _BUILD_LOCK:
        if key not in _BUILT:
            _BUILT[key] = build()
        return _BUILT[key]


@register("sales_fragment", O.q(f"select {O.SALES_COLS} from sales where year = {FRAGMENT_YEAR}"))
def q_sales_fragment(spark, sf_dir):
    """H1: one year's fragment (a partition filter)."""
    w = wh(spark, sf_dir)
    return layout.fragment_of(w.sales(), FRAGMENT_YEAR)


@register("fragment_month", O.q(f"""
select {O.SALES_COLS} from sales where year = {FRAGMENT_MONTH_YEAR} and month = {FRAGMENT_MONTH}"""))
def q_fragment_month(spark, sf_dir):
    """``SELECT * FROM sales_<year> WHERE month = 11``."""
    w = wh(spark, sf_dir)
    frag = layout.fragment_of(w.sales(), FRAGMENT_MONTH_YEAR)
    return frag.filter(F.col("month") == FRAGMENT_MONTH)


@register("sales_unified", O.q(f"select {O.SALES_COLS} from sales"))
def q_sales_unified(spark, sf_dir):
    """The bag of all year fragments, in one read of the partitioned table
    (rows without a date, under the null partition, included)."""
    return wh(spark, sf_dir).sales()


BASIC_SQL = "select product_id, product_name, category_id, stock_quantity, created_at from products"
PRICING_SQL = "select product_id, cost_price, selling_price, valid_from, valid_to, updated_at from products"


@register("products_basic", O.q(BASIC_SQL))
def q_products_basic(spark, sf_dir):
    """H2: identity column group."""
    return spark.table(wh(spark, sf_dir).basic_table)


@register("products_pricing", O.q(PRICING_SQL))
def q_products_pricing(spark, sf_dir):
    """H2: pricing column group."""
    return spark.table(wh(spark, sf_dir).pricing_table)


@register("products_reconstructed", O.q("""
select product_id, product_name, category_id, stock_quantity, cost_price, selling_price,
       valid_from, valid_to, created_at, updated_at from products"""))
def q_products_reconstructed(spark, sf_dir):
    """Join of the two column groups (bucketed alike: no shuffle)."""
    w = wh(spark, sf_dir)
    return layout.reconstruct_products(spark.table(w.basic_table), spark.table(w.pricing_table))


@register("append_sales", O.q(f"select {O.SALES_COLS} from sales"))
def q_append_sales(spark, sf_dir):
    """The sales up to 1997 as one batch, the rest as another that a retry
    sends twice; the table is read back."""
    w = wh(spark, sf_dir)

    def build():
        s = w.sales()
        table = BatchTable(spark, new_table_path(spark, "sales_appended"))
        table.append(s.filter("year <= 1997"), "to-1997")
        for _ in range(2):
            table.append(s.filter("year > 1997"), "from-1998")
        return table
    return _once(w, "append", build).read().select(*retail.SALES_COLUMNS)


def _live(spark, w) -> LiveSales:
    """A live store of the sales to 1997, to which the later years were
    appended in two batches, the second one twice."""
    def build():
        live = LiveSales(spark, new_table_path(spark, "live_sales"))
        s = w.sales()
        live.append(s.filter("year <= 1997"), "to-1997")
        live.append(s.filter("year = 1998"), "1998")
        for _ in range(2):
            live.append(s.filter("year > 1998"), "from-1999")
        return live
    return _once(w, "live", build)


@register("live_overview", ORACLE["overview_totals"])
def q_live_overview(spark, sf_dir):
    """S4 with D1: the totals after three appended batches, from the merged daily summary."""
    return kpi.overview_totals(_live(spark, wh(spark, sf_dir)).daily_summary())


@register("live_monthly_summary", ORACLE["monthly_sales_summary"])
def q_live_monthly(spark, sf_dir):
    """S4 with D2/S13: the monthly view after the appends."""
    return kpi.monthly_sales_summary(_live(spark, wh(spark, sf_dir)).daily_summary())


@register("live_top_products", ORACLE["top_products"])
def q_live_top_products(spark, sf_dir):
    """S4 with D4: the product ranking after the appends."""
    return kpi.top_products(_live(spark, wh(spark, sf_dir)).product_summary(), TOP_K)


@register("live_sales", ORACLE["scan_sales"])
def q_live_sales(spark, sf_dir):
    """Every sale of the committed batches, once."""
    return _live(spark, wh(spark, sf_dir)).sales().select(*retail.SALES_COLUMNS)


NEW_CATEGORY = "SEASONAL"


@register("upsert_categories", O.q(f"""
select category_id, category_name, description from categories
union all
select (select max(category_id) from categories) + 1, '{NEW_CATEGORY}', '{NEW_CATEGORY} products for retail'"""))
def q_upsert_categories(spark, sf_dir):
    """Upsert two known names (with a new description) and one new name by name.

    As in the reference, a conflict only re-sets the name, so the known rows
    keep their description; the new name gets the next id.
    """
    w = wh(spark, sf_dir)
    base = w.categories()
    known = base.orderBy("category_name").limit(2).select(
        "category_name", F.lit("updated description").alias("description"))
    new = spark.range(1).select(F.lit(NEW_CATEGORY).alias("category_name"),
                                F.lit(NEW_CATEGORY + retail.CATEGORY_DESCRIPTION_SUFFIX).alias("description"))

    def build():
        path = new_table_path(spark, "categories_upserted")
        layout.upsert(base, known.unionByName(new), "category_name", id_col="category_id").write.parquet(path)
        return path
    return spark.read.parquet(_once(w, "upsert", build))


@register("insert_absent_dim_time", with_dim_time("""
select * from dim_time where year = 1996 or full_date between date '1997-01-01' and date '1997-01-10'"""))
def q_insert_absent_dim_time(spark, sf_dir):
    """A 1996 calendar receives 22 Dec 1996 - 10 Jan 1997; only the new days are added."""
    w = wh(spark, sf_dir)

    def build():
        path = new_table_path(spark, "dim_time_1996")
        dim = w.dim_time()
        dim.filter(F.col("year") == 1996).write.parquet(path)
        incoming = dim.filter(F.col("full_date").between(dt.date(1996, 12, 22), dt.date(1997, 1, 10)))
        layout.insert_absent_into(spark, path, incoming, "date_key")
        return path
    return spark.read.parquet(_once(w, "insert_absent", build))


@register("replicate_products", O.q("""
select product_id, product_name, category_id, cost_price, selling_price, stock_quantity from products"""))
def q_replicate_products(spark, sf_dir):
    """The replica after a full refresh (the refresh stamp is left out)."""
    w = wh(spark, sf_dir)
    return w.read(w.replica_path).drop("replicated_at")


@register("replication_status", O.q("""
select count(*) as master_records, (select count(*) from products) as replica_records,
       true as replicated from products"""))
def q_replication_status(spark, sf_dir):
    """Counts of master and replica; whether the replica carries a refresh stamp."""
    w = wh(spark, sf_dir)
    st = layout.replication_status(w.read(w.master_path), w.read(w.replica_path))
    return st.select("master_records", "replica_records", F.col("last_replicated").isNotNull().alias("replicated"))


DIMS_SQL = """,
dim_category as (
  select row_number() over (order by category_id) as category_key, category_id, category_name,
         category_name || ' products' as description from categories),
dim_product as (
  select row_number() over (order by p.product_id) as product_key, p.product_id, p.product_name,
         c.category_name, p.cost_price, p.selling_price
  from products p join categories c on p.category_id = c.category_id)
"""


@register("dim_category", O.q(DIMS_SQL + "select * from dim_category"))
def q_dim_category(spark, sf_dir):
    """Category dimension with sequential surrogate keys."""
    w = wh(spark, sf_dir)
    return w.read(w.star["dim_category"])


@register("dim_product", O.q(DIMS_SQL + "select * from dim_product"))
def q_dim_product(spark, sf_dir):
    """Product dimension, keys assigned without a single-partition window."""
    w = wh(spark, sf_dir)
    return w.read(w.star["dim_product"])


FACT_SQL = O.q(DIMS_SQL + """
select cast(strftime(s.sale_date, '%Y%m%d') as int) as date_key, dp.product_key, dc.category_key,
       s.quantity, s.discount_percent, s.sale_amount, s.profit,
       cast(s.sale_amount - s.profit as decimal(12,2)) as cost_amount
from sales s join dim_product dp on s.product_id = dp.product_id
join dim_category dc on s.category_id = dc.category_id""")


@register("load_fact_sales", FACT_SQL)
def q_load_fact_sales(spark, sf_dir):
    """The fact table of the star load (generated fact ids left out)."""
    w = wh(spark, sf_dir)
    f = w.read(w.star["fact_sales"])
    return f.select(*layout.FACT_COLUMNS)


@register("fragmentation_counts", O.q(f"""
select 'sales_' || cast(year as varchar) as relation, count(*) as row_count from sales group by year
union all select 'sales_unified', count(*) from sales
union all select 'products_basic', count(*) from products
union all select 'products_pricing', count(*) from products
union all select 'products_reconstructed', count(*) from products"""))
def q_fragmentation_counts(spark, sf_dir):
    """Rows per horizontal fragment, the unified view and the vertical fragments."""
    w = wh(spark, sf_dir)
    frags = w.sales()
    b, p = spark.table(w.basic_table), spark.table(w.pricing_table)
    others = layout.labelled_counts([
        ("sales_unified", frags),
        ("products_basic", b),
        ("products_pricing", p),
        ("products_reconstructed", layout.reconstruct_products(b, p)),
    ])
    return layout.year_fragment_counts(frags).unionByName(others)


# The role of every star table, an output of the report.
STAR_ROLES = {"fact_sales": "Fact table", "dim_time": "Date/festival info", "dim_product": "Product details", "dim_category": "Category grouping"}


@register("star_schema_counts", with_dim_time(DIMS_SQL + """
select 'fact_sales' as table_name, 'Fact table' as role, count(*) as row_count from sales
union all select 'dim_time', 'Date/festival info', count(*) from dim_time
union all select 'dim_product', 'Product details', count(*) from dim_product
union all select 'dim_category', 'Category grouping', count(*) from dim_category"""))
def q_star_schema_counts(spark, sf_dir):
    """Rows of the fact table and each dimension, with its role."""
    w = wh(spark, sf_dir)
    frames = {name: w.read(path) for name, path in w.star.items()} | {"dim_time": w.dim_time()}
    counts = layout.labelled_counts(list(frames.items()), "table_name")
    role = F.create_map(*[F.lit(x) for named in STAR_ROLES.items() for x in named])
    return counts.select("table_name", role[F.col("table_name")].alias("role"), "row_count")


# The first load knows the even products and the years to 1997, the second all.
KEYS_SQL = """,
keyed as (select product_id, row_number() over (order by product_id % 2, product_id) as product_key from products),
dim_category as (select row_number() over (order by category_id) as category_key, category_id from categories)
"""


def _refreshed_star(spark, w) -> star.StarStore:
    def build():
        store = star.StarStore(spark, new_table_path(spark, "star_store"))
        even = w.products().filter("product_id % 2 = 0")
        store.refresh(w.sales().filter("year <= 1997 AND product_id % 2 = 0"), even, w.categories())
        for _ in range(2):      # the second time nothing has changed
            store.refresh(w.sales(), w.products(), w.categories())
        return store
    return _once(w, "star_store", build)


@register("star_refresh_facts", O.q(KEYS_SQL + """
select cast(strftime(s.sale_date, '%Y%m%d') as int) as date_key, k.product_key, c.category_key, s.quantity,
       s.discount_percent, s.sale_amount, s.profit, cast(s.sale_amount - s.profit as decimal(12,2)) as cost_amount
from sales s join keyed k on s.product_id = k.product_id join dim_category c on s.category_id = c.category_id"""))
def q_star_refresh_facts(spark, sf_dir):
    """The facts after a partial load, a full one and a repeated one."""
    return _refreshed_star(spark, wh(spark, sf_dir)).fact_sales().select(*layout.FACT_COLUMNS)


@register("star_refresh_products", O.q(KEYS_SQL + """
select k.product_key, p.product_id, p.product_name, c.category_name, p.cost_price, p.selling_price
from products p join keyed k on p.product_id = k.product_id join categories c on p.category_id = c.category_id"""))
def q_star_refresh_products(spark, sf_dir):
    """Product keys that the first load gave stay, new products follow."""
    return _refreshed_star(spark, wh(spark, sf_dir)).dim_product()


@register("load_summary", O.q("""
select 'categories' as label, cast(count(*) as double) as value from categories
union all select 'products', count(*) from products
union all select 'sales', count(*) from sales
union all select 'festival_sales', count(*) from sales where is_festival_month
union all select 'sales_' || cast(year as varchar), count(*) from sales group by year
union all select 'fact_sales', count(*) from sales
union all select 'revenue', cast(sum(sale_amount) as double) from sales
union all select 'profit', cast(sum(profit) as double) from sales"""))
def q_load_summary(spark, sf_dir):
    """The load job's closing counts and totals."""
    w = wh(spark, sf_dir)
    s = w.sales()
    one = s.agg(F.count(F.lit(1)).cast("double").alias("sales"), F.count_if(F.col("is_festival_month")).cast("double").alias("festival_sales"),
                money.money_sum("sale_amount").alias("revenue"), money.money_sum("profit").alias("profit"))
    totals = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("value")) for c in one.columns])))
    counts = layout.labelled_counts([("categories", w.categories()), ("products", w.products()), ("fact_sales", w.read(w.star["fact_sales"]))])
    counts = counts.unionByName(layout.year_fragment_counts(s))
    return totals.unionByName(counts.select(F.col("relation").alias("label"), F.col("row_count").cast("double").alias("value")))


# -------------------------------------------------------------------------- ML
TRAIN_SQL = """,
train as (
  select s.order_key, s.line_number, s.product_id, p.product_name, s.category_name, s.quantity,
         s.discount_percent, s.sale_amount, s.profit, s.month, s.year, s.is_festival_month,
         p.cost_price, p.selling_price
  from sales s join products p on s.product_id = p.product_id),
cat_avg as (select category_name, """ + O.avg("sale_amount") + """ as category_avg_sale from sales group by category_name),
mon_avg as (select month, """ + O.avg("sale_amount") + """ as month_avg_sale from sales group by month),
enc as (select category_name, cast(dense_rank() over (order by category_name) - 1 as double) as category_encoded
        from categories)
"""
SPLIT_SQL = "((order_key % 1000003) * 2654435761 + line_number * 40503 + 42) % 100 < 20"


def with_train(body: str) -> str:
    return O.q(TRAIN_SQL + body)


def _lookups(spark, w):
    return ml.read_lookups(spark, _once(w, "lookups", lambda: ml.write_lookups(w.summary()).path))


def _encoder(w):
    """The category encoder, fitted once and published as an artifact."""
    def build():
        path = ml.publish_encoder(ml.category_encoder(w.categories()), new_table_path(w.spark, "artifacts"))
        return ml.load_encoder(path)
    return _once(w, "encoder", build)


def _features(spark, w):
    return ml.features(ml.training_set(w.keyed_sales()), _lookups(spark, w), _encoder(w))


@register("training_set", with_train("select * from train"))
def q_training_set(spark, sf_dir):
    """M1: sales with their product's prices, 12 columns plus lineage keys."""
    return ml.training_set(wh(spark, sf_dir).keyed_sales())


@register("category_encoding", with_train("select * from enc"))
def q_category_encoding(spark, sf_dir):
    """M3: alphabetical 0-based category codes."""
    w = wh(spark, sf_dir)
    return ml.encoding_table(_encoder(w), w.categories())


@register("feature_lookups", with_train("""
select 'category' as lookup, category_name as key, category_avg_sale as avg_sale from cat_avg
union all select 'month', cast(month as varchar), month_avg_sale from mon_avg"""))
def q_feature_lookups(spark, sf_dir):
    """The published averages, read back from their JSON artifact."""
    lk = _lookups(spark, wh(spark, sf_dir))
    cat = lk.category_avg.select(F.lit("category").alias("lookup"), F.col("category_name").alias("key"),
                                 F.col("category_avg_sale").alias("avg_sale"))
    mon = lk.month_avg.select(F.lit("month").alias("lookup"), F.col("month").cast("string").alias("key"),
                              F.col("month_avg_sale").alias("avg_sale"))
    return cat.unionByName(mon)


@register("features", with_train("""
select t.order_key, t.line_number, t.category_name, e.category_encoded, t.month, t.quantity,
       cast(t.discount_percent as double) as discount_percent,
       cast(t.is_festival_month as int) as is_festival_int,
       cast(t.cost_price as double) as cost_price, cast(t.selling_price as double) as selling_price,
       ca.category_avg_sale, ma.month_avg_sale,
       (cast(t.selling_price as double) - cast(t.cost_price as double)) / cast(t.selling_price as double) as profit_margin,
       cast(t.quantity * t.selling_price as double) as base_sale_value,
       cast(t.sale_amount as double) as sale_amount, cast(t.profit as double) as profit
from train t left join cat_avg ca on t.category_name = ca.category_name
left join mon_avg ma on t.month = ma.month
join enc e on t.category_name = e.category_name"""))
def q_features(spark, sf_dir):
    """M2: the 11 features in order, with targets."""
    return _features(spark, wh(spark, sf_dir))


@register("train_test_counts", O.q(f"""
select case when {SPLIT_SQL} then 'test' else 'train' end as split, count(*) as rows
from sales group by 1"""))
def q_train_test_counts(spark, sf_dir):
    """M4: sizes of the deterministic 80/20 split."""
    return ml.split_counts(wh(spark, sf_dir).sales())


@register("regression_metrics", with_train(f"""
, m as (
  select count(*) as n,
         cast(sum(abs(sale_amount - cast(quantity * selling_price as decimal(18,2)))) as double) as s_abs,
         cast(sum((sale_amount - cast(quantity * selling_price as decimal(18,2)))
                  * (sale_amount - cast(quantity * selling_price as decimal(18,2)))) as double) as s_sq,
         var_pop(cast(sale_amount as double)) as v
  from train where {SPLIT_SQL})
select n, round(s_abs / n, 6) as mae, round(sqrt(s_sq / n), 6) as rmse, round(1.0 - s_sq / n / v, 6) as r2 from m"""))
def q_regression_metrics(spark, sf_dir):
    """M7: MAE/RMSE/R^2 of the list-price predictor (quantity x price) on the test rows."""
    w = wh(spark, sf_dir)
    t = ml.training_set(w.keyed_sales()).filter(ml.is_test_row())
    t = t.withColumn("base_value", (F.col("quantity") * F.col("selling_price")).cast("decimal(18,2)"))
    m = ml.regression_metrics(t, "sale_amount", "base_value")
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


def _linear(spark, w):
    return _once(w, "models_lr", lambda: ml.train_linear(_features(spark, w))[1])


def _forests(spark, w):
    return _once(w, "models_rf", lambda: ml.train_forests(_features(spark, w))[1])


@register("lr_metrics")
def q_lr_metrics(spark, sf_dir):
    """M5/M7: linear regression per target, hold-out metrics (rows-only check;
    ``lr_moments`` and ``lr_orthogonality`` check the fit)."""
    return spark.read.parquet(_linear(spark, wh(spark, sf_dir))["metrics"])


FIT_COLUMNS = [*ml.FEATURE_COLUMNS, *ml.TARGETS]
FIT_SQL = with_train(f""",
fit as materialized (
  select e.category_encoded, t.month, t.quantity, t.discount_percent, cast(t.is_festival_month as int) as is_festival_int, t.cost_price, t.selling_price,
         ca.category_avg_sale, ma.month_avg_sale,
         (cast(t.selling_price as double) - cast(t.cost_price as double)) / cast(t.selling_price as double) as profit_margin,
         t.quantity * t.selling_price as base_sale_value, t.sale_amount, t.profit
  from train t left join cat_avg ca on t.category_name = ca.category_name left join mon_avg ma on t.month = ma.month
  join enc e on t.category_name = e.category_name where not ({SPLIT_SQL}))
""")


@register("lr_moments", FIT_SQL + " union all ".join(
    f"select '{x}' as a, '{y}' as b, round(corr(cast({x} as double), cast({y} as double)), 6) as correlation from fit"
    for i, x in enumerate(FIT_COLUMNS) for y in FIT_COLUMNS[i:]))
def q_lr_moments(spark, sf_dir):
    """M5: the sufficient statistics of the linear fit, as correlations."""
    rows = ml.usable(_features(spark, wh(spark, sf_dir)))[0].filter(~ml.is_test_row())
    pairs = [(i, j) for i in range(len(FIT_COLUMNS)) for j in range(i, len(FIT_COLUMNS))]
    cov = lambda i, j: F.col(f"cov_{i}_{j}")
    return ml.moments(rows, FIT_COLUMNS).select(F.inline(F.array(*[
        F.struct(F.lit(FIT_COLUMNS[i]).alias("a"), F.lit(FIT_COLUMNS[j]).alias("b"),
                 F.round(F.try_divide(cov(i, j), F.sqrt(cov(i, i)) * F.sqrt(cov(j, j))), 6).alias("correlation")) for i, j in pairs])))


# Residuals of a least-squares fit are orthogonal to every feature; rounding
# leaves correlations of some 1e-9 with features as close to each other as these.
ORTHOGONAL = 1e-6


@register("lr_orthogonality", "select * from (values " + ", ".join(
    f"('{t}', '{f}', true)" for t in ml.TARGETS for f in ml.FEATURE_COLUMNS) + ") v(target, feature, orthogonal)")
def q_lr_orthogonality(spark, sf_dir):
    """M5: on the training rows no residual correlates with a feature, which
    least squares alone has."""
    w = wh(spark, sf_dir)
    rows = ml.usable(_features(spark, w))[0].filter(~ml.is_test_row())
    got = ml.residual_correlations(rows, ml.load_linear(spark, _linear(spark, w)["models"]))
    return got.select("target", "feature", (F.abs("correlation") < ORTHOGONAL).alias("orthogonal"))


@register("rf_metrics")
def q_rf_metrics(spark, sf_dir):
    """M6/M7: random forest (100 trees, depth 10) per target (rows-only check;
    ``forest_scores`` checks the models)."""
    return spark.read.parquet(_forests(spark, wh(spark, sf_dir))["metrics"])


REQUEST_SQL = """,
req as (select distinct category_name as category, month, quantity, 5.0::double as discount_percent,
               quantity % 2 = 0 as store_in_db from sales),
prices as (select category_id, """ + O.avg("cost_price") + " as cost_price, " + O.avg("selling_price") + """ as selling_price
           from products group by category_id),
mflag as (select month, cast(min_by(is_festival, date_key) as int) as is_festival_int from dim_time group by month)
"""


def _request_features(spark, w):
    req = ml.requests_from_sales(w.sales())
    return ml.request_features(req, w.categories(), w.products(), _lookups(spark, w),
                               calendar.month_festival_flag(w.dim_time()), _encoder(w))


@register("request_features", O.q(DIM_TIME_SQL + TRAIN_SQL + REQUEST_SQL + """
select r.category, r.store_in_db, e.category_encoded, r.month, r.quantity, r.discount_percent,
       coalesce(f.is_festival_int, 0) as is_festival_int, p.cost_price, p.selling_price,
       ca.category_avg_sale, ma.month_avg_sale,
       (p.selling_price - p.cost_price) / p.selling_price as profit_margin,
       r.quantity * p.selling_price as base_sale_value
from req r join categories c on c.category_name = r.category
join prices p on p.category_id = c.category_id
join cat_avg ca on ca.category_name = r.category
join mon_avg ma on ma.month = r.month
left join mflag f on f.month = r.month
join enc e on e.category_name = r.category"""))
def q_request_features(spark, sf_dir):
    """Score requests resolved against the lookup tables (11 features each)."""
    feats, _ = _request_features(spark, wh(spark, sf_dir))
    return feats


def _scored(spark, w):
    """Score the request batch once; the scores are written and reused."""
    def build():
        paths = _forests(spark, w)
        feats, _ = _request_features(spark, w)
        path = new_table_path(spark, "scores")
        ml.score(feats, ml.load_model(paths["sale_amount"]), ml.load_model(paths["profit"])).write.parquet(path)
        return path
    return spark.read.parquet(_once(w, "scores", build))


@register("score_requests")
def q_score_requests(spark, sf_dir):
    """M8: batch scoring with the saved forest models (rows-only check)."""
    return _scored(spark, wh(spark, sf_dir)).drop("pred_sale", "pred_profit")


REQUEST_COLUMNS_SQL = O.q(DIM_TIME_SQL + TRAIN_SQL + REQUEST_SQL + """
, known as (
  select r.category, r.month, r.quantity, r.discount_percent, r.store_in_db, coalesce(f.is_festival_int, 0) = 1 as is_festival_month
  from req r join categories c on c.category_name = r.category
  join cat_avg ca on ca.category_name = r.category join mon_avg ma on ma.month = r.month left join mflag f on f.month = r.month)
""")


def _forest_tables(spark, w):
    """The forests as node tables, written once."""
    def build():
        root, paths = new_table_path(spark, "forests"), _forests(spark, w)
        for target in ml.TARGETS:
            forest.nodes(spark, paths[target]).write.parquet(f"{root}/{target}")
        return root
    root = _once(w, "forest_tables", build)
    return {target: spark.read.parquet(f"{root}/{target}") for target in ml.TARGETS}


@register("forest_scores", REQUEST_COLUMNS_SQL + "select *, true as same_sale, true as same_profit, true as same_margin from known")
def q_forest_scores(spark, sf_dir):
    """All requests scored by joins with the exported trees: equal to
    the models' own predictions, and their margin recomputed (P12)."""
    w = wh(spark, sf_dir)

    def build():
        tables, path = _forest_tables(spark, w), new_table_path(spark, "forest_scores")
        feats, _ = _request_features(spark, w)
        sale = forest.predict(feats, tables["sale_amount"], ml.FEATURE_COLUMNS, "by_join_sale")
        both = forest.predict(sale, tables["profit"], ml.FEATURE_COLUMNS, "by_join_profit")
        both.select("category", "month", "quantity", "by_join_sale", "by_join_profit").write.parquet(path)
        return path
    joined = _scored(spark, w).join(spark.read.parquet(_once(w, "forest_scores", build)), ["category", "month", "quantity"])
    same = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(a))
    margin = F.round(money.guarded_percent("by_join_profit", "by_join_sale"), 2)
    return joined.select("category", "month", "quantity", "discount_percent", "store_in_db", "is_festival_month",
                         same("pred_sale", "by_join_sale").alias("same_sale"), same("pred_profit", "by_join_profit").alias("same_profit"),
                         (F.abs(margin - F.col("profit_margin_percent")) <= 0.011).alias("same_margin"))


def _logged(spark, w):
    def build():
        path = new_table_path(spark, "prediction_history")
        for _ in range(2):      # a retry logs nothing twice
            ml.log_predictions(_scored(spark, w), path, "requests")
        return path
    return ml.read_log(spark, _once(w, "prediction_log", build))


@register("prediction_log")
def q_prediction_log(spark, sf_dir):
    """M9: the logged predictions of requests with ``store_in_db`` (rows-only
    check; ``prediction_log_rows`` checks all but the predictions)."""
    return _logged(spark, wh(spark, sf_dir)).drop("created_at")


@register("prediction_log_rows", REQUEST_COLUMNS_SQL + """
select category as category_name, month, quantity, cast(discount_percent as decimal(5,2)) as discount_percent, true as as_scored, true as dated
from known where store_in_db""")
def q_prediction_log_rows(spark, sf_dir):
    """M9: every request to be stored is logged once, with the scored values and a time."""
    w = wh(spark, sf_dir)
    scored = _scored(spark, w).select(F.col("category").alias("category_name"), "month", "quantity", "pred_sale", "pred_profit")
    log = _logged(spark, w).join(scored, ["category_name", "month", "quantity"])
    kept = (F.col("predicted_sale") == F.col("pred_sale").cast("decimal(12,2)")) & (F.col("predicted_profit") == F.col("pred_profit").cast("decimal(12,2)"))
    return log.select("category_name", "month", "quantity", "discount_percent", kept.alias("as_scored"), F.col("created_at").isNotNull().alias("dated"))


# ---------------------------------------------------------------------- export
@register("export_documents", O.q("""
select 'product_' || cast(product_id as varchar) as doc_id, product_name, cast(category_id as varchar) as category_id,
       cast(cost_price as double) as cost_price, cast(selling_price as double) as selling_price,
       case when category_id = 1 then stock_quantity + 1000 else stock_quantity end as stock_quantity
from products"""))
def q_export_documents(spark, sf_dir):
    """S11 (set): all product documents, then an update of category 1's stock; latest wins."""
    w = wh(spark, sf_dir)

    def build():
        docs = documents.product_documents(w.products())
        first = documents.set_documents(spark, docs)
        upd = documents.product_documents(
            w.products().filter(F.col("category_id") == 1)
            .withColumn("stock_quantity", F.col("stock_quantity") + 1000))
        return documents.set_documents(spark, upd, first)
    schema = documents.product_documents(w.products()).schema
    return documents.read_documents(spark, _once(w, "docs", build), schema)


SALE_DOCUMENT_COLUMNS = ["product_id", "product_name", "quantity", "sale_amount", "profit", "is_festival", "sale_date"]


@register("export_sale_documents", O.q(""",
docs as (
  select 'product_' || cast(product_id as varchar) as product_id, product_name, quantity, cast(sale_amount as double) as sale_amount,
         cast(profit as double) as profit, is_festival_month as is_festival, created_at as sale_date from sales),
numbered as (select *, row_number() over (partition by """ + ", ".join(SALE_DOCUMENT_COLUMNS) + """) as k from docs),
named as (select *, sha256(""" + " || ".join(
    f"coalesce(octet_length(encode(cast({c} as varchar))) || ':' || cast({c} as varchar), '-')" for c in SALE_DOCUMENT_COLUMNS) + """) as content from numbered)
select sha256('first/' || sha256(content || '#' || k)) as doc_id, """ + ", ".join(SALE_DOCUMENT_COLUMNS) + " from named"))
def q_export_sale_documents(spark, sf_dir):
    """S11 (add): every sale as a document under an id made of its content; the batch is sent twice."""
    w = wh(spark, sf_dir)
    docs = documents.sale_documents(w.sales())

    def build():
        path = new_table_path(spark, "sale_documents")
        for _ in range(2):
            documents.add_documents(docs, path, "first")
        return path
    schema = documents.with_content_ids(docs).schema
    return documents.read_added(spark, _once(w, "sale_docs", build), schema)


@register("categories_json", O.q("""
select '{"category_id":' || category_id || ',"category_name":"' || category_name || '","description":"' || description || '"}' as json from categories"""))
def q_categories_json(spark, sf_dir):
    """Result rows as JSON objects."""
    return documents.as_json_rows(wh(spark, sf_dir).categories())


# ------------------------------------------------------------ SQL over views
@register("sql_category_monthly", ORACLE["category_monthly"])
def q_sql_category_monthly(spark, sf_dir):
    """D9 as SQL text over the registered views, category bound as a parameter."""
    views.register_views(wh(spark, sf_dir))
    return views.sql(spark, """
        SELECT s.year, s.month, COUNT(*) AS total_orders,
               CAST(SUM(s.sale_amount) AS DOUBLE) AS total_sales,
               CAST(SUM(s.profit) AS DOUBLE) AS total_profit,
               CAST(SUM(s.discount_percent) AS DOUBLE) / COUNT(s.discount_percent) AS avg_discount
        FROM sales s JOIN categories c ON s.category_id = c.category_id
        WHERE c.category_name = :category
        GROUP BY s.year, s.month ORDER BY s.year, s.month""", category=CATEGORY)


@register("sql_top_products", ORACLE["top_products"])
def q_sql_top_products(spark, sf_dir):
    """``SELECT * FROM top_products LIMIT n`` over the ordered view."""
    views.register_views(wh(spark, sf_dir))
    return views.sql(spark, "SELECT * FROM top_products LIMIT :n", n=TOP_K)


def _sql_view(name: str):
    @register(f"sql_{name}", ORACLE[name])
    def query(spark, sf_dir):
        """``SELECT *`` over the registered view."""
        views.register_views(wh(spark, sf_dir))
        return views.sql(spark, f"SELECT * FROM {name}")


for _name in ("monthly_sales_summary", "category_performance", "festival_comparison", "sales_unified", "products_reconstructed"):
    _sql_view(_name)
