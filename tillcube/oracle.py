"""DuckDB twins of the registered queries (the correctness oracle).

Each SQL text runs on the driver's views (``lineitem``, ``part``, ...) and
re-derives the retail tables with the mapping of FIXTURES.md, C.  Rules:
exact decimals, no decimal division, final sums cast to double, averages
as ``double(sum) / count``, counts as bigint, year/month as int.
"""

from __future__ import annotations

# The retail model as CTEs; every oracle query starts with this.
RETAIL_CTES = """
with categories as (
  select cast(dense_rank() over (order by p_type) as bigint) as category_id,
         p_type as category_name,
         concat(p_type, ' products for retail') as description
  from (select distinct p_type from part)),
products as (
  select p_partkey as product_id, p_name as product_name, c.category_id,
         cast(cast(p_retailprice as decimal(10,2)) * cast(60 + p_size % 25 as decimal(3,0))
              * cast(0.01 as decimal(2,2)) as decimal(10,2)) as cost_price,
         cast(p_retailprice as decimal(10,2)) as selling_price,
         p_size as stock_quantity,
         date '1995-01-01' as valid_from, date '9999-12-31' as valid_to,
         timestamp '1995-01-01 00:00:00' as created_at,
         timestamp '1995-01-01 00:00:00' as updated_at
  from part join categories c on c.category_name = part.p_type),
fest as (
  select cast(concat(cast(y as varchar), '-', md) as date) as fd, nm, y * 10 + o as o
  from (select unnest(range(year(min(l_shipdate)), year(max(l_shipdate)) + 1)) as y from lineitem) t
  cross join (values (0,'03-08','Holi'),(1,'04-22','Eid'),(2,'11-12','Diwali'),
                     (3,'11-13','Diwali'),(4,'12-25','Christmas')) f(o, md, nm)),
days as (select distinct cast(l_shipdate as date) as d from lineitem),
tag as (
  select d, min_by(nm, o) as festival_name
  from days join fest on abs(datediff('day', fd, d)) <= 5 group by d),
sales as (
  select l_orderkey as order_key, l_linenumber as line_number, l_partkey as product_id, p.category_id, p.product_name, c.category_name,
         cast(l_quantity as int) as quantity,
         cast(l_discount * 100 as decimal(5,2)) as discount_percent,
         cast(cast(l_quantity as int) * p.selling_price
              * (1 - cast(l_discount as decimal(4,2))) as decimal(12,2)) as sale_amount,
         cast(cast(l_quantity as int) * p.selling_price * (1 - cast(l_discount as decimal(4,2)))
              - cast(l_quantity as int) * p.cost_price as decimal(12,2)) as profit,
         cast(l_shipdate as date) as sale_date,
         cast(month(l_shipdate) as int) as month, cast(year(l_shipdate) as int) as year,
         tag.festival_name is not null as is_festival_month, tag.festival_name,
         l_shipdate as created_at, l_shipdate as updated_at
  from lineitem l
  join products p on l_partkey = p.product_id
  join categories c on c.category_id = p.category_id
  left join tag on tag.d = cast(l_shipdate as date))
"""

SALES_COLS = ("order_key, line_number, product_id, category_id, product_name, category_name, quantity, discount_percent, "
              "sale_amount, profit, sale_date, month, year, is_festival_month, festival_name, "
              "created_at, updated_at")


def avg(x: str) -> str:
    return f"cast(sum({x}) as double) / nullif(count({x}), 0)"


def msum(x: str) -> str:
    return f"cast(sum({x}) as double)"


def q(body: str) -> str:
    return RETAIL_CTES + body
