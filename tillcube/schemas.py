"""Declared schemas of the retail tables (S3), as explicit StructTypes.

Types follow FIXTURES.md, A: ids long, counts and calendar fields int,
money decimal, dates date, audit times timestamp without zone.
``conform`` casts and orders a DataFrame to a declared schema (e.g. rows
arriving from another source); ``check`` compares names and types;
``read_declared`` splits arriving rows into those that meet the declared
types, NOT NULL columns and checks, and those that do not, with the reason.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "ts": T.TimestampNTZType(), "double": T.DoubleType(),
    "dec10": T.DecimalType(10, 2), "dec12": T.DecimalType(12, 2), "dec5": T.DecimalType(5, 2),
}


def _schema(spec: str) -> T.StructType:
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


CATEGORIES = _schema("category_id long, category_name string, description string")
PRODUCTS = _schema("product_id long, product_name string, category_id long, cost_price dec10, "
                   "selling_price dec10, stock_quantity int, valid_from date, valid_to date, "
                   "created_at ts, updated_at ts")
SALES = _schema("order_key long, line_number int, product_id long, category_id long, product_name string, "
                "category_name string, quantity int, discount_percent dec5, sale_amount dec12, profit dec12, "
                "sale_date date, month int, year int, is_festival_month boolean, festival_name string, "
                "created_at ts, updated_at ts")
DIM_TIME = _schema("date_key int, full_date date, day int, month int, month_name string, quarter int, "
                   "year int, day_of_week int, day_name string, is_weekend boolean, is_festival boolean, "
                   "festival_name string")
DIM_PRODUCT = _schema("product_key long, product_id long, product_name string, category_name string, "
                      "cost_price dec10, selling_price dec10")
DIM_CATEGORY = _schema("category_key long, category_id long, category_name string, description string")
FACT_SALES = _schema("date_key int, product_key long, category_key long, quantity int, discount_percent dec5, "
                     "sale_amount dec12, profit dec12, cost_amount dec12")
PREDICTION_HISTORY = _schema("category_name string, month int, quantity int, discount_percent dec5, "
                             "predicted_sale dec12, predicted_profit dec12")

TABLES = {"categories": CATEGORIES, "products": PRODUCTS, "sales": SALES, "dim_time": DIM_TIME,
          "dim_product": DIM_PRODUCT, "dim_category": DIM_CATEGORY, "fact_sales": FACT_SALES,
          "prediction_history": PREDICTION_HISTORY}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def check(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences in names or types between ``df`` and ``schema`` (empty when equal)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name not in have:
            out.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            out.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    return out


@dataclass(frozen=True)
class Rules:
    """What a row of a table must meet besides its types."""

    not_null: tuple[str, ...] = ()
    # What a violated check is called -> SQL predicate over the typed columns (NULL passes).
    checks: dict[str, str] = field(default_factory=dict)
    # Values of columns that the input does not have, as text.
    defaults: dict[str, str] = field(default_factory=dict)


# The declared NOT NULL columns, checks and defaults.
RULES = {
    "categories": Rules(("category_name",)),
    "products": Rules(("product_name", "cost_price", "selling_price", "valid_from"), {"valid_to: before valid_from": "valid_to >= valid_from"},
                      {"stock_quantity": "0", "valid_to": "9999-12-31"}),
    "sales": Rules(("quantity", "sale_amount", "profit", "sale_date", "month", "year"),
                   {"month: not that of sale_date": "month = month(sale_date)", "year: not that of sale_date": "year = year(sale_date)"},
                   {"discount_percent": "0", "is_festival_month": "false"}),
    "prediction_history": Rules(("category_name", "month", "quantity", "predicted_sale", "predicted_profit"), {}, {"discount_percent": "0"}),
}


def judged(raw: DataFrame, table: str) -> DataFrame:
    """The rows in the declared types with ``reject_reason`` (NULL if they meet
    all rules), in one pass without a shuffle.  A value that does not fit its
    type is NULL; a column that the input lacks has its default, else NULL;
    columns that are not declared go."""
    schema, rules = TABLES[table], RULES.get(table, Rules())
    raw_name = {f.name: f"__raw_{f.name}" for f in schema.fields}
    given = raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(rules.defaults.get(f.name))).alias(raw_name[f.name]) for f in schema.fields])
    typed = given.select("*", *[F.col(raw_name[f.name]).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    reasons = []
    for f in schema.fields:
        value, source = F.col(f.name), F.col(raw_name[f.name])
        reasons.append(F.when(value.isNull() & source.isNotNull(), F.lit(f"{f.name}: not a value of {f.dataType.simpleString()}")))
        if f.name in rules.not_null:
            reasons.append(F.when(source.isNull(), F.lit(f"{f.name}: missing")))
    reasons += [F.when(~F.expr(predicate), F.lit(name)) for name, predicate in rules.checks.items()]
    found = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    return typed.select(*schema.fieldNames(), F.when(F.size(found) > 0, F.array_join(found, "; ")).alias("reject_reason"))


def read_declared(raw: DataFrame, table: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of the input, both in the declared types, the
    rejected with ``reject_reason``.  The input is read once: both are written
    to the new folder ``path`` by one job and read from there.  They stay in
    one table, told apart by the reason: writing them apart would sort every
    task's rows by it."""
    judged(raw, table).write.parquet(path)
    rows = raw.sparkSession.read.schema(T.StructType([*TABLES[table].fields, T.StructField("reject_reason", T.StringType())])).parquet(path)
    return rows.filter(F.col("reject_reason").isNull()).drop("reject_reason"), rows.filter(F.col("reject_reason").isNotNull())
