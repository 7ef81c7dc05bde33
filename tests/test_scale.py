"""What grows with the tables: bins of price versions, tasks and sorts of the load, bytes of the exports."""

import datetime as dt
import glob
import threading

from pyspark.sql import functions as F

from tillcube import registry, schemas
from tillcube.operators import layout, ml, temporal
from tillcube.plans.inspect import plan_text
from tillcube.session import new_table_path
from tillcube.sources import documents, retail


def test_a_price_version_is_listed_at_most_twice(spark):
    versions = spark.range(300).select((F.col("id") % 3).alias("product_id"), F.date_add(F.lit(dt.date(1994, 1, 1)), (F.col("id") * 11).cast("int")).alias("valid_from"),
                                       F.lit(2.0).alias("selling_price"), F.lit(1.0).alias("cost_price"), (F.col("id") * 37 % 2900).cast("int").alias("days"))
    versions = versions.withColumn("valid_to", F.date_add("valid_from", F.col("days"))).drop("days")
    span = spark.createDataFrame([(dt.date(1995, 1, 1), dt.date(2001, 12, 31))], "first date, last date")
    listed = temporal.binned_versions(versions, span).groupBy("v_product_id", "valid_from").count()
    assert {r["count"] for r in listed.collect()} <= {1, 2}
    # and every sale still meets exactly the versions of its day
    sales = spark.range(900).select((F.col("id") % 3).alias("product_id"), F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("id") * 13 % 2557).cast("int")).alias("sale_date"), "id")
    got = temporal.sales_with_price_at_date(sales, versions).select("id", "valid_from", "valid_to")
    want = sales.join(versions, "product_id").filter("sale_date BETWEEN valid_from AND valid_to").select("id", "valid_from", "valid_to")
    assert sorted(got.collect()) == sorted(want.collect()) and want.count() > 900


def test_price_versions_never_pass_through_the_driver(spark, wh):
    for report in (temporal.revenue_at_date_prices, temporal.sales_with_price_at_date):
        plan = report(wh.sales(), temporal.price_versions(wh.products()))
        assert plan.count() > 0 and "BroadcastExchange" not in plan_text(plan)


def test_star_report_names_every_role(spark, sf_dir):
    got = {r.table_name: (r.role, r.row_count > 0) for r in registry.QUERIES["star_schema_counts"](spark, sf_dir).collect()}
    assert got == {"fact_sales": ("Fact table", True), "dim_time": ("Date/festival info", True),
                   "dim_product": ("Product details", True), "dim_category": ("Category grouping", True)}


def test_load_deals_its_sales_by_their_number(spark, wh, monkeypatch):
    sales, tasks = wh.keyed_sales(), 3 * spark.sparkContext.defaultParallelism
    n = sales.count()
    monkeypatch.setattr(retail, "ROWS_PER_TASK", -(-n // tasks))
    path = retail.write_sales(sales, wh.products(), new_table_path(spark, "dealt"), rows=n)
    back = spark.read.parquet(path)
    files = back.groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == n and len(files) >= tasks
    assert max(r["count"] for r in files) <= 2 * n / tasks
    assert back.select(*sales.columns).exceptAll(sales).isEmpty()


def test_declared_rows_are_not_sorted(spark):
    raw = spark.createDataFrame([("1", "bolt"), ("x", "nut")], "category_id string, category_name string")
    path = new_table_path(spark, "declared")
    ok, bad = schemas.read_declared(raw, "categories", path)
    assert [r.category_id for r in ok.collect()] == [1] and [r.reject_reason for r in bad.collect()] == ["category_id: not a value of bigint"]
    assert not glob.glob(f"{path.removeprefix('file:')}/*=*")      # a folder a side would cost a sort


def test_added_documents_move_once_and_are_compressed(spark, monkeypatch):
    monkeypatch.setattr(documents, "COPIES", 3)
    docs = spark.createDataFrame([("a", 1)] * 10 + [("b", 2)] * 3 + [("c", None)], "name string, v int")
    path = new_table_path(spark, "added")
    documents.add_documents(docs, path, "one")
    files = glob.glob(f"{path.removeprefix('file:')}/batches/*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    named = documents.with_content_ids(docs)
    back = documents.read_added(spark, path, named.schema)
    assert sorted((r.name, r.v or 0) for r in back.collect()) == sorted((r.name, r.v or 0) for r in docs.collect())
    assert back.select("doc_id").distinct().count() == 14
    # documents of few copies are not dealt a second time
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "(__n" in plan and "> 3" in plan


def test_facts_keep_their_rows_and_the_session_its_settings(spark, wh):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    made = layout.load_facts(wh.keyed_sales(), new_table_path(spark, "star"))
    facts = spark.read.parquet(made["fact_sales"])
    assert facts.count() == wh.sales().count() == facts.select("fact_id").distinct().count()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before


def test_both_targets_train_side_by_side(spark, wh, monkeypatch):
    feats = registry._features(spark, wh)
    both, make = threading.Barrier(len(ml.TARGETS)), ml.forest_regressor
    monkeypatch.setattr(ml, "forest_regressor", lambda *args: both.wait(120) is not None and make(*args))
    metrics, paths = ml.train_forests(feats, trees=1, depth=2)
    assert {r.target for r in metrics.collect()} == set(ml.TARGETS) and set(paths) == {"metrics", *ml.TARGETS}


def test_forest_tasks_are_even_and_hold_neighbours(spark, wh, monkeypatch):
    feats, held, make = registry._features(spark, wh), {}, ml.forest_regressor
    uneven = feats.filter("month <= 10").coalesce(1).unionAll(feats.filter("month > 10").coalesce(1))

    class Seen:
        def __init__(self, target, *args):
            self.target, self.estimator = target, make(target, *args)

        def fit(self, train):
            value = ml.FEATURE_COLUMNS.index("base_sale_value")
            held[self.target] = [[r.features[value] for r in part] for part in train.select("features").rdd.glom().collect()]
            return self.estimator.fit(train)

    monkeypatch.setattr(ml, "TASK_ROWS", 500, raising=False)
    monkeypatch.setattr(ml, "forest_regressor", Seen)
    metrics, _ = ml.train_forests(uneven, trees=1, depth=2)
    rows = feats.count()
    assert sum(r.n for r in metrics.collect()) + sum(len(p) for parts in held.values() for p in parts) == 2 * rows
    for parts in held.values():
        assert len(parts) == -(-rows // 500) and max(map(len, parts)) < 1.5 * min(map(len, parts))
        assert all(p == sorted(p) for p in parts)
    # few rows stay as they are read; many come in tasks of a bounded size
    assert ml.dealt(uneven, 1000) is uneven
    assert ml.dealt(uneven, 40 * ml.MOST_TASK_ROWS).rdd.getNumPartitions() == 40
