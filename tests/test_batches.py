"""Retry-safe appends, live summaries, content ids, declared rules, merges and the incremental star load."""

import os

import pytest
from pyspark.sql import functions as F

from tillcube import schemas
from tillcube.operators import kpi, layout
from tillcube.operators.star import StarStore
from tillcube.session import new_table_path
from tillcube.sources import documents, retail, views
from tillcube.sources.batches import BatchTable, Manifest
from tillcube.sources.live import LiveSales


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------ batches
def test_a_batch_is_added_once_and_seen_whole(spark):
    table = BatchTable(spark, new_table_path(spark, "batches"), spark.range(1).schema)
    assert table.read().count() == 0
    assert table.append(spark.range(10), "a") and not table.append(spark.range(10), "a")
    table.write_folder(spark.range(99), "b")                   # a job that died before its commit
    assert table.read().count() == 10
    assert table.append(spark.range(5), "b") and table.read().count() == 15
    assert list(table.batches()) == ["a", "b"]
    with pytest.raises(ValueError):
        table.append(spark.range(1), "../x")


def test_two_writers_of_one_version(spark):
    m = Manifest(spark, new_table_path(spark, "manifest"))
    assert m.read() == (0, {})
    assert m.commit(1, {"a": 1}) and not m.commit(1, {"a": 2})
    seen = []

    def change(state):
        if not seen:                                            # another writer commits in between
            assert m.commit(2, {"a": 5})
        seen.append(state["a"])
        return {"a": state["a"] + 1}
    assert m.update(change) == {"a": 6} and seen == [1, 5] and m.read() == (3, {"a": 6})


def test_an_open_version_is_stepped_over(spark, monkeypatch):
    monkeypatch.setattr("tillcube.sources.batches.LOST", 2)
    m = Manifest(spark, new_table_path(spark, "manifest"))
    m.commit(1, {"a": 1})
    m._fs.create(m._hadoop.Path(m.path, "000000002"), False).close()           # its writer was lost
    assert m.read() == (1, {"a": 1})
    assert m.update(lambda s: {"a": 2}) == {"a": 2} and m.read() == (3, {"a": 2})


# ------------------------------------------------------------ live summaries
def test_an_append_reaches_views_and_summaries_without_a_reload(spark, sf_dir):
    wh = retail.load_warehouse(spark, sf_dir, reuse=False, layout_tables=False)
    before = kpi.overview_totals(wh.summary()).head().total_orders
    batch = wh.sales().filter("year = 1997 AND month = 3")
    n = batch.count()
    assert wh.append_sales(batch, "march") and not wh.append_sales(batch, "march")
    assert wh.sales().count() == before + n
    assert wh.keyed_sales().filter("product_key IS NULL").count() == 0         # looked up, as the batch had none
    assert kpi.overview_totals(wh.summary()).head().total_orders == before + n
    views.register_views(wh, "live_")
    got = views.sql(spark, "SELECT total_orders FROM live_monthly_sales_summary WHERE year = 1997 AND month = 3").head()[0]
    assert got == 2 * n
    # summaries equal those made of all sales anew
    for merged, anew in ((wh.summary(), kpi.category_performance), (wh.product_summary(), lambda s: kpi.top_products(s, None))):
        assert rows(anew(merged)) == rows(anew(wh.sales()))
    retail._LOADED.clear()


def test_an_append_reads_the_batch_alone(spark, wh, monkeypatch):
    live = LiveSales(spark, new_table_path(spark, "live"), {"sales": "/nowhere", **{n: f"{wh.root}/{n}" for n in ("daily_summary", "product_summary")}})
    batch = wh.sales().filter("year = 1998")
    assert live.append(batch, "again")          # the sales of the base cannot be read: they are not
    assert kpi.overview_totals(live.daily_summary()).head().total_orders == wh.sales().count() + batch.count()


# ------------------------------------------------------------ documents
def test_content_ids_are_stable_and_unique(spark, monkeypatch):
    monkeypatch.setattr(documents, "COPIES", 3)
    docs = spark.createDataFrame([("same", None)] * 10 + [("other", 1.5), (None, None)], "name string, v double")
    first, again = (documents.with_content_ids(docs.repartition(n)) for n in (1, 5))
    assert rows(first) == rows(again) and first.select("doc_id").distinct().count() == 12
    path = new_table_path(spark, "collection")
    for batch in ("a", "a", "b"):               # a retry adds nothing, another batch new documents
        documents.add_documents(docs, path, batch)
    got = documents.read_added(spark, path, first.schema)
    assert got.count() == 24 == got.select("doc_id").distinct().count()


def test_set_documents_need_an_id(spark):
    with pytest.raises(ValueError):
        documents.set_documents(spark, spark.createDataFrame([(None, 1)], "doc_id string, v int"))


# ------------------------------------------------------------ merges
def test_upsert_with_null_orders_and_keys(spark):
    base = spark.createDataFrame([(1, "A", "old")], "id long, name string, v string")
    sent = spark.createDataFrame([("A", "new", None), ("B", "b1", None), ("B", "b2", None), ("C", "c9", 9), ("C", "c1", 1), ("C", "c0", None),
                                  (None, "x", 1), (None, "y", None)], "name string, v string, o int")
    got = rows(layout.upsert(base, sent, "name", "id", ["v"], "o"))
    assert [r[1:] for r in got] == [("A", "new"), (None, "x"), (None, "y"), ("B", "b2"), ("C", "c9")] or \
        sorted(map(repr, (r[1:] for r in got))) == sorted(map(repr, [("A", "new"), ("B", "b2"), ("C", "c9"), (None, "x"), (None, "y")]))
    assert sorted(r[0] for r in got) == [1, 2, 3, 4, 5]


def test_insert_absent_with_null_orders_and_keys(spark):
    base = spark.createDataFrame([("A", "old", 1)], "name string, v string, o int")
    sent = spark.createDataFrame([("A", "new", 1), ("B", "b5", 5), ("B", "b0", None), (None, "x", 1), (None, "x", 1)], base.schema)
    assert rows(layout.insert_absent(base, sent, "name", "o")) == [("B", "b0", None), (None, "x", 1), (None, "x", 1)]


# ------------------------------------------------------------ declared rules
def test_declared_rules_split_rows(spark):
    raw = spark.createDataFrame([("1", "bolt", "1.50", "2.00", "2020-01-01", "2019-01-01", "clash"), ("x", None, "9", "2.005x", None, None, ""), ("3", "nut", "1", "2", "2020-01-01", None, "")],
                                "product_id string, product_name string, cost_price string, selling_price string, valid_from string, valid_to string, reject_reason string")
    ok, bad = schemas.read_declared(raw, "products", new_table_path(spark, "declared"))
    assert schemas.check(ok, schemas.PRODUCTS) == []
    assert [(r.product_id, r.stock_quantity, r.valid_to) for r in ok.collect()] == [(3, 0, None)]
    assert {r.reject_reason for r in bad.collect()} == {
        "valid_to: before valid_from",
        "product_id: not a value of bigint; product_name: missing; selling_price: not a value of decimal(10,2); valid_from: missing"}
    none = schemas.read_declared(raw.limit(0), "products", new_table_path(spark, "declared"))
    assert [d.count() for d in none] == [0, 0]


def test_written_tables_meet_their_declared_types(wh):
    for name, df in (("categories", wh.categories()), ("products", wh.products()), ("sales", wh.sales()), ("dim_time", wh.dim_time())):
        assert schemas.check(df, schemas.TABLES[name]) == []
        assert schemas.judged(df, name).filter("reject_reason IS NOT NULL").count() == 0


# ------------------------------------------------------------ star schema
def files_of(path):
    return {f"{d}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, fs in os.walk(path.replace("file:", "")) for f in fs if f.endswith(".parquet")}


def test_star_refresh_rewrites_changed_years_alone(spark, wh):
    store = StarStore(spark, new_table_path(spark, "star"))
    sales, products, categories = wh.sales().cache(), wh.products(), wh.categories()
    known = products.filter("product_id % 3 > 0")
    part = sales.join(known.select("product_id"), "product_id", "left_semi")
    first = store.refresh(part.filter("year <= 1997 OR year > 1998"), known, categories)
    assert first.new_products == known.count() and 1998 not in first.years and 1997 in first.years
    keys = {r.product_id: r.product_key for r in store.dim_product().collect()}
    before = files_of(f"{store.path}/fact_sales")

    # grown input: one more year; nothing else is written, and keys stay
    second = store.refresh(part, known, categories)
    assert (second.new_products, second.new_categories, second.years) == (0, 0, [1998])
    after = files_of(f"{store.path}/fact_sales")
    assert {f: t for f, t in after.items() if "year=1998" not in f} == before and len(after) > len(before)
    assert store.fact_sales().count() == part.count()

    # the same again: nothing at all
    assert store.refresh(part, known, categories).years == [] and files_of(f"{store.path}/fact_sales") == after

    # more products: known keys stay, new ones follow in id order
    third = store.refresh(sales, products, categories)
    now = {r.product_id: r.product_key for r in store.dim_product().collect()}
    assert third.new_products == products.count() - known.count() and {p: now[p] for p in keys} == keys
    fresh = sorted(set(now) - set(keys))
    assert [now[p] for p in fresh] == list(range(len(keys) + 1, len(now) + 1))
    assert store.fact_sales().count() == sales.count()

    # a year without sales is no longer read
    store.refresh(sales.filter("year <> 1996"), products, categories)
    assert store.fact_sales().filter("year = 1996").count() == 0
    sales.unpersist()


def test_year_fingerprints_ignore_order_and_see_changes(wh):
    from tillcube.operators.star import year_fingerprints
    s = wh.sales()
    assert rows(year_fingerprints(s)) == rows(year_fingerprints(s.repartition(3)))
    one = s.limit(1)
    changed = year_fingerprints(s.exceptAll(one).unionByName(one.withColumn("quantity", F.col("quantity") + 1)))
    assert len(set(rows(changed)) - set(rows(year_fingerprints(s)))) == 1
