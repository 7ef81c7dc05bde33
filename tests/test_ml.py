"""Training and scoring: model quality, repeatability, scoring counts, rejects."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcube.operators import calendar, forest, ml
from tillcube.session import new_table_path


@pytest.fixture(scope="module")
def feats(spark, wh):
    lk = ml.write_lookups(wh.sales())
    enc = ml.category_encoder(wh.categories())
    return ml.features(ml.training_set(wh.keyed_sales()), lk, enc).cache(), lk, enc


def test_feature_order_matches_reference(feats):
    f, _, _ = feats
    assert f.columns[3:14] == ml.FEATURE_COLUMNS


def test_carried_prices_equal_joined_ones(wh):
    carried, joined = ml.training_set(wh.keyed_sales()), ml.training_set(wh.sales(), wh.products())
    assert carried.columns == joined.columns == ml.TRAINING_COLUMNS
    assert carried.exceptAll(joined).isEmpty() and joined.exceptAll(carried).isEmpty()


def test_linear_regression_quality(feats):
    f, _, _ = feats
    metrics, _ = ml.train_linear(f)
    r2 = {r.target: r.r2 for r in metrics.collect()}
    assert r2["sale_amount"] > 0.9 and r2["profit"] > 0.85


def test_linear_fit_equals_least_squares(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)) * [1, 1e4, 1e-3] + [5, 1e6, 0]
    y = x @ [2.0, -3e-4, 700.0] + 9 + rng.normal(size=500)
    rows = spark.createDataFrame([(*map(float, r), 4.0, float(v)) for r, v in zip(x, y)], "a double, b double, c double, same double, y double").repartition(7)
    model, = ml.fit_linear(rows, ["y"], ["a", "b", "c", "same"])
    want, *_ = np.linalg.lstsq(np.column_stack([x, np.ones(500)]), y, rcond=None)
    assert [model.coefficients[k] for k in "abc"] == pytest.approx(want[:3], rel=1e-6)
    assert model.coefficients["same"] == 0 and model.intercept == pytest.approx(want[3], rel=1e-6)
    path = new_table_path(spark, "linear")
    ml.save_linear(spark, [model], path)
    assert ml.load_linear(spark, path) == [model]
    assert ml.fit_linear(rows.limit(0), ["y"], ["a"]) == []


def test_moments_merge_in_centred_form(spark):
    rows = spark.createDataFrame([(1e9 + i, float(i % 2)) for i in range(100)], "a double, b double").repartition(9)
    got = ml.moments(rows, ["a", "b"]).head()
    assert got.cov_0_0 == pytest.approx(833.25, rel=1e-9) and got.mean_0 == pytest.approx(1e9 + 49.5)


def test_r2_keeps_its_digits_far_from_zero(spark):
    rows = [(1e8 + i, 1e8 + i + e) for i, e in enumerate((0.1, -0.1, 0.1, -0.1, 0.1))]
    got = ml.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").head()
    assert got.r2 == pytest.approx(0.995, abs=1e-6)
    same = ml.regression_metrics(spark.createDataFrame([(7.0, 6.0)] * 3, "y double, p double"), "y", "p").head()
    assert same.r2 is None and same.mae == 1.0
    none = ml.regression_metrics(spark.createDataFrame([], "y double, p double"), "y", "p").head()
    assert (none.n, none.mae, none.rmse, none.r2) == (0, None, None, None)


def test_rows_without_a_feature_are_rejected_not_fatal(spark, wh, feats):
    _, lk, enc = feats
    sales = wh.keyed_sales().withColumn("selling_price", F.when(F.col("product_id") % 10 == 0, F.lit(0)).otherwise(F.col("selling_price")).cast("decimal(10,2)"))
    f = ml.features(ml.training_set(sales), lk, enc)
    good, bad = ml.usable(f)
    assert good.count() + bad.count() == f.count() and bad.count() > 0
    assert {r.reject_reason for r in bad.select("reject_reason").distinct().collect()} == {"no value for profit_margin"}
    assert ml.train_linear(f)[0].count() == 2 and ml.train_forests(f, trees=1, depth=2)[0].count() == 2
    # serving: a category whose products are all priced 0
    free = wh.products().withColumn("selling_price", F.when(F.col("category_id") == 1, F.lit(0)).otherwise(F.col("selling_price")).cast("decimal(10,2)"))
    req = ml.requests_from_sales(wh.sales())
    ok, rejects = ml.request_features(req, wh.categories(), free, lk, calendar.month_festival_flag(wh.dim_time()), enc)
    assert ok.count() + rejects.count() == req.count()
    assert {r.reject_reason for r in rejects.collect()} == {"no value for profit_margin"}


def test_forest_is_repeatable_and_scores_every_request(spark, wh, feats):
    f, lk, enc = feats
    # A small forest keeps the unit test quick; the registered query uses 100 trees.
    m1, p1 = ml.train_forests(f, trees=5, depth=5)
    m2, _ = ml.train_forests(f, trees=5, depth=5)
    assert sorted(m1.collect()) == sorted(m2.collect())
    req = ml.requests_from_sales(wh.sales())
    feats_r, rejects = ml.request_features(req, wh.categories(), wh.products(), lk,
                                           calendar.month_festival_flag(wh.dim_time()), enc)
    assert rejects.count() == 0
    scored = ml.score(feats_r, ml.load_model(p1["sale_amount"]), ml.load_model(p1["profit"]))
    assert scored.count() == req.count()
    path = new_table_path(spark, "log")
    for _ in range(2):          # the second time is a retry
        ml.log_predictions(scored, path, "one")
    assert ml.read_log(spark, path).count() == req.filter("store_in_db").count()

    # the exported trees give the same predictions without the ML library
    tree_rows = forest.nodes(spark, p1["sale_amount"])
    assert tree_rows.select("tree").distinct().count() == 5 and forest.depth(tree_rows) <= 5
    by_join = forest.predict(feats_r, tree_rows, ml.FEATURE_COLUMNS)
    mine = {(r.category, r.month, r.quantity): r.prediction for r in by_join.collect()}
    assert mine == pytest.approx({(r.category, r.month, r.quantity): r.pred_sale for r in scored.collect()}, rel=1e-9)


def test_forest_by_shuffled_joins(spark, feats, monkeypatch):
    f, _, _ = feats
    _, paths = ml.train_forests(f, trees=2, depth=3)
    tree_rows, few = forest.nodes(spark, paths["profit"]), f.select("order_key", "line_number", *ml.FEATURE_COLUMNS).orderBy("order_key", "line_number").limit(50)
    key = lambda r: (r.order_key, r.line_number, r.cost_price, r.quantity)
    want = {key(r): r.prediction for r in forest.predict(few, tree_rows, ml.FEATURE_COLUMNS).collect()}
    monkeypatch.setattr(forest, "BROADCAST_NODES", 0)
    assert {key(r): r.prediction for r in forest.predict(few, tree_rows, ml.FEATURE_COLUMNS).collect()} == pytest.approx(want)


def test_unknown_category_and_month_are_rejected(spark, wh, feats):
    _, lk, enc = feats
    req = spark.createDataFrame([("NOPE", 1, 2, 5.0, False), ("ECONOMY", 13, 2, 5.0, True),
                                 ("ECONOMY", 3, 1, 5.0, False)],
                                "category string, month int, quantity int, discount_percent double, store_in_db boolean")
    ok, rejects = ml.request_features(req, wh.categories(), wh.products(), lk,
                                      calendar.month_festival_flag(wh.dim_time()), enc)
    reasons = {r.category: r.reject_reason for r in rejects.collect()}
    assert ok.count() == 1
    assert reasons == {"NOPE": "category not found", "ECONOMY": "no average for month"}


def test_split_is_about_twenty_percent(wh):
    c = {r.split: r.rows for r in ml.split_counts(wh.sales()).collect()}
    frac = c["test"] / (c["test"] + c["train"])
    assert 0.15 < frac < 0.25


def test_margin_guard(spark):
    from tillcube.functions.money import guarded_percent
    df = spark.createDataFrame([(0.0, 5.0), (-1.0, 5.0), (10.0, 2.5)], "s double, p double")
    out = [r[0] for r in df.select(guarded_percent("p", "s")).collect()]
    assert out == [0.0, 0.0, 25.0]
    assert F is not None


def test_encoder_and_metadata_are_published(spark, wh):
    from tillcube.session import new_table_path as ntp
    enc = ml.category_encoder(wh.categories())
    root = ntp(spark, "artifacts")
    loaded = ml.load_encoder(ml.publish_encoder(enc, root))
    assert loaded.labels == sorted(loaded.labels) == enc.labels
    meta = spark.read.json(f"{root}/metadata").first()
    assert meta.feature_columns == ml.FEATURE_COLUMNS and meta.categories == enc.labels
