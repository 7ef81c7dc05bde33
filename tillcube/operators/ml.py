"""Training and batch scoring of the sales / profit regressors.

The reference trains on one pandas frame and scores one HTTP request at a
time.  Here the training set is a Spark join, the lookups (category and
month averages) are small aggregates written once as artifacts, the linear
models come from one aggregate of sufficient statistics, the forests are
Spark ML pipelines saved to the shared folder, and scoring is a batch
``transform`` over a DataFrame of requests (``forest.py`` scores with the
exported trees instead).  Rows with a NULL feature are rejected with a reason
before they reach a model.  The split is a hash of the sale's lineage keys, so it does not
depend on partitioning (``randomSplit`` would).
"""

from __future__ import annotations

import functools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import guarded_percent
from ..session import new_table_path
from ..sources.batches import BatchTable
from .kpi import category_avg_price, historical_averages

# Fixed values (the reference's feature order and model settings).
FEATURE_COLUMNS = [
    "category_encoded", "month", "quantity", "discount_percent", "is_festival_int",
    "cost_price", "selling_price", "category_avg_sale", "month_avg_sale",
    "profit_margin", "base_sale_value",
]
TARGETS = ["sale_amount", "profit"]
TEST_PERCENT = 20
SPLIT_SEED = 42
RF_TREES = 100
RF_DEPTH = 10
RF_SEED = 42
# Split hash multipliers (any fixed odd constants; the key is reduced first so
# the product cannot overflow a long at any table size).
_SPLIT_KEY_MOD = 1_000_003
_SPLIT_MUL_ORDER = 2_654_435_761
_SPLIT_MUL_LINE = 40_503


TRAINING_COLUMNS = ["order_key", "line_number", "product_id", "product_name", "category_name", "quantity", "discount_percent",
                    "sale_amount", "profit", "month", "year", "is_festival_month", "cost_price", "selling_price"]


def training_set(sales: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """M1: the 12 training columns and the lineage keys.  Sales that carry
    their product's prices (as the load writes them) need no join; others are
    joined to ``products`` (J2)."""
    if products is not None:
        p = products.select("product_id", F.col("product_name").alias("p_name"), "cost_price", "selling_price")
        sales = sales.drop("product_name", "cost_price", "selling_price").join(p, "product_id").withColumnRenamed("p_name", "product_name")
    return sales.select(*TRAINING_COLUMNS)


def is_test_row(order_key="order_key", line_number="line_number") -> F.Column:
    """M4: deterministic 80/20 split on the lineage keys."""
    h = (F.pmod(F.col(order_key), F.lit(_SPLIT_KEY_MOD)) * F.lit(_SPLIT_MUL_ORDER)
         + F.col(line_number).cast("long") * F.lit(_SPLIT_MUL_LINE) + F.lit(SPLIT_SEED))
    return F.pmod(h, F.lit(100)) < F.lit(TEST_PERCENT)


def split_counts(train: DataFrame) -> DataFrame:
    """M4 report: rows per side of the split."""
    return (train.select(F.when(is_test_row(), "test").otherwise("train").alias("split"))
            .groupBy("split").agg(F.count(F.lit(1)).alias("rows")))


def category_encoder(categories: DataFrame) -> StringIndexerModel:
    """M3: alphabetical 0-based label encoding, fitted on the category dimension."""
    return StringIndexer(inputCol="category_name", outputCol="category_encoded",
                         stringOrderType="alphabetAsc").fit(categories.select("category_name"))


def encoding_table(encoder: StringIndexerModel, categories: DataFrame) -> DataFrame:
    return encoder.transform(categories.select("category_name"))


def publish_encoder(encoder: StringIndexerModel, root: str) -> str:
    """Save the fitted encoder and a metadata document (feature order,
    encoder classes) next to the lookups; returns the encoder path."""
    spark = SparkSession.getActiveSession()
    path = f"{root}/encoder"
    encoder.write().overwrite().save(path)
    meta = spark.range(1).select(
        F.array(*[F.lit(c) for c in FEATURE_COLUMNS]).alias("feature_columns"),
        F.array(*[F.lit(c) for c in encoder.labels]).alias("categories"))
    meta.coalesce(1).write.mode("overwrite").json(f"{root}/metadata")
    return path


def load_encoder(path: str) -> StringIndexerModel:
    return StringIndexerModel.load(path)


@dataclass
class Lookups:
    """M10 artifacts: the averages used as features, written as JSON."""

    category_avg: DataFrame  # category_name, category_avg_sale
    month_avg: DataFrame     # month, month_avg_sale
    path: str


def write_lookups(sales: DataFrame) -> Lookups:
    """Compute the two averages once and publish them as JSON."""
    spark = sales.sparkSession
    cat, mon = historical_averages(sales)
    path = new_table_path(spark, "lookups")
    cat.write.json(f"{path}/category_avg")
    mon.write.json(f"{path}/month_avg")
    return read_lookups(spark, path)


def read_lookups(spark: SparkSession, path: str) -> Lookups:
    cat = spark.read.schema("category_name string, category_avg_sale double").json(f"{path}/category_avg")
    mon = spark.read.schema("month int, month_avg_sale double").json(f"{path}/month_avg")
    return Lookups(cat, mon, path)


def _derived_features(df: DataFrame) -> DataFrame:
    sell = F.col("selling_price").cast("double")
    cost = F.col("cost_price").cast("double")
    return (df.withColumn("profit_margin", F.try_divide(sell - cost, sell))
              .withColumn("cost_price", cost)
              .withColumn("selling_price", sell))


def features(train: DataFrame, lookups: Lookups, encoder: StringIndexerModel) -> DataFrame:
    """M2: the 11 features in the reference's order, plus targets and lineage.

    The averages are joined left, as the reference's merge; Spark broadcasts
    them while they are under its byte threshold.
    """
    cat = lookups.category_avg
    mon = lookups.month_avg
    df = train.join(cat, "category_name", "left").join(mon, "month", "left")
    df = (encoder.transform(df)
          .withColumn("is_festival_int", F.col("is_festival_month").cast("int"))
          .withColumn("base_sale_value", (F.col("quantity") * F.col("selling_price")).cast("double"))
          .withColumn("discount_percent", F.col("discount_percent").cast("double")))
    df = _derived_features(df)
    return df.select("order_key", "line_number", "category_name", *FEATURE_COLUMNS,
                     F.col("sale_amount").cast("double").alias("sale_amount"),
                     F.col("profit").cast("double").alias("profit"))


def missing_reason(columns: list[str]) -> F.Column:
    """Names of the NULL columns of a row, as text; NULL if there is none."""
    named = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda c: c.isNotNull())
    return F.when(F.size(named) > 0, F.concat(F.lit("no value for "), F.array_join(named, ", ")))


def usable(feats: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows a model can use, rejects with ``reject_reason``): a NULL in one of
    ``columns`` (a margin of price 0, for example) rejects a row."""
    reason = missing_reason(columns or [*FEATURE_COLUMNS, *[t for t in TARGETS if t in feats.columns]])
    marked = feats.withColumn("reject_reason", reason)
    return marked.filter(F.col("reject_reason").isNull()).drop("reject_reason"), marked.filter(F.col("reject_reason").isNotNull())


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features")


# Memory (MB) that a forest level's split statistics may take in a task.  More
# nodes are split at once with more; a 1 GB heap of eight tasks holds this.
TREE_MEMORY_MB = 64


def forest_regressor(target: str, trees: int = RF_TREES, depth: int = RF_DEPTH, memory_mb: int = TREE_MEMORY_MB) -> RandomForestRegressor:
    """M6: the estimator for one target, reading the assembled ``features``."""
    # Node ids are cached (faster than re-walking 100 trees per level, by
    # ~30% measured at sf0.01) and checkpointed to the shared checkpoint dir
    # every 10 iterations, so the node-id lineage stays short and a lost
    # executor costs at most 10 levels of recomputation.
    return RandomForestRegressor(featuresCol="features", labelCol=target, predictionCol="prediction",
                                 numTrees=trees, maxDepth=depth, seed=RF_SEED, featureSubsetStrategy="all",
                                 maxMemoryInMB=memory_mb, cacheNodeIds=True, checkpointInterval=10)


# Rows of a task up to MANY_TASKS tasks, then the most rows of a task; the
# number of tasks depends on the rows alone, as the trees' bootstrap draws do
# on the tasks.  Up to twice TASK_ROWS rows stay as they are read.
TASK_ROWS = 50_000
MANY_TASKS = 24
MOST_TASK_ROWS = 500_000
# Rows near each other in these go the same way in most trees.
NEAR_COLUMNS = ["base_sale_value", "discount_percent", "profit_margin", "cost_price", "month"]


def dealt(rows: DataFrame, count: int) -> DataFrame:
    """The rows in tasks of about equal size, neighbours in the features side
    by side.

    The sales lie in one partition a year, so a tree level would wait for the
    largest; and rows in the order of the sales touch another node's split
    statistics each time, which takes twice the CPU time.  Hash and full sort
    give every run the same tasks and order.
    """
    if count <= 2 * TASK_ROWS:
        return rows
    tasks = max(min(MANY_TASKS, -(-count // TASK_ROWS)), -(-count // MOST_TASK_ROWS))
    return rows.repartition(tasks, *rows.columns).sortWithinPartitions(*NEAR_COLUMNS, *[c for c in rows.columns if c not in NEAR_COLUMNS])


# ------------------------------------------------------------ least squares
@dataclass
class LinearModel:
    """M5: intercept and one coefficient a feature."""

    target: str
    intercept: float
    coefficients: dict[str, float]

    def prediction(self) -> F.Column:
        """The prediction as an expression over the features."""
        out = F.lit(self.intercept)
        for c, b in self.coefficients.items():
            out = out + F.col(c) * F.lit(b)
        return out


def moments(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Sufficient statistics of the columns in one aggregate (one row): the
    number of rows, the means and all centred second moments.  Spark merges
    them in centred form, so large means cost no digits."""
    c = [F.col(x).cast("double") for x in columns]
    return rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"mean_{i}") for i, x in enumerate(c)],
                    *[F.covar_pop(c[i], c[j]).alias(f"cov_{i}_{j}") for i in range(len(c)) for j in range(i, len(c))])


def fit_linear(rows: DataFrame, targets: list[str] = TARGETS, feature_columns: list[str] = FEATURE_COLUMNS) -> list[LinearModel]:
    """M5: least squares of every target from one pass over the rows; the
    driver solves a system of as many equations as features.

    Of features that depend on each other linearly (a constant one, too) the
    solution of smallest norm in standard units is taken.  Rows must have no NULL; no rows
    give no models.
    """
    columns = [*feature_columns, *targets]
    row = moments(rows, columns).head()
    if not row.n:
        return []
    k = len(feature_columns)
    mean = np.array([row[f"mean_{i}"] for i in range(len(columns))])
    cov = np.array([[row[f"cov_{min(i, j)}_{max(i, j)}"] for j in range(len(columns))] for i in range(len(columns))])
    unit = np.sqrt(np.diag(cov)[:k])
    unit[unit == 0] = 1.0
    solved = np.linalg.pinv(cov[:k, :k] / np.outer(unit, unit), rcond=1e-12, hermitian=True) @ (cov[:k, k:] / unit[:, None])
    out = []
    for t, target in enumerate(targets):
        b = solved[:, t] / unit
        out.append(LinearModel(target, float(mean[k + t] - b @ mean[:k]), dict(zip(feature_columns, map(float, b)))))
    return out


def save_linear(spark: SparkSession, models: list[LinearModel], path: str) -> str:
    """The models as JSON rows (target, term, value); the intercept's term is NULL."""
    rows = [(m.target, t, v) for m in models for t, v in [(None, m.intercept), *m.coefficients.items()]]
    spark.createDataFrame(rows, "target string, term string, value double").coalesce(1).write.json(path)
    return path


def load_linear(spark: SparkSession, path: str) -> list[LinearModel]:
    rows = spark.read.schema("target string, term string, value double").json(path).collect()      # features x targets
    targets = list(dict.fromkeys(r.target for r in rows))
    return [LinearModel(t, next(r.value for r in rows if r.target == t and r.term is None),
                        {r.term: r.value for r in rows if r.target == t and r.term is not None}) for t in targets]


def residual_correlations(rows: DataFrame, models: list[LinearModel]) -> DataFrame:
    """target, feature and the correlation of the residuals with the feature:
    0 (up to rounding) on the rows that the models were fitted to."""
    pairs = [(m, f) for m in models for f in m.coefficients]
    one = rows.agg(*[F.corr(F.col(m.target) - m.prediction(), F.col(f).cast("double")).alias(f"r_{i}") for i, (m, f) in enumerate(pairs)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(m.target).alias("target"), F.lit(f).alias("feature"), F.col(f"r_{i}").alias("correlation"))
                                         for i, (m, f) in enumerate(pairs)])))


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M7: MAE, RMSE, R^2 in one aggregation.

    The label's variance is summed in centred form, so labels far from 0 lose
    no digits.  R^2 of a constant label (or one row) is NULL, as are all
    metrics of no rows.  For a decimal prediction the error sums are exact.
    """
    e = F.col(label) - F.col(prediction)
    n = F.count(F.lit(1)).cast("double")
    s_abs, s_sq = F.sum(F.abs(e)).cast("double"), F.sum(e * e).cast("double")
    mse = F.try_divide(s_sq, n)
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(s_abs, n).alias("mae"),
        F.sqrt(mse).alias("rmse"),
        (F.lit(1.0) - F.try_divide(mse, F.var_pop(F.col(label).cast("double")))).alias("r2"),
    )


def _labelled_metrics(pred: DataFrame, kind: str, target: str, prediction: str = "prediction") -> DataFrame:
    return regression_metrics(pred, target, prediction).select(F.lit(kind).alias("model"), F.lit(target).alias("target"), "n", "mae", "rmse", "r2")


def train_linear(feats: DataFrame, root: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """M5: linear models on the train side, their metrics on the test side, and
    the paths of both.  Rows with a NULL are left out (see ``usable``)."""
    spark = feats.sparkSession
    root = root or new_table_path(spark, "models")
    rows, _ = usable(feats)
    models = fit_linear(rows.filter(~is_test_row()))
    paths = {"models": save_linear(spark, models, f"{root}/lr"), "metrics": f"{root}/lr_metrics"}
    test = rows.filter(is_test_row())
    parts = [_labelled_metrics(test.withColumn("prediction", m.prediction()), "lr", m.target) for m in models]
    if not parts:
        raise ValueError("no row to train on")
    functools.reduce(DataFrame.unionByName, parts).write.parquet(paths["metrics"])
    return spark.read.parquet(paths["metrics"]), paths


def train_forests(feats: DataFrame, trees: int = RF_TREES, depth: int = RF_DEPTH, root: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """M6: one forest a target on the train side; metrics on the test side.

    Models are saved under ``root`` (M10/S10); returns the metrics rows and
    the written paths (one per target, and ``"metrics"``).  Rows with a NULL
    are left out (see ``usable``).
    """
    spark = feats.sparkSession
    # Training makes several passes.  The features are a short plan over the
    # written warehouse tables, so the assembled vectors (train and test
    # rows) are kept in executor memory, spilling to disk, and a lost
    # executor's share is recomputed deterministically from those tables.
    asm = assembler()
    rows = usable(feats)[0].withColumn("__test", is_test_row())
    assembled = (asm.transform(dealt(rows, rows.count()))
                 .select("features", "__test", *TARGETS).persist(StorageLevel.MEMORY_AND_DISK))
    train = assembled.filter(~F.col("__test"))
    test = assembled.filter(F.col("__test"))
    root = root or new_table_path(spark, "models")
    paths = {"metrics": f"{root}/rf_metrics"} | {target: f"{root}/rf_{target}" for target in TARGETS}

    def fit_one(target: str) -> DataFrame:
        model = forest_regressor(target, trees, depth).fit(train)
        PipelineModel(stages=[asm, model]).write().overwrite().save(paths[target])
        return _labelled_metrics(model.transform(test), "rf", target)

    try:
        # A tree level ends with its slowest task, so the targets train side by
        # side and one fills the cores that the other leaves.  A core still runs
        # one task, so the split statistics take no more memory.
        assembled.count()
        with ThreadPoolExecutor(max_workers=len(TARGETS)) as pool:
            parts = list(pool.map(fit_one, TARGETS))
        functools.reduce(DataFrame.unionByName, parts).write.parquet(paths["metrics"])
    finally:
        assembled.unpersist()
    return spark.read.parquet(paths["metrics"]), paths


# ------------------------------------------------------------------ scoring
def requests_from_sales(sales: DataFrame, discount_percent: float = 5.0) -> DataFrame:
    """Batch of score requests (FIXTURES.md): distinct (category, month, quantity)."""
    r = sales.select("category_name", "month", "quantity").distinct()
    return r.select(F.col("category_name").alias("category"), "month", "quantity",
                    F.lit(discount_percent).alias("discount_percent"),
                    (F.col("quantity") % 2 == 0).alias("store_in_db"))


def request_features(requests: DataFrame, categories: DataFrame, products: DataFrame,
                     lookups: Lookups, month_flags: DataFrame,
                     encoder: StringIndexerModel) -> tuple[DataFrame, DataFrame]:
    """Resolve each request against the small lookup tables.

    Returns (features, rejects).  A request whose category is unknown, whose
    month has no average or that has a NULL feature goes to ``rejects`` with a
    reason (the reference answers 404 / fails).  Serving uses category-average prices
    (as the reference does), not per-product prices.
    """
    cats = categories.select(F.col("category_name").alias("category"), "category_id")
    prices = category_avg_price(products).select(
        "category_id", F.col("c").alias("cost_price"), F.col("s").alias("selling_price"))
    cat_avg = lookups.category_avg.withColumnRenamed("category_name", "category")
    mon_avg = lookups.month_avg
    flags = month_flags.select("month", F.col("is_festival").cast("int").alias("is_festival_int"))
    r = (requests.join(cats, "category", "left").join(prices, "category_id", "left")
         .join(cat_avg, "category", "left").join(mon_avg, "month", "left").join(flags, "month", "left"))
    reason = (F.when(F.col("category_id").isNull(), F.lit("category not found"))
               .when(F.col("category_avg_sale").isNull(), F.lit("no average for category"))
               .when(F.col("month_avg_sale").isNull(), F.lit("no average for month")))
    r = r.withColumn("reject_reason", reason)
    shown = ["category", "month", "quantity", "discount_percent", "reject_reason"]
    rejects = r.filter(F.col("reject_reason").isNotNull()).select(*shown)
    ok = r.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    ok = (encoder.transform(ok.withColumn("category_name", F.col("category")))
          .withColumn("is_festival_int", F.coalesce(F.col("is_festival_int"), F.lit(0)))
          .withColumn("profit_margin", F.try_divide(F.col("selling_price") - F.col("cost_price"), F.col("selling_price")))
          .withColumn("base_sale_value", F.col("quantity") * F.col("selling_price")))
    whole, without = usable(ok.select("category", "store_in_db", *FEATURE_COLUMNS), FEATURE_COLUMNS)
    return whole, rejects.unionByName(without.select(*shown))


def score(feats: DataFrame, sale_model: PipelineModel, profit_model: PipelineModel) -> DataFrame:
    """M8: two predictions per request, margin (P12) and rounding to 2 places."""
    a = sale_model.transform(feats).withColumnRenamed("prediction", "pred_sale").drop("features")
    b = profit_model.transform(a).withColumnRenamed("prediction", "pred_profit").drop("features")
    return b.select(
        "category", "month", "quantity", "discount_percent", "store_in_db",
        F.col("is_festival_int").cast("boolean").alias("is_festival_month"),
        "pred_sale", "pred_profit",
        F.round("pred_sale", 2).alias("predicted_sale_amount"),
        F.round("pred_profit", 2).alias("predicted_profit"),
        F.round(guarded_percent("pred_profit", "pred_sale"), 2).alias("profit_margin_percent"),
    )


def log_predictions(scored: DataFrame, path: str, batch_id: str) -> str:
    """M9: append the (unrounded) predictions of requests with ``store_in_db`` to
    the log at ``path``, as one batch; a batch that it knows adds nothing."""
    rows = scored.filter(F.col("store_in_db")).select(
        F.col("category").alias("category_name"), "month", "quantity",
        F.col("discount_percent").cast("decimal(5,2)").alias("discount_percent"),
        F.col("pred_sale").cast("decimal(12,2)").alias("predicted_sale"),
        F.col("pred_profit").cast("decimal(12,2)").alias("predicted_profit"),
        F.current_timestamp().alias("created_at"))
    BatchTable(scored.sparkSession, path).append(rows, batch_id)
    return path


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """M9: all logged predictions."""
    return BatchTable(spark, path).read()


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
