"""Bulk JSON document export (S11), re-aimed from a document-store client.

A "collection" is a folder of JSON lines ``{"doc_id": ..., <fields>}``.
``set`` writes documents by id (an upsert: a new version of the
collection = old documents whose id is not re-sent + the sent documents);
``add`` appends documents under generated ids, as one batch of the collection.
The ids come from the documents' content, so a retried batch neither adds a
document twice nor renames one.  Nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import one_per_key
from ..session import new_table_path
from .batches import BatchTable


def set_documents(spark: SparkSession, docs: DataFrame, collection: str | None = None,
                  id_col: str = "doc_id", order_col: str | None = None) -> str:
    """Upsert ``docs`` by ``id_col`` into ``collection``; returns the new collection path.

    Of documents sent with one id the last by ``order_col`` stays (without it
    the greatest by its values).  A document needs an id: rows without one
    are refused."""
    if docs.filter(F.col(id_col).isNull()).limit(1).count():
        raise ValueError(f"a document has no {id_col}")
    out = new_table_path(spark, "collection")
    docs = one_per_key(docs, id_col, order_col, last=True)
    if collection is not None:
        old = spark.read.schema(docs.schema).json(collection)
        docs = old.join(docs.select(id_col), id_col, "left_anti").unionByName(docs)
    docs.write.json(out)
    return out


def content_id(columns: list[str]) -> F.Column:
    """sha256 of the values as text, each with its length; NULL is ``-``."""
    form = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*form), 256)


COPIES = 1000       # equal documents that one row of the numbering stands for


def with_content_ids(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents under ids made of their content and, among equal ones,
    their number (1, 2, ...).  Equal documents are counted before the shuffle;
    those of more than ``COPIES`` copies alone are spread again in runs, so a
    document of very many copies costs no task more than a run."""
    cols = docs.columns
    counted = docs.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    few = counted.filter(F.col("__n") <= COPIES).withColumn("__run", F.lit(0).cast("long"))
    runs = counted.filter(F.col("__n") > COPIES).withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__n - 1) div {COPIES}"))))
    runs = few.unionByName(runs.repartition(F.xxhash64(*cols, "__run")))
    numbers = F.sequence(F.col("__run") * COPIES + 1, F.least(F.col("__n"), (F.col("__run") + 1) * COPIES))
    each = runs.withColumn("__k", F.explode(numbers))
    return each.select(F.sha2(F.concat(content_id(cols), F.lit("#"), F.col("__k").cast("string")), 256).alias(id_col), *cols)


def add_documents(docs: DataFrame, collection: str, batch_id: str, id_col: str = "doc_id") -> str:
    """Append ``docs`` under ids of their content (``with_content_ids``, then
    told apart by batch, as ``add`` always makes a new document).  A batch id
    that the collection knows adds nothing."""
    named = with_content_ids(docs, id_col).withColumn(id_col, F.sha2(F.concat(F.lit(f"{batch_id}/"), F.col(id_col)), 256))
    BatchTable(docs.sparkSession, collection, named.schema, "json").append(named, batch_id)
    return collection


def read_added(spark: SparkSession, collection: str, schema) -> DataFrame:
    """The documents of a collection's batches."""
    return BatchTable(spark, collection, schema, "json").read()


def read_documents(spark: SparkSession, collection: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(collection)


def product_documents(products: DataFrame) -> DataFrame:
    """Product documents: id-keyed, category as a string, prices as numbers."""
    return products.select(
        F.concat(F.lit("product_"), F.col("product_id").cast("string")).alias("doc_id"),
        "product_name",
        F.col("category_id").cast("string").alias("category_id"),
        F.col("cost_price").cast("double").alias("cost_price"),
        F.col("selling_price").cast("double").alias("selling_price"),
        "stock_quantity")


def sale_documents(sales: DataFrame) -> DataFrame:
    """Sale documents (fields of the reference's sale document)."""
    return sales.select(
        F.concat(F.lit("product_"), F.col("product_id").cast("string")).alias("product_id"),
        "product_name", "quantity",
        F.col("sale_amount").cast("double").alias("sale_amount"),
        F.col("profit").cast("double").alias("profit"),
        F.col("is_festival_month").alias("is_festival"),
        F.col("created_at").alias("sale_date"))


def as_json_rows(df: DataFrame, column: str = "json") -> DataFrame:
    """Each result row as one JSON object (the payload an endpoint returns),
    built on the executors; collect or stream it only at the edge."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(column))
