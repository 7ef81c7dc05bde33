"""Sales that grow: appended batches reach the serving tables at once.

The reference's views are evaluated at request time, so a new sale is in the
next answer.  Here KPIs read the daily and the product summary, so an append
merges the additive measures of the appended batch alone into both: its sales
are written and summarised, the summaries (bounded by days, categories and
products) get their next version, and one commit makes all three visible.
The sales of earlier batches are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import summary
from .batches import BatchTable

SUMMARIES = {
    "daily_summary": (summary.daily_summary, summary.DIMENSIONS),
    "product_summary": (summary.product_summary, summary.PRODUCT_DIMENSIONS),
}


class LiveSales:
    """A sales table in the folder ``path`` with its summaries.  ``base``: tables
    by name (``sales`` and the summaries) that were written before, if any."""

    def __init__(self, spark: SparkSession, path: str, base: dict[str, str] | None = None):
        self.spark, self.path, self.base = spark, path, base or {}
        self.table = BatchTable(spark, path)

    def version(self) -> int:
        return self.table.manifest.read()[0]

    def append(self, sales: DataFrame, batch_id: str) -> bool:
        """Add a batch of sales; False if its id is known already."""
        if batch_id in self.table.batches():
            return False
        folder = self.table.write_folder(sales, batch_id)
        written = self.spark.read.schema(sales.schema).parquet(folder)
        deltas = {}
        for name, (summarise, _) in SUMMARIES.items():
            deltas[name] = f"{folder}-{name}"
            summarise(written).write.parquet(deltas[name])

        def merged(state: dict) -> dict | None:
            if batch_id in state.get("batches", {}):
                return None
            new = dict(state, batches={**state.get("batches", {}), batch_id: folder})
            for name, (_, dims) in SUMMARIES.items():
                parts = [p for p in (state.get(name, self.base.get(name)), deltas[name]) if p]
                if len(parts) == 1:
                    new[name] = parts[0]
                    continue
                new[name] = f"{folder}-{name}-v{len(new['batches'])}"
                rows = self.spark.read.parquet(parts[0]).unionByName(self.spark.read.parquet(parts[1]))
                rows.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in summary.MEASURES]).write.mode("overwrite").parquet(new[name])
            return new
        return self.table.manifest.update(merged)["batches"][batch_id] == folder

    def sales(self) -> DataFrame:
        """All sales: the base and every committed batch."""
        base = self.spark.read.parquet(self.base["sales"]) if "sales" in self.base else None
        if not self.table.batches():
            if base is None:
                raise ValueError(f"{self.path}: no sales yet")
            return base
        added = self.table.read()
        return added if base is None else base.unionByName(added, allowMissingColumns=True)

    def _summary(self, name: str) -> DataFrame:
        path = self.table.manifest.read()[1].get(name, self.base.get(name))
        if path is None:
            raise ValueError(f"{self.path}: no sales yet")
        return self.spark.read.parquet(path)

    def daily_summary(self) -> DataFrame:
        """The (day, category, festival tag) measures, appended batches included."""
        return self._summary("daily_summary")

    def product_summary(self) -> DataFrame:
        """The (product name, category) measures, appended batches included."""
        return self._summary("product_summary")
