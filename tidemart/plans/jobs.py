"""The warehouse as batch jobs: every layer is written once and read back by the next."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from tidemart.operators import keywords, stats
from tidemart.plans.warehouse import Settings, Warehouse
from tidemart.schemas import (KEYWORD_STATS_COLUMNS, PRODUCT_STATS_COLUMNS,
                              PROVINCE_STATS_COLUMNS, VISITOR_STATS_COLUMNS)
from tidemart.sources.derived import Inputs

# In order of dependence: a layer reads only layers named before it.
LAYERS = ("repaired", "uniques", "bounced", "tokens", "order_rows", "order_wide",
          "payment_rows", "payment_wide")


class LayeredWarehouse(Warehouse):
    """A warehouse whose shared layers are tables below a folder.

    Writing a layer ends its lineage: a lost executor costs the running step, not the
    layers below it, and two readers of a layer do not work it out twice.
    """

    def __init__(self, inputs: Inputs, settings: Settings, folder: str):
        super().__init__(inputs, settings)
        self.folder = folder

    def write_layers(self) -> None:
        for name in LAYERS:
            path = os.path.join(self.folder, name)
            layer = getattr(self, name)
            layer.write.mode("overwrite").parquet(path)
            # Layers are cached properties, so later ones are built on the table.
            self.__dict__[name] = self.inputs.spark.read.schema(layer.schema).parquet(path)

    def visitor_events(self, compact: bool = False) -> DataFrame:
        """From the layers, which are there already."""
        return stats.visitor_events(self.pages, self.uniques, self.bounced, compact)

    def write_statistics(self) -> None:
        size = self.settings.window
        tables = {
            "visitor_stats": (stats.visitor_stats(self.visitor_events(compact=True), size),
                              VISITOR_STATS_COLUMNS),
            "product_stats": (self.product_stats_enriched(), PRODUCT_STATS_COLUMNS),
            "province_stats": (stats.province_stats(self.order_wide, size), PROVINCE_STATS_COLUMNS),
            "keyword_stats": (keywords.keyword_stats(self.tokens, size), KEYWORD_STATS_COLUMNS)}
        for name, (table, columns) in tables.items():
            rows = stats.sink_row(stats.stamped(table, self.settings.stats_ms), columns)
            rows.write.mode("overwrite").parquet(os.path.join(self.folder, name))
