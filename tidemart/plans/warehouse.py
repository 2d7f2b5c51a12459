"""The layers of the warehouse, each built from the one below.

On a cluster the layers are written and read back (``tidemart.plans.jobs``); here they are
plain DataFrames, so a single plan can also run through several of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from tidemart.operators import changelog, dims, keywords, logs, routing, rules, stats, visits, wide
from tidemart.sources.derived import Inputs


@dataclass(frozen=True)
class Settings:
    """Parameters of the operators; the defaults are those of a live shop."""

    window: str = "2 seconds"
    bounce_gap_ms: int = 10_000
    as_of_ms: int = 0
    stats_ms: int | None = None


class Warehouse:
    def __init__(self, inputs: Inputs, settings: Settings):
        self.inputs, self.settings = inputs, settings

    # ---- logs
    @cached_property
    def log(self) -> DataFrame:
        return self.inputs.page_log()

    @cached_property
    def repaired(self) -> DataFrame:
        return logs.repair_new_users(self.log)

    @cached_property
    def pages(self) -> DataFrame:
        return logs.split_pages(self.repaired)

    @cached_property
    def raw_pages(self) -> DataFrame:
        """Page records for jobs that do not look at the new-user flag."""
        return logs.split_pages(self.log)

    @cached_property
    def uniques(self) -> DataFrame:
        return visits.daily_unique_visits(self.pages)

    @cached_property
    def bounced(self) -> DataFrame:
        return visits.bounces(self.pages, self.settings.bounce_gap_ms, others=self.raw_pages)

    def visitor_events(self, compact: bool = False) -> DataFrame:
        flagged = visits.flagged_pages(self.inputs.visit_log(), self.settings.bounce_gap_ms)
        return stats.visitor_rows(flagged, compact)

    @cached_property
    def searches(self) -> DataFrame:
        return keywords.keyword_rows(self.raw_pages)

    @cached_property
    def tokens(self) -> DataFrame:
        return keywords.keyword_tokens(self.searches)

    # ---- changes
    @cached_property
    def change_lines(self) -> DataFrame:
        return routing.parse_changes(self.inputs.change_log())

    @cached_property
    def changes(self) -> DataFrame:
        return routing.non_empty(routing.clean_changes(self.change_lines))

    @cached_property
    def normal_changes(self) -> DataFrame:
        return routing.normalize_type(self.changes)

    @cached_property
    def config(self) -> DataFrame:
        return routing.checked_config(self.inputs.routes())

    @cached_property
    def facts(self) -> DataFrame:
        return routing.fact_changes(self.normal_changes, self.config)

    @cached_property
    def dim_changes(self) -> DataFrame:
        return routing.dim_changes(self.normal_changes, self.config)

    @cached_property
    def route_config(self) -> DataFrame:
        return routing.latest_config(changelog.envelope(self.inputs.route_feed()))

    def customer_feed(self, snapshot: DataFrame, history: DataFrame) -> DataFrame:
        """The customers' snapshot and change feed as one feed of images, each with its key."""
        columns = ("id", "name", "gender")
        images = changelog.envelope(history)
        changes = images.select("type", F.coalesce(F.col("data")["id"], F.col("before")["id"]).alias("pk"),
                                *[F.col("data")[name].alias(name) for name in columns[1:]], "seq")
        return changelog.bootstrapped(snapshot.withColumnRenamed("id", "pk"), changes)

    # ---- wide rows
    @cached_property
    def products(self) -> DataFrame:
        i = self.inputs
        return dims.product_dimension(i.skus(), i.spus(), i.trademarks(), i.categories())

    @cached_property
    def order_pairs(self) -> DataFrame:
        return wide.join_order_details(self.inputs.orders(), self.inputs.details())

    @cached_property
    def order_rows(self) -> DataFrame:
        """Wide order rows before the lookups, for jobs that need no dimension column."""
        return wide.order_wide(self.order_pairs)

    @cached_property
    def payment_rows(self) -> DataFrame:
        return wide.payment_wide(wide.join_payments(self.inputs.payments(), self.order_rows))

    @cached_property
    def _known_rows(self) -> DataFrame:
        """Wide order rows that know their user: an order is looked up once, not with every line."""
        orders = dims.with_user(self.inputs.orders(), self.inputs.users(), self.settings.as_of_ms)
        return wide.order_wide(wide.join_order_details(orders, self.inputs.details()))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Products and, last, provinces: what these add is long, and they are few enough to be sent to the rows."""
        return dims.with_province(dims.with_product(rows, self.products), self.inputs.provinces())

    @cached_property
    def order_wide(self) -> DataFrame:
        return self._placed(self._known_rows)

    @cached_property
    def payment_wide(self) -> DataFrame:
        """Products are looked up last, where the rows to be moved are those that were paid."""
        paid = wide.payment_wide(wide.join_payments(self.inputs.payments(), self._known_rows))
        return self._placed(paid)

    # ---- products
    def product_events(self) -> DataFrame:
        return (stats.product_page_events(self.raw_pages)
                .unionByName(stats.product_line_events(self.inputs.line_marks()))
                .unionByName(stats.product_orders(self.order_rows))
                .unionByName(stats.product_payments(self.payment_rows)))

    def product_sums(self) -> DataFrame:
        """The events above, part by part: those of lines, orders and payments are reduced where they are joined."""
        self.inputs.share_lines()
        return stats.product_sums(
            stats.product_page_events(self.raw_pages), stats.product_line_rows(self.inputs.line_marks()),
            stats.product_orders(self.order_rows), stats.product_payments(self.payment_rows), size=self.settings.window)

    def product_stats(self) -> DataFrame:
        return stats.product_result(self.product_sums(), self.settings.window)

    def product_stats_enriched(self) -> DataFrame:
        # Looked up before the windows' bounds are written out as text.
        sums = dims.with_product(self.product_sums(), self.products, price=True)
        return stats.product_result(sums, self.settings.window)

    # ---- rules
    @cached_property
    def rule_lines(self) -> DataFrame:
        return rules.parse_rules(self.inputs.rule_feed())

    @cached_property
    def active_rules(self) -> DataFrame:
        return rules.active_rules(rules.valid_rules(self.rule_lines))

    def fanned(self) -> DataFrame:
        return rules.fan_out(self.inputs.transactions(), self.active_rules)


