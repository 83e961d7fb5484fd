"""The three layers as lazy DataFrames over one set of bronze inputs.

Nothing here runs a job: every attribute is a plan. ``auric.plans.pipeline``
writes these plans to tables; the checks and reports read them directly.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from auric.context import RunContext, configure_session
from auric.operators import dq
from auric.operators.gold import Gold, build_gold
from auric.operators.silver import Silver, build_silver
from auric.sources.fixtures import FIXTURE_CTX, bronze_from_testdata


class Lakehouse:
    def __init__(self, bronze: dict[str, DataFrame], ctx: RunContext):
        self.bronze = bronze
        self.ctx = ctx

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str,
                      ctx: RunContext = FIXTURE_CTX) -> "Lakehouse":
        configure_session(spark)
        lh = cls(bronze_from_testdata(spark, sf_dir, ctx), ctx)
        lh.spark, lh.sf_dir = spark, sf_dir
        return lh

    @classmethod
    def from_tables(cls, spark: SparkSession, layout=None, ctx: RunContext = FIXTURE_CTX
                    ) -> "Lakehouse":
        """Gold from the tables the batch job wrote (what dashboards query);
        bronze is the stored bronze, and silver is planned from it on use."""
        from auric.plans.pipeline import Layout, gold_tables
        layout = layout or Layout()
        configure_session(spark)
        bronze = {n: spark.table(f"{layout.bronze}.{n}_raw")
                  for n in ("customers", "products", "loyalty_segments", "sales_orders")}
        lh = cls(bronze, ctx)
        lh.__dict__["gold"] = Gold(**gold_tables(spark, layout))
        return lh

    @cached_property
    def silver(self) -> Silver:
        return build_silver(self.bronze, self.ctx)

    @cached_property
    def gold(self) -> Gold:
        return build_gold(self.silver)

    @property
    def quarantine(self) -> DataFrame:
        return dq.unified_quarantine(self.silver.results())

    @property
    def dq_results(self) -> DataFrame:
        return dq.batch_summary(self.silver.results())

    def silver_tables(self) -> dict[str, DataFrame]:
        s = self.silver
        return {
            "customers": s.customers.clean,
            "products": s.products.clean,
            "loyalty_segments": s.loyalty_segments.clean,
            "orders": s.orders.clean,
            "order_line_items": s.order_line_items.clean,
            "dq_quarantine": self.quarantine,
            "dq_results": self.dq_results,
        }
