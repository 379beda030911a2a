"""KPI marts kept month by month.

The additive monthly figures of a mart are stored per month. Loading months
recomputes the figures of these months only (from a listings table partitioned by
month, only their folders are read). The change columns look at a key's next month, so a load also
changes the rows whose next month it brings, replaces or takes away; these months are
found from the stored figures before and after, and only their folders of the
finished mart are rewritten.

    <path>/figures/month_year=MM-yyyy    monthly_listing_aggregates of the month
    <path>/mart/month_year=MM-yyyy       the finished KPI rows

Figures are written before the mart; a run that dies in between is repaired by
running the same load again. A month is replaced by its new rows; one that comes
without any row stays as it is.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylake.functions.dates import label_time_key
from staylake.operators.kpi import finished_kpis, monthly_listing_aggregates
from staylake.sources.sinks import write_table
from staylake.sources.store import materialize


class KpiMart:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: str = "label"):
        self.spark, self.path, self.keys, self.order = spark, path, list(keys), order

    def _stored(self, part: str) -> DataFrame | None:
        """A stored part; labels are kept with a dash, as a slash cannot be a folder name."""
        try:
            rows = self.spark.read.parquet(f"{self.path}/{part}")
        except AnalysisException:  # nothing loaded yet
            return None
        return rows.withColumn("month_year", F.replace("month_year", F.lit("-"), F.lit("/")))

    def _save(self, rows: DataFrame, part: str) -> None:
        rows = rows.withColumn("month_year", F.replace("month_year", F.lit("/"), F.lit("-")))
        write_table(rows, f"{self.path}/{part}", partition_by=["month_year"], files_per_partition=1)

    def _leading_to(self, figures: DataFrame, months: list[str]) -> set[str]:
        """The months that hold a row whose next month is one of ``months``."""
        at = F.col("month_year") if self.order == "label" else label_time_key("month_year")
        following = F.lead("month_year").over(Window.partitionBy(*self.keys).orderBy(at))
        ahead = figures.select("month_year", following.alias("next")).filter(F.col("next").isin(months))
        return {r[0] for r in ahead.select("month_year").distinct().collect()}  # at most all months

    def load(self, rows: DataFrame, date_col: str = "scraped_date") -> list[str]:
        """Take in the months that ``rows`` holds (all rows of each); the months rewritten in the mart."""
        new = monthly_listing_aggregates(rows, self.keys, date_col).filter(F.col("month_year").isNotNull())
        new = materialize(self.spark, {"figures": new}, "mart-load")["figures"]  # computed once, looked at twice
        held = self._stored("figures")
        stale: set[str] = set()
        months = [r[0] for r in new.select("month_year").distinct().collect()]
        if not months:
            return []
        if held is not None:
            stale |= self._leading_to(held, months)
        self._save(new, "figures")
        figures = self._stored("figures")
        stale |= self._leading_to(figures, months) | set(months)
        finished = finished_kpis(figures, self.keys, self.order)
        self._save(finished.filter(F.col("month_year").isin(sorted(stale))), "mart")
        return sorted(stale)

    def read(self) -> DataFrame | None:
        return self._stored("mart")
