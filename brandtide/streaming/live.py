"""Extension: the row rules on a stream of daily facts. The batch detectors remain the definition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandtide.params import SpikeParams
from brandtide.sources.sales import coerced


def cumulative_stream(facts: DataFrame, p: SpikeParams) -> DataFrame:
    """Rows of a (streaming) fact whose daily count is most of the running total; stateless, so no watermark is needed."""
    rows = coerced(facts)
    n = F.col("DailySalesCount")
    return rows.where((n > p.min_daily_count) & (F.col("TotalCount") > 0) & (F.try_divide(n, "TotalCount") > p.cumulative_ratio)).drop("TotalCount", "TotalInt")


def daily_totals_stream(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """GMV by day and channel from a stream of sales with ``ts``, ``Channel``, ``value``; late rows within ``delay`` count."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "Channel").agg(F.sum("value").alias("gmv"), F.count("*").alias("n"))
