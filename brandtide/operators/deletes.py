"""Deletes as text, as decisions, and as survivors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = ["Channel", "L3Title", "spike_date", "win_from", "win_to"]


def chunks(rows: DataFrame, size: int = 500) -> DataFrame:
    """Item ids of each group by GMV, largest first, in chunks: columns of the group, chunk, n_chunks, items."""
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("gmv_jt"), "ItemId"))
    numbered = rows.withColumn("rank", rank).withColumn("chunk", F.ceil(F.col("rank") / size).cast("int"))
    per_chunk = numbered.groupBy(*GROUP, "chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "ItemId"))), lambda x: x["ItemId"]).alias("items"))
    return per_chunk.withColumn("n_chunks", F.max("chunk").over(Window.partitionBy(*GROUP)))


def statements(rows: DataFrame, table: str, size: int = 500) -> DataFrame:
    """One reviewable DELETE for each chunk, quotes doubled."""
    # Fixed values below: the wording of the statement and its comments.
    quoted = lambda c: F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))
    day = F.col("spike_date").cast("string")
    mark = F.when(F.col("n_chunks") > 1, F.format_string(" (chunk %d/%d)", "chunk", "n_chunks")).otherwise("")
    ids = F.array_join(F.transform("items", quoted), ", ")
    l3 = F.when(F.col("L3Title") != "", F.concat(F.lit("AND L3Title = "), quoted(F.col("L3Title")))).otherwise(F.lit("-- AND L3Title = ''"))
    text = F.concat(
        F.lit("-- ["), "Channel", F.lit("] × ["), "L3Title", F.lit("] | Spike: "), day, F.lit(" | Window: "), F.col("win_from").cast("string"), F.lit("~"), F.col("win_to").cast("string"), mark,
        F.lit("\n-- Items terdampak: "), F.size("items").cast("string"), F.lit(f" (sorted by GMV desc)\nALTER TABLE {table}\nDELETE WHERE\n    Channel   = "), quoted(F.col("Channel")),
        F.lit("\n    AND ScrapDate BETWEEN '"), day, F.lit("' AND '"), day, F.lit("'\n    AND DailySalesValue > 0\n    "), l3, F.lit("\n    AND ItemId IN ("), ids, F.lit(");"),
    )
    return chunks(rows, size).select(*GROUP, "chunk", text.alias("statement"))


def asked(rows: DataFrame) -> DataFrame:
    """What an analyst sees before a group is decided: ordinal, group, its item count, GMV and items, largest GMV first."""
    item = rows.groupBy(*GROUP, "ItemId").agg(F.sum("gmv_jt").alias("gmv"))
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("gmv"), "ItemId"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "ItemId"))), lambda x: x["ItemId"])  # a delete names them all
    groups = item.withColumn("rank", rank).groupBy(*GROUP).agg(F.count("*").alias("item_count"), F.round(F.sum("gmv"), 3).alias("gmv_jt"), listed.alias("items"))
    return groups.withColumn("ordinal", F.row_number().over(Window.orderBy("Channel", "L3Title", "spike_date", "win_from", "win_to")))  # a row for each question


def decided(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows whose group is answered y before the first q; ``decisions``: Channel, L3Title, spike_date, ordinal, answer."""
    order = Window.orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)  # a row for each question that was asked
    yes = decisions.withColumn("stopped", F.max(F.when(F.lower("answer") == "q", 1).otherwise(0)).over(order)).where((F.col("stopped") == 0) & (F.lower("answer") == "y"))
    return rows.join(yes.select("Channel", "L3Title", "spike_date"), ["Channel", "L3Title", "spike_date"], "left_semi")


def stage_ranges(total: int, target_percent: int = 100, stage_percent: int = 20) -> list[tuple[int, int]]:
    """Row ranges (from, to) of a job that runs in stages."""
    end, step = -(-total * target_percent // 100), max(1, -(-total * stage_percent // 100))
    return [(a, min(a + step, end)) for a in range(0, end, step)]


def resume(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that no earlier stage finished."""
    return rows.join(done.where("ResultStatus = 'success'").select(key), key, "left_anti")
