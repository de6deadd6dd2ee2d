"""Detection of artefacts in daily sales, as one plan over all groups.

Every rule that looks around a day is a window over the item's rows within a range of days, so nothing loops over
groups or dates. A rule that holds for a row holds for the item's whole day: flags are lifted with a maximum over
(Channel, L3Title, ItemId, ScrapDate) before labels are chosen. Windows are keyed by item, so their size follows an
item's history; the only wider grouping, daily GMV, is aggregated before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brandtide.params import RangeParams, SpikeParams
from brandtide.sources.sales import coerced

# The labels.
LABELS = {"a": "STALE_FROZEN_DAILY", "b": "NEW_ITEM_UNIFORM_COUNT", "c": "CUMULATIVE_SALESCOUNT", "d": "SPIKE_JUMP", "f": "GHOST_REAPPEARANCE", "g": "BRAND_NEW_SPIKE"}


def with_last_seen(fact: DataFrame, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """As-of, strictly before: an item's previous day in its channel and the last known total, over the whole table.

    With ``since`` and ``until`` only rows of those days come out: all before is folded into one row for each item first.
    """
    before = Window.partitionBy("Channel", "ItemId").orderBy("day_no").rangeBetween(Window.unboundedPreceding, -1)
    known = F.when(F.col("TotalInt").isNotNull(), F.struct("day_no", "TotalInt"))
    rows = fact.withColumn("day_no", F.unix_date("ScrapDate"))
    recent = rows if since is None else rows.where(F.col("ScrapDate").between(since, until))
    recent = recent.withColumn("last_seen", F.max("ScrapDate").over(before)).withColumn("last_count", F.max(known).over(before)["TotalInt"])
    if since is None:
        return recent
    past = rows.where(F.col("ScrapDate") < since).groupBy("Channel", "ItemId").agg(F.max("ScrapDate").alias("past_seen"), F.max(known)["TotalInt"].alias("past_count"))
    return recent.join(past, ["Channel", "ItemId"], "left").withColumns({"last_seen": F.coalesce("last_seen", "past_seen"), "last_count": F.coalesce("last_count", "past_count")}).drop("past_seen", "past_count")


def in_range(fact: DataFrame, p: SpikeParams) -> DataFrame:
    """Rows with sales within the period and its surroundings, and when each item was first seen among them."""
    rows = fact.where((F.col("ScrapDate") >= F.date_sub(F.lit(p.period_from), p.radius)) & (F.col("ScrapDate") <= F.date_add(F.lit(p.period_to), p.radius)) & (F.col("DailySalesValue") > 0))
    return rows.withColumn("first_seen_ever", F.min("ScrapDate").over(Window.partitionBy("ItemId", "Channel")))


def iqr_dates(rows: DataFrame, p: SpikeParams) -> DataFrame:
    """Channel, L3Title, ScrapDate, day_gmv, upper: days of the period whose GMV is above the group's bound."""
    daily = rows.groupBy("Channel", "L3Title", "ScrapDate").agg(F.sum("DailySalesValue").alias("day_gmv"))
    period = F.col("ScrapDate").between(F.lit(p.period_from), F.lit(p.period_to))
    pre = F.col("ScrapDate") < F.lit(p.period_from)
    q = lambda x, cond: F.percentile(F.when(cond, F.col("day_gmv")), F.lit(x))
    stats = daily.groupBy("Channel", "L3Title").agg(
        F.count(F.when(pre, 1)).alias("n_pre"), F.count(F.when(period, 1)).alias("n_period"),
        q(0.25, pre).alias("pre1"), q(0.5, pre).alias("pre2"), q(0.75, pre).alias("pre3"), q(0.25, period).alias("in1"), q(0.75, period).alias("in3"),
    )
    m = F.lit(p.iqr_mult)
    flat = F.col("pre2") * (1 + m * 0.1)
    upper = F.when(F.col("n_period") < 3, None).when(F.col("n_pre") >= 7, F.when(F.col("pre3") == F.col("pre1"), flat).otherwise(F.col("pre3") + m * (F.col("pre3") - F.col("pre1")))).when(F.col("n_period") >= 7, F.col("in3") + m * (F.col("in3") - F.col("in1")))
    return daily.where(period).join(stats.select("Channel", "L3Title", upper.alias("upper")), ["Channel", "L3Title"]).where("day_gmv > upper")


def with_flags(fact: DataFrame, p: SpikeParams, only: Column | None = None) -> DataFrame:
    """Rows of the period's range with flag_a to flag_g (lifted to the item's day) and gap_days.

    Rows that ``only`` leaves out serve as what an item was last seen by, and for nothing else.
    """
    rows = coerced(fact)
    if p.enable_ghost:
        rows = with_last_seen(rows, F.date_sub(F.lit(p.period_from), p.radius), F.date_add(F.lit(p.period_to), p.radius))
    else:  # no rule that counts looks back
        rows = rows.withColumns({"day_no": F.unix_date("ScrapDate"), "last_seen": F.lit(None).cast("date"), "last_count": F.lit(None).cast("bigint")})
    rows = in_range(rows if only is None else rows.where(only), p)
    item = Window.partitionBy("Channel", "L3Title", "ItemId")
    around, earlier, later = (item.orderBy("day_no").rangeBetween(*x) for x in ((-p.radius, p.radius), (-p.radius, -1), (1, p.radius)))
    n, total, r = F.col("DailySalesCount"), F.col("TotalCount"), p.radius
    days = lambda c, w: F.size(F.collect_set(c).over(w))
    sold = F.when(n > 0, n)
    frozen = days("DailySalesCount", around) <= p.frozen_max_unique
    base_n = F.count(sold).over(earlier) + F.count(sold).over(later)
    base_sum = F.coalesce(F.sum(sold).over(earlier), F.lit(0.0)) + F.coalesce(F.sum(sold).over(later), F.lit(0.0))
    day_sold = F.when(n > 0, F.col("ScrapDate"))
    base_days = days(day_sold, earlier) + days(day_sold, later)
    absent = F.max("day_no").over(earlier).isNull()
    gap = F.datediff("ScrapDate", "last_seen")
    near = F.abs(n - (F.col("TotalInt") - F.col("last_count"))) <= p.ghost_delta_tolerance
    ghost = absent & F.col("last_seen").isNotNull() & (gap > p.ghost_min_gap_days) & F.coalesce(near, F.lit(True))
    flags = {
        "a": (days("ScrapDate", around) >= p.frozen_min_days) & frozen & (F.max("DailySalesCount").over(around) > p.min_daily_count),
        "b": (F.col("first_seen_ever") >= F.date_sub("ScrapDate", r)) & frozen & (F.min("DailySalesCount").over(around) > p.min_daily_count),
        "c": (n > p.min_daily_count) & (total > 0) & (F.try_divide(n, total) > p.cumulative_ratio),
        "d": (n > p.min_daily_count) & (base_days >= p.min_baseline_days) & (base_sum > 0) & (n > F.try_divide(base_sum, base_n) * p.jump_mult),
        "f": ghost,
        "g": absent & F.col("last_seen").isNull() & (n > p.ghost_new_min_count) & (F.max("day_no").over(item) == F.col("day_no")),
    }
    rows = rows.withColumns({f"row_{k}": F.coalesce(v, F.lit(False)) for k, v in flags.items()} | {"row_gap": F.when(ghost, gap)})
    day = Window.partitionBy("Channel", "L3Title", "ItemId", "ScrapDate")
    lifted = {f"flag_{k}": F.max(f"row_{k}").over(day) for k in flags} | {"gap_days": F.max("row_gap").over(day)}
    return rows.withColumns(lifted).drop(*[f"row_{k}" for k in flags], "row_gap")


def labelled(fact: DataFrame, p: SpikeParams, only: Column | None = None) -> DataFrame:
    """Flagged rows of the period (and of ``only``) with label, window, GMV in millions, ratio and gap."""
    rows = with_flags(fact, p, only)
    dates = iqr_dates(in_range(coerced(fact if only is None else fact.where(only)), p), p).select("Channel", "L3Title", "ScrapDate", F.lit(True).alias("is_iqr"))
    rows = rows.where(F.col("ScrapDate").between(F.lit(p.period_from), F.lit(p.period_to))).join(dates, ["Channel", "L3Title", "ScrapDate"], "left")
    iqr = F.coalesce("is_iqr", F.lit(False))
    gate = {"a": iqr & p.include_stale, "b": iqr & p.include_stale, "c": F.lit(True), "d": F.lit(True), "f": iqr & p.enable_ghost, "g": iqr & p.enable_ghost}
    label = F.coalesce(*[F.when(F.col(f"flag_{k}") & gate[k], name) for k, name in LABELS.items()])
    ratio = F.when(F.col("TotalCount") > 0, F.round(F.try_divide("DailySalesCount", "TotalCount"), 4))
    return (
        rows.withColumn("spike_flag", label).where("spike_flag is not null")
        .withColumns({"spike_date": F.col("ScrapDate"), "win_from": F.date_sub("ScrapDate", p.radius), "win_to": F.date_add("ScrapDate", p.radius), "gmv_jt": F.round(F.col("DailySalesValue") / 1e6, 3), "daily_to_total_ratio": ratio, "gap_days": F.when(iqr & p.enable_ghost, F.col("gap_days"))})
        .drop("is_iqr", "day_no", "last_seen", "last_count", "TotalCount", "TotalInt", *[f"flag_{k}" for k in LABELS])
    )


def above_min_gmv(rows: DataFrame, p: SpikeParams) -> DataFrame:
    return rows.where(F.col("gmv_jt") >= p.min_gmv)


def summary(rows: DataFrame) -> DataFrame:
    keys = ["Channel", "L3Title", "spike_date", "spike_flag"]
    return rows.dropna(subset=keys).groupBy(*keys).agg(F.count_distinct("ItemId").alias("item_count"), F.round(F.sum("gmv_jt"), 3).alias("gmv_jt"))


def totals(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_distinct("ItemId").alias("items"), F.round(F.sum("gmv_jt"), 3).alias("gmv_jt"), F.count("*").alias("n_rows"))


def range_flags(fact: DataFrame, p: RangeParams) -> DataFrame:
    """ItemId and spike_flag, a row for each of the three detectors that names the item (not deduplicated)."""
    scope = F.col("Channel") == p.channel
    if p.l3title:
        scope &= F.col("L3Title") == p.l3title
    if p.shops:
        scope &= F.col("ShopName").isin(*p.shops)
    rows = coerced(fact).where(scope)
    n, target = F.col("DailySalesCount"), F.col("ScrapDate").between(F.lit(p.target_from), F.lit(p.target_to))
    window = F.col("ScrapDate").between(F.lit(p.detection_from), F.lit(p.detection_to))
    keys = ["ItemId", "Channel"]
    sold = window & (n > 0)
    base = sold & ~target
    stats = rows.groupBy(*keys).agg(
        F.count_distinct(F.when(sold, F.col("ScrapDate"))).alias("days"), F.count_distinct(F.when(sold, n)).alias("kinds"), F.min(F.when(sold, n)).alias("least"), F.max(F.when(sold, n)).alias("most"), F.min("ScrapDate").alias("first_seen"),
        F.avg(F.when(base, n)).alias("baseline"), F.count_distinct(F.when(base, F.col("ScrapDate"))).alias("base_days"), F.max(F.when(target, n)).alias("target_most"),
        # A total of zero makes an infinite ratio here and so a flag; the variant by day does not flag it.
        F.max(F.when(target & (n > p.min_count) & F.col("TotalCount").isNotNull() & (F.col("SalesCount") != "null"), F.when(F.col("TotalCount") == 0, True).otherwise(F.try_divide(n, "TotalCount") > p.cumulative_ratio))).alias("cumulative"),
    )
    frozen = (F.col("kinds") <= 2) & (F.col("days") >= p.min_days) & (F.col("most") > p.min_count)
    uniform = (F.col("first_seen") >= F.lit(p.detection_from)) & (F.col("kinds") <= 2) & (F.col("least") > p.min_count)
    jump = (F.col("base_days") >= 2) & (F.col("baseline") > 0) & (F.col("target_most") > p.min_count) & (F.col("target_most") > F.col("baseline") * p.jump_mult)
    stale = F.when(F.col("days") > 0, F.when(frozen, LABELS["a"]).when(uniform, LABELS["b"]))
    label = F.coalesce(stale, F.when(F.col("cumulative"), LABELS["c"]), F.when(jump, LABELS["d"]))
    hits = F.array_compact(F.array(F.when(stale.isNotNull(), 1), F.when(F.col("cumulative"), 2), F.when(jump, 3)))
    return stats.select("ItemId", label.alias("spike_flag"), F.explode(hits).alias("branch"))


def range_preview(fact: DataFrame, p: RangeParams, deduplicated: bool = False) -> DataFrame:
    """Rows of the target range whose item is flagged; repeated for each detector that flags it, unless deduplicated."""
    flags = range_flags(fact, p).drop("branch")
    flags = flags.distinct() if deduplicated else flags
    scope = (F.col("Channel") == p.channel) & F.col("ScrapDate").between(F.lit(p.target_from), F.lit(p.target_to)) & (F.col("DailySalesValue") > 0)
    if p.l3title:
        scope &= F.col("L3Title") == p.l3title
    if p.shops:
        scope &= F.col("ShopName").isin(*p.shops)
    return coerced(fact).where(scope).join(flags, "ItemId").select(
        "ScrapDate", "ItemId", "L3Title", "Channel", "ShopName", "ListingName", "SalePrice", "SalesCount", F.round("DailySalesCount", 0).alias("daily_count"), F.round(F.col("DailySalesValue") / 1e6, 3).alias("gmv_jt"), F.round(F.try_divide("DailySalesCount", "TotalCount"), 4).alias("daily_to_total_ratio"), "spike_flag"
    )


# Columns of the report's two tables, and the names under which they are exported.
DETAIL = "spike_date Channel L3Title KeywordCategory Brand spike_flag ItemId ShopName ListingName SalePrice DailySalesCount gmv_jt daily_to_total_ratio gap_days win_from win_to".split()
DETAIL_NAMES = {"spike_date": "Spike Date", "spike_flag": "Flag", "gmv_jt": "GMV (jt)", "daily_to_total_ratio": "Daily/Total Ratio", "gap_days": "Gap Hari (F)", "win_from": "Window From", "win_to": "Window To"}
SUMMARY_NAMES = {"spike_date": "Spike Date", "spike_flag": "Flag", "item_count": "Jumlah Item", "gmv_jt": "GMV Terdampak (jt)"}


def exported(rows: DataFrame) -> DataFrame:
    """The detail under its export names; columns that are missing are left out."""
    return rows.select([F.col(c).alias(DETAIL_NAMES.get(c, c)) for c in DETAIL if c in rows.columns])


def summary_lines(rows: DataFrame) -> DataFrame:
    """Channel, L3Title, line_no, line: the summary as text, a heading for each group; ``rows`` is a summary."""
    width = lambda c, n: F.lpad(c, n, " ")
    body = F.format_string("  %-14s  %-26s  %s  %s", F.col("spike_date").cast("string"), "spike_flag", width(F.col("item_count").cast("string"), 6), width(F.format_number("gmv_jt", 3), 12))
    keys = ["Channel", "L3Title"]
    lines = rows.select(*keys, (F.row_number().over(Window.partitionBy(*keys).orderBy("spike_date", "spike_flag")) + 1).alias("line_no"), body.alias("line"))
    titles = F.format_string("  %-14s  %-26s  %6s  %12s", *map(F.lit, ("Date", "Flag", "Items", "GMV (jt)")))
    heading = lambda n, text: F.struct(F.lit(n).alias("line_no"), text.alias("line"))
    heads = rows.select(*keys).distinct().select(*keys, F.explode(F.array(heading(0, F.concat_ws("  ›  ", *keys)), heading(1, titles))).alias("x")).select(*keys, "x.*")
    return heads.unionByName(lines)


def total_line(rows: DataFrame) -> DataFrame:
    """The totals as one line of text."""
    t = totals(rows)
    return t.select(F.concat(F.lit("TOTAL Flagged Items: "), F.format_number("items", 0), F.lit("  |  Total GMV Terdampak: "), F.format_number(F.coalesce("gmv_jt", F.lit(0.0)), 3), F.lit(" jt")).alias("line"))


def item_history(fact: DataFrame) -> DataFrame:
    """ItemId, first_seen, days, kinds (of daily counts), most, gmv over the whole table."""
    return fact.groupBy("ItemId").agg(
        F.min("ScrapDate").alias("first_seen"), F.count_distinct("ScrapDate").alias("days"), F.count_distinct("DailySalesCount").alias("kinds"), F.max("DailySalesCount").alias("most"), F.round(F.sum("DailySalesValue"), 2).alias("gmv")
    )


def top_items(fact: DataFrame, n: int = 10) -> DataFrame:
    """The items of the largest GMV, ties by id."""
    return fact.groupBy("ItemId").agg(F.round(F.sum("DailySalesValue"), 2).alias("gmv")).orderBy(F.desc("gmv"), "ItemId").limit(n)


def survivors(fact: DataFrame, flagged: DataFrame, keys: list[str], applies: Column | None = None) -> DataFrame:
    """The table without the rows that a DELETE of ``flagged`` keys removes (of rows for which ``applies`` holds)."""
    if applies is None:
        return fact.join(flagged.select(*keys).distinct(), keys, "left_anti")
    gone = flagged.select(*keys).distinct().withColumn("__gone", F.lit(True))
    return fact.join(gone, keys, "left").where(~(F.coalesce("__gone", F.lit(False)) & F.coalesce(applies, F.lit(False)))).drop("__gone")
