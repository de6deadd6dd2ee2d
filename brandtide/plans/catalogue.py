"""Registered queries for the marketplace operators over the given tables, and their DuckDB counterparts.

The tables have no sales facts, so facts come from ``events`` and titles from ``documents`` and ``part`` (see
``sources.sales``); thresholds that depend on the span of a month of events are set in ``SPIKES``.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brandtide.functions import text
from brandtide.operators import brands, deletes, pages, spikes
from brandtide.params import BrandParams, RangeParams, SpikeParams
from brandtide.sources.sales import coerced, listings_from_documents, sales_from_events

SPIKES = SpikeParams(period_from=date(2024, 1, 16), period_to=date(2024, 1, 30), radius=7, iqr_mult=1.0, ghost_min_gap_days=7, include_stale=True, min_gmv=0.05)
RANGE = RangeParams(detection_from=date(2024, 1, 10), detection_to=date(2024, 1, 24), target_from=date(2024, 1, 17), target_to=date(2024, 1, 18), channel="click", jump_mult=5)
#: The first days of the events, in which some items are new.
EARLY = replace(SPIKES, period_from=date(2024, 1, 2), period_to=date(2024, 1, 4), radius=1)
BRANDS = BrandParams(max_df=0.05)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listings(spark, sf_dir):
    return listings_from_documents(spark, sf_dir)


def _flag(letter: str, p: SpikeParams = SPIKES):
    def query(spark, sf_dir):
        rows = spikes.with_flags(sales_from_events(spark, sf_dir), p)
        return rows.where(F.col(f"flag_{letter}") & F.col("ScrapDate").between(F.lit(p.period_from), F.lit(p.period_to))).select("ItemId", "Channel", "ScrapDate")

    return query


def ghost_reappearance(spark, sf_dir):
    rows = spikes.with_flags(sales_from_events(spark, sf_dir), SPIKES)
    return rows.where(F.col("flag_f") & F.col("ScrapDate").between(F.lit(SPIKES.period_from), F.lit(SPIKES.period_to))).select("ItemId", "Channel", "ScrapDate", "gap_days")


def _labelled(spark, sf_dir):
    return spikes.labelled(sales_from_events(spark, sf_dir), SPIKES)


def spike_labels(spark, sf_dir):
    return _labelled(spark, sf_dir).select("ItemId", "Channel", "L3Title", "spike_date", "spike_flag", "win_from", "win_to", "gmv_jt", "daily_to_total_ratio", F.col("gap_days").cast("double").alias("gap_days"))


def delete_statements(spark, sf_dir):
    return deletes.statements(_labelled(spark, sf_dir), "sales", 20)


def delete_questions(spark, sf_dir):
    rows = deletes.asked(_labelled(spark, sf_dir))
    return rows.select("ordinal", "Channel", "L3Title", "spike_date", "item_count", "gmv_jt", F.array_join("items", ",").alias("ids"))


def report_detail(spark, sf_dir):
    return spikes.exported(_labelled(spark, sf_dir)).drop("GMV (jt)").withColumn("Gap Hari (F)", F.col("Gap Hari (F)").cast("double"))


def delete_decisions(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    asked = rows.groupBy("Channel", "L3Title", "spike_date").agg(F.count("*").alias("n")).withColumn("ordinal", F.row_number().over(Window.orderBy("Channel", "L3Title", "spike_date")))
    answers = asked.withColumn("answer", F.when(F.col("ordinal") == 15, "q").when(F.col("ordinal") % 2 == 0, "n").otherwise("y"))
    return deletes.decided(rows, answers).select("ItemId", "Channel", "L3Title", "spike_date")


def delete_survivors(spark, sf_dir):
    fact = sales_from_events(spark, sf_dir)
    rows = spikes.labelled(fact, SPIKES).withColumn("ScrapDate", F.col("spike_date"))
    return spikes.survivors(fact, rows, ["Channel", "L3Title", "ScrapDate", "ItemId"], F.col("DailySalesValue") > 0).select("ItemId", "Channel", "ScrapDate")


def range_survivors(spark, sf_dir):
    fact = sales_from_events(spark, sf_dir)
    applies = (F.col("Channel") == RANGE.channel) & F.col("ScrapDate").between(F.lit(RANGE.target_from), F.lit(RANGE.target_to)) & (F.col("DailySalesValue") > 0)
    return spikes.survivors(fact, spikes.range_flags(fact, RANGE), ["ItemId"], applies).select("ItemId", "Channel", "ScrapDate")


def first_seen_window(spark, sf_dir):
    return spikes.in_range(spikes.with_last_seen(coerced(sales_from_events(spark, sf_dir))), SPIKES).select("ItemId", "Channel", "ScrapDate", "first_seen_ever")


def asof_last_seen(spark, sf_dir):
    return spikes.with_last_seen(coerced(sales_from_events(spark, sf_dir))).select("ItemId", "Channel", "ScrapDate", "last_seen", F.col("last_count").cast("double").alias("last_count"))


def iqr_candidate_dates(spark, sf_dir):
    rows = spikes.in_range(coerced(sales_from_events(spark, sf_dir)), SPIKES)
    return spikes.iqr_dates(rows, SPIKES).withColumn("upper", F.round("upper", 2))


def _lineitem_fact(spark, sf_dir):
    """Parts as items, lines as sales."""
    line = _read(spark, sf_dir, "lineitem")
    return line.select(F.col("l_partkey").alias("ItemId"), F.to_date("l_shipdate").alias("ScrapDate"), F.col("l_quantity").alias("DailySalesCount"), F.col("l_extendedprice").alias("DailySalesValue"))


def item_history(spark, sf_dir):
    return spikes.item_history(_lineitem_fact(spark, sf_dir)).withColumnRenamed("ItemId", "l_partkey")


def topk_gmv(spark, sf_dir):
    return spikes.top_items(_lineitem_fact(spark, sf_dir)).withColumnRenamed("ItemId", "l_partkey")


def clean_text(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", text.clean_title(F.col("text")).alias("clean"))
    return d.select("doc_id", F.md5("clean").alias("clean_md5"), F.length("clean").alias("n"), F.size(text.tokens(F.col("clean"))).alias("n_tokens"))


def brand_skeletons(spark, sf_dir):
    p = _read(spark, sf_dir, "part").select("p_name", "p_brand").distinct()
    return p.select("p_name", "p_brand", text.title_case(F.concat_ws(" ", "p_name", F.lower("p_brand"))).alias("title"), text.skeleton(F.concat("p_name", "p_brand")).alias("skeleton"), text.normalized(F.concat_ws("  ", "p_brand", "p_name")).alias("normal"))


def ngram_vocab(spark, sf_dir):
    return brands.vocabulary(_listings(spark, sf_dir), BRANDS)


def rule_first_match(spark, sf_dir):
    part = _read(spark, sf_dir, "part")
    rules = part.select(F.element_at(F.split("p_name", " "), 1).alias("keyword")).distinct().select("keyword", F.concat(F.lit("Brand "), "keyword").alias("brand"), F.row_number().over(Window.orderBy("keyword")).alias("rule_rank"))
    rows = part.select("p_partkey", F.col("p_name").alias("ListingName"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise("No Brand").alias("Brand"))
    return brands.apply_rules(rows, rules)


def chunk_assignment(spark, sf_dir):
    part = _read(spark, sf_dir, "part")
    day = F.lit(SPIKES.period_from)
    rows = part.select(F.col("p_brand").alias("Channel"), F.lit("").alias("L3Title"), day.alias("spike_date"), day.alias("win_from"), day.alias("win_to"), F.col("p_partkey").alias("ItemId"), (-F.col("p_partkey")).alias("gmv_jt"))
    return deletes.chunks(rows, 20).select(F.explode("items").alias("p_partkey"), F.col("Channel").alias("p_brand"), "chunk")


def centroid_bucket(spark, sf_dir):
    v = _read(spark, sf_dir, "embeddings")
    out = brands.bucketed(v, v.where("label < 3"), v.where("label >= 3"), BRANDS)
    return out.select("vec_id", "delta", "bucket")


def delta_stats(spark, sf_dir):
    return centroid_bucket(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("n"), F.min("delta").alias("least"), F.max("delta").alias("most"), F.round(F.avg("delta"), 4).alias("mean"))


def _page_rows(spark, sf_dir):
    """Pages with markup of every kind that candidates come from."""
    p = _read(spark, sf_dir, "pages")
    k = lambda n: (F.col("page_id") % n).cast("string")
    markup = F.concat(
        F.lit("<p><b>Brand</b>: "), F.element_at(F.split("url", "[/.]"), 3), F.lit("</p><dl><dt>Merek</dt><dd></dd><dd>Sib "), k(5),
        F.lit('</dd></dl><script>{"brand":"Acme '), k(7), F.lit('"}</script><script type="x">{"BRAND_name" : "Bnd '), k(4), F.lit('", "item_brand": "Itm '), k(9),
        F.lit('", "brand": {"logo": "u", "name": "Str '), k(6), F.lit("\"}}</script><meta content='Met "), k(8), F.lit("' property=\"og:Brand\"><meta name=author content=nobody>"),
    )
    url = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("https://shopee.example/"), "page_id")).when(F.col("page_id") % 5 == 1, "").otherwise(F.concat("url", F.lit("?tiktok")))
    html = F.when(F.col("page_id") % 4 == 0, F.col("html")).otherwise(F.concat("html", markup))
    return p.select("page_id", url.alias("url"), html.alias("html"), F.concat(F.lit("Acme "), k(3), F.lit(" premium")).alias("ListingName"), F.lit("").alias("Brand"))


def page_score(spark, sf_dir):
    rows = _page_rows(spark, sf_dir)
    return pages.scored(pages.candidates(rows, with_title=True), rows).select("page_id", "value", "source", "confidence")


def page_pick(spark, sf_dir):
    rows = _page_rows(spark, sf_dir)
    return pages.picked(rows, pages.scored(pages.candidates(rows, with_title=True), rows))


def status_counts(spark, sf_dir):
    return page_pick(spark, sf_dir).groupBy("ResultStatus").agg(F.count("*").alias("n"))


def _matched(spark, sf_dir):
    part = _read(spark, sf_dir, "part")
    masters = part.select(text.title_case(F.translate("p_name", " ", "")).alias("Brand")).distinct()
    names = part.select(F.explode(F.array("p_name", F.concat(F.translate("p_name", " ", ""), F.lit("e")), F.upper("p_name"), F.concat_ws(" ", F.lower("p_type"), "p_name"))).alias("candidate")).distinct()
    return brands.matched(names, masters, BRANDS)


def llm_validate(spark, sf_dir):
    found = _matched(spark, sf_dir).where("status = 'New Brand Discovery'").select("candidate", F.when(F.col("score") >= 80, "accept").when(F.col("score") < 60, "reject").otherwise("ambiguous").alias("bucket"))
    return brands.validated(found, lambda names: {n for n in names if len(n) % 2})


def brand_exact(spark, sf_dir):
    part = _read(spark, sf_dir, "part")
    masters = part.select(text.title_case("p_name").alias("Brand")).distinct()
    names = part.select(F.explode(F.array(F.upper("p_name"), F.substring("p_name", 1, 4), F.concat(F.lit("q"), "p_type"))).alias("candidate")).distinct()
    found = brands.matched(names, masters, BRANDS)
    return found.where("status = 'Short Candidate (To LLM)' or lower(candidate) = lower(suggested)")


def judge_containment(spark, sf_dir):
    names = _read(spark, sf_dir, "part").select(F.explode(F.array("p_name", F.element_at(F.split("p_name", " "), 1), F.concat_ws(" ", "p_brand", "p_name"), "p_type")).alias("candidate")).distinct()
    n = F.length("candidate")
    found = names.withColumn("bucket", F.when(n % 5 == 0, "accept").when(n % 5 == 1, "reject").otherwise("ambiguous"))
    return brands.validated(found, lambda batch: {x for x in batch if len(x) % 5 == 3})


def judge_batches(spark, sf_dir):
    names = _read(spark, sf_dir, "part").groupBy("p_brand").agg(F.sort_array(F.collect_set("p_type")).alias("names"))
    return names.select("p_brand", text.json_list(F.col("names")).alias("batch"), text.sentence(F.col("p_brand")).alias("sentence"))


QUERIES = {
    "flag_stale_frozen": _flag("a"),
    "flag_new_uniform": _flag("b"),
    "flag_cumulative": _flag("c"),
    "flag_spike_jump": _flag("d"),
    "ghost_reappearance": ghost_reappearance,
    "brand_new_spike": _flag("g", EARLY),
    "iqr_candidate_dates": iqr_candidate_dates,
    "spike_labels": spike_labels,
    "spike_summary": lambda s, d: spikes.summary(_labelled(s, d)),
    "spike_totals": lambda s, d: spikes.totals(_labelled(s, d)),
    "min_gmv_filter": lambda s, d: spikes.above_min_gmv(_labelled(s, d), SPIKES).select("ItemId", "Channel", "spike_date", "gmv_jt"),
    "delete_statements": delete_statements,
    "delete_questions": delete_questions,
    "delete_decisions": delete_decisions,
    "report_detail": report_detail,
    "delete_survivors": delete_survivors,
    "sql_variant_preview": lambda s, d: spikes.range_preview(sales_from_events(s, d), RANGE),
    "sql_variant_survivors": range_survivors,
    "first_seen_window": first_seen_window,
    "asof_last_seen": asof_last_seen,
    "item_history": item_history,
    "topk_gmv": topk_gmv,
    "master_brands": lambda s, d: brands.master_brands(sales_from_events(s, d)),
    "unbranded_scan": lambda s, d: brands.unbranded(sales_from_events(s, d)),
    "unbranded_count": lambda s, d: brands.unbranded(sales_from_events(s, d)).agg(F.count("*").alias("n")),
    "clean_text": clean_text,
    "brand_skeletons": brand_skeletons,
    "ngram_simple": lambda s, d: brands.simple_ngrams(_listings(s, d), BRANDS),
    "ngram_vocab": ngram_vocab,
    "ngram_stats": lambda s, d: brands.ngram_stats(_listings(s, d), BRANDS),
    "rule_first_match": rule_first_match,
    "chunk_assignment": chunk_assignment,
    "centroid_bucket": centroid_bucket,
    "delta_stats": delta_stats,
    "page_score": page_score,
    "page_pick": page_pick,
    "status_counts": status_counts,
    "brand_match": _matched,
    "llm_validate": llm_validate,
    "brand_exact": brand_exact,
    "judge_containment": judge_containment,
    "judge_batches": judge_batches,
}

SALES = """sales AS (
  SELECT CAST(user_id AS VARCHAR) AS ItemId, CAST(ts AS DATE) AS ScrapDate, event_type AS Channel, 'L3_' || CAST(user_id % 3 AS VARCHAR) AS L3Title,
         CASE WHEN user_id % 4 = 0 THEN 'No Brand' ELSE 'brand ' || CAST(user_id % 7 AS VARCHAR) || 'x' END AS Brand,
         'Shop ' || CAST(user_id % 11 AS VARCHAR) AS ShopName, 'Item ' || CAST(user_id AS VARCHAR) AS ListingName, 'https://shopee.example/i/' || CAST(user_id AS VARCHAR) AS ListingLink,
         CAST(25000 AS DOUBLE) AS SalePrice, CAST(sum(floor(value)) AS DOUBLE) AS DailySalesCount, CAST(count(*) * 25000 AS DOUBLE) AS DailySalesValue
  FROM events GROUP BY user_id, CAST(ts AS DATE), event_type
), fact AS (
  SELECT *, date_diff('day', DATE '1970-01-01', ScrapDate) AS day_no,
         CAST(CAST(sum(DailySalesCount) OVER (PARTITION BY ItemId, Channel ORDER BY ScrapDate) AS BIGINT) AS VARCHAR) AS SalesCount
  FROM sales
)"""
FLAGS = f"""WITH {SALES}, prior AS (
  SELECT *, CAST(SalesCount AS DOUBLE) AS total, max(ScrapDate) OVER w AS last_seen, arg_max(TRY_CAST(SalesCount AS BIGINT), day_no) OVER w AS last_count
  FROM fact WINDOW w AS (PARTITION BY Channel, ItemId ORDER BY day_no RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), kept AS (
  SELECT *, min(ScrapDate) OVER (PARTITION BY ItemId, Channel) AS first_seen_ever FROM prior
  WHERE ScrapDate BETWEEN DATE '2024-01-16' - 7 AND DATE '2024-01-30' + 7 AND DailySalesValue > 0
), wide AS (
  SELECT a.ItemId, a.Channel, a.L3Title, a.ScrapDate, a.DailySalesCount AS n, a.DailySalesValue, a.total, a.last_seen, a.last_count, a.first_seen_ever, a.day_no,
         count(DISTINCT b.ScrapDate) AS days, count(DISTINCT b.DailySalesCount) AS kinds, max(b.DailySalesCount) AS most, min(b.DailySalesCount) AS least,
         avg(b.DailySalesCount) FILTER (WHERE b.day_no <> a.day_no AND b.DailySalesCount > 0) AS baseline,
         count(DISTINCT b.ScrapDate) FILTER (WHERE b.day_no <> a.day_no AND b.DailySalesCount > 0) AS base_days,
         count(*) FILTER (WHERE b.day_no < a.day_no) = 0 AS absent
  FROM kept a JOIN kept b ON a.ItemId = b.ItemId AND a.Channel = b.Channel AND a.L3Title = b.L3Title AND b.day_no BETWEEN a.day_no - 7 AND a.day_no + 7
  GROUP BY ALL
), flags AS (
  SELECT *, days >= 2 AND kinds <= 2 AND most > 10 AS a, first_seen_ever >= ScrapDate - 7 AND kinds <= 2 AND least > 10 AS b,
         n > 10 AND total > 0 AND n / total > 0.7 AS c, n > 10 AND base_days >= 2 AND baseline > 0 AND n > 3 * baseline AS d,
         absent AND last_seen IS NOT NULL AND date_diff('day', last_seen, ScrapDate) > 7 AND coalesce(abs(n - (total - last_count)) <= 2, true) AS f,
         absent AND last_seen IS NULL AND n > 5 AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.ItemId = wide.ItemId AND k.Channel = wide.Channel AND k.L3Title = wide.L3Title AND k.day_no > wide.day_no) AS g,
         date_diff('day', last_seen, ScrapDate) AS gap
  FROM wide
), period AS (SELECT * FROM flags WHERE ScrapDate BETWEEN DATE '2024-01-16' AND DATE '2024-01-30'
), group_days AS (SELECT Channel, L3Title, ScrapDate, sum(DailySalesValue) AS day_gmv FROM kept GROUP BY ALL
), stats AS (
  SELECT Channel, L3Title, count(*) FILTER (WHERE ScrapDate < DATE '2024-01-16') AS n_pre, count(*) FILTER (WHERE ScrapDate BETWEEN DATE '2024-01-16' AND DATE '2024-01-30') AS n_in,
         quantile_cont(day_gmv, 0.25) FILTER (WHERE ScrapDate < DATE '2024-01-16') AS p1, quantile_cont(day_gmv, 0.5) FILTER (WHERE ScrapDate < DATE '2024-01-16') AS p2, quantile_cont(day_gmv, 0.75) FILTER (WHERE ScrapDate < DATE '2024-01-16') AS p3,
         quantile_cont(day_gmv, 0.25) FILTER (WHERE ScrapDate BETWEEN DATE '2024-01-16' AND DATE '2024-01-30') AS i1, quantile_cont(day_gmv, 0.75) FILTER (WHERE ScrapDate BETWEEN DATE '2024-01-16' AND DATE '2024-01-30') AS i3
  FROM group_days GROUP BY ALL
), uppers AS (
  SELECT Channel, L3Title, CASE WHEN n_in < 3 THEN NULL WHEN n_pre >= 7 THEN CASE WHEN p3 = p1 THEN p2 * 1.1 ELSE p3 + (p3 - p1) END WHEN n_in >= 7 THEN i3 + (i3 - i1) END AS upper FROM stats
), iqr AS (
  SELECT g.Channel, g.L3Title, g.ScrapDate, g.day_gmv, u.upper FROM group_days g JOIN uppers u USING (Channel, L3Title)
  WHERE g.ScrapDate BETWEEN DATE '2024-01-16' AND DATE '2024-01-30' AND g.day_gmv > u.upper
), labelled AS (
  SELECT p.ItemId, p.Channel, p.L3Title, p.ScrapDate AS spike_date, p.ScrapDate - 7 AS win_from, p.ScrapDate + 7 AS win_to,
         CASE WHEN a AND i.upper IS NOT NULL THEN 'STALE_FROZEN_DAILY' WHEN b AND i.upper IS NOT NULL THEN 'NEW_ITEM_UNIFORM_COUNT' WHEN c THEN 'CUMULATIVE_SALESCOUNT' WHEN d THEN 'SPIKE_JUMP'
              WHEN f AND i.upper IS NOT NULL THEN 'GHOST_REAPPEARANCE' WHEN g AND i.upper IS NOT NULL THEN 'BRAND_NEW_SPIKE' END AS spike_flag,
         round(DailySalesValue / 1e6, 3) AS gmv_jt, CASE WHEN total > 0 THEN round(n / total, 4) END AS daily_to_total_ratio, CASE WHEN f AND i.upper IS NOT NULL THEN CAST(gap AS INTEGER) END AS gap_days
  FROM period p LEFT JOIN iqr i ON p.Channel = i.Channel AND p.L3Title = i.L3Title AND p.ScrapDate = i.ScrapDate
), marked AS (SELECT * FROM labelled WHERE spike_flag IS NOT NULL)
"""
RANGED = f"""WITH {SALES}, scope AS (SELECT *, TRY_CAST(SalesCount AS DOUBLE) AS total FROM fact WHERE Channel = 'click'
), ab AS (
  SELECT s.ItemId, CASE WHEN kinds <= 2 AND days >= 2 AND most > 10 THEN 'STALE_FROZEN_DAILY' WHEN first_seen >= DATE '2024-01-10' AND kinds <= 2 AND least > 10 THEN 'NEW_ITEM_UNIFORM_COUNT' END AS spike_flag
  FROM (SELECT ItemId, count(DISTINCT ScrapDate) AS days, count(DISTINCT DailySalesCount) AS kinds, min(DailySalesCount) AS least, max(DailySalesCount) AS most
        FROM scope WHERE ScrapDate BETWEEN DATE '2024-01-10' AND DATE '2024-01-24' AND DailySalesCount > 0 GROUP BY ItemId) s
  LEFT JOIN (SELECT ItemId, min(ScrapDate) AS first_seen FROM scope GROUP BY ItemId) h USING (ItemId)
), cf AS (SELECT DISTINCT ItemId FROM scope WHERE ScrapDate BETWEEN DATE '2024-01-17' AND DATE '2024-01-18' AND DailySalesCount > 10 AND total IS NOT NULL AND DailySalesCount / total > 0.7
), sj AS (
  SELECT DISTINCT t.ItemId FROM scope t JOIN (
    SELECT ItemId, avg(DailySalesCount) AS baseline FROM scope WHERE ScrapDate BETWEEN DATE '2024-01-10' AND DATE '2024-01-24' AND NOT ScrapDate BETWEEN DATE '2024-01-17' AND DATE '2024-01-18' AND DailySalesCount > 0
    GROUP BY ItemId HAVING count(DISTINCT ScrapDate) >= 2) b USING (ItemId)
  WHERE t.ScrapDate BETWEEN DATE '2024-01-17' AND DATE '2024-01-18' AND t.DailySalesCount > 10 AND baseline > 0 AND t.DailySalesCount > baseline * 5
), every AS (SELECT ItemId FROM ab WHERE spike_flag IS NOT NULL UNION ALL SELECT ItemId FROM cf UNION ALL SELECT ItemId FROM sj)
"""


def _quoted(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


CLEAN = r"trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"
TITLES = f"titles AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS gmv, list_filter(string_split({CLEAN}, ' '), lambda w: w <> '') AS w FROM documents)"
PAIRS = "list_concat({0}, list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
VOCAB = f"""v AS (SELECT ngram, count(*) AS df FROM (
  SELECT unnest(list_distinct({PAIRS.format('k')})) AS ngram FROM (SELECT list_filter(w, lambda x: regexp_full_match(x, '[a-z]{{3,}}') AND x NOT IN {_quoted(text.VOCABULARY_STOPWORDS)}) AS k FROM titles)
) GROUP BY ngram HAVING count(*) >= 2 AND count(*) <= 0.05 * (SELECT count(*) FROM documents))"""
#: The same for ``EARLY``.
EARLY_FLAGS = FLAGS.replace("2024-01-16", "2024-01-02").replace("2024-01-30", "2024-01-04").replace("- 7", "- 1").replace("+ 7", "+ 1")
_period = lambda letter: f"{FLAGS} SELECT ItemId, Channel, ScrapDate FROM period WHERE {letter}"

BUCKETS = """WITH x AS (SELECT vec_id, label, unnest(range(1, 65)) AS pos, unnest(embedding) AS x FROM embeddings), c AS (SELECT pos, avg(CAST(x AS DOUBLE)) FILTER (WHERE label < 3) AS yes, avg(CAST(x AS DOUBLE)) FILTER (WHERE label >= 3) AS no FROM x GROUP BY pos
  ), d AS (SELECT vec_id, round(sum(CAST(x AS DOUBLE) * yes) / (sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) * sqrt(sum(yes * yes))) - sum(CAST(x AS DOUBLE) * no) / (sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) * sqrt(sum(no * no))), 6) AS delta FROM x JOIN c USING (pos) GROUP BY vec_id)
  SELECT vec_id, delta, CASE WHEN delta >= 0.10 THEN 'accept' WHEN delta <= -0.08 THEN 'reject' ELSE 'ambiguous' END AS bucket FROM d"""
PAGES = r"""WITH p AS (
  SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'https://shopee.example/' || CAST(page_id AS VARCHAR) WHEN 1 THEN '' ELSE url || '?tiktok' END AS url,
         CASE WHEN page_id % 4 = 0 THEN NULL ELSE regexp_split_to_array(url, '[/.]')[3] END AS label, CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'Acme ' || CAST(page_id % 7 AS VARCHAR) END AS js,
         regexp_extract(html, '(?is)<title[^>]*>([^<]+)</title>', 1) AS title, 'acme ' || CAST(page_id % 3 AS VARCHAR) || ' premium' AS ln FROM pages
), c AS (
  SELECT page_id, label AS v, 'label_inline' AS source, 1 AS ord, 0.82 AS base FROM p WHERE label <> '' UNION ALL SELECT page_id, js, 'json_brand', 3, 0.88 FROM p WHERE js IS NOT NULL
  UNION ALL SELECT page_id, 'Sib ' || page_id % 5, 'label_sibling', 2, 0.78 FROM p WHERE js IS NOT NULL UNION ALL SELECT page_id, 'Bnd ' || page_id % 4, 'json_brand_name', 4, 0.86 FROM p WHERE js IS NOT NULL
  UNION ALL SELECT page_id, 'Itm ' || page_id % 9, 'json_item_brand', 5, 0.84 FROM p WHERE js IS NOT NULL UNION ALL SELECT page_id, 'Str ' || page_id % 6, 'structured_brand', 6, 0.90 FROM p WHERE js IS NOT NULL
  UNION ALL SELECT page_id, 'Met ' || page_id % 8, 'meta_brand', 7, 0.80 FROM p WHERE js IS NOT NULL
  UNION ALL SELECT page_id, title, 'title_hint', 8, 0.35 FROM p WHERE title <> ''
), n AS (
  SELECT c.page_id, source, ord, base, ln, trim(regexp_replace(v, '[\s\x{a0}]+', ' ', 'g')) AS value,
         trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(v, '[\s\x{a0}]+', ' ', 'g'))), '[^a-z0-9&\-.\s]', ' ', 'g'), '\s+', ' ', 'g')) AS norm FROM c JOIN p USING (page_id)
), m AS (
  SELECT *, list_filter(string_split(norm, ' '), lambda w: w <> '') AS ws, length(regexp_replace(value, '[^0-9]', '', 'g')) AS digits FROM n
), s AS (
  SELECT page_id, value, source, ord, CASE WHEN value = '' OR norm = '' THEN 0.0 ELSE round(greatest(0.0, least(0.99, CAST(base AS DOUBLE)
    + CASE WHEN length(value) BETWEEN 2 AND 25 THEN 0.08 WHEN length(value) <= 40 THEN 0.03 ELSE -0.18 END
    + CASE WHEN len(ws) BETWEEN 1 AND 3 THEN 0.08 WHEN len(ws) = 4 THEN 0.03 ELSE -0.12 END
    + CASE WHEN len(ws) = 0 OR len(list_filter(ws, lambda w: w IN GENERIC)) >= greatest(1, ceil(len(ws) * 0.6)) THEN -0.30 ELSE 0 END
    + CASE WHEN digits >= greatest(2, length(value) // 3) THEN -0.10 ELSE 0 END
    + CASE WHEN contains(ln, norm) THEN 0.05 ELSE 0 END + CASE WHEN norm IN GENERIC THEN -0.35 ELSE 0 END)), 4) END AS confidence FROM m
)
""".replace("GENERIC", _quoted(text.GENERIC_WORDS))
PICK = PAGES + """, best AS (SELECT page_id, arg_max(value, (confidence, -ord)) AS value, arg_max(source, (confidence, -ord)) AS source, max(confidence) AS confidence FROM s GROUP BY page_id
), r AS (SELECT p.page_id, b.value, b.source, b.confidence, url, CASE WHEN NOT (contains(lower(url), 'shopee') OR contains(lower(url), 'tiktok')) THEN 'invalid_url' WHEN b.value IS NULL THEN 'not_found' WHEN b.confidence < 0.6 THEN 'low_confidence' ELSE 'success' END AS ResultStatus FROM p LEFT JOIN best b USING (page_id))
"""

ORACLE = {
    "flag_stale_frozen": _period("a"),
    "flag_new_uniform": _period("b"),
    "flag_cumulative": _period("c"),
    "flag_spike_jump": _period("d"),
    "ghost_reappearance": f"{FLAGS} SELECT ItemId, Channel, ScrapDate, CAST(gap AS INTEGER) AS gap_days FROM period WHERE f",
    "brand_new_spike": f"{EARLY_FLAGS} SELECT ItemId, Channel, ScrapDate FROM flags WHERE g AND ScrapDate BETWEEN DATE '2024-01-02' AND DATE '2024-01-04'",
    "iqr_candidate_dates": f"{FLAGS} SELECT Channel, L3Title, ScrapDate, day_gmv, round(upper, 2) AS upper FROM iqr",
    "spike_labels": f"{FLAGS} SELECT * REPLACE (CAST(gap_days AS DOUBLE) AS gap_days) FROM marked",
    "spike_summary": f"{FLAGS} SELECT Channel, L3Title, spike_date, spike_flag, count(DISTINCT ItemId) AS item_count, round(sum(gmv_jt), 3) AS gmv_jt FROM marked GROUP BY ALL",
    "spike_totals": f"{FLAGS} SELECT count(DISTINCT ItemId) AS items, round(sum(gmv_jt), 3) AS gmv_jt, count(*) AS n_rows FROM marked",
    "min_gmv_filter": f"{FLAGS} SELECT ItemId, Channel, spike_date, gmv_jt FROM marked WHERE gmv_jt >= 0.05",
    "delete_statements": f"""{FLAGS}, r AS (SELECT *, row_number() OVER (PARTITION BY Channel, L3Title, spike_date ORDER BY gmv_jt DESC, ItemId) AS k FROM marked),
      c AS (SELECT Channel, L3Title, spike_date, win_from, win_to, CAST(ceil(k / 20) AS INTEGER) AS chunk, string_agg('''' || ItemId || '''', ', ' ORDER BY k) AS ids, count(*) AS n FROM r GROUP BY ALL),
      d AS (SELECT *, max(chunk) OVER (PARTITION BY Channel, L3Title, spike_date) AS n_chunks, CAST(spike_date AS VARCHAR) AS day FROM c)
      SELECT Channel, L3Title, spike_date, win_from, win_to, chunk,
        '-- [' || Channel || '] × [' || L3Title || '] | Spike: ' || day || ' | Window: ' || CAST(win_from AS VARCHAR) || '~' || CAST(win_to AS VARCHAR) || CASE WHEN n_chunks > 1 THEN ' (chunk ' || chunk || '/' || n_chunks || ')' ELSE '' END
        || chr(10) || '-- Items terdampak: ' || n || ' (sorted by GMV desc)' || chr(10) || 'ALTER TABLE sales' || chr(10) || 'DELETE WHERE' || chr(10) || '    Channel   = ''' || Channel || '''' || chr(10)
        || '    AND ScrapDate BETWEEN ''' || day || ''' AND ''' || day || '''' || chr(10) || '    AND DailySalesValue > 0' || chr(10) || '    AND L3Title = ''' || L3Title || '''' || chr(10) || '    AND ItemId IN (' || ids || ');' AS statement FROM d""",
    "delete_questions": f"""{FLAGS}, i AS (SELECT Channel, L3Title, spike_date, ItemId, sum(gmv_jt) AS g FROM marked GROUP BY ALL)
      SELECT CAST(row_number() OVER (ORDER BY Channel, L3Title, spike_date) AS INTEGER) AS ordinal, Channel, L3Title, spike_date, count(*) AS item_count, round(sum(g), 3) AS gmv_jt, string_agg(ItemId, ',' ORDER BY g DESC, ItemId) AS ids FROM i GROUP BY Channel, L3Title, spike_date""",
    "report_detail": f"""{FLAGS}, n AS (SELECT m.*, f.ShopName, f.ListingName, f.Brand, f.SalePrice, f.DailySalesCount FROM marked m JOIN fact f ON f.ItemId = m.ItemId AND f.Channel = m.Channel AND f.ScrapDate = m.spike_date)
      SELECT spike_date AS "Spike Date", Channel, L3Title, '' AS KeywordCategory, Brand, spike_flag AS Flag, ItemId, ShopName, ListingName, SalePrice, DailySalesCount, daily_to_total_ratio AS "Daily/Total Ratio", CAST(gap_days AS DOUBLE) AS "Gap Hari (F)", win_from AS "Window From", win_to AS "Window To" FROM n""",
    "delete_decisions": f"{FLAGS}, q AS (SELECT Channel, L3Title, spike_date, row_number() OVER (ORDER BY Channel, L3Title, spike_date) AS k FROM (SELECT DISTINCT Channel, L3Title, spike_date FROM marked)) SELECT ItemId, Channel, L3Title, spike_date FROM marked JOIN q USING (Channel, L3Title, spike_date) WHERE k < 15 AND k % 2 = 1",
    "delete_survivors": f"{FLAGS} SELECT ItemId, Channel, ScrapDate FROM fact x WHERE NOT (DailySalesValue > 0 AND EXISTS (SELECT 1 FROM marked m WHERE m.ItemId = x.ItemId AND m.Channel = x.Channel AND m.L3Title = x.L3Title AND m.spike_date = x.ScrapDate))",
    "sql_variant_preview": f"""{RANGED} SELECT e.ScrapDate, e.ItemId, e.L3Title, e.Channel, e.ShopName, e.ListingName, e.SalePrice, e.SalesCount, round(e.DailySalesCount, 0) AS daily_count, round(e.DailySalesValue / 1e6, 3) AS gmv_jt,
      round(e.DailySalesCount / nullif(e.total, 0), 4) AS daily_to_total_ratio, coalesce(ab.spike_flag, CASE WHEN cf.ItemId IS NOT NULL THEN 'CUMULATIVE_SALESCOUNT' WHEN sj.ItemId IS NOT NULL THEN 'SPIKE_JUMP' END) AS spike_flag
      FROM scope e JOIN every x ON e.ItemId = x.ItemId LEFT JOIN ab ON e.ItemId = ab.ItemId LEFT JOIN cf ON e.ItemId = cf.ItemId LEFT JOIN sj ON e.ItemId = sj.ItemId
      WHERE e.ScrapDate BETWEEN DATE '2024-01-17' AND DATE '2024-01-18' AND e.DailySalesValue > 0""",
    "sql_variant_survivors": f"{RANGED} SELECT ItemId, Channel, ScrapDate FROM fact WHERE NOT (Channel = 'click' AND ScrapDate BETWEEN DATE '2024-01-17' AND DATE '2024-01-18' AND DailySalesValue > 0 AND ItemId IN (SELECT ItemId FROM every))",
    "first_seen_window": f"{FLAGS} SELECT ItemId, Channel, ScrapDate, first_seen_ever FROM kept",
    "asof_last_seen": f"{FLAGS} SELECT ItemId, Channel, ScrapDate, last_seen, CAST(last_count AS DOUBLE) AS last_count FROM prior",
    "item_history": "SELECT l_partkey, CAST(min(l_shipdate) AS DATE) AS first_seen, count(DISTINCT CAST(l_shipdate AS DATE)) AS days, count(DISTINCT l_quantity) AS kinds, max(l_quantity) AS most, round(sum(l_extendedprice), 2) AS gmv FROM lineitem GROUP BY l_partkey",
    "topk_gmv": "SELECT l_partkey, round(sum(l_extendedprice), 2) AS gmv FROM lineitem GROUP BY l_partkey ORDER BY gmv DESC, l_partkey LIMIT 10",
    "master_brands": f"WITH {SALES} SELECT DISTINCT array_to_string(list_transform(regexp_extract_all(Brand, '[a-zA-Z]+|[^a-zA-Z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') AS Brand FROM fact WHERE Brand NOT IN ('No Brand', '')",
    "unbranded_scan": f"WITH {SALES} SELECT ItemId, ListingLink, ListingName, DailySalesValue FROM fact WHERE Brand = 'No Brand'",
    "unbranded_count": f"WITH {SALES} SELECT count(*) AS n FROM fact WHERE Brand = 'No Brand'",
    "clean_text": f"WITH c AS (SELECT doc_id, {CLEAN} AS clean FROM documents) SELECT doc_id, md5(clean) AS clean_md5, CAST(length(clean) AS INTEGER) AS n, CAST(len(list_filter(string_split(clean, ' '), lambda w: w <> '')) AS INTEGER) AS n_tokens FROM c",
    "brand_skeletons": r"""SELECT DISTINCT p_name, p_brand, array_to_string(list_transform(regexp_extract_all(p_name || ' ' || lower(p_brand), '[a-zA-Z]+|[^a-zA-Z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') AS title,
      regexp_replace(lower(p_name || p_brand), '[^a-z0-9]', '', 'g') AS skeleton, trim(regexp_replace(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9&\-.\s]', ' ', 'g'), '\s+', ' ', 'g')) AS normal FROM part""",
    "ngram_simple": f"""WITH {TITLES}, k AS (SELECT gmv, list_filter(w, lambda x: x NOT IN {_quoted(text.TITLE_STOPWORDS)} AND length(x) > 2 AND NOT regexp_full_match(x, '[0-9]+'))[1:4] AS k FROM titles)
      SELECT ngram, count(*) AS occurrences, round(sum(gmv), 2) AS total_gmv FROM (SELECT unnest({PAIRS.format('k')}) AS ngram, gmv FROM k) GROUP BY ngram HAVING count(*) >= 2""",
    "ngram_vocab": f"WITH {TITLES}, {VOCAB} SELECT ngram, df FROM v",
    "ngram_stats": f"""WITH {TITLES}, {VOCAB}, g AS (SELECT doc_id, gmv, unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS ngram FROM (SELECT doc_id, gmv, {PAIRS.format('w[1:4]')} AS x FROM titles))
      SELECT ngram, count(*) AS occurrences, round(sum(gmv), 2) AS total_gmv, array_to_string(list(CAST(doc_id AS VARCHAR) ORDER BY doc_id, pos)[1:3], ' || ') AS samples FROM g WHERE ngram IN (SELECT ngram FROM v) GROUP BY ngram""",
    "rule_first_match": """WITH r AS (SELECT k, 'Brand ' || k AS brand, row_number() OVER (ORDER BY k) AS rule_rank FROM (SELECT DISTINCT string_split(p_name, ' ')[1] AS k FROM part))
      SELECT p_partkey, p_name AS ListingName, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE coalesce((SELECT arg_min(brand, rule_rank) FROM r WHERE contains(lower(p_name), lower(k))), 'No Brand') END AS Brand FROM part""",
    "chunk_assignment": "SELECT p_partkey, p_brand, CAST(ceil(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) / 20) AS INTEGER) AS chunk FROM part",
    "centroid_bucket": BUCKETS,
    "delta_stats": f"SELECT bucket, count(*) AS n, min(delta) AS least, max(delta) AS most, round(avg(delta), 4) AS mean FROM ({BUCKETS}) GROUP BY bucket",
    "page_score": PAGES + "SELECT page_id, value, source, confidence FROM s WHERE value <> ''",
    "page_pick": PICK + "SELECT page_id, CASE WHEN ResultStatus = 'success' THEN value ELSE '' END AS BrandName, CASE WHEN ResultStatus IN ('success', 'low_confidence') THEN confidence ELSE 0 END AS BrandConfidence, CASE WHEN ResultStatus IN ('success', 'low_confidence') THEN source ELSE '' END AS BrandSource, ResultStatus, CASE WHEN url = '' THEN 'empty url' WHEN ResultStatus = 'invalid_url' THEN 'unsupported domain' WHEN ResultStatus = 'not_found' THEN 'no candidate' WHEN ResultStatus = 'low_confidence' THEN value ELSE '' END AS ResultNote FROM r",
    "brand_exact": """WITH m AS (SELECT lower(p_name) AS low, min(array_to_string(list_transform(regexp_extract_all(p_name, '[a-zA-Z]+|[^a-zA-Z]+'), lambda x: upper(x[1]) || lower(x[2:])), '')) AS master FROM part GROUP BY ALL),
      c AS (SELECT DISTINCT unnest([upper(p_name), p_name[1:4], 'q' || p_type]) AS candidate FROM part)
      SELECT candidate, CASE WHEN master IS NOT NULL THEN 'Existing Brand' ELSE 'Short Candidate (To LLM)' END AS status, coalesce(master, '') AS suggested, CASE WHEN master IS NOT NULL THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS score
      FROM c LEFT JOIN m ON lower(candidate) = low WHERE master IS NOT NULL OR length(regexp_replace(lower(candidate), '[^a-z0-9]', '', 'g')) < 5""",
    "judge_containment": """WITH c AS (SELECT DISTINCT unnest([p_name, string_split(p_name, ' ')[1], p_brand || ' ' || p_name, p_type]) AS candidate FROM part),
      n AS (SELECT candidate, length(candidate) % 5 AS k, regexp_replace(lower(candidate), '[^a-z0-9]', '', 'g') AS s FROM c), v AS (SELECT DISTINCT s AS v FROM n WHERE k = 3)
      SELECT candidate, CASE k WHEN 0 THEN 'accept' WHEN 1 THEN 'reject' ELSE 'ambiguous' END AS bucket,
        CASE WHEN k = 0 THEN 'LLM Verified Brand' WHEN k = 1 THEN 'Rejected by Embedding (Generic)' WHEN EXISTS (SELECT 1 FROM v WHERE contains(s, v) OR contains(v, s)) THEN 'LLM Verified Brand' ELSE 'Rejected by LLM (Generic/Region)' END AS status FROM n""",
    "judge_batches": """SELECT p_brand, CAST(to_json(list_sort(list(DISTINCT p_type))) AS VARCHAR) AS batch, 'produk dengan merek ' || p_brand AS sentence FROM part GROUP BY p_brand""",
    "status_counts": PICK + "SELECT ResultStatus, count(*) AS n FROM r GROUP BY ResultStatus",
}
