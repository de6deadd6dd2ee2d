"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Every document gets a place on the hash line of its source (48 bits of the MD5 of its id). Sizes are
summed by source and by 12-bit bucket of that line; the budget falls into one bucket, and only that
bucket is refined by the next 12 bits, four times. What lies below the threshold is taken once more
than the rest. Nothing is sorted, and no task ever holds more than 4,096 sums of a source.

Defined results: a null or empty text has size 0 and is taken 0 words; a null source is one source,
the last; a null id hashes as the empty text; rows that repeat an id stand or fall together; an empty
table gives an empty result; columns of the input keep their names and values whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brandtide.llm.common import table, with_small, word_count
from brandtide.runtime import scratch, staged

DIGITS, LEVELS = 3, 4


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _line(doc_id: Column) -> Column:
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, DIGITS * LEVELS)


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Target words by source.

    ``sizes`` has ``source`` and ``source_size``, a row for each source. Sources weigh ``weights`` in turn, by code
    point with null last. Targets share the sum of all sizes by weight and stop at ``most`` times their source's
    size; the excess goes to the others by weight until none is above. Filling in ascending order of ceiling a
    weight reaches that fixed point in one pass.
    """
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("top", F.col("source_size") * F.lit(most))
        .withColumn("ratio", F.col("top").cast("double") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("top").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weights_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    )
    level = F.col("left").cast("double") / F.col("weights_left")
    free = F.when(F.col("top") > F.col("weight") * level, level)
    return ranked.withColumn("level", F.first(free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).select(
        "source", "source_size", F.least(F.col("top").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.col("top").cast("double"))).alias("target")
    )


def plan(slim: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> tuple[DataFrame, int]:
    """Thresholds by source, a staged table, and its number of rows. ``slim`` has key, source, size, line."""
    per_source = staged(targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most).withColumn("key", _key(F.col("source"))), "mix-targets")
    n = per_source.count()
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long")
    state = per_source.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    found = state.where("rest > 0").select("key", "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("held"))
    for level in range(LEVELS):
        digits = F.substring("line", level * DIGITS + 1, DIGITS)
        rows = slim.select("key", "size", F.substring("line", 1, level * DIGITS).alias("prefix"), digits.alias("digits"))
        sums = with_small(rows, found.select("key", "prefix"), ["key", "prefix"], "left_semi", n).groupBy("key", "digits").agg(F.sum("size").alias("held"))
        below = F.coalesce(F.sum("held").over(Window.partitionBy("key").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        at = with_small(sums.withColumn("below", below), found.select("key", "rest", "prefix", "before"), "key", "inner", n).withColumn("start", F.col("before") + F.col("below"))
        hit = at.where((F.col("start") <= F.col("rest")) & (F.col("start") + F.col("held") > F.col("rest")))
        # A row for each source; written, so that each level reads the sizes once.
        found = staged(hit.select("key", "rest", F.concat("prefix", "digits").alias("prefix"), F.col("start").alias("before"), "held"), "mix-bucket")
    cut = found.select("key", F.col("prefix").alias("cut"), (F.col("before") + F.col("held") - F.col("rest") < F.col("rest") - F.col("before")).alias("inclusive"))
    return staged(state.join(cut, "key", "left").select("key", "source_size", "target", "whole", "cut", "inclusive"), "mix-thresholds"), n


def slim_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), _key(F.col(source_col).cast("string")).alias("key"), _line(F.col(id_col)).alias("line")
    )


def _copies() -> Column:
    return F.col("whole") + F.when((F.col("line") < F.col("cut")) | ((F.col("line") == F.col("cut")) & F.col("inclusive")), 1).otherwise(0)


def mixed(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken (see the module's text)."""
    with scratch(docs.sparkSession) as keep:
        slim = keep(staged(slim_of(docs), "mix-sizes"))
        thresholds, n = plan(slim)
        keep(thresholds)
    return with_small(slim, thresholds, "key", "left", n).select("doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    with scratch(docs.sparkSession) as keep:
        thresholds, n = plan(staged(slim_of(docs), "mix-sizes"))
        keep(thresholds)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _key(F.col("source").cast("string")).alias("key"), _line(F.col("doc_id")).alias("line"), word_count(F.col("text")).alias("size"))
    taken = with_small(keyed, thresholds, "key", "left", n).withColumn("copies", F.when(F.col("size") > 0, _copies()).otherwise(0))
    return taken.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS line
  FROM documents
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS top FROM s
), r AS (
  SELECT *, CAST(top AS DOUBLE) / weight AS ratio, sum(source_size) OVER () AS total FROM w
), f AS (
  SELECT *, CAST(total - coalesce(sum(top) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lvl FROM r
), g AS (SELECT *, (SELECT arg_min(lvl, ratio) FROM f WHERE top > weight * lvl) AS level FROM f
), t AS (SELECT source, source_size, least(CAST(top AS DOUBLE), coalesce(weight * level, CAST(top AS DOUBLE))) AS target FROM g
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS whole FROM t
), o AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size AS rest,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.line) AS DOUBLE) AS after_,
         CAST(sum(d.size) OVER (PARTITION BY d.source, d.line) AS DOUBLE) AS held
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN rest > 0 AND (after_ <= rest OR (after_ - held <= rest AND after_ - rest < rest - (after_ - held))) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""
