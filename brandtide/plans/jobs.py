"""Whole jobs: what an analyst runs, with their files. Deletes are only written as text unless decisions are given."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import fields, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandtide.functions.text import GENERIC_WORDS, sentence
from brandtide.operators import brands, deletes, pages, spikes
from brandtide.params import BrandParams, SpikeParams
from brandtide.runtime import discard, staged
from brandtide.sources.sales import fact_filter, read_table



def logged(spark: SparkSession, out: str, step: str, rows: int) -> None:
    """Appends what was done to ``out``/log."""
    spark.range(1).select(F.current_timestamp().alias("at"), F.lit(step).alias("step"), F.lit(rows).cast("long").alias("rows")).coalesce(1).write.mode("append").json(f"{out}/log")


def spike_job(fact: DataFrame, p: SpikeParams, out: str, table: str, decisions: DataFrame | None = None, **only: str) -> DataFrame:
    """Writes summary, detail, the summary as text, questions, statements and a log under ``out``; with decisions also
    the surviving rows. Returns the rows that are reported, under their own names."""
    kept = staged(spikes.above_min_gmv(spikes.labelled(fact, p, fact_filter(**only)), p), "spikes")
    by_day = staged(spikes.summary(kept), "spike-summary")
    by_day.withColumnsRenamed(spikes.SUMMARY_NAMES).orderBy("Channel", "L3Title", "Spike Date").coalesce(1).write.mode("overwrite").csv(f"{out}/summary", header=True)
    spikes.exported(kept).orderBy("Channel", "L3Title", "Spike Date", F.desc("GMV (jt)")).write.mode("overwrite").csv(f"{out}/detail", header=True)
    spikes.summary_lines(by_day).orderBy("Channel", "L3Title", "line_no").select("line").coalesce(1).write.mode("overwrite").text(f"{out}/summary_text")
    deletes.asked(kept).orderBy("ordinal").write.mode("overwrite").json(f"{out}/questions")
    deletes.statements(kept, table).orderBy("Channel", "L3Title", "spike_date", "chunk").select("statement").write.mode("overwrite").text(f"{out}/delete_sql", lineSep=";\n\n")
    logged(fact.sparkSession, out, "report", kept.count())
    if decisions is not None:
        gone = staged(deletes.decided(kept, decisions).withColumn("ScrapDate", F.col("spike_date")), "spikes-deleted")
        spikes.survivors(fact, gone, ["Channel", "L3Title", "ScrapDate", "ItemId"], F.col("DailySalesValue") > 0).write.mode("overwrite").parquet(f"{out}/survivors")
        logged(fact.sparkSession, out, "delete", gone.count())
    return kept


Encoder = Callable[[DataFrame], DataFrame]


def embedded(names: DataFrame, masters: DataFrame, generic: DataFrame, encode: Encoder, p: BrandParams) -> DataFrame:
    """``names`` (candidate) with delta and bucket, by an encoder from (name, sentence) to (name, embedding)."""
    vectors = lambda df, c: staged(encode(df.select(F.col(c).alias("name"), sentence(F.col(c)).alias("sentence"))), "brand-vectors")
    found = brands.bucketed(vectors(names, "candidate"), vectors(masters, "Brand"), vectors(generic, "word"), p)
    return found.select(F.col("name").alias("candidate"), "delta", "bucket")


def brand_job(sales: DataFrame, listings: DataFrame, out: str, p: BrandParams = BrandParams(), judge: brands.Judge = brands.accept_all, encode: Encoder | None = None) -> DataFrame:
    """Candidates with their final status, written as CSV, largest GMV first.

    With an encoder, new names go to the judge only if they are as near to master brands as to generic words; without
    one all of them do. Short names always do.
    """
    found = staged(brands.discovered(sales, listings, p), "brand-candidates")
    short, new = (found.where(F.col("status") == s).select("candidate").distinct() for s in ("Short Candidate (To LLM)", "New Brand Discovery"))
    if encode is None:
        new = new.withColumn("bucket", F.lit("ambiguous"))
    else:
        words = found.sparkSession.createDataFrame([(w,) for w in GENERIC_WORDS], "word string")
        new = staged(embedded(new, brands.master_brands(sales), words, encode, p).select("candidate", "bucket"), "brand-buckets")
    pools = [brands.validated(short.withColumn("bucket", F.lit("ambiguous")), judge, True), brands.validated(new, judge, False)]
    final = pools[0].unionByName(pools[1]).select("candidate", F.col("status").alias("judged"))
    rows = staged(found.join(final, "candidate", "left").withColumn("status", F.coalesce("judged", "status")).drop("judged"), "brand-final")
    rows.orderBy(F.desc("total_gmv"), "candidate").write.mode("overwrite").csv(f"{out}/brands", header=True)
    logged(found.sparkSession, out, "brands", rows.count())
    return rows


def page_job(rows: DataFrame, out: str, stage_percent: int = 20, labels: str = pages.LABELS, fetch: Callable[[str], str] | None = None) -> DataFrame:
    """Extraction in stages: each is written under ``out``, and what an earlier run finished is not done again.

    ``rows``: page_id, url, html, ListingName, Brand; with ``fetch`` html is asked for and not read. Pages are dealt to
    stages by a hash of their id, into a folder each, so that a stage reads its own pages only.
    """
    spark, stages = rows.sparkSession, max(1, -(-100 // stage_percent))
    done = spark.createDataFrame([], "page_id long, ResultStatus string")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/pages")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        done = staged(spark.read.parquet(f"{out}/pages").select("page_id", "ResultStatus"), "pages-done")
    left = deletes.resume(rows, done, "page_id").withColumn("stage", F.pmod(F.xxhash64("page_id"), F.lit(stages)).cast("int"))
    left = staged(left, "pages-left", ("stage",))
    for k in range(stages):
        part = left.where(F.col("stage") == k)
        if fetch is not None:
            part = staged(pages.fetched(part, fetch).join(part.select("page_id", "ListingName", "Brand"), "page_id"), "pages-fetched")
        pages.picked(part, pages.scored(pages.candidates(part, labels), part)).write.mode("append").parquet(f"{out}/pages")
    discard(left)
    return spark.read.parquet(f"{out}/pages")


def parse(args: list[str] | None = None) -> tuple[argparse.Namespace, SpikeParams]:
    """Options of the spike job; every threshold has one of its own name."""
    own = argparse.ArgumentParser(prog="python -m brandtide.plans.jobs", description="Find, report and delete artefacts in daily sales.")
    own.add_argument("table", help="path of the fact table")
    own.add_argument("out", help="folder for the reports")
    own.add_argument("--name", default="sales", help="table name in the statements")
    for x in ("channel", "l3title", "brand", "keyword-category"):
        own.add_argument(f"--{x}", default="")
    for f in fields(SpikeParams):
        kind = date.fromisoformat if isinstance(f.default, date) else type(f.default)
        flag = {"action": argparse.BooleanOptionalAction} if kind is bool else {"type": kind}
        own.add_argument(f"--{f.name.replace('_', '-')}", default=f.default, **flag)
    got = own.parse_args(args)
    return got, replace(SpikeParams(), **{f.name: getattr(got, f.name) for f in fields(SpikeParams)})


def main() -> None:
    got, p = parse()
    spark = SparkSession.builder.getOrCreate()
    detail = spike_job(read_table(spark, got.table), p, got.out, got.name, channel=got.channel, l3title=got.l3title, brand=got.brand, keyword_category=got.keyword_category)
    spikes.total_line(detail).show(truncate=False)


if __name__ == "__main__":
    main()
