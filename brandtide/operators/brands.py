"""Brand discovery: n-gram candidates, resolution to master brands, validation, and rules that write brands back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brandtide.functions.match import best_match_udf, metaphone_udf
from brandtide.functions.text import clean_title, cosine, ngrams, skeleton, substrings, title_case, title_tokens, tokens, vocabulary_tokens
from brandtide.params import BrandParams
from brandtide.runtime import staged

P = BrandParams()
#: Rows of a table of brands or rules that may be broadcast.
SMALL_ROWS = 100_000
#: Master brands in a list that candidates are compared with at once.
LIST_ROWS = 5000


def _small(df: DataFrame) -> DataFrame:
    """Broadcast if counted to be small; otherwise Spark chooses."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def unbranded(sales: DataFrame) -> DataFrame:
    return sales.where("Brand = 'No Brand'").select("ItemId", "ListingLink", "ListingName", "DailySalesValue")


def master_brands(sales: DataFrame) -> DataFrame:
    return sales.where("Brand is not null and Brand not in ('No Brand', '')").select(title_case(F.col("Brand")).alias("Brand")).distinct()


def simple_ngrams(listings: DataFrame, p: BrandParams = P) -> DataFrame:
    """ngram, occurrences, total_gmv from the first words left after filtering; largest GMV first when sorted by it."""
    lead = F.slice(title_tokens(clean_title(F.col("ListingName"))), 1, p.leading_words)
    rows = listings.select(F.explode(ngrams(lead)).alias("ngram"), F.coalesce("DailySalesValue", F.lit(0.0)).alias("gmv"))
    return rows.groupBy("ngram").agg(F.count("*").alias("occurrences"), F.round(F.sum("gmv"), 2).alias("total_gmv")).where(F.col("occurrences") >= p.min_occurrences)


def vocabulary(listings: DataFrame, p: BrandParams = P) -> DataFrame:
    """ngram and the number of titles that have it, for n-grams neither too rare nor too frequent."""
    return _vocabulary(listings.select(clean_title(F.col("ListingName")).alias("clean")), listings.count(), p)


def _vocabulary(titles: DataFrame, n: int, p: BrandParams) -> DataFrame:
    grams = titles.select(F.explode(F.array_distinct(ngrams(vocabulary_tokens(F.col("clean"))))).alias("ngram"))
    return grams.groupBy("ngram").agg(F.count("*").alias("df")).where((F.col("df") >= p.min_df) & (F.col("df") <= p.max_df * n))


def ngram_stats(listings: DataFrame, p: BrandParams = P) -> DataFrame:
    """ngram, occurrences, total_gmv, samples (of three rows) over the first raw words, for n-grams of the vocabulary.

    ``listings`` has ``ord``, which says what comes first. Repeats within a title count each time.
    """
    titles = staged(listings.select("ord", "ItemId", F.coalesce("DailySalesValue", F.lit(0.0)).alias("gmv"), clean_title(F.col("ListingName")).alias("clean")), "ngram-titles")
    lead = F.slice(tokens(F.substring_index("clean", " ", p.leading_words)), 1, p.leading_words)
    rows = titles.select("ord", "ItemId", "gmv", F.posexplode(ngrams(lead)).alias("pos", "ngram"))
    rows = staged(rows.join(_vocabulary(titles, titles.count(), p).select("ngram"), "ngram", "left_semi"), "ngram-rows")
    # A limited rank: each task keeps three rows of an n-gram before they are shuffled, however frequent it is.
    rank = F.row_number().over(Window.partitionBy("ngram").orderBy("ord", "pos", "ItemId"))
    first = rows.withColumn("rank", rank).where("rank <= 3").groupBy("ngram").agg(F.array_sort(F.collect_list(F.struct("rank", "ItemId"))).alias("s"))
    sums = rows.groupBy("ngram").agg(F.count("*").alias("occurrences"), F.round(F.sum("gmv"), 2).alias("total_gmv"))
    return sums.join(first, "ngram").select("ngram", "occurrences", "total_gmv", F.array_join("s.ItemId", " || ").alias("samples"))


def matched(candidates: DataFrame, masters: DataFrame, p: BrandParams = P) -> DataFrame:
    """``candidates`` (candidate) with status, suggested, score: equal, short, alike in sound, alike in letters, or new.

    The score of a new brand is its best over all masters. Candidates meet the masters in lists of ``LIST_ROWS``, not
    one by one, and within a list lengths that cannot be better are passed over. Of several masters that sound alike
    the first by name counts.
    """
    masters = staged(masters.select(F.col("Brand").alias("master"), F.lower("Brand").alias("low"), skeleton(F.col("Brand")).alias("m_skeleton")).distinct().withColumn("m_sound", metaphone_udf("m_skeleton")), "brand-masters")
    few = masters.count()
    c = candidates.select("candidate").distinct().withColumn("low", F.lower("candidate")).withColumn("skeleton", skeleton(F.col("candidate")))
    c = staged(c.join(_small(masters.groupBy("low").agg(F.min("master").alias("exact"))), "low", "left"), "brand-names")
    exact = c.where("exact is not null").select("candidate", F.col("exact").alias("suggested"))
    rest = c.where("exact is null")
    long_ = staged(rest.where(F.length("skeleton") >= p.min_skeleton).withColumn("sound", metaphone_udf("skeleton")).select("candidate", "skeleton", "sound"), "brand-sounds")
    ratio = F.length("skeleton") / F.greatest(F.length("m_skeleton"), F.lit(1))
    sound = long_.join(_small(masters), F.col("sound") == F.col("m_sound")).where((F.length("sound") >= p.min_phonetic) & ratio.between(p.min_length_ratio, p.max_length_ratio)).groupBy("candidate").agg(F.min("master").alias("suggested"))
    left = long_.join(sound.select("candidate"), "candidate", "left_anti")
    lists = masters.select("master", "m_skeleton", F.pmod(F.xxhash64("master"), F.lit(-(-few // LIST_ROWS) or 1)).alias("list"))
    lists = lists.groupBy("list").agg(F.array_sort(F.collect_list(F.struct("master", "m_skeleton"))).alias("x")).select(F.col("x.master").alias("names"), F.col("x.m_skeleton").alias("skeletons"))
    best = left.join(lists).withColumn("b", best_match_udf("skeleton", "names", "skeletons"))  # each list is a stated block of the masters
    fuzzy = best.groupBy("candidate").agg(F.max("b.score").alias("score"), F.min_by("b.name", F.struct(-F.col("b.score"), F.col("b.name"))).alias("suggested"))
    fuzzy = left.select("candidate").join(fuzzy, "candidate", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    known = F.col("score") >= p.min_fuzz
    # The statuses.
    row = lambda df, status, suggested, score: df.select("candidate", status.alias("status"), suggested.alias("suggested"), score.alias("score"))
    return reduce(
        DataFrame.unionByName,
        [
            row(exact, F.lit("Existing Brand"), F.col("suggested"), F.lit(100.0)),
            row(rest.where(F.length("skeleton") < p.min_skeleton), F.lit("Short Candidate (To LLM)"), F.lit(""), F.lit(0.0)),
            row(sound, F.lit("Auto-Matched (Synonym)"), F.col("suggested"), F.lit(99.0)),
            row(fuzzy, F.when(F.col("score") == 100, "Existing Brand").when(known, "Auto-Matched (Synonym)").otherwise("New Brand Discovery"), F.when(known, F.col("suggested")).otherwise(""), F.round("score", 2)),
        ],
    )


def centroid(vectors: DataFrame) -> DataFrame:
    """One row: the mean of ``embedding`` by position."""
    means = vectors.select(F.posexplode("embedding").alias("pos", "x")).groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))  # a row for each dimension


def bucketed(vectors: DataFrame, brands: DataFrame, generic: DataFrame, p: BrandParams = P) -> DataFrame:
    """``vectors`` with delta (likeness to the brands' centroid less that to the generic one) and bucket."""
    both = vectors.crossJoin(F.broadcast(centroid(brands).withColumnRenamed("centroid", "yes"))).crossJoin(F.broadcast(centroid(generic).withColumnRenamed("centroid", "no")))  # a row each
    delta = F.round(cosine(F.col("embedding"), F.col("yes")) - cosine(F.col("embedding"), F.col("no")), 6)
    return both.withColumn("delta", delta).withColumn("bucket", F.when(F.col("delta") >= p.accept_delta, "accept").when(F.col("delta") <= p.reject_delta, "reject").otherwise("ambiguous")).drop("yes", "no")


Judge = Callable[[list[str]], set[str]]


def accept_all(names: list[str]) -> set[str]:
    """The judge without a model: every name is a brand."""
    return set(names)


def with_fallback(judges: list[Judge], is_missing: Callable[[Exception], bool]) -> Judge:
    """The first judge whose model exists; any other failure rejects the batch."""

    def ask(names: list[str]) -> set[str]:
        for judge in judges:
            try:
                return judge(names)
            except Exception as failure:  # noqa: BLE001 - whatever a remote model raises
                if not is_missing(failure):
                    return set()
        return set()

    return ask


def model_names(text: str, aliases: dict[str, str]) -> list[str]:
    """Names from a comma-separated list, aliases resolved, each once, in order."""
    names = [x.strip() for x in text.split(",")]
    return list(dict.fromkeys(aliases.get(x.lower(), x) for x in names if x))


def without_keywords(rows: DataFrame, keywords: list[str], name: str = "ListingName") -> DataFrame:
    """Rows whose title holds none of the keywords; a null title holds none."""
    title = F.lower(F.coalesce(F.col(name), F.lit("")))
    return rows.where(~reduce(lambda a, b: a | b, [F.contains(title, F.lit(k.lower())) for k in dict.fromkeys(keywords)], F.lit(False)))


def validated(bucketed_: DataFrame, judge: Judge = accept_all, strict: bool = False, batch: int = 500) -> DataFrame:
    """``bucketed_`` (candidate, bucket) with the final status; the judge sees ambiguous names in batches, on executors."""
    # The statuses here and below.
    short = "Rejected (Too Short / Generic)"

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = frame["candidate"].tolist()
            for i in range(0, len(names), batch):
                yield pd.DataFrame({"verified": sorted(judge(names[i : i + batch]))}, dtype="object")

    ambiguous = bucketed_.where("bucket = 'ambiguous'").select("candidate")
    # Written, so that the judge is asked once.
    verified = staged(ambiguous.mapInPandas(ask, "verified string").select(skeleton(F.col("verified")).alias("v")).distinct(), "brand-verified")
    own = staged(ambiguous.select("candidate", skeleton(F.col("candidate")).alias("own")), "brand-ambiguous")
    equal = own.join(verified, own["own"] == verified["v"], "left_semi")
    rest = own.join(equal.select("candidate"), "candidate", "left_anti")
    # One holds the other: equality with one of its substrings.
    parts = rest.select("candidate", F.explode(substrings(F.col("own"))).alias("v")).join(verified, "v", "left_semi").select("candidate")
    whole = rest.join(verified.select(F.explode(substrings(F.col("v"))).alias("own")).distinct(), "own", "left_semi").select("candidate")
    inside = parts.unionByName(whole)
    passed = equal.select("candidate").unionByName(inside).distinct().withColumn("passed", F.lit(True))
    status = (
        F.when(F.col("bucket") == "accept", "LLM Verified Brand").when(F.col("bucket") == "reject", short if strict else "Rejected by Embedding (Generic)")
        .when(F.col("passed"), "LLM Verified Brand").otherwise(short if strict else "Rejected by LLM (Generic/Region)")
    )
    return bucketed_.join(passed, "candidate", "left").withColumn("status", status).drop("passed")


def rules_of(found: DataFrame) -> DataFrame:
    """keyword, brand, rule_rank from resolved candidates (candidate, suggested, status, total_gmv): largest GMV first."""
    kept = found.where("status in ('Existing Brand', 'Auto-Matched (Synonym)') and suggested <> ''")
    return kept.select(F.lower("candidate").alias("keyword"), F.col("suggested").alias("brand"), F.row_number().over(Window.orderBy(F.desc("total_gmv"), "candidate")).alias("rule_rank"))  # rules are few


def apply_rules(rows: DataFrame, rules: DataFrame, name: str = "ListingName") -> DataFrame:
    """``rows`` with Brand replaced, where it is 'No Brand', by the first rule whose keyword occurs in the raw title.

    Up to 100 rules become one chain of conditions and no join; more are joined, each distinct title once.
    """
    few = rules.orderBy("rule_rank").limit(P.rules_per_batch + 1).collect()
    if len(few) <= P.rules_per_batch:
        chain = reduce(lambda c, r: c.when(F.contains(F.lower(name), F.lit(r["keyword"].lower())), r["brand"]), few, F.when(F.lit(False), ""))
        brand = chain.otherwise(F.col("Brand")) if few else F.col("Brand")
        return rows.withColumn("Brand", F.when(F.col("Brand") == "No Brand", brand).otherwise(F.col("Brand")))
    titles = rows.where("Brand = 'No Brand'").select(F.col(name).alias("__title")).distinct()
    hits = titles.join(_small(rules), F.contains(F.lower("__title"), F.lower("keyword"))).groupBy("__title").agg(F.min_by("brand", "rule_rank").alias("__brand"))
    return rows.join(hits, F.col(name) == F.col("__title"), "left").withColumn("Brand", F.when(F.col("Brand") == "No Brand", F.coalesce("__brand", "Brand")).otherwise(F.col("Brand"))).drop("__title", "__brand")


def discovered(sales: DataFrame, listings: DataFrame, p: BrandParams = P) -> DataFrame:
    """End to end up to validation: n-grams of unbranded titles, each resolved to a master brand."""
    stats = ngram_stats(listings, p).where(F.col("occurrences") >= p.min_occurrences)
    found = matched(stats.select(F.col("ngram").alias("candidate")), master_brands(sales), p)
    return stats.withColumnRenamed("ngram", "candidate").join(found, "candidate").withColumn("candidate", title_case(F.col("candidate")))
