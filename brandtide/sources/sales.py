"""Sources: daily sales facts and listings, with tolerant schemas and coercions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the fact table.
FACT = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("ItemId",)]
    + [T.StructField("ScrapDate", T.DateType())]
    + [T.StructField(c, T.StringType()) for c in ("Channel", "L3Title", "Brand", "KeywordCategory", "ShopName", "ListingName", "ListingLink")]
    + [T.StructField("SalePrice", T.DoubleType()), T.StructField("SalesCount", T.StringType()), T.StructField("DailySalesCount", T.DoubleType()), T.StructField("DailySalesValue", T.DoubleType())]
)


def ensure_column(df: DataFrame, name: str, default: Column) -> DataFrame:
    """``df`` with the column, added if its schema lacks it."""
    return df if name in df.columns else df.withColumn(name, default)


def existing(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select([c for c in names if c in df.columns])


def numeric(c: str) -> Column:
    """What is no number is 0."""
    return F.coalesce(F.expr(f"try_cast(`{c}` AS DOUBLE)"), F.lit(0.0))


def coerced(df: DataFrame) -> DataFrame:
    """Fact columns in their types; the running total stays null where it is no number."""
    df = ensure_column(df, "KeywordCategory", F.lit(""))
    return df.withColumns({"ScrapDate": F.to_date("ScrapDate"), **{c: numeric(c) for c in ("SalePrice", "DailySalesCount", "DailySalesValue")}, "TotalCount": F.expr("try_cast(SalesCount AS DOUBLE)"), "TotalInt": F.expr("try_cast(SalesCount AS BIGINT)")})


def fact_filter(channel: str = "", l3title: str = "", brand: str = "", keyword_category: str = "") -> Column:
    """Equality on whichever of these is given, as columns and not as text."""
    wanted = {"Channel": channel, "L3Title": l3title, "Brand": brand, "KeywordCategory": keyword_category}
    return reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in wanted.items() if v], F.lit(True))


def read_table(spark: SparkSession, path: str, kind: str = "parquet", schema: T.StructType | None = None, **options) -> DataFrame:
    """Parquet, CSV, JSON or ORC files, or a JDBC table (path is its name; url and the rest are options)."""
    reader = spark.read.format(kind).options(**options)
    if kind == "jdbc":
        return reader.option("dbtable", path).load()
    if kind == "csv":
        reader = reader.option("header", True)
    return (reader.schema(schema) if schema else reader).load(path)


def sales_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily facts from the events table: items are users, channels are event types."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "user_id", "event_type", "value")
    daily = e.groupBy(F.col("user_id"), F.col("event_type").alias("Channel"), F.to_date("ts").alias("ScrapDate")).agg(F.sum(F.floor("value")).cast("double").alias("DailySalesCount"), (F.count("*") * 25000.0).alias("DailySalesValue"))
    from pyspark.sql import Window

    running = F.sum("DailySalesCount").over(Window.partitionBy("user_id", "Channel").orderBy("ScrapDate").rowsBetween(Window.unboundedPreceding, 0))
    item = F.col("user_id").cast("string")
    return daily.select(
        item.alias("ItemId"), "ScrapDate", "Channel", F.concat(F.lit("L3_"), (F.col("user_id") % 3).cast("string")).alias("L3Title"),
        F.when(F.col("user_id") % 4 == 0, "No Brand").otherwise(F.concat(F.lit("brand "), (F.col("user_id") % 7).cast("string"), F.lit("x"))).alias("Brand"),
        F.concat(F.lit("Shop "), (F.col("user_id") % 11).cast("string")).alias("ShopName"), F.concat(F.lit("Item "), item).alias("ListingName"), F.concat(F.lit("https://shopee.example/i/"), item).alias("ListingLink"),
        F.lit(25000.0).alias("SalePrice"), running.cast("bigint").cast("string").alias("SalesCount"), "DailySalesCount", "DailySalesValue",
    )


def listings_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select(F.col("doc_id").cast("string").alias("ItemId"), F.col("text").alias("ListingName"), F.col("n_chars").cast("double").alias("DailySalesValue"), F.col("doc_id").alias("ord"))
