import glob
from datetime import date, timedelta

from pyspark.sql import functions as F

from brandtide.operators import brands
from brandtide.params import BrandParams, SpikeParams
from brandtide.plans import jobs
from brandtide.streaming import live
from test_spikes import D0, facts, row


def test_spike_job(spark, tmp_path):
    rows = facts(spark, [row("a", D0, 850, 1000), row("b", D0, 5, 1000), row("c", D0, 900, 1000, channel="Lazada")])
    answers = spark.createDataFrame([("Shopee", "Soap", D0, 1, "y")], "Channel string, L3Title string, spike_date date, ordinal int, answer string")
    detail = jobs.spike_job(rows, SpikeParams(), str(tmp_path), "default.t", answers, channel="Shopee")
    assert [r["ItemId"] for r in detail.collect()] == ["a"]
    text = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/delete_sql/part-*"))
    assert "ItemId IN ('a')" in text and "Lazada" not in text
    assert {r["ItemId"] for r in spark.read.parquet(f"{tmp_path}/survivors").collect()} == {"b", "c"}
    summary = spark.read.csv(f"{tmp_path}/summary", header=True).first()
    assert summary["Jumlah Item"] == "1" and summary["Flag"] == "CUMULATIVE_SALESCOUNT"
    assert {"Spike Date", "GMV (jt)", "Window From"} <= set(spark.read.csv(f"{tmp_path}/detail", header=True).columns)
    lines = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/summary_text/part-*")).splitlines()
    assert lines[0] == "Shopee  ›  Soap" and lines[1].split() == ["Date", "Flag", "Items", "GMV", "(jt)"] and "CUMULATIVE_SALESCOUNT" in lines[2]
    asked = spark.read.json(f"{tmp_path}/questions").first()
    assert (asked["ordinal"], asked["item_count"], asked["items"]) == (1, 1, ["a"])
    assert {(r["step"], r["rows"]) for r in spark.read.json(f"{tmp_path}/log").collect()} == {("report", 1), ("delete", 1)}


def test_filtered_job_sees_items_under_other_categories(spark, tmp_path):
    p = SpikeParams(period_from=D0 - timedelta(9), period_to=D0, min_gmv=0.0)
    rows = [row("back", D0 - timedelta(p.radius + 80), 5, 1000, l3="Oil"), row("back", D0, 300, 1300)]
    rows += [row("other", D0 - timedelta(k), 5, 100000) for k in range(1, 30)]
    detail = jobs.spike_job(facts(spark, rows), p, str(tmp_path), "default.t", l3title="Soap").collect()
    assert [(r["ItemId"], r["spike_flag"], r["gap_days"], r["L3Title"]) for r in detail] == [("back", "GHOST_REAPPEARANCE", p.radius + 80, "Soap")]


def test_options():
    got, p = jobs.parse(["t", "o", "--jump-mult", "5", "--no-enable-ghost", "--include-stale", "--period-from", "2026-01-02", "--channel", "x"])
    assert (p.jump_mult, p.enable_ghost, p.include_stale, p.period_from, got.channel, p.radius) == (5, False, True, date(2026, 1, 2), "x", 120)


def test_brand_job(spark, tmp_path):
    names = ["acme tool one", "acme tool two", "skintifik cream", "skintifik soap", "zz top", "zz low"]
    listings = spark.createDataFrame([(str(k), n, 10.0 * k, k) for k, n in enumerate(names)], "ItemId string, ListingName string, DailySalesValue double, ord int")
    sales = spark.createDataFrame([("Skintific",), ("No Brand",), ("",)], "Brand string")
    rows = {r["candidate"]: (r["status"], r["suggested"]) for r in jobs.brand_job(sales, listings, str(tmp_path), BrandParams(max_df=1.0), lambda names: {n for n in names if n.startswith("Acme")}).collect()}
    assert rows["Skintifik"] == ("Auto-Matched (Synonym)", "Skintific") and rows["Acme Tool"] == ("LLM Verified Brand", "") and rows["Tool"][0] == "Rejected (Too Short / Generic)"
    rules = brands.rules_of(spark.createDataFrame([("Skintifik", "Skintific", "Auto-Matched (Synonym)", 5.0), ("New", "", "New Brand Discovery", 9.0)], "candidate string, suggested string, status string, total_gmv double"))
    assert [tuple(r) for r in rules.collect()] == [("skintifik", "Skintific", 1)]


def test_page_job_resumes(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"https://shopee.x/{k}", f"<p>Brand: Acme{k}</p>", "", "") for k in range(9)], "page_id long, url string, html string, ListingName string, Brand string")
    assert jobs.page_job(rows.where("page_id < 5"), str(tmp_path)).count() == 5
    done = jobs.page_job(rows, str(tmp_path))
    assert done.count() == 9 and done.where("ResultStatus = 'success'").count() == 9


def test_judges():
    def missing(names):
        raise LookupError("model not exist")

    def broken(names):
        raise ValueError("other")

    ask = brands.with_fallback([missing, brands.accept_all], lambda e: isinstance(e, LookupError))
    assert ask(["a"]) == {"a"} and brands.with_fallback([broken, brands.accept_all], lambda e: isinstance(e, LookupError))(["a"]) == set()
    assert brands.model_names(" fast, x ,fast", {"fast": "m-1"}) == ["m-1", "x"]


def test_without_keywords(spark):
    rows = spark.createDataFrame([("Glue Pro",), ("Lash",), (None,)], "ListingName string")
    assert [r[0] for r in brands.without_keywords(rows, ["glue", "glue"]).collect()] == ["Lash", None]


def test_streams(spark, tmp_path):
    rows = facts(spark, [row("a", D0, 850, 1000), row("b", D0, 5, 1000)])
    rows.write.parquet(str(tmp_path / "in"))
    stream = live.cumulative_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), SpikeParams())
    q = stream.writeStream.format("memory").queryName("cumulative_rows").start()
    q.processAllAvailable()
    q.stop()
    assert [r["ItemId"] for r in spark.sql("SELECT ItemId FROM cumulative_rows").collect()] == ["a"]
    events = spark.createDataFrame([(D0, "x", 2.0), (D0, "x", 3.0), (D0 + timedelta(3), "x", 1.0)], "d date, Channel string, value double").select(F.col("d").cast("timestamp").alias("ts"), "Channel", "value")
    events.write.parquet(str(tmp_path / "ev"))
    totals = live.daily_totals_stream(spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev")))
    q = totals.writeStream.format("memory").outputMode("complete").queryName("totals_rows").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["gmv"] for r in spark.sql("SELECT gmv FROM totals_rows").collect()) == [1.0, 5.0]


def test_total_line(spark):
    from brandtide.operators import spikes

    rows = spark.createDataFrame([("a", 1234.5), ("b", 1.0), ("a", 0.25)], "ItemId string, gmv_jt double")
    assert spikes.total_line(rows).first()["line"] == "TOTAL Flagged Items: 2  |  Total GMV Terdampak: 1,235.750 jt"
    assert spikes.total_line(rows.where("false")).first()["line"].startswith("TOTAL Flagged Items: 0")


def test_names_near_master_brands_skip_the_judge(spark, tmp_path):
    sales = spark.createDataFrame([("x", "No Brand"), ("y", "Maxpresso")], "ItemId string, Brand string")
    listings = spark.createDataFrame([(str(k), t, 5.0, k) for k, t in enumerate(["acmeron mild", "acmeron dark", "genericus mild", "genericus dark", "middlingo one", "middlingo two"])], "ItemId string, ListingName string, DailySalesValue double, ord int")

    def encode(names):  # brands to the right, generic words up
        x = F.when(F.col("name").rlike("(?i)acmeron|maxpresso"), 1.0).when(F.col("name").rlike("(?i)middlingo"), 0.7).otherwise(0.0)
        y = F.when(F.col("name").rlike("(?i)acmeron|maxpresso"), 0.0).when(F.col("name").rlike("(?i)middlingo"), 0.7).otherwise(1.0)
        assert names.where("sentence <> 'produk dengan merek ' || name").isEmpty()
        return names.select("name", F.array(x, y).alias("embedding"))

    got = {r["candidate"]: r["status"] for r in jobs.brand_job(sales, listings, str(tmp_path), BrandParams(max_df=1.0), lambda names: {n for n in names if "Middlingo" in n}, encode).collect()}
    assert got["Acmeron"] == "LLM Verified Brand" and got["Genericus"] == "Rejected by Embedding (Generic)" and got["Middlingo"] == "LLM Verified Brand"


def test_pages_that_fail_are_errors_after_three_tries(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)

    def fetch(url):
        asked.add(1)
        if "bad" in url:
            raise TimeoutError("45 s")
        return "<p>Brand: Acme</p>"

    rows = spark.createDataFrame([(1, "https://shopee.x/1", None, "", ""), (2, "https://shopee.x/bad", None, "", ""), (3, "", None, "", "")], "page_id long, url string, html string, ListingName string, Brand string")
    got = {r["page_id"]: (r["ResultStatus"], r["BrandName"], r["ResultNote"]) for r in jobs.page_job(rows, str(tmp_path), 100, fetch=fetch).collect()}
    assert got == {1: ("success", "Acme", ""), 2: ("error", "", "TimeoutError: 45 s"), 3: ("invalid_url", "", "empty url")}
    assert asked.value == 4
    again = jobs.page_job(rows, str(tmp_path), 100, fetch=lambda url: "<p>Merk: Bolt</p>").collect()
    assert sorted((r["page_id"], r["BrandName"]) for r in again if r["ResultStatus"] == "success") == [(1, "Acme"), (2, "Bolt")]
