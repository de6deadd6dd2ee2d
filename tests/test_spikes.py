"""Rules of the detectors on hand-made facts, boundaries included, and against a plain loop."""

import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from brandtide.operators import deletes, spikes
from brandtide.params import RangeParams, SpikeParams
from brandtide.sources.sales import FACT, coerced, ensure_column, fact_filter, read_table

D0 = date(2026, 4, 10)
P = SpikeParams(period_from=date(2026, 4, 1), period_to=date(2026, 4, 30), radius=120, include_stale=True)


def row(item, day, count, total=None, value=None, channel="Shopee", l3="Soap"):
    return (item, day, channel, l3, "No Brand", "", "Shop", f"Item {item}", "", 1000.0, None if total is None else str(total), float(count) if count is not None else None, 1e6 * (count or 1) if value is None else value)


def facts(spark, rows):
    return spark.createDataFrame(rows, FACT)


def flags(spark, rows, p=P, day=D0):
    found = spikes.with_flags(facts(spark, rows), p).where(F.col("ScrapDate") == F.lit(day)).collect()
    return {(r["ItemId"], k) for r in found for k in "abcdfg" if r[f"flag_{k}"]}, {r["ItemId"]: r["gap_days"] for r in found}


def test_cumulative_is_strict_and_skips_zero_and_bad_totals(spark):
    got, _ = flags(spark, [row("hit", D0, 850, 1000), row("edge", D0, 700, 1000), row("few", D0, 10, 11), row("zero", D0, 50, 0), row("null", D0, 50, "null"), row("none", D0, 50)])
    assert {i for i, k in got if k == "c"} == {"hit"}


def test_jump_needs_two_days_and_three_times_the_mean(spark):
    rows = [row("hit", D0 - timedelta(d), 50) for d in (1, 2)] + [row("hit", D0, 600)]
    rows += [row("edge", D0 - timedelta(d), 50) for d in (1, 2)] + [row("edge", D0, 150)]
    rows += [row("short", D0 - timedelta(1), 50), row("short", D0, 600)]
    got, _ = flags(spark, rows)
    assert {i for i, k in got if k == "d"} == {"hit"}


def test_stale_and_uniform(spark):
    rows = [row("flat", D0 + timedelta(d), 500) for d in range(10)] + [row("once", D0, 300)] + [row("ten", D0 + timedelta(d), 10) for d in range(3)]
    got, _ = flags(spark, rows)
    assert ("flat", "a") in got and ("once", "a") not in got and ("once", "b") in got and not {("ten", "a"), ("ten", "b")} & got


def test_ghost_and_brand_new(spark):
    day = date(2026, 4, 21)
    p = SpikeParams(period_from=date(2026, 4, 1), period_to=date(2026, 4, 30), radius=20)
    rows = [row("ghost", date(2025, 11, 30), 1, 981), row("ghost", day, 44, 1025), row("near", day - timedelta(30), 1, 5), row("near", day, 3, 8), row("far", day - timedelta(31), 1, None), row("far", day, 3, 8), row("off", day - timedelta(40), 1, 5), row("off", day, 30, 100), row("new", day, 6), row("stays", day, 6), row("stays", day + timedelta(1), 6), row("five", day, 5)]
    got, gap = flags(spark, rows, p, day)
    assert {i for i, k in got if k == "f"} == {"ghost", "far"} and gap["ghost"] == 142
    assert {i for i, k in got if k == "g"} == {"new"}


def test_days_are_lifted_and_labels_ranked(spark):
    rows = [row("two", D0, 850, 1000), row("two", D0, 1, 5000)] + [row("two", D0 - timedelta(d), 50, 10**6) for d in (1, 2)]
    found = spikes.labelled(facts(spark, rows), P).where(F.col("ScrapDate") == F.lit(D0)).collect()
    assert [r["spike_flag"] for r in found] == ["CUMULATIVE_SALESCOUNT"] * 2  # C before D, and for every row of the day
    assert {r["win_from"] for r in found} == {D0 - timedelta(120)}


def group(gmv_before, gmv_in):
    start = date(2026, 4, 1)
    rows = [row(f"b{i}", start - timedelta(i + 1), 1, value=v) for i, v in enumerate(gmv_before)]
    return rows + [row(f"i{i}", start + timedelta(i), 1, value=v) for i, v in enumerate(gmv_in)]


@pytest.mark.parametrize("before,inside,n", [([10.0] * 7, [10, 10, 13.1], 1), ([10.0] * 7, [10, 10, 13.0], 0), ([10.0] * 7, [10, 99], 0), ([10.0] * 6, [10, 11, 12, 10, 11, 12, 99], 1), ([10.0] * 6, [10, 10, 99], 0)])
def test_outlier_days(spark, before, inside, n):
    rows = spikes.in_range(coerced(facts(spark, group(before, [float(x) for x in inside]))), P)
    assert spikes.iqr_dates(rows, P).count() == n


def test_windows_agree_with_a_loop(spark):
    rng, p, rows = random.Random(5), SpikeParams(period_from=date(2026, 4, 8), period_to=date(2026, 4, 20), radius=5, ghost_min_gap_days=6, include_stale=True, iqr_mult=0.5), []
    for item in range(25):
        for d in range(30):
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                rows.append(row(str(item), date(2026, 3, 28) + timedelta(d), rng.choice([5, 12, 12, 40, 200]), rng.choice([None, 60, 250, 900]), rng.choice([0.0, 2e6, 3e6]), l3=f"L{item % 2}"))
    got = {(r["ItemId"], r["ScrapDate"], k) for r in spikes.with_flags(facts(spark, rows), p).collect() for k in "abcdg" if r[f"flag_{k}"]}
    lo, hi = p.period_from - timedelta(5), p.period_to + timedelta(5)
    kept = [r for r in rows if lo <= r[1] <= hi and r[12] > 0]
    want = set()
    for item, day in {(r[0], r[1]) for r in kept}:
        own = [r for r in kept if r[0] == item]
        near = [r for r in own if abs((r[1] - day).days) <= 5]
        now = [r for r in own if r[1] == day]
        counts, first = [r[11] for r in near], min(r[1] for r in own)
        if len({r[1] for r in near}) >= 2 and len(set(counts)) <= 2 and max(counts) > 10:
            want.add((item, day, "a"))
        if first >= day - timedelta(5) and len(set(counts)) <= 2 and min(counts) > 10:
            want.add((item, day, "b"))
        if any(r[11] > 10 and r[10] and r[11] / float(r[10]) > 0.7 for r in now):
            want.add((item, day, "c"))
        base = [r for r in near if r[1] != day and r[11] > 0]
        if len({r[1] for r in base}) >= 2 and any(r[11] > 10 and r[11] > 3 * sum(x[11] for x in base) / len(base) for r in now):
            want.add((item, day, "d"))
        before = [r for r in near if r[1] < day]
        if not before and not [r for r in rows if r[0] == item and r[1] < day] and max(r[1] for r in own) == day and any(r[11] > 5 for r in now):
            want.add((item, day, "g"))
    assert got == want


def test_range_variant_repeats_rows_and_flags_zero_totals(spark):
    p = RangeParams(detection_from=D0 - timedelta(7), detection_to=D0 + timedelta(7), target_from=D0, target_to=D0, channel="Shopee")
    rows = [row("x", D0 - timedelta(1), 20, 20), row("x", D0 - timedelta(2), 20, 20), row("x", D0, 200, 210), row("z", D0, 50, 0), row("z", D0 - timedelta(30), 1, 1)]
    got = spikes.range_preview(facts(spark, rows), p).collect()
    assert sorted((r["ItemId"], r["spike_flag"]) for r in got) == [("x", "STALE_FROZEN_DAILY")] * 3 + [("z", "CUMULATIVE_SALESCOUNT")]
    assert spikes.range_preview(facts(spark, rows), p, True).count() == 2


def test_deletes_and_survivors_make_the_input(spark):
    rows = facts(spark, [row("a", D0, 850, 1000), row("b", D0, 5, 1000), row("a", D0 + timedelta(1), 1, 2000, 0.0)])
    found = spikes.labelled(rows, P).withColumn("ScrapDate", F.col("spike_date"))
    left = spikes.survivors(rows, found, ["Channel", "L3Title", "ScrapDate", "ItemId"], F.col("DailySalesValue") > 0)
    assert {r["ItemId"] for r in left.collect()} == {"a", "b"} and left.count() == 2


def test_statement_text_and_chunks(spark):
    rows = spark.createDataFrame([("Tiktok", "O'Hair", date(2026, 4, 12), date(2025, 12, 13), date(2026, 8, 10), f"i{k}", float(k)) for k in range(3)], "Channel string, L3Title string, spike_date date, win_from date, win_to date, ItemId string, gmv_jt double")
    got = [r["statement"] for r in deletes.statements(rows, "default.t", 2).orderBy("chunk").collect()]
    assert len(got) == 2 and "(chunk 1/2)" in got[0] and "ItemId IN ('i2', 'i1')" in got[0] and "L3Title = 'O''Hair'" in got[0] and "Window: 2025-12-13~2026-08-10" in got[0]


def test_decisions_stop_at_q(spark):
    rows = spark.createDataFrame([("c", f"l{k}", D0, str(k)) for k in range(4)], "Channel string, L3Title string, spike_date date, ItemId string")
    answers = spark.createDataFrame([("c", f"l{k}", D0, k, a) for k, a in enumerate("ynqy")], "Channel string, L3Title string, spike_date date, ordinal int, answer string")
    assert [r["ItemId"] for r in deletes.decided(rows, answers).collect()] == ["0"]


def test_stages_sources_and_filters(spark, tmp_path):
    assert deletes.stage_ranges(61509)[0] == (0, 12302) and len(deletes.stage_ranges(61509)) == 5
    frame = spark.createDataFrame([("1", "x")], "ItemId string, Channel string")
    assert ensure_column(frame, "L3Title", F.lit("")).columns[-1] == "L3Title" and ensure_column(frame, "Channel", F.lit("")) is frame
    assert frame.where(fact_filter(channel="x")).count() == 1 and frame.where(fact_filter(channel="x' OR '1'='1")).count() == 0
    frame.write.csv(str(tmp_path / "c"), header=True)
    assert read_table(spark, str(tmp_path / "c"), "csv", frame.schema).collect() == frame.collect()


def test_empty_fact(spark):
    empty = facts(spark, [])
    assert spikes.labelled(empty, P).count() == 0 and spikes.summary(spikes.labelled(empty, P)).count() == 0


def test_history_before_the_range_is_folded(spark):
    rows = [row("x", D0 - timedelta(P.radius + d), 5, 1000 + d) for d in range(1, 40)] + [row("x", D0 - timedelta(3), 0, "null"), row("x", D0, 7, 2000), row("y", D0, 1, 5)]
    fact = coerced(facts(spark, rows))
    keys = ["ItemId", "ScrapDate", "last_seen", "last_count"]
    whole = {tuple(r) for r in spikes.with_last_seen(fact).select(*keys).collect() if r["ScrapDate"] >= D0 - timedelta(P.radius)}
    folded = spikes.with_last_seen(fact, F.lit(D0 - timedelta(P.radius)), F.lit(D0)).select(*keys)
    assert {tuple(r) for r in folded.collect()} == whole and len(whole) == 3
    assert spikes.with_flags(facts(spark, rows), replace(P, enable_ghost=False)).where("flag_f").count() == 0
