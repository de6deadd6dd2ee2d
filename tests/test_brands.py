"""Text functions, matching, rules and pages on known values."""

import pytest
from pyspark.sql import functions as F

from brandtide.functions import text
from brandtide.functions.match import indel_ratio, metaphone
from brandtide.operators import brands, pages


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,want", [("3m", "3M"), ("1001abc", "1001Abc"), ("good-day", "Good-Day"), ("L'oREAL", "L'Oreal"), ("", "")])
def test_title_case(spark, raw, want):
    assert one(spark, text.title_case, raw) == want == raw.title()


def test_cleaning(spark):
    assert one(spark, text.clean_title, "  Kopi\tÉtoile-3in1!! ") == "kopi toile 3in1"
    assert one(spark, text.clean_title, None) == ""
    assert one(spark, text.clean_spaces, "a  b\n") == "a b"
    assert one(spark, text.normalized, "H&M  (Co.)") == "h&m co."
    assert one(spark, text.skeleton, "L'Oréal 3") == "loral3"


def test_ngrams(spark):
    grams = lambda w: one(spark, text.ngrams, w, "array<string>")
    assert grams(["a", "b", "c"]) == ["a", "b", "c", "a b", "b c"] and grams(["a"]) == ["a"] and grams([]) == []


@pytest.mark.parametrize("raw,want", [('["a","b"]', ["a", "b"]), ('```json\n["a"]\n```', ["a"]), ('Sure: ["a","b"] ok', ["a", "b"]), ('["a","b","c', ["a", "b"]), ('["a","b"', ["a"]), ("none", None)])
def test_salvaged_arrays(spark, raw, want):
    assert (one(spark, text.json_names, raw) or None) == want


def test_likeness():
    assert metaphone("skintific") == metaphone("skintifik") == "SKNTFK"
    assert metaphone("knight") == "NT"
    assert round(indel_ratio("maxpreso", "maxpresso"), 2) == 94.12
    assert indel_ratio("", "") == 100 and indel_ratio("a", "") == 0


def test_likeness_against_a_table():
    import random

    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(9))) for _ in "xy")
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert indel_ratio(a, b) == (200 * t[-1][-1] / (len(a) + len(b)) if a or b else 100)


def test_cascade(spark):
    masters = spark.createDataFrame([("Skintific",), ("Maxpresso",), ("Abc",)], "Brand string")
    names = spark.createDataFrame([("SKINTIFIC",), ("skintifik",), ("abd",), ("qqqwwww",)], "candidate string")
    got = {r["candidate"]: (r["status"], r["suggested"]) for r in brands.matched(names, masters).collect()}
    assert got == {"SKINTIFIC": ("Existing Brand", "Skintific"), "skintifik": ("Auto-Matched (Synonym)", "Skintific"), "abd": ("Short Candidate (To LLM)", ""), "qqqwwww": ("New Brand Discovery", "")}


@pytest.mark.parametrize("extra", [0, 150])
def test_first_rule_wins(spark, extra):
    rules = spark.createDataFrame([("kopi", "X", 1), ("kopi gayo", "Y", 2)] + [(f"zz{k}", "Z", 3 + k) for k in range(extra)], "keyword string, brand string, rule_rank int")
    rows = spark.createDataFrame([("Kopi Gayo 1kg", "No Brand"), ("Kopi", "Own"), ("tea", "No Brand"), (None, "No Brand")], "ListingName string, Brand string")
    got = {(r["ListingName"], r["Brand"]) for r in brands.apply_rules(rows, rules).collect()}
    assert got == {("Kopi Gayo 1kg", "X"), ("Kopi", "Own"), ("tea", "No Brand"), (None, "No Brand")}


def test_vocabulary_and_stats(spark):
    rows = spark.createDataFrame([("1", "acme acme tool", 10.0, 1), ("2", "acme murah tool", 5.0, 2), ("3", "other thing", None, 3)], "ItemId string, ListingName string, DailySalesValue double, ord int")
    p = brands.BrandParams(max_df=1.0)
    assert {r["ngram"]: r["df"] for r in brands.vocabulary(rows, p).collect()} == {"acme": 2, "tool": 2, "acme tool": 2}
    got = {r["ngram"]: (r["occurrences"], r["total_gmv"], r["samples"]) for r in brands.ngram_stats(rows, p).collect()}
    assert got == {"acme": (3, 25.0, "1 || 1 || 2"), "tool": (2, 15.0, "1 || 2"), "acme tool": (1, 10.0, "1")}


def test_judge_and_containment(spark):
    found = spark.createDataFrame([("sakha coffee", "ambiguous"), ("zzz", "ambiguous"), ("ok", "accept"), ("no", "reject")], "candidate string, bucket string")
    got = {r["candidate"]: r["status"] for r in brands.validated(found, lambda names: {"Sakha"} if "zzz" in names or "sakha coffee" in names else set()).collect()}
    assert got == {"sakha coffee": "LLM Verified Brand", "zzz": "Rejected by LLM (Generic/Region)", "ok": "LLM Verified Brand", "no": "Rejected by Embedding (Generic)"}


@pytest.mark.parametrize("value,source,listing,want", [("-", "label_sibling", "x", 0.89), ("-", "label_sibling", "a - b", 0.94), ("-", "label_inline", "x", 0.93), (r"Shop \x26 MISC (v2019.04)", "json_brand", "x", 0.89)])
def test_scores(spark, value, source, listing, want):
    frame = spark.createDataFrame([(value, source, listing, "")], "v string, s string, l string, r string")
    assert frame.select(pages.score(*map(F.col, "vslr")).alias("y")).first()["y"] == want


def test_pages(spark):
    html = '<p>Brand: Acme</p><dl><dt>Merek</dt><dd>Bolt</dd></dl><script>{"brand":"Json","x":{"brand_name":"Name"}}</script><meta name="og:brand" content="Meta"><p>brand: acme</p>'
    rows = spark.createDataFrame([(1, "https://shopee.x/1", html, "", ""), (2, "http://other", html, "", ""), (3, None, None, None, None), (4, "tiktok", "<p>none</p>", "", "")], "page_id int, url string, html string, ListingName string, Brand string")
    found = pages.candidates(rows)
    assert {(r["value"], r["source"]) for r in found.where("page_id = 1").collect()} == {("Acme", "label_inline"), ("Bolt", "label_sibling"), ("Json", "json_brand"), ("Name", "json_brand_name"), ("Meta", "meta_brand")}
    got = {r["page_id"]: (r["ResultStatus"], r["ResultNote"]) for r in pages.picked(rows, pages.scored(found, rows)).collect()}
    assert got == {1: ("success", ""), 2: ("invalid_url", "unsupported domain"), 3: ("invalid_url", "empty url"), 4: ("not_found", "no candidate")}


def test_the_judge_is_asked_once_for_each_name(spark):
    asked = spark.sparkContext.accumulator(0)

    def judge(names):
        asked.add(len(names))
        return {n for n in names if n.endswith("7")}

    found = spark.createDataFrame([(f"name {k}", "ambiguous") for k in range(40)], "candidate string, bucket string")
    got = brands.validated(found, judge).collect()
    assert asked.value == 40
    assert sum(r["status"] == "LLM Verified Brand" for r in got) == 7  # 1, 2 and 3 are within 17, 27 and 37


def test_containment_against_brute_force(spark):
    import random

    rng = random.Random(5)
    names = list({"".join(rng.choices("ab c", k=rng.randrange(1, 7))).strip() or "x" for _ in range(60)})
    verified = {n for n in names if len(n) == 3}
    got = {r["candidate"]: r["status"] for r in brands.validated(spark.createDataFrame([(n, "ambiguous") for n in names], "candidate string, bucket string"), lambda batch: {n for n in batch if len(n) == 3}).collect()}
    bare = lambda n: n.replace(" ", "")
    want = {n: any(bare(v) in bare(n) or bare(n) in bare(v) for v in verified) for n in names}
    assert {n: s == "LLM Verified Brand" for n, s in got.items()} == want


def test_best_of_against_all(spark):
    import random

    from brandtide.functions.match import best_of

    rng = random.Random(4)
    for _ in range(100):
        names = [("".join(rng.choices("abc", k=rng.randrange(1, 4))), "".join(rng.choices("abcd", k=rng.randrange(0, 12)))) for _ in range(20)]
        word = "".join(rng.choices("abcd", k=rng.randrange(0, 12)))
        by = {}
        for n, s in names:
            by.setdefault(len(s), []).append((n, s))
        top = max(indel_ratio(word, s) for _, s in names)
        assert best_of(word, by) == (top, min(n for n, s in names if indel_ratio(word, s) == top) if top else None)


def test_lists_of_masters(spark, monkeypatch):
    masters = spark.createDataFrame([(f"Brand{k}xyz",) for k in range(30)] + [("Skintific",)], "Brand string")
    names = spark.createDataFrame([("brando7xyzq",), ("skintifficc",), ("wholly other",)], "candidate string")
    rows = [sorted(map(tuple, brands.matched(names, masters).collect()))]
    monkeypatch.setattr(brands, "LIST_ROWS", 4)
    rows.append(sorted(map(tuple, brands.matched(names, masters).collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 3


def test_titles_are_cleaned_once(spark):
    rows = spark.createDataFrame([("1", "acme tool", 1.0, 1)], "ItemId string, ListingName string, DailySalesValue double, ord int")
    for frame in (brands.simple_ngrams(rows), brands.vocabulary(rows)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace") == 2


def test_pages_with_several_scripts_and_forms(spark):
    html = """<div><span>Brand</span><span></span><i> Sib </i></div><p><b>Merk</b> - <i>Inl</i></p>
      <script>var a = {"brand": "One"};</script><script type="application/ld+json">{"Brand": {"logo": "x", "name": "Ld"}, "brand": "Two"}</script>
      <script>x = '<p>Brand: Script</p>'</script><META CONTENT='Meta A' NAME='Brand'><meta property="og:brand" content="Meta B"><meta name="author" content="Nobody">"""
    rows = spark.createDataFrame([(1, "https://shopee.x/1", html, "", "")], "page_id int, url string, html string, ListingName string, Brand string")
    assert {(r["value"], r["source"]) for r in pages.candidates(rows).collect()} == {
        ("Inl", "label_inline"), ("Sib", "label_sibling"), ("One", "json_brand"), ("Two", "json_brand"), ("Ld", "structured_brand"), ("Meta A", "meta_brand"), ("Meta B", "meta_brand")
    }
