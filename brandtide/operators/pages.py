"""Brand names from stored product pages: candidates by pattern, scores as arithmetic, the best one by rank."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brandtide.functions.text import GENERIC_WORDS, clean_spaces, is_generic, normalized, once, tokens

# What a candidate is worth by where it was found.
SOURCE_SCORES = {
    "json_brand": 0.88, "json_brand_name": 0.86, "json_item_brand": 0.84, "structured_brand": 0.90, "label_inline": 0.82,
    "label_sibling": 0.78, "meta_brand": 0.80, "store_hint": 0.45, "title_hint": 0.35, "unknown": 0.20,
}
# Labels, and the JSON forms that scripts are searched for.
LABELS = "brand|merk|merek"
JSON_FORMS = {
    "json_brand": r'(?i)"brand"\s*:\s*"([^"]+)"',
    "json_brand_name": r'(?i)"brand_name"\s*:\s*"([^"]+)"',
    "json_item_brand": r'(?i)"item_brand"\s*:\s*"([^"]+)"',
    "structured_brand": r'(?is)"brand"\s*:\s*\{[^}]*"name"\s*:\s*"([^"]+)"',
}
_TAGS = r"(?:</?[a-zA-Z][^>]*>\s*)*"
_EMPTY = r"(?:<([a-zA-Z]\w*)[^>]*>\s*</\1>\s*)*"


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value, in quotes of either kind or none; empty if it is missing."""
    value = lambda form: F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*{form}", 1)
    quoted = F.concat(value('"([^"]*)"'), value("'([^']*)'"))
    return F.when(quoted != "", quoted).otherwise(value(r"""([^\s"'>]+)"""))


def candidates(pages: DataFrame, labels: str = LABELS, meta: str = "brand", with_title: bool = False) -> DataFrame:
    """page_id, value, source, ord for each distinct candidate of ``html``; ``labels`` and ``meta`` are patterns.

    A label's value follows a colon or dash, whatever tags lie between (inline), or is in the next element that is not
    empty behind one that holds the label alone (sibling). Each script gives the first of each JSON form. Meta elements count if their
    name, or else property, holds ``meta``. A page without ``html`` has no candidates.
    """
    html = F.coalesce("html", F.lit(""))
    # As the reader sees it: scripts and styles hold no labels.
    body = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    tagged = lambda v, s: F.struct(clean_spaces(v).alias("value"), F.lit(s).alias("source"))
    every = lambda text, pattern, source, group=1: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda v: tagged(v, source))
    scripts = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script\s*>"), F.lit(1)), lambda t: F.array(*[tagged(F.regexp_extract(t, x, 1), s) for s, x in JSON_FORMS.items()]))
    named = lambda t: F.lower(once(_attribute(t, "name"), lambda n: F.when(n != "", n).otherwise(_attribute(t, "property"))))
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)), lambda t: named(t).rlike(meta))
    found = [
        every(body, rf"(?is)>\s*(?:{labels})\s*{_TAGS}[:\-]\s*{_TAGS}([^<]+)<", "label_inline"),
        every(body, rf"(?is)>\s*(?:{labels})\s*</[^>]+>\s*{_EMPTY}(?:<[a-zA-Z][^>]*>\s*)+([^<]+?)\s*<", "label_sibling", 2),
        F.flatten(scripts),
        F.transform(metas, lambda t: tagged(_attribute(t, "content"), "meta_brand")),
    ]
    if with_title:
        found.append(every(html, r"(?is)<title[^>]*>([^<]+)</title>", "title_hint"))
    rows = pages.select("page_id", F.posexplode(F.flatten(F.array(*found))).alias("ord", "c")).select("page_id", "c.value", "c.source", "ord").where("value <> ''")
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("page_id", F.lower("value"), "source").orderBy("ord"))).where("n = 1").drop("n")


def fetched(rows: DataFrame, fetch: Callable[[str], str], tries: int = 3) -> DataFrame:
    """page_id, url, html, fetch_error of ``rows`` (page_id, url): each page is asked for up to ``tries`` times.

    A page without url is not asked for. What a failed page last raised is its fetch_error, and its html is null.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for url in frame["url"]:
                got, error = None, None
                for _ in range(tries if url else 0):
                    try:
                        got, error = fetch(url), None
                        break
                    except Exception as failure:  # noqa: BLE001 - whatever a browser raises
                        error = f"{type(failure).__name__}: {failure}"
                found.append((got, error))
            yield frame.assign(html=pd.Series([x for x, _ in found], dtype="object", index=frame.index), fetch_error=pd.Series([x for _, x in found], dtype="object", index=frame.index))

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.select("page_id", "url").mapInPandas(ask, f"page_id {kind}, url string, html string, fetch_error string")


# Fixed values within: what length, words, digits, the reference brand and the listing add or take, and the bounds.
def score(value: Column, source: Column, listing: Column, reference: Column) -> Column:
    """0 to 0.99, four places."""
    c, n, ref, title = clean_spaces(value), normalized(value), clean_spaces(reference), normalized(listing)
    size, n_words, digits = F.length(c), F.size(tokens(n)), F.length(F.regexp_replace(c, "[^0-9]", ""))
    base = F.lit(SOURCE_SCORES["unknown"])
    for name, worth in SOURCE_SCORES.items():
        base = F.when(source == name, worth).otherwise(base)
    known = normalized(ref)
    total = (
        base
        + F.when(size.between(2, 25), 0.08).when(size <= 40, 0.03).otherwise(-0.18)
        + F.when(n_words.between(1, 3), 0.08).when(n_words == 4, 0.03).otherwise(-0.12)
        + F.when(is_generic(n), -0.30).otherwise(0.0)
        + F.when(digits >= F.greatest(F.lit(2), F.floor(size / 3)), -0.10).otherwise(0.0)
        + F.when(ref == "", 0.0).when(known == n, 0.22).when(F.contains(n, known) | F.contains(known, n), 0.10).otherwise(0.0)
        + F.when((title != "") & F.contains(title, n), 0.05).otherwise(0.0)
        + F.when(n.isin(*GENERIC_WORDS), -0.35).otherwise(0.0)
    )
    return F.when((c == "") | (n == ""), F.lit(0.0)).otherwise(F.round(F.greatest(F.lit(0.0), F.least(total, F.lit(0.99))), 4))


def scored(found: DataFrame, pages: DataFrame) -> DataFrame:
    """Candidates with confidence; ``pages`` has page_id, ListingName, Brand."""
    rows = found.join(pages.select("page_id", "ListingName", "Brand"), "page_id")
    return rows.withColumn("confidence", score(F.col("value"), F.col("source"), F.col("ListingName"), F.col("Brand"))).drop("ListingName", "Brand")


def picked(pages: DataFrame, found: DataFrame, least: float = 0.60, domains: tuple[str, ...] = ("shopee", "tiktok")) -> DataFrame:
    """page_id, BrandName, BrandConfidence, BrandSource, ResultStatus, ResultNote: the best candidate, ties by order.

    ``pages`` has page_id, url and perhaps fetch_error; ``found`` has page_id, value, source, ord, confidence.
    """
    error = F.col("fetch_error") if "fetch_error" in pages.columns else F.lit(None).cast("string")
    best = found.groupBy("page_id").agg(F.max(F.struct("confidence", (-F.col("ord")).alias("first"), "value", "source")).alias("b"))
    url = F.lower(clean_spaces(F.col("url")))
    unsupported = F.lit(True)
    for d in domains:
        unsupported &= ~F.contains(url, F.lit(d))
    status = F.when((url == "") | unsupported, "invalid_url").when(F.col("failed").isNotNull(), "error").when(F.col("b").isNull(), "not_found").when(F.col("b.confidence") < least, "low_confidence").otherwise("success")
    note = F.when(url == "", "empty url").when(unsupported, "unsupported domain").when(F.col("failed").isNotNull(), F.col("failed")).when(F.col("b").isNull(), "no candidate").when(F.col("b.confidence") < least, F.col("b.value")).otherwise("")
    rows = pages.select("page_id", "url", error.alias("failed")).join(best, "page_id", "left").withColumn("ResultStatus", status)
    valid = F.col("ResultStatus").isin("success", "low_confidence")
    return rows.select("page_id", F.when(F.col("ResultStatus") == "success", F.col("b.value")).otherwise("").alias("BrandName"), F.when(valid, F.col("b.confidence")).otherwise(0.0).alias("BrandConfidence"), F.when(valid, F.col("b.source")).otherwise("").alias("BrandSource"), "ResultStatus", note.alias("ResultNote"))
