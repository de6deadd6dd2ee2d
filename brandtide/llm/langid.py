"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes one space, and the 1-, 2- and 3-grams of what results are
hashed into buckets. Counts by language come from at most about ``ROWS_PER_LANGUAGE`` labelled rows of each
language (chosen by a hash of the id; the documented bound of the fit); the log-probability matrix, of a fixed
size, is broadcast. Scoring gathers the matrix rows of a batch's n-grams and sums them by document in numpy. All
languages are equally likely beforehand: how many rows are labelled says nothing about a text.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if there is no
labelled row; equal scores go to the first language by code point; a null language is no label; more than
``LANGUAGES`` different labels are an error.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandtide.llm.common import mix64, small_batches, table, text_slices

ROWS_PER_LANGUAGE, LANGUAGES = 5000, 4096
BUCKETS, ORDERS, ALPHA = 1 << 16, (1, 2, 3), 0.1
#: The matrix has at most so many cells; with very many languages there are fewer buckets.
CELLS = 1 << 25
KNOWN = 0x3000
#: A text of more bytes goes through in pieces of so many characters.
LONG = 2 << 20


def letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(KNOWN)])


def _letters_of(low: str, known: np.ndarray, after: bool) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased text with all but letters as blanks, and which of them count: letters, and the first
    other character after a letter; ``after``: whether a letter stands before the text."""
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    alpha = known[np.minimum(codes, KNOWN - 1)]
    if len(high := np.flatnonzero(codes >= KNOWN)):
        kinds, which = np.unique(codes[high], return_inverse=True)
        alpha[high] = np.array([chr(c).isalpha() for c in kinds])[which]
    keep = alpha.copy()
    keep[1:] |= alpha[:-1]
    keep[:1] |= after
    return np.where(alpha, codes, 32).astype(np.uint64), keep


def _hashed(codes: np.ndarray, n: int, buckets: int) -> np.ndarray:
    h = np.full(max(0, len(codes) - n + 1), n, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x100000001B3) + codes[k : k + len(h)]
    return (mix64(h) & np.uint64(buckets - 1)).astype(np.int64)


def grams(texts: list[str], known: np.ndarray, buckets: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Buckets and row of each n-gram, by order, and which rows have a letter."""
    low = [t.lower() for t in texts]
    codes, keep = _letters_of("".join(t + "\n" for t in low), known, False)
    rows = np.searchsorted(np.cumsum([len(t) + 1 for t in low]), np.flatnonzero(keep), "right")
    codes = codes[keep]
    has = np.zeros(len(texts), bool)
    has[rows[codes != 32]] = True
    hashed, owner = [], []
    for n in ORDERS:
        h = _hashed(codes, n, buckets)
        whole = rows[: len(h)] == rows[n - 1 : n - 1 + len(h)]
        if n == 1:
            whole &= codes != 32
        hashed.append(h[whole])
        owner.append(rows[: len(h)][whole])
    return hashed, owner, has


def grams_of_one(text: str, known: np.ndarray, buckets: int, size: int):
    """What ``grams`` gives for one text, by pieces of ``size`` characters; each carries the last characters over."""
    low, after, carry = text.lower() + "\n", False, np.zeros(0, np.uint64)
    for i in range(0, len(low), size):
        codes, keep = _letters_of(low[i : i + size], known, after)
        after = bool(codes[-1] != 32)
        codes = codes[keep]
        joined = np.concatenate([carry, codes])
        hashed = [_hashed(joined[max(0, len(carry) - n + 1) :] if n > 1 else codes[codes != 32], n, buckets) for n in ORDERS]
        yield hashed, [np.zeros(len(h), np.int64) for h in hashed], np.array([bool((codes != 32).any())])
        carry = joined[len(joined) - min(len(joined), max(ORDERS) - 1) :]


def fit(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and their matrix (buckets x languages, float32) from rows with doc_id, text and lang."""
    labelled = labelled.where("lang is not null")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages are labelled")
    langs = sorted(sizes)
    buckets = BUCKETS
    while buckets * len(langs) > CELLS:
        buckets //= 2
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    place = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 31))
    # A row for each language, at most LANGUAGES.
    wanted = labelled.sparkSession.createDataFrame([(k, i, int(min(1.0, rows_per_language / sizes[k]) * (1 << 31))) for i, k in enumerate(langs)], "lang string, lang_index int, least long")
    chosen = labelled.join(F.broadcast(wanted), "lang").where(place < F.col("least")).select("lang_index", "text").repartition(24)
    n_langs = len(langs)

    def count(batches):
        known, sums = letters(), np.zeros((n_langs, buckets), np.int64)
        for b in batches:
            for lang, data, offs in text_slices(b["lang_index"], b["text"]):
                raw = data.tobytes()
                hashed, owner, _ = grams([raw[x:y].decode() for x, y in zip(offs[:-1], offs[1:])], known, buckets)
                lang = np.array(lang)
                for h, o in zip(hashed, owner):
                    sums += np.bincount(lang[o] * buckets + h, minlength=n_langs * buckets).reshape(n_langs, buckets)
        used = [i for i in range(n_langs) if sums[i].any()]
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array([zlib.compress(sums[i].tobytes(), 1) for i in used], pa.binary())], names=["lang_index", "sums"])

    total = np.zeros((n_langs, buckets))
    for row in chosen.mapInArrow(count, "lang_index int, sums binary").toLocalIterator():  # 24 partitions, one array for each language
        total[row["lang_index"]] += np.frombuffer(zlib.decompress(row["sums"]), np.int64)
    logs = np.log(total + ALPHA) - np.log(total.sum(axis=1, keepdims=True) + ALPHA * buckets)
    return langs, np.ascontiguousarray(logs.T.astype(np.float32))


def predict(docs: DataFrame, langs: list[str], logs: np.ndarray, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior of the prediction) for rows with doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, logs))

    def score(batches):
        langs, logs = shared.value
        known = letters()
        for b in batches:
            pred, best = [], []
            for ids, data, offs in text_slices(b["doc_id"], b["text"]):
                raw = data.tobytes()
                texts = [raw[x:y].decode() for x, y in zip(offs[:-1], offs[1:])]
                sums, has = np.zeros((len(texts), max(1, len(langs)))), np.zeros(len(texts), bool)
                long = len(texts) == 1 and len(raw) > LONG
                for hashed, owner, any_ in grams_of_one(texts[0], known, len(logs), LONG) if long else [grams(texts, known, len(logs))]:
                    has |= any_
                    if langs:
                        for h, o in zip(hashed, owner):
                            if len(h):
                                first = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
                                sums[o[first]] += np.add.reduceat(logs[h], first, axis=0, dtype=np.float64)
                top = sums.argmax(axis=1)
                odds = np.exp(sums - sums.max(axis=1, keepdims=True))
                p = odds[np.arange(len(texts)), top] / odds.sum(axis=1)
                known_ = has & bool(langs)
                pred += [langs[i] if k else "und" for i, k in zip(top, known_)]
                best.append(np.where(known_, p, 0.0))
            best = np.concatenate(best) if best else np.zeros(0)
            yield pa.record_batch([b["doc_id"], b["held_out"], pa.array(pred, pa.string()), pa.array(best, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text").mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def op2_language(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    langs, logs = fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    return predict(docs, langs, logs, held_out)
