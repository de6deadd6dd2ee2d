"""Toxicity by class-conditional Kneser-Ney models.

Two word-bigram models, of toxic and of ordinary rows, share the counts that they back off to. By class c,

    P_c(w | v) = max(c(v, w) - D, 0) / c(v) + left_c(v) P_c(w)
    P_c(w)     = max(N(. w) - D, 0) / N(..) + left_c P_shared(w)

with N the number of different words before w within the class (continuation counts), c that of different words before
the pair, and P_shared the relative frequency of w in all texts of the corpus, labelled or not: a lowest level of plain
frequencies below the two Kneser-Ney levels. So neither what a text repeats nor a passage that some texts share counts
more than once; an expression that always has the same words before it counts once as well, and is missed.

The discount D is of this module's own making, in place of one absolute discount: four plus what the other class
explains, 1.5 times its count o, scaled to the same total, and twice the root of that. So expressions that are rare, or
that both classes have alike (a language, a subject), go to the shared counts whole, and a class keeps of its own what
the other does not show. Both models learn from as many rows. A text's value is the mean over its words of the difference
of both log-likelihoods; a logistic curve fitted to labelled rows kept out of the models turns it into a score.

Words are runs of ASCII letters (lower-cased) and bytes above 127. The models are fitted on at most about
``ROWS_PER_CLASS`` rows of each class and the curve on ``CURVE_ROWS`` (chosen by a hash of the id): the
documented bounds of the fit. What is broadcast are the pairs, contexts and words in which a class has an excess, five
different contexts at least, in those rows: all of them. Counts of the corpus cover every text.

Defined results: a null or empty text has the value of words that neither class shows, and the score of the curve there; without labels of both
classes every score is the share of toxic labels (0 without any); a null label is none; labels that repeat an id
count once, by the largest. ``without_toxic`` never rejects a row of a null id, rejects all rows of an id that
has one toxic text, and rejects nothing without labels of both classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandtide.llm.common import HashIndex, bounds, mix64, run_hashes, small_batches, table, text_slices, with_small
from brandtide.runtime import scratch, staged

ROWS_PER_CLASS, CURVE_ROWS, DISCOUNT = 8000, 16000, 4.0
WORD_SEED, PAIR = 0x5DEECE66D1CE4E5B, np.uint64(0x9E3779B97F4A7C15)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of some rows, and the first word of each row (rows + 1 entries)."""
    low = data | np.uint8(32)
    starts, ends = bounds(((low >= 97) & (low <= 122)) | (data >= 128), offsets)
    hashes = run_hashes(np.where(data < 128, low, data), starts, ends, WORD_SEED)
    return hashes, np.searchsorted(starts, offsets)


def excess(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Counts less their discount, given the other class's counts on the same scale."""
    return np.maximum(own - DISCOUNT - 1.5 * other - 2.0 * np.sqrt(other), 0.0)


def _excess(own: str, other: str, scale: float) -> Column:
    o = F.col(other) * F.lit(scale)
    return F.greatest(F.col(own) - DISCOUNT - o * 1.5 - F.sqrt(o) * 2.0, F.lit(0.0))


def _pairs(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbouring words within a row: positions of the second word, and pair hashes."""
    inner = np.ones(len(hashes), bool)
    inner[first[:-1][first[:-1] < len(hashes)]] = False
    at = np.flatnonzero(inner)
    return at, mix64(hashes[at - 1] * PAIR + hashes[at])


def count_triples(batches):
    for b in batches:
        for cls, data, offs in text_slices(b["toxic"], b["text"], 1 << 22):
            hashes, first = tokens(data, offs)
            if not len(hashes):
                continue
            at, pair = _pairs(hashes, first)
            toxic = np.repeat(np.array(cls, np.int64), np.diff(first))
            starts = np.flatnonzero(np.isin(np.arange(len(hashes)), at, invert=True))  # a row's first word follows word 0
            prior = np.concatenate([np.zeros(1, np.uint64), hashes[:-1]])
            prior[starts] = 0  # what stands before each word
            before = np.concatenate([hashes[at - 1], np.zeros(len(starts), np.uint64)])
            context = np.concatenate([prior[at - 1], np.zeros(len(starts), np.uint64)])
            word = np.concatenate([hashes[at], hashes[starts]])
            pair = mix64(np.concatenate([pair, mix64(hashes[starts])]) + context * PAIR)
            label = np.concatenate([toxic[at], toxic[starts]])
            _, where, which = np.unique(pair, return_index=True, return_inverse=True)
            t = np.bincount(which, weights=label, minlength=len(where)).astype(np.int64)
            n = np.bincount(which, minlength=len(where)) - t
            yield pa.record_batch([*[pa.array(x[where].view(np.int64)) for x in (context, before, word)], pa.array(t > 0), pa.array(n > 0)], names=["u", "v", "w", "t", "n"])


def _columns(df: DataFrame) -> list[np.ndarray]:
    return [c.to_numpy() for c in df.toArrow().columns]


def corpus_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """How often each word of the vocabulary stands in all texts, and the number of all words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        index, sums = HashIndex(shared.value), np.zeros(len(shared.value) + 1, np.int64)  # any other word counts last
        for b in batches:
            for _, data, offs in text_slices(b["doc_id"], b["text"]):
                at = index.find(tokens(data, offs)[0])
                sums += np.bincount(np.where(at >= 0, at, len(sums) - 1), minlength=len(sums))
        used = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(sums[used])], names=["word", "n"])

    at, n = _columns(docs.select("doc_id", "text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n")))
    out = np.zeros(len(vocabulary) + 1, np.int64)
    out[at] = n
    return out[:-1], int(out.sum())


class Model:
    """Differences of log-probabilities (toxic less ordinary) by pair, context and word."""

    def __init__(self, docs: DataFrame, labelled: DataFrame):
        triples = labelled.select(F.col("toxic").cast("long").alias("toxic"), "text").mapInArrow(count_triples, "u long, v long, w long, t boolean, n boolean")
        triples = triples.groupBy("u", "v", "w").agg(F.max("t").alias("t"), F.max("n").alias("n"))
        pairs = staged(triples.groupBy("v", "w").agg(F.count_if("t").alias("t"), F.count_if("n").alias("n")), "toxic-pairs")
        kinds = lambda c: F.count(F.when(F.col(c) > 0, 1))
        size_t, size_n = (float(x or 1) for x in pairs.agg(F.sum("t"), F.sum("n")).first())
        words = staged(pairs.groupBy("w").agg(kinds("t").alias("nt"), kinds("n").alias("nn")), "toxic-words")
        kinds_t, kinds_n = (float(x or 1) for x in words.agg(F.sum("nt"), F.sum("nn")).first())
        word_owns = [_excess("nt", "nn", kinds_t / kinds_n), _excess("nn", "nt", kinds_n / kinds_t)]
        own_t, own_n = (float(x or 0) for x in words.agg(*map(F.sum, word_owns)).first())
        left_t, left_n = 1 - own_t / kinds_t, 1 - own_n / kinds_n
        owns = [_excess("t", "n", size_t / size_n), _excess("n", "t", size_n / size_t)]
        # All with an excess: what has none is worth what an unseen pair, context or word is.
        kept = staged(pairs.withColumns({"et": owns[0], "en": owns[1]}).where("et > 0 or en > 0").select("v", "w", "et", "en"), "toxic-kept")
        contexts = pairs.groupBy("v").agg(F.sum("t").alias("ct"), F.sum("n").alias("cn"), *[F.sum(x).alias(k) for x, k in zip(owns, ("et", "en"))]).where("et > 0 or en > 0")
        words = words.withColumns({"et": word_owns[0], "en": word_owns[1]}).join(kept.select("w", F.lit(True).alias("paired")).distinct(), "w", "left")
        w, et, en = _columns(words.where("et > 0 or en > 0 or paired").select("w", "et", "en"))
        self.words = w.view(np.uint64)
        seen, total = corpus_counts(docs, self.words)
        base = (seen + 1.0) / (total + len(seen) + 1.0)
        p_t, p_n = et / kinds_t + left_t * base, en / kinds_n + left_n * base
        self.word_delta, self.unseen = np.log(p_t / p_n), float(np.log(left_t / left_n))
        v, ct, cn, et, en = _columns(contexts.select("v", "ct", "cn", "et", "en"))
        rest_t, rest_n = 1 - et / np.maximum(ct, 1), 1 - en / np.maximum(cn, 1)
        self.contexts, self.context_delta = v.view(np.uint64), np.log(rest_t / rest_n)
        v2, w2, et, en = _columns(kept)
        v2, w2 = v2.view(np.uint64), w2.view(np.uint64)
        at_v, at_w = HashIndex(self.contexts).find(v2), HashIndex(self.words).find(w2)
        q_t = et / np.maximum(ct[at_v], 1) + rest_t[at_v] * p_t[at_w]
        q_n = en / np.maximum(cn[at_v], 1) + rest_n[at_v] * p_n[at_w]
        self.pairs, self.pair_delta = mix64(v2 * PAIR + w2), np.log(q_t / q_n)

    def scorer(self):
        """A function from (bytes, offsets) to each row's mean difference."""
        words, contexts, pairs = HashIndex(self.words), HashIndex(self.contexts), HashIndex(self.pairs)
        take = lambda delta, at, other: np.where(at >= 0, delta[at], other) if len(delta) else np.full(len(at), other)

        def score(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
            hashes, first = tokens(data, offsets)
            value = take(self.word_delta, words.find(hashes), self.unseen)
            before = np.concatenate([np.zeros(1, np.uint64), hashes[:-1]]) if len(hashes) else hashes
            before[first[:-1][first[:-1] < len(hashes)]] = 0
            value = value + take(self.context_delta, contexts.find(before), 0.0)
            at = pairs.find(mix64(before * PAIR + hashes))
            value = np.where(at >= 0, take(self.pair_delta, at, 0.0), value)
            sums = np.concatenate([[0.0], np.cumsum(value)])
            n = np.diff(first)
            return np.where(n > 0, (sums[first[1:]] - sums[first[:-1]]) / np.maximum(1, n), self.unseen)

        return score


def values(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id and value for rows with doc_id and text."""
    shared = rows.sparkSession.sparkContext.broadcast(model.__dict__)

    def run(batches):
        own = object.__new__(Model)
        own.__dict__ = shared.value
        score = own.scorer()
        for b in batches:
            found = [score(data, offs) for _, data, offs in text_slices(b["doc_id"], b["text"])]
            yield pa.record_batch([b["doc_id"], pa.array(np.concatenate(found) if found else np.zeros(0))], names=["doc_id", "value"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, value double")


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve with most likelihood, slightly ridged."""
    scale = float(np.std(x)) or 1.0
    z, beta = np.stack([x / scale, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (y - p) - 1e-3 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def fitted(docs: DataFrame, labels: DataFrame, learn: Column, curve: Column) -> tuple[Model | None, float, float]:
    """Model and curve from the labels; ``learn`` and ``curve`` say which ids serve the models and the curve."""
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where((learn | curve) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic", learn.alias("learn"))
    sizes = {(r["learn"], r["toxic"]): r["count"] for r in known.groupBy("learn", "toxic").count().collect()}
    rows = sum(n for (x, _), n in sizes.items())
    if not sizes.get((True, 1)) or not sizes.get((True, 0)) or not sizes.get((False, 1)) or not sizes.get((False, 0)):
        toxic = sum(n for (_, t), n in sizes.items() if t == 1)
        share = min(max(toxic / rows, 1e-6), 1 - 1e-6) if rows else 0.0
        return None, 0.0, float(np.log(share / (1 - share))) if share else float("-inf")
    place = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 31))
    curve_all = sizes[False, 0] + sizes[False, 1]
    each = min(ROWS_PER_CLASS, sizes[True, 0], sizes[True, 1])
    part = lambda most, n: F.lit(int(min(1.0, most / n) * (1 << 31)))
    least = F.when(~F.col("learn"), part(CURVE_ROWS, curve_all)).when(F.col("toxic") == 1, part(each, sizes[True, 1])).otherwise(part(each, sizes[True, 0]))
    chosen = F.broadcast(known.where(place < least))  # at most about 2 * ROWS_PER_CLASS + CURVE_ROWS rows
    chosen = staged(docs.select("doc_id", "text").join(chosen, "doc_id").withColumn("same", F.xxhash64("text")).dropDuplicates(["same", "toxic", "learn"]).drop("same").repartition(24), "toxic-fit")
    model = Model(docs, chosen.where("learn"))
    held = chosen.where(~F.col("learn"))
    x, y = _columns(values(held, model).join(F.broadcast(held.select("doc_id", "toxic").distinct()), "doc_id").select("value", F.col("toxic").cast("double")))
    return model, *logistic(x, y)


def scored(docs: DataFrame, labels: DataFrame, learn: Column, held: Column) -> DataFrame:
    """doc_id and score (0 to 1) of every text."""
    with scratch(docs.sparkSession):  # the model is on the driver then
        model, slope, start = fitted(docs, labels, learn, held)
    found = values(docs, model) if model else docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.0).alias("value"))
    return curve(found, slope, start)


def curve(found: DataFrame, slope: float, start: float) -> DataFrame:
    """doc_id and score of rows of doc_id and value."""
    return found.select("doc_id", (1 / (1 + F.exp(-(F.lit(slope) * F.col("value") + F.lit(start))))).alias("score"))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(-1))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    number = fold(F.col("doc_id"))
    found = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), number.isin(1, 2, 3), number == 4)
    return found.select("doc_id", (number == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, at: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below ``at``; all labels serve (folds 0 to 3 the models, 4 the curve)."""
    number = fold(F.col("doc_id"))
    with scratch(docs.sparkSession) as keep:
        model, slope, start = fitted(docs, labels, number.isin(0, 1, 2, 3), number == 4)
        if model is None:
            return docs
        rejected = curve(values(docs, model), slope, start).where(F.col("score") >= at)
        rejected = keep(staged(rejected.select(F.col("doc_id").alias("__rejected")).distinct(), "toxic-rejected"))
    return with_small(docs, rejected, F.col("doc_id").cast("long") == F.col("__rejected"), "left_anti", rejected.count())
