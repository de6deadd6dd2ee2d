"""Document fingerprints by winnowing.

Every run of ``K`` code points is hashed with a rolling polynomial; of each ``WINDOW`` neighbouring hashes the
smallest is kept, the rightmost of equal ones, with its position. Two texts that share ``K + WINDOW - 1`` code
points therefore share a kept hash there, and no match shorter than ``K`` counts.

Defined results: a null text is empty and has no fingerprint; a text shorter than K has its one hash at 0; two
empty fingerprints are alike (1), an empty and another are not (0). The next document of the last is the first, of
a single row itself; rows that repeat an id follow each other by text; a null id comes last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandtide.llm.common import Powers, mix64, small_batches, table
from brandtide.llm.ranges import with_range

K, WINDOW, BASE = 20, 30, 0x2545F4914F6CDD1D
POSITIONS = 24  # bits; longer texts go through in blocks
BLOCK = 1 << 22


def winnow(text: str, powers: Powers, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes (40 bits) and their positions in code points, in order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = np.uint64((1 << POSITIONS) - 1)
    hashes, positions = [], []
    for start in range(0, max(1, len(codes) - k + 1), BLOCK):
        part = codes[start : start + BLOCK + k + window - 2]
        grams = powers.windows(part, min(k, len(part)))
        key = (mix64(grams) & ~low) | (low - np.arange(len(grams), dtype=np.uint64))  # equal hashes: the rightmost is least
        width, size = min(window, len(key)), 1
        while 2 * size <= width:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < width:
            key = np.minimum(key[: len(key) - (width - size)], key[width - size :])
        kept = key[np.concatenate([[True], key[1:] != key[:-1]])]
        hashes.append(kept >> np.uint64(POSITIONS))
        positions.append((low - (kept & low)).astype(np.int64) + start)
    hashes, positions = np.concatenate(hashes), np.concatenate(positions)
    new = np.concatenate([[True], positions[1:] != positions[:-1]])  # blocks share their border window
    return hashes[new], positions[new]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes, sorted and distinct."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    return f"{len(hashes)}:{hashlib.sha256(hashes.astype('<u8').tobytes() + positions.astype('<i8').tobytes()).hexdigest()[:40]}"


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, hashes and positions for rows with doc_id and text."""

    def run(batches):
        powers = Powers(BASE)
        for b in batches:
            found = [winnow(t or "", powers) for t in b["text"].to_pylist()]
            yield pa.record_batch([b["doc_id"], pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())), pa.array([p for _, p in found], pa.list_(pa.int64()))], names=["doc_id", "hashes", "positions"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare(batches):
    """Rows by range, in order; the last row of a range is a copy of the next range's first (kind 1)."""
    powers, prev, at = Powers(BASE), None, None
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    for b in batches:
        out = []
        for number, kind, doc_id, text in zip(*(b[c].to_pylist() for c in ("range", "kind", "doc_id", "text"))):
            text = text or ""
            hashes, positions = winnow(text, powers)
            now = (doc_id, text, digest(hashes, positions), np.unique(hashes))
            if prev is not None and number == at:
                old_id, old, old_digest, old_set = prev
                half = len(old) // 2
                edited = old[: len(old) - half] + text[:half]
                h, p = winnow(edited, powers)
                out.append((old_id, len(old), hashlib.sha256(edited.encode()).hexdigest(), old_digest, digest(h, p), likeness(old_set, np.unique(h)), likeness(old_set, now[3])))
            prev, at = (None, None) if kind else (now, number)
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in OUT.split(", ")])


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text (the query's contract)."""
    rows = with_range(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    place = F.coalesce("doc_id", F.lit((1 << 63) - 1))  # null ids come last
    least = [(r["range"], r["least"]) for r in rows.groupBy("range").agg(F.min(place).alias("least")).orderBy("range").collect()]  # a row for each range
    if not least:
        return rows.limit(0).mapInArrow(compare, OUT)
    before = {number: least[i - 1][0] for i, (number, _) in enumerate(least)}  # the first range follows the last
    heads = docs.sparkSession.createDataFrame([(number, first, before[number]) for number, first in least], "range int, least long, to_range int")
    first = rows.join(F.broadcast(heads), (rows["range"] == heads["range"]) & (place == F.col("least"))).groupBy("to_range").agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), "doc_id")).alias("x"))
    both = rows.select("range", F.lit(0).alias("kind"), "doc_id", "text").unionByName(first.select(F.col("to_range").alias("range"), F.lit(1).alias("kind"), "x.doc_id", "x.text"))
    return both.repartition("range").sortWithinPartitions("range", "kind", F.col("doc_id").asc_nulls_last(), F.coalesce("text", F.lit(""))).mapInArrow(compare, OUT)


def op5_fingerprints(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return with_next(table(spark, sf_dir, "documents"))
