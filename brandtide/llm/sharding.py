"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

How many rows each input partition sends to each shard is drawn first, from the multivariate
hypergeometric law that a uniform permutation of all rows follows; the matrix has exact row and column
sums, and executors draw it by halving the partitions from a seed for each half. Each partition then permutes its rows and deals them out by its row of the matrix, rows go to
their shards, and each shard permutes what it got. Slots come from counts of hash ranges within a
shard, so that a shard of any size is ordered by many tasks.

Defined results: null texts have 8 bytes and crc32 0; repeated rows are rows of their own; an empty table
gives an empty result; with fewer rows than shards the last shards stay empty.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brandtide.llm.common import table, with_small
from brandtide.runtime import scratch, staged

#: Rows that one task orders within a shard, about.
RANGE_ROWS = 500_000
#: numpy draws from fewer than 10**9 rows.
NUMPY_ROWS = 900_000_000
#: Partitions whose rows of the matrix one task draws.
PARTS = 4096


def _large_hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """By inversion outwards from the mode, for populations beyond numpy's range."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    log = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    up = down = math.exp(log(good, mode) + log(bad, n - mode) - log(good + bad, n))
    left, i, j = rng.random() - up, mode, mode
    while left > 0 and (i > low or j < high):
        if j < high:
            up *= (good - j) * (n - j) / ((j + 1) * (bad - n + j + 1))
            j += 1
            left -= up
            if left <= 0:
                return j
        if i > low:
            down *= i * (bad - n + i) / ((good - i + 1) * (n - i + 1))
            i -= 1
            left -= down
            if left <= 0:
                return i
        if up + down < 1e-300:
            break
    return mode


def _split(rng: np.random.Generator, shards: np.ndarray, n: int) -> np.ndarray:
    """How many of each shard's open places n rows take, drawn at random."""
    if int(shards.sum()) < NUMPY_ROWS:
        return rng.multivariate_hypergeometric(shards, n, method="marginals")
    out, rest = np.zeros(len(shards), np.int64), int(shards.sum())
    for s, good in enumerate(shards.tolist()):
        rest -= good
        out[s] = _large_hypergeometric(rng, good, rest, n) if n else 0
        n -= int(out[s])
    return out


def matrix_rows(counts: np.ndarray, n_shards: int, seed: int, start: int = 0, stop: int | None = None):
    """(partition, rows for each shard) of the communication matrix for partitions start to stop.

    Exact row sums ``counts``, column sums at most one apart. A tree halves the partitions; the draw at each of its
    nodes has a seed of its own, so that any task can draw its rows of the matrix from the counts alone.
    """
    sums, total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]), int(counts.sum())
    stop = len(counts) if stop is None else stop
    todo = [(0, len(counts), np.array([total // n_shards + (s < total % n_shards) for s in range(n_shards)], np.int64))]
    while todo:
        low, high, shards = todo.pop()
        if high <= start or low >= stop or low == high:
            continue
        if high - low == 1:
            yield low, shards
            continue
        middle = (low + high) // 2
        left = _split(np.random.default_rng((seed, low, high)), shards, int(sums[middle] - sums[low]))
        todo += [(middle, high, shards - left), (low, middle, left)]


def communication_matrix(spark: SparkSession, counts: list[tuple[int, int]], n_shards: int, seed: int) -> DataFrame:
    """part and ends (running sums of what it sends to each shard) of (part, rows), drawn on executors."""
    parts, n = np.array([p for p, _ in counts], np.int32), np.array([x for _, x in counts], np.int64)
    shared = spark.sparkContext.broadcast((parts, n))  # two numbers for each partition

    def draw(batches):
        parts, n = shared.value
        for b in batches:
            rows = [x for k in b["id"].to_pylist() for x in matrix_rows(n, n_shards, seed, k * PARTS, min(len(n), (k + 1) * PARTS))]
            yield pa.record_batch([pa.array(parts[[p for p, _ in rows]], pa.int32()), pa.array([r.cumsum() for _, r in rows], pa.list_(pa.int64()))], names=["part", "ends"])

    blocks = -(-len(counts) // PARTS)
    return staged(spark.range(0, blocks, 1, max(1, blocks)).mapInArrow(draw, "part int, ends array<bigint>"), "shard-matrix")


def shuffle_into_shards(rows: DataFrame, n_shards: int, seed: int = 11) -> DataFrame:
    """``rows`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 within a shard), uniformly shuffled."""
    spark = rows.sparkSession
    with scratch(spark) as keep:
        row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
        held = staged(rows.select(row, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos")), "shard-rows")
        counts = sorted((r["part"], r["count"]) for r in held.groupBy("part").count().collect())  # a row for each partition
        ends = communication_matrix(spark, counts, n_shards, seed)
        local = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "pos"), "pos"))
        dealt = with_small(held.withColumn("turn", local), ends, "part", "inner", len(counts))
        dealt = dealt.select("row", "pos", F.size(F.filter("ends", lambda e: e < F.col("turn"))).alias("shard"), F.xxhash64(F.lit(seed + 1), "pos").alias("place"))
        bits = max(3, math.ceil(math.log2(max(1, sum(n for _, n in counts) / n_shards / RANGE_ROWS))))
        dealt = keep(staged(dealt.withColumn("range", F.shiftrightunsigned("place", 64 - bits)), "shard-dealt"))
    starts = dealt.groupBy("shard", "range").count().select("shard", "range", (F.sum("count").over(Window.partitionBy("shard").orderBy("range")) - F.col("count")).alias("start"))
    slot = F.col("start") + F.row_number().over(Window.partitionBy("shard", "range").orderBy("place", "pos")) - 1
    return with_small(dealt, starts, ["shard", "range"], "inner", n_shards << bits).select("row.*", "shard", slot.cast("long").alias("slot"))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return shuffle_into_shards(slim, 24).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
