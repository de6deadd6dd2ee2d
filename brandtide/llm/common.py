"""Helpers that the corpus operators share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
#: Rows of a table that may be broadcast: some tens of MB at most for the narrow tables here.
BROADCAST_ROWS = 200_000
#: Bytes of text that one numpy pass handles.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Whole texts can be long: hand Python workers fewer rows and bytes at a time (for the rest of the session)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null and empty texts."""
    parts = F.size(F.split(text, f"{SPACE}+", -1))
    edges = F.when(text.rlike(f"^{SPACE}"), 1).otherwise(0) + F.when(F.right(text, F.lit(1)).rlike(SPACE), 1).otherwise(0)
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(parts - edges).cast("long")


def with_small(left: DataFrame, small: DataFrame, on, how: str, rows: int) -> DataFrame:
    """Join a side of so many rows: broadcast if it has few, else shuffled (adaptive execution splits hot keys)."""
    return left.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, on, how)


def text_slices(ids: pa.Array, texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Consecutive rows as (ids, UTF-8 bytes, offsets), about ``most`` bytes at a time and at least one row; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    ids = ids.to_pylist()
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield ids[i:j], data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (fixed constants), on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd multiplier and of its inverse modulo 2**64, extended as needed."""

    def __init__(self, base: int):
        self.base, self.inv = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 12)
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (self.base, self.inv))

    def windows(self, values: np.ndarray, width: int) -> np.ndarray:
        """Polynomial hash of every run of ``width`` values, by prefix sums."""
        n = len(values) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        self.grow(len(values) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[: len(values)], dtype=np.uint64)])
        return (sums[width:] - sums[:n]) * self.down[:n]


#: Of each block of eight bytes, the first 0 to 8.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes from which on a run is hashed by BLAKE2b.
LONG_RUN = 64


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end].

    Blocks of eight bytes are mixed with their place before they are added up, so that no arrangement of letters
    makes sums agree as it does for polynomials modulo 2**64; runs of at most eight bytes and equal length never
    collide. Longer runs than ``LONG_RUN`` get a keyed BLAKE2b hash.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # eight bytes from each place on
    sizes = ends - starts
    salt = mix64(np.uint64(seed) + np.arange(LONG_RUN // 8 + 2, dtype=np.uint64))
    out = mix64((blocks[starts] & _MASKS[np.minimum(sizes, 8)]) ^ salt[0])
    more = np.flatnonzero((sizes > 8) & (sizes <= LONG_RUN))
    for k in range(1, LONG_RUN // 8):
        if not len(more):
            break
        out[more] += mix64((blocks[starts[more] + 8 * k] & _MASKS[np.minimum(sizes[more] - 8 * k, 8)]) ^ salt[k])
        more = more[sizes[more] > 8 * (k + 1)]
    out = mix64(out + sizes.astype(np.uint64) * salt[-1])
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(sizes > LONG_RUN).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out


def bounds(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of true values; no run crosses an offset."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] |= mask[inner]
    last[inner - 1] |= mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray, seed: int, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space: 64-bit hashes, byte starts and ends, and the first word of each row (rows + 1 entries)."""
    starts, ends = bounds(~((data == 32) | ((data >= 9) & (data <= 13))), offsets)
    if lower:
        data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << np.uint8(5))
    return run_hashes(data, starts, ends, seed), starts, ends, np.searchsorted(starts, offsets)


class HashIndex:
    """Positions of 64-bit keys, looked up many at a time (open addressing, linear probing)."""

    def __init__(self, keys: np.ndarray):
        size = 1 << max(4, int(2.5 * len(keys)).bit_length())
        self.mask, self.keys, self.at = np.uint64(size - 1), np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        todo, step = np.arange(len(keys), dtype=np.int32), 0
        while len(todo):
            slot = ((keys[todo] + np.uint64(step)) & self.mask).astype(np.int64)
            free = self.at[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.at[slot[won]], self.keys[slot[won]] = todo[won], keys[todo[won]]
            todo, step = np.delete(todo, won), step + 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 if absent."""
        out, todo, step = np.full(len(keys), -1, np.int32), np.arange(len(keys)), 0
        while len(todo):
            slot = ((keys[todo] + np.uint64(step)) & self.mask).astype(np.int64)
            at, hit = self.at[slot], self.keys[slot] == keys[todo]
            out[todo[hit & (at >= 0)]] = at[hit & (at >= 0)]
            todo, step = todo[(at >= 0) & ~hit], step + 1
        return out
