"""Substring dedup: words covered by a run of ``WINDOW`` words that also starts in a document of smaller id go.

First pass: every partition counts its windows, once a document, in count-min sketches of ``ROWS`` rows whose counters
stop at two; partitions send the positions of their ones and twos by slice, as gaps of a byte or so, and slices are
merged, so that the merged sketch never counts a window too low. The flags "twice or more", of a bounded size, are broadcast. Second pass: windows
that the sketch takes for repeated, and no others, are grouped exactly (by 96 bits of two hashes). Partitions cut their
documents into chunks; a chunk asks each hash bucket about its distinct windows once, with the smallest id that has
them here, and gets one bit for each: whether a smaller id exists elsewhere. So a window that a third of all documents
share costs an entry for each chunk, not for each document. A third pass cuts the same chunks again, which is cheaper
than to keep them, and applies the answers; a checksum of each chunk guards against an input that changed meanwhile.

With more text than the largest sketch is made for, more windows pass for repeated and the second pass grows; results
stay the same. Two different windows agree in 96 bits with chance 2**-96, or 2**-64 if they differ in one word alone.

The input is read three times and must have the same partitions each time, as a table of files has; write others first.

Defined results: null and empty texts have no words; windows never cross documents; a window repeated only within a
document stays; rows that repeat an id are judged apart, and neither counts as smaller; a row with a null id keeps all
its words and is no reason to remove others'; equal texts keep their words under the smallest id.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandtide.llm.common import BROADCAST_ROWS, Powers, mix64, small_batches, table, text_slices, words
from brandtide.runtime import scratch, staged

WINDOW, ROWS = 13, 2
#: Counters of the sketch by window of the corpus, at most; their flags take an eighth of that in bytes.
CELLS_EACH, CELLS = 4, 1 << 29
SLICE = 1 << 22
#: Windows that a partition gathers before it sends them on.
GATHER, CHUNK = 3_000_000, 1_000_000
#: Windows of the corpus for each bucket of the second pass, at most half as many on average if all of them pass.
BUCKET = 1 << 21
WORD_SEED, FIRST_BASE, SECOND_BASE = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3
#: Bytes of removal ranges that may be broadcast.
BROADCAST_BYTES = 32 << 20


def pack(array: np.ndarray) -> bytes:
    return pa.compress(array.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def gaps(at: np.ndarray, start: int) -> bytes:
    """Ascending positions as differences in base 255, 255 meaning that the number goes on."""
    steps = np.diff(at, prepend=start)
    ends = np.cumsum(steps // 255 + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = steps % 255
    return pa.compress(out.tobytes(), codec="zstd", asbytes=True) + len(out).to_bytes(4, "little")


def positions(blob: bytes, start: int) -> np.ndarray:
    steps = np.frombuffer(pa.decompress(blob[:-4], int.from_bytes(blob[-4:], "little"), codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255] + start


def cells(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    """Counters of the hashes in a row of ``width`` (below 2**32)."""
    own = mix64(hashes + np.uint64((row + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return (own >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)


class Windows:
    """Window hashes of rows of text."""

    def __init__(self, width: int = WINDOW):
        self.width, self.first, self.second = width, Powers(FIRST_BASE), Powers(SECOND_BASE)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes and each row's first word; window hashes, each window's row and its first word within the row."""
        hashes, _, _, first = words(data, offsets, WORD_SEED)
        counts = np.maximum(0, np.diff(first) - self.width + 1)
        row = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        return hashes, first, mix64(self.first.windows(hashes, self.width))[first[row] + inside] if len(row) else np.zeros(0, np.uint64), row, inside

    def again(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A second, independent hash of the windows that start at the given words."""
        return mix64(self.second.windows(mix64(hashes ^ np.uint64(0xD6E8FEB86659FD93)), self.width)[at]).astype(np.uint32) if len(at) else np.zeros(0, np.uint32)


def sketch(rows: int, width: int, window: int):
    def run(batches):
        windows, held, size = Windows(window), [], 0

        def send():
            hashes = np.concatenate(held)
            held.clear()
            for row in range(rows):
                at = np.sort(cells(hashes, row, width)).astype(np.int64)
                new = np.concatenate([[True], at[1:] != at[:-1]])
                once, twice = at[new], np.unique(at[~new])
                cuts = np.append(np.arange(0, width, SLICE), width)
                a, b = np.searchsorted(once, cuts), np.searchsorted(twice, cuts)
                used = [i for i in range(len(cuts) - 1) if a[i + 1] > a[i]]
                yield pa.record_batch(
                    [pa.array([row] * len(used), pa.int32()), pa.array(used, pa.int32()), pa.array([gaps(once[a[i] : a[i + 1]], cuts[i]) for i in used], pa.binary()), pa.array([gaps(twice[b[i] : b[i + 1]], cuts[i]) for i in used], pa.binary())],
                    names=["row", "slice", "once", "twice"],
                )

        for b in batches:
            for _, data, offs in text_slices(b["doc_id"], b["text"]):
                _, _, hashes, row, _ = windows.of(data, offs)
                if not len(hashes):
                    continue
                mixed = mix64(hashes + row.astype(np.uint64))  # once a document: neighbours in this order are equal in row and hash
                held.append(hashes[np.unique(mixed, return_index=True)[1]])
                size += len(held[-1])
                if size > GATHER:
                    yield from send()
                    size = 0
        if held:
            yield from send()

    return run


def merge(width: int):
    """Flags of counters at two or more, of all parts of a slice."""

    def run(batches):
        once, twice = {}, {}
        for b in batches:
            for row, part, x, y in zip(*(b[c].to_pylist() for c in ("row", "slice", "once", "twice"))):
                key = (row, part)
                if key not in once:
                    once[key], twice[key] = np.zeros(min(SLICE, width), bool), np.zeros(min(SLICE, width), bool)
                at = positions(x, 0)
                twice[key][at[once[key][at]]] = True
                once[key][at] = True
                twice[key][positions(y, 0)] = True
        for (row, part), flags in twice.items():
            yield pa.record_batch([pa.array([row], pa.int32()), pa.array([part], pa.int32()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())], names=["row", "slice", "flags"])

    return run


def asked(width: int, bits: int, window: int, flags, kind: int):
    """Chunks' questions to buckets (kind 0), or what their answers are applied to (kind 1)."""

    def run(batches):
        windows, partition, number = Windows(window), TaskContext.get().partitionId(), 0
        bit = lambda table_, at: table_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
        docs, found, size = [], [], 0
        low = 64 - bits  # bits of a first hash that its bucket doesn't tell
        n_bytes = -(-low // 8)

        def send():
            row, inside, k1, k2 = (np.concatenate(x) for x in zip(*found))
            found.clear()
            ids = np.array([d for d, _ in docs], np.int64)
            order = np.lexsort((k2, k1))
            new = np.concatenate([[True], (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])])
            starts = np.flatnonzero(new)
            least = np.minimum.reduceat(ids[row[order]], starts)
            u1, u2 = k1[order][starts], k2[order][starts]
            at, check = partition << 24 | number, zlib.crc32(u2.tobytes(), zlib.crc32(least.tobytes()))
            if kind == 0:
                used, cuts = np.unique(u1 >> np.uint64(low), return_index=True)
                used, cuts = used.astype(np.int64), np.append(cuts, len(u1))
                short = np.ascontiguousarray(u1.view(np.uint8).reshape(-1, 8)[:, :n_bytes])
                part = lambda x, i: x[cuts[i] : cuts[i + 1]].tobytes()
                n = len(used)
                yield pa.record_batch(
                    [pa.array([0] * n, pa.int32()), pa.array([at] * n, pa.int64()), pa.array([check] * n, pa.int64()), pa.array(used), pa.array(np.diff(cuts)), pa.array([part(short, i) + part(u2, i) for i in range(n)], pa.binary()), pa.array([pack(least[cuts[i] : cuts[i + 1]]) for i in range(n)], pa.binary()), *[pa.nulls(n, pa.binary())] * 2],
                    names=ASKED,
                )
                return
            which = np.empty(len(order), np.uint32)
            which[order] = np.cumsum(new) - 1
            keep, index = np.unique(row, return_inverse=True)
            mine = np.packbits(ids[row] > least[which])  # a smaller id is in this chunk
            fp = np.array([docs[i][1] for i in keep], np.int64)
            steps = np.concatenate([np.diff(index, prepend=0), np.diff(inside, prepend=0)]).astype(np.int32)
            yield pa.record_batch(
                [pa.array([1], pa.int32()), pa.array([at]), pa.array([check], pa.int64()), pa.array([-1], pa.int64()), pa.array([len(row)]), pa.array([np.concatenate([ids[keep], fp]).tobytes()], pa.binary()), pa.array([pack(steps)], pa.binary()), pa.array([pack(which)], pa.binary()), pa.array([mine.tobytes()], pa.binary())],
                names=ASKED,
            )

        for b in batches:
            b = b.filter(b["doc_id"].is_valid())
            fps = iter(b["fp"].to_pylist())
            for ids, data, offs in text_slices(b["doc_id"], b["text"]):
                base = len(docs)
                docs += [(d, next(fps)) for d in ids]
                hashes, first, k1, row, inside = windows.of(data, offs)
                if not len(k1):
                    continue
                likely = np.ones(len(k1), bool)
                for r, table_ in enumerate(flags.value):
                    likely &= bit(table_, cells(k1, r, width)).astype(bool)
                at = np.flatnonzero(likely)
                if len(at):
                    found.append((row[at] + base, inside[at], k1[at], windows.again(hashes, first[row[at]] + inside[at])))
                    size += len(at)
                if size > CHUNK:
                    yield from send()
                    docs, size, number = [], 0, number + 1
        if found:
            yield from send()

    return run


ASKED = ["kind", "chunk", "check", "bucket", "n", "keys", "ids", "which", "mine"]
ASKED_TYPE = "kind int, chunk long, check long, bucket long, n long, keys binary, ids binary, which binary, mine binary"


def answerer(bits: int):
    n_bytes = -(-(64 - bits) // 8)

    def answered(t: pa.Table) -> pa.Table:
        """One bit for each entry of each chunk's question: a smaller id has the window elsewhere."""
        sizes = t["n"].to_pylist()
        k1 = np.zeros((sum(sizes), 8), np.uint8)  # what all entries of a bucket share is left out
        k1[:, :n_bytes] = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8, n_bytes * n) for x, n in zip(t["keys"], sizes)]).reshape(-1, n_bytes)
        k1 = k1.view("<u8")[:, 0]
        k2 = np.concatenate([np.frombuffer(x.as_buffer(), "<u4", n, n_bytes * n) for x, n in zip(t["keys"], sizes)])
        ids = np.concatenate([unpack(x, "<i8", n) for x, n in zip(t["ids"].to_pylist(), sizes)])
        order = np.lexsort((k2, k1))
        new = np.concatenate([[True], (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])])
        least = np.empty(len(ids), np.int64)
        least[order] = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        bits_ = np.split(least < ids, np.cumsum(sizes)[:-1])
        return pa.table([pa.array([2] * len(bits_), pa.int32()), t["chunk"], t["check"], t["bucket"], t["n"], pa.array([np.packbits(x).tobytes() for x in bits_], pa.binary()), *[pa.nulls(len(bits_), pa.binary())] * 3], names=ASKED)

    return answered


def resolver(window: int):
    def resolve(own: pa.Table, rest: pa.Table) -> pa.Table:
        """Ranges of words to remove, by document of a chunk."""
        if len(own) != 1 or {*own["check"].to_pylist()} != {*rest["check"].to_pylist()}:
            raise ValueError("the documents changed between two passes")
        rest, n = rest.sort_by("bucket"), own["n"][0].as_py()
        elsewhere = np.concatenate([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=k).astype(bool) for x, k in zip(rest["keys"], rest["n"].to_pylist())])
        ids = np.frombuffer(own["keys"][0].as_buffer(), "<i8")
        ids, fp = ids[: len(ids) // 2], ids[len(ids) // 2 :]
        index, inside = (np.cumsum(x, dtype=np.int64) for x in np.split(unpack(own["ids"][0].as_py(), "<i4", 2 * n), 2))
        mine = np.unpackbits(np.frombuffer(own["mine"][0].as_buffer(), np.uint8), count=n).astype(bool)
        gone = np.flatnonzero(mine | elsewhere[unpack(own["which"][0].as_py(), "<u4", n)])
        index, inside = index[gone], inside[gone]  # ascending in both
        first = np.concatenate([[True], (index[1:] != index[:-1]) | (inside[1:] > inside[:-1] + window)]) if len(gone) else np.zeros(0, bool)
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(gone))[: len(starts)] - 1
        docs, cut = np.unique(index[starts], return_index=True)
        offsets = pa.array(np.append(cut, len(starts)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (inside[starts], inside[ends] + window)]
        return pa.table([pa.array(ids[docs]), pa.array(fp[docs]), *lists], names=["doc_id", "fp", "starts", "ends"])

    return resolve


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Staged doc_id, fp, starts, ends: ranges of words to remove. ``docs`` has doc_id, text and fp."""
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    windows = max(1, n_bytes // 6)
    width = -(-max(1 << 12, min(CELLS, CELLS_EACH * windows) // ROWS) // 64) * 64
    parts = docs.select("doc_id", "text").mapInArrow(sketch(ROWS, width, window), "row int, slice int, once binary, twice binary")
    table_ = np.zeros((ROWS, width // 8), np.uint8)
    for r in parts.repartition("row", "slice").mapInArrow(merge(width), "row int, slice int, flags binary").toLocalIterator():  # CELLS / 8 bytes at most
        start = r["slice"] * SLICE // 8
        own = np.frombuffer(r["flags"], np.uint8)[: width // 8 - start]
        table_[r["row"], start : start + len(own)] = own
    flags = spark.sparkContext.broadcast(table_)
    bits = max(4, (windows // BUCKET).bit_length())
    chunks = lambda kind: docs.select("doc_id", "text", "fp").mapInArrow(asked(width, bits, window, flags, kind), ASKED_TYPE)
    answers = staged(chunks(0).groupBy("bucket").applyInArrow(answerer(bits), ASKED_TYPE), "window-answers")
    # Not a union, in which partitions have other numbers.
    ranges = staged(chunks(1).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(resolver(window), "doc_id long, fp long, starts array<int>, ends array<int>").dropDuplicates(["doc_id", "fp"]), "window-ranges")
    flags.unpersist()
    return ranges


def cut(batches):
    """Kept words of each row, joined by one space."""
    for b in batches:
        n_words, n_removed, kept = [], [], []
        for text, starts, ends in zip(*(b[c].to_pylist() for c in ("text", "starts", "ends"))):
            parts = (text or "").encode().split()  # at ASCII white space
            n = len(parts)
            for x, y in zip(reversed(starts or ()), reversed(ends or ())):
                del parts[x:y]
            n_words.append(n)
            n_removed.append(n - len(parts))
            kept.append(b" ".join(parts))
        yield pa.record_batch([b["doc_id"], b["fp"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array([k.decode() for k in kept], pa.string())], names=["doc_id", "fp", "n_words", "n_removed", "kept_sha256", "kept"])


CUT = "doc_id long, fp long, n_words long, n_removed long, kept_sha256 string, kept string"


def with_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (doc_id, text, fp and whatever else) with starts and ends."""
    with scratch(docs.sparkSession) as keep:
        ranges = keep(removals(docs.select("doc_id", "text", "fp"), window))
    rows, size = ranges.agg(F.count("*"), F.sum(48 + 8 * F.size("starts"))).first()
    small = rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES
    return docs.join(F.broadcast(ranges) if small else ranges, ["doc_id", "fp"], "left")


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept text of each row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("fp"))
    return with_ranges(own).select("doc_id", "fp", "text", "starts", "ends").mapInArrow(cut, CUT)


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def replacer(columns: list[str]):
    def replace(batches):
        for b in batches:
            arrays, starts = dict(zip(columns, b["row"].flatten())), b["starts"].to_pylist()
            text, lengths = arrays["text"].to_pylist(), arrays["n_chars"].to_pylist() if "n_chars" in columns else None
            for i, (x, y) in enumerate(zip(starts, b["ends"].to_pylist())):
                if x:
                    parts = text[i].encode().split()
                    for u, v in zip(reversed(x), reversed(y)):
                        del parts[u:v]
                    text[i] = b" ".join(parts).decode()
                    if lengths is not None:
                        lengths[i] = len(text[i])
            arrays["text"] = pa.array(text, arrays["text"].type)
            if lengths is not None:
                arrays["n_chars"] = pa.array(lengths, arrays["n_chars"].type)
            yield pa.record_batch(list(arrays.values()), names=columns)

    return replace


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with what repeats cut from the text (and ``n_chars``, if there, to match); other texts stay as they are."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("fp"))
    return with_ranges(keyed).select("row", "starts", "ends").mapInArrow(replacer(docs.columns), docs.schema)
