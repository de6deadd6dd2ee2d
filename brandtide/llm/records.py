"""Token ids in files of length-delimited binary records.

A record is its length (8 bytes), the masked CRC-32C of those bytes, the data, and the masked CRC-32C of the data,
all little-endian: the framing that TFRecord readers know. Data are the ids as unsigned 16-bit integers (32-bit if
the vocabulary is larger). Beside each file lies an index of 24 bytes a record: id, offset in the file and number of
ids, for reads in any order. Files go by ranges of ids in ascending order, into the shared folder; each attempt of a
task writes files of its own, and only those of the attempt that Spark counts enter the manifest.

Tokenizing: texts are split into the pieces that byte-level BPE encodes one by one (the tokenizer's own pattern, by
character classes in numpy); the tokenizers library encodes each distinct piece of a task once. Texts with English
contractions or a special token's string, where that split could differ, go to the library whole.

Defined results: null and empty texts have the end id alone; rows that repeat an id follow each other by text; a null
id comes last and is stored as -1 with a flag; an empty table gives no file and an empty result.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brandtide.llm.common import run_hashes, small_batches, table
from brandtide.llm.ranges import with_range
from brandtide.runtime import new_path, staged

END = 2
#: Distinct pieces that a task keeps at most before it starts anew.
PIECES = 400_000
KNOWN = 0x3000
SEED = 0x6C8E9CF570932BD5
# The code points that are white space to the pattern.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
ODD = re.compile(r"'(?:[stmd]|re|ve|ll)|<\|")


def kind_of(code: int) -> int:
    major = unicodedata.category(chr(code))[0]
    return SPACE if code in WHITE else LETTER if major == "L" else NUMBER if major == "N" else OTHER


class Pieces:
    """Ids of texts, each distinct piece encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.split = Tokenizer.from_file(path)  # for texts that are split already
        self.split.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.kinds = np.array([kind_of(c) for c in range(KNOWN)], np.uint8)
        self.clear()

    def clear(self) -> None:
        """Forget all pieces: keys in ascending order, where the ids of each begin, how many, and all ids."""
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions of known keys, -1 for others."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, at, -1) if len(self.keys) else np.full(len(keys), -1)

    def add(self, keys: np.ndarray, pieces: list[str]) -> None:
        begin, size = [self.begin], [self.size]
        for some in range(0, len(pieces), 20_000):
            part = pieces[some : some + 20_000]
            found = self.split.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids, lengths = np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids), minlength=len(part))
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used : self.used + len(ids)] = ids
            begin.append(self.used + np.cumsum(lengths) - lengths)
            size.append(lengths)
            self.used += len(ids)
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys, self.begin, self.size = keys[order], np.concatenate(begin)[order], np.concatenate(size)[order]

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(t) for t in texts])
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        kinds = self.kinds[np.minimum(codes, KNOWN - 1)]
        if len(high := np.flatnonzero(codes >= KNOWN)):
            which, back = np.unique(codes[high], return_inverse=True)
            kinds[high] = np.array([kind_of(int(c)) for c in which], np.uint8)[back]
        text_starts = np.cumsum(sizes) - sizes
        start = np.concatenate([[True], kinds[1:] != kinds[:-1]])
        start[text_starts[text_starts < len(codes)]] = True
        # The last of some white space before other characters is a piece, or the head of theirs if it is a blank.
        last = np.zeros(len(codes), bool)
        last[:-1] = (kinds[:-1] == SPACE) & (kinds[1:] != SPACE)
        last[text_starts[(text_starts > 0) & (text_starts < len(codes))] - 1] = False
        at = np.flatnonzero(last)
        start[at] = True
        start[at[codes[at] == 32] + 1] = False
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(codes))
        top = int(codes.max())
        width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4  # bytes that tell each character
        hashes = run_hashes(codes.astype(f"<u{width}").view(np.uint8), width * starts, width * ends, SEED + width)
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > PIECES:
            self.clear()
        new = np.flatnonzero(self.find(keys) < 0)
        if len(new):
            at = first[new]
            self.add(keys[new], [joined[x:y] for x, y in zip(starts[at].tolist(), ends[at].tolist())])
        where = self.find(keys)[back]
        begin, lengths = self.begin[where], self.size[where]
        stops = np.cumsum(lengths)
        ids = self.flat[np.repeat(begin - (stops - lengths), lengths) + np.arange(stops[-1])]
        owner = np.searchsorted(text_starts, starts, "right") - 1
        owner = np.maximum.accumulate(owner)
        return ids, np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        odd = [i for i, t in enumerate(texts) if ODD.search(t)]
        for i in odd:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        rest = [i for i in range(len(texts)) if out[i] is None]
        while rest:
            n, size = 0, 0
            while n < len(rest) and (not n or size + len(texts[rest[n]]) <= 1 << 21):
                size += len(texts[rest[n]])
                n += 1
            ids, counts = self.plain([texts[i] for i in rest[:n]])
            for i, part in zip(rest[:n], np.split(ids, np.cumsum(counts)[:-1])):
                out[i] = part
            rest = rest[n:]
        return out


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-32C tables by byte and by pair of bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0x82F63B78), one >> 1)
    pair = np.arange(65536, dtype=np.uint32)
    for _ in range(2):
        pair = one[pair & 255] ^ (pair >> 8)
    return one, pair


CHUNK = 256


class Crc32c:
    """CRC-32C of many byte strings at once: all chunks in parallel, then folded by string."""

    def __init__(self):
        self.one, self.pair = _crc_tables()
        unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
        for _ in range(CHUNK):
            unit = self.one[unit & 255] ^ (unit >> 8)
        self.shift = []  # a register after CHUNK zero bytes, by each of its own bytes
        for part in range(4):
            row = np.zeros(256, np.uint32)
            for bit in range(8):
                row[np.arange(256) >> bit & 1 == 1] ^= unit[8 * part + bit]
            self.shift.append(row)

    def of(self, parts: list[bytes]) -> np.ndarray:
        if not parts:
            return np.zeros(0, np.uint32)
        out = np.zeros(len(parts), np.uint32)
        short = [i for i, p in enumerate(parts) if len(p) < 4]
        for i in short:
            crc = 0xFFFFFFFF
            for byte in parts[i]:
                crc = int(self.one[(crc ^ byte) & 255]) ^ crc >> 8
            out[i] = crc ^ 0xFFFFFFFF
        rest = [i for i in range(len(parts)) if len(parts[i]) >= 4]
        if not rest:
            return out
        chunks = np.array([-(-len(parts[i]) // CHUNK) for i in rest])
        buffer, first = np.zeros(int(chunks.sum()) * CHUNK, np.uint8), np.cumsum(chunks) - chunks
        for i, c, f in zip(rest, chunks, first):  # zeros in front leave a zero register; the start value is in the first four bytes
            p, stop = np.frombuffer(parts[i], np.uint8), (f + c) * CHUNK
            buffer[stop - len(p) : stop] = p
            buffer[stop - len(p) : stop - len(p) + 4] ^= 255
        columns = np.ascontiguousarray(buffer.view("<u2").reshape(-1, CHUNK // 2).T)
        crc = np.zeros(columns.shape[1], np.uint32)
        for column in columns:
            crc = self.pair[(crc ^ column) & 0xFFFF] ^ (crc >> 16)
        total, order = np.zeros(len(rest), np.uint32), np.argsort(-chunks, kind="stable")
        counts = -chunks[order]
        for step in range(int(chunks.max())):
            active = order[: np.searchsorted(counts, -step)]
            r = total[active]
            total[active] = self.shift[0][r & 255] ^ self.shift[1][r >> 8 & 255] ^ self.shift[2][r >> 16 & 255] ^ self.shift[3][r >> 24] ^ crc[first[active] + step]
        out[rest] = total ^ np.uint32(0xFFFFFFFF)
        return out

    def masked(self, parts: list[bytes]) -> np.ndarray:
        crc = self.of(parts)
        return ((crc >> 15) | (crc << 17)) + np.uint32(0xA282EAD8)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<i8"), ("n", "<u4"), ("null", "<u4")])
MANIFEST = "range int, path string, n_docs long, n_tokens long"


def writer(base: str, tokenizer_path: str, wide: bool, end_id: int):
    def write(batches):
        pieces, crc, at, out, entries = Pieces(tokenizer_path), Crc32c(), None, None, []
        filesystem, root = _open(base)
        filesystem.create_dir(root, recursive=True)

        def close():
            out.close()
            index = np.concatenate(entries)
            with filesystem.open_output_stream(f"{root}/{name}.index") as f:
                f.write(index.tobytes())
            return pa.record_batch([pa.array([at], pa.int32()), pa.array([name]), pa.array([len(index)]), pa.array([int(index["n"].sum())], pa.int64())], names=["range", "path", "n_docs", "n_tokens"])

        for b in batches:
            numbers = np.array(b["range"].to_pylist())
            for number in dict.fromkeys(numbers.tolist()):
                if number != at:
                    if out is not None:
                        yield close()
                    at, name, entries, offset = number, f"ids-{number:06d}-{uuid.uuid4().hex}.rec", [], 0
                    out = filesystem.open_output_stream(f"{root}/{name}")
                rows = np.flatnonzero(numbers == number)
                doc_ids = b["doc_id"].take(pa.array(rows)).to_pylist()
                texts = [t or "" for t in b["text"].take(pa.array(rows)).to_pylist()]
                ids = [np.append(x, np.uint32(end_id)) for x in pieces.encode(texts)]
                data = [x.astype("<u4" if wide else "<u2").tobytes() for x in ids]
                lengths = [len(d).to_bytes(8, "little") for d in data]
                heads, bodies = crc.masked(lengths).astype("<u4"), crc.masked(data).astype("<u4")
                sizes = np.array([len(d) + 16 for d in data])
                index = np.zeros(len(data), INDEX)
                index["doc_id"], index["null"] = [-1 if x is None else x for x in doc_ids], [x is None for x in doc_ids]
                index["offset"], index["n"] = offset + np.cumsum(sizes) - sizes, [len(x) for x in ids]
                entries.append(index)
                offset += int(sizes.sum())
                out.write(b"".join(x for n, h, d, c in zip(lengths, heads, data, bodies) for x in (n, h.tobytes(), d, c.tobytes())))
        if out is not None:
            yield close()

    return write


def write_records(docs: DataFrame, tokenizer_path: str, end_id: int = END) -> tuple[DataFrame, str]:
    """Files of all texts under a folder, and their manifest with each file's first position (start)."""
    from tokenizers import Tokenizer

    wide = Tokenizer.from_file(tokenizer_path).get_vocab_size() > 65536
    base = new_path(docs.sparkSession, "records")
    rows = with_range(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = rows.repartition("range").sortWithinPartitions("range", F.col("doc_id").asc_nulls_last(), F.coalesce("text", F.lit("")))
    manifest = staged(rows.mapInArrow(writer(base, tokenizer_path, wide, end_id), MANIFEST), "record-manifest")
    start = F.coalesce(F.sum("n_tokens").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each file
    return manifest.withColumn("start", start).withColumn("wide", F.lit(wide)), base


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def reader(base: str):
    def read(batches):
        filesystem, root = _open(base)
        crc = Crc32c()
        for b in batches:
            for path, start, wide in zip(*(b[c].to_pylist() for c in ("path", "start", "wide"))):
                with filesystem.open_input_stream(f"{root}/{path}.index") as f:
                    index = np.frombuffer(f.read(), INDEX)
                with filesystem.open_input_stream(f"{root}/{path}") as f:
                    for some in range(0, len(index), 512):
                        part, data, checks = index[some : some + 512], [], []
                        for n in part["n"]:
                            length = f.read(8)
                            size = int.from_bytes(length, "little")
                            head, body, tail = f.read(4), f.read(size), f.read(4)
                            if size != int(n) * (4 if wide else 2) or len(body) != size:
                                raise ValueError(f"{path}: a record's length differs from the index")
                            data.append(body)
                            checks.append((length, head, tail))
                        heads, bodies = crc.masked([x for x, _, _ in checks]), crc.masked(data)
                        if heads.astype("<u4").tobytes() != b"".join(x for _, x, _ in checks) or bodies.astype("<u4").tobytes() != b"".join(x for _, _, x in checks):
                            raise ValueError(f"{path}: a checksum is wrong")
                        ids = [zlib.crc32(np.frombuffer(d, "<u4" if wide else "<u2").astype("<u4").tobytes()) for d in data]
                        n = part["n"].astype(np.int64)
                        yield pa.record_batch([pa.array(part["doc_id"], mask=part["null"] == 1), pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array(ids, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(n.sum())

    return read


def read_records(manifest: DataFrame, base: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record, checksums verified."""
    files = max(1, manifest.count())
    return manifest.repartition(files, "range").mapInArrow(reader(base), READ)


def op7_records(spark, sf_dir: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    return read_records(*write_records(table(spark, sf_dir, "documents"), public_tokenizers.path(tokenizer)))
