"""Media columns of MPEG audio: write and read elementary streams held in a binary column.

Reading handles MPEG 1, 2 and 2.5, layers I to III: ID3v2 tags before and ID3v1 or APE tags behind the last frame, a
search for the next pair of matching headers wherever junk or damage breaks the chain, Xing/Info tables with
their LAME part and VBRI tables, CRC-16 of layer III headers and side information, the exact number of samples
and the offset of every frame. Free-format frames are not read: they count as junk.

Writing stores arbitrary bytes as a variable-bitrate layer III stream of digital silence, the bytes being each
frame's ancillary data after a two-byte length, with CRCs, a Xing table and an ID3v2 tag that holds the length.

The query raises an error if a payload is not as long as its tag says.

Defined results: null or empty media have no frame, no samples and an empty payload; equal bytes give equal
results; repeated rows are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandtide.llm.common import small_batches, table
from brandtide.runtime import staged

# Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by (MPEG 1 or not, layer), samples a second by version.
BITRATES = {
    (True, 1): [0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448],
    (True, 2): [0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384],
    (True, 3): [0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320],
    (False, 1): [0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256],
    (False, 2): [0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
    (False, 3): [0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
}
RATES = {3: [44100, 48000, 32000], 2: [22050, 24000, 16000], 0: [11025, 12000, 8000]}
PAD = 576
#: Header, CRC and side information of a stereo MPEG 1 layer III frame.
HEAD = 38
OWNER = b"payload\0"


def _crc_table() -> np.ndarray:
    table_ = np.arange(256, dtype=np.uint32) << 8
    for _ in range(8):
        table_ = np.where(table_ & 0x8000, (table_ << 1) ^ 0x8005, table_ << 1) & 0xFFFF
    return table_


CRC = _crc_table()


def crc16(rows: np.ndarray) -> np.ndarray:
    """CRC-16 (polynomial 8005, start FFFF) of each row of bytes."""
    crc = np.full(len(rows), 0xFFFF, np.uint32)
    for column in rows.T:
        crc = ((crc << 8) & 0xFF00) ^ CRC[(crc >> 8) ^ column]
    return crc


def header(word: bytes) -> tuple | None:
    """(version, layer, rate, bit rate, frame bytes, samples, crc present, side bytes) of four bytes, if they are a frame header."""
    if len(word) < 4 or word[0] != 255 or word[1] & 0xE0 != 0xE0:
        return None
    version, layer = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3)
    rate_index, bit_index = word[2] >> 2 & 3, word[2] >> 4
    if version == 1 or layer == 4 or rate_index == 3 or bit_index in (0, 15) or word[3] & 3 == 2:
        return None
    first = version == 3
    rate, kbit, pad = RATES[version][rate_index], BITRATES[first, layer][bit_index], word[2] >> 1 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or first else 576
    size = (12000 * kbit // rate + pad) * 4 if layer == 1 else samples // 8 * 1000 * kbit // rate + pad
    mono = word[3] >> 6 == 3
    side = 0 if layer < 3 else (17 if mono else 32) if first else (9 if mono else 17)
    return version, layer, rate, kbit, size, samples, not word[1] & 1, side


def _synchsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _vbr(frame: bytes, head: tuple) -> dict | None:
    """The Xing, Info or VBRI table of a first frame."""
    at = 4 + 2 * head[6] + head[7]
    if frame[at : at + 4] in (b"Xing", b"Info"):
        flags, out, p = int.from_bytes(frame[at + 4 : at + 8], "big"), {"kind": frame[at : at + 4].decode()}, at + 8
        for bit, name, n in ((1, "frames", 4), (2, "bytes", 4), (4, "toc", 100), (8, "quality", 4)):
            if flags & bit:
                out[name] = list(frame[p : p + n]) if name == "toc" else int.from_bytes(frame[p : p + n], "big")
                p += n
        if frame[p : p + 4] in (b"LAME", b"Lavc", b"Lavf") and len(frame) >= p + 24:
            out["delay"], out["padding"] = frame[p + 21] << 4 | frame[p + 22] >> 4, (frame[p + 22] & 15) << 8 | frame[p + 23]
        return out
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        u = lambda a, n: int.from_bytes(frame[a : a + n], "big")
        entries, scale, size = u(54, 2), u(56, 2), u(58, 2)
        return {"kind": "VBRI", "bytes": u(46, 4), "frames": u(50, 4), "delay": u(42, 2), "toc": [u(62 + i * size, size) * scale for i in range(entries)] if size else []}
    return None


def _trailing(media: bytes, start: int) -> dict[int, list[str]]:
    """Where tags behind the frames may begin, and which; frames may also hold bytes that look like them."""
    ends, out = {len(media): []}, {}
    if len(media) - start >= 128 and media[-128:-125] == b"TAG":
        ends[len(media) - 128] = out[len(media) - 128] = ["ID3v1"]
    for end, before in ends.items():
        if end - start >= 32 and media[end - 32 : end - 24] == b"APETAGEX":
            out[end - min(end - start, int.from_bytes(media[end - 20 : end - 16], "little") + 32 * bool(media[end - 9] & 128))] = [*before, "APE"]
    return out


def read(media: bytes) -> dict:
    """Tags, table, frames and payload of a stream; see the keys below."""
    data, pos, end = np.frombuffer(media, np.uint8), 0, len(media)
    out = {"version": None, "layer": None, "rate": None, "n_frames": 0, "n_samples": 0, "junk_bytes": 0, "resyncs": 0, "crc_checked": 0, "crc_bad": 0, "bitrates": {}, "vbr": None, "stored_bytes": None, "tags": [], "payload": b"", "offsets": np.zeros(0, np.int64)}
    while media[pos : pos + 3] == b"ID3" and end - pos >= 10 and max(media[pos + 6 : pos + 10]) < 128:
        size, body = _synchsafe(media[pos + 6 : pos + 10]), pos + 10
        stop, newer = min(end, body + size), media[pos + 3] == 4
        while body + 10 <= stop and media[body : body + 4].isalnum():
            n = _synchsafe(media[body + 4 : body + 8]) if newer else int.from_bytes(media[body + 4 : body + 8], "big")
            name, value = media[body : body + 4].decode("ascii"), media[body + 10 : body + 10 + n]
            out["tags"].append(name)
            if name == "PRIV" and value.startswith(OWNER):
                out["stored_bytes"] = int.from_bytes(value[len(OWNER) :], "big")
            body += 10 + n
        pos = stop + 10 * bool(media[pos + 5] & 16)
    trailing = _trailing(media, pos)
    offsets, payload, like, first = [], [], None, True
    fits = lambda a, b: a is not None and (b is None or a[:3] == b[:3])
    while pos + 4 <= end:
        head = header(media[pos : pos + 4])
        ok = fits(head, like) and pos + head[4] <= end and (pos + head[4] + 4 > end or pos + head[4] in trailing or fits(header(media[pos + head[4] : pos + head[4] + 4]), head))
        if not ok:
            step = media.find(b"\xff", pos + 1, end)
            step = end if step < 0 else step
            tag = min((t for t in trailing if pos <= t <= step), default=None)
            if tag is not None:  # no frame holds these bytes
                step = end = tag
                out["tags"] += trailing[tag]
            if step == pos:
                break
            out["junk_bytes"] += step - pos
            out["resyncs"] += like is not None and (not offsets or offsets[-1][-1] >= 0) and not out.get("lost")
            out["lost"] = True
            pos = step
            continue
        out["lost"] = False
        size = head[4]
        run = data[pos : pos + (end - pos) // size * size].reshape(-1, size)
        same = (run[:, :4] == run[0, :4]).all(axis=1)
        n = len(run) if same.all() else int(np.argmin(same))
        if first:
            first, like = False, head
            out["version"], out["layer"], out["rate"] = head[:3]
            if table_ := _vbr(media[pos : pos + size], head):
                out["vbr"] = table_
                pos += size
                continue
        run = run[:n]
        if head[6] and head[1] == 3:
            covered = np.concatenate([run[:, 2:4], run[:, 6 : 6 + head[7]]], axis=1)
            out["crc_bad"] += int((crc16(covered) != (run[:, 4].astype(np.uint32) << 8 | run[:, 5])).sum())
            out["crc_checked"] += n
        at = 4 + 2 * head[6] + head[7]
        if head[1] == 3 and at == HEAD:
            lengths = run[:, HEAD].astype(np.int64) << 8 | run[:, HEAD + 1]
            room = size - HEAD - 2
            if (lengths == room).all():
                payload.append(run[:, HEAD + 2 :].tobytes())
            else:
                payload += [run[i, HEAD + 2 : HEAD + 2 + int(k)].tobytes() for i, k in enumerate(lengths) if k <= room]
        offsets.append(pos + size * np.arange(n, dtype=np.int64))
        out["bitrates"][head[3]] = out["bitrates"].get(head[3], 0) + n
        out["n_frames"] += n
        out["n_samples"] += n * head[5]
        pos += n * size
    out["junk_bytes"] += max(0, end - pos)
    if out["vbr"] and "padding" in out["vbr"]:
        out["n_samples"] = max(0, out["n_samples"] - out["vbr"]["delay"] - out["vbr"]["padding"])
    out["payload"] = b"".join(payload)
    out["offsets"] = np.concatenate(offsets) if offsets else out["offsets"]
    out.pop("lost", None)
    return out


def _frame_head(index: int) -> bytes:
    word = bytes([0xFF, 0xFA, index << 4 | 1 << 2, 0])  # MPEG 1, layer III, CRC, 48 kHz, stereo
    crc = int(crc16(np.frombuffer(word[2:] + bytes(32), np.uint8)[None])[0])
    return word + crc.to_bytes(2, "big") + bytes(32)


SIZES = {i: 3 * kbit for i, kbit in enumerate(BITRATES[True, 3]) if i}
HEADS = {i: np.frombuffer(_frame_head(i), np.uint8) for i in SIZES}
TOP = 14


def write(payload: bytes) -> bytes:
    """A stream that holds the payload; ``read`` gives it back."""
    room = SIZES[TOP] - HEAD - 2
    full, rest = divmod(len(payload), room)
    frames = np.zeros((full, SIZES[TOP]), np.uint8)
    frames[:, :HEAD] = HEADS[TOP]
    frames[:, HEAD], frames[:, HEAD + 1] = room >> 8, room & 255
    frames[:, HEAD + 2 :] = np.frombuffer(payload[: full * room], np.uint8).reshape(full, room)
    sizes, body = [SIZES[TOP]] * full, [frames.tobytes()]
    if rest:
        index = min(i for i, size in SIZES.items() if size - HEAD - 2 >= rest)
        last = HEADS[index].tobytes() + rest.to_bytes(2, "big") + payload[full * room :]
        body.append(last.ljust(SIZES[index], b"\0"))
        sizes.append(SIZES[index])
    table_index = 7  # 96 kbit/s: room for the table
    total = SIZES[table_index] + sum(sizes)
    starts = SIZES[table_index] + np.concatenate([[0], np.cumsum(sizes)])
    toc = bytes(min(255, int(starts[len(sizes) * p // 100] * 256 // total)) for p in range(100))
    info = HEADS[table_index].tobytes() + b"Xing" + (7).to_bytes(4, "big") + len(sizes).to_bytes(4, "big") + total.to_bytes(4, "big") + toc
    private = OWNER + len(payload).to_bytes(8, "big")
    tag = b"PRIV" + len(private).to_bytes(4, "big") + b"\0\0" + private
    head = b"ID3\3\0\0" + bytes(len(tag) >> s & 127 for s in (21, 14, 7, 0))
    return b"".join([head, tag, info.ljust(SIZES[table_index], b"\0"), *body])


def feature(x: dict) -> str:
    rates = ",".join(f"{k}x{n}" for k, n in sorted(x["bitrates"].items()))
    table_ = x["vbr"] or {}
    return (
        f"v{x['version']}l{x['layer']} rate={x['rate']} frames={x['n_frames']} samples={x['n_samples']} kbit={rates} vbr={table_.get('kind')}:{table_.get('frames')}:{table_.get('bytes')} "
        f"crc={x['crc_checked'] - x['crc_bad']}/{x['crc_checked']} junk={x['junk_bytes']} resyncs={x['resyncs']} seek={zlib.crc32(x['offsets'].astype('<i8').tobytes()):08x} "
        f"payload={zlib.crc32(x['payload']):08x}"
    )


STORED = "doc_id long, n_bytes long, media binary"
READ = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, sample_rate int, n_samples long, seek_offsets array<long>"


def store(batches):
    for b in batches:
        ids, n, media = [], [], []
        for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
            raw = (text or "").encode()
            ids.append(doc_id)
            n.append(len(raw))
            media.append(write(raw + b"\xff" * (-len(raw) % PAD or PAD * (not raw))))
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def load(batches):
    for b in batches:
        rows = []
        for doc_id, n, media in zip(b["doc_id"].to_pylist(), b["n_bytes"].to_pylist(), b["media"]):
            media = media.as_py() or b""
            x = read(media)
            p = x["payload"]
            if x["stored_bytes"] not in (None, len(p)):
                raise ValueError(f"document {doc_id}: {len(p)} bytes read, {x['stored_bytes']} stored")
            rows.append((doc_id, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(x), x["rate"], x["n_samples"], x["offsets"]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=[x.split()[0] for x in READ.split(", ")])


def op1_media(spark, sf_dir: str) -> DataFrame:
    """Texts as stored streams in the shared folder, read back."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return staged(docs.mapInArrow(store, STORED), "mpeg-media").mapInArrow(load, READ)
