import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from brandtide.llm import mpeg

PAYLOADS = [b"\xff" * 576, b"abc" * 192, bytes(range(256)) * 45, b"\xff\xfb\x90\x00" * 1440, b"", b"x" * 920, b"y" * 921]


@pytest.mark.parametrize("payload", PAYLOADS)
def test_round_trip(payload):
    x = mpeg.read(mpeg.write(payload))
    assert x["payload"] == payload and x["stored_bytes"] == len(payload) and not x["junk_bytes"] and not x["crc_bad"]
    assert x["n_samples"] == 1152 * x["n_frames"] == 1152 * len(x["offsets"]) and x["vbr"]["frames"] == x["n_frames"]


def test_offsets_are_frames_and_table_is_right():
    media = mpeg.write(b"t" * 9000)
    x = mpeg.read(media)
    assert all(mpeg.header(media[o : o + 4]) for o in x["offsets"]) and len(x["vbr"]["toc"]) == 100
    assert x["vbr"]["bytes"] == len(media) - (x["offsets"][0] - 288)


def test_resynchronises_after_junk_and_damage():
    media = mpeg.write(b"t" * 9000)
    x, first = mpeg.read(media), int(mpeg.read(media)["offsets"][3])
    y = mpeg.read(media[:first] + b"\xff\xfa junk \xff\xe0" + media[first:])
    assert y["n_frames"] == x["n_frames"] and y["junk_bytes"] == 10 and y["resyncs"] == 1 and y["payload"] == x["payload"]
    broken = bytearray(media)
    broken[first + 10] ^= 1
    assert mpeg.read(bytes(broken))["crc_bad"] == 1
    assert mpeg.read(b"junk" + b"\xff" * 50)["n_frames"] == 0


def test_tags_lame_and_vbri():
    media = mpeg.write(b"t" * 3000)
    tag = b"TAG" + bytes(125)
    ape = b"APETAGEX" + (2000).to_bytes(4, "little") + (32).to_bytes(4, "little") + bytes(16)
    assert mpeg.read(media + ape + tag)["tags"] == ["PRIV", "ID3v1", "APE"] and mpeg.read(media + tag)["n_frames"] == mpeg.read(media)["n_frames"]
    head = bytes([0xFF, 0xFB, 0xE4, 0])  # 320 kbit/s, 48 kHz, without CRC
    lame = (head + bytes(32) + b"Xing" + (1).to_bytes(4, "big") + (4).to_bytes(4, "big") + b"LAME3.100" + bytes(12) + bytes([0x24, 0x01, 0x00])).ljust(960, b"\0")
    x = mpeg.read(lame + (head + bytes(956)) * 4)
    assert x["n_samples"] == 4 * 1152 - 576 - 256 and x["crc_checked"] == 0
    vbri = (head + bytes(32) + b"VBRI" + bytes([0, 1, 0, 0, 0, 0]) + (9).to_bytes(4, "big") + (4).to_bytes(4, "big") + (2).to_bytes(2, "big") + (1).to_bytes(2, "big") + (2).to_bytes(2, "big") + (2).to_bytes(2, "big") + bytes([1, 0, 2, 0])).ljust(960, b"\0")
    assert mpeg.read(vbri + (head + bytes(956)) * 4)["vbr"] == {"kind": "VBRI", "bytes": 9, "frames": 4, "delay": 0, "toc": [256, 512]}


@pytest.mark.parametrize("back,mark", [(128, b"TAG"), (32, b"APETAGEX" + bytes([0, 0, 0, 0, 0xC0, 3, 0, 0]) + bytes(16))])
def test_payload_that_looks_like_a_trailing_tag(back, mark):
    payload = (b"z" * (920 * 2 - back) + mark).ljust(920 * 2, b"z")
    media = mpeg.write(payload)
    assert media[-back:].startswith(mark) and mpeg.read(media)["payload"] == payload and mpeg.read(media)["tags"] == ["PRIV"]
    tag = b"TAG" + bytes(125)
    assert mpeg.read(media + tag)["payload"] == payload and mpeg.read(media + tag)["tags"] == ["PRIV", "ID3v1"] and not mpeg.read(media + tag)["junk_bytes"]
    assert mpeg.read(tag)["tags"] == ["ID3v1"] and not mpeg.read(tag)["junk_bytes"]
    assert mpeg.read(media + b"junk" + tag)["junk_bytes"] >= 4 and mpeg.read(media + b"junk" + tag)["tags"] == ["PRIV", "ID3v1"]


def test_lost_payload_is_an_error():
    media = mpeg.write(b"t" * 9000)
    rows = pa.record_batch([pa.array([1]), pa.array([9000]), pa.array([media[:-960]], pa.binary())], names=["doc_id", "n_bytes", "media"])
    with pytest.raises(ValueError, match="9000 stored"):
        list(mpeg.load([rows]))


@pytest.mark.parametrize("word,size,samples", [("fffb9064", 417, 1152), ("fffd8404", 384, 1152), ("ffff1400", 32, 384), ("fff35044", 130, 576)])
def test_headers(word, size, samples):
    assert mpeg.header(bytes.fromhex(word))[4:6] == (size, samples)


def test_query(spark, docs, sf_dir):
    texts = ["", None, "é" * 300, "same", "same", "x" * 576, "\x00" * 2000 + "end"]
    got = {r["doc_id"]: r for r in mpeg.op1_media(spark, sf_dir(documents=docs(texts))).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or 576 * (not raw))
        assert (got[i]["n_bytes"], got[i]["payload_bytes"], got[i]["payload_sha256"], got[i]["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert got[3]["media_sha256"] == got[4]["media_sha256"] and got[3]["feature"] == got[4]["feature"] and got[0]["feature"] == got[1]["feature"]
    assert mpeg.op1_media(spark, sf_dir(documents=docs([]))).count() == 0


def test_crc16_by_bits():
    data = np.frombuffer(b"\x90\x64" + b"side information", np.uint8)
    crc = 0xFFFF
    for byte in data.tolist():
        for bit in range(7, -1, -1):
            top = crc >> 15 ^ byte >> bit & 1
            crc = (crc << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    assert int(mpeg.crc16(data[None])[0]) == crc


@pytest.mark.parametrize("size", [576, 1152, 5760])
def test_payloads_that_look_like_tags_or_frames(size):
    rng = random.Random(size)
    plain = bytes(rng.choices(b"abcdef \n", k=size))
    frame = mpeg.HEADS[mpeg.TOP].tobytes()
    marks = [b"TAG", b"APETAGEX" + (40).to_bytes(4, "little") * 2, b"ID3\3\0\0\0\0\0\x10", b"Xing\0\0\0\7", frame[:6], frame, b"\xff" * 40]
    for mark in marks:
        for at in range(0, size - len(mark) + 1, 1 if size < 1000 else 13):
            payload = plain[:at] + mark + plain[at + len(mark) :]
            found = mpeg.read(mpeg.write(payload))
            assert found["payload"] == payload and found["stored_bytes"] == size and not found["resyncs"], (mark, at)
    both = plain[: size - 160] + b"APETAGEX" + bytes(24) + b"TAG" + plain[-125:]
    assert mpeg.read(mpeg.write(both))["payload"] == both


def test_feature_tells_texts_of_one_length_apart():
    a, b = (mpeg.feature(mpeg.read(mpeg.write(x * 576))) for x in (b"a", b"b"))
    assert a != b
