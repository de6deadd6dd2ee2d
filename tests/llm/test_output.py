import collections
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest

from brandtide.llm import mixing, packing, records, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, "Hello  world\n\n next", "it's we'll  don't", "<|endoftext|> x", "a b　c ", " lead", "tab\t\tx", "ünï 12٣ ½ ²", "日本語 テキスト", "x" * 3000, "a\r\n \x0b b  ", "'s", " 's !?", "é \U0001f600\U0001f600", "word " * 2000, "\x85 \x1c​"]


def test_pieces_are_what_the_library_gives():
    from tokenizers import Tokenizer

    tok, rng = Tokenizer.from_file(PATH), random.Random(5)
    alphabet = "ab éÜ12 \n\t'!?.- 日sT  "
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    got = records.Pieces(PATH).encode(texts)
    for t, ids in zip(texts, got):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_crc32c():
    crc, rng = records.Crc32c(), random.Random(1)
    assert crc.of([b"123456789", b"", b"\0" * 32, b"\xff" * 32]).tolist() == [0xE3069283, 0, 0x8A9136AA, 0x62A8AB43]
    parts = [rng.randbytes(rng.choice([1, 3, 4, 5, 255, 256, 257, 1000, 5000])) for _ in range(50)]

    def plain(data):
        c = 0xFFFFFFFF
        for byte in data:
            c ^= byte
            for _ in range(8):
                c = c >> 1 ^ 0x82F63B78 * (c & 1)
        return c ^ 0xFFFFFFFF

    assert crc.of(parts).tolist() == [plain(p) for p in parts]


def test_records_round_trip(spark, docs, sf_dir, monkeypatch):
    from tokenizers import Tokenizer

    from brandtide.llm import ranges

    monkeypatch.setattr(ranges, "RANGE_ROWS", 5)
    tok, start = Tokenizer.from_file(PATH), 0
    found = {r["doc_id"]: r for r in records.op7_records(spark, sf_dir(documents=docs(TEXTS, ids=[7 * k for k in range(len(TEXTS))]).repartition(3))).collect()}
    assert len(found) == len(TEXTS)
    for k, t in enumerate(TEXTS):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        r = found[7 * k]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_damaged_records_are_noticed(spark, docs):
    manifest, base = records.write_records(docs(["one two", "three"], ids=[1, None]), PATH)
    assert {r["doc_id"] for r in records.read_records(manifest, base).collect()} == {1, None}
    path = f"{base.removeprefix('file://')}/{manifest.first()['path']}"
    raw = bytearray(open(path, "rb").read())
    raw[13] ^= 1
    open(path, "wb").write(raw)
    with pytest.raises(Exception, match="checksum"):
        records.read_records(manifest, base).collect()
    assert records.read_records(*records.write_records(docs([]), PATH)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 23, 24, 1000])
def test_shards(spark, docs, sf_dir, n):
    texts = [None if k % 7 == 0 else "é" * (k % 50) for k in range(n)]
    rows = sharding.op6_sharding(spark, sf_dir(documents=docs(texts).repartition(5))).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(n))
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(x) == list(range(len(x))) for x in slots.values())


def matrix(counts, n_shards, seed, *part):
    return np.array([row for _, row in sharding.matrix_rows(np.array(counts), n_shards, seed, *part)])


def test_matrix_sums_and_law(monkeypatch):
    counts = [50, 0, 7, 300, 1]
    m = matrix(counts, 24, 3)
    assert m.sum(axis=1).tolist() == counts and set(m.sum(axis=0).tolist()) <= {14, 15}
    assert np.array_equal(np.concatenate([matrix(counts, 24, 3, 0, 2), matrix(counts, 24, 3, 2, 5)]), m)  # by different tasks
    means = np.mean([matrix([30, 70], 2, s) for s in range(400)], axis=0)
    assert np.allclose(means, [[15, 15], [35, 35]], atol=0.6)
    monkeypatch.setattr(sharding, "NUMPY_ROWS", 0)
    assert matrix(counts, 24, 3).sum(axis=1).tolist() == counts
    means = np.mean([matrix([30, 70], 2, s) for s in range(400)], axis=0)
    assert np.allclose(means, [[15, 15], [35, 35]], atol=0.6)
    rng = np.random.default_rng(1)
    draws = [sharding._large_hypergeometric(rng, 3_000, 7_000, 100) for _ in range(3000)]
    assert abs(np.mean(draws) - 30) < 0.4 and abs(np.var(draws) - 100 * 0.3 * 0.7 * 9900 / 9999) < 1.5
    assert 0 < sharding._large_hypergeometric(rng, 10**9, 10**10, 30_000) < 30_000


def mixed_against_sql(spark, frame, sf_dir):
    base = sf_dir(documents=frame)
    rows = mixing.op3_mixing(spark, base).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{base}/documents.parquet/*.parquet'")
    want = con.sql(mixing.ORACLE).df()
    key = lambda x: sorted(map(tuple, x[["doc_id", "size", "source_size", "target", "taken"]].fillna(-1).values.tolist()))
    assert key(rows) == key(want)
    return rows


def test_mixing(spark, docs, sf_dir):
    rng = random.Random(2)
    sources = [rng.choice(["hot"] * 6 + ["a", "b", "ü", None]) for _ in range(600)]
    texts = [rng.choice([None, "", " x ", "one two\tthree\n" * rng.randrange(1, 20)]) for _ in range(600)]
    rows = mixed_against_sql(spark, docs(texts, sources=sources), sf_dir)
    assert all(r.size_ == len(WORD.findall(texts[r.doc_id] or "")) for r in rows.rename(columns={"size": "size_"}).itertuples())
    assert (rows["taken"] <= 3 * rows["size"]).all()
    by = rows.assign(s=[sources[i] or "none" for i in rows["doc_id"]]).groupby("s").agg({"taken": "sum", "target": "max", "size": "max"})
    assert ((by["taken"] - by["target"]).abs() <= by["size"]).all()
    assert rows["taken"].sum() == pytest.approx(rows["size"].sum(), abs=5 * 60)


@pytest.mark.parametrize("texts,sources", [([], []), (["", None], ["a", None]), (["w"], ["a"]), (["a b", "c", "d e f"], ["x", "y", "z"])])
def test_mixing_edges(spark, docs, sf_dir, texts, sources):
    mixed_against_sql(spark, docs(texts, sources=sources or None), sf_dir)


def test_targets_by_resharing(spark):
    sizes, weights = [("a", 10), ("b", 1000), ("c", 5), ("d", 70), (None, 0)], [5, 2, 1, 5, 2]
    total, want, free = sum(n for _, n in sizes), {}, list(range(5))
    while True:  # as it is told: share, stop at the ceiling, share the excess again
        left = total - sum(want.values())
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] >= 3 * sizes[i][1]]
        if not over:
            break
        for i in over:
            want[i] = 3 * sizes[i][1]
            free.remove(i)
    want |= share
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    assert all(got[sizes[i][0]] == pytest.approx(want[i]) for i in range(5))


def test_mix_repeats_rows_and_keeps_columns(spark, docs):
    frame = docs(["w " * 10] * 5 + ["v " * 400], sources=["a"] * 5 + ["b"])
    rows = mixing.mix(frame)
    assert rows.columns == frame.columns
    got = Counter(r["doc_id"] for r in rows.collect())
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mixed(frame).collect()}
    assert got == {i: n for i, n in want.items() if n} and max(got.values()) == 3


def brute_pack(pieces, capacity, per_source):
    bins, out = [], [None] * len(pieces)
    for i in sorted(range(len(pieces)), key=lambda i: -pieces[i][0]):
        size, s, c = pieces[i]
        fits = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= size and c not in b["clusters"] and b["sources"][s] < per_source]
        if not fits:
            bins.append({"left": capacity, "clusters": set(), "sources": Counter()})
        k = min(fits)[1] if fits else len(bins) - 1
        out[i] = (k, capacity - bins[k]["left"])
        bins[k]["left"] -= size
        bins[k]["clusters"].add(c)
        bins[k]["sources"][s] += 1
    return out


@pytest.mark.parametrize("seed", range(5))
def test_packing_is_best_fit(seed):
    rng = random.Random(seed)
    pieces = [(rng.randrange(1, 101), rng.choice(["hot", "hot", "a", "b", None]), rng.randrange(80)) for _ in range(300)]
    per_source = 1 + seed % 3
    assert packing.pack(pieces, 100, per_source) == brute_pack(pieces, 100, per_source)


def test_packed_documents(spark, docs):
    rng = random.Random(8)
    texts = ["w " * rng.randrange(1, 500) for _ in range(150)] + ["copy text here"] * 20 + [None, "", " \n"]
    sources = [rng.choice(["s", "t", None]) for _ in texts]
    rows = packing.packed(docs(texts, sources=sources), 100, 2, 64).collect()
    words, bins = Counter(), defaultdict(list)
    for r in rows:
        words[r["doc_id"]] += r["piece_words"]
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append(r)
    assert all(words[i] == len(WORD.findall(t or "")) for i, t in enumerate(texts))
    for held in bins.values():
        spans = sorted((r["bin_start"], r["bin_start"] + r["piece_words"]) for r in held)
        assert spans[-1][1] <= 100 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert max(Counter(sources[r["doc_id"]] for r in held).values()) <= 2 and max(Counter(texts[r["doc_id"]] for r in held).values()) == 1
    assert packing.packed(docs([])).count() == 0


@pytest.mark.parametrize("n", [64, 1024, 2048])
def test_long_pieces_that_are_alike(spark, docs, n):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    at = [k.bit_count() & 1 for k in range(n)]
    for letters in ("ab", "ai", "éü", "中国"):
        texts = ["".join(letters[x ^ flip] for x in at) for flip in (0, 1)]
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in records.Pieces(path).encode(texts)] == want
    found = {r["doc_id"]: r for r in records.read_records(*records.write_records(docs(texts), path)).collect()}
    for i, ids in enumerate(want):
        assert found[i]["ids_crc32"] == zlib.crc32(np.array([*ids, 2], "<u4").tobytes())


def test_rows_that_repeat_are_dealt_out(spark, docs):
    got = sharding.shuffle_into_shards(docs(["same"] * 50, ids=[7] * 50), 24).collect()
    assert len(got) == 50 and {collections.Counter(r["shard"] for r in got)[s] for s in range(24)} == {2, 3}
    assert sharding.shuffle_into_shards(docs([]), 24).count() == 0
