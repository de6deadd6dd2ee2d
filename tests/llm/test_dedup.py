import collections
import hashlib
import random
import re

import numpy as np
import pytest

from brandtide.llm import graph, near_dedup, substrings, winnowing
from brandtide.llm.common import Powers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=1, n=60):
    """Texts with exact and near copies, shared passages, odd white space, empty and null texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgé", k=rng.randrange(1, 7))) for _ in range(400)]
    passage = [rng.choices(vocabulary, k=40) for _ in range(3)]
    texts = []
    for _ in range(n):
        words, kind = rng.choices(vocabulary, k=rng.randrange(0, 120)), rng.random()
        if kind < 0.2 and texts:
            words = WORD.findall(rng.choice(texts) or "")
            for _ in range(rng.randrange(4)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary).upper()
        elif kind < 0.5:
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passage)[rng.randrange(5) :]
        elif kind < 0.6:
            words = words[:12] * 4
        texts.append(rng.choice([" ", "\n", " \t"]).join(words) + rng.choice(["", " ", "\n"]))
    return texts + ["", None, "   ", "one two", "ONE two", "one  two ", "x " * 5000, "x " * 5000 + "y"]


def brute_groups(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, docs, sf_dir, seed):
    texts = corpus(seed)
    found = near_dedup.op9_near_duplicates(spark, sf_dir(documents=docs(texts))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_groups(list(enumerate(texts)))
    assert len(found) == len(texts) and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_large_groups_of_copies(spark, docs):
    rng = random.Random(7)
    base = [f"w{k}" for k in range(80)]
    texts = []
    for k in range(200):
        words = list(base)
        words[rng.randrange(80)] = f"x{k}"
        texts.append(" ".join(words))
    texts += ["equal text of more than five words"] * 120
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(docs(texts)).collect()}
    want = brute_groups(list(enumerate(texts)))
    assert got == {i: c for i, (_, c) in want.items()}


@pytest.mark.parametrize("outsiders", [4, 4096])
def test_hub_whose_copies_are_linked_only_with_it(spark, docs, monkeypatch, outsiders):
    monkeypatch.setattr(near_dedup, "LEAF", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    monkeypatch.setattr(near_dedup, "OUTSIDERS", outsiders)
    rng, base = random.Random(6), [f"w{k}" for k in range(80)]
    texts = [" ".join(base)]
    for k in range(60):
        words = list(base)
        a = rng.randrange(5, 35)
        words[a], words[a + 38] = f"x{k}", f"y{k}"
        texts.append(" ".join(words))
    want = brute_groups(list(enumerate(texts)))
    assert {c for _, c in want.values()} == {0}
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(docs(texts)).collect()} == {i: 0 for i in want}


def test_pairs_at_the_threshold_are_found_however_deep_their_nodes(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEAF", 0)  # every node that two documents share branches on
    rng, texts = random.Random(8), []
    for k in range(4000):
        words = [f"w{k}x{i}" for i in range(74)]
        texts.append(" ".join(words))
        words[rng.randrange(5, 30)] = words[rng.randrange(40, 65)] = "other"
        texts.append(" ".join(words))
    assert brute_groups(list(enumerate(texts[:2])))[1] == (70, 0)  # 60 of 80 shingles: 0.75
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(docs(texts).repartition(4)).collect()}
    assert [i for i, c in got.items() if c != i - i % 2] == []
    assert near_dedup.missed(0.75, 4) < 2e-6 and near_dedup.missed(0.75, near_dedup.LAST) < 1e-3


def family(n, changed, rng):
    """Texts with so many of 200 words changed, mostly below the threshold with one another."""
    texts = []
    for k in range(n):
        words = [f"w{i}" for i in range(200)]
        for i in rng.sample(range(200), changed):
            words[i] = f"x{k}y{i}"
        texts.append(" ".join(words))
    return texts


def test_families_below_the_threshold_in_blocks_and_deep_nodes(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 40)
    monkeypatch.setattr(near_dedup, "OUTSIDERS", 30)
    monkeypatch.setattr(near_dedup, "COLUMNS", 64)
    rng = random.Random(11)
    texts = family(250, 6, rng)
    texts += [" ".join([*t.split()[:120], "same", *t.split()[121:]]) for t in texts[::5]]
    want = {i: c for i, (_, c) in brute_groups(list(enumerate(texts))).items()}
    assert 100 < len(set(want.values())) < 280
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(docs(texts)).collect()} == want


def test_a_family_below_the_threshold_is_not_sent_on_as_its_pairs(spark, docs, monkeypatch):
    n, rows, staged = 600, {}, near_dedup.staged

    def counted(df, name):
        out = staged(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(near_dedup, "staged", counted)
    near_dedup.near_groups(docs(family(n, 5, random.Random(n)))).count()
    assert rows["near-blocks"] + rows["near-links"] + rows["near-asked"] < 6 * n
    assert rows["near-pairs"] <= rows["near-leaves"] * near_dedup.LEAF / 2  # in small leaves


def thue_morse(n, letters):
    """Words of n letters over two letters that polynomial hashes modulo a power of two do not tell apart."""
    at = [k.bit_count() & 1 for k in range(n)]
    return ["".join(letters[x ^ flip] for x in at) for flip in (0, 1)]


@pytest.mark.parametrize("n", [32, 64, 512, 1024, 2048])
def test_long_words_that_are_alike_do_not_collide(spark, docs, n):
    a, b = thue_morse(n, "ai")
    x, y = thue_morse(n, "bj")
    lead = [f"w{k}" for k in range(12)]
    texts = [" ".join([a, b, a, b, a]), " ".join([b, a, b, a, b]), " ".join([*lead, x]), " ".join([*lead, y])]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(docs(texts)).collect()}
    assert got == {i: c for i, (_, c) in brute_groups(list(enumerate(texts))).items()} and got[1] == 1
    cut = substrings.deduplicated(docs(texts)).collect()
    assert {(r["doc_id"], r["n_removed"]) for r in cut} == {(i, 0) for i in range(4)}


def test_run_hashes():
    from brandtide.llm.common import run_hashes

    rng = random.Random(2)
    runs = [bytes(rng.choices(b"ab\0", k=k)) for k in range(1, 90) for _ in range(30)]
    data, sizes = np.frombuffer(b" ".join(runs), np.uint8), np.array([len(r) for r in runs])
    starts = np.cumsum(sizes + 1) - sizes - 1
    hashes = run_hashes(data, starts, starts + sizes, 5)
    assert len(set(hashes.tolist())) == len(set(runs))
    assert run_hashes(data[starts[-1] :], np.array([0]), sizes[-1:], 5)[0] == hashes[-1] != run_hashes(data[starts[-1] :], np.array([0]), sizes[-1:], 6)[0]


def test_repeated_ids_and_empty_table(spark, docs):
    texts, ids = ["a b c d e f g", "p q r s t u v", "p q r s t u v", "h i j k l m n"], [1, 1, 2, None]
    got = {(r["doc_id"], r["component_id"]) for r in near_dedup.near_groups(docs(texts, ids=ids)).collect()}
    assert got == {(1, 1), (2, 1), (None, None)}
    kept = near_dedup.one_of_each(docs(texts, ids=ids))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "None"] and "taken" in kept.columns
    assert near_dedup.near_groups(docs([])).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(30)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def brute_cut(rows, width=13):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - width + 1):
            x = tuple(w[k : k + width])
            if i is not None:
                first[x] = min(first.get(x, i), i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_substrings(spark, docs, sf_dir, seed, monkeypatch):
    texts = corpus(seed)
    if seed == 4:
        monkeypatch.setattr(substrings, "CHUNK", 200)  # many chunks
        monkeypatch.setattr(substrings, "GATHER", 300)
        monkeypatch.setattr(substrings, "CELLS", 1 << 9)  # and a sketch far too small
        monkeypatch.setattr(substrings, "BUCKET", 4)  # and very many buckets
    found = substrings.op4_substrings(spark, sf_dir(documents=docs(texts).repartition(3))).collect()
    want = [(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute_cut(list(enumerate(texts)))]
    assert sorted(map(tuple, found)) == sorted(want) and sum(g for _, _, g, _ in want) > 100


def test_substrings_stage_keeps_columns_and_untouched_texts(spark, docs):
    texts = ["  odd\tspace stays here  ", " ".join(f"w{k}" for k in range(20)), "y " + " ".join(f"w{k}" for k in range(20)), None]
    got = {r["doc_id"]: r for r in substrings.without_repeats(docs(texts, ids=[5, 6, 7, None])).collect()}
    assert [got[i]["text"] for i in (5, 6, 7, None)] == [texts[0], texts[1], "y", None]
    assert got[7]["n_chars"] == 1 and got[7]["fp"] == "f" and got[7]["row"] == "r" and got[7]["taken"] == 7
    assert substrings.without_repeats(docs([])).count() == 0 and substrings.without_repeats(docs([])).columns == docs([]).columns


def test_repeated_and_null_ids_of_windows(spark, docs):
    run = " ".join(f"w{k}" for k in range(15))
    rows = list(zip([4, 4, 9, None, None], [run, run + " z", "a " + run, run, run]))
    got = substrings.deduplicated(docs([t for _, t in rows], ids=[i for i, _ in rows])).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got) == sorted((str(a), *b) for a, *b in brute_cut(rows))


def test_gaps():
    at = np.array([3, 4, 300, 258 + 300, 100_000, 4_000_000])
    assert substrings.positions(substrings.gaps(at, 3), 3).tolist() == at.tolist() and not len(substrings.positions(substrings.gaps(at[:0], 0), 0))


def plain_hash(codes):
    """The hash of a k-gram, in plain integers."""
    mask, h = (1 << 64) - 1, sum((c + 1) * pow(winnowing.BASE | 1, j, 1 << 64) for j, c in enumerate(codes)) & (1 << 64) - 1
    h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & mask
    h = ((h ^ h >> 27) * 0x94D049BB133111EB) & mask
    return (h ^ h >> 31) >> 24


def brute_winnow(text, k=winnowing.K, window=winnowing.WINDOW):
    if not text:
        return []
    codes = [ord(c) for c in text]
    k = min(k, len(codes))
    hashes = [plain_hash(codes[i : i + k]) for i in range(len(codes) - k + 1)]
    out = []
    for i in range(max(1, len(hashes) - window + 1)):
        part = hashes[i : i + window]
        at = i + max(j for j, h in enumerate(part) if h == min(part))
        if not out or out[-1][1] != at:
            out.append((hashes[at], at))
    return out


@pytest.mark.parametrize("text", ["", "a", "ab" * 100, "é" * 300, "the quick brown fox " * 7, "".join(random.Random(9).choices("abcdef \n", k=700))])
def test_winnowing(text, monkeypatch):
    h, p = winnowing.winnow(text, Powers(winnowing.BASE))
    assert list(zip(h.tolist(), p.tolist())) == brute_winnow(text)
    monkeypatch.setattr(winnowing, "BLOCK", 64)
    h2, p2 = winnowing.winnow(text, Powers(winnowing.BASE))
    assert (h2.tolist(), p2.tolist()) == (h.tolist(), p.tolist())


def test_winnowing_finds_every_long_match():
    rng = random.Random(1)
    for _ in range(20):
        shared = "".join(rng.choices("abcdefgh", k=winnowing.K + winnowing.WINDOW - 1))
        a, b = ("".join(rng.choices("ijklmnop", k=100)) + shared + "".join(rng.choices("ijklmnop", k=100)) for _ in "ab")
        assert set(winnowing.winnow(a, Powers(winnowing.BASE))[0].tolist()) & set(winnowing.winnow(b, Powers(winnowing.BASE))[0].tolist())


@pytest.mark.parametrize("rows", [1, 5, 400])
def test_edited_texts(spark, docs, sf_dir, rows, monkeypatch):
    from brandtide.llm import ranges

    monkeypatch.setattr(ranges, "RANGE_ROWS", 30)
    rng = random.Random(rows)
    texts = [rng.choice([None, "", "tiny", "Ünï " * rng.randrange(80), "".join(rng.choices("ab cd", k=rng.randrange(300)))]) for _ in range(rows)]
    found = {r["doc_id"]: r for r in winnowing.op5_fingerprints(spark, sf_dir(documents=docs(texts, ids=[3 * k for k in range(rows)]).repartition(3))).collect()}
    assert len(found) == rows
    for k, t in enumerate(texts):
        t, nxt = t or "", texts[(k + 1) % rows] or ""
        half, r = len(t) // 2, found[3 * k]
        edited = t[: len(t) - half] + nxt[:half]
        a, b, c = ({h for h, _ in brute_winnow(x)} for x in (t, edited, nxt))
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r["near_edited"] - like(a, b)) < 1e-12 and abs(r["near_next"] - like(a, c)) < 1e-12
    by_text = collections.defaultdict(set)
    for k, t in enumerate(texts):
        by_text[t or ""].add(found[3 * k]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())


def test_edited_texts_with_repeated_and_null_ids(spark, docs):
    got = winnowing.with_next(docs(["b" * 40, "a" * 40, "z" * 40, "q" * 40], ids=[1, 1, None, 2])).collect()
    assert len(got) == 4 and {r["edited_sha256"] for r in got} == {hashlib.sha256(x.encode()).hexdigest() for x in ("a" * 20 + "b" * 20, "b" * 20 + "q" * 20, "q" * 20 + "z" * 20, "z" * 20 + "a" * 20)}
    assert winnowing.with_next(docs([])).count() == 0


