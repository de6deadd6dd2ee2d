import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brandtide.llm import langid, toxicity
from brandtide.llm.common import HashIndex, Powers

WORDS = {"en": "the of and wheat thing shore".split(), "de": "und der schön straße nicht über".split(), "el": "και το είναι στο δεν".split()}


def test_language(spark, docs, sf_dir):
    rng = random.Random(3)
    texts, langs = [], []
    for i in range(240):
        lang = ["en", "de", "el"][i % 3]
        texts.append(" ".join(rng.choices(WORDS[lang], k=12)))
        langs.append(lang if i % 10 else None)
    texts += ["", None, "123 !!", "The OF", "wheat " * 300_000]
    langs += [None, "en", "en", None, None]
    got = {r["doc_id"]: r for r in langid.op2_language(spark, sf_dir(documents=docs(texts, langs=langs))).collect()}
    assert len(got) == len(texts)
    assert all(got[i]["lang_pred"] == ["en", "de", "el"][i % 3] for i in range(240))
    assert [got[i]["lang_pred"] for i in (240, 241, 242)] == ["und"] * 3 and got[243]["lang_pred"] == got[244]["lang_pred"] == "en"
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in got.items())


def test_language_without_labels(spark, docs, sf_dir):
    got = langid.op2_language(spark, sf_dir(documents=docs(["abc"], langs=[None]))).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]
    assert langid.op2_language(spark, sf_dir(documents=docs([]))).count() == 0


def test_too_many_languages_are_an_error(spark, docs):
    n = langid.LANGUAGES + 1
    with pytest.raises(ValueError, match="languages"):
        langid.fit(docs(["ab"] * n, langs=[f"l{k}" for k in range(n)]))


def test_matrix_is_naive_bayes(spark, docs):
    langs, logs = langid.fit(docs(["ab", "cd", "cd"], langs=["x", "y", "y"]))
    counts = np.zeros((langid.BUCKETS, 2))
    for text, k in (("ab", 0), ("cd", 1), ("cd", 1)):
        for h in langid.grams([text], langid.letters(), langid.BUCKETS)[0]:
            np.add.at(counts[:, k], h, 1)
    want = np.log((counts + langid.ALPHA) / (counts.sum(axis=0) + langid.ALPHA * langid.BUCKETS))
    assert langs == ["x", "y"] and np.allclose(logs, want, atol=1e-4)


def toxic_corpus(docs, spark, n=700):
    rng, texts, labels = random.Random(4), [], []
    vocabulary = [a + b for a in "tok mel sor bin ra vun del".split() for b in "ar in os et um il".split()]
    for i in range(n):
        words, bad = rng.choices(vocabulary, k=rng.randrange(20, 90)), i % 4 == 0
        if bad:
            for w in rng.choices(["scum", "idiot"], k=4):
                words.insert(rng.randrange(len(words)), w)
        texts.append(" ".join(words))
        if i % 7:
            labels.append((i, int(bad)))
    texts += ["", None]
    return docs(texts), spark.createDataFrame(labels + [(0, None), (10**6, 1)], "doc_id long, toxic int"), texts


def test_toxicity(spark, docs, sf_dir):
    frame, labels, texts = toxic_corpus(docs, spark)
    got = {r["doc_id"]: r for r in toxicity.op10_toxicity(spark, sf_dir(documents=frame, labels=labels)).collect()}
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    held = [i for i in range(700) if got[i]["held_out"]]
    assert held and all(zlib.crc32(str(i).encode()) % 5 == 0 for i in held)
    assert np.mean([got[i]["predicted"] == (i % 4 == 0) for i in held]) > 0.95
    assert got[700]["score"] == got[701]["score"] and got[700]["predicted"] == 0
    kept = {r["doc_id"] for r in toxicity.without_toxic(frame, labels).collect()}
    assert {700, 701} <= kept and np.mean([i in kept for i in range(700) if i % 4]) > 0.97 and np.mean([i not in kept for i in range(0, 700, 4)]) > 0.9


def test_toxicity_without_labels(spark, docs, sf_dir):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.op10_toxicity(spark, sf_dir(documents=docs(["a"]), labels=none)).collect()] == [0.0]
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    got = toxicity.op10_toxicity(spark, sf_dir(documents=docs(["a", "b"]), labels=one)).collect()
    assert len(got) == 2 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.op10_toxicity(spark, sf_dir(documents=docs([]), labels=none)).count() == 0


def test_hash_index_and_windows():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    index, powers = HashIndex(keys), Powers(12345)
    assert (index.find(keys) == np.arange(5000)).all() and (index.find(keys + np.uint64(1)) == -1).mean() > 0.99
    a = rng.integers(0, 50, 300, dtype=np.uint64)
    a[200:220] = a[50:70]
    assert powers.windows(a, 20)[50] == powers.windows(a, 20)[200] and len(powers.windows(a, 301)) == 0


def test_excess_is_what_the_other_class_lacks():
    assert toxicity.excess(np.array([100.0, 100.0, 4.0]), np.array([0.0, 100.0, 0.0])).tolist() == [96.0, 0.0, 0.0]


def test_fold(spark):
    got = spark.createDataFrame([(12,), (None,)], "doc_id long").select(toxicity.fold(F.col("doc_id")).alias("x")).collect()
    assert [r["x"] for r in got] == [zlib.crc32(b"12") % 5, -1]


def bucket(gram, buckets):
    """The bucket of an n-gram, in plain integers."""
    mask, h = (1 << 64) - 1, len(gram)
    for c in gram:
        h = (h * 0x100000001B3 + ord(c)) & mask
    h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & mask
    h = ((h ^ h >> 27) * 0x94D049BB133111EB) & mask
    return (h ^ h >> 31) & (buckets - 1)


def plain_grams(text, buckets):
    """n-grams of letters with a blank behind each run of them, none of a blank alone."""
    flat = "".join(f"{w} " for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" ") if w)
    return [bucket(flat[i : i + n], buckets) for n in (1, 2, 3) for i in range(len(flat) - n + 1) if flat[i : i + n] != " "]


def test_scores_against_bayes(spark, docs, monkeypatch):
    monkeypatch.setattr(langid, "BUCKETS", 64)
    texts = ["der die das", "le la les", "der Hund und die Katze!", "les chats et le chien", "Die DIE", None, "12 34", "la die", "x"]
    langs = ["de", "fr", "de", "fr", None, None, None, None, None]
    frame = docs(texts, langs=langs)
    names, logs = langid.fit(frame)
    counts = {k: np.zeros(64) for k in ("de", "fr")}
    for t, k in zip(texts, langs):
        for g in plain_grams(t, 64) if k else []:
            counts[k][g] += 1
    want = {}
    for i, t in enumerate(texts):
        by = {k: sum(math.log((c[g] + langid.ALPHA) / (c.sum() + 64 * langid.ALPHA)) for g in plain_grams(t, 64)) for k, c in counts.items()}
        odds = {k: math.exp(v - max(by.values())) for k, v in by.items()}
        best = min(odds, key=lambda k: (-odds[k], k))
        want[i] = (best, odds[best] / sum(odds.values())) if plain_grams(t, 64) else ("und", 0.0)
    for r in langid.predict(frame, names, logs, F.lit(False)).collect():
        assert r["lang_pred"] == want[r["doc_id"]][0] and abs(r["score"] - want[r["doc_id"]][1]) < 1e-4


def test_pieces_of_long_texts_count_the_same(monkeypatch):
    known, rng = langid.letters(), random.Random(4)
    for text in ["".join(rng.choices("abÄé ,. 中ΑΣ", k=k)) for k in (1, 2, 3, 50, 400)] + ["", " ", ". a"]:
        whole, _, has = langid.grams([text], known, 1 << 12)
        for size in (1, 2, 7, 100):
            parts = list(langid.grams_of_one(text, known, 1 << 12, size))
            assert [np.concatenate(x).tolist() for x in zip(*[p[0] for p in parts])] == [h.tolist() for h in whole]
            assert any(p[2][0] for p in parts) == has[0]


def test_long_texts_get_the_same_result(spark, docs, monkeypatch):
    texts = ["der die das " * 50, "le la les " * 50, "die le das la " * 40]
    frame = docs(texts, langs=["de", "fr", None])
    names, logs = langid.fit(frame)
    rows = [sorted(map(tuple, langid.predict(frame, names, logs, F.lit(False)).collect()))]
    monkeypatch.setattr(langid, "LONG", 50)
    monkeypatch.setattr(langid, "text_slices", lambda ids, texts, f=langid.text_slices: f(ids, texts, 1))
    rows.append(sorted(map(tuple, langid.predict(frame, names, logs, F.lit(False)).collect())))
    assert [r[:3] for r in rows[0]] == [r[:3] for r in rows[1]] and np.allclose([r[3] for r in rows[0]], [r[3] for r in rows[1]])


def test_probabilities_against_the_formulas(spark, docs):
    """Kneser-Ney by dictionaries, from the docstring's formulas."""
    rng = random.Random(3)
    any_ = "abcdefghijklmnop"
    toxic = [f"p{x} vile scum" for x in any_] + [f"q{x} are vile {x}" for x in any_[:9]] + ["a kind folk"]
    plain = [f"p{x} kind folk" for x in any_] + [f"the day r{x} of kind" for x in any_[:9]] + ["a vile scum"]
    texts, labels = toxic + plain, [1] * len(toxic) + [0] * len(plain)
    frame = docs(texts)
    labelled = frame.join(spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int"), "doc_id")
    model = toxicity.Model(frame, labelled)
    split = str.split
    seen = {1: set(), 0: set()}
    for t, c in zip(texts, labels):
        w = ["", *split(t)]
        seen[c] |= {(w[k - 2] if k > 1 else None, w[k - 1], w[k]) for k in range(1, len(w))}
    c = {k: collections.Counter((v, w) for _, v, w in x) for k, x in seen.items()}
    n = {k: collections.Counter(w for _, w in x) for k, x in c.items()}
    freq = collections.Counter(w for t in texts for w in split(t))

    def less(own, other, scale):
        o = other * scale
        return max(own - 4 - 1.5 * o - 2 * math.sqrt(o), 0.0)

    def levels(k):
        size, other = sum(c[k].values()), sum(c[1 - k].values())
        kinds, kinds_other = sum(n[k].values()), sum(n[1 - k].values())
        pair = {x: less(m, c[1 - k][x], size / other) for x, m in c[k].items()}
        word = {w: less(m, n[1 - k][w], kinds / kinds_other) for w, m in n[k].items()}
        return pair, word, 1 - sum(word.values()) / kinds, kinds

    got = {k: levels(k) for k in (0, 1)}
    vocabulary = {w for k in (0, 1) for w, e in got[k][1].items() if e} | {x[1] for k in (0, 1) for x, e in got[k][0].items() if e}

    def p(k, v, w):
        pair, word, left, kinds = got[k]
        base = (freq[w] + 1) / (sum(freq.values()) + len(vocabulary) + 1)
        low = word.get(w, 0.0) / kinds + left * base
        context = [x for x in c[k] if x[0] == v]
        if not context:
            return low
        total = sum(c[k][x] for x in context)
        return pair.get((v, w), 0.0) / total + (1 - sum(pair[x] for x in context) / total) * low

    score = model.scorer()
    for text in ["pz vile scum", "the vile day", "vile", "folk kind"] + [" ".join(rng.choices("pa vile scum kind folk the day of".split(), k=6)) for _ in range(20)]:
        w = ["", *split(text)]
        want = np.mean([math.log(p(1, a, b) / p(0, a, b)) for a, b in zip(w, w[1:])])
        data = np.frombuffer(text.encode(), np.uint8)
        assert abs(score(data, np.array([0, len(data)]))[0] - want) < 1e-9, text
    assert len(model.pairs) > 1


def test_one_class_rejects_nothing_and_repeated_labels_count_once(spark, docs):
    one = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, toxic int")
    assert toxicity.without_toxic(docs(["a b"] * 9), one).count() == 9
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, None)], "doc_id long, toxic int")
    every = F.lit(True)
    model, _, start = toxicity.fitted(docs(["a", "b", "c"]), labels, every, F.lit(False))
    assert model is None and abs(start) < 1e-9  # one of two ids is toxic
