"""Near-duplicates by a chosen-path set similarity join over word shingles.

Texts are sets of 64-bit hashes of five consecutive words (A-Z lower-cased). Equal sets are grouped first by a
128-bit sum over the set, and only the smallest id of each goes on. From ``COORDINATES`` minwise values of each set,
``TREES`` independent trees branch: every node chooses, from a hash of its path, one coordinate and with probability
1/2 a second, and a document goes to the child of its value there. By the size of a node and what is in it:

* At most ``LEAF`` documents: all pairs are compared by their minwise values, and those that may reach the threshold
  are confirmed on full sets, which go once to each leaf that has such pairs.
* More, but not alike (less than ``ALIKE`` of the values agree with the node's most frequent ones): up to ``UNLIKE``
  documents are a leaf as well, for few of their pairs come near the threshold; more branch on, two levels at once.
* More, and alike: the document nearest to the most frequent values leads, and nodes of one leader are one family.
  Families are cut into blocks of at most about ``BLOCK`` documents, each with its leader. A block compares the leader
  with all, and whatever the leader is not linked to with all, by exact intersections of full sets as bitmaps; it
  returns a star for each group that it finds, never all pairs.
* A family of several blocks then holds components. If at most ``OUTSIDERS`` documents are outside the largest, each
  is compared with the other components in all blocks; if there are more, the family's nodes branch on, and
  each of their children is judged likewise. From level ``LAST`` on nothing branches and all is compared.

A pair is lost if it shares no node in which it would be compared: at the threshold with chance 6e-13 at level 1,
1e-7 at level 3, 9e-6 at level 5 and 7e-4 at level ``LAST`` (``missed``), which only families get to that keep more
than ``OUTSIDERS`` documents apart in nodes of so many common values. Fewer than half of a pair's values agree with
chance 4e-8, the only other loss. Both fall with similarity.

Defined results: null, empty and blank texts have no shingle and are linked with nothing; fewer words than five are
one shingle; rows that repeat an id are one document of several texts, of which one is kept; rows of a null id are
linked with nothing, so that near copies among them stay; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brandtide.llm.common import Powers, mix64, small_batches, table, text_slices, with_small, words
from brandtide.llm.graph import components
from brandtide.runtime import discard, scratch, staged

SHINGLE, COORDINATES, TREES, LEAF, UNLIKE = 5, 96, 18, 48, 8192
#: Documents and bytes of sets in a block of a family, about; outsiders that are compared with a whole family.
BLOCK, BLOCK_BYTES, OUTSIDERS = 8192, 32 << 20, 8192
#: Documents by which a node's most frequent values are told; share of agreeing values from which on it is alike.
SAMPLE, ALIKE = 64, 0.5
LAST = 11
WORD_SEED, SHINGLE_BASE = 0x9E6C63D0876A9A35, 0xD1342543DE82EF95
#: A pair may reach the threshold if this share of its minwise values agree.
MAY = 0.5
#: Shingles that one bitmap has columns for.
COLUMNS = 1 << 13


def missed(similarity: float, level: int) -> float:
    """The chance that a pair which may reach the threshold shares no node of a level, if all nodes above are large."""
    total = 0.0
    for k in range(ceil(MAY * COORDINATES), COORDINATES + 1):
        agree, below = k / COORDINATES, 0.0
        for _ in range(level):
            child = 1 - agree + agree * below
            below = (child + child**2) / 2
        total += comb(COORDINATES, k) * similarity**k * (1 - similarity) ** (COORDINATES - k) * below**TREES
    return total


def shingle_sets(data: np.ndarray, offsets: np.ndarray, powers: Powers, width: int = SHINGLE):
    """The sorted set of shingle hashes of each row."""
    hashes, _, _, first = words(data, offsets, WORD_SEED, lower=True)
    grams = mix64(powers.windows(hashes, width))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(grams[a : b - width + 1])
        elif b > a:
            yield mix64(powers.windows(hashes[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def _minwise() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64))
    return (seeds[:COORDINATES] >> np.uint64(32)).astype(np.uint32), (seeds[COORDINATES:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minwise(values: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least of each coordinate's hash over a set (at least one value)."""
    short, best = (values >> np.uint64(32)).astype(np.uint32), np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(short), 512):
        part = (short[i : i + 512, None] ^ flips) * factors
        best = np.minimum(best, (part ^ (part >> np.uint32(15))).min(axis=0))
    return best


def sketches(batches):
    powers, (flips, factors) = Powers(SHINGLE_BASE), _minwise()
    for b in batches:
        ids, n, d1, d2, sigs = [], [], [], [], []
        for some, data, offs in text_slices(b["doc_id"], b["text"]):
            ids += some
            for s in shingle_sets(data, offs, powers):
                n.append(len(s))
                d1.append(s.sum(dtype=np.uint64))
                d2.append(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
                sigs.append(minwise(s, flips, factors).tobytes() if len(s) else b"")
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(np.array(d1, np.uint64).view(np.int64)), pa.array(np.array(d2, np.uint64).view(np.int64)), pa.array(sigs, pa.binary())], names=["doc_id", "n", "d1", "d2", "sig"])


def children(keys: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the child nodes of rows with these node keys and signatures, and the row of each."""
    draw = mix64(keys ^ np.uint64(0x51ED2701))
    one = (draw % np.uint64(COORDINATES)).astype(np.int64)
    two = (one + 1 + ((draw >> np.uint64(20)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
    rows = np.arange(len(keys))
    second = rows[(draw >> np.uint64(40)) % np.uint64(2) == 0]
    at, coordinate = np.concatenate([rows, second]), np.concatenate([one, two[second]])
    return mix64(mix64(keys[at] + coordinate.astype(np.uint64)) ^ sig[at, coordinate]), at


def branch(levels: int):
    """Nodes (key, rep, deep) so many levels below those of rows (key, rep, deep, sig)."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys, sig, at = b["key"].to_numpy().view(np.uint64), _rows(b["sig"], np.uint32), np.arange(b.num_rows)
            for _ in range(levels):
                keys, child_of = children(keys, sig[at])
                at = at[child_of]
            yield pa.record_batch([pa.array(keys.view(np.int64)), b["rep"].take(pa.array(at)), b["deep"].take(pa.array(at))], names=["key", "rep", "deep"])

    return run


def _rows(column: pa.Array, kind) -> np.ndarray:
    """Signatures of equal length as the rows of an array."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, COORDINATES)


def whole_runs(batches, column: str):
    """Tables of rows sorted by a column, none of whose values is in two of them."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        keys = t[column].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # the last value may go on
        rest = t.slice(cut)
        if cut:
            yield t.slice(0, cut)
    if rest is not None:
        yield rest


def agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many of their bytes rows agree, eight at a time."""
    lanes = np.ascontiguousarray(x == y).view(np.uint64).sum(axis=1, dtype=np.uint64)  # a byte holds at most 12 here
    return (lanes * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.int32)


def leaf_pairs(batches):
    """Pairs (a < b, alike) within a leaf, with its size, but none of one family (0 is none).

    Rows (key, size, n, rep, low, family) come sorted by key and n, so that a document is compared with those behind it
    that are not too large for the threshold.
    """
    names = ["key", "size", "a", "b", "alike"]
    for t in whole_runs(batches, "key"):
        keys, sizes, reps, n, family = (t[c].to_numpy() for c in ("key", "size", "rep", "n", "family"))
        low, out, at = _rows(t["low"], np.uint8), [], np.flatnonzero(sizes <= LEAF)
        for step in range(1, LEAF):  # all small leaves at once
            at = at[at + step < len(keys)]
            at = at[(keys[at] == keys[at + step]) & (100 * n[at] >= 75 * n[at + step])]
            if not len(at):
                break
            some = at[((family[at] != family[at + step]) | (family[at] == 0)) & (reps[at] != reps[at + step])]
            alike = agreeing(low[some], low[some + step])
            ok = alike >= MAY * COORDINATES
            out.append((some[ok], some[ok] + step, alike[ok]))
        for i in np.flatnonzero(sizes > LEAF).tolist():
            end = int(np.searchsorted(keys, keys[i], "right"))
            end = i + int(np.searchsorted(n[i:end], n[i] * 4 // 3, "right"))
            if end > i + 1:
                alike = agreeing(low[i + 1 : end], low[i])
                ok = np.flatnonzero(alike >= MAY * COORDINATES)
                ok = ok[((family[i + 1 + ok] != family[i]) | (family[i] == 0)) & (reps[i + 1 + ok] != reps[i])]
                out.append((np.full(len(ok), i), i + 1 + ok, alike[ok]))
        if out:
            one, two, alike = (np.concatenate(x) for x in zip(*out))
            a, b = np.minimum(reps[one], reps[two]), np.maximum(reps[one], reps[two])
            yield pa.record_batch([pa.array(x) for x in (keys[one], sizes[one], a, b, alike)], names=names)


def alike_enough(both, x, y):
    """Whether sets of x and y elements, that share so many, reach the threshold."""
    return 100 * both >= 75 * (x + y - both)


class Groups:
    """Groups of numbered things, joined as links are found."""

    def __init__(self, labels: np.ndarray):
        self.first, self.labels = labels, labels.copy()

    def join(self, i: int, others: np.ndarray) -> None:
        found = np.unique(self.labels[others])
        found = found[found != self.labels[i]]
        if len(found):
            self.labels[np.isin(self.labels, found)] = self.labels[i]

    def stars(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of the least name of each group with one of each part that it was joined from."""
        order = np.lexsort((names, self.first, self.labels))
        label, part = self.labels[order], self.first[order]
        some = order[np.concatenate([[True], (label[1:] != label[:-1]) | (part[1:] != part[:-1])])]
        order = some[np.lexsort((names[some], self.labels[some]))]
        new = np.concatenate([[True], self.labels[order][1:] != self.labels[order][:-1]])
        least = names[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        return least[~new], names[order][~new]


def confirm_leaves(batches):
    """Links (a < b), a star for each group, by the pairs (with b) that reach the threshold; the sets of a leaf (without b) come first."""
    at, sets, root = None, {}, {}

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def stars():
        found = [(top(x), x) for x in root if top(x) != x]
        return pa.record_batch([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        for key, a, b, x in zip(*(batch[c].to_pylist() for c in ("key", "a", "b", "shingles"))):
            if at != key:
                if root:
                    yield stars()
                at, sets, root = key, {}, {}
            if b is None:
                sets[a], root[a] = np.frombuffer(x, np.uint64), a
                continue
            u, v = top(a), top(b)
            if u != v and alike_enough(len(np.intersect1d(sets[a], sets[b], assume_unique=True)), len(sets[a]), len(sets[b])):
                root[max(u, v)] = min(u, v)
    if root:
        yield stars()


def with_sets(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """A staged table of rows with ``id``, and the full set (as bytes) of the document of that id."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text")
    found = with_small(texts, rows, "id", "inner", rows.count())
    kinds = [f for f in rows.schema.fields]

    def run(batches):
        powers = Powers(SHINGLE_BASE)
        for b in batches:
            sets = [s.tobytes() for _, data, offs in text_slices(b["id"], b["text"]) for s in shingle_sets(data, offs, powers)]
            yield pa.record_batch([*[b[f] for f in names], pa.array(sets, pa.binary())], names=[*names, "shingles"])

    names = [f.name for f in kinds]
    return found.select(*names, "text").mapInArrow(run, T.StructType([*kinds, T.StructField("shingles", T.BinaryType())]))


def leaf_links(leaves: DataFrame, whole: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Staged links within the leaves, rows of key, rep, size, but for pairs of one family in ``whole`` (family, rep)."""
    one = whole.groupBy("rep").agg(F.xxhash64(F.min("family")).alias("family"))
    low = reps.select("rep", "n", "low").join(one, "rep", "left")
    rows = leaves.join(low, "rep").select("key", "size", "rep", "n", "low", F.coalesce("family", F.lit(0)).alias("family"))
    found = rows.repartition("key").sortWithinPartitions("key", "n", "rep").mapInArrow(leaf_pairs, "key long, size long, a long, b long, alike int")
    # A pair that met in several leaves is confirmed in the largest, which has most others to confirm.
    pairs = found.groupBy("a", "b").agg(F.max(F.struct("size", "key")).alias("x"), F.first("alike").alias("alike"))
    pairs = staged(pairs.select("x.key", "a", "b", "alike"), "near-pairs")
    held = staged(pairs.select("key", F.col("a").alias("id")).union(pairs.select("key", "b")).distinct(), "near-asked")
    rows = with_sets(held, docs).select("key", F.col("id").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(COORDINATES + 1).alias("alike"), "shingles")
    rows = rows.unionByName(pairs, allowMissingColumns=True).repartition("key").sortWithinPartitions("key", F.desc("alike"))
    return staged(rows.mapInArrow(confirm_leaves, "a long, b long"), "near-links")


def leaders(nodes: DataFrame) -> DataFrame:
    """Staged key and leader of the alike ones among large nodes; ``nodes`` is a staged table of key, rep, size, low."""
    sample = nodes.where(F.pmod(F.xxhash64("rep", "key"), F.col("size")) < SAMPLE)

    def most_frequent(t: pa.Table) -> pa.Table:  # of SAMPLE rows, about
        rows = _rows(t["low"], np.uint8)
        counts = np.bincount((rows + 256 * np.arange(COORDINATES)).ravel(), minlength=256 * COORDINATES).reshape(COORDINATES, 256)
        return pa.table([t["key"][:1], pa.array([counts.argmax(axis=1).astype(np.uint8).tobytes()], pa.binary()), pa.array([float(counts.max(axis=1).sum()) / rows.size])], names=["key", "top", "share"])

    def agreement(batches):
        for b in batches:
            if b.num_rows:
                agree = (_rows(b["low"], np.uint8) == _rows(b["top"], np.uint8)).sum(axis=1)
                yield pa.record_batch([b["key"], b["rep"], pa.array(agree.astype(np.int32))], names=["key", "rep", "agree"])

    tops = staged(sample.select("key", "low").groupBy("key").applyInArrow(most_frequent, "key long, top binary, share double").where(F.col("share") >= ALIKE).select("key", "top"), "near-tops")
    seen = with_small(nodes, tops, "key", "inner", tops.count()).select("key", "rep", "low", "top").mapInArrow(agreement, "key long, rep long, agree int")
    return staged(seen.groupBy("key").agg(F.max_by("rep", F.struct("agree", -F.col("rep"))).alias("leader")), "near-leaders")


def shared(sets: list[np.ndarray], asked: np.ndarray):
    """For each of the asked sets its number and the size of its intersection with every set."""
    sizes = np.array([len(s) for s in sets])
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    kinds, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    often = counts > 1  # others are in no intersection
    rank = np.cumsum(often) - 1
    use = often[column]
    column, owner, n_columns = rank[column[use]], owner[use], int(often.sum())
    parts = [(owner[at], column[at] - start) for start in range(0, n_columns, COLUMNS) if len(at := np.flatnonzero((column >= start) & (column < start + COLUMNS)))]
    for some in range(0, len(asked), 1024):
        who = asked[some : some + 1024]
        both = np.zeros((len(who), len(sets)), np.int32)
        for rows, columns in parts:
            flags = np.zeros((len(sets), min(COLUMNS, -(-n_columns // 64) * 64)), bool)
            flags[rows, columns] = True
            bits = np.packbits(flags, axis=1).view(np.uint64)
            del flags
            for k, i in enumerate(who):
                both[k] += np.bitwise_count(bits & bits[i]).sum(axis=1, dtype=np.int32)
        yield from zip(who.tolist(), both)


def block_links(batches):
    """Links (a < b), a star for each group that is found, of blocks of rows (place, kind, rep, part, shingles), sorted by place and kind.

    Kind 0 is a family's leader: linked with all, and what is not linked with it is compared with all. Without a leader
    rows of kind 1 are compared with those of kind 2 that are of another part (component).
    """
    held: list = []

    def links():
        rows = {r[1]: r for r in reversed(held)}  # a leader is a member as well
        rows = sorted(rows.values(), key=lambda r: r[0])
        kind, reps = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        sizes, groups = np.array([len(s) for s in sets]), Groups(np.array([r[2] for r in rows]))
        if kind[0] == 0:
            owner = np.repeat(np.arange(len(sets)), sizes)
            both = np.bincount(owner[np.isin(np.concatenate(sets), sets[0])], minlength=len(sets))
            groups.join(0, np.flatnonzero(alike_enough(both, sizes[0], sizes)))
            asked = np.flatnonzero(groups.labels != groups.labels[0])
        else:
            asked = np.flatnonzero(kind == 1)
        if len(asked):
            for i, both in shared(sets, asked):
                groups.join(i, np.flatnonzero(alike_enough(both, sizes[i], sizes)))
        a, b = groups.stars(reps)
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    at = None
    for batch in batches:
        for place, *row in zip(*(batch[c].to_pylist() for c in ("place", "kind", "rep", "part", "shingles"))):
            if place != at and held:
                yield links()
                held.clear()
            at = place
            held.append(row)
    if held:
        yield links()


def in_blocks(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Staged links within blocks; ``rows`` is a staged table of place, kind, id, part."""
    placed = with_sets(rows, docs).select("place", "kind", F.col("id").alias("rep"), "part", "shingles")
    return staged(placed.repartition("place").sortWithinPartitions("place", "kind", "rep").mapInArrow(block_links, "a long, b long"), "near-links")


def in_families(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged members and families (family, blocks) of rows (family, rep, n)."""
    members = staged(members, "near-members")
    sizes = members.groupBy("family").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("n") * 8 / BLOCK_BYTES)).cast("int")
    return members, staged(sizes.select("family", blocks.alias("blocks")), "near-families")


def _place(block: Column) -> Column:
    return F.xxhash64("family", block).alias("place")


def _own_block() -> Column:
    return F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")


def _every_block() -> Column:
    return F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")


def family_links(members: DataFrame, families: DataFrame, docs: DataFrame) -> DataFrame:
    """Staged links with the leaders (families are called by them) and within blocks."""
    held = members.join(families, "family").select(_place(_own_block()), F.lit(1).alias("kind"), "rep")
    heads = families.select("family", _every_block()).select(_place(F.col("block")), F.lit(0).alias("kind"), F.col("family").alias("rep"))
    return in_blocks(staged(held.unionByName(heads).select("place", "kind", F.col("rep").alias("id"), F.col("rep").alias("part")), "near-blocks"), docs)


def outsider_links(members: DataFrame, families: DataFrame, parts: DataFrame, last: bool, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged links between the components of families, and the families that have too many outsiders for that."""
    part = parts.select(F.col("node").alias("rep"), F.col("component").alias("part"))
    own = staged(members.join(families, "family").join(part, "rep", "left").withColumn("part", F.coalesce("part", "rep")), "near-members")
    kinds = own.groupBy("family", "part").agg(F.count("*").alias("m"), F.sum("n").alias("n")).groupBy("family")
    largest = F.struct("m", "part")
    kinds = kinds.agg(F.max_by("part", largest).alias("main"), (F.sum("m") - F.max("m")).alias("outside"), (F.sum("n") - F.max_by("n", largest)).alias("n"))
    many = ((F.col("outside") > OUTSIDERS) | (F.col("n") * 8 > 2 * BLOCK_BYTES)) & F.lit(not last)
    kinds = staged(kinds.where("outside > 0").withColumn("many", many), "near-main")
    own = own.join(kinds.where("not many").select("family", "main"), "family")
    held = own.select(_place(_own_block()), F.lit(2).alias("kind"), "rep", "part")
    asked = own.where("part <> main").select("family", _every_block(), "rep", "part").select(_place(F.col("block")), F.lit(1).alias("kind"), "rep", "part")
    return in_blocks(staged(held.unionByName(asked).withColumnRenamed("rep", "id"), "near-blocks"), docs), kinds.where("many").select("family")


def chosen_path(reps: DataFrame, docs: DataFrame) -> list[DataFrame]:
    """Staged links (a, b) that join what is near; ``reps`` (rep, n, sig) is a staged table."""
    roots = F.explode(F.array(*[F.lit(int(x)) for x in mix64(np.arange(1, TREES + 1, dtype=np.uint64)).view(np.int64)]))
    rows, leaves, links, done = reps.select(roots.alias("key"), "rep", F.lit(False).alias("deep"), "sig"), [], [], None
    whole = reps.where("false").select(F.col("rep").alias("family"), "rep")
    level, deep = -1, False
    while level < LAST:
        step = 2 - (level < 0)  # below the first level large nodes take two steps at once
        level = max(0, level) + step
        nodes = staged(rows.mapInArrow(branch(step), "key long, rep long, deep boolean"), "near-nodes")
        sizes = staged(nodes.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "near-sizes")
        n_large = sizes.where(F.col("size") > LEAF).count()
        leaves.append(staged(nodes.join(sizes.where(F.col("size") <= LEAF), "key").select("key", "rep", "size"), "near-leaves"))
        if not n_large:
            break
        large = with_small(nodes, sizes.where(F.col("size") > LEAF), "key", "inner", n_large).join(reps.select("rep", "n", "low"), "rep")
        large = staged(large.select("key", "rep", "size", "deep", "n", "low"), "near-large")
        discard(nodes)
        led = leaders(large.where("not deep"))
        n_led = led.count()
        unlike = with_small(large, led, "key", "left_anti", n_led).where("not deep")
        few = F.lit(level >= LAST) | (F.col("size") <= UNLIKE)
        leaves.append(unlike.where(few).select("key", "rep", "size"))
        again, parted, called = [unlike.where(~few).select("key", "rep", "deep")], [], []
        n_again = with_small(sizes.where(~few & (F.col("size") > LEAF)), led, "key", "left_anti", n_led).count()
        if n_led:
            members, families = in_families(with_small(large, led, "key", "inner", n_led).select(F.col("leader").alias("family"), "rep", "n").distinct())
            if done is not None:  # what met under the same leader before is compared
                new = members.join(done, ["family", "rep"], "left_anti").select("family").distinct()
                families = staged(families.join(new, "family", "left_semi"), "near-families")
            if done is None or not families.isEmpty():
                links.append(family_links(members, families, docs))
            whole = whole.unionByName(members.join(families.where("blocks = 1"), "family", "left_semi").select("family", "rep"))
            if not families.where("blocks > 1").isEmpty():
                parted.append((members, families.where("blocks > 1")))
                called.append(led.select("key", F.col("leader").alias("family")))
            done = every([x for x in (done, members.select("family", "rep")) if x is not None])
        if deep:
            parted.append(in_families(large.where("deep").select(F.col("key").alias("family"), "rep", "n")))
            called.append(large.where("deep").select("key", F.col("key").alias("family")).distinct())
        deep = False
        if parted:
            parts = staged(components(every(links)), "near-parts")
            found, many = outsider_links(every([x for x, _ in parted]), every([x for _, x in parted]), parts, level >= LAST, docs)
            links.append(found)
            deep = not many.isEmpty()
            if deep:
                again.append(large.join(every(called).join(many, "family", "left_semi"), "key", "left_semi").select("key", "rep", F.lit(True).alias("deep")))
        if not n_again and not deep:  # deep nodes are counted too, and end with a level more
            break
        rows = every(again).join(reps.select("rep", "sig"), "rep").select("key", "rep", "deep", "sig")
    return [leaf_links(every(leaves), whole, reps, docs), *links]


def every(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _low_bytes(sig: Column) -> Column:
    """The lowest byte of each 32-bit value of a signature (every fourth byte of its hexadecimal form)."""
    return F.unhex(F.regexp_replace(F.hex(sig), "(..)......", "$1"))


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    with scratch(docs.sparkSession) as keep:
        sketched = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sketches, "doc_id long, n long, d1 long, d2 long, sig binary")
        sets = keep(staged(sketched, "near-sketches"))
        some = sets.where("n > 0 and doc_id is not null")
        first = staged(some.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "near-equal")
        repeated = staged(sets.groupBy("doc_id").count().where("count > 1").select("doc_id"), "near-repeated")
        own = first.select(F.col("rep").alias("doc_id"), "d1", "d2", "n", "rep")
        reps = some.join(own, ["doc_id", "d1", "d2", "n"]).select("rep", "n", "sig", _low_bytes(F.col("sig")).alias("low"))
        once = repeated.isEmpty()
        reps = staged(reps if once else reps.dropDuplicates(["rep"]), "near-reps")
        links = every(chosen_path(reps, docs))
        if not once:  # rows that repeat an id hold several sets under it: link what they are equal to
            same_id = some.join(repeated, "doc_id", "left_semi").select("doc_id", "d1", "d2", "n").join(first, ["d1", "d2", "n"]).where("doc_id <> rep")
            links = links.unionByName(same_id.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
        parts = staged(components(links).select(F.col("node").alias("rep"), "component"), "near-parts")
        component = first.join(parts, "rep", "left").select("d1", "d2", "n", F.coalesce("component", "rep").alias("component_id"))
        component = keep(staged(component, "near-components"))
    found = some.select("doc_id", "n", "d1", "d2").join(component, ["d1", "d2", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    rest = sets.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(rest)


def op9_near_duplicates(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_groups(table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document of the smallest id of each group, with the columns of ``docs``; rows that repeat an id count once."""
    with scratch(docs.sparkSession) as keep:
        gone = keep(staged(near_groups(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "near-gone"))
    out = with_small(docs, gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti", gone.count())
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return out
    once = out.where("doc_id is not null").dropDuplicates(["doc_id"])
    return once.unionByName(out.where("doc_id is null"))
