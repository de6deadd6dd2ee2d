"""Best-fit packing under conflicts.

Documents longer than a bin fill whole bins with their first words; what remains of each document is one
piece. Pieces are dealt at random into groups of some thousand rows, and each group packs its pieces in
descending order of size. Open bins are kept in order of what they have left, and each carries bitmaps of
the sources and duplicate clusters within it. The search starts at the first bin that has room and goes on
to the next until it finds a compatible one, which is then the tightest; only if none is left, a bin opens.
Two pieces of one duplicate cluster (documents of equal text; near copies may share a bin) never share a bin, and no
bin holds more than ``per_source`` pieces of a source. There is no limit on bins or on how far the search goes within
the group; bins of other groups are not searched.

Defined results: null and empty texts have no piece (piece 0, bin_id null); a null source is a source, null
texts are a cluster; repeated rows are pieces of their own and conflict; an empty table gives an empty result. The
groups follow the rows' places in the input, so that the same rows in another layout may be packed otherwise.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandtide.llm.common import table, word_count
from brandtide.runtime import staged

CAPACITY, PER_SOURCE, GROUP_ROWS = 2048, 2, 4096
OUT = "doc_id long, n_words long, piece int, start_word long, piece_words long, bin_id long, bin_start long"


def pack(pieces: list[tuple[int, object, object]], capacity: int, per_source: int = PER_SOURCE) -> list[tuple[int, int]]:
    """(bin, offset in it) for each (size, source, cluster); sizes are 1 to capacity."""
    seen: dict = {}
    for _, _, c in pieces:
        seen[c] = seen.get(c, 0) + 1
    source_bit, cluster_bit = {}, {}
    for _, s, c in pieces:
        source_bit.setdefault(s, 1 << len(source_bit))
        if seen[c] > 1:  # a cluster of one piece conflicts with none
            cluster_bit.setdefault(c, 1 << len(cluster_bit))
    open_bins: list[tuple[int, int]] = []  # (words left, bin), ascending
    sources: list[list[int]] = []  # bitmaps of the sources that a bin has once, twice, ...
    clusters: list[int] = []
    out: list = [None] * len(pieces)
    for i in sorted(range(len(pieces)), key=lambda i: -pieces[i][0]):
        size, s, c = pieces[i]
        s, c = source_bit[s], cluster_bit.get(c, 0)
        k = bisect_left(open_bins, (size, -1))
        while k < len(open_bins) and (clusters[b := open_bins[k][1]] & c or sources[b][-1] & s):
            k += 1
        if k < len(open_bins):
            left, b = open_bins.pop(k)
        else:
            left, b = capacity, len(clusters)
            sources.append([0] * per_source)
            clusters.append(0)
        out[i] = (b, capacity - left)
        clusters[b] |= c
        for level in range(per_source):
            if not sources[b][level] & s:
                sources[b][level] |= s
                break
        if left > size:
            insort(open_bins, (left - size, b))
    return out


def packed(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """A row for each piece: doc_id, n_words, piece, start_word, piece_words, bin_id (unique, not gapless), bin_start."""
    slim = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("n_words"), F.xxhash64("text").alias("c1"), F.hash("text").alias("c2"), F.monotonically_increasing_id().alias("row")
        ),
        "pack-sizes",
    )
    n_groups = max(1, -(-slim.count() // group_rows))

    def pack_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("row", "ascending")]).to_pylist()
        rest = [(i, r["n_words"] % capacity) for i, r in enumerate(rows) if r["n_words"] % capacity]
        place = dict(zip((i for i, _ in rest), pack([(n, rows[i]["source"], (rows[i]["c1"], rows[i]["c2"])) for i, n in rest], capacity, per_source)))
        at, out = max((b for b, _ in place.values()), default=-1) + 1, []
        base = rows[0]["grp"] << 32
        for i, r in enumerate(rows):
            full = r["n_words"] // capacity
            for p in range(full):
                out.append((r["doc_id"], r["n_words"], p, p * capacity, capacity, base | at, 0))
                at += 1
            if i in place:
                out.append((r["doc_id"], r["n_words"], full, full * capacity, r["n_words"] - full * capacity, base | place[i][0], place[i][1]))
            elif not full:
                out.append((r["doc_id"], r["n_words"], 0, 0, 0, None, None))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in OUT.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return slim.withColumn("grp", F.pmod(F.xxhash64("row", "doc_id"), F.lit(n_groups))).groupBy("grp").applyInArrow(pack_group, OUT)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
