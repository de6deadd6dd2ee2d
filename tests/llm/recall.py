"""Compares op9_near_duplicates with an exact join of all documents of a folder.

    python tests/llm/recall.py /root/testdata/sf0.1

Prints the links of the exact join (prefix filter over words, no hashes), how many of them the query has in one
component, and the documents whose component differs.
"""

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact_links(rows):
    """Pairs of ids whose sets share 75 of 100 shingles, equal texts by their least id only."""
    number: dict = {}
    sets, first = {}, {}
    same = []
    for i, text in sorted(rows):
        words = WORD.findall((text or "").translate(LOW))
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []
        own = frozenset(number.setdefault(g, len(number)) for g in grams)
        if own:
            if own in first:
                same.append((first[own], i))
            else:
                first[own] = i
                sets[i] = own
    frequent = collections.Counter(x for s in sets.values() for x in s)
    held, out = collections.defaultdict(list), []
    for i, s in sorted(sets.items(), key=lambda p: len(p[1])):
        order = sorted(s, key=lambda x: (frequent[x], x))
        prefix = order[: len(s) - -(-3 * len(s) // 4) + 1]
        for j in {j for x in prefix for j in held[x]}:
            if 4 * len(sets[j]) >= 3 * len(s) and 100 * (both := len(s & sets[j])) >= 75 * (len(s) + len(sets[j]) - both):
                out.append((min(i, j), max(i, j)))
        for x in prefix:
            held[x].append(i)
    return out, same


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i: find(i) for i in ids}


def main(sf_dir):
    from pyspark.sql import SparkSession

    from brandtide.llm import near_dedup

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.op9_near_duplicates(spark, sf_dir).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    links, same = exact_links(rows)
    want = components(got, links + same)
    print(f"{len(got)} documents, {len(links)} links between different sets, {sum(got[a] == got[b] for a, b in links)} of them found, {sum(got[i] != c for i, c in want.items())} components differ")


if __name__ == "__main__":
    main(sys.argv[1])
