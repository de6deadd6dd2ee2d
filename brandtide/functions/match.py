"""String likeness that Spark lacks, as Arrow UDFs, with plain forms for tests."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def metaphone(word: str) -> str:
    """The published Metaphone code of a word's letters."""
    w = "".join(c for c in word.upper() if "A" <= c <= "Z")
    if not w:
        return ""
    if w[:2] in ("AE", "GN", "KN", "PN", "WR"):
        w = w[1:]
    elif w[0] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    out, n = [], len(w)
    at = lambda i: w[i] if 0 <= i < n else ""
    for i, c in enumerate(w):
        if c == at(i - 1) and c != "C":
            continue
        nxt, after, prev = at(i + 1), at(i + 2), at(i - 1)
        soft = nxt in ("E", "I", "Y") and nxt != ""
        if c in "AEIOU":
            out.append(c if i == 0 else "")
        elif c in "FJLMNR":
            out.append(c)
        elif c == "B":
            out.append("" if i == n - 1 and prev == "M" else "B")
        elif c == "C":
            if nxt == "I" and after == "A" or nxt == "H" and prev != "S":
                out.append("X")
            elif soft:
                out.append("" if prev == "S" else "S")
            else:
                out.append("K")
        elif c == "D":
            out.append("J" if nxt == "G" and after in ("E", "I", "Y") and after else "T")
        elif c == "G":
            silent = nxt == "H" and after and after not in "AEIOU" or nxt == "N" and (i + 2 == n or w[i + 1 :] == "NED")
            if silent or prev == "D" and soft:
                continue
            out.append("J" if soft and prev != "G" else "K")
        elif c == "H":
            out.append("H" if nxt and nxt in "AEIOU" and prev not in ("C", "S", "P", "T", "G") else "")
        elif c == "K":
            out.append("" if prev == "C" else "K")
        elif c == "P":
            out.append("F" if nxt == "H" else "P")
        elif c == "Q":
            out.append("K")
        elif c == "S":
            out.append("X" if nxt == "H" or nxt == "I" and after in ("O", "A") and after else "S")
        elif c == "T":
            if nxt == "I" and after and after in "AO":
                out.append("X")
            elif nxt == "H":
                out.append("0")
            elif not (nxt == "C" and after == "H"):
                out.append("T")
        elif c == "V":
            out.append("F")
        elif c in "WY":
            out.append(c if nxt and nxt in "AEIOU" else "")
        elif c == "X":
            out.append("KS")
        elif c == "Z":
            out.append("S")
    return "".join(out)


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (len a + len b), by the bit-parallel longest common subsequence; 100 for two empty words."""
    if not a and not b:
        return 100.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        match = row & where.get(c, 0)
        row = (row + match | row - match) & full
    return 200.0 * (len(a) - row.bit_count()) / (len(a) + len(b))


def best_of(word: str, names: dict[int, list[tuple[str, str]]]) -> tuple[float, str | None]:
    """The best ratio of a word, and the first name that has it; ``names`` are (name, skeleton) by length of skeleton.

    Lengths x and y allow 200 * min(x, y) / (x + y) at most, so lengths are tried from the nearest on until none can be
    better; 0 counts as no name.
    """
    best, found, n = 0.0, None, len(word)
    bound = lambda k: 200.0 * min(n, k) / (n + k) if n + k else 100.0
    for k in sorted(names, key=bound, reverse=True):
        if bound(k) < best or bound(k) == 0:
            break
        for name, other in names[k]:
            score = indel_ratio(word, other)
            if score > best or score == best > 0 and name < found:
                best, found = score, name
    return best, found


@F.pandas_udf(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("name", T.StringType())]))
def best_match_udf(words: pd.Series, names: pd.Series, skeletons: pd.Series) -> pd.DataFrame:
    """The best of the names in each row's list; rows of one list follow each other."""
    out, last, by_length = [], None, {}
    for word, own, other in zip(words, names, skeletons):
        if last is None or len(last) != len(own) or (last != own).any():
            last, by_length = own, {}
            for name, x in zip(own, other):
                by_length.setdefault(len(x), []).append((name, x))
        out.append(best_of(word, by_length))
    return pd.DataFrame(out, columns=["score", "name"])


@F.pandas_udf(T.StringType())
def metaphone_udf(words: pd.Series) -> pd.Series:
    return words.map(lambda x: None if x is None else metaphone(x))


@F.pandas_udf(T.DoubleType())
def indel_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else indel_ratio(x, y) for x, y in zip(a, b)], dtype="float64")
