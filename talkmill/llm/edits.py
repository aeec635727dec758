"""Small edit distances: symmetric-delete neighbourhoods and restricted Damerau-Levenshtein distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.functions import broadcast


def deletes(word: str, depth: int) -> set[str]:
    """The word and all that is left of it after deleting up to `depth` letters."""
    found = {word}
    last = {word}
    for _ in range(depth):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        found |= last
    return found


def distance(a: str, b: str, most: int = 2) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours; `most` + 1 if it's more than `most`."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    far = most + 1
    before: list[int] = []
    row = [min(j, far) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [far] * (len(b) + 1)  # only a band of 2 * most + 1 cells can be near
        new[0] = min(i, far)
        low, high = max(1, i - most), min(len(b), i + most)
        best = new[0]
        for j in range(low, high + 1):
            y = b[j - 1]
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new[j] = min(d, far)
            best = min(best, d)
        if best > most:
            return far
        before, row = row, new
    return row[-1]


#: Longer words are found by unchanged segments instead of deletions, whose number grows with the square of the length.
LONG = 40


def _cuts(n: int, parts: int) -> list[tuple[int, int]]:
    """Borders of `parts` nearly equal segments of a word of n letters."""
    return [(n * i // parts, n * (i + 1) // parts) for i in range(parts)]


def _key(n: int, i: int, segment: str) -> str:
    return f"#{n}.{i}.{hashlib.blake2b(segment.encode(), digest_size=12).hexdigest()}"


def index_keys(word: str, depth: int) -> set[str]:
    """Keys under which a word is kept: its deletions, or its 2 * depth + 1 segments if it's long (one of them survives `depth` edits; a swap counts as two)."""
    if len(word) <= LONG:
        return deletes(word, reach(len(word), depth))
    return {_key(len(word), i, word[a:b]) for i, (a, b) in enumerate(_cuts(len(word), 2 * depth + 1))}


def probe_keys(word: str, depth: int) -> set[str]:
    """Keys under which all words within `depth` edits of a word are kept."""
    keys = deletes(word, reach(len(word), depth)) if len(word) <= LONG + depth else set()
    for n in range(max(LONG + 1, len(word) - depth), len(word) + depth + 1):
        for i, (a, b) in enumerate(_cuts(n, 2 * depth + 1)):
            keys |= {_key(n, i, word[s : s + b - a]) for s in range(max(0, a - depth), min(len(word) - (b - a), a + depth) + 1)}
    return keys


def reach(n: int, depth: int = 2) -> int:
    """How many letters a word of n letters may lose in the index."""
    return 0 if n < 4 else min(1, depth) if n < 5 else depth


def allowed(a: int, b: int, depth: int = 2) -> int:
    """The largest distance at which words of a and b letters are taken for spellings of one word."""
    low, high = min(a, b), max(a, b)
    return 0 if low < 3 or high < 4 else min(1, depth) if low < 5 or high < 7 else depth


def close_pairs(left: DataFrame, right: DataFrame, group: str | None = None, depth: int = 2, small_right: bool = False) -> DataFrame:
    """Pairs (group, a, b, d) of distinct words `word` of both sides (of the same `group`) whose distance d is `allowed`.

    Each word emits its own deletions, and only words that share one are compared: no word meets all others.
    `small_right` says that the right side was counted and its keys may be broadcast.
    """
    both = [group] if group else []

    def spread(keys):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = [(*r, k) for r in b.itertuples(index=False, name=None) for k in keys(r[-1], depth)]
                yield pd.DataFrame(rows, columns=[*both, "word", "key"])

        return run

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            most = [allowed(len(x), len(y), depth) for x, y in zip(b["a"], b["b"])]
            b["d"] = [distance(x, y, m) for x, y, m in zip(b["a"], b["b"], most)]
            yield b[b["d"] <= most]

    head = f"{group} string, " if group else ""

    spark = left.sparkSession
    # few bytes but much work per word: spread by number of tasks, not by size
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def keyed(df: DataFrame, keys) -> DataFrame:
        return df.select(*both, "word").distinct().repartition(tasks, "word").mapInPandas(spread(keys), f"{head}word string, key string")

    keys = keyed(right, probe_keys).withColumnRenamed("word", "b")
    pairs = keyed(left, index_keys).withColumnRenamed("word", "a").join(broadcast(keys) if small_right else keys.hint("merge"), [*both, "key"]).select(*both, "a", "b").distinct()
    return pairs.mapInPandas(measure, f"{head}a string, b string, d int")
