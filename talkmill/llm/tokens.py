"""Whole-corpus encoding with a byte-level BPE vocabulary, by a pair occurrence index.

Each task splits its texts into words, and the words that it hasn't met yet are encoded together: an index maps
each rank to the positions of the pairs that make it, ranks are applied in ascending order, and each merge adds
the pairs it creates to the index. A merge is done once per distinct word and task. No shuffle, no driver step.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of the public vocabularies; a parameter of every function that needs one.
VOCABULARIES = "/opt/tokenizers"
#: Fixed value: the published word pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct words that a task keeps encoded; beyond it they're forgotten and encoded anew (results don't change).
KEPT_WORDS = 2_000_000
#: Characters encoded at a time; bounds a task's memory, results don't depend on it.
CHARS = 2_000_000


class PairIndexBpe:
    """Encoder over rank lines `base64 rank`; rank is also the id."""

    def __init__(self, lines: bytes):
        pairs = (line.split() for line in lines.splitlines() if line)
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes = {v: k for k, v in self.rank.items()}
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.merged: dict[tuple[int, int], int] = {}
        self.word = regex.compile(PATTERN)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _rank(self, a: int, b: int) -> int:
        r = self.merged.get((a, b))
        if r is None:
            r = self.merged[a, b] = self.rank.get(self.bytes[a] + self.bytes[b], -1)
        return r

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        total = int(sizes.sum())
        sym: list[int] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)].tolist()
        ends = np.cumsum(sizes)
        following, before = np.arange(1, total + 1), np.arange(-1, total - 1)
        following[ends - 1] = -1
        before[ends - sizes] = -1
        nxt, prv = following.tolist(), before.tolist()
        places: dict[int, list[int]] = {}
        rank = self._rank
        for i in range(total):
            j = nxt[i]
            if j >= 0 and (r := rank(sym[i], sym[j])) >= 0:
                places.setdefault(r, []).append(i)
        active = list(places)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            for i in sorted(places.pop(r)):
                a = sym[i]
                j = nxt[i] if a >= 0 else -1
                if j < 0 or rank(a, sym[j]) != r:
                    continue  # an earlier merge took one of the two
                k = nxt[j]
                sym[i], sym[j], nxt[i] = r, -1, k
                if k >= 0:
                    prv[k] = i
                    if (s := rank(r, sym[k])) >= 0:
                        if s not in places:
                            places[s] = []
                            heapq.heappush(active, s)
                        places[s].append(i)
                if (h := prv[i]) >= 0 and (s := rank(sym[h], r)) >= 0:
                    if s not in places:
                        places[s] = []
                        heapq.heappush(active, s)
                    places[s].append(h)
        left = np.array(sym, np.int64)
        alive = left >= 0
        owner = np.repeat(np.arange(len(words)), sizes)
        return left[alive].astype(np.int32), np.bincount(owner[alive], minlength=len(words))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text (0 for empty and null)."""
        found = [self.word.findall(t) if t else [] for t in texts]
        if len(self.number) > KEPT_WORDS:
            self._forget()
        new = list({w for ws in found for w in ws if w not in self.number})
        if new:
            ids, sizes = self._merge([w.encode() for w in new])
            base = len(self.ids)
            self.number.update(zip(new, range(len(self.starts), len(self.starts) + len(new))))
            self.starts = np.concatenate([self.starts, base + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, ids])
        counts = np.fromiter(map(len, found), np.int64, len(found))
        which = np.fromiter((self.number[w] for ws in found for w in ws), np.int64, int(counts.sum()))
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) - np.repeat(ends - sizes, sizes) + np.repeat(self.starts[which], sizes)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return self.ids[at], np.diff(edges)


def _vocabulary(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # a fixed file of under 1 MB


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHARS characters; a longer text is a range of its own."""
    size, a = 0, 0
    lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        if size and size + n > CHARS:
            yield a, i
            a, size = i, 0
        size += int(n)
    if a < len(lengths):
        yield a, len(lengths)


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = f"{VOCABULARIES}/byte_bpe_50k.tiktoken", counts_only: bool = False) -> DataFrame:
    """`key` and `ids` (array of int) of each row's text, without special tokens.

    Null and empty texts get an empty list; blank texts are encoded as they are; strings that look like special
    tokens are plain text; texts of any length are encoded whole. One row out per row in: repeated rows stay
    repeated, and a null key stays. Other columns are ignored. With `counts_only`, `n_tokens` (long) instead of `ids`.
    """
    lines = _vocabulary(documents.sparkSession, vocabulary)
    kind = documents.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PairIndexBpe(lines.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in _pieces(texts):
                ids, sizes = bpe.encode(texts[a:b].to_pylist())
                if counts_only:
                    out = pa.array(sizes, pa.int64())
                else:
                    out = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys[a:b], out], names=["key", "out"])

    schema = T.StructType([T.StructField("key", kind), T.StructField("out", T.LongType() if counts_only else T.ArrayType(T.IntegerType()))])
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).toDF(key, "n_tokens" if counts_only else "ids")


def vocabulary_path() -> str:
    return os.environ.get("TALKMILL_VOCABULARY", f"{VOCABULARIES}/byte_bpe_50k.tiktoken")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(documents, vocabulary=vocabulary_path())
