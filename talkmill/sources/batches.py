"""Source files as content-addressed batches."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 20


@dataclass(frozen=True, order=True)
class Batch:
    batch_id: str
    path: str
    source_hash: str
    mtime: int


def batch_id(source_hash: str, mtime: int) -> str:
    return hashlib.sha256(f"{source_hash}:{mtime}".encode()).hexdigest()[:12]


def identify(path: str) -> Batch:
    """A batch's identity from its bytes and modification time; reads in chunks."""
    p, h = Path(path), hashlib.sha256()
    if not p.is_file():
        raise FileNotFoundError(path)
    with p.open("rb") as f:
        while chunk := f.read(CHUNK):
            h.update(chunk)
    mtime = int(p.stat().st_mtime)
    return Batch(batch_id(h.hexdigest(), mtime), str(p), h.hexdigest(), mtime)


class Known(Protocol):
    """Remembers the hash of a file by path, size and modification time; the manifest does."""

    def known_hash(self, path: str, size: int, mtime_ms: int) -> str | None: ...
    def keep_hash(self, path: str, size: int, mtime_ms: int, source_hash: str) -> None: ...


def discover(root: str, spark: SparkSession | None = None, known: Known | None = None) -> list[Batch]:
    """Parquet files of a folder, by batch id; none if the folder is missing.

    With a session the folder may be on any file system. A file whose path, size and time are `known` isn't read again,
    so a pass over an unchanged folder lists it and no more; new files are read as streams, in chunks.
    """
    if spark is None:
        return sorted(identify(str(p)) for p in Path(root).glob("*.parquet")) if Path(root).is_dir() else []
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(conf)
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name, local = status.getPath().toString(), status.getPath().toUri().getPath()
        if not name.endswith(".parquet") or not status.isFile():
            continue
        path = local if status.getPath().toUri().getScheme() == "file" else name
        size, mtime_ms = status.getLen(), status.getModificationTime()
        digest = known.known_hash(path, size, mtime_ms) if known else None
        if digest is None:
            stream = fs.open(status.getPath())
            try:
                digest = jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
            finally:
                stream.close()
            if known:
                known.keep_hash(path, size, mtime_ms, digest)
        mtime = mtime_ms // 1000
        out.append(Batch(batch_id(digest, mtime), path, digest, mtime))
    return sorted(out)


def pending(sources: DataFrame, manifest: DataFrame) -> DataFrame:
    """Sources without a completed batch."""
    return sources.join(manifest.where(F.col("status") == "COMPLETED").select("batch_id"), "batch_id", "left_anti")
