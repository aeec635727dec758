"""Session settings and the shared folder that every executor can reach.

Intermediate tables and stream checkpoints go to `<shared folder>/talkmill/<application id>/`. They're deleted when a
`scratch` block ends in which they were made, and all that is left of them when the driver ends.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine (or a shared disk) import the package from where the driver has it."""
    here, env = str(Path(__file__).parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, here])
    return spark


def local_session(cores: int | str = 8, partitions: int | None = None, app: str = "talkmill") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(partitions or cores)).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    return importable(b.getOrCreate())


#: Folders made for applications whose setting is unset (local masters only).
_MADE: dict[str, str] = {}
#: Paths of the open scratch blocks, innermost last.
_OPEN: list[list[str]] = []
_SEEN: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset a local master gets one of its own; a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if app not in _MADE:
        _MADE[app] = tempfile.mkdtemp(prefix="talkmill-")
        atexit.register(shutil.rmtree, _MADE[app], True)
    return _MADE[app]


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes paths of any file system, missing ones silently."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for x in paths:
        path = jvm.org.apache.hadoop.fs.Path(x)
        path.getFileSystem(conf).delete(path, True)


def _own(spark: SparkSession) -> str:
    root = f"{shared_root(spark)}/talkmill/{spark.sparkContext.applicationId}"
    if root not in _SEEN:
        _SEEN.add(root)

        def clear():
            with contextlib.suppress(Exception):  # the session may be gone before the driver ends
                remove(spark, root)

        atexit.register(clear)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder for a table or a stream's checkpoint."""
    path = f"{_own(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """What is written inside is deleted at the end; results must have been used or stored elsewhere by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        remove(spark, *_OPEN.pop())


def written(df, name: str):
    """`df` as a table in the shared folder: cuts lineage, survives a lost executor and is computed once."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
