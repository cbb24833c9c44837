"""Session, scratch tables and the size checks that guard broadcasts."""

from __future__ import annotations

import atexit
import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that may be gathered on the driver or sent to every executor.
SMALL_ROWS = 100_000
#: Bytes, by the optimizer's own estimate, below which a side may be broadcast.
SMALL_BYTES = 32 << 20

_SCRATCH: dict[str, str] = {}


def session(name: str = "tessera", cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine is tested under."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; a folder of part files reads like a single file."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001 - the context may have ended before
        pass


def _scratch_root(spark: SparkSession) -> str:
    """The session's own folder below spark.checkpoint.dir.

    A folder of this machine is used only by a local session without that
    setting, as in tests, where every executor is on it; on a cluster a missing
    setting is an error. The folder goes when the driver ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + os.path.join(tempfile.gettempdir(), "tessera-scratch")
        root = _SCRATCH[app] = f"{base.rstrip('/')}/tessera-{app}"
        atexit.register(_delete, spark, root)
    return _SCRATCH[app]


def materialize(df: DataFrame, partition_by: list[str] | None = None, clean: bool = True) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return the written table.

    Cuts the lineage so that a lost executor costs tasks, not whole stages, and
    a result read several times is computed once. After the write the shuffle
    files of the job are garbage; Spark removes them when its own objects are
    collected, so the collectors are called now and not some time later;
    without ``clean`` they aren't, for loops of many small rounds. A table that
    no later plan reads can be dropped with :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{_scratch_root(spark)}/{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    schema = df.schema
    if clean:
        release(spark)
    out = spark.read.schema(schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` wrote; nothing may read it any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let the context cleaner drop shuffle files that nothing refers to."""
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - only a hint
        pass


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer partitions than the cluster has cores, dealt out to all of them.

    For work in Python over a few files that can't be split; a scan that fills
    the cores already is left as it is, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` after pushdown and pruning."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """Hint a broadcast only where the size estimate is below ``limit``.

    A larger side keeps no hint, so that Spark joins by shuffle.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def bounded_rows(df: DataFrame, limit: int = SMALL_ROWS) -> list:
    """All rows of a table that is small by its nature; an error above ``limit``.

    For reference lists and the like. One row more than the limit is asked for,
    so a table that has grown past it never floods the driver.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a table taken for small has more than {limit} rows")
    return rows


def row_blocks(df: DataFrame, size: int):
    """Rows in blocks of at most ``size``, without holding more than one block."""
    block: list = []
    for row in df.toLocalIterator():
        block.append(row)
        if len(block) >= size:
            yield block
            block = []
    if block:
        yield block
