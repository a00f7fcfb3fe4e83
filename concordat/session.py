"""Spark session settings the operators are designed for."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed partitions even where the output feeds another keyed operator
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # merge outputs are written by row origin: three open files per task instead of a sort
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # no Python stack is recorded per column expression: wide tables build several times faster
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


#: Stored tables not yet removed, by path.
_STORED: dict[str, DataFrame] = {}


def sized_conf(shuffled_bytes: int, cores: int, partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Settings that keep a partition of the largest shuffle near ``partition_bytes``.

    The count is where adaptive execution starts; it merges small partitions and splits skewed ones.
    """
    partitions = max(2 * cores, -(-shuffled_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def build_session(app_name: str = "concordat", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """The session with ``conf`` while a table is written; what was set before is set again after."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a folder of its own, below the warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return configured.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder and read it from there.

    A lost executor then costs a read, not the work before, and each later use reads only the
    columns it needs. ``discard`` removes the table, ``discard_all`` those of the whole session.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _STORED[path] = table
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote and nothing reads any more."""
    for path in [p for p, kept in _STORED.items() if any(kept is t for t in tables)]:
        spark = _STORED.pop(path).sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard_all() -> None:
    """Remove every stored table, at the end of a run whose results are written."""
    discard(*_STORED.values())
