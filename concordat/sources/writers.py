"""Writers."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame, path: str, *, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> str:
    """Write Parquet or CSV by suffix, as a folder of files; parents are made."""
    kind = PurePosixPath(str(path)).suffix.lower()
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == ".parquet":
        writer.parquet(str(path))
    elif kind == ".csv":
        writer.option("header", True).option("escape", '"').csv(str(path))
    else:
        raise ValueError(f"Unsupported output type: {kind}")
    return str(path)
