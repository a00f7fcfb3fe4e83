"""Header rows of text files, read at the head of every file, so that a folder of them is read by name."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..model import WARNING, issue, issues_frame, local_table

#: Heads that are read at once.
THREADS = 16


def head_rows(spark: SparkSession, path: str, sep: str, count: int = 1) -> list[tuple[str, list[list[str]]]]:
    """(file, its first ``count`` rows) of every text file under ``path`` that has a row, by name.

    Only the first lines of a file are read, through the session's file systems. Lines without a character are no rows;
    a quoted line break goes on with the row.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def head(uri: str) -> tuple[str, list[list[str]]]:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        stream = at.getFileSystem(conf).open(at)
        codec = codecs.getCodec(at)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        rows: list[list[str]] = []
        try:
            while len(rows) < count and (line := reader.readLine()) is not None:
                while line.count('"') % 2 and (more := reader.readLine()) is not None:
                    line = f"{line}\n{more}"
                if line.strip():
                    rows.append(next(csv.reader([line], delimiter=sep)))
        finally:
            reader.close()
        return at.toString(), rows

    files = sorted(spark.read.text(str(path)).inputFiles())
    with ThreadPoolExecutor(THREADS) as pool:
        return [(file, rows) for file, rows in pool.map(head, files) if rows]


def by_layout(heads: Sequence[tuple[str, object]]) -> list[tuple[object, list[str]]]:
    """(layout, its files), layouts in the order of their first files."""
    groups: dict[object, list[str]] = {}
    for file, layout in heads:
        groups.setdefault(layout, []).append(file)
    return list(groups.items())


def literal_path(file: str) -> str:
    """A path that a reader does not take for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", file)


def text_layouts(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(file, position, name): the header of every text file, positions from 0."""
    rows = [(file, n, name) for file, head in head_rows(spark, path, sep) for n, name in enumerate(head[0])]
    return local_table(spark, rows, "file string, position int, name string")


def layout_findings(spark: SparkSession, path: str, sep: str, dataset_id: str, columns: Sequence[str] = (), stage: str = "input") -> DataFrame:
    """Findings about columns that some files lack, or that are not among ``columns`` where these are given."""
    return issues_frame(spark, layout_rows(spark, path, sep, dataset_id, columns, stage))


def layout_rows(spark: SparkSession, path: str, sep: str, dataset_id: str, columns: Sequence[str] = (), stage: str = "input") -> list[tuple]:
    headers = [set(head[0]) for _, head in head_rows(spark, path, sep)]
    rows = []
    for name in sorted(set(columns).union(*headers)):
        absent = sum(name not in h for h in headers)
        if absent:
            message = f"Column '{name}' is absent in {absent} of {len(headers)} files"
            rows.append(issue(dataset_id, stage, "column_absent_in_files", WARNING, message, column_name=name, row_count=absent))
        if columns and name not in columns:
            present = len(headers) - absent
            message = f"Column '{name}' of {present} files is not expected"
            rows.append(issue(dataset_id, stage, "column_unknown_in_files", WARNING, message, column_name=name, row_count=present))
    return rows
