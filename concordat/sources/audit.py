"""Audit of input files: presence, size, time and SHA-256, many files in parallel."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from pathlib import PurePosixPath
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import CheckResult, DatasetSpec, ERROR, INFO, issue, issues_frame, local_table
from .layouts import layout_rows
from .readers import DELIMITERS

FILE_COLUMNS = ("path", "name", "size_bytes", "modified_at", "suffix")
CHUNK_BYTES = 4 * 1024 * 1024
# Settings of object stores begin with these.
STORES = ("fs.s3a.", "fs.azure.")


def audit_files(spark: SparkSession, path: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """Path, name, size, time and suffix of every file under ``path``; contents are not read."""
    listed = _with_empty_files(_binary(spark, path, recursive))
    name = F.element_at(F.split("path", "/"), -1)
    extension = F.regexp_extract(name, r"(\.[^.]+)$", 1)
    return listed.select(
        "path",
        name.alias("name"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
        F.lower(extension).alias("suffix"),
    )


def _binary(spark: SparkSession, path: str | Sequence[str], recursive: bool) -> DataFrame:
    paths = [str(path)] if isinstance(path, (str, bytes)) or not isinstance(path, Sequence) else [str(p) for p in path]
    return spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(paths)


def _with_empty_files(files: DataFrame) -> DataFrame:
    """The scan leaves out files without a byte, but the listing, which the driver holds, has them."""
    found = files.select("path", "modificationTime", "length")
    listing = local_table(files.sparkSession, [(unquote(uri),) for uri in files.inputFiles()], "uri string")
    # the listing writes file:///a where the scan writes file:/a
    as_scanned = F.regexp_replace("uri", "^file:/+", "file:/")
    empty = listing.select(as_scanned.alias("path")).join(found, "path", "left_anti")
    return found.unionByName(empty.withColumn("length", F.lit(0).cast("long")), allowMissingColumns=True)


def store_settings(spark: SparkSession) -> dict[str, str]:
    """What the session says of its object stores (endpoints, keys, regions), by Hadoop's names."""
    conf = spark._jsc.hadoopConfiguration()
    return {f"{store}{name}": value for store in STORES for name, value in conf.getPropsWithPrefix(store).items()}


def store_locator(settings: Mapping[str, str]) -> Callable[[str], tuple[str, dict[str, str], str]]:
    """A function from a file's URI to the kind of its store, the options to open that with, and the place in it.

    The options are those with which Spark reads the same file, a bucket's own before the general ones. It travels
    to the workers by value, so they need neither this package nor settings of their own.
    """
    settings = dict(settings)

    def locate(uri: str) -> tuple[str, dict[str, str], str]:
        scheme, _, rest = uri.partition(":")
        place = rest.lstrip("/")
        if scheme in ("s3", "s3a", "s3n"):
            bucket = place.partition("/")[0]

            def of(name: str) -> str:
                return settings.get(f"fs.s3a.bucket.{bucket}.{name}", settings.get(f"fs.s3a.{name}", ""))

            kind, _, host = of("endpoint").rpartition("://")
            plain = kind == "http" or (not kind and of("connection.ssl.enabled") == "false")
            options = {
                "access_key": of("access.key"), "secret_key": of("secret.key"), "session_token": of("session.token"),
                "role_arn": of("assumed.role.arn"), "region": of("endpoint.region"),
                "endpoint_override": "" if host == "s3.amazonaws.com" else host.rstrip("/"), "scheme": "http" if plain else "",
            }
            return "s3", {k: v for k, v in options.items() if v}, place
        if scheme in ("abfs", "abfss", "wasb", "wasbs"):
            authority, _, inside = place.partition("/")
            container, _, host = authority.partition("@")
            key = settings.get(f"fs.azure.account.key.{host}", "")
            return "azure", {"account_name": host.partition(".")[0], **({"account_key": key} if key else {})}, f"{container}/{inside}"
        return scheme, {}, uri

    return locate


def _streamed_hashes(files: DataFrame, chunk_bytes: int) -> DataFrame:
    """Path and SHA-256 of files, each read a chunk at a time: one way for every size, so memory is one chunk."""
    spark = files.sparkSession
    locate = store_locator(store_settings(spark))

    # built here, so that it travels to the workers by value: they need not have this package
    def stream_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        from urllib.parse import quote

        from pyarrow import fs

        opened = {}
        for batch in batches:
            digests = []
            for uri in batch["path"]:
                kind, options, place = locate(uri)
                try:
                    if kind in ("s3", "azure"):
                        store = (kind, *sorted(options.items()))
                        if store not in opened:
                            opened[store] = (fs.S3FileSystem if kind == "s3" else fs.AzureFileSystem)(**options)
                        filesystem = opened[store]
                    else:
                        scheme, _, location = place.partition(":")
                        filesystem, place = fs.FileSystem.from_uri(f"{scheme}:{quote(location)}")
                except Exception as error:
                    raise ValueError(f"Cannot stream {uri} to hash it: {error}") from error
                digest = hashlib.sha256()
                with filesystem.open_input_stream(place) as stream:
                    while chunk := stream.read(chunk_bytes):
                        digest.update(chunk)
                digests.append(digest.hexdigest())
            yield batch[["path"]].assign(sha256=digests)

    # dealt out one by one, as hashing a file is serial; a stated number is not merged again for its few bytes
    tasks = max(1, min(len(files.inputFiles()), 4 * spark.sparkContext.defaultParallelism))
    return files.select("path").repartition(tasks).mapInPandas(stream_hashes, "path string, sha256 string")


def collect_file_metadata(
    spark: SparkSession,
    path: str | Sequence[str],
    include_hash: bool = True,
    recursive: bool = True,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``audit_files`` with the SHA-256 of every file, read in chunks of ``chunk_bytes``."""
    metadata = audit_files(spark, path, recursive)
    if not include_hash:
        return metadata
    hashes = _streamed_hashes(_binary(spark, path, recursive), chunk_bytes)
    no_bytes = F.when(F.col("size_bytes") == 0, F.sha2(F.lit("").cast("binary"), 256))
    joined = metadata.join(hashes, "path", "left")
    return joined.withColumn("sha256", F.coalesce("sha256", no_bytes))


def file_hashes(
    spark: SparkSession, path: str | Sequence[str], recursive: bool = True, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Path and SHA-256 of every file, of any size."""
    return collect_file_metadata(spark, path, True, recursive, chunk_bytes).select("path", "sha256")


def _listed_files(spark: SparkSession, path: str) -> list[str] | None:
    """Files the listing finds under a path; None when there is no such path."""
    try:
        return _binary(spark, path, True).inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def validate_file_exists(
    spark: SparkSession, path: str, dataset_id: str, stage: str = "input", with_info: bool = True
) -> tuple[bool, DataFrame]:
    """A table may be a file or a folder of files; a folder without any counts as absent."""
    rows, files = [], _listed_files(spark, path)
    if files is None:
        rows.append(issue(dataset_id, stage, "file_exists", ERROR, f"Missing file: {path}"))
    elif not files:
        rows.append(issue(dataset_id, stage, "is_file", ERROR, f"Path is not a file: {path}"))
    elif with_info:
        rows.append(issue(dataset_id, stage, "file_exists", INFO, f"Input file located: {path}"))
    return all(r[3] != ERROR for r in rows), issues_frame(spark, rows)


def validate_file_input(spark: SparkSession, spec: DatasetSpec, include_hash: bool = True) -> CheckResult:
    step = f"{spec.dataset_id}_input_validation"
    found, issues = validate_file_exists(spark, spec.path, spec.dataset_id, with_info=False)
    if not found:
        empty = local_table(spark, [], "path string, size_bytes long, sha256 string")
        return CheckResult(step, spec.dataset_id, empty, issues)
    kind = (spec.file_type or PurePosixPath(str(spec.path)).suffix.lstrip(".")).lower()
    if kind in DELIMITERS and not spec.header_strategy:
        rows = layout_rows(spark, spec.path, DELIMITERS[kind], spec.dataset_id)
        issues = issues.union(issues_frame(spark, rows)) if rows else issues
    metadata = collect_file_metadata(spark, spec.path, include_hash)
    shown = ["path", "size_bytes", *(["sha256"] if include_hash else [])]
    return CheckResult(step, spec.dataset_id, metadata.select(*shown), issues)
