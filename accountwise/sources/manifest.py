"""SHA-256 manifest of a dataset and its verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = ("joblib", "pkl", "pickle", "json", "parquet", "csv")

#: Files are read in pieces of this size.
CHUNK_BYTES = 8 << 20


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it. Only the store's root is parsed as a URI: names need no escapes."""
    scheme, _, rest = path.partition("://") if "://" in path else ("file", "", path.removeprefix("file:"))
    if scheme == "file":
        return fs.LocalFileSystem(), rest
    authority, _, name = rest.partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{name}"


def _hashed(frames: Iterator[pd.DataFrame], chunk: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, size in zip(frame["path"], frame["bytes"]):
            system, name = _opened(path)
            digest = hashlib.sha256()
            with system.open_input_stream(name) as stream:
                while block := stream.read(chunk):
                    digest.update(block)
            yield pd.DataFrame({"path": [path], "bytes": [size], "sha256": [digest.hexdigest()]})


def manifest(
    spark: SparkSession, folder: str, suffixes: tuple[str, ...] = SUFFIXES, chunk: int = CHUNK_BYTES
) -> DataFrame:
    """Relative path, size and hash of every file below a folder; hashing runs in the tasks.

    Every file, small or large, is read through Arrow's file systems in chunks, so its size is not bounded by memory; a
    store that Arrow cannot open fails the job instead of leaving files unverified.
    """
    root = folder.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}")
        .load(root)
    )
    bare = root.split("://", 1)[-1].removeprefix("file:")
    relative = F.element_at(F.split("path", F.lit("\\Q" + bare + "/\\E"), 2), -1)
    listed = files.select("path", F.col("length").alias("bytes")).repartition("path")
    hashed = listed.mapInPandas(lambda frames: _hashed(frames, chunk), "path string, bytes long, sha256 string")
    return hashed.select(relative.alias("path"), "bytes", "sha256")


def verify(expected: DataFrame, current: DataFrame) -> DataFrame:
    """ok / changed / missing / new per file."""
    old, new = expected.alias("old"), current.alias("new")
    both = old.join(new, F.col("old.path") == F.col("new.path"), "full_outer")
    status = (
        F.when(F.col("new.path").isNull(), "missing").when(F.col("old.path").isNull(), "new")
        .when(F.col("old.sha256") == F.col("new.sha256"), "ok").otherwise("changed")
    )
    return both.select(F.coalesce("old.path", "new.path").alias("path"), status.alias("status"))


def entry_status(verified: DataFrame) -> DataFrame:
    """The same for every entry of the dataset's folder, a table in one file or in many: the status of its files if it is one
    for all, else changed."""
    both = F.when(F.min("status") == F.max("status"), F.min("status")).otherwise("changed")
    return verified.groupBy(F.substring_index("path", "/", 1).alias("path")).agg(both.alias("status"))


def require_intact(expected: DataFrame, current: DataFrame) -> None:
    """Fail closed: any changed, missing or unlisted file stops the job."""
    bad = verify(expected, current).where(F.col("status") != "ok")
    shown = [f"{r['path']}: {r['status']}" for r in bad.orderBy("path").limit(20).collect()]
    if shown:
        raise RuntimeError("dataset does not match its manifest: " + "; ".join(shown))
