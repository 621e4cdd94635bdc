"""Publication that never overwrites: the same bytes again are accepted, others are refused."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.errors import PublishError

METADATA = ("source_system", "source_locator", "retrieved_at", "generated_at", "source_event_time", "season", "league_scope", "artifact_version", "schema_version", "redaction_status")


def envelope(metadata: dict, collection: dict, data: list[dict], page_counts: dict[int, int] | None = None) -> dict:
    """An artifact's content; page counts must add up to its rows."""
    if set(metadata) != set(METADATA):
        raise PublishError("metadata must have exactly its keys")
    if page_counts is not None and sum(page_counts.values()) != len(data):
        raise PublishError("page counts don't add up to the rows")
    return {"metadata": metadata, "collection": collection | ({"page_counts": page_counts} if page_counts is not None else {}), "data": data}


def publish_file(path: str | Path, artifact: dict) -> bool:
    """Writes a small artifact whole or not at all, and exclusively. False if the same bytes were there already."""
    path, body = Path(path), (json.dumps(artifact, ensure_ascii=False, sort_keys=True, indent=2) + "\n").encode()
    fd, temp = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(body)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(temp, path)
        except FileExistsError:
            if path.read_bytes() != body:
                raise PublishError(f"{path.name} exists with other content") from None
            return False
    finally:
        os.unlink(temp)
    return True


def publish_table(df: DataFrame, path: str) -> None:
    """Writes a table of any size beside its place and renames it there, which fails if something is there."""
    spark: SparkSession = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.exists(target):
        raise PublishError(f"{path} exists")
    staged = hadoop.Path(f"{path.rstrip('/')}.staged-{hashlib.sha256(os.urandom(16)).hexdigest()[:12]}")
    try:
        df.write.parquet(staged.toString())
        if fs.exists(target) or not fs.rename(staged, target):
            raise PublishError(f"{path} exists")
    finally:
        fs.delete(staged, True)


def lineage(spark: SparkSession, path: str) -> DataFrame:
    """(source, bytes, sha256) of files."""
    return spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "[^/]*$", 0).alias("source"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def load_artifact(path: str | Path) -> dict:
    """An artifact as envelope() makes it; raises PublishError for another shape."""
    from attestry.sources.strict_json import loads

    try:
        found = loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise PublishError(f"{Path(path).name} can't be read") from e
    if not isinstance(found, dict) or found.keys() != {"metadata", "collection", "data"} or not isinstance(found["metadata"], dict) or set(found["metadata"]) != set(METADATA) or not isinstance(found["data"], list):
        raise PublishError(f"{Path(path).name} has another shape")
    return found
