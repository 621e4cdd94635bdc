"""What several operators share: reading tables, cutting lineage, streaming sorted groups through Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows an operator's Python side hands back at once.
OUT_ROWS = 4096
#: Bytes of text after which it hands them back early.
OUT_BYTES = 4 << 20
#: Bytes of rows that Python gets at once.
BATCH_BYTES = 4 << 20
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workdir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where that is unset a temporary one is made on a local master, as in tests; on a cluster that raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        sc = spark.sparkContext
        held = sc._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="attestry-")
        sc.setCheckpointDir(found)
        found = sc._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: its lineage ends there, and a lost executor costs no recomputation."""
    bound_batches(df.sparkSession)
    path = f"{workdir(df.sparkSession)}/attestry-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._attestry_path = path
    return out


def forget(*frames: DataFrame | None) -> None:
    """Deletes tables that written() made and nothing reads any more."""
    for df in frames:
        if path := getattr(df, "_attestry_path", None):
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])
            where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def bound_batches(spark: SparkSession) -> None:
    """Rows come to Python by BATCH_BYTES unless the session says otherwise; by default they come 10,000 at a time, however long."""
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner", most_hot: int = 1000, least_hot: int = 200) -> DataFrame:
    """left joined to right, which has a key once, with the rows of left's hot keys dealt over several tasks.

    A key is hot with more than least_hot rows and more than one in most_hot of all, so that there are most_hot of them at most; these few are
    broadcast with the number of their parts, and right's row of a hot key is repeated for each part. how: inner or left.
    """
    per = left.where(F.col(left_key).isNotNull()).groupBy(F.col(left_key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
    per = written(per.where(F.col("__n") > least_hot), "hot")
    bound = max(least_hot, (per.agg(F.sum("__n")).first()[0] or 0) // most_hot)
    hot = per.where(F.col("__n") > bound).select("__hot", F.ceil(F.col("__n") / bound).cast("int").alias("__parts"))
    columns = [*left.columns, *right.columns]
    if not hot.head(1):
        return left.join(right, F.col(left_key) == F.col(right_key), how)
    hot = F.broadcast(hot)  # most_hot rows at most
    parts = F.coalesce("__parts", F.lit(1))
    a = left.join(hot, F.col(left_key) == F.col("__hot"), "left").withColumn("__part", F.pmod(F.xxhash64(*(c for c, kind in left.dtypes if kind in ("string", "bigint", "int"))), parts).cast("int")).drop("__hot", "__parts")
    b = right.join(hot, F.col(right_key) == F.col("__hot"), "left").withColumn("__copy", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__hot", "__parts")
    return a.join(b, (F.col(left_key) == F.col(right_key)) & (F.col("__part") == F.col("__copy")), how).select(*columns)


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[tuple]], schema: T.StructType | str, binary: tuple[str, ...] = ()) -> DataFrame:
    """mapInArrow with plain Python rows: fn gets tuples of df's columns and yields tuples of schema's.

    Strings named in binary arrive as UTF-8 bytes. Batches go out by rows and by bytes, so that long texts don't pile up.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    columns = [part.column(i).cast(pa.binary()) if n in binary else part.column(i) for i, n in enumerate(names)]
                    yield from zip(*(c.to_pylist() for c in columns), strict=True)

        held, size = [], 0
        for row in fn(rows()):
            held.append(row)
            size += sum(len(x) for x in row if isinstance(x, (str, bytes, list)))
            if len(held) >= OUT_ROWS or size >= OUT_BYTES:
                yield pack(held, arrow)
                held, size = [], 0
        if held:
            yield pack(held, arrow)
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def pack(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def grouped(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Groups of rows whose first width fields are equal, from rows that arrive sorted by them; one row is held at a time."""
    import itertools

    return itertools.groupby(rows, key=lambda r: r[:width])


def words_of(text: str = "text"):
    """Column: the text with each of the six white-space characters as one space."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\f\r", "     ")


def count_words(text: str = "text"):
    """Column: how many runs of other characters than space and U+0009 to U+000D the text has."""
    return F.size(F.array_remove(F.split(words_of(text), " "), "")).cast("long")
