"""What the operators of this subpackage share: the shared folder, written tables, Arrow helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is ``spark.checkpoint.dir`` where the session names one. A temporary folder stands in only on a
    local master, where driver and executors are one process.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="foliant-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read again: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, *paths: str) -> None:
    """Delete tables that no later step reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(conf).delete(at, True)


def shuffles_freed(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs: it does so when the driver has collected what stood for them,
    which it otherwise does at long intervals only (``spark.cleaner.periodicGC.interval``)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names given as keywords: other columns can't clash."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def rowwise(
    df: DataFrame,
    schema: T.StructType,
    build: Callable[[], Callable[[pa.RecordBatch], dict | pa.RecordBatch]],
    slice_bytes: int | None = None,
) -> DataFrame:
    """``mapInArrow`` where ``build`` runs once a task and its result once a batch of bounded bytes.

    The batch function returns the columns of ``schema`` by name.
    """
    names = [f.name for f in schema.fields]
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = build()
        for batch in batches:
            for part in sliced(batch, slice_bytes or SLICE_BYTES):
                out = step(part)
                yield pa.RecordBatch.from_arrays(
                    [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], arrow.field(n).type) for n in names],
                    schema=arrow,
                )

    return df.mapInArrow(run, schema)


#: A key with more rows than both of these allow is hot: ``HOT_ROWS``, and one ``HOT_KEYS``-th of all rows.
HOT_ROWS, HOT_KEYS = 1_000, 10_000


def spread_join(left: DataFrame, right: DataFrame, key: str, total: int, most: int, count: str = "copies") -> DataFrame:
    """Inner join of ``left`` with ``right``, where no task gets all rows of a hot key.

    ``right`` has a row for each key and, in ``count``, how many rows of ``left`` have it, ``most`` at the most;
    ``total`` is at least the number of left's rows. There are fewer than ``HOT_KEYS`` hot keys whatever the size, so
    that they are broadcast; all others are joined by key. ``left`` is read twice if there are hot keys.
    """
    bound = max(HOT_ROWS, total // HOT_KEYS)
    if most <= bound:
        return left.join(right.drop(count), key)
    hot = F.col(count) > bound
    few, rest = F.broadcast(right.filter(hot).drop(count)), right.filter(~hot).drop(count)
    return left.join(few, key).unionByName(left.join(few.select(key), key, "left_anti").join(rest, key))


def greatest(df: DataFrame, column: str = "copies") -> int:
    """The greatest value of a column, 0 if there is none."""
    return df.agg(F.max(column)).first()[0] or 0


#: A slice of a batch ends before this many bytes, or after one row.
SLICE_BYTES = 8 << 20


def sliced(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded size in bytes, so that long texts don't pile up."""
    n = batch.num_rows
    if n <= 1 or batch.nbytes <= most:
        if n:
            yield batch
        return
    half = n // 2
    yield from sliced(batch.slice(0, half), most)
    yield from sliced(batch.slice(half), most)
