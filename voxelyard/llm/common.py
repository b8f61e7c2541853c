"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words as the contracts of the mixing and SimHash operators define them.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Rows whose crc32(doc_id) has this remainder modulo 4 are held out of every training set.
HELD_OUT_REMAINDER = 2


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Where that is unset (tests in local mode) a temporary folder is made, and set as Spark's
    checkpoint folder. On a cluster an unset folder is an error, for a local one would not be seen
    by the executors.
    """
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if got:
        return got.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="voxelyard-")
    spark.sparkContext.setCheckpointDir(f"file://{made}")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/voxelyard/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut lineage: write df as Parquet in the shared folder and read it again with its schema.

    Survives lost executors, since no block of it lives on one of them.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a stage that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/voxelyard/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(
        F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT_REMAINDER, F.lit(False)
    )


def pieces(batch: pa.RecordBatch, column: int = 1, at_most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about at_most bytes of text each, at least a row; never cuts a text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if total + n > at_most and i > begin:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(n)
    if begin < batch.num_rows:
        yield batch.slice(begin)


def long_schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])
