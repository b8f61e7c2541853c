"""Cutting lineage between the stages of a long plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def _shared(df: DataFrame) -> str:
    """The checkpoint folder that driver and executors share, as cut describes it."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        if shared := df.sparkSession.conf.get("spark.checkpoint.dir", None):
            sc.setCheckpointDir(shared)
        elif not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='voxelyard-')}")
    return sc.getCheckpointDir().rstrip("/")


def store(df: DataFrame) -> DataFrame:
    """df as Parquet in the shared folder, uncompressed: for wide rows that several steps read some columns of.

    Names and sizes are then read without the contents, which a checkpoint could not do.
    """
    path = f"{_shared(df)}/voxelyard/store-{uuid.uuid4().hex}"
    df.write.option("compression", "uncompressed").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """df, computed and written to the checkpoint folder that driver and executors share.

    Plans stay small however many stages there are, and a lost executor loses nothing. Where no folder
    is set a temporary one is used in local mode; on a cluster that is an error.
    """
    _shared(df)
    return df.checkpoint(eager=True)
