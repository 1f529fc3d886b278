"""Materialising intermediate results in the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import contextvars
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir
from ..sources import files

_open: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("staged", default=None)


@contextlib.contextmanager
def staging(spark: SparkSession):
    """Removes, at its end, every folder that :func:`materialize` writes within.

    For steps that write their results: what they staged is of no use afterwards. Frames that
    still read staged folders must not outlive the block.
    """
    staged: list[str] = []
    token = _open.set(staged)
    try:
        yield staged
    finally:
        _open.reset(token)
        for path in staged:
            files.remove(spark, path)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the session's shared checkpoint folder and
    return a frame reading it back.

    Cuts lineage like ``checkpoint()``: later passes (counts, ranks) read stable
    files, and a lost executor re-reads instead of recomputing upstream shuffles.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/starloom-stage/{label}-{uuid.uuid4().hex}"
    staged = _open.get()
    if staged is not None:
        staged.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
