"""Session settings the operators depend on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Without that setting only a
    local session gets a folder of its own: on a cluster a machine-local folder would lose the
    checkpoint together with the executor that wrote it.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cellrecon-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the short-lived tables made inside when it ends; what reads them has to run before that.

    Results are built from such tables, so a job writes its result within the scope.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a short-lived table in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later stages all see the very same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Store an intermediate table in the shared folder and read it back.

    Like a checkpoint, but Spark also knows the size of what it reads: a table that turns out small
    is broadcast where it is joined, and one that does not is shuffled.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
