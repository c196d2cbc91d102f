"""Where lineage is cut and stage outputs are kept.

Every folder comes from ``spark.checkpoint.dir``, which on a cluster names storage all
executors share.  Only a local-mode session may fall back to a folder of its own.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Folders made inside each open :func:`stages` block, innermost last.
_OPEN: list[list[str]] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local-mode session without one gets a private one."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if configured:
        if not current.isDefined():
            context.setCheckpointDir(configured)
        return configured
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="keelson-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` below the checkpoint folder and go on from the written table.

    Unlike an in-memory copy the table outlives lost executors; unlike an RDD checkpoint it
    carries no constraints of the old plan into the next, which loops would pile up, and
    its known size lets the planner choose joins by measure.
    """
    spark = df.sparkSession
    path = work_folder(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the checkpoint folder, for a stage's output."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextlib.contextmanager
def stages(spark: SparkSession) -> Iterator[list[str]]:
    """Own the stage folders made inside the block, and remove them at its end.

    Write or collect the result inside: what is read after the block must not depend on a stage.
    """
    folders: list[str] = []
    _OPEN.append(folders)
    try:
        yield folders
    finally:
        _OPEN.remove(folders)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)
