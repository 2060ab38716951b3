"""Where intermediate tables go: the shared folder the cluster names."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in local mode.

    Executors can be lost at any time, so whatever cuts the lineage has to lie
    on storage that every executor can read.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="verbatide-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are stored and never computed again."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
