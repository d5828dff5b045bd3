"""Shared storage for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the one in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder;
    on a cluster a missing setting is an error, because a machine-local folder
    would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster[...] has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="terracell-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, stem: str) -> str:
    """A fresh path below the shared folder.

    All paths of an application share one folder, to be deleted when it is done.
    """
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/terracell-{app}/{stem}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, stem: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Cuts the lineage (a lost executor rereads files instead of recomputing)
    and gives the optimizer true sizes for the joins that follow.
    """
    path = scratch_path(df.sparkSession, stem)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
