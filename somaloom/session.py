"""Session defaults and scratch-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "somaloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; AQE and its skew-join handling stay on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOT: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for cut-lineage tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a session whose tasks all run in this machine's one process (``local[...]``, as in tests)
    may leave it unset; it then gets a private folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="somaloom-"))
    return _LOCAL_ROOT[0]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Used between the pileup stage and the stages that re-read it many times: the
    written table survives the loss of any executor.
    """
    path = f"{checkpoint_root(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
