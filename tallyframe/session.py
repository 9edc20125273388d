"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


#: Of local sessions without a shared folder, by application.
_OWN_FOLDERS: dict[str, str] = {}


def build_session(name: str = "tallyframe", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; leaves memory and partition counts to the caller."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir`` or has set a checkpoint folder. Only a local session without
    either gets a folder of its own, since executors on other machines
    could not read it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir, or a checkpoint folder, that all executors share")
    if not folder:
        if context.applicationId not in _OWN_FOLDERS:
            _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="tallyframe-")
        folder = _OWN_FOLDERS[context.applicationId]
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one written table."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, path: str) -> DataFrame:
    """The rows written to Parquet at this path, and read from there. The schema is known, so no job asks the files for it."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
