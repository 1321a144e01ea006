"""Session settings the operators count on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. AQE picks broadcast joins from measured sizes, merges
# small shuffle partitions and splits skewed ones, also where that costs one
# more shuffle, because a hot key may hold a third of all rows.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and send the package to its executors."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Make this package importable on every executor, once for each session.

    The archive is a file of the driver; Spark serves it to the executors.
    """
    sc = spark.sparkContext
    if getattr(sc, "_panelworks_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="panelworks-"), "panelworks.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                own = os.path.join(folder, name)
                archive.write(own, os.path.relpath(own, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._panelworks_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; make a temporary one only for a local master.

    On a cluster the folder has to be shared storage, so an unset
    ``spark.checkpoint.dir`` is an error there and not a reason to fall back to
    a disk that dies with its machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="panelworks-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return sc.getCheckpointDir()


def stored_table(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; its size in bytes is known from then on."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def persist_point(df: DataFrame) -> DataFrame:
    """Cut the lineage at ``df`` so that every later use sees the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
