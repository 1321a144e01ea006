"""Tables in the shared folder, and batch sizes.

``written`` cuts the lineage: what later steps read is a Parquet table in the folder of
``spark.checkpoint.dir``, so a lost executor repeats tasks and never a different result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelworks.session import ensure_checkpoint_dir, tune

#: Bytes of one Arrow batch; a row that is longer makes a batch of its own.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000


def prepared(spark: SparkSession) -> SparkSession:
    """Apply the settings these operators count on; ``tune`` also sends the package to the executors."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` in the shared folder and return the stored table."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._panelworks_path = path
    return stored


def dropped(*stored: DataFrame) -> None:
    """Remove tables of ``written`` that nothing reads any more."""
    for df in stored:
        path = getattr(df, "_panelworks_path", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def spread(files: DataFrame, by: str) -> DataFrame:
    """The rows, one for each file, dealt out so that about as many tasks read as there are files.

    The number is given, so adaptive execution does not merge the few small rows into one task; beyond eight tasks a
    core each task reads several files.
    """
    most = 8 * files.sparkSession.sparkContext.defaultParallelism
    return files.repartitionByRange(max(1, min(files.count(), most)), by)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The names, with more underscores where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{table}.parquet")
