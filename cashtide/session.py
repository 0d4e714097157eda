"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the plans rely on. Sizes are left to the cluster's own configuration.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the rows have to be exchanged again afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sessions of a stream are merged in the map tasks first: a task gets the sessions of an account, not its posts.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "cashtide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="cashtide-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors and stops plan growth in loops."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to a scratch Parquet table and read from there.

    For inputs that are costly to compute and scanned several times with few columns: unlike a
    checkpoint the table is columnar, so a scan of the key column reads only that.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
