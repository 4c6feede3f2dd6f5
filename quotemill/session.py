"""Session settings the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings, safe to apply to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (ticker, date) may reuse a shuffle on ticker that a window needs anyway.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "quotemill", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; cluster settings come from ``spark-submit`` unless given here."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return folder.rstrip("/")
