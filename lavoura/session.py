"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; safe to apply to a session somebody else created.
RUNTIME_CONF = {
    # Every timestamp in the data model is an instant in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot applicants, places or risk classes are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where a grouping by the join key follows, at the price of one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "134217728",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: int | str = "*", checkpoint_dir: str | None = None, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # Recording the call site of every column costs more than building a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
