"""Session settings the plans count on."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when an aggregate above would have reused the partitioning:
    # one extra exchange costs less than a task holding a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tuned(spark: SparkSession) -> SparkSession:
    """Put the settings on the caller's own session, for good: plans are lazy and run after this returns."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int | str = "*", memory: str = "8g", partitions: int = 8, shared_dir: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("almsbook")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    if shared_dir:
        builder = builder.config("spark.checkpoint.dir", shared_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)
