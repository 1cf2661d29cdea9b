"""Session builder for tests and benchmarks; on a cluster the caller's session is used."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", app: str = "riskloom", shuffle_partitions: int = 8, checkpoint_dir: str | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Call sites of column expressions are for notebooks; recording them slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()
