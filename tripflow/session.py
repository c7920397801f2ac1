"""Session settings this library is run with. Queries themselves change no setting."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Timestamps without a zone are read as UTC wherever an instant is needed.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8000 bytes; beyond it, unfused code is much faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    # Large event-time state belongs on the executors' disks, not on their heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: str = "8", memory: str = "8g", **more: str) -> SparkSession:
    """A single-machine session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RECOMMENDED, **more}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
