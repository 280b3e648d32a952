"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split by AQE even where the split costs one more shuffle downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Small arrow batches by count; Spark also bounds them by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def shuffle_partitions(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Initial shuffle partition count for a job that reads ``input_bytes``.

    AQE merges partitions that turn out small but never splits a plain aggregation, so the
    starting number has to fit the data: about ``target_bytes`` each, and at least one per core.
    """
    by_size = -(-input_bytes // target_bytes)
    return max(1, cores, by_size)


def fit_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Raise the session's shuffle partition count to what an input of this size needs.

    A larger count that is set already stays, and small inputs change nothing.
    """
    needed = shuffle_partitions(input_bytes, 1)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))


def get_session(
    app_name: str = "lakeloom",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """Return a session with :data:`DEFAULTS`; ``conf`` keys use ``__`` for dots.

    ``master`` is left to ``spark-submit`` unless given. ``input_bytes``, the size of what the job
    reads, sets the number of shuffle partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    if input_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions(input_bytes, cores))
    return spark
