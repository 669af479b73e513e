"""A session with the settings that the operators expect."""

from pyspark.sql import SparkSession


def session(name: str = "skylattice", **conf) -> SparkSession:
    """UTC, adaptive execution, last tag wins. Partition counts and memory are left to the cluster unless given."""
    b = SparkSession.builder.appName(name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Bounds an Arrow batch by bytes. Called by what sends whole files or blobs to Python, as a batch of 10,000 of them fits nowhere."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))
    if now <= 0 or now > most:
        spark.conf.set(key, str(most))
