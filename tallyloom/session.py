"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All of these are runtime SQL settings, so they can be applied to a session that already exists.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # without it a shuffle has spark.sql.shuffle.partitions parts whatever the input, and the sizes below do nothing
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs a shuffle further down
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Bytes at most; a session's smaller value stays. The hash maps and sorts of a task hold several times the bytes it reads, which are compressed.
AT_MOST = {
    # adaptive execution joins shuffled partitions up to this size
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    # a scan's task combines what it reads before the shuffle
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}

# A shuffle starts with a partition for this many bytes of the tables read, where the session has fewer; what one shuffle sends is about as much as they hold.
READ_PER_PARTITION = 8 << 20
# More would be blocks too small to fetch; beyond this, partitions grow and Spark spills.
MOST_PARTITIONS = 10_000
SHUFFLED, INITIAL = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in AT_MOST.items():
        if as_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    return spark


def follow_input(spark: SparkSession, read_bytes: int) -> None:
    """Let shuffles start with as many partitions as the input asks for; adaptive execution joins the small ones again.

    Their number is raised only, as frames are run after others were made in the same session.
    """
    shuffled, initial = int(spark.conf.get(SHUFFLED)), spark.conf.get(INITIAL, None)
    needed = max(shuffled, min(MOST_PARTITIONS, -(-read_bytes // READ_PER_PARTITION)))
    if needed > (shuffled if initial is None else int(initial)):
        spark.conf.set(INITIAL, str(needed))


def local_session(app: str = "tallyloom", cores: int | str = "*", memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
