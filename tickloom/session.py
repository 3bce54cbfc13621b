"""Session settings the package relies on."""

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("tickloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.maxMetadataStringLength", "2000")  # show pushed filters in full
        # recording a Python call site per column operation doubles the time to build wide plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tickloom-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df once to the checkpoint folder; readers reuse it and lost executors reread it."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
