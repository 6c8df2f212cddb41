"""Session defaults, and the one place that decides where cut lineage is stored."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with runtime re-planning on. Give ``master`` only for local runs."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor and the driver can reach.

    A local run without that setting gets a temporary folder. A cluster without it is refused:
    a folder on one machine would be lost with that machine.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="daytally-")
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder."""
    folder, context = shared_folder(df.sparkSession), df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again, for what several passes read in part: each pass
    then reads its own columns alone, and survives lost executors. The folder is for the session to clear."""
    path = f"{shared_folder(df.sparkSession)}/daytally-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
