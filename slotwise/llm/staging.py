"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

FOLDER = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where it is unset, a single-process session gets a temporary folder of its
    own for the rest of its life; any other session is refused, as its executors
    would not see that folder.
    """
    folder = spark.conf.get(FOLDER, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {FOLDER} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="slotwise-")
    spark.conf.set(FOLDER, folder)
    return folder


def new_folder(spark: SparkSession) -> str:
    """A path below the shared folder that nothing uses yet; removed with all of the session's when its JVM ends."""
    own = f"{shared_folder(spark)}/llm-{spark.conf.get('spark.app.id')}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path)
    files.deleteOnExit(path)  # a path that does not exist yet would be forgotten
    return f"{own}/{uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    folder = new_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, name: str) -> str:
    """``name`` behind as many underscores as it takes to be no column of ``df``."""
    taken = {x.lower() for x in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
