"""Session settings for local runs, and the shared checkpoint folder.

On a cluster the caller brings the session. Nothing here overrides a setting
that such a session already carries.
"""

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", name: str = "chronolode", memory: str = "16g") -> SparkSession:
    """A local session for tests and the benchmark."""
    partitions = str(cpus) if str(cpus).isdigit() else "8"
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediates, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, since executors
    of a cluster share none.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    """One folder for all local sessions of this process, removed when it ends."""
    path = tempfile.mkdtemp(prefix="spark-shared-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the copy."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/chronolode/{name}-{uuid.uuid4().hex}"
