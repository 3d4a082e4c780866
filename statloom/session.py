"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, settings: dict[str, str] | None = None
) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    spark = (
        builder.master(f"local[{cores}]")
        .appName("statloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors, named by ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where there is one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="statloom-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    The table survives the loss of executors, cuts the lineage and fixes the rows
    for reuse; later steps read only the columns they need and the planner knows
    its size.  It stays in the folder, like a checkpoint, until that is cleared.
    ``by`` deals the rows out by the hash of these columns, two parts a core, so that each of
    many passes over a table of narrow rows uses all cores.
    """
    spark = df.sparkSession
    if by:
        df = df.repartition(max(1, 2 * spark.sparkContext.defaultParallelism), *by)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
