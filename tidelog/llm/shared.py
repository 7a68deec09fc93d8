"""Places and helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir.

    Only where the session names none and runs on this machine (as in tests) is one made and
    set; on a cluster other executors couldn't see it, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidelog-shared-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, name: str, **totals) -> tuple[DataFrame, dict]:
    """written(df, name) and, from the same pass, the number of its rows and further totals of it."""
    seen = Observation()
    out = written(df.observe(seen, F.count(F.lit(1)).alias("rows"), *(column.alias(k) for k, column in totals.items())), name)
    return out, seen.get


def sized(df: DataFrame, rows: int, each: int = 50_000) -> DataFrame:
    """df in fewer tasks where it has few rows: about each rows a task, and no fewer than LEAST_TASKS."""
    return df.coalesce(max(LEAST_TASKS, rows // each))


def free(df: DataFrame, name: str) -> str:
    """name, or one like it that no column of df has (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


LEAST_TASKS = 12
#: Rows of a few numbers that are broadcast, at most; longer tables are joined by shuffle.
BROADCAST_ROWS = 200_000


def side(df: DataFrame, rows: int) -> DataFrame:
    """df as a side of a join: broadcast only if its known number of rows is small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by written(), once nothing reads it."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows and bytes of an Arrow batch, so that a worker's memory doesn't follow the texts' length.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python workers in batches of bounded rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
