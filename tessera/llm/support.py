"""Shared plumbing of the text operators: shared scratch tables, renaming, loading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Paths written by this process, by application id, for ``release``.
_WRITTEN: dict[str, list[str]] = {}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ... by place, so that no name of the caller's can clash or need quoting."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def place(df: DataFrame, name: str) -> str:
    """What ``plain(df)`` calls column ``name``: the first of that very name, else of that name in other case."""
    names = df.columns
    if name not in names:
        lower = [n.lower() for n in names]
        if name.lower() not in lower:
            raise ValueError(f"no column {name!r} among {names}")
        return f"c{lower.index(name.lower())}"
    return f"c{names.index(name)}"


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Some columns of ``df`` under the operator's own names: ``picked(df, id="doc_id", text="text")``."""
    return plain(df).select(*(F.col(place(df, name)).alias(own) for own, name in columns.items()))


#: Bytes of an Arrow batch; a worker holds a batch several times over, and texts differ in length by orders.
BATCH_BYTES = "8m"


def tune(spark: SparkSession) -> None:
    """Session settings under which a Python worker's memory stays small whatever the rows' length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in a plain local session."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="tessera-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it again.

    A lost executor then costs only the tasks it was running; nothing lives on its disk.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: tuple[DataFrame, ...] = ()) -> None:
    """Delete what ``scratch_path`` handed out in this application, once results are stored elsewhere.

    Folders that the tables in ``keep`` read stay.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    used = [f for df in keep for f in df.inputFiles()]
    known = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in known:
        if any(path.rpartition("/")[2] in f for f in used):
            _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
            continue
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def bucket(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def salt(column, seed: int, modulus: int):
    """A reproducible number below ``modulus`` from any column."""
    return F.pmod(F.xxhash64(F.lit(seed), column), F.lit(modulus)).cast("int")


def hashed_sample(df: DataFrame, rows: int, keys: list[str], total: int, seed: int = 3) -> list:
    """``rows`` rows at most, in the order of a hash of ``keys``, at the driver: those below the share ``rows / total``.

    The share is applied where rows are read, so tasks send what is wanted and no more, however many they are;
    where keys repeat, so that a hash stands for many rows, a task still keeps ``rows`` of them at most.
    """
    if not total:
        return []
    share = min(1.0, (1.25 * rows + 20) / total)
    mark = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 40)) / float(1 << 40)
    return df.withColumn("__mark", mark).where(F.col("__mark") < share).orderBy("__mark").limit(rows).collect()
