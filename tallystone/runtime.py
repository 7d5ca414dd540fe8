"""Session helpers shared by all operators: reading, cutting lineage, checked broadcasts, bucket sizing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 20_000
#: And at most so many bytes of text.
BROADCAST_BYTES = 4_000_000
_STAGED: list[str] = []
ARROW_BYTES, ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory (a file or a folder of parts). Batches for Python workers are bounded in
    bytes as well as in rows, so long texts don't add up; a setting of the session is kept."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(ARROW_BATCH))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session; a temporary one only where it is unset
    and the master is local (tests)."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="tallystone-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later uses neither recompute nor lose the data with an executor. For small frames."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to a compressed columnar table in the shared folder and read it back. For frames as large as the input."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:  # goes with the session; where that isn't reached, with the shared folder
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    except Exception:  # noqa: BLE001
        pass
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Remove what stage() wrote so far in this session; frames made of it can't be used any more. How many tables went."""
    n = 0
    while _STAGED:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        n += bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
    return n


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Is the frame proven to be within the broadcast bound? Reads at most rows + 1 rows and only their count and
    size reach the driver."""
    lengths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(8)) for c, t in df.dtypes if not t.startswith(("array", "struct", "map"))]
    total = F.lit(16 * (len(df.columns) - len(lengths)))
    for x in lengths:
        total = total + x
    got = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total), F.lit(0)).alias("b")).first()
    return got["n"] <= rows and got["b"] <= size


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """broadcast() behind a check of the size; beyond it the join is left to shuffle (adaptive skew handling)."""
    return F.broadcast(df) if small(df) else df


def key128(*cols: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: a key narrow enough to shuffle, without practical collisions."""
    return F.xxhash64(*cols), F.xxhash64(F.lit("tallystone"), *cols)


def fresh(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the wanted columns, so extra columns of the input can neither clash nor be carried."""
    return df.select(*[F.col(f"`{c}`") for c in wanted])


def spread_rows(df: DataFrame) -> DataFrame:
    """For work that costs far more than moving the rows: a scan that Spark can't split into as many tasks as there are
    cores (one small file) is dealt out to them. Larger scans stay where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
