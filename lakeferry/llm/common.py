"""What the operators of this subpackage share: inputs, the shared folder, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders that this process made for itself because spark.checkpoint.dir is unset.
_own: dict[str, str] = {}


#: Bytes of rows that Spark hands to a Python worker at once; whole texts are long.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Lets Python workers find this package where it lies, if they share its folder, and bounds what they get at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), root)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """URI of the folder all machines share: spark.checkpoint.dir, or a fresh local one if that is unset and there is one machine."""
    said = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if said:
        return said.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="lakeferry-")
    return _own[app]


def work_dir(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder, made, in the shared one."""
    prepare(spark)
    uri = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return uri


def remove(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that no later job repeats its plan."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


#: Rows, of a few numbers each, that may go to every executor.
BROADCAST_ROWS = 300_000


def small(df: DataFrame) -> DataFrame:
    """df, kept and counted: to be broadcast if it has at most BROADCAST_ROWS rows, and else joined as Spark sees fit."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def trim() -> None:
    """Gives back what a Python worker holds and doesn't use, at the end of a task: workers live on, and share an executor's memory."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def file_system(uri: str):
    """(pyarrow filesystem, path) of a URI in the shared folder; for use on executors."""
    from pyarrow import fs

    if "://" not in uri:
        return (fs.LocalFileSystem(), uri.removeprefix("file:"))
    if uri.startswith("s3a://"):
        uri = "s3" + uri[3:]
    return fs.FileSystem.from_uri(uri)


def write_whole(uri: str, name: str, fill) -> str:
    """Writes a file by fill(stream) under a name of this attempt's own, then moves it to name.

    A task that runs again, or twice at once, replaces the file by an equal one.
    """
    fs, at = file_system(uri)
    own = f"{at}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        fill(out)
    fs.move(own, f"{at}/{name}")
    return f"{uri}/{name}"


def sampled(rows: DataFrame, most: int, most_bytes: int, labels: DataFrame | None = None) -> list[tuple]:
    """(doc_id, text, label) of distinct labelled rows, the first by hash of id and text: at most `most`, and as many as most_bytes hold.

    rows: doc_id, text, and label, unless labels has that (doc_id, label).
    """
    rows = rows.withColumn("h", F.xxhash64("text"))
    size = F.octet_length("text").alias("size")
    ids = rows.select("doc_id", "h", size, "label") if labels is None else rows.select("doc_id", "h", size).join(labels, "doc_id")
    ids = ids.where(F.col("size") <= most_bytes).distinct()
    ids = ids.orderBy(F.xxhash64("doc_id", "h"), "doc_id", "h", "label", "size").limit(most).collect()
    of: dict[tuple, list] = {}
    held = 0
    for r in ids:
        held += r["size"]
        if held <= most_bytes:
            of.setdefault((r.doc_id, r.h), []).append(r.label)
    if not of:
        return []
    chosen = rows.sparkSession.createDataFrame(list(of), "_d bigint, _h bigint")
    kept = rows.join(F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left_semi")
    texts = kept.groupBy("doc_id", "h").agg(F.min("text").alias("text")).collect()
    return sorted(((r.doc_id, r.text, x) for r in texts for x in of[r.doc_id, r.h]), key=lambda r: (r[0] is None, r[0], r[1], r[2]))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def held_out(id_column: str, folds: int, fold: int) -> Column:
    """crc32(id as text) mod folds = fold; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == fold, F.lit(False))
