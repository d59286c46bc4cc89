"""Token counts of flat token files without an index, by a separator scan.

A flat file is nothing but little-endian ids of one width; each document ends with an end-of-document id. The
scan reads blocks of BLOCK bytes independently: numpy finds the separators of a block; a
document that began in an earlier block starts after the last separator before the block, which a prefix scan over the
blocks' summaries (separators, last separator) gives, as it gives each document its number.

Files are read in ranges through the shared folder's file system (a scheme pyarrow knows); nothing passes the driver but names
and lengths of files.

Cases: a document may be empty (two separators in a row: n_tokens 0). Ids after the last separator are
a document without end (ended = false). Bytes beyond the last whole id are left out. An empty file has no documents. In
`write_flat`, null text = empty; null and repeated doc_ids are kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, file_system, write_whole

BLOCK = 8 << 20


def write_flat(docs: DataFrame, path: str, folder: str, end: int) -> tuple[DataFrame, int]:
    """Writes a flat file for each partition of docs into folder; (file, doc_no, doc_id) of the documents, and an id's bytes."""
    from .tokens import Encoder, groups, with_end

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, ids = Encoder.of(path, True), []
        name = f"part-{TaskContext.get().partitionId():05d}.ids"

        def fill(out):
            for batch in batches:
                texts = [t.as_py() or "" for t in batch.column(1)]
                for i, j in groups(batch.column(1)):
                    flat, _ = with_end(*encoder.encode(texts[i:j]), end)
                    out.write(flat.tobytes())
                ids.append(batch.column(0))

        write_whole(folder, name, fill)
        n = 0
        for column in ids:
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(column), pa.string()), pa.array(np.arange(n, n + len(column))), column], ["file", "doc_no", "doc_id"])
            n += len(column)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return cut(rows.mapInArrow(run, "file string, doc_no bigint, doc_id bigint")), Encoder.of(path, True).dtype.itemsize


def scan(spark: SparkSession, folder: str, end: int, width: int, block: int = BLOCK, suffix: str = ".ids") -> DataFrame:
    """file, doc_no (from 0), start (ids before it in the file), n_tokens (without the end id), ended."""
    block -= block % width
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = [s for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root) if s.getPath().getName().endswith(suffix) and not s.getPath().getName().startswith(".")]
    sizes = sorted((s.getPath().getName(), s.getLen()) for s in files)
    schema = "file string, size bigint"
    blocks = spark.createDataFrame(sizes, schema).withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("size") - 1) / block)).cast("int"))))
    count = sum(max(1, -(-n // block)) for _, n in sizes)
    blocks = blocks.repartition(max(1, min(count, 4096)), "file", "block")

    def run(batches):
        import pyarrow as pa

        fs, at = file_system(folder)
        for batch in batches:
            for r in batch.to_pylist():
                first = r["block"] * block
                with fs.open_input_file(f"{at}/{r['file']}") as f:
                    f.seek(first)
                    data = f.read(min(block, r["size"] - first)) if r["size"] > first else b""
                ids = np.frombuffer(data[: len(data) - len(data) % width], f"<u{width}")
                seps = np.flatnonzero(ids == end) + first // width
                n = len(seps) + 1  # the last row is what follows the last separator
                start = np.concatenate(([-1], seps + 1))
                stop = np.append(seps, first // width + len(ids))
                arrays = [pa.array([r["file"]] * n), pa.array(np.full(n, r["block"], np.int32)), pa.array(np.arange(n)), pa.array(start), pa.array(stop), pa.array(np.arange(n) < len(seps))]
                yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "nth", "start", "stop", "ended"])

    found = cut(blocks.select("file", "size", "block").mapInArrow(run, "file string, block int, nth bigint, start bigint, stop bigint, ended boolean"))
    sums = found.groupBy("file", "block").agg(F.sum(F.col("ended").cast("bigint")).alias("seps"), F.max(F.when(F.col("ended"), F.col("stop"))).alias("last"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("file", "block", F.coalesce(F.sum("seps").over(ahead), F.lit(0)).alias("before"), (F.coalesce(F.max("last").over(ahead), F.lit(-1)) + 1).alias("open"), F.max("block").over(Window.partitionBy("file")).alias("final"))
    out = found.join(sums, ["file", "block"]).withColumn("start", F.when(F.col("nth") == 0, F.col("open")).otherwise(F.col("start")))
    tail = ~F.col("ended") & (F.col("block") == F.col("final")) & (F.col("stop") > F.col("start"))
    out = out.where(F.col("ended") | tail)
    return out.select("file", (F.col("before") + F.col("nth")).alias("doc_no"), "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "ended")
