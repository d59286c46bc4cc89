"""Token ids as Huffman-coded binary blocks.

Format: a folder of two Parquet tables, written by Spark's own committers.
`code`: one row, the code length of every id (bytes; the codes are canonical, so lengths are all). `blocks`: independent blocks, each of
documents in ascending order: start (ids before the block, of all), n_tokens, doc_ids, doc_tokens
(counts, end id included), checks (bit offset of every CHECK-th id), payload. A block holds at most BLOCK ids: a longer document
is dealt out over blocks of its own, which say how many ids it has (`whole`, else null) and how many are in blocks before (`skip`).

Documents are range-partitioned by (doc_id, hash of the text), nulls first, and sorted within partitions;
ids are made once and kept in a working table, with each task's counts of ids, which a groupBy adds up
(the driver gets one row an id).

Cases: null text = empty: the end id alone. Null doc_ids come first. Rows that repeat a doc_id are documents each, ordered
by text. An empty table writes no blocks. Other columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import huffman
from .common import remove, trim, work_dir

BLOCK = 1 << 19
END = 2


def _tokenised(docs: DataFrame, path: str, end: int, size: int, cache: int) -> DataFrame:
    """part, at (ids before it in its partition), doc_id, n, ids: in order within each partition; and a row of part -1 with the counts of each task's ids, compressed."""
    from .tokens import Encoder, groups, with_end

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, part, at = Encoder.of(path, cache=cache), TaskContext.get().partitionId(), 0
        names, counts = ["part", "at", "doc_id", "n", "ids"], np.zeros(size, np.int64)
        for batch in batches:
            for i, j in groups(batch.column(1)):
                piece = batch.slice(i, j - i)
                flat, n = with_end(*encoder.encode([t.as_py() or "" for t in piece.column(1)]), end)
                counts += np.bincount(flat, minlength=size)
                to = np.cumsum(n)
                offsets = np.concatenate(([0], to * flat.itemsize)).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
                arrays = [pa.array(np.full(len(n), part, np.int32)), pa.array(at + to - n), piece.column(0), pa.array(n), ids]
                yield pa.RecordBatch.from_arrays(arrays, names)
                at += int(to[-1])
        trim()
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((-1, 0, None, 0, zlib.compress(counts.tobytes(), 1)), kinds, strict=True)], names)

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    return rows.mapInArrow(run, "part int, at bigint, doc_id bigint, n bigint, ids binary")


def write(docs: DataFrame, folder: str, path: str, end: int = END, cache: int | None = None) -> None:
    """Writes docs' ids into folder (a URI all machines reach); cache: pieces each Python worker remembers."""
    from .tokens import CACHE, Encoder

    spark = docs.sparkSession
    kind = Encoder.of(path).dtype
    size = max(len(Encoder.of(path).ends), end + 1)
    work = work_dir(spark, "ids")
    _tokenised(docs, path, end, size, cache or CACHE).write.mode("overwrite").option("compression", "zstd").parquet(work)
    kept = spark.read.parquet(work)

    def count(batches):
        import pyarrow as pa

        held = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                held += np.frombuffer(zlib.decompress(x), np.int64)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["id", "n"])

    counts = np.zeros(size, np.int64)
    found = kept.where("part < 0").select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts[found["id"]] = found["n"]
    kept = kept.where("part >= 0")
    length = huffman.lengths(counts)
    code = huffman.codes(length)
    spark.createDataFrame([(bytearray(length.tobytes()),)], "lengths binary").coalesce(1).write.mode("overwrite").parquet(f"{folder}/code")
    # ids before each partition: one row a partition
    starts, at = {}, 0
    for r in kept.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        starts[r.part] = at
        at += r.n
    before = spark.sparkContext.broadcast(starts)

    def blocks(batches):
        import pyarrow as pa

        names = ["start", "n_tokens", "doc_ids", "doc_tokens", "whole", "skip", "checks", "payload"]

        def block(rows, whole=None, skip=0):
            ids = np.frombuffer(b"".join(r[3] for r in rows), kind)
            payload, checks = huffman.encode(ids, length, code)
            row = [rows[0][0], len(ids), [r[1] for r in rows], [r[2] for r in rows], whole, skip, checks.astype("<u8").tobytes(), payload]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

        rows, n, to = [], 0, None
        for batch in batches:
            for part, at, doc, k, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at += before.value[part]
                if rows and (n + k > BLOCK or at != to):
                    yield block(rows)
                    rows, n = [], 0
                if k > BLOCK:
                    for i in range(0, k, BLOCK):
                        piece = ids[i * kind.itemsize : (i + BLOCK) * kind.itemsize]
                        yield block([(at + i, doc, len(piece) // kind.itemsize, piece)], k, i)
                    continue
                rows.append((at, doc, k, ids))
                n, to = n + k, at + k
        if rows:
            yield block(rows)

    schema = "start bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, whole bigint, skip bigint, checks binary, payload binary"
    kept.select("part", "at", "doc_id", "n", "ids").mapInArrow(blocks, schema).write.mode("overwrite").option("compression", "uncompressed").parquet(f"{folder}/blocks")
    remove(spark, work)


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), bits from the highest power's end, modulo that of crc32."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def crc_of_both(first: int, second: int, n: int) -> int:
    """crc32 of two byte strings in turn, from the crc32 of each and the length of the second."""
    power, base, bits = 1 << 31, 1 << 30, 8 * n
    while bits:
        if bits & 1:
            power = _times(power, base)
        base, bits = _times(base, base), bits >> 1
    return _times(power, first) ^ second


def read(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files; with ids, the ids as well (array)."""
    length = np.frombuffer(bytes(spark.read.parquet(f"{folder}/code").first()[0]), np.uint8)
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + ids]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids

    def run(batches):
        import pyarrow as pa

        lookup = huffman.table(length, huffman.codes(length))
        for batch in batches:
            for r in batch.to_pylist():
                got = huffman.decode(r["payload"], r["n_tokens"], np.frombuffer(r["checks"], "<u8"), lookup).astype("<u4")
                n = np.array(r["doc_tokens"], np.int64)
                to = np.cumsum(n)
                docs = [got[b - k : b] for b, k in zip(to.tolist(), n.tolist(), strict=True)]
                arrays = [pa.array(r["doc_ids"], pa.int64()), pa.array(r["start"] + to - n), pa.array(n), pa.array([zlib.crc32(d.tobytes()) for d in docs], pa.int64())]
                if ids:
                    arrays.append(pa.array([d.tolist() for d in docs], pa.list_(pa.int64())))
                if r["whole"] is not None:
                    arrays.append(pa.array([r["start"] - r["skip"]], pa.int64()))
                yield pa.RecordBatch.from_arrays(arrays, [*names, "first"][: len(arrays)])

    def join(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc, first, pieces in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                crc = pieces[0]["ids_crc32"]
                for p in pieces[1:]:
                    crc = crc_of_both(crc, p["ids_crc32"], 4 * p["n_tokens"])
                rows.append((doc, first, sum(p["n_tokens"] for p in pieces), crc, *[[x for p in pieces for x in p["ids"]]][: int(ids)]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names)

    blocks = spark.read.parquet(f"{folder}/blocks")
    out = blocks.where("whole is null").mapInArrow(run, schema)
    if blocks.where("whole is not null").isEmpty():
        return out
    pieces = blocks.where("whole is not null").mapInArrow(run, f"{schema}, first bigint")
    grouped = pieces.groupBy("doc_id", "first").agg(F.sort_array(F.collect_list(F.struct(*names[1:]))).alias("pieces"))
    return out.union(grouped.mapInArrow(join, schema))
