"""Exact top-k search by distributed histogram selection.

Queries go in blocks of at most QUERY_BLOCK (a bounded array on the driver and in each
task); against each block every row is scored. The kth best score of each query is
found digit by digit:

1. every task counts its scores by their highest digit (BITS bits), from the best bin down to
   the one that holds its own kth (the global kth lies there or above), and these counts are summed;
2. the bin that holds the global kth fixes the digit; the next round counts the next digit inside that bin;
3. with the kth score known exactly, every task keeps its scores above it and, of those equal to it,
   the k with the smallest ids; a window over these few rows breaks ties.

A round scores again instead of storing scores: they are blocks of a matrix product. Scores are
integers. The product runs in float64 while no sum can reach 2**53, in Python's integers
otherwise; what a bigint can't hold becomes its nearest end.

Cases: vectors null, empty, or holding null or non-finite components take no part; nor do
vectors of another length against a query. Candidates with the query's id are its own row, and
left out; a row with a null id is a candidate like any other and comes last among ties (2**63 - 1 stands for
null, and is no id of its own). Fewer than k candidates: all. Repeated rows are
candidates each; queries that repeat get the list each. Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, prepare, work_dir

QUERY_BLOCK = 4096
BITS = 8
SCALE = 256
_ROWS = 512
_NULL = np.iinfo(np.int64).max


def _scaled(m: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): float64, or Python's integers where a product could overflow."""
    if np.abs(m).max(initial=0) < 1e300:
        return np.floor(m * SCALE)
    return np.array([[int(x) * SCALE if abs(x) > 2.0**60 else int(np.floor(x * SCALE)) for x in r] for r in m], object).reshape(m.shape)


def _vectors(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of an Arrow list column: places and rows (as a matrix) of the vectors of that width without null or non-finite components."""
    at = np.asarray(column.offsets, np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become nan
    odd = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    ok = np.asarray(column.is_valid()) & (np.diff(at) == width) & (odd[at[1:]] == odd[at[:-1]])
    use = np.flatnonzero(ok)
    return use, _scaled(values[at[use][:, None] + np.arange(width)])


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, int64, of integer-valued vectors."""
    most = [int(np.abs(m).max(initial=0)) for m in (queries, rows)]
    if most[0] * most[1] * queries.shape[1] < 2**53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    ints = lambda m: [[int(x) for x in r] for r in m]
    exact = ints(rows)
    fit = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    return np.array([[fit(sum(map(int.__mul__, q, r))) for r in exact] for q in ints(queries)], np.int64).reshape(len(queries), len(rows))


def _scored(batches, qid: np.ndarray, qv: np.ndarray, base: int):
    """For pieces of the batches: row ids, scores less the least possible (uint64, query by row), which are candidates."""
    sign = np.uint64(1 << 63)
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            piece = batch.slice(at, _ROWS)
            use, m = _vectors(piece.column(1), qv.shape[1])
            if len(use):
                ids = np.array(piece.column(0).fill_null(_NULL), np.int64)[use]
                u = products(qv, m).view(np.uint64)
                u ^= sign
                u -= np.uint64(base)
                yield ids, u, (ids[None, :] != qid[:, None]) | (ids == _NULL)[None, :]


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each query by integer inner product of floor(256 * x)."""
    prepare(rows.sparkSession)
    pick = lambda df: df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    wanted = cut(pick(queries).where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite)))
    data = pick(rows)
    # the largest component bounds every score, and with it how many digits there are
    parts = data.select(F.array_max(F.transform(F.filter("v", finite), F.abs)).alias("x"))
    most = parts.agg(F.max("x")).first()[0] or 0.0
    total = wanted.count()
    blocks = 1 if total <= QUERY_BLOCK else -(-2 * total // QUERY_BLOCK)
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    spark, schema = data.sparkSession, "query_id bigint, rank int, vec_id bigint, score bigint"
    if not total:
        return spark.createDataFrame([], schema)
    folder = None if blocks == 1 else work_dir(spark, "topk")
    found: list[DataFrame] = []

    def keep(group: list) -> None:
        """One block's result: as a plan if there is one block, else in a table, lest plans pile up."""
        out = _block(data, group, k, most)
        if folder:
            out.write.mode("append").parquet(folder)
        else:
            found.append(out)

    for b in range(blocks):
        of: dict[int, list] = {}
        for r in wanted.where(F.col("block") == b).orderBy("id").toLocalIterator():
            group = of.setdefault(len(r.v), [])
            group.append(r)
            if len(group) == QUERY_BLOCK:
                keep(group)
                of[len(r.v)] = []
        for group in of.values():
            if group:
                keep(group)
    if folder:
        return spark.read.schema(schema).parquet(folder)
    out = found[0]
    for p in found[1:]:
        out = out.union(p)
    return out


def _block(data: DataFrame, group: list, k: int, most: float) -> DataFrame:
    qid = np.array([_NULL if r.id is None else r.id for r in group], np.int64)
    qv = _scaled(np.asarray([r.v for r in group], np.float64))
    limit = int(np.abs(qv).max()) * qv.shape[1] * (int(most) + 1) * SCALE
    digits = min(64 // BITS, -(-(limit.bit_length() + 1) // BITS))
    base = (1 << 63) - (1 << (digits * BITS - 1))
    prefix, need = np.zeros(len(qid), np.uint64), np.full(len(qid), k)
    for digit in range(digits):
        shift = np.uint64((digits - 1 - digit) * BITS)
        at = _round(data, qid, qv, base, shift, prefix if digit else None, k)
        chosen, above = np.zeros(len(qid), np.uint64), np.zeros(len(qid), np.int64)
        for q, b, before in at:  # best bins first
            if before < need[q]:
                chosen[q], above[q] = b, before
        prefix, need = (prefix << np.uint64(BITS)) | chosen, need - above
    kth = prefix

    def best(batches):
        import pyarrow as pa

        keep: dict[int, list] = {}
        for ids, u, ok in _scored(batches, qid, qv, base):
            ok &= u >= kth[:, None]
            for i in np.flatnonzero(ok.any(1)):
                j = np.flatnonzero(ok[i])
                score = (u[i, j] + np.uint64(base) ^ np.uint64(1 << 63)).view(np.int64)
                keep[i] = sorted([*keep.get(i, ()), *zip((~score).tolist(), ids[j].tolist(), strict=True)])[:k]
        out = [(i, x, ~s) for i, v in keep.items() for s, x in v]
        q, x, s = ([o[n] for o in out] for n in range(3))
        arrays = [pa.array([int(qid[i]) for i in q], pa.int64()), pa.array(map(int, q), pa.int32()), pa.array(x, pa.int64()), pa.array(s, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["query_id", "q", "vec_id", "score"])

    kept = data.mapInArrow(best, "query_id bigint, q int, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc("vec_id")))
    kept = kept.withColumn("rank", rank).where(F.col("rank") <= k)
    known = lambda c: F.when(F.col(c) < int(_NULL), F.col(c)).alias(c)
    return kept.select(known("query_id"), F.col("rank").cast("int").alias("rank"), known("vec_id"), "score")


def _round(data: DataFrame, qid, qv, base: int, shift, prefix, k: int) -> list:
    """(query, bin, scores in better bins) of the bins of one digit that hold the k best, best first."""
    bins = 1 << BITS

    def count(batches):
        import pyarrow as pa

        held = np.zeros(len(qid) * bins, np.int64)
        for _, u, ok in _scored(batches, qid, qv, base):
            digit = u >> shift
            if prefix is not None:
                ok &= digit >> np.uint64(BITS) == prefix[:, None]
                digit &= np.uint64(bins - 1)
            q, j = np.nonzero(ok)
            held += np.bincount(q * bins + digit[q, j].astype(np.int64), minlength=len(held))
        held = held.reshape(-1, bins)
        above = held[:, ::-1].cumsum(1)[:, ::-1] - held
        q, b = np.nonzero((held > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(b, pa.int32()), pa.array(held[q, b])], ["q", "bin", "n"])

    sums = data.mapInArrow(count, "q int, bin int, n bigint").groupBy("q", "bin").agg(F.sum("n").alias("n"))
    better = Window.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("above", F.coalesce(F.sum("n").over(better), F.lit(0))).where(F.col("above") < k)
    return sorted(((r.q, r.bin, r.above) for r in sums.collect()), key=lambda x: (x[0], -x[1]))
