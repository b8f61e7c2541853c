"""Operator 1: nearest neighbours by block matrix join over int8 tiles.

Unit vectors are quantised to int8 with a scale of their own, and the length of each one's rounding
error is kept. A tile is the int8 product of a block of queries and a block of candidates (exact in
float32, as long as 127^2 times the dimension stays below 2^24); it gives every cosine with a bound
on its error. Pairs whose upper bound reaches the fifth best lower bound of their query survive and
are computed again in double precision on the original vectors. Heaps hold each query's best over
the tiles of a task; the heaps of all tasks are merged by one more.

The queries are a stated set. Both sides are dealt to blocks by a hash of the id: a block of queries meets
a block of candidates in one group of rows, keyed by the two blocks. A query is copied to each block of
candidates and a candidate to each block of queries; the numbers of blocks follow the bytes of the two
sides (`block_bytes` a block), so that a task holds one block of queries, streams candidates past it and
sends on at most `k` rows a query. Nothing goes through the driver, and nothing is cut from the
candidates: the result is exact.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (integers in float32), scale, length of the coded vector, length of its error."""
    unit = vectors / np.abs(vectors).max(1, keepdims=True)
    unit = unit / np.sqrt(np.square(unit).sum(1, keepdims=True))
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None])
    coded = codes * scale[:, None]
    return codes.astype(np.float32), scale, np.sqrt(np.square(coded).sum(1)), np.sqrt(np.square(unit - coded).sum(1))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of a and b, in double precision, each sum taken from left to right.

    Rows whose squares leave the range of doubles are scaled by their largest component first.
    """
    dot = np.zeros(len(a))
    one, two = np.zeros(len(a)), np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore", divide="ignore", under="ignore"):
        for d in range(a.shape[1]):
            dot += a[:, d] * b[:, d]
            one += a[:, d] * a[:, d]
            two += b[:, d] * b[:, d]
        plain = dot / (np.sqrt(one) * np.sqrt(two))
    tiny, huge = 1e-280, 1e280
    odd = np.flatnonzero((one < tiny) | (one > huge) | (two < tiny) | (two > huge) | ~np.isfinite(plain))
    if len(odd):
        a, b = (x[odd] / np.abs(x[odd]).max(1, keepdims=True) for x in (a, b))
        plain[odd] = (a * b).sum(1) / np.sqrt(np.square(a).sum(1) * np.square(b).sum(1))
    return np.clip(plain, -1.0, 1.0)


def usable(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: ids and double vectors of the rows that take part."""
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    keep = pc.and_(pc.is_valid(ids), pc.is_valid(vectors))
    ids, vectors = ids.filter(keep), vectors.filter(keep)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths[lengths > 0]).tolist():
        at = pa.array(lengths == n)
        flat = pc.list_flatten(vectors.filter(at)).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)
        rows = flat.reshape(-1, n)
        good = np.isfinite(rows).all(1) & (rows != 0).any(1)
        if good.any():
            out[n] = ids.filter(at).to_numpy(zero_copy_only=False).astype(np.int64)[good], rows[good]
    return out


class Heaps:
    """The k best candidates of each query: a heap of (score, -id), the worst on top."""

    def __init__(self, k: int) -> None:
        self.k, self.of = k, defaultdict(list)

    def push(self, query: int, score: float, vec_id: int) -> None:
        heap = self.of[query]
        if len(heap) < self.k:
            heapq.heappush(heap, (score, -vec_id))
        elif (score, -vec_id) > heap[0]:
            heapq.heapreplace(heap, (score, -vec_id))

    def out(self) -> Iterator[pa.RecordBatch]:
        rows = [(q, -v, s) for q, h in self.of.items() for s, v in h]
        for at in range(0, len(rows), 100_000):
            yield _found(rows[at : at + 100_000])


def tile(queries: tuple, cands: tuple, heaps: Heaps, k: int) -> None:
    """Push what survives of a block of queries against a block of candidates."""
    q_ids, q_rows, (q_codes, q_scale, q_len, q_err) = queries
    c_ids, c_rows, (c_codes, c_scale, c_len, c_err) = cands
    near = (q_codes @ c_codes.T).astype(np.float64) * q_scale[:, None] * c_scale
    slack = q_len[:, None] * c_err + q_err[:, None] * (c_len + c_err) + 1e-9
    own = q_ids[:, None] == c_ids
    low = np.where(own, -np.inf, near - slack)
    n = min(k, low.shape[1])
    bar = np.partition(low, low.shape[1] - n, axis=1)[:, low.shape[1] - n] if n == k else np.full(len(q_ids), -np.inf)
    for i, q in enumerate(q_ids.tolist()):
        if len(h := heaps.of[q]) == k:
            bar[i] = max(bar[i], h[0][0])
    up = np.where(own, -np.inf, near + slack)
    rows, cols = np.nonzero((up >= bar[:, None]) & ~own)
    for at in range(0, len(rows), 65536):
        i, j = rows[at : at + 65536], cols[at : at + 65536]
        scores = cosine(q_rows[i], c_rows[j])
        ids = c_ids[j]
        order = np.lexsort((ids, -scores, i))
        i, scores, ids = i[order], scores[order], ids[order]
        first = np.concatenate(([0], np.flatnonzero(np.diff(i)) + 1))
        rank = np.arange(len(i)) - np.repeat(first, np.diff(np.concatenate((first, [len(i)]))))
        best = rank < k
        for q, s, v in zip(q_ids[i[best]].tolist(), scores[best].tolist(), ids[best].tolist()):
            heaps.push(q, s, v)


def blocked(ids: np.ndarray, rows: np.ndarray, size: int) -> Iterator[tuple]:
    for at in range(0, len(ids), size):
        part = rows[at : at + size]
        yield ids[at : at + size], part, quantise(part)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    block_bytes: int = 32 << 20, query_block: int = 512, candidate_block: int = 4096,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of largest cosine for each query.

    queries is a subset of vectors (same columns). A query's own id is no candidate (rows that repeat
    it neither); of query rows that repeat an id with different vectors the smallest vector, in Spark's
    order of arrays, asks. Ties go to the smaller vec_id. Vectors null, empty, zero or holding null or
    non-finite components, and null ids, take no part; only vectors of equal length are compared.
    Repeated rows of one id count once for each row. Other columns are not read, whatever their
    names. Fewer than k candidates: all of them. Empty tables give an empty table.
    """
    spark = vectors.sparkSession
    cands = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where("vec_id is not null and v is not null")
    asked = (
        queries.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where("vec_id is not null and v is not null")
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    )
    size = F.coalesce(F.sum(F.size("v") * 8 + 8), F.lit(0)).alias("b")
    q_blocks = max(1, -(-int(asked.agg(size).first()["b"]) // block_bytes))
    c_blocks = max(2 * spark.sparkContext.defaultParallelism // q_blocks, 1, -(-int(cands.agg(size).first()["b"]) // (4 * block_bytes)))

    def dealt(rows: DataFrame, side: int, mine: int, other: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(mine)).cast("int")
        copies = rows.select(block.alias("mine"), F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("other"), "vec_id", "v")
        q, c = ("mine", "other") if side == 0 else ("other", "mine")
        return copies.select(F.col(q).alias("q"), F.col(c).alias("c"), F.lit(side).alias("side"), "vec_id", "v")

    both = dealt(asked, 0, q_blocks, c_blocks).unionByName(dealt(cands, 1, c_blocks, q_blocks))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps, key = Heaps(k), None
        held: dict[int, list[tuple]] = {}
        blocks: dict[int, list[tuple]] | None = None
        for whole in batches:
            cols = [whole.column(i).to_numpy() for i in range(3)]
            cuts = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows]):
                if a == b:
                    continue
                if key != (now := (int(cols[0][a]), int(cols[1][a]))):
                    yield from heaps.out()
                    heaps, key, held, blocks = Heaps(k), now, {}, None
                found = usable(whole.column(3).slice(a, b - a), whole.column(4).slice(a, b - a))
                if cols[2][a] == 0:  # the queries come first
                    for n, part in found.items():
                        held.setdefault(n, []).append(part)
                    continue
                if blocks is None:
                    blocks = {n: [*blocked(*map(np.concatenate, zip(*parts)), query_block)] for n, parts in held.items()}
                for n, (ids, rows) in found.items():
                    for c in blocked(ids, rows, candidate_block) if n in blocks else ():
                        for q in blocks[n]:
                            tile(q, c, heaps, k)
        yield from heaps.out()

    found = (
        both.repartition(F.col("q"), F.col("c")).sortWithinPartitions("q", "c", "side", "vec_id")
        .mapInArrow(work, "query_id long, vec_id long, score double")
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by query: one heap at a time."""
        last, heap, out = None, [], []

        def done() -> None:
            best = heapq.nsmallest(k, heap)
            out.extend((last, i + 1, v, -s) for i, (s, v) in enumerate(best))

        for b in batches:
            for q, v, s in zip(*(b.column(i).to_pylist() for i in range(3))):
                if q != last and heap:
                    done()
                    heap = []
                last = q
                heap.append((-s, v))
            if len(out) > 50_000:
                yield _ranked(out)
                out.clear()
        if heap:
            done()
        yield _ranked(out)

    return (
        found.repartition("query_id").sortWithinPartitions("query_id")
        .mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
    )


def _found(rows: list[tuple]) -> pa.RecordBatch:
    q, v, s = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], ["query_id", "vec_id", "score"])


def _ranked(rows: list[tuple]) -> pa.RecordBatch:
    q, r, v, s = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(q, pa.int64()), pa.array(r, pa.int32()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
        ["query_id", "rank", "vec_id", "score"],
    )
