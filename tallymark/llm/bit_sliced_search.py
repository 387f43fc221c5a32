"""Exact top-k inner-product search over a bit-sliced index.

Vectors are quantised to integers. A block of rows is stored by bit: for every component and
every binary digit one bitmap over the rows. A query's score is the sum of these bitmaps, each
shifted by its digit and by the digits of the query's component; carry-save adders sum all
bitmaps of one weight for all rows at once. The result is bit-sliced as well, so the best rows
follow from its most significant slice downward; rows that tie at the boundary are taken by
least id. Every query meets every block: the answer is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import map_arrow, materialised, prefix_sums

#: Rows of an index block and queries of a query block.
ROWS, QUERIES = 8192, 128
#: Query blocks that one task takes to an index block.
QUERY_BLOCKS = 64
SCALE = 256
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(vectors: list[np.ndarray], scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of every component; shorter vectors are filled with zeros.

    64-bit integers if they fit, else Python integers.
    """
    width = max((len(v) for v in vectors), default=0)
    dense = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        dense[i, : len(v)] = v
    if not dense.size or np.abs(dense).max() < 2.0**50 / scale:
        return np.floor(dense * scale).astype(np.int64)
    whole = [[int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in r] for r in dense.tolist()]
    return np.array(whole, object)


def bit_slices(values: np.ndarray) -> np.ndarray:
    """(rows, components) integers -> (components, bits, words) bitmaps of two's complement."""
    rows, width = values.shape
    greatest = max((abs(int(values.max())), abs(int(values.min()) + 1)), default=0) if values.size else 0
    bits = greatest.bit_length() + 1
    out = np.zeros((width, bits, -(-rows // 64) * 8), np.uint8)
    for j in range(bits):
        digit = ((values >> j) & 1).astype(bool).T
        packed = np.packbits(digit, axis=1, bitorder="little")
        out[:, j, : packed.shape[1]] = packed
    return out.view(np.uint64)


def signed_digits(n: int) -> list[tuple[int, int]]:
    """n as a sum of sign * 2**place with no two neighbouring places."""
    out, place = [], 0
    while n:
        if n & 1:
            sign = 2 - (n & 3)
            out.append((sign, place))
            n -= sign
        n >>= 1
        place += 1
    return out


def sum_slices(slices: np.ndarray, query: list[int]) -> tuple[np.ndarray, int]:
    """Bit-sliced sums of query[c] * component c, and what to add to each: (bits, words), shift."""
    width, bits, words = slices.shape
    at: dict[int, list[tuple[int, int, bool]]] = {}
    shift = 0
    for c, q in enumerate(query[:width]):
        for sign, place in signed_digits(q):
            for j in range(bits):
                # The top digit of two's complement counts negatively; -x is (1 - x) - 1.
                minus = (sign < 0) != (j == bits - 1)
                at.setdefault(place + j, []).append((c, j, minus))
                if minus:
                    shift -= 1 << (place + j)
    out, weight, carried = [], 0, np.zeros((0, words), np.uint64)
    while at or len(carried):
        column = carried
        if weight in at:
            c, j, minus = map(np.array, zip(*at.pop(weight), strict=True))
            mine = slices[c, j]
            mine[minus] ^= _ALL
            column = np.concatenate([carried, mine])
        carries = []
        while len(column) >= 3:
            n = len(column) // 3
            a, b, d = column[:n], column[n : 2 * n], column[2 * n : 3 * n]
            odd = a ^ b
            carries.append((a & b) | (odd & d))
            column = np.concatenate([odd ^ d, column[3 * n :]])
        if len(column) == 2:
            carries.append(column[:1] & column[1:])
            column = column[:1] ^ column[1:]
        out.append(column[0] if len(column) else np.zeros(words, np.uint64))
        carried = np.concatenate(carries) if carries else carried[:0]
        weight += 1
    return np.array(out).reshape(len(out), words), shift


def best_rows(sums: np.ndarray, there: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k greatest sums among the rows `there`, ties to the least row."""
    sure, tied, n = np.zeros_like(there), there, 0
    for digit in sums[::-1]:
        high = tied & digit
        count = int(np.bitwise_count(high).sum())
        if n + count > k:
            tied = high
        else:
            sure, n, tied = sure | high, n + count, tied & ~digit
            if n == k:
                break
    found = _rows(sure)
    return np.concatenate([found, _rows(tied)[: k - len(found)]]) if n < k else found


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _score(sums: np.ndarray, shift: int, row: int) -> int:
    word, bit = row // 64, np.uint64(row % 64)
    digits = (sums[:, word] >> bit) & np.uint64(1)
    total = sum(1 << p for p in np.flatnonzero(digits).tolist()) + shift
    return max(-(2**63), min(2**63 - 1, total))


# ---- blocks --------------------------------------------------------------------------------------


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))[:-1])


def _blocks(rows: DataFrame, size: int, sliced: bool) -> DataFrame:
    """Pack the rows of each task into blocks: task, part, ids, shape, body."""

    def pack(ids: np.ndarray, vectors: list[np.ndarray], task: int, part: int) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        values = quantised([vectors[i] for i in order])
        if sliced:
            body = bit_slices(values)
            shape, raw = list(body.shape), body.tobytes()
        else:
            shape, raw = list(values.shape), "\n".join(",".join(map(str, v)) for v in values.tolist()).encode()
        arrays = [[task], [part], [ids[order].astype("<i8").tobytes()], [shape], [raw]]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary()]
        columns = [pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["task", "part", "ids", "shape", "body"])

    def run(batches):
        import pyarrow.compute  # noqa: F401

        task, part = TaskContext.get().partitionId(), 0
        ids, vectors = np.zeros(0, np.int64), []
        for batch in batches:
            if not len(batch):
                continue
            ids = np.concatenate([ids, batch.column(0).to_numpy()])
            vectors += _vectors(batch.column(1))
            while len(ids) >= size:
                yield pack(ids[:size], vectors[:size], task, part)
                ids, vectors, part = ids[size:], vectors[size:], part + 1
        if len(ids):
            yield pack(ids, vectors, task, part)

    return map_arrow(rows, run, "task long, part long, ids binary, shape array<int>, body binary")


def _numbered(blocks: DataFrame) -> DataFrame:
    """Add `block`: 0, 1, ... over all blocks."""
    per_task = blocks.groupBy("task").agg(F.count("*").alias("n"))
    first = prefix_sums(per_task, [], "task", "n", "first").drop("n")
    return blocks.join(first, "task").withColumn("block", F.col("first") + F.col("part"))


def top_k_inner_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per query and rank: query_id, rank (from 1), id, score.

    Queries are the rows for which `is_query` holds; candidates are all rows of another id.
    Rows with a null id or vector, or with a null or non-finite component, take no part. Rows
    equal in id and vector count once. Vectors of different lengths are filled with zeros. Ties
    go to the least id; a query with fewer candidates has fewer ranks. Scores beyond 64 bits are
    cut to the nearest 64-bit number. Other columns are neither read nor returned.
    """
    flawed = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~flawed)
    rows = materialised(rows.dropDuplicates(["id", "vector"]), "search-rows")
    index = materialised(_blocks(rows.select("id", "vector"), ROWS, True), "search-index")
    queries = _blocks(rows.filter("is_query").select("id", "vector"), QUERIES, False)
    queries = materialised(queries, "search-queries")
    # A grid: a task meets one index block with so many query blocks. No cell is a shuffle of both.
    n, splits = index.count(), -(-queries.count() // QUERY_BLOCKS) or 1
    cells = max(1, min(n * splits, 10_000))
    cut = F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))
    index = _numbered(index).select("block", "ids", "shape", "body").withColumn("split", cut)
    asked = _numbered(queries).select(
        F.explode(F.sequence(F.lit(0), F.lit(max(n - 1, 0)))).alias("to"),
        F.pmod("block", F.lit(splits)).cast("int").alias("split"),
        F.col("ids").alias("query_ids"),
        F.col("body").alias("query_body"),
    ).withColumn("block", F.col("to").cast("long"))

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                slices = np.frombuffer(row["body"], np.uint64).reshape(row["shape"])
                everyone = np.zeros(slices.shape[2] * 64, bool)
                everyone[: len(ids)] = True
                found = []
                lines = row["query_body"].decode().split("\n")
                for me, line in zip(np.frombuffer(row["query_ids"], "<i8"), lines, strict=True):
                    others = everyone.copy()
                    others[: len(ids)] &= ids != me
                    there = np.packbits(others, bitorder="little").view(np.uint64)
                    query = [int(x) for x in line.split(",")] if line else []
                    sums, shift = sum_slices(slices, query)
                    best = best_rows(sums, there, k)
                    found += [(int(me), int(ids[r]), _score(sums, shift, r)) for r in best]
                columns = [list(c) for c in zip(*found, strict=True)] if found else [[], [], []]
                arrays = [pa.array(c, pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["query_id", "id", "score"])

    cell = ["block", "split"]
    near = asked.repartition(cells, *cell).join(index.repartition(cells, *cell), cell)
    near = near.select("ids", "shape", "body", "query_ids", "query_body")
    scored = map_arrow(near, search, "query_id long, id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
