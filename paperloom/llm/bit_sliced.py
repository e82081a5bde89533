"""Exact top-k inner products over a bit-sliced index.

Every component x becomes floor(256 * x). A block of rows is kept as one bitmap per
dimension and bit of its quantised components. A query multiplies by adding shifted slices:
each signed digit of its components selects one slice or its complement, and carry-save
adders on whole bitmaps reduce the columns to the slices of the sum. The k best rows then
come from the sum's most significant slice downward; rows tied at the last place are
resolved exactly, by the smaller id.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Components of the candidates of one block, bytes of one pack of queries, packs that meet a block in one task,
#: and bits of the slices of one index.
BLOCK_CELLS, PACK_BYTES, PACKS_A_TASK, INDEX_BITS = 1 << 22, 1 << 20, 64, 1 << 31


def signed_digits(n: int) -> list[tuple[int, int]]:
    """Non-adjacent form: (position, +1 or -1) pairs whose sum of digit * 2**position is n."""
    out, at = [], 0
    while n:
        if n & 1:
            d = 2 - (n & 3)
            out.append((at, d))
            n -= d
        n >>= 1
        at += 1
    return out


def integers(cells: np.ndarray) -> list:
    """256 times the cells, whole numbers of any size, as nested lists of Python integers; cells
    that are integers already have been multiplied."""
    if cells.dtype != np.float64:
        return cells.tolist()
    # a double times 256 is exact unless it overflows; doubles that large are whole themselves
    whole = lambda x: int(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE
    return [[whole(x) for x in row] for row in cells.tolist()]


class Block:
    """Bit slices of the rows of one block, ids ascending. ``cells`` are quantised components as
    integers, or as doubles still to be multiplied by 256 where these would not fit 32 bits."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.cells = ids[order], cells[order]
        n, dims = cells.shape
        self.n, self.words = n, (n + 63) // 64
        ends = integers(np.array([[self.cells.max(initial=0), self.cells.min(initial=0)]], cells.dtype))[0]
        self.bits = max(ends[0], -(ends[1] + 1), 0).bit_length() + 1
        self.base = 1 << (self.bits - 1)
        self.plain = np.zeros((dims, self.bits, self.words), dtype=np.uint64)
        width = (self.bits + 7) // 8
        for d in range(dims):
            if cells.dtype == np.float64:
                shifted = (v + self.base for (v,) in integers(self.cells[:, d : d + 1]))
                raw = np.frombuffer(b"".join(u.to_bytes(width, "little") for u in shifted), np.uint8).reshape(n, width)
            else:
                raw = (self.cells[:, d].astype(np.int64) + self.base).astype("<u8").view(np.uint8).reshape(n, 8)
            packed = np.packbits(np.unpackbits(raw, axis=1, count=self.bits, bitorder="little").T, axis=1, bitorder="little")
            self.plain[d].view(np.uint8)[:, : packed.shape[1]] = packed
        self.held = self.plain.any(axis=2)
        self.rows = self._bitmap(np.arange(n))

    def _bitmap(self, at: np.ndarray) -> np.ndarray:
        flags = np.zeros(self.words * 64, dtype=np.uint8)
        flags[at] = 1
        return np.packbits(flags, bitorder="little").view(np.uint64)

    def sum_slices(self, query: list[int]) -> list[np.ndarray]:
        """Slices, least significant first, of the inner products shifted by one constant to be non-negative."""
        columns: list[list[np.ndarray]] = []

        def put(column: int, bitmap: np.ndarray) -> None:
            while len(columns) <= column:
                columns.append([])
            columns[column].append(bitmap)

        for d, q in enumerate(query):
            digits = signed_digits(q)
            inverse = ~self.plain[d] if any(sign < 0 for _, sign in digits) else None
            for at, sign in digits:
                for b in range(self.bits):
                    if sign < 0:
                        put(at + b, inverse[b])
                    elif self.held[d, b]:
                        put(at + b, self.plain[d, b])
        out = []
        c = 0
        while c < len(columns):
            held = columns[c]
            while len(held) > 2:
                x, y, z = held.pop(), held.pop(), held.pop()
                t = x ^ y
                carry = x & y
                x = t & z
                carry |= x
                t ^= z
                held.insert(0, t)
                put(c + 1, carry)
            if len(held) == 2:
                x, y = held
                put(c + 1, x & y)
                held = [x ^ y]
            out.append(held[0] if held else np.zeros(self.words, dtype=np.uint64))
            c += 1
        return out

    def best(self, query_id: int, query: list[int], k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best rows, the query's own id excepted, best first."""
        own = slice(np.searchsorted(self.ids, query_id, "left"), np.searchsorted(self.ids, query_id, "right"))
        open_rows = self.rows & ~self._bitmap(np.arange(own.start, own.stop)) if own.start < own.stop else self.rows.copy()
        sure = np.zeros(self.words, dtype=np.uint64)
        for bitmap in reversed(self.sum_slices(query)):
            high = open_rows & bitmap
            n = int(np.bitwise_count(sure | high).sum())
            if n >= k:
                open_rows = high
            else:
                sure |= high
                open_rows = open_rows & ~bitmap
            if n == k:
                break
        at = self._positions(sure)
        tied = self._positions(open_rows)[: max(0, k - len(at))]
        at = np.concatenate([at, tied])
        scores = (sum(a * b for a, b in zip(row, query, strict=True)) for row in integers(self.cells[at]))
        return ranked(zip(scores, self.ids[at].tolist(), strict=True), k)

    def _positions(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def ranked(rows, k: int) -> list[tuple[int, int]]:
    return sorted(rows, key=lambda r: (-r[0], r[1]))[:k]


def sort_key(n: int) -> bytes:
    """Bytes whose order is that of the integers, whatever their size: sign, length, magnitude."""
    size = (abs(n).bit_length() + 7) // 8
    own = size.to_bytes(4, "big") + abs(n).to_bytes(size, "big")
    return b"\x01" + own if n >= 0 else b"\x00" + bytes(255 - b for b in own)


def quantised(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """_id and _v of the rows whose vector is whole and finite: components as doubles, floored to
    multiples of 1/256 (from 2**44 on every double is one)."""
    v = F.transform(vec_col, lambda x: x.cast("double"))
    whole = F.col(vec_col).isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    snap = lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x * SCALE).cast("double") / SCALE).otherwise(x)
    return df.where(whole & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.transform(v, snap).alias("_v"))


def _matrix(vectors: pd.Series, dims: int, kind: type) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out if kind == np.float64 else (out * SCALE).astype(kind)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block_rows: int | None = None,
    query_rows: int | None = None,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest integer inner product for each row of ``queries``.

    Returns query_id, rank (from 1), vec_id, score, exact; fewer than k rows where there are
    fewer candidates. Ties go to the smaller id. Rows that share the query's id are its own and
    are no candidates. Vectors that are null or hold null or non-finite components, and rows
    without an id, take no part; missing trailing components count as 0, so an empty vector
    scores 0 with every other. A query id that repeats is asked once for each distinct vector; a
    candidate row that repeats counts as often as it stands there. Other columns are ignored.
    Finite components may have any size: sums are exact and ranked exactly. A score beyond 64
    bits is null in ``score``; ``exact`` has it in digits, and is null for the others.

    Candidates are dealt round robin into blocks of ``block_rows`` (by default ``BLOCK_CELLS``
    components), so that equal vectors or equal ids do not meet in one task. Queries are packed
    and sent to every block; a task reads its block once, builds the index, and streams the packs
    past it. More than ``PACKS_A_TASK`` packs, or fewer blocks than cores, make several lanes of
    queries, and a block goes to each lane once. Only k rows for each query and block leave a task.
    """
    rows = quantised(vectors, id_col, vec_col)
    asked = quantised(queries, id_col, vec_col).distinct()
    largest = F.coalesce(F.max(F.array_max(F.transform("_v", F.abs))), F.lit(0.0))
    n_rows, dims, top = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("_v")), F.lit(0)), largest).first()
    n_asked, asked_dims, asked_top = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("_v")), F.lit(0)), largest).first()
    dims = max(1, dims, asked_dims)
    top = max(top, asked_top) * SCALE
    kind = np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.float64
    block_rows = block_rows or max(1, BLOCK_CELLS // dims)
    query_rows = query_rows or max(1, PACK_BYTES // (dims * np.dtype(kind).itemsize))
    index_rows = max(64, INDEX_BITS // (dims * (34 if top < 2**31 else 1 + math.frexp(max(top, asked_top))[1] + 9)))
    blocks = max(1, math.ceil(n_rows / block_rows))
    spread = math.ceil(2 * vectors.sparkSession.sparkContext.defaultParallelism / blocks)
    packs = max(1, math.ceil(n_asked / query_rows), min(spread, n_asked))
    lanes = max(math.ceil(packs / PACKS_A_TASK), min(packs, spread))

    def dealt(df: DataFrame, n: int) -> DataFrame:
        return df.repartition(n).mapInPandas(_pack(dims, kind), "_ids binary, _cells binary").withColumn("_n", F.spark_partition_id())

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = dealt(rows, blocks).select(F.col("_n").alias("_b"), every(lanes).alias("_lane"), F.lit(0).alias("_side"), "_ids", "_cells")
    right = dealt(asked, packs).select(every(blocks).alias("_b"), (F.col("_n") % lanes).alias("_lane"), F.lit(1).alias("_side"), "_ids", "_cells")
    met = left.unionByName(right).repartition(blocks * lanes, "_b", "_lane").sortWithinPartitions("_b", "_lane", "_side")

    def search(frames):
        place, index = None, []
        for frame in frames:
            for b, lane, side, ids, cells in zip(frame._b, frame._lane, frame._side, frame._ids, frame._cells, strict=True):
                if place != (b, lane):
                    place, index = (b, lane), []
                ids, cells = np.frombuffer(ids, np.int64), np.frombuffer(cells, kind).reshape(-1, dims)
                if side == 0:
                    index += [Block(ids[i : i + index_rows], cells[i : i + index_rows]) for i in range(0, len(ids), index_rows)]
                    continue
                found = []
                for q, v, raw in zip(ids.tolist(), integers(cells), cells, strict=True):
                    key = hashlib.blake2b(raw.tobytes(), digest_size=16).digest()
                    for score, i in ranked((r for block in index for r in block.best(q, v, k)), k):
                        fits = -(2**63) <= score < 2**63
                        found.append((q, key, i, score if fits else None, None if fits else str(score), sort_key(score)))
                names = ("query_id", "_key", "vec_id", "score", "exact", "_order")
                yield pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(names, zip(*found, strict=True), strict=False)}, columns=names)

    found = met.mapInPandas(search, "query_id long, _key binary, vec_id long, score long, exact string, _order binary")
    order = Window.partitionBy("query_id", "_key").orderBy(F.desc("_order"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "exact")


def _pack(dims: int, kind: type):
    def pack(frames):
        ids, values = [], []
        for frame in frames:
            if len(frame):
                ids.append(frame._id.to_numpy(np.int64))
                values.append(_matrix(frame._v, dims, kind))
        if ids:
            yield pd.DataFrame({"_ids": [np.concatenate(ids).tobytes()], "_cells": [np.concatenate(values).tobytes()]})

    return pack


def op7_bit_sliced_topk(spark, sf_dir):
    from .common import table

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5).select("query_id", "rank", "vec_id", "score")


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
