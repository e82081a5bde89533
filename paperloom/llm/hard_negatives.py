"""Hard negatives: rows of other labels that score nearly as high as a positive, by bit-sliced products.

Components become floor(256 * x). A block keeps one bit plane for each bit of its components, a row's
plane packed into 64-bit words; an anchor has planes too. The product with one plane is a weighted sum
of bit counts of ANDed words. Planes are taken from the most significant (the sign) down: after each,
a row's score lies in an interval whose width is that of the planes still missing. A row leaves as soon
as its interval misses every window of the anchor, or lies below the scores that k rows already surely
have. What stays through the last plane has its exact score.
"""

from __future__ import annotations

import hashlib
import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bit_sliced import SCALE, integers, sort_key
from .common import cut_lineage

#: Components of the candidates of one block, bytes of one pack of anchors, packs that meet a block in one task.
BLOCK_CELLS, PACK_BYTES, PACKS_A_TASK = 1 << 22, 1 << 20, 64


def packed_bits(flags: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 as 64-bit words."""
    rows, dims = flags.shape
    out = np.zeros((rows, (dims + 63) // 64 * 8), np.uint8)
    raw = np.packbits(flags, axis=1, bitorder="little")
    out[:, : raw.shape[1]] = raw
    return out.view(np.uint64)


def width_of(cells: np.ndarray) -> int:
    """Bits of two's complement that hold all cells."""
    most, least = int(cells.max(initial=0)), int(cells.min(initial=0))
    return max(most, -(least + 1), 0).bit_length() + 1


def planes_of(cells: np.ndarray, bits: int) -> np.ndarray:
    """Planes of two's complement, the most significant first: bits x rows x words."""
    planes = [packed_bits(((cells >> b) & 1).astype(np.uint8)) for b in reversed(range(bits))]
    return np.stack(planes) if planes else np.zeros((0, len(cells), 0), np.uint64)


class Block:
    """Bit planes, ids and labels of the candidates of one block."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray):
        self.ids, self.labels = ids, labels
        self.bits = width_of(cells)
        self.planes = planes_of(cells, self.bits)

    def best(self, query: np.ndarray, open_rows: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[list[tuple[int, int]]]:
        """For each window (least and greatest score, None for no end), the (score, id) of its k first
        rows among ``open_rows``: higher scores first, then smaller ids."""
        own_bits = width_of(query)
        own = planes_of(query[None, :], own_bits)[:, 0]
        signs = [-1 if i == 0 else 1 for i in range(max(own_bits, self.bits))]
        values = [int(q) for q in query]
        above, below = sum(q for q in values if q > 0), sum(q for q in values if q < 0)
        exact = max(1, sum(map(abs, values))) << self.bits
        kind = np.int64 if exact < 2**62 else object
        at, score = open_rows, np.zeros(len(open_rows), kind)
        for i in range(self.bits):
            plane = self.planes[i][at]
            part = np.zeros(len(at), kind)
            for j in range(own_bits):
                both = np.bitwise_count(plane & own[j]).astype(np.int64).sum(axis=1) if plane.shape[1] != 1 else np.bitwise_count(plane[:, 0] & own[j]).astype(np.int64)
                part += both.astype(kind) * (signs[j] << (own_bits - 1 - j))
            left = self.bits - 1 - i
            score = score + part * (signs[i] << left)
            low, high = score + below * ((1 << left) - 1), score + above * ((1 << left) - 1)
            stays = np.zeros(len(at), bool)
            for least, most in windows:
                within = np.ones(len(at), bool)
                sure = np.ones(len(at), bool)
                if least is not None:
                    within &= (high >= least).astype(bool)
                    sure &= (low >= least).astype(bool)
                if most is not None:
                    within &= (low <= most).astype(bool)
                    sure &= (high <= most).astype(bool)
                lows = low[sure]
                if len(lows) >= k:
                    within &= (high >= (np.partition(lows, len(lows) - k)[len(lows) - k] if kind is np.int64 else sorted(lows)[-k])).astype(bool)
                stays |= within
            at, score = at[stays], score[stays]
        ids = self.ids[at]
        out = []
        for least, most in windows:
            fits = [(int(s), int(i)) for s, i in zip(score.tolist(), ids.tolist(), strict=True) if (least is None or s >= least) and (most is None or s <= most)]
            out.append(sorted(fits, key=lambda r: (-r[0], r[1]))[:k])
        return out


def prepared(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """_id, _label and _v of the rows that take part; components are doubles, floored to multiples of
    1/256 (from 2**44 on every double is one)."""
    own = df.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("_label"), F.transform(vec_col, lambda x: x.cast("double")).alias("_v"))
    finite = ~F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    snap = lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x * SCALE).cast("double") / SCALE).otherwise(x)
    return own.where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.col("_v").isNotNull() & finite).withColumn("_v", F.transform("_v", snap))


class Layout:
    """How many blocks, packs and lanes meet, and how components travel; from counts alone."""

    def __init__(self, rows: DataFrame, anchors: DataFrame, block_rows: int | None, anchor_rows: int | None):
        sizes = [F.count(F.lit(1)), F.coalesce(F.max(F.size("_v")), F.lit(0)), F.coalesce(F.max(F.array_max(F.transform("_v", F.abs))), F.lit(0.0))]
        (n, dims, top), (asked, asked_dims, asked_top) = rows.agg(*sizes).first(), anchors.agg(*sizes).first()
        self.dims = max(1, dims, asked_dims)
        top = max(top, asked_top) * SCALE
        self.kind = np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.float64
        self.blocks = max(1, math.ceil(n / (block_rows or max(1, BLOCK_CELLS // self.dims))))
        cores = rows.sparkSession.sparkContext.defaultParallelism
        spread = math.ceil(2 * cores / self.blocks)
        self.packs = max(1, math.ceil(asked / (anchor_rows or max(1, PACK_BYTES // (self.dims * np.dtype(self.kind).itemsize)))), min(spread, asked))
        self.lanes = max(math.ceil(self.packs / PACKS_A_TASK), min(self.packs, spread))

    def packed(self, df: DataFrame, n: int) -> DataFrame:
        """``df`` (_id, _label, _v, _asked) dealt round robin to ``n`` packs, each one row."""
        dims, kind = self.dims, self.kind

        def pack(frames):
            ids, labels, cells, asked = [], [], [], []
            for frame in frames:
                if len(frame):
                    ids.append(frame._id.to_numpy(np.int64))
                    labels.append(frame._label.to_numpy(np.int64))
                    grid = np.zeros((len(frame), dims))
                    for i, v in enumerate(frame._v):
                        grid[i, : len(v)] = v
                    cells.append(grid if kind == np.float64 else (grid * SCALE).astype(kind))
                    asked += frame._asked.tolist()
            if ids:
                joined = [np.concatenate(x).tobytes() for x in (ids, labels, cells)]
                yield pd.DataFrame({"_ids": joined[:1], "_labels": joined[1:2], "_cells": joined[2:], "_asked": ["\n".join(asked)]})

        schema = "_ids binary, _labels binary, _cells binary, _asked string"
        return df.repartition(n).mapInPandas(pack, schema).withColumn("_n", F.spark_partition_id())

    def met(self, rows: DataFrame, anchors: DataFrame, same_label: bool, k: int) -> DataFrame:
        """Of each block of ``rows``, the k first for every window in the ``_asked`` of an anchor (without
        windows: k in all), of the anchor's label or of other labels, never of its own id."""
        dims, kind = self.dims, self.kind
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        held = ["_ids", "_labels", "_cells", "_asked"]
        left = self.packed(rows.withColumn("_asked", F.lit("")), self.blocks).select(F.col("_n").alias("_b"), every(self.lanes).alias("_lane"), F.lit(0).alias("_side"), *held)
        right = self.packed(anchors, self.packs).select(every(self.blocks).alias("_b"), (F.col("_n") % self.lanes).alias("_lane"), F.lit(1).alias("_side"), *held)
        both = left.unionByName(right).repartition(self.blocks * self.lanes, "_b", "_lane").sortWithinPartitions("_b", "_lane", "_side")

        def unpacked(ids: bytes, labels: bytes, cells: bytes):
            grid = np.frombuffer(cells, kind).reshape(-1, dims)
            whole = np.array(integers(grid), object).reshape(-1, dims) if kind == np.float64 else grid.astype(np.int64)
            return np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), whole, grid

        def search(frames):
            place, block = None, None
            for frame in frames:
                for b, lane, side, ids, labels, cells, asked in zip(frame._b, frame._lane, frame._side, *(frame[c] for c in held), strict=True):
                    ids, labels, whole, raw = unpacked(ids, labels, cells)
                    if side == 0:
                        place, block = (b, lane), Block(ids, labels, whole)
                        continue
                    if place != (b, lane):  # anchors without candidates
                        continue
                    found = []
                    for i, label, query, own, windows in zip(ids.tolist(), labels.tolist(), whole, raw, asked.split("\n"), strict=True):
                        key = key_of(own, label)
                        wanted = np.flatnonzero(((block.labels == label) == same_label) & (block.ids != i))
                        windows = json.loads(windows) if windows else [[0, None, None, None]]
                        ends = [(least and int(least), most and int(most)) for *_, least, most in windows]
                        for (at, *_), best in zip(windows, block.best(query, wanted, ends, k), strict=True):
                            found += [(i, key, at, j, str(score), sort_key(score)) for score, j in best]
                    yield pd.DataFrame(found, columns=["_id", "_key", "_at", "_other", "_score", "_order"])

        return both.mapInPandas(search, "_id long, _key binary, _at int, _other long, _score string, _order binary")


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    low_pct: int = 80,
    high_pct: int = 100,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    block_rows: int | None = None,
    anchor_rows: int | None = None,
) -> DataFrame:
    """For each row of ``anchors`` and each of its ``positives`` first other rows of the same label, the
    ``negatives`` first rows of other labels whose integer inner product with the anchor is at least
    ``low_pct`` and at most ``high_pct`` percent of the positive's: anchor_id, positive_id, rank (from 1),
    negative_id, positive_score, negative_score.

    Higher scores come first, ties by smaller id. Rows without id or label, and rows whose vector is null
    or holds a null or non-finite component take no part; missing trailing components count as 0. Labels
    are whole numbers. Rows that share an anchor's id are its own: no positives, no negatives. A row of
    ``vectors`` that repeats counts as often as it stands there; anchors that repeat whole are asked once,
    an anchor's id with several vectors or labels once for each. An anchor whose scores with its positives
    are negative has no such rows (the window is empty). Empty tables give no rows; other columns are
    ignored. Scores are exact at any size; one beyond 64 bits is null in the result.

    Candidates are dealt round robin to blocks, so neither a hot label nor equal vectors meet in one task;
    packs of anchors go to every block, which a task indexes once. Two passes: positives first, then, with
    the windows that they give, negatives. Only the first rows of each block and window leave a task.
    """
    rows = prepared(vectors, id_col, vec_col, label_col)
    asked = prepared(anchors, id_col, vec_col, label_col).distinct()
    layout = Layout(rows, asked, block_rows, anchor_rows)

    def first(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("_id", "_key", "_at").orderBy(F.desc("_order"), "_other")
        return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)

    def with_windows(frames):
        for frame in frames:
            out = []
            for held in frame._held:
                windows = []
                for p in held:
                    score = int(p["_score"])
                    least, most = -(-low_pct * score // 100), high_pct * score // 100
                    if least <= most:
                        windows.append([int(p["_rank"]), int(p["_other"]), str(score), str(least), str(most)])
                out.append(json.dumps(windows) if windows else None)
            yield frame.drop(columns="_held").assign(_asked=out)

    near = first(layout.met(rows, asked.withColumn("_asked", F.lit("")), True, positives), positives)
    held = near.groupBy("_id", "_key").agg(F.collect_list(F.struct("_rank", "_other", "_score")).alias("_held"))  # ``positives`` at most
    keyed = asked.mapInPandas(_keyed(layout.dims, layout.kind), "_id long, _label long, _v array<double>, _key binary")
    ready = keyed.join(held, ["_id", "_key"]).select("_id", "_label", "_v", "_key", "_held")
    ready = cut_lineage(ready.mapInPandas(with_windows, "_id long, _label long, _v array<double>, _key binary, _asked string").where("_asked IS NOT NULL"))
    hard = first(layout.met(rows, ready.select("_id", "_label", "_v", "_asked"), False, negatives), negatives)
    windows = F.from_json("_asked", "array<array<string>>")
    asked_for = ready.select("_id", "_key", F.explode(windows).alias("_w"))
    asked_for = asked_for.select("_id", "_key", F.get("_w", 0).cast("int").alias("_at"), F.get("_w", 1).cast("long").alias("positive_id"), F.get("_w", 2).try_cast("long").alias("positive_score"))
    out = hard.join(asked_for, ["_id", "_key", "_at"])
    return out.select(F.col("_id").alias("anchor_id"), "positive_id", F.col("_rank").alias("rank"), F.col("_other").alias("negative_id"), "positive_score", F.col("_score").try_cast("long").alias("negative_score"))


def _keyed(dims: int, kind: type):
    """Adds the key by which an anchor's results are known: its vector, as it travels, and its label."""

    def key(frames):
        for frame in frames:
            grid = np.zeros((len(frame), dims))
            for i, v in enumerate(frame._v):
                grid[i, : len(v)] = v
            grid = grid if kind == np.float64 else (grid * SCALE).astype(kind)
            yield frame.assign(_key=[key_of(own, label) for own, label in zip(grid, frame._label.tolist(), strict=True)])

    return key


def key_of(cells: np.ndarray, label: int) -> bytes:
    return hashlib.blake2b(cells.tobytes() + label.to_bytes(8, "big", signed=True), digest_size=16).digest()


def op13_hard_negatives(spark, sf_dir):
    from .common import table

    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", moved)
    return hard_negatives(vectors, vectors.where(F.col("vec_id") % 100 == 0), positives=5, negatives=5, low_pct=80, high_pct=100)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS i FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND p.i <= 5
    AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
