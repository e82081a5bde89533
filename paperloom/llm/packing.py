"""Best-fit packing of documents into sequences under conflict constraints.

Documents are packed by decreasing length. Open bins are kept in order of their residual
space and carry two bitmaps: the sources and the duplicate clusters they already hold. For a
document the search starts at the smallest residual that holds it and goes on to successors
until a bin without conflict is found; that is the tightest compatible bin. If none is left,
a bin is opened.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text


class Packer:
    """Bins of one group. ``sources`` and ``clusters`` number the group's values; a negative
    number stands for a value that cannot conflict (null, or met once in the group).

    Bins with the same residual and the same source bitmap form one class of the order, so a
    successor step passes all of a class at once when the source conflicts.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (residual, source bitmap) of classes, sorted
        self.classes: dict[tuple[int, int], list[tuple[int, int]]] = {}  # to (cluster bitmap, bin)
        self.bins = 0

    def put(self, length: int, source: int, cluster: int) -> int:
        """The bin that gets the document; bins count from 0."""
        s_bit = 1 << source if source >= 0 else 0
        c_bit = 1 << cluster if cluster >= 0 else 0
        for i in range(bisect_left(self.order, (length, 0)), len(self.order)):
            key = self.order[i]
            if key[1] & s_bit:
                continue
            held = self.classes[key]
            for j in range(len(held) - 1, -1, -1):
                clusters, number = held[j]
                if not clusters & c_bit:
                    held.pop(j)
                    if not held:
                        del self.classes[key]
                        self.order.pop(i)
                    self._keep(key[0] - length, key[1] | s_bit, clusters | c_bit, number)
                    return number
        self.bins += 1
        self._keep(self.capacity - length, s_bit, c_bit, self.bins - 1)
        return self.bins - 1

    def _keep(self, residual: int, sources: int, clusters: int, number: int) -> None:
        if residual > 0:
            key = (residual, sources)
            if key not in self.classes:
                self.classes[key] = []
                insort(self.order, key)
            self.classes[key].append((clusters, number))


def pack_group(lengths, sources, clusters, capacity: int) -> list[int]:
    """Bin of each document of one group, in the order given. Every length is 1 to capacity.

    Ties in length go by position, so the caller orders rows to fix the result.
    """

    def numbered(values, once: bool):
        counts: dict = {}
        for v in values:
            counts[v] = counts.get(v, 0) + 1
        ids = {v: i for i, v in enumerate(v for v, n in counts.items() if v is not None and v == v and (n > 1 or not once))}
        return [ids.get(v, -1) for v in values]

    s, c = numbered(sources, True), numbered(clusters, True)
    packer = Packer(capacity)
    out = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        out[i] = packer.put(lengths[i], s[i], c[i])
    return out


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    group_rows: int = 4_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str | None = "source",
    cluster_col: str | None = None,
    chunk: int = 10_000,
) -> DataFrame:
    """Places every document in sequences of ``capacity`` tokens (words of the text).

    Returns id, part, tokens, bin_group, bin, bin_fill: a document longer than ``capacity`` is
    cut into full parts, each a sequence of its own, and a rest (part counts from 0, tokens of
    the parts sum to the document's). No sequence holds two documents of one source or of one
    duplicate cluster; ``cluster_col`` None means the hash of the text with white space and
    case levelled. Null sources or clusters conflict with nothing. Null and empty texts count
    one token, so that they too get a place. Repeated rows are placed each by itself (their
    cluster keeps them apart). Null ids stay; an empty table gives no rows; other columns are
    ignored.

    Rows are dealt by a hash of id and cluster into groups of about ``group_rows`` and each
    group is packed by itself; only lengths, a source and a cluster hash reach Python. Copies
    of one text that share an id too are spread by a second hash of their other columns; rows
    equal in everything are counted first and unfolded into numbered copies, ``chunk`` at a time.
    """
    text = whole_text(text_col)
    level = F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))
    cluster = F.xxhash64(level) if cluster_col is None else F.xxhash64(F.col(cluster_col).cast("string"))
    if cluster_col is not None:
        cluster = F.when(F.col(cluster_col).isNotNull(), cluster)
    source = F.lit(None).cast("string") if source_col is None else F.col(source_col).cast("string")
    words = F.size(F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != ""))
    rows = (
        docs.select(F.col(id_col).alias("_id"), source.alias("_source"), cluster.alias("_cluster"), F.greatest(words, F.lit(1)).alias("_tokens"))
        .groupBy("_id", "_source", "_cluster", "_tokens")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), "_n", F.lit(chunk).cast("long"))))
        .withColumn("_copy", F.explode(F.sequence("_from", F.least(F.col("_from") + chunk - 1, "_n"))))
    )
    full = F.floor((F.col("_tokens") - 1) / capacity).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), full),
        lambda i: F.struct(i.alias("part"), F.when(i < full, F.lit(capacity)).otherwise(F.col("_tokens") - full * capacity).alias("tokens")),
    )
    groups = max(1, math.ceil(docs.select(id_col).count() / group_rows))
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("_id", "_cluster", "_copy"), F.lit(groups)).cast("int"))
    cells = dealt.select("_id", "_source", "_cluster", "_group", "_copy", F.explode(parts).alias("_part")).select(
        "_id", "_source", "_cluster", "_group", "_copy", F.col("_part.part").alias("part"), F.col("_part.tokens").cast("int").alias("tokens")
    )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_id", "_cluster", "_source", "_copy", "part"], kind="stable", na_position="first")
        source_ = [None if pd.isna(v) else v for v in frame["_source"]]
        cluster_ = [None if pd.isna(v) else v for v in frame["_cluster"]]
        lengths = frame["tokens"].tolist()
        bins = pack_group(lengths, source_, cluster_, capacity)
        fill: dict[int, int] = {}
        for b, n in zip(bins, lengths, strict=True):
            fill[b] = fill.get(b, 0) + n
        return pd.DataFrame({
            "_id": frame["_id"], "part": frame["part"], "tokens": frame["tokens"],
            "bin_group": frame["_group"], "bin": bins, "bin_fill": [fill[b] for b in bins],
        })

    kind = docs.schema[id_col].dataType.simpleString()
    packed = cells.groupBy("_group").applyInPandas(run, f"_id {kind}, part int, tokens int, bin_group int, bin int, bin_fill int")
    return packed.withColumnRenamed("_id", id_col)


def op10_packing(spark, sf_dir):
    from .common import table

    return pack(table(spark, sf_dir, "documents"))
