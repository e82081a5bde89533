"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends region, rack and shard levels. At each level every child draws
``-ln(u) / weight`` with ``u`` hashed from the row's key and the child's name, and the
smallest draw wins. A child's draw does not depend on its siblings, so a change of one
weight moves rows only into or out of that child's subtree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, table


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def balanced_tree(shards: int, per_rack: int = 4, racks_per_region: int = 2) -> list[Leaf]:
    """``shards`` equal leaves, filled rack by rack and region by region."""
    if shards < 1:
        raise ValueError("a tree needs at least one shard")
    per_region = per_rack * racks_per_region
    return [Leaf(f"region{s // per_region}", f"rack{s // per_rack}", s) for s in range(shards)]


def add_shard(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard in a region and rack of its own: no weight of another subtree changes,
    so rows move into the new shard and nowhere else."""
    n = max(x.shard for x in leaves) + 1
    return [*leaves, Leaf(f"grown{n}", f"grown{n}", n, weight)]


def _tree(leaves: list[Leaf]) -> list[tuple[str, float, list]]:
    """(name, weight, children) of the regions that have weight; a shard's children are its number."""
    regions: dict[str, dict[str, list[Leaf]]] = {}
    for x in leaves:
        if x.weight > 0:
            regions.setdefault(x.region, {}).setdefault(x.rack, []).append(x)
    out = []
    for region, racks in regions.items():
        own = [
            (f"{region}/{rack}", math.fsum(x.weight for x in low), [(f"{region}/{rack}/{x.shard}", x.weight, x.shard) for x in low])
            for rack, low in racks.items()
        ]
        out.append((region, math.fsum(w for _, w, _ in own), own))
    return out


def _literal(nodes: list, depth: int) -> Column:
    below = lambda c: F.lit(c) if depth == 1 else _literal(c, depth - 1)
    return F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(i).alias("at"), below(c).alias("below")) for i, (n, w, c) in enumerate(nodes)]
    )


def _descend(key: Column, children: Column) -> Column:
    """What lies below the child with the smallest draw; ties go to the child named first."""

    def draw(c: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, c["name"]), 11) + F.lit(0.5)) / F.lit(float(2**53))
        return F.struct((-F.log(u) / c["weight"]).alias("draw"), c["at"].alias("at"), c["below"].alias("below"))

    return F.array_min(F.transform(children, draw))["below"]


def place(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of ``key`` (any type, hashed as text; nulls share one shard).

    The tree is one literal and each level one step down it, so the expression stays small
    however many shards there are. Leaves of weight 0 get no rows. Raises ValueError if no
    weight is positive.
    """
    tree = _tree(leaves)
    if not tree:
        raise ValueError("no shard has a positive weight")
    key = F.coalesce(key.cast("string"), F.lit("\x00"))
    return _descend(key, _descend(key, _descend(key, _literal(tree, 3))))


def shard_documents(
    docs: DataFrame,
    leaves: list[Leaf],
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_bucket: int = 20_000,
    chunk: int = 10_000,
) -> DataFrame:
    """Every row's shard, its gapless slot within the shard, and its shard with one more shard.

    Returns id, size, text_crc32, law, shard, slot, grown_shard. The law is ``key``: id and
    shard count decide. size is the text's UTF-8 bytes plus 1, a null text counts as empty
    for the checksum and has size 1. Rows with a null id share a shard. Repeated rows stay
    repeated, each with a slot of its own; they are counted before the shuffle and unfolded
    after it, so a row repeated any number of times stays one shuffled record. An empty table
    gives no rows. Other columns of ``docs`` are ignored.

    Slots: rows of a shard are dealt to buckets by a hash; a row's slot is its bucket's offset
    (a prefix sum over the buckets' counts, at least 64 buckets and about ``rows_per_bucket``
    rows each) plus its running number in the bucket.
    """
    shards = len(leaves)
    text = F.col(text_col).cast("string")
    counted = (
        docs.select(
            F.col(id_col).alias("_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("_size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("_crc"),
        )
        .groupBy("_id", "_size", "_crc")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counted = cut_lineage(counted)  # the texts are read once
    rows = counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    buckets = max(64, math.ceil(rows / shards / rows_per_bucket))
    one = (
        counted.withColumn("_shard", place(F.col("_id"), leaves))
        .withColumn("_grown", place(F.col("_id"), add_shard(leaves)))
        .withColumn("_bucket", F.pmod(F.xxhash64("_id", "_size", "_crc", F.lit("bucket")), F.lit(buckets)))
    )
    totals = one.groupBy("_shard", "_bucket").agg(F.sum("_n").alias("_total"))
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_shard", "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    within = (
        Window.partitionBy("_shard", "_bucket").orderBy("_id", "_size", "_crc").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = one.withColumn("_start", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(offsets, ["_shard", "_bucket"])
    first = F.col("_offset") + F.col("_start")
    return (
        placed.withColumn("_from", F.explode(F.sequence(first, first + F.col("_n") - 1, F.lit(chunk).cast("long"))))
        .withColumn("_to", F.least(F.col("_from") + chunk - 1, first + F.col("_n") - 1))
        .withColumn("_slot", F.explode(F.sequence("_from", "_to")))
        .select(
            F.col("_id").alias(id_col),
            F.col("_size").alias("size"),
            F.col("_crc").alias("text_crc32"),
            F.lit("key").alias("law"),
            F.col("_shard").cast("int").alias("shard"),
            F.col("_slot").cast("long").alias("slot"),
            F.col("_grown").cast("int").alias("grown_shard"),
        )
    )


def op8_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"), balanced_tree(16))
