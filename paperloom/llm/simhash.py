"""Near duplicates by SimHash fingerprints over an inverted index of byte positions.

Fingerprints of 64 bits that differ in at most 3 bits differ in at most 3 of their 8 bytes,
so they share at least 5 positional bytes. The index posts every distinct fingerprint under
the values of 14 sets of four byte positions. The sets are the 4-subsets of 0..7 whose
members xor to 0: each 3 positions lie in exactly one of them and complements of sets are
sets, so whatever 3 bytes differ, one set is untouched. Per pair that meets in a posting list
the shared positional bytes are tallied, pairs with the guaranteed 5 stay, and their
distance is verified.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

BITS = 3
POSITION_SETS = [c for c in itertools.combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
#: The sets by the most bits that may differ: a single byte leaves one of the two halves untouched.
SETS = {1: [(0, 1, 2, 3), (4, 5, 6, 7)], BITS: POSITION_SETS}

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def digests(text: str | None, words: int) -> bytes:
    """Eight bytes for each shingle of ``words`` words (all words, if there are fewer)."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return b""
    if len(parts) <= words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False))
    return b"".join(map(xxhash.xxh64_digest, shingles, itertools.repeat(42)))


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned SimHash of the shingles of ``words`` words, repeats included; 0 without words."""
    found = digests(text, words)
    if not found:
        return 0
    n = len(found) // 8
    # one histogram over (byte position, byte value), then bits per position
    at = np.frombuffer(found, np.uint8).reshape(n, 8) + np.arange(0, 2048, 256, dtype=np.int16)
    counts = np.bincount(at.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int.from_bytes(np.packbits(counts.ravel() * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """_id and _fp (the fingerprint as a signed long) of every row."""

    def run(frames):
        for f in frames:
            fp = np.array([fingerprint(t, words) for t in f["_t"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"_id": f["_id"], "_fp": fp})

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    return own.mapInPandas(run, f"_id {kind}, _fp long")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftright(fp, 8 * position).bitwiseAND(F.lit(255))


def _postings(classes: DataFrame, bits: int) -> DataFrame:
    """_key (position set and its four byte values) and _fp, a row for each fingerprint and set."""
    fp = F.col("_fp")
    keys = []
    for i, at in enumerate(SETS[bits]):
        value = reduce(lambda acc, p: F.shiftleft(acc, 8).bitwiseOR(_byte(fp, p)), at, F.lit(i).cast("long"))
        keys.append(value)
    return classes.select(F.explode(F.array(*keys)).alias("_key"), "_fp")


def _shared_bytes(a: Column, b: Column) -> Column:
    return reduce(lambda x, y: x + y, [(_byte(a.bitwiseXOR(b), p) == 0).cast("int") for p in range(8)])


def links(classes: DataFrame, most_in_list: int = 256, bits: int = BITS) -> DataFrame:
    """Links (_a, _b) between distinct fingerprints that keep every two fingerprints within
    ``bits`` bits (1 or 3) connected; a link may join two that have a third within reach of both.

    Posting lists of up to ``most_in_list`` fingerprints give their pairs. A longer list gives
    a number of links in proportion to its length instead, exactly: within the list the
    fingerprints agree in four bytes, so two of them within 3 bits have some 32-bit word at
    most 1 bit from one's remaining bytes and at most 2 from the other's. Every word that some
    fingerprint reaches with 1 bit links all who reach it with 1 or 2 bits to one of the former.
    Within 1 bit the word is one's own bytes, and the other reaches it with 1 bit.
    """
    posted = _postings(classes, bits)
    lists = posted.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    met = posted.join(lists, "_key")
    short = met.where(F.col("_n") <= most_in_list).select("_key", "_fp")
    a, b = short.select("_key", F.col("_fp").alias("_a")), short.select("_key", F.col("_fp").alias("_b"))
    pairs = (
        a.join(b, "_key")
        .where(F.col("_a") < F.col("_b"))
        .where(_shared_bytes(F.col("_a"), F.col("_b")) >= 8 - bits)
        .where(F.bit_count(F.col("_a").bitwiseXOR(F.col("_b"))) <= bits)
        .select("_a", "_b")
    )
    long = met.where(F.col("_n") > most_in_list).select("_key", "_fp")
    return pairs.unionByName(_star_links(long, bits)).distinct()


def _star_links(long: DataFrame, bits: int) -> DataFrame:
    """Links within long posting lists through words near the bytes that the list leaves free."""

    free = [[8 * p + k for p in range(8) if p not in at for k in range(8)] for at in SETS[bits]]
    own_bits = F.array(*[F.array(*map(F.lit, x)) for x in free])[F.shiftrightunsigned("_key", 32).cast("int")]
    own = long.select("_key", "_fp", own_bits.alias("_bits"))

    def words(picks: list[tuple[int, ...]]) -> DataFrame:
        """One row for each choice of free bits, with those bits flipped."""
        flat = F.array(*[F.array(*map(F.lit, x)) if x else F.array().cast("array<int>") for x in picks])
        flip = F.expr("aggregate(_pick, _fp, (w, i) -> w ^ shiftleft(1L, _bits[i]))")
        return own.withColumn("_pick", F.explode(flat)).select("_key", "_fp", flip.alias("_w"))

    least = bits // 2
    near = words([x for n in range(least + 1) for x in itertools.combinations(range(32), n)])
    hubs = near.groupBy("_key", "_w").agg(F.min("_fp").alias("_hub"))
    further = words(list(itertools.combinations(range(32), least + 1)))
    reached = near.unionByName(further).join(hubs, ["_key", "_w"]).where(F.col("_fp") != F.col("_hub"))
    return reached.select(F.least("_fp", "_hub").alias("_a"), F.greatest("_fp", "_hub").alias("_b"))


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """_fp and _root (its component's smallest fingerprint) of every fingerprint with a link.

    Alternates large-star and small-star steps; each round is written to the checkpoint
    folder. Per round the neighbours of a node are only counted down to their minimum.
    """
    cur = cut_lineage(edges.select(F.greatest("_a", "_b").alias("_u"), F.least("_a", "_b").alias("_v")).distinct())
    seen = None
    for _ in range(most_rounds):
        state = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_u", "_v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            found = cur.select(F.col("_u").alias("_fp"), F.col("_v").alias("_root"))
            return found.unionByName(found.select(F.col("_root").alias("_fp"), "_root").distinct())
        seen = state
        both = cur.unionByName(cur.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        least = both.groupBy("_u").agg(F.min("_v").alias("_w")).withColumn("_w", F.least("_u", "_w"))
        large = both.join(least, "_u").where("_v > _u").select(F.col("_v").alias("_u"), F.col("_w").alias("_v"))
        large = large.distinct()
        low = large.groupBy("_u").agg(F.min("_v").alias("_w"))
        small = large.join(low, "_u").where("_v != _w").select(F.col("_v").alias("_u"), F.col("_w").alias("_v"))
        cur = cut_lineage(small.unionByName(low.select("_u", F.col("_w").alias("_v"))).distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def named(fps: DataFrame, classes: DataFrame, roots: DataFrame, id_col: str) -> DataFrame:
    """Every row's id, fingerprint and component_id, from the rows (_id, _fp), their classes
    (_fp, _least) and the roots of linked fingerprints."""
    rooted = classes.join(roots, "_fp", "left").withColumn("_root", F.coalesce("_root", "_fp"))
    named = rooted.groupBy("_root").agg(F.min("_least").alias("_component"))
    linked = roots.join(named, "_root").select("_fp", "_component")
    labels = classes.join(linked, "_fp", "left").select("_fp", F.coalesce("_component", "_least").alias("_component"))
    labels = cut_lineage(labels)  # so both sides of the join are shuffled for it, and a frequent fingerprint can be split
    return fps.join(labels, "_fp").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_component").alias("component_id"),
    )


def fingerprint_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, most_in_list: int = 256
) -> DataFrame:
    """Every row's id, fingerprint (16 hex digits) and component_id, by bits alone.

    component_id is the smallest id reachable over links of at most 3 differing bits, the
    row's own included; null only if no reachable row has an id. Texts without words (null
    and empty ones) have fingerprint zero and link like any other. Equal fingerprints are one
    class, so copies meet in no pairs. Repeated rows stay repeated, an empty table gives no
    rows, other columns are ignored. Texts are hashed whole.
    """
    fps = cut_lineage(fingerprints(docs, id_col, text_col, words))
    classes = cut_lineage(fps.groupBy("_fp").agg(F.min("_id").alias("_least")))
    return named(fps, classes, components(links(classes.select("_fp"), most_in_list)), id_col)


def op2_simhash(spark, sf_dir):
    from .common import table

    return fingerprint_groups(table(spark, sf_dir, "documents"))
