"""Near duplicates by SimHash fingerprints of samples over the inverted index of byte positions.

Training data is cleared by the Jaccard similarity of sets of five-word shingles. One fingerprint of a whole
text can't give that relation: at a similarity of 0.8 two texts differ in about 10 of 64 bits, so in nearly
all bytes. So each set has several fingerprints, each the SimHash of three shingles that minimum hashes draw
from it. Two sets at a similarity of 0.8 draw the same three, and so have equal fingerprints, with probability
0.51 each. The index of ``simhash`` posts the distinct fingerprints by their bytes, counts shared bytes and
verifies the bits; sets whose fingerprints it joins are candidates, and each pair of those is verified by its
exact similarity.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage
from .simhash import components, digests, links, named

#: Near copies share this much of their sets of so many words. Two texts at 0.8 have one of 12 fingerprints of 3
#: drawn shingles in common with probability 0.9998; fingerprints up to ``PRINT_BITS`` apart are joined.
WORDS, SIMILARITY, PRINTS, DRAWN, PRINT_BITS, HUBS = 5, 0.8, 12, 3, 1, 8
#: Least and most bits (as powers of two) of the filter of texts whose sets are asked for; between them it has 64 for each.
FILTER_BITS = (16, 28)
_MASKS = np.random.default_rng(11).integers(0, 1 << 64, PRINTS * DRAWN, np.uint64)[:, None]
_FACTORS = np.random.default_rng(13).integers(0, 1 << 64, PRINTS * DRAWN, np.uint64)[:, None] | np.uint64(1)
_INVERSES = np.array([pow(int(f), -1, 1 << 64) for f in _FACTORS[:, 0]], np.uint64)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles' signed hashes, ascending."""
    return np.unique(np.frombuffer(digests(text, words), ">i8").astype(np.int64))


def set_fingerprint(own: np.ndarray) -> int:
    """Signed; equal for equal sets."""
    return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes())).view(np.int64))


def prints(own: np.ndarray) -> np.ndarray:
    """The signed SimHash of each sample of three shingles; none for an empty set."""
    if not len(own):
        return np.empty(0, dtype=np.int64)
    low = np.full(PRINTS * DRAWN, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(own), 2048):
        low = np.minimum(low, ((own[at : at + 2048].view(np.uint64) ^ _MASKS) * _FACTORS).min(axis=1))
    a, b, c = ((low * _INVERSES) ^ _MASKS[:, 0]).reshape(DRAWN, PRINTS)  # the shingles that have these minima
    return ((a & b) | (a & c) | (b & c)).view(np.int64)  # the bits set in over half of three


def _posted(rows: DataFrame) -> DataFrame:
    """The lists (_key) that sets (_fp, _size) stand in: one for each of a set's fingerprints (_prints), and
    one for each component of fingerprints that the index of byte positions joins."""
    own = rows.select("_fp", "_size", F.explode("_prints").alias("_key")).distinct()
    joined = cut_lineage(links(own.select(F.col("_key").alias("_fp")).distinct(), bits=PRINT_BITS))
    if joined.isEmpty():
        return own
    roots = components(joined).select(F.col("_fp").alias("_key"), "_root")
    return own.join(roots, "_key", "left").select("_fp", "_size", F.coalesce("_root", "_key").alias("_key")).distinct()


def _candidates(posted: DataFrame, most_in_list: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (_a, _b) of sets that share a list and whose sizes allow ``similarity``; and
    the members (_key, _fp, _size) of lists that gave only some of their pairs.

    Lists of up to ``most_in_list`` sets give all their pairs. A longer one gives those of
    ``HUBS`` of its members, the first by hash, with all others; a set that is in several such
    lists meets a hub once.
    """
    lists = posted.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    met = cut_lineage(posted.join(lists, "_key"))
    short = met.where(F.col("_n") <= most_in_list)
    a = short.select("_key", F.col("_fp").alias("_a"), F.col("_size").alias("_na"))
    b = short.select("_key", F.col("_fp").alias("_b"), F.col("_size").alias("_nb"))
    pairs = a.join(b, "_key").where("_a < _b").select("_a", "_b", "_na", "_nb")
    crowd = met.where(F.col("_n") > most_in_list).select("_key", "_fp", "_size")
    first = [F.min(F.struct(F.xxhash64("_fp", F.lit(i)), "_fp", "_size")) for i in range(HUBS)]
    hubs = crowd.groupBy("_key").agg(F.array(*first).alias("_hubs"))
    own = crowd.join(hubs, "_key").groupBy("_fp", "_size").agg(F.array_distinct(F.flatten(F.collect_set("_hubs"))).alias("_hubs"))
    stars = own.withColumn("_hub", F.explode("_hubs")).where("_fp != _hub._fp").select(
        F.least("_fp", "_hub._fp").alias("_a"), F.greatest("_fp", "_hub._fp").alias("_b"), F.col("_size").alias("_na"), F.col("_hub._size").alias("_nb")
    )
    fits = F.least("_na", "_nb") >= F.lit(similarity) * F.greatest("_na", "_nb")
    return pairs.unionByName(stars).where(fits).select("_a", "_b").distinct(), crowd


def _apart(crowd: DataFrame, roots: DataFrame) -> DataFrame:
    """The sets of crowded lists that span several components: (_fp, _size, _root, _minor). Of two sets of
    one list in different components at least one is minor, that is, outside some list's largest component."""
    known = crowd.join(roots, "_fp", "left").withColumn("_root", F.coalesce("_root", "_fp"))
    parts = known.groupBy("_key", "_root").agg(F.count(F.lit(1)).alias("_n"))
    spanning = parts.groupBy("_key").agg(F.max(F.struct("_n", "_root")).alias("_main"), F.count(F.lit(1)).alias("_parts")).where("_parts > 1")
    held = known.join(spanning.select("_key", F.col("_main._root").alias("_main")), "_key")
    return held.groupBy("_fp", "_size", "_root").agg(F.bool_or(F.col("_root") != F.col("_main")).alias("_minor"))


def _pairs_across(apart: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The rest of the pairs of crowded lists: minor sets with sets of other components that can
    reach ``similarity``, exactly. With shingles in one order, the rarest first, the first one that two
    such sets share comes so early in both that enough can follow; so the smaller set gives only
    its first ninth or so, the larger its first fifth, and what follows in both bounds the overlap."""
    shingles = apart.join(sets, "_fp").select("_fp", "_size", "_root", "_minor", F.explode("_set").alias("_s"))
    often = shingles.groupBy("_s").agg(F.count(F.lit(1)).alias("_often")).where("_often > 1")
    own = Window.partitionBy("_fp")
    alone = F.col("_size") - F.count(F.lit(1)).over(own)  # shingles that no other set has come before all these
    known = shingles.join(often, "_s").withColumn("_i", alone + F.row_number().over(own.orderBy("_often", "_s")))
    early = lambda share: F.col("_i") <= F.col("_size") - F.ceil(F.col("_size") * F.lit(share) - 1e-9) + 1
    share = similarity / (1 + similarity)  # two sets' overlap is at least this part of their sizes' sum
    side = lambda df, n: df.select("_s", *[F.col(c).alias(f"{c}_{n}") for c in ("_fp", "_size", "_root", "_minor", "_i")])
    small, large = side(known.where(early(2 * share)), "a"), side(known.where(early(similarity)), "b")
    least = F.lit(share) * (F.col("_size_a") + F.col("_size_b")) - 1e-9
    follows = 1 + F.least(F.col("_size_a") - F.col("_i_a"), F.col("_size_b") - F.col("_i_b"))
    met = small.join(large, "_s").where("_root_a != _root_b AND (_minor_a OR _minor_b) AND (_size_a < _size_b OR (_size_a = _size_b AND _fp_a < _fp_b))")
    met = met.where((F.col("_size_a") >= F.lit(similarity) * F.col("_size_b")) & (follows >= least))
    return met.select(F.least("_fp_a", "_fp_b").alias("_a"), F.greatest("_fp_a", "_fp_b").alias("_b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of at least ``similarity``."""
    a = sets.select(F.col("_fp").alias("_a"), F.col("_set").alias("_sa"))
    b = sets.select(F.col("_fp").alias("_b"), F.col("_set").alias("_sb"))
    both = pairs.join(a, "_a").join(b, "_b").withColumn("_shared", F.size(F.array_intersect("_sa", "_sb")))
    return both.where(F.col("_shared") / (F.size("_sa") + F.size("_sb") - F.col("_shared")) >= similarity).select("_a", "_b")


def _mask_of(keys: DataFrame, bits: int) -> np.ndarray:
    """A filter of ``2**bits`` bits in bytes, that holds the keys (_th) by their first bits."""

    def merged(frames):
        mask = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for f in frames:
            at = _place(f["_th"].to_numpy(np.int64), bits)
            np.bitwise_or.at(mask, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pd.DataFrame({"_mask": [mask.tobytes()]})

    mask = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for r in keys.coalesce(8).mapInPandas(merged, "_mask binary").toLocalIterator():
        mask |= np.frombuffer(r["_mask"], dtype=np.uint8)
    return mask


def _place(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _holds(mask: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter may hold."""
    at = _place(keys, bits)
    return (mask[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _similar(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float, most_in_list: int) -> tuple[DataFrame, DataFrame]:
    """Every row as (_id, _th: hash of its text, _fp: fingerprint of its set), and the roots of linked fingerprints."""

    def keys(frames):
        for f in frames:
            own = [shingle_set(t, words) for t in f["_t"]]
            fps = np.array([set_fingerprint(s) for s in own], dtype=np.int64)
            yield pd.DataFrame({"_id": f["_id"], "_th": f["_th"], "_fp": fps, "_size": [len(s) for s in own], "_prints": [prints(s) for s in own]})

    def sets(frames):
        seen = set()  # a task gives a frequent set once
        mask = np.frombuffer(held.value, dtype=np.uint8)
        for f in frames:
            out = []
            for t in f["_t"][_holds(mask, bits, f["_th"].to_numpy(np.int64))]:
                own = shingle_set(t, words)
                fp = set_fingerprint(own)
                if fp not in seen:
                    seen.add(fp)
                    out.append((fp, own))
            yield pd.DataFrame(out, columns=["_fp", "_set"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("_id"), text.alias("_t"), F.xxhash64(text).alias("_th"))
    rows = cut_lineage(own.mapInPandas(keys, f"_id {kind}, _th long, _fp long, _size int, _prints array<long>"))
    pairs, crowd = map(cut_lineage, _candidates(_posted(rows), most_in_list, similarity))
    wanted = pairs.select(F.explode(F.array("_a", "_b")).alias("_fp")).unionByName(crowd.select("_fp")).distinct()
    # the sets are built again for the texts of the candidates alone, as sets are many times larger than the rest
    asked = cut_lineage(rows.join(wanted, "_fp", "left_semi").select("_th").distinct())
    bits = min(max(FILTER_BITS[0], math.ceil(math.log2(64 * asked.count() + 1))), FILTER_BITS[1])
    held = docs.sparkSession.sparkContext.broadcast(_mask_of(asked, bits).tobytes())
    found = own.select("_th", "_t").mapInPandas(sets, "_fp long, _set array<long>").join(wanted, "_fp", "left_semi")
    found = cut_lineage(found.dropDuplicates(["_fp"]))
    linked = cut_lineage(_verified(pairs, found, similarity))
    roots = components(linked)
    apart = cut_lineage(_apart(crowd, roots))
    if not apart.isEmpty():
        roots = components(linked.unionByName(_verified(_pairs_across(apart, found, similarity), found, similarity)))
    return rows.select("_id", "_th", "_fp"), roots


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    most_in_list: int = 32,
) -> DataFrame:
    """Every row's id, fingerprint (16 hex digits) of its set of shingles, and component_id.

    component_id is the smallest id reachable over links of at least ``similarity``, the row's
    own included; null only if no reachable row has an id. Every link is verified by the exact
    Jaccard similarity of the sets of ``words``-word shingles. A list of more than ``most_in_list``
    sets is first linked through a few of its members; where that leaves it in several components,
    its other pairs across them follow. Texts with equal sets are one
    class (those without words another), so copies meet in no pairs. Repeated rows stay
    repeated, an empty table gives no rows, other columns are ignored. Texts are hashed whole.
    """
    rows, roots = _similar(docs, id_col, text_col, words, similarity, most_in_list)
    classes = cut_lineage(rows.groupBy("_fp").agg(F.min("_id").alias("_least")))
    return named(rows.select("_id", "_fp"), classes, roots, id_col)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each component, once, with all its columns.

    Of rows with one id but several texts each belongs to its own text's component. Rows with a
    null id cannot be named in a group and stay.
    """
    with_id = docs.where(F.col(id_col).isNotNull())
    rows, roots = _similar(with_id, id_col, text_col, WORDS, SIMILARITY, 32)
    first = rows.groupBy("_fp").agg(F.min(F.struct("_id", "_th")).alias("_first")).join(roots, "_fp", "left")
    kept = first.groupBy(F.coalesce("_root", "_fp").alias("_root")).agg(F.min("_first").alias("_first")).select("_first._id", "_first._th").distinct()
    prefix = "_k"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    marked = with_id.withColumn(f"{prefix}_th", F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    own = [f"{prefix}_id", f"{prefix}_th"]
    kept = kept.select(F.col("_id").alias(own[0]), F.col("_th").alias(own[1]))
    joined = marked.withColumn(own[0], F.col(id_col)).join(kept, own, "left_semi").dropDuplicates(own)
    return joined.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
