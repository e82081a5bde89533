import math
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from paperloom.llm import sharding as S


def placed(spark, leaves, n=4000):
    df = spark.range(n).select("id", S.place(F.col("id"), leaves).alias("s"))
    return {r.id: r.s for r in df.collect()}


def test_only_the_new_shard_gets_rows(spark):
    leaves = S.balanced_tree(16)
    before, after = placed(spark, leaves), placed(spark, S.add_shard(leaves))
    assert {after[i] for i in before if after[i] != before[i]} == {16}
    counts = Counter(before.values())
    assert len(counts) == 16 and max(counts.values()) < 2 * min(counts.values())


def test_movement_stays_in_the_changed_subtree(spark):
    leaves = S.balanced_tree(16)
    changed = [S.Leaf(x.region, x.rack, x.shard, {5: 1.5, 6: 0.5}.get(x.shard, 1.0)) for x in leaves]  # one rack's total stays
    before, after = placed(spark, leaves), placed(spark, changed)
    moved = {i for i in before if before[i] != after[i]}
    assert moved and {before[i] for i in moved} | {after[i] for i in moved} <= {4, 5, 6, 7}
    gone = [S.Leaf(x.region, x.rack, x.shard, 0.0 if x.shard == 9 else 1.0) for x in leaves]
    assert 9 not in placed(spark, gone).values()


def test_weights_set_shares(spark):
    counts = Counter(placed(spark, [S.Leaf("a", "a", 0, 3.0), S.Leaf("b", "b", 1, 1.0)], 8000).values())
    assert abs(counts[0] / 8000 - 0.75) < 0.03


def test_query(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = S.op8_sharding(spark, data).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, "a", "k"), (1, "a", "k"), (1, "a", "k"), (None, None, "k"), (None, None, "k"), (2, "", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    got = S.shard_documents(df, S.balanced_tree(3), chunk=2).collect()
    assert Counter(r.doc_id for r in got) == {1: 3, None: 2, 2: 1}
    per = defaultdict(list)
    for r in got:
        per[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in per.values())
    assert {r.size for r in got if r.doc_id is None} == {1} and len({r.shard for r in got if r.doc_id is None}) == 1
    assert S.shard_documents(df.limit(0), S.balanced_tree(3)).count() == 0


def brute_place(key, leaves):
    """The tree walked level by level with draws of plain Python."""
    own = [x for x in leaves if x.weight > 0]
    for name in (lambda x: x.region, lambda x: f"{x.region}/{x.rack}", lambda x: f"{x.region}/{x.rack}/{x.shard}"):
        weights = defaultdict(float)
        for x in own:
            weights[name(x)] += x.weight

        def draw(child):
            h = xxhash.xxh64_intdigest(child, seed=xxhash.xxh64_intdigest(key, seed=42))
            return -math.log(((h >> 11) + 0.5) / 2**53) / weights[child]  # noqa: B023

        best = min(weights, key=draw)
        own = [x for x in own if name(x) == best]
    return own[0].shard


def test_draws_equal_plain_python(spark):
    uneven = [S.Leaf(x.region, x.rack, x.shard, 0.5 + x.shard % 3) for x in S.balanced_tree(13)] + [S.Leaf("region0", "rack9", 99, 0.0)]
    for leaves in (S.balanced_tree(16), S.add_shard(S.balanced_tree(16)), uneven):
        assert placed(spark, leaves, 1500) == {i: brute_place(str(i), leaves) for i in range(1500)}
    assert {r.s for r in spark.range(1).select(S.place(F.lit(None), uneven).alias("s")).collect()} == {brute_place("\x00", uneven)}


def test_very_long_texts(spark):
    df = spark.createDataFrame([(1, "é" * 3_000_000), (2, "x")], "doc_id long, text string")
    got = {r.doc_id: (r.size, r.text_crc32) for r in S.shard_documents(df, S.balanced_tree(3)).collect()}
    assert got == {1: (6_000_001, zlib.crc32(("é" * 3_000_000).encode())), 2: (2, zlib.crc32(b"x"))}
