import random
from collections import defaultdict

from pyspark.sql import functions as F

from paperloom.llm import packing as P


def test_every_choice_is_the_tightest_compatible_bin():
    rng = random.Random(9)
    for _ in range(60):
        capacity, n = rng.randint(5, 40), rng.randint(1, 80)
        lengths = [rng.randint(1, capacity) for _ in range(n)]
        sources = [rng.choice([None, "a", "b", "c", "d", "e"]) for _ in range(n)]
        clusters = [rng.choice([None, *range(20)]) for _ in range(n)]
        got = P.pack_group(lengths, sources, clusters, capacity)
        bins: list = []
        for i in sorted(range(n), key=lambda i: (-lengths[i], i)):
            fits = [b for b, (r, s, c) in enumerate(bins) if r >= lengths[i] and not (sources[i] is not None and sources[i] in s) and not (clusters[i] is not None and clusters[i] in c)]
            if got[i] == len(bins):
                assert not fits
                bins.append([capacity, set(), set()])
            else:
                assert got[i] in fits and bins[got[i]][0] == min(bins[b][0] for b in fits)
            b = bins[got[i]]
            b[0] -= lengths[i]
            b[1].add(sources[i])
            b[2].add(clusters[i])


def test_query(spark, data):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = P.op10_packing(spark, data).collect()
    tokens, fill, sources = defaultdict(int), defaultdict(int), defaultdict(list)
    for r in rows:
        tokens[r.doc_id] += r.tokens
        fill[r.bin_group, r.bin] += r.tokens
        if r.tokens < 2048:
            sources[r.bin_group, r.bin].append(docs[r.doc_id].source)
    assert tokens == {i: max(1, len((d.text or "").split())) for i, d in docs.items()}
    assert max(fill.values()) <= 2048 and all(r.bin_fill == fill[r.bin_group, r.bin] for r in rows)
    assert all(len(x) == len(set(x)) for x in sources.values())


def test_odd_rows(spark):
    rows = [(1, "a b", "s", 1), (1, "a b", "s", 1), (2, None, None, 1), (None, "", "s", 1), (3, "w " * 25, "t", 1), (4, "A  B", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, bin int")
    got = P.pack(df, capacity=10)
    assert got.agg(F.sum("tokens")).first()[0] == 2 + 2 + 1 + 1 + 25 + 2
    assert sorted(r.tokens for r in got.where("doc_id = 3").collect()) == [5, 10, 10]
    same = [(r.bin_group, r.bin) for r in got.where("doc_id = 1 OR doc_id = 4").collect()]
    assert len(same) == len(set(same))  # copies don't share a sequence
    assert P.pack(df.limit(0)).count() == 0


def test_many_equal_rows_are_unfolded_in_chunks(spark):
    df = spark.range(30_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit(None).cast("string").alias("source"))
    got = P.pack(df, capacity=10, group_rows=2_000, chunk=1_000)
    r = got.agg(F.count(F.lit(1)), F.sum("tokens"), F.max("bin_fill"), F.count_distinct("bin_group", "bin")).first()
    assert tuple(r) == (30_000, 90_000, 3, 30_000)  # copies share no sequence
