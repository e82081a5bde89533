import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.llm import phrases as P

LOW = str.maketrans(P.UPPER, P.LOWER)


def brute(rows, max_words=3, min_count=10, cover=50, most=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    frequent = {p: n for p, n in f.items() if n >= min_count and len(p[1]) > 1}
    out = {}
    for (lang, p), a in frequent.items():
        within = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
        if any(x == lang and len(q) > len(p) and 100 * n >= cover * a and within(q) for (x, q), n in frequent.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, total[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1))


def run(spark, rows, **more):
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit("x")).withColumn("f", F.lit(1))
    names = {"cover": "cover_pct"}
    return sorted(tuple(r) for r in P.collocations(docs, **{names.get(k, k): v for k, v in more.items()}).collect())


def made(n=400, seed=1):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "city", "a", "b", "çà", "x\xa0y", "日本", "q'", "zz"]
    return [(rng.choice(["en", "en", "fr", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "?!"]) for _ in range(rng.randint(0, 12)))) for _ in range(n)]


@pytest.mark.parametrize("more", [{}, {"max_words": 4, "min_count": 3}, {"max_words": 2}, {"min_count": 5, "cover": 80, "most": 7}])
def test_equals_brute_force(spark, more):
    rows = made() + [("en", "New York City"), ("en", None), (None, None)] * 6
    assert run(spark, rows, **more) == brute(rows, **more)


def test_lots_lose_no_word():
    rows = [(lang or "", (t or "").encode()) for lang, t in made(300, 2)] + [(f"l{i}", b"many languages. " * 3) for i in range(200)]
    words = lambda texts: sorted(tuple(p.split(b" ")) for t in texts for p in re.split(b"[.,;:!?\n\x0b\x0c\r]", t.replace(b"\t", b" ")) if p.strip())
    for most in (5, 300, 10**6):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i : i + 90]]), pa.array([r[1].decode() for r in rows[i : i + 90]])], names=["lang", "text"]) for i in range(0, len(rows), 90)]
        got: dict = {}
        for lang, lot in P.lots(batches, most):
            got.setdefault(lang, []).extend(lot)
        assert set(got) == {r[0] for r in rows}
        assert all(words(got[lang]) == words(t for x, t in rows if x == lang) for lang in got)


def test_a_crowded_filter_changes_nothing(spark):
    rows = made(200, 2)
    assert run(spark, rows, min_count=4, filter_bits=64) == brute(rows, min_count=4)  # a filter that holds everything: all n-grams are emitted


def test_filter_holds_what_is_frequent_and_little_else(spark):
    frequent = spark.createDataFrame([("en", f"w{i} x") for i in range(500)], "lang string, phrase string")
    bits = P.filter_of(frequent).value
    text = b" ".join(b"w%d x y" % i for i in range(1000))
    got, counts = P.grams([text], "en", 3, bits)
    assert counts.sum() == 0  # "x y" is not held, so no three words are emitted
    both = spark.createDataFrame([("en", f"w{i} x") for i in range(500)] + [("en", "x y")], "lang string, phrase string")
    got, counts = P.grams([text], "en", 3, P.filter_of(both).value)
    assert sorted(got.to_pylist()) == sorted(b"w%d x y" % i for i in range(500)) and counts.tolist() == [1] * 500
    assert len(P.grams([text], "fr", 3, P.filter_of(both).value)[0]) == 0


def test_scores_beyond_64_bits(spark):
    levels = [spark.createDataFrame([("en", None, 9 * 10**14), ("en", "a", 8 * 10**14 + 1), ("en", "b", 7 * 10**14 + 3)], "lang string, phrase string, f long"), spark.createDataFrame([("en", "a b", 6 * 10**14 + 7)], "lang string, phrase string, f long")]
    a, left, right = 6 * 10**14 + 7, 8 * 10**14 + 1, 7 * 10**14 + 3
    own = P.frequencies
    P.frequencies = lambda *_: levels
    try:
        got = run(spark, [], max_words=2)
    finally:
        P.frequencies = own
    assert got == [("en", 1, "a b", a, left, right, 9 * 10**14, 1000000 * a * a // (left * right))]


def test_empty_and_wordless_tables(spark):
    assert run(spark, []) == run(spark, [("en", ""), ("en", " .,\n"), (None, None)]) == []


def test_long_text_and_repeated_rows(spark):
    rows = [("en", "deep water " * 60_000 + "stop. " + "z" * 300_000)] + [("en", "one two three")] * 30
    assert run(spark, rows) == brute(rows)


def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    got = sorted(tuple(r) for r in P.op12_collocations(spark, data).collect())
    assert got and got == sorted(con.execute(P.OP12_SQL).fetchall())
