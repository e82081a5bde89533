import random
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paperloom.llm import token_counts as T

PATH = public_tokenizers.path(T.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return T.PrefixCounter(PATH)


def plain(library, text):
    return [len(library.encode(text[:p], add_special_tokens=False).ids) for p in range(1, len(text) + 1)]


TEXTS = [
    "Hello, world! We're here; they'll say it's John's 2,048 tokens...",
    "'r 're 'll 'l ''s !'s don't o'clock 'Re 'VE x'",
    "a<|endoftext|>b !<|startoftext|>!<|endoftext <|ENDOFTEXT|> <|endoftext|><|endoftext|>",
    "Straße ΑΣ Σας İstanbul naïve 東京都 ภาษา \U0001f600\U0001f600 x y z\x1c\x85\t\r\n q",
    "internationalization antidisestablishmentarianism pneumonoultramicroscopic aaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "--------------====!!!!????....<<<<>>>>____",
    "½ ² Ⅷ ٣٤ 12345 a1b2",
    " ",
    "x",
]


@pytest.mark.parametrize("text", TEXTS)
def test_every_prefix_equals_the_library(counter, library, text):
    assert counter.prefix_counts(text).tolist() == plain(library, text)


def test_random_letters_equal_the_library(counter, library):
    rng = random.Random(5)
    for letters in ("abcdeinrst", "aei nrst'", "<|endoftx>' ", "éèñößabc ", "ab\x00\x7f﻿​1"):
        for _ in range(60):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 40)))
            assert counter.prefix_counts(text).tolist() == plain(library, text), text


def test_combining_characters_count_whole(counter, library):
    for text in ("été cafés", "한글 ok", "ạ́b ≮", "́x", "Å İ̇"):
        counts = counter.prefix_counts(text)
        parts = T.SEQUENCE.findall(text)
        at, want = 0, []
        for p in parts:
            at += len(p)
            want += [len(library.encode(text[:at], add_special_tokens=False).ids)] * len(p)
        assert counts.tolist() == want, text


def test_random_characters_of_all_planes_give_the_library_total(counter, library):
    rng = random.Random(11)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(0x20, 0x3000), rng.randrange(0x3000, 0xD800), rng.randrange(0xE000, 0x20000), 0x20])) for _ in range(30))
        assert counter.prefix_counts(text)[-1] == len(library.encode(text, add_special_tokens=False).ids), ascii(text)


def test_tokens_stay_apart_as_merging_anew_says(counter):
    names = list(counter.number)
    ranks = {counter.parts[i]: i for i in range(512, len(names))}

    def merged(*tokens):
        symbols = []
        for t in tokens:
            stack = [t]
            while stack:
                x = stack.pop()
                if x < 512:
                    symbols.append(x)
                else:
                    stack += [counter.parts[x][1], counter.parts[x][0]]
        while len(symbols) > 1:
            made, at = min((ranks.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:])))
            if made == 1 << 30:
                break
            symbols[at : at + 2] = [made]
        return symbols

    rng = random.Random(3)
    inner = [i for i, x in enumerate(names) if not x.endswith(T.END) and i < 9000]
    every = [i for i in range(9000) if counter.whole(i)]
    assert all((merged(i) == [i]) == counter.whole(i) for i in rng.sample(range(len(names)), 3000))
    for _ in range(20_000):
        a, b = rng.choice(inner), rng.choice(every)
        if counter.whole(a):
            assert counter.stays(a, b) == (merged(a, b) == [a, b]), (names[a], names[b])


def test_characters_the_library_reads_otherwise(counter, library, monkeypatch):
    monkeypatch.setattr(counter, "reading", lambda c: 0)
    for text in ("Straße ΑΣ Σας naïve 東京都!", "x İ é"):
        assert counter.prefix_counts(text)[-1] == len(library.encode(text, add_special_tokens=False).ids)


def test_words_without_end_take_linear_time(counter, library):
    counter.prefix_counts("warm up")
    seconds = []
    for n in (20_000, 80_000):
        began = time.perf_counter()
        got = counter.prefix_counts("abcdefghij" * (n // 10))
        seconds.append(time.perf_counter() - began)
        assert got[-1] == len(library.encode("abcdefghij" * (n // 10), add_special_tokens=False).ids)
    assert seconds[1] < 12 * seconds[0] + 0.5


def test_long_texts_are_cut_at_white_space(counter, library, monkeypatch):
    monkeypatch.setattr(T, "STRETCH", 7)
    text = TEXTS[0] * 5 + " " + TEXTS[2]
    assert counter.prefix_counts(text).tolist() == plain(library, text)


def test_little_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 3)
    own = T.PrefixCounter(PATH)
    assert own.prefix_counts(TEXTS[0]).tolist() == plain(library, TEXTS[0])


def test_operator_keeps_rows_and_columns(spark, library):
    rows = [(1, TEXTS[0], "a"), (1, TEXTS[0], "a"), (2, None, "b"), (3, "", None), (None, TEXTS[3], "c"), (4, "word " * 5000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, prefix_tokens string").withColumn("a.b", F.lit(1))
    out = T.prefix_counts(docs, PATH)
    assert out.columns == ["doc_id", "text", "a.b", "prefix_tokens"]
    word = plain(library, "word ")
    want = lambda t: [k + n for k in range(5000) for n in word] if len(t) > 1000 else plain(library, t)
    got = sorted(((r.doc_id, r.text, r.prefix_tokens) for r in out.collect()), key=str)
    assert got == sorted(((i, t, want(t or "")) for i, t, _ in rows), key=str)
    assert T.prefix_counts(docs.where("false"), PATH).count() == 0


def test_budgets_are_look_ups(spark, library):
    texts = [TEXTS[0], TEXTS[4], "", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    counted = T.prefix_counts(docs, PATH)
    for budget in (0, 1, 3, 8, 1000):
        for r in counted.select("text", T.truncated(F.col("text"), F.col("prefix_tokens"), budget).alias("cut"), T.tokens_of(F.col("prefix_tokens"), budget).alias("n")).collect():
            t = r.text or ""
            fits = [p for p, n in enumerate([0, *plain(library, t)]) if n <= budget]
            assert r.cut == t[: fits[-1]] and r.n == [0, *plain(library, t)][min(budget, len(t))]


def test_query_equals_the_library(spark, data, library):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in T.op11_token_counts(spark, data).collect()}
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    n = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in rows}
    assert got == {r.doc_id: (len((r.text or "").encode()), n[r.doc_id], n[r.doc_id] > 2048) for r in rows}
