import math
from collections import Counter
from functools import cache

import numpy as np
import pytest
import xxhash

from paperloom.llm import decontamination as D

QUESTION = "A train leaves the station at 60 miles per hour and Anna walks to the market with 12 apples for 3 hours before Anna eats 12 apples at home"
DOC, ITEM = "doc_id long, text string, lang string, _h long", "item_id long, text string, _doc string"
FILL = "Some unrelated prose about rivers and hills that never asks anything at all. "


def leaks(spark, texts, items=(QUESTION,), **more):
    docs = spark.createDataFrame([(i, t, "en", 1) for i, t in enumerate(texts)], DOC)
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], ITEM)
    return {(r.doc_id, r.item_id): r for r in D.find_leaks(docs, bench, **more).collect()}


def test_copies_and_new_parameters_are_leaks_and_others_are_not(spark):
    renamed = QUESTION.replace("60", "75").replace("12", "31").replace("Anna", "Peter").replace("miles", "km")
    loose = QUESTION.replace("Anna walks", "Peter walks").replace("12 apples for", "31 apples for").replace("12 apples at", "99 apples at").replace("Anna eats", "Maria eats")
    texts = [QUESTION, FILL + QUESTION.upper().lower() + FILL, FILL * 3 + renamed, FILL * 5, "", None, QUESTION[:60], loose]
    got = leaks(spark, texts)
    assert {d for d, _ in got} == {0, 1, 2}
    assert got[2, 0].consistency == 1.0 and got[2, 0].n_slots > 0
    assert (7, 0) in leaks(spark, texts, least_consistency=0.0)


def test_short_empty_and_repeated_items(spark):
    assert set(leaks(spark, ["we ask what is love here", "nothing"], ("what is love", "", None))) == {(0, 0)}
    docs = spark.createDataFrame([(1, QUESTION, "en", 1)] * 3 + [(None, QUESTION, "en", 1)], DOC)
    bench = spark.createDataFrame([(1, QUESTION, "x")] * 2 + [(None, QUESTION, "x")], ITEM)
    assert D.find_leaks(docs, bench).count() == 1
    assert D.drop_leaks(docs, bench).count() == 1
    assert D.find_leaks(docs.limit(0), bench).count() == D.find_leaks(docs, bench.limit(0)).count() == 0


def test_canonical_kinds():
    t = D.canonical("Anna gave Tom 3 kg. Then Bob left!")
    assert t.tokens() == ["anna", "gave", "tom", "3", "kg", "then", "bob", "left"]
    assert t.kinds.tolist() == [0, 0, D.NAME, D.NUMBER, D.UNIT, 0, D.NAME, 0]
    assert len(D.canonical(None).codes) == 0


@cache
def brute_readings(text):
    """Token kinds and values of both readings, spelled out; runs of one kind of slot are one slot."""
    out = []
    for names in (False, True):
        tokens, first = [], True
        for raw in D._TOKEN.findall(text or ""):
            if raw in ".!?":
                first = True
                continue
            low = raw.lower()
            capital = raw[0] > "?" and raw[0] != low[0] and raw[1:] == low[1:] and len(raw) > 1
            kind = "<unit>" if low in D.UNITS else "<number>" if raw[0] in "0123456789" else "<name>" if capital and (names or not first) else ""
            first = False
            if kind and tokens and tokens[-1][0] == kind:
                tokens[-1][1] += " " + low
            else:
                tokens.append([kind, low, raw])
        out.append(tokens)
    return out


@cache
def brute_text(text, width):
    """Windows as (place, marks, slots), and how many the first reading has."""
    plain, named = brute_readings(text)
    w = min(width, len(plain))
    if not w:
        return [], 0, 0
    starts = []  # the first raw token that each token of a reading covers
    for tokens in (plain, named):
        at, own = 0, []
        for kind, value, _ in tokens:
            own.append(at)
            at += len(value.split(" ")) if kind else 1
        starts.append(own)
    out = {}
    for tokens, own in zip((plain, named), starts, strict=True):
        if tokens is named and (len(named) < width or named == plain or w < width):
            continue
        for i in range(len(tokens) - w + 1):
            win = tokens[i : i + w]
            bare = all(k for k, _, _ in win)
            marks = tuple(("value", v) if bare else k or v for k, v, _ in win)
            place = next((j for j, x in enumerate(starts[0]) if x >= own[i]), len(starts[0]))
            if place <= len(plain) - w and (place, marks) not in out:
                out[place, marks] = tuple(v if k else "" for k, v, _ in win)
    return sorted((*k, v) for k, v in out.items()), w, len(plain) - w + 1


def brute_consistency(pairs):
    if not pairs:
        return 1.0
    forth, back = {}, {}
    for a, b in pairs:
        forth.setdefault(a, Counter())[b] += 1
        back.setdefault(b, Counter())[a] += 1
    return min(sum(max(c.values()) for c in m.values()) for m in (forth, back)) / len(pairs)


def brute_slots(cells):
    at = {}
    for q, theirs, ours in cells:
        for i, (a, b) in enumerate(zip(theirs, ours, strict=True)):
            if a or b:
                at.setdefault(q + i, (a, b))
    return list(at.values())


def brute_leak(doc, item, width=D.WINDOW, share=0.3, least=0.8):
    """Windows of the best alignment that has enough of them and consistent slots, None if there is none."""
    own, w, n = brute_text(item, width)
    if not n:
        return None
    have = {}
    for p, marks, slots in brute_text(doc, width)[0] if w == width else brute_short(doc, w):
        have.setdefault(marks, []).append((p, slots))
    along = {}
    for q, marks, slots in own:
        for p, ours in have.get(marks, ()):
            along.setdefault(p - q, {}).setdefault(q, (slots, ours))
    need = max(1, math.ceil(n * share))
    best = max((len(x) for x in along.values() if len(x) >= need and brute_consistency(brute_slots([(q, *v) for q, v in x.items()])) >= least), default=0)
    order, chains = sorted(along), []
    for s in order:
        if chains and s - chains[-1][-1] <= w:
            chains[-1].append(s)
        else:
            chains.append([s])
    for chain in chains:
        if len(chain) > 1:
            taken = {}
            for s in sorted(chain, key=lambda s: (len(along[s]), s), reverse=True):
                for q, v in along[s].items():
                    taken.setdefault(q, (q + s, *v))
            cells = sorted((q, p, a, b) for q, (p, a, b) in taken.items())
            longest = [1] * len(cells)
            for i in range(len(cells)):
                longest[i] = 1 + max((longest[j] for j in range(i) if cells[j][1] < cells[i][1]), default=0)
            if len(cells) and max(longest) >= need and max(longest) > best:
                best = ("joint", max(longest))
    return best or None


@cache
def brute_short(doc, w):
    plain = brute_readings(doc)[0]
    out = []
    for i in range(len(plain) - w + 1):
        win = plain[i : i + w]
        bare = all(k for k, _, _ in win)
        out.append((i, tuple(("value", v) if bare else k or v for k, v, _ in win), tuple(v if k else "" for k, v, _ in win)))
    return out


def made_texts(seed, count):
    rng = np.random.default_rng(seed)
    words = ["the", "red", "apples", "cost", "3", "12", "kg", "km", "Anna", "Tom", "Peter Paul", "then", "walks.", "We", "go", "far"]
    return [" ".join(words[int(i)] for i in rng.integers(len(words), size=int(rng.integers(0, 60)))) for _ in range(count)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_with_slot_consistency(spark, seed):
    items = made_texts(seed, 12) + [QUESTION, "12 13 14", "what is love", "3 km 4 kg 5 miles 6 km 7 mm 8 kg"]
    docs = made_texts(seed + 10, 25) + [FILL + t.replace("12", "31").replace("Anna", "Lisa Marie") + " " + FILL for t in items] + [" ".join(items[:4]), "on 12 13 14 off", "12 14 13"]
    docs += [t.replace("red", "very red") for t in items[:6]]
    got = {k: r.n_windows for k, r in leaks(spark, docs, items).items()}
    seen = 0
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            want = brute_leak(doc, item)
            if isinstance(want, tuple):  # joint: which places are taken at equals decides its slots
                seen += 1
                assert (d, i) not in got or got[d, i] <= want[1]
            else:
                assert got.get((d, i)) == want, (doc, item)
    assert len(got) > 20


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.n_windows for r in D.op5_decontamination(spark, sf).collect()}
    for d, t in docs.items():
        for i, text in items.items():
            if len(t or "") < 3000:
                want = brute_leak(t, text)
                assert isinstance(want, tuple) or got.get((d, i)) == want


def test_numbers_and_periods_do_not_blow_up(spark):
    rng = np.random.default_rng(5)
    numbers = [" ".join(map(str, rng.integers(100, size=20_000))) for _ in range(20)]
    assert set(leaks(spark, numbers, numbers)) == {(i, i) for i in range(20)}
    units = [" ".join(f"{x} km" for x in rng.integers(1000, size=10_000)) for _ in range(20)]
    assert set(leaks(spark, units, units)) == {(i, i) for i in range(20)}
    period = ["we count one and one again " * 1000]
    assert leaks(spark, period, period)[0, 0].share == 1.0


def test_wordless_windows_count_by_their_values(spark):
    assert leaks(spark, ["on 12 km 13 kg off", "a 1 b", "7 km 8 kg"], ("12 km 13 kg", "5")).keys() == {(0, 0)}


def test_texts_that_share_an_id_are_each_compared(spark):
    docs = spark.createDataFrame([(1, FILL, "en", 1), (1, QUESTION, "en", 1)], DOC)
    bench = spark.createDataFrame([(1, "an item about something else entirely, nothing that occurs", "x"), (1, QUESTION, "x")], ITEM)
    assert [(r.doc_id, r.item_id, r.share) for r in D.find_leaks(docs, bench).collect()] == [(1, 1, 1.0)]


def test_alignments_by_transforms_equal_listed_ones():
    rng = np.random.default_rng(2)
    rows = [(np.unique(rng.integers(200, size=40)), None, np.unique(rng.integers(300, size=90)), None) for _ in range(3)]
    rows = [(i, ["a"] * len(i), d, ["b"] * len(d)) for i, _, d, _ in rows]
    pair = D.Pair(rows, 8)
    listed = pair.shifts()
    D.LISTED_PAIRS, kept = 0, D.LISTED_PAIRS
    try:
        assert (pair.shifts() == listed).all()
    finally:
        D.LISTED_PAIRS = kept


def test_letters_beyond_the_alphabet_are_words():
    t = D.canonical("x² Ⅷ end. Éa ß 1.5 mm?")
    assert t.tokens() == ["x²", "ⅷ", "end", "éa", "ß", "1.5", "mm"]
    assert t.kinds.tolist() == [0, 0, 0, 0, 0, D.NUMBER, D.UNIT]


def test_names_that_start_sentences_may_be_swapped(spark):
    item = "Maria has 12 red apples. Peter has 5 green apples. Anna has 3 small apples. Julia has 9 large apples. How many apples are there?"
    swapped = item
    for a, b in (("Maria", "Susan"), ("Peter", "Robert"), ("Anna", "Clara"), ("Julia", "Helen"), ("12", "40"), ("5", "6"), ("3", "8"), ("9", "7")):
        swapped = swapped.replace(a, b)
    got = leaks(spark, [swapped, FILL + "Question: " + swapped, FILL, item.lower()], (item,))
    assert {d for d, _ in got} == {0, 1, 3}
    assert got[0, 0].share == got[3, 0].share == 1.0


def test_longer_names_and_inserted_words_do_not_split_a_leak(spark):
    item = (
        "On the first day old Maria sold 12 red apples to her friend at the market. In the same week old Peter sold 30 green pears to the "
        "people of the town, and then young Anna bought 7 yellow plums from both of them for her mother. How much fruit was left?"
    )
    longer = item.replace("Maria", "Mary Ann").replace("Peter", "John Paul").replace("Anna", "Rosa Lee").replace("12", "41").replace("30", "52").replace("7", "9")
    inserted = longer.replace("her friend", "her very good friend").replace("the same week", "the very same week").replace("people of", "good people of")
    inserted = inserted.replace("from both", "again from both")
    got = leaks(spark, [longer, FILL + inserted, FILL * 3], (item,))
    assert {d for d, _ in got} == {0, 1}
    assert got[0, 0].share == 1.0
    plain = D.canonical(item)
    known = set(D.window_hashes(plain.codes, D.WINDOW).tolist())
    along = [i - j for i, h in enumerate(D.window_hashes(D.canonical(inserted).codes, D.WINDOW).tolist()) if h in known for j, g in enumerate(D.window_hashes(plain.codes, D.WINDOW).tolist()) if g == h]
    assert max(along.count(x) for x in along) < 0.3 * (len(plain.codes) - D.WINDOW + 1)


def test_windows_in_order():
    assert D._in_order([(0, 5), (1, 2), (2, 6), (3, 3), (4, 7)]) in ([0, 2, 4], [1, 3, 4])
    assert D._in_order([]) == []


def test_texts_read_together_have_the_windows_of_each():
    items = ["Tom buys 12 apples for 3 dollars. Then he sells 5 of them to Ann", "one. Two", "12 Ab 13 Cd kg 16 m 17 New York Paris ends here now", "ΑΣ. Σας και ΑΣ İstanbul Éa Ab cD 12.5 KG Kg", ""]
    texts = [*items, None, "One", " ".join(items), "Of all. The same words and the same words again and again. The same"]
    every = lambda hashes: np.arange(len(hashes))
    together, alone = [], []
    for t, w, *window in D.joint_windows(texts, [1, 3, 8], 8, every):
        together.append((t, w, *window))
    for t, text in enumerate(texts):
        own = D.readings(text)
        for w in (1, 3, 8):
            if len(own[0].codes) >= w:
                for template, hashes, places, at in D.read_windows(own if w == 8 else own[:1], w):
                    alone += [(t, w, int(h), int(p), template.slots(int(i), w)) for h, p, i in zip(hashes, places, at, strict=True)]
    assert sorted(together) == sorted(alone) and len({x[0] for x in alone}) == 7


def test_codes_and_kinds_of_tokens_found_at_once_are_those_of_each():
    words = D.Vocabulary()
    raw = ["Ann", "ann", "KG", "12.5", ".", "X", "McCoy", "ΑΣ", "É", "ann", "Éa", "\ud800x"]
    kinds = [words.CAPITALISED, 0, D.UNIT, D.NUMBER, words.END, 0, 0, 0, 0, 0, words.CAPITALISED, 0]
    n = words.numbers(raw)
    assert words.kind[n].tolist() == kinds and [words.low(x) for x in n] == [x.lower() for x in raw]
    assert words.code[n].tolist() == [xxhash.xxh64_intdigest(x.lower().encode("utf-8", "surrogatepass")) for x in raw]
