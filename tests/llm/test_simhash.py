import random
import re

import numpy as np
import xxhash

from paperloom.llm import near_duplicates, simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(fps):
    ids = list(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints():
    for text in (None, "", " \t", "One", "one two", "A b C d e", "ÄB äb c\x0bd", "x " * 50, "a\u00a0b c d"):
        assert simhash.fingerprint(text) == brute_fingerprint(text), text


def test_query_equals_brute_force(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op2_simhash(spark, data).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


def links_of(spark, values, most_in_list):
    df = spark.createDataFrame([(v if v < 2**63 else v - 2**64,) for v in values], "_fp long")
    pairs = simhash.links(df, most_in_list).collect()
    return {(p[0] % 2**64, p[1] % 2**64) for p in pairs}


def test_links_connect_all_near_pairs_in_short_and_long_lists(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    values = set(seeds)
    for s in seeds:
        for _ in range(6):
            v = s
            for b in rng.sample(range(64), rng.randint(1, 5)):
                v ^= 1 << b
            values.add(v)
    values = sorted(values)
    want = brute_components(dict(enumerate(values)))
    for most in (256, 1):
        links = links_of(spark, values, most)
        at = {v: i for i, v in enumerate(values)}
        assert all((a ^ b).bit_count() <= 6 for a, b in links)
        root = list(range(len(values)))

        def find(i, root=root):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in links:
            x, y = find(at[a]), find(at[b])
            root[max(x, y)] = min(x, y)
        assert {i: find(i) for i in range(len(values))} == want


def test_one_of_each_stays(spark):
    text = "the same words again and again in one text"
    rows = [(3, text), (1, text), (1, text), (2, "quite another text with other words"), (None, text), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id for r in near_duplicates.keep_one_of_each(df).collect()), key=str) == sorted([1, 2, 5, None], key=str)
    assert near_duplicates.near_duplicates(df.limit(0)).count() == 0


def brute_similar(texts, least=0.8):
    """Components over exact Jaccard similarities of the sets of five-word shingles."""
    sets = {}
    for i, t in texts.items():
        words = (t or "").lower().split()
        sets[i] = {" ".join(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
    holders = {}
    for i, s in sets.items():
        for x in s or {""}:
            holders.setdefault(x, set()).add(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = {(a, b) for own in holders.values() for a in own for b in own if a < b}
    near = {(a, b) for a, b in pairs if sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}
    for a, b in near:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_copies_with_a_few_edits_are_one_group_and_others_are_not(spark):
    rng = random.Random(5)
    texts = {}
    for g in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(150)]
        for k in range(6):
            own = list(base)
            for _ in range(k):
                own[rng.randrange(len(own))] = f"new{rng.randrange(4000)}"
            texts[10 * g + k] = " ".join(own)
        texts[10 * g + 9] = " ".join(base[:80] + [f"v{rng.randrange(4000)}" for _ in range(70)])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_similar(texts)
    assert len(set(want.values())) < len(want)
    for most in (32, 2):
        assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(df, most_in_list=most).collect()} == want
    assert sorted(r.doc_id for r in near_duplicates.keep_one_of_each(df).collect()) == sorted(set(want.values()))


def test_near_duplicates_of_the_table_equal_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    want = brute_similar({r.doc_id: r.text for r in docs.collect()})
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()} == want


def test_every_linked_fingerprint_has_a_root_the_root_too(spark):
    edges = spark.createDataFrame([(1, 5), (5, 9), (20, 30)], "_a long, _b long")
    assert sorted(map(tuple, simhash.components(edges).collect())) == [(1, 1), (5, 1), (9, 1), (20, 20), (30, 20)]


def test_crowded_lists_lose_no_link(spark, monkeypatch):
    """Chains of near copies, in which no member is near all others, in lists that give one hub."""
    rng = random.Random(11)
    texts, n = {}, 0
    for _ in range(4):
        own = [f"w{rng.randrange(9000)}" for _ in range(120)]
        for k in range(40):
            texts[n] = " ".join(own)
            n += 1
            own = list(own)
            own[(k * 7) % 120] = f"n{rng.randrange(9000)}"
    monkeypatch.setattr(near_duplicates, "HUBS", 1)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_similar(texts)
    rows, roots = near_duplicates._similar(df, "doc_id", "text", 5, 0.8, 2)
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(df, most_in_list=2).collect()} == want
    assert rows.count() == n and roots.count() > 0


def test_pairs_across_components_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    sets = {i: sorted(set(rng.integers(0, 40, size=int(rng.integers(3, 30))).tolist())) for i in range(60)}
    sets |= {100 + i: sorted({*s[1:], 99}) for i, s in sets.items() if len(s) > 12}
    crowd = spark.createDataFrame([(1, i, len(s)) for i, s in sets.items()], "_key long, _fp long, _size int")
    apart = near_duplicates._apart(crowd, spark.createDataFrame([(i, i % 3) for i in sets], "_fp long, _root long"))
    assert 0 < apart.where("_minor").count() < apart.count() == len(sets)
    table = spark.createDataFrame(list(sets.items()), "_fp long, _set array<long>")
    near = lambda a, b: len({*sets[a]} & {*sets[b]}) >= 0.8 * len({*sets[a]} | {*sets[b]})
    want = {(a, b) for a in sets for b in sets if a < b and a % 3 != b % 3 and near(a, b)}
    got = {tuple(r) for r in near_duplicates._verified(near_duplicates._pairs_across(apart, table, 0.8), table, 0.8).collect()}
    assert got == want and want


def test_texts_that_share_an_id_are_kept_each(spark):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(5, one, "x"), (5, two, "y"), (5, one, "x"), (7, two + " end", "z"), (None, one, "n")], "doc_id long, text string, _k_th string")
    assert sorted((str(r.doc_id), r._k_th) for r in near_duplicates.keep_one_of_each(df).collect()) == [("5", "x"), ("5", "y"), ("None", "n")]


def test_fingerprints_of_an_empty_table(spark):
    assert simhash.fingerprint_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_prints(text):
    """SimHash of each three shingles that minimum hashes draw, bit by bit."""
    own = {int(x) % 2**64 for x in near_duplicates.shingle_set(text)}
    masks, factors = (x[:, 0].tolist() for x in (near_duplicates._MASKS, near_duplicates._FACTORS))
    drawn = [min(own, key=lambda x: (x ^ m) * f % 2**64) for m, f in zip(masks, factors, strict=True)]
    n = near_duplicates.PRINTS
    return [sum(1 << b for b in range(64) if sum(drawn[i + k * n] >> b & 1 for k in range(3)) > 1) for i in range(n)]


def test_prints_are_simhashes_of_drawn_shingles():
    for text in ("one", "one two three", "a b c d e f g", " ".join(f"w{i % 97}" for i in range(3000))):
        assert [int(x) % 2**64 for x in near_duplicates.prints(near_duplicates.shingle_set(text))] == brute_prints(text)
    assert len(near_duplicates.prints(near_duplicates.shingle_set(None))) == 0


def test_links_within_one_bit_in_short_and_long_lists(spark):
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    seeds += [(seeds[0] & ~0xFFFFFFFF) | rng.getrandbits(32) for _ in range(20)]
    values = sorted({s ^ flip for s in seeds for flip in (0, 1 << rng.randrange(64), 1 << rng.randrange(64), 7 << rng.randrange(60))})
    near = {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 1}
    signed = [(v if v < 2**63 else v - 2**64,) for v in values]
    for most in (256, 1):
        got = simhash.links(spark.createDataFrame(signed, "_fp long"), most, bits=1).collect()
        got = {tuple(sorted((a % 2**64, b % 2**64))) for a, b in got}
        assert near <= got and all((a ^ b).bit_count() <= 2 for a, b in got)


def test_the_byte_position_index_joins_the_lists_of_near_duplicates(spark):
    """Sets whose fingerprints differ by one bit, in either half, stand in one list; others in their own."""
    rows = [(1, 9, [5, 1 << 40]), (2, 9, [7, 77]), (3, 9, [(1 << 40) + (1 << 60), 99]), (4, 9, [4 + 3 * 256, 5])]
    df = spark.createDataFrame(rows, "_fp long, _size int, _prints array<long>")
    lists = {}
    for r in near_duplicates._posted(df).collect():
        lists.setdefault(r._key, set()).add(r._fp)
    assert sorted(map(sorted, lists.values())) == [[1, 2, 4], [1, 3], [2], [3], [4]]
    pairs, crowd = near_duplicates._candidates(near_duplicates._posted(df), 32, 0.8)
    assert {tuple(r) for r in pairs.collect()} == {(1, 2), (1, 3), (1, 4), (2, 4)} and crowd.isEmpty()


def test_filter_of_texts_holds_all_that_are_asked(spark):
    keys = np.random.default_rng(9).integers(-(2**63), 2**63, 3000)
    df = spark.createDataFrame([(int(k),) for k in keys[:1000]], "_th long").repartition(11)
    for bits in (16, 22):
        mask = near_duplicates._mask_of(df, bits)
        assert len(mask) == 1 << (bits - 3) and near_duplicates._holds(mask, bits, keys[:1000]).all()
        assert near_duplicates._holds(mask, bits, keys[1000:]).mean() < 0.03
