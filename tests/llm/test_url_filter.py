import itertools
import math
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from paperloom.llm import url_filter as U

PAGE = "page_id long, url string, html string"


def brute_segment(name, counts, total):
    best = None
    for cuts in itertools.product((0, 1), repeat=len(name) - 1):
        words, start = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                words.append(name[start:i])
                start = i
        words.append(name[start:])
        p = 0.0
        for w in words:
            unknown = math.log(1 / (total + len(counts) + 1)) - 2.3 * len(w)
            p += max(unknown, math.log((counts[w] + 1) / (total + len(counts) + 1)) if w in counts else -math.inf)
        if best is None or p > best + 1e-12:
            best = p
    return best


def test_segmentation_is_the_most_probable():
    counts = {"cheap": 20, "pills": 20, "pill": 5, "he": 30, "a": 50, "s": 1, "new": 9, "news": 9}
    total = sum(counts.values())
    for name in ("cheappills", "news", "newspill", "aheap", "xyz", "a"):
        arcs = [(i, w, c) for w, c in counts.items() for i in range(len(name)) if name.startswith(w, i)]
        words = U.segment(name, arcs, total, len(counts))
        assert "".join(words) == name
        p = sum(math.log((counts[w] + 1) / (total + len(counts) + 1)) if w in counts else math.log(1 / (total + len(counts) + 1)) - 2.3 * len(w) for w in words)
        assert abs(p - brute_segment(name, counts, total)) < 1e-9
    assert U.segment("cheappills", [(0, "cheap", 20), (5, "pills", 20)], 40, 2) == ["cheap", "pills"]


def brute_rule(host, path):
    best = None
    for rule, verdict in U.RULES:
        d, _, p = rule.partition("/")
        if (host == d or host.endswith("." + d)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    tail = rest[end:]
    cut = min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), tail[:cut]


def test_urls_and_rules(spark):
    urls = [None, "", "nourl", "://", "http://EXAMPLE.com/en/1", "http://www.example.com/en/", "http://a.www.example.com/en/x", "http://example.com", "http://example.com?x://y/", "http://x.net/es/", "http://x.net/ES/",
            "a://b://c/d", "http://com/", "http://xcom/", "http://É.net/fr/#a", "http://x.net/fr/a\nb?q", "http://fnet/es/"]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGE)
    for r in U.judge(df).collect():
        host, path = brute_parts(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        rule, verdict = brute_rule(host, path)
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)


def invented():
    """(url, title, blocked): bad hosts without any seed word, one kind known by its titles, one by the company it keeps."""
    good = ["gardenbook", "daily-history", "schoolnews", "travelguide", "farm-weather", "free-library", "museumstory", "win-science", "track-recipes", "healthforum"]
    rows = [(f"http://{n}.example.org/en/{i}", "garden book daily history school news travel guide farm weather zorblix quimp", False) for i in range(3) for n in good]
    rows += [(f"http://www.zorblix-{x}.example.org/en/{i}", "the best casino of all", True) for i, x in enumerate(("one", "two", "three", "four"))]  # told by titles
    rows += [(f"http://{x}quimp.example.org/de/{i}", "quimp", True) for i, x in enumerate(("casino", "poker", "betting", "porn"))]  # a seed beside a new word
    rows += [("http://www.zorblix.example.org/de/9", "nothing to see", True), ("http://www.quimp.example.org/de/7", "", True), ("http://www.zorblixquimp.example.org/de/2", None, True)]  # neither
    return rows


def test_learns_words_that_are_no_seeds(spark):
    rows = invented()
    pages = [(i, u, None if t is None else f"<title>{t}</title>") for i, (u, t, _) in enumerate(rows)]
    got = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(pages, PAGE)).collect()}
    assert {i for i in got if got[i] == "block"} == {i for i, r in enumerate(rows) if r[2]}
    looked_up = {i for i, (u, _, _) in enumerate(rows) if any(w in u for w in U.SEED_BLOCK)}
    assert len([i for i in got if (got[i] == "block") != (i in looked_up)]) == 7  # of 41 urls; a list of seeds finds 4 of the 11 bad ones


def brute_verdicts(pages):
    """The same model in plain Python: segmentation from one lexicon, then rounds of learning."""
    words_of = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    title = lambda h: (re.search(r"<title[^>]*>([^<]*)", h or "", re.I | re.S) or ["", ""])[1]
    lexicon = Counter({w: U.KNOWN_WEIGHT for w in (*U.SEED_BLOCK, *U.COMMON)})
    for _, _, h in pages:
        lexicon.update(w for w in words_of(title(h)) if 2 <= len(w) <= U.LONGEST_WORD)
    total = sum(lexicon.values())
    groups = {}
    for _, u, h in pages:
        host, path = brute_parts(u)
        g = groups.setdefault((host, re.sub("[0-9]+", "0", path)), [0, 0])
        g[0] += 1
        g[1] += bool(set(words_of(title(h))) & set(U.SEED_BLOCK))

    def split(value):
        out = []
        for name in re.findall(r"[^\W\d_]+|[0-9]+", value.lower()):
            if name[0].isdigit():
                name = "#"
            arcs = [(i, name[i:j], lexicon[name[i:j]]) for i in range(len(name)) for j in range(i + 2, min(len(name), i + U.LONGEST_WORD) + 1) if name[i:j] in lexicon]
            out += U.segment(name, arcs, total, len(lexicon))
        return out

    values = {(side, k[side]): split(k[side]) for k in groups for side in (0, 1)}
    positive = {k: any(w in U.SEED_BLOCK for side in (0, 1) for w in values[side, k[side]]) or 2 * t > n for k, (n, t) in groups.items()}
    p = {k: float(v) for k, v in positive.items()}
    prior = math.log(U.BLOCK_PRIOR / (1 - U.BLOCK_PRIOR))
    for _ in range(U.ROUNDS):
        b, a = Counter(), Counter()
        for (side, v), own in values.items():
            near = [k for k in groups if k[side] == v]
            share = sum(p[k] * groups[k][0] for k in near) / sum(groups[k][0] for k in near)
            for w in own:
                b[w] += share
                a[w] += 1 - share
        nb, na = sum(b.values()), sum(a.values())
        odds = {}
        for w in b:
            pooled = U.BORROWED * (a[w] + b[w]) / (na + nb)
            odds[w] = math.log((b[w] + pooled) / (nb + U.BORROWED)) - math.log((a[w] + pooled) / (na + U.BORROWED))
        total_odds = {k: prior + sum(odds[w] for side in (0, 1) for w in values[side, k[side]]) for k in groups}
        p = {k: float(positive[k] or t > 0) for k, t in total_odds.items()}
    return total_odds


def test_log_odds_equal_brute_force(spark, data):
    made = [(i, u, None if t is None else f"<TITLE>{t}</TITLE>") for i, (u, t, _) in enumerate(invented())] + [(98, None, None), (99, "nourl", "")]
    table = [tuple(r) for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").collect()]
    for pages in (made, table):
        want = brute_verdicts(pages)
        urls = {i: u for i, u, _ in pages}
        for r in U.judge(spark.createDataFrame(pages, PAGE)).collect():
            host, path = brute_parts(urls[r.page_id])
            odds = want[host, re.sub("[0-9]+", "0", path)]
            assert abs(r.block_log_odds - odds) < 1e-6 and r.verdict == (brute_rule(host, path)[1] or ("block" if odds > 0 else "allow"))


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, _host string, _told int, side string, value string, _word string, rule string"
    extra = ("h", 1, "s", "v", "w", "r")
    long = "http://" + "casino" * 3000 + ".example.org/" + "a1/" * 5000
    rows = [(None, "http://a.org/x", "<title>x</title>", *extra), (1, None, None, *extra), (1, None, None, *extra), (2, long, "<title>" + "word " * 20_000, *extra)]
    df = spark.createDataFrame(rows, schema)
    got = U.judge(df).collect()
    assert sorted(str(r.page_id) for r in got) == ["1", "1", "2", "None"] and {r.page_id: r.verdict for r in got}[2] == "block"
    assert U.judge(df.limit(0)).count() == 0


def test_query(spark, data):
    got = U.op3_url_filter(spark, data)
    assert got.count() == spark.read.parquet(f"{data}/pages.parquet").count()
    for r in got.collect():
        assert (r.rule, r.verdict if r.rule else None) == brute_rule(r.host, r.path)
    assert U.judge(spark.createDataFrame([], PAGE)).count() == 0
    assert got.where(F.col("verdict").isNull()).count() == 0


def test_cost_of_a_name_grows_with_its_length_alone(spark):
    lexicon = spark.createDataFrame([("casino", 5), ("royal", 3), ("no", 2)], "_word string, _count long")
    name = "casinoroyal" * 18_182
    began = time.perf_counter()
    got = {r._name: r._words for r in U.segmented(spark.createDataFrame([(name,), ("royalcasino",), ("x",), ("",)], "_name string"), lexicon).collect()}
    assert time.perf_counter() - began < 60
    assert got[name] == ["casino", "royal"] * 18_182 and got["royalcasino"] == ["royal", "casino"] and got["x"] == ["x"] and got[""] == []
