"""URL filter: list rules first, else naive Bayes over segmented host and path words.

Concatenated names in hosts and paths are split into words by the most probable (Viterbi)
segmentation under a unigram model whose counts come from the pages' titles. A multinomial
naive Bayes scores the words. Nothing is labelled, so it learns from positive and unlabelled
urls: those that hold a seed word, or whose pages' titles mostly hold one, are blocked; all
others start as allowed, and those that the model blocks join the blocked ones for the next
round, so that words that keep company with blocked ones become evidence too. The list rules are policy for
parts of a site and say nothing about words, so it doesn't learn from them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

#: (rule, verdict); a rule is a host, a slash and the start of a path.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Words that stand for blocked matter wherever they occur; they label, the model decides.
SEED_BLOCK = ("ads", "adult", "bets", "betting", "casino", "escort", "gambling", "pills", "poker", "porn", "sex", "spam", "torrent", "viagra", "warez", "xxx")
#: Words of names that titles may lack, for the segmentation alone.
COMMON = (
    "about", "academy", "archive", "article", "bet", "blog", "bonus", "book", "books", "cash", "cheap", "city", "click", "college", "culture", "daily", "deal", "docs",
    "download", "education", "farm", "forum", "free", "garden", "guide", "health", "help", "history", "home", "journal", "learn", "library", "loan", "magazine", "music",
    "museum", "nature", "news", "pharmacy", "pill", "post", "press", "prize", "recipe", "replica", "report", "research", "review", "school", "science", "slots", "story", "support",
    "track", "travel", "university", "weather", "wiki", "win",
)
#: Substrings of names that a task hands on at once.
PIECES_AT_ONCE = 100_000
LONGEST_WORD = 20
#: Count of a known word in the unigram model; counts that the classes borrow from all urls' words; rounds of learning.
KNOWN_WEIGHT, BORROWED, ROUNDS = 50, 5.0, 4
BLOCK_PRIOR = 0.2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for r, v in sorted(rules, key=lambda x: (len(x[0]), x[0])):  # later cases win, so the longest comes last
        domain, _, start = r.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def segment(name: str, arcs: Sequence[tuple[int, str, int]], total: int, kinds: int) -> list[str]:
    """The most probable split of ``name``. ``arcs`` are (start, word, count) for its substrings
    that the unigram model knows, ``total`` the sum of all counts, ``kinds`` the number of
    words. Unknown stretches cost as unseen words, dearer with each character. Ties go to the
    longer last word."""
    n = len(name)
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, w, c in arcs:
        ends.setdefault(start + len(w), []).append((start, math.log((c + 1) / (total + kinds + 1))))
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    unknown = math.log(1 / (total + kinds + 1))
    for e in range(1, n + 1):
        options = [(s, p) for s, p in sorted(ends.get(e, []))]
        options += [(s, unknown - 2.3 * (e - s)) for s in range(max(0, e - LONGEST_WORD), e)]
        for s, p in options:
            if best[s] + p > best[e] + 1e-12:
                best[e], back[e] = best[s] + p, s
    out, e = [], n
    while e:
        out.append(name[back[e] : e])
        e = back[e]
    return out[::-1]


def names_in(col: Column) -> Column:
    """The runs of letters in ``col``, repeats included, and '#' for each run of digits."""
    found = F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+|[0-9]+)"), 1)
    return F.transform(found, lambda x: F.when(x.rlike("^[0-9]"), "#").otherwise(x))


def words_in(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1)


def unigrams(titles: DataFrame) -> DataFrame:
    """_word and _count over all words of column ``_title``, and over the known words. Single
    letters are no words: they would be in most names, and unknown stretches cover them."""
    words = titles.select(F.explode(words_in(F.col("_title"))).alias("_word"))
    counted = words.where(F.length("_word").between(2, LONGEST_WORD)).groupBy("_word").agg(F.count(F.lit(1)).alias("_count"))
    known = titles.sparkSession.createDataFrame([(w, KNOWN_WEIGHT) for w in (*SEED_BLOCK, *COMMON)], "_word string, _count long")
    return counted.unionByName(known).groupBy("_word").agg(F.sum("_count").alias("_count"))


def segmented(names: DataFrame, lexicon: DataFrame) -> DataFrame:
    """_name and _words for the distinct values of column ``_name``. Every name's substrings of at
    most ``LONGEST_WORD`` letters are joined to the lexicon; no lexicon is collected."""
    total, kinds = lexicon.agg(F.coalesce(F.sum("_count"), F.lit(0)), F.count(F.lit(1))).first()
    names = names.select("_name", F.sha2("_name", 256).alias("_key")).distinct()

    def pieces(frames):
        rows: list = []
        for frame in frames:
            for key, name in zip(frame["_key"], frame["_name"], strict=True):
                n = len(name)
                for start in range(n - 1):
                    rows += [(key, start, name[start:end]) for end in range(start + 2, min(n, start + LONGEST_WORD) + 1)]
                    if len(rows) >= PIECES_AT_ONCE:
                        yield pd.DataFrame(rows, columns=["_key", "_start", "_word"])
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["_key", "_start", "_word"])

    # a piece carries its name's hash, not the name: what a name costs grows with its length alone
    found = names.mapInPandas(pieces, "_key string, _start int, _word string").join(lexicon, "_word")
    arcs = found.groupBy("_key").agg(F.collect_list(F.struct("_start", "_word", "_count")).alias("_arcs"))

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, arcs: pd.Series) -> pd.Series:
        none: list = []
        return pd.Series(
            [
                segment(n, none if a is None else [(x["_start"], x["_word"], x["_count"]) for x in a], total, kinds)
                for n, a in zip(name, arcs, strict=True)
            ],
            dtype=object,
        )

    return names.join(arcs, "_key", "left").select("_name", split("_name", "_arcs").alias("_words"))


def word_odds(words: DataFrame, shares: DataFrame) -> DataFrame:
    """_word and _odds (log of its probability in the blocked class over that in the allowed one),
    from (side, value, _word) and the share (0 to 1) of each (side, value) that is blocked.

    Each value counts once for each of its words, however many pages have it. A class borrows
    ``BORROWED`` counts, spread as the words of both classes are, so a word that one class
    lacks counts against that class in proportion to how much of the class was seen.
    """
    shared = words.join(shares, ["side", "value"])
    counts = shared.groupBy("_word").agg(F.sum("_share").alias("_b"), F.sum(1 - F.col("_share")).alias("_a"))
    b, a = counts.agg(F.coalesce(F.sum("_b"), F.lit(0.0)), F.coalesce(F.sum("_a"), F.lit(0.0))).first()
    pooled = F.lit(BORROWED / max(a + b, 1e-9)) * (F.col("_a") + F.col("_b"))
    return counts.select("_word", (F.log((F.col("_b") + pooled) / (b + BORROWED)) - F.log((F.col("_a") + pooled) / (a + BORROWED))).alias("_odds"))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    block_prior: float = BLOCK_PRIOR,
) -> DataFrame:
    """Every row's id, host, path, rule, verdict, and ``block_log_odds`` of the method.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is judged
    by the prior alone. Verdict: the rule's, else ``block`` where the log odds are above 0,
    else ``allow``. Null html gives no title. Repeated rows and null ids stay, an empty table
    gives no rows, other columns are ignored, whatever their names. Words are counted over all
    pages; hosts and paths (digits levelled) are scored once for each distinct value, however
    long, and joined back, so a host of a third of all rows is scored once.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    title = F.regexp_extract(F.col(html_col), r"(?is)<title[^>]*>([^<]*)", 1)
    told = F.coalesce(F.exists(words_in(title), lambda w: w.isin(*SEED_BLOCK)), F.lit(False))
    base = pages.select(F.col(id_col).alias("_id"), host.alias("_host"), path.alias("_path"), told.alias("_told"))
    rule, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    base = base.select("_id", "_host", "_path", "_told", rule.alias("_rule"), verdict.alias("_verdict"), F.regexp_replace("_path", "[0-9]+", "0").alias("_shape"))

    urls = cut_lineage(base.groupBy("_host", "_shape").agg(F.count(F.lit(1)).alias("_n"), F.count_if("_told").alias("_told")))
    sides = F.array(
        F.struct(F.lit("host").alias("side"), F.col("_host").alias("value")),
        F.struct(F.lit("path").alias("side"), F.col("_shape").alias("value")),
    )
    values = urls.select(F.explode(sides).alias("_s")).select("_s.side", "_s.value").distinct()
    named = values.withColumn("_name", F.explode(names_in(F.col("value"))))
    split = segmented(named, cut_lineage(unigrams(pages.select(title.alias("_title")))))
    words = cut_lineage(named.join(split, "_name").select("side", "value", F.explode("_words").alias("_word")))

    def of_side(df: DataFrame, side: str, value: str, column: str, name: str) -> DataFrame:
        return df.where(F.col("side") == side).select(F.col("value").alias(value), F.col(column).alias(name))

    def scored(df: DataFrame, odds: DataFrame) -> DataFrame:
        """``df`` with the log odds of its host and shape."""
        sums = words.join(odds, "_word").groupBy("side", "value").agg(F.sum("_odds").alias("_odds"))
        both = df.join(of_side(sums, "host", "_host", "_odds", "_host_odds"), "_host", "left").join(of_side(sums, "path", "_shape", "_odds", "_path_odds"), "_shape", "left")
        prior = F.lit(math.log(block_prior / (1 - block_prior)))
        return both.withColumn("_total", F.round(prior + F.coalesce("_host_odds", F.lit(0.0)) + F.coalesce("_path_odds", F.lit(0.0)), 9)).drop("_host_odds", "_path_odds")

    seeded = words.where(F.col("_word").isin(*SEED_BLOCK)).select("side", "value").distinct().withColumn("_yes", F.lit(True))
    known = urls.join(of_side(seeded, "host", "_host", "_yes", "_bad_host"), "_host", "left").join(of_side(seeded, "path", "_shape", "_yes", "_bad_shape"), "_shape", "left")
    positive = F.col("_bad_host").isNotNull() | F.col("_bad_shape").isNotNull() | (F.col("_told") * 2 > F.col("_n"))
    known = cut_lineage(known.select("_host", "_shape", "_n", positive.alias("_positive")))
    weighed = known.withColumn("_p", F.col("_positive").cast("double"))
    for i in range(ROUNDS):
        shares = weighed.select(F.explode(sides).alias("_s"), "_n", "_p").groupBy("_s.side", "_s.value").agg((F.sum(F.col("_p") * F.col("_n")) / F.sum("_n")).alias("_share"))
        odds = cut_lineage(word_odds(words, shares))
        if i < ROUNDS - 1:
            again = scored(known, odds)
            weighed = again.withColumn("_p", (F.col("_positive") | (F.col("_total") > 0)).cast("double"))
    return scored(base.drop("_told"), odds).select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.when(F.col("_total") > 0, "block").otherwise("allow")).alias("verdict"),
        F.col("_total").alias("block_log_odds"),
    )


def op3_url_filter(spark, sf_dir):
    from .common import table

    return judge(table(spark, sf_dir, "pages"))
