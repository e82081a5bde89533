"""Phrases whose words stand together more often than chance has it, for each language.

All 1- to n-grams become DataFrame rows of language, phrase and count, are aggregated by hash, joined
with the counts of their parts, scored in Decimal, thinned by an anti-join with their one-word
extensions, and ranked by a window.

The rows are made level by level: a phrase as frequent as asked has parts as frequent, so an n-gram is
emitted only if a filter of fixed size may hold both of its (n-1)-grams. The filter errs on the side of
emitting, so no count is lost, and most n-grams, which occur once or twice, are never shuffled. A task
adds up the n-grams of a batch before they leave it, so a line that repeats is one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, whole_text

#: Bits of the filter of frequent phrases, which every executor gets (32 MB), and tests of each phrase in it.
FILTER_BITS, PROBES = 1 << 28, 2
#: Bytes of text that a task cuts into n-grams at once.
BATCH_BYTES = 1 << 21
#: Parts in which a language's phrases are ranked before all of its best ones meet.
SALTS = 64

#: What ends a piece, and what stands between the words of a piece.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(ENDS)] = 2
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def words_of(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of the texts in order, lower-cased, and the number of the piece each stands in."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = _KIND[raw]
    inside = kind == 0
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    data = _LOW[raw[inside]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words.dictionary_encode(), piece


def mixed(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of all but its last word and of that word."""
    x = (before * np.uint64(0x9E3779B97F4A7C15) + word) ^ (before >> np.uint64(29))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def seed_of(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """The bits of phrases in a filter of ``size`` bits."""
    step = (hashes >> np.uint64(33)) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) % np.uint64(size)).astype(np.int64) for i in range(PROBES)]


def held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for at in places(hashes, 64 * len(bits)):
        out &= (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
    return out


def grams(texts: list[bytes], lang: str, n: int, bits: np.ndarray | None) -> tuple[pa.Array, np.ndarray]:
    """The distinct n-grams of the texts that may be frequent, space-joined, and how often each stands there."""
    words, piece = words_of(texts)
    codes = words.indices.to_numpy().astype(np.int64)
    distinct = words.dictionary
    if n == 1:
        return distinct, np.bincount(codes, minlength=len(distinct))
    m = max(0, len(codes) - n + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))[codes]
    part = np.full(len(codes), seed_of(lang), np.uint64)
    for i in range(n - 1):  # of the (n-1)-grams that start at each word
        part = mixed(part[: len(codes) - i], hashes[i:])
    good = held(bits, part)
    at = np.flatnonzero((piece[n - 1 :][:m] == piece[:m]) & good[:m] & good[1 : m + 1])
    key, first = codes[at], at
    for i in range(1, n):  # numbers for the distinct phrases so far, then those with one more word
        _, first, key = np.unique(key * len(distinct) + codes[at + i], return_index=True, return_inverse=True)
    count = np.bincount(key, minlength=len(first)) if len(at) else np.zeros(0, np.int64)
    own = at[first]
    out = distinct.take(pa.array(codes[own]))
    for i in range(1, n):
        out = pc.binary_join_element_wise(out, distinct.take(pa.array(codes[own + i])), pa.scalar(b" ", pa.large_binary()))
    return out, count


def stretches(texts: Iterable[bytes], most: int) -> Iterator[list[bytes]]:
    """The texts in lots of about ``most`` bytes; a longer one is cut where a piece ends."""
    lot, size = [], 0
    for t in texts:
        at = 0
        while len(t) - at > most:
            ends = (t.find(bytes([e]), at + most, at + 2 * most) for e in ENDS)
            end = min((e for e in ends if e >= 0), default=-1)
            if end < 0:  # a piece beyond all measure goes whole
                break
            yield [t[at:end]]
            at = end + 1
        lot.append(t[at:] if at else t)
        size += len(lot[-1])
        if size >= most:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def lots(batches, most: int) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of each language in lots of about ``most`` bytes. What waits for its lot to fill is at most
    four lots, however many languages there are: beyond that the largest goes as it is."""
    waiting: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for start in range(0, len(batch), 256):
            part = batch.slice(start, 256)
            for lang, text in zip(part.column(0).to_pylist(), pc.cast(part.column(1), pa.binary()).to_pylist(), strict=True):
                waiting.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 64
            while size and (max(size.values()) >= most or sum(size.values()) >= 4 * most):
                lang = max(size, key=size.__getitem__)
                del size[lang]
                for lot in stretches(waiting.pop(lang), most):
                    yield lang, lot
    for lang, texts in waiting.items():
        for lot in stretches(texts, most):
            yield lang, lot


def exploded(docs: DataFrame, n: int, bits=None) -> DataFrame:
    """lang, phrase and f of the n-grams of each lot of texts; for n = 1 also the number of all words,
    under a null phrase."""

    def explode(batches):
        for lang, lot in lots(batches, BATCH_BYTES):
            phrases, counts = grams(lot, lang, n, bits.value if bits else None)
            phrases = pc.cast(pc.cast(phrases, pa.large_string()), pa.string())
            if n == 1:
                phrases, counts = pa.concat_arrays([phrases, pa.nulls(1, pa.string())]), np.append(counts, counts.sum())
            for i in range(0, len(phrases), 1 << 15):
                own = phrases[i : i + (1 << 15)]
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(own)), own, pa.array(counts[i : i + (1 << 15)].astype(np.int64))], names=["lang", "phrase", "f"])

    return docs.mapInArrow(explode, "lang string, phrase string, f long")


def filter_of(frequent: DataFrame, size: int = FILTER_BITS):
    """The filter that holds the phrases of ``frequent`` (lang, phrase), sent to all executors."""

    def mark(batches):
        for batch in batches:
            hashes = np.zeros(len(batch), np.uint64)
            for i, (lang, phrase) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                h = np.array([seed_of(lang)], np.uint64)
                for w in phrase.encode().split(b" "):
                    h = mixed(h, np.array([xxhash.xxh64_intdigest(w)], np.uint64))
                hashes[i] = h[0]
            at = np.concatenate(places(hashes, size))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).view(np.int64))], names=["at", "bits"])

    marked = frequent.select("lang", "phrase").mapInArrow(mark, "at long, bits long")
    table = marked.groupBy("at").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()  # size / 64 rows at most
    bits = np.zeros(size // 64, np.uint64)
    bits[table["at"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(bits)


def frequencies(docs: DataFrame, max_words: int, min_count: int, filter_bits: int = FILTER_BITS) -> list[DataFrame]:
    """For 1 to ``max_words`` words, the phrases that occur ``min_count`` times or more in their language
    (lang, phrase, f); the first also has the number of all words of each, under a null phrase."""
    out, bits = [], None
    for n in range(1, max_words + 1):
        counts = exploded(docs, n, bits).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        out.append(cut_lineage(counts.where((F.col("f") >= min_count) | F.col("phrase").isNull())))
        if n < max_words:
            bits = filter_of(out[-1].where("phrase IS NOT NULL"), filter_bits)
    return out


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    min_count: int = 10,
    cover_pct: int = 50,
    most: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The ``most`` best phrases of 2 to ``max_words`` words of each language: lang, rank (from 1), phrase,
    a (its occurrences), l, r (those of the two parts of its weakest cut), n (words of the language), score.

    Texts are lower-cased (A-Z) and split into pieces at ``. , ; : ! ?`` and line ends, pieces into words at
    blanks and tabs; phrases lie within pieces, overlapping ones all count. The score of a cut is
    floor(1000000 * a * a / (l * r)), exact for counts up to 10**15; the least of a phrase's cuts counts,
    ties to the shorter first part. Phrases of at least ``min_count`` occurrences are candidates; one that
    lies in a candidate longer by one word with ``cover_pct`` percent of its occurrences is dropped (a
    still longer one implies such a one, as counts only fall). Ties in rank go to the more frequent, then
    to the smaller phrase by bytes.

    A null text is empty, a null language is ``und``. Repeated rows count each time, other columns are
    ignored, and tables without words give no rows. A language may hold all rows: nothing is grouped by
    it alone but the best ``most`` of each of ``SALTS`` parts.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), whole_text(text_col).alias("text"))
    levels = frequencies(rows, max_words, min_count, filter_bits)
    counts = levels[0].where("phrase IS NOT NULL")
    totals = levels[0].where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    candidates = levels[1]
    for level in levels[2:]:
        candidates = candidates.unionByName(level)
    for level in levels[1:-1]:
        counts = counts.unionByName(level)

    words = F.split("phrase", " ")
    join = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    cuts = candidates.withColumnRenamed("f", "a").withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", join(1, F.col("k")).alias("_left"), join(F.col("k") + 1, F.size(words)).alias("_right"))
    part = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    cuts = cuts.join(part("_left", "l"), ["lang", "_left"]).join(part("_right", "r"), ["lang", "_right"])
    wide = lambda c: f"CAST({c} AS DECIMAL(15, 0))"
    score = F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({wide('a')} * {wide('a')})) DIV ({wide('l')} * {wide('r')})")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))

    longer = candidates.where(F.size(words) > 2).select("lang", "f", F.explode(F.array(join(1, F.size(words) - 1), join(2, F.size(words)))).alias("_part"))
    longer = longer.groupBy("lang", "_part").agg(F.max("f").alias("f")).withColumnRenamed("lang", "_lang")
    inside = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")) & (100 * F.col("f") >= cover_pct * F.col("a"))
    kept = scored.join(longer, inside, "left_anti").select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", (F.xxhash64("phrase") % SALTS)).orderBy(*best)
    kept = kept.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= most)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir):
    from .common import table

    return collocations(table(spark, sf_dir, "documents"), max_words=3, min_count=10, cover_pct=50, most=2000)


OP12_SQL = rf"""
WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, range(1, 4) AS r(k)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, j, array_to_string(string_split(c.phrase, ' ')[1:j], ' ') AS lhs,
         array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ') AS rhs
  FROM f AS c, range(1, 3) AS r(j) WHERE c.k >= 2 AND j < c.k AND c.f >= 10
), scored AS (
  SELECT c.*, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts AS c JOIN f AS x ON x.lang = c.lang AND x.phrase = c.lhs JOIN f AS y ON y.lang = c.lang AND y.phrase = c.rhs
), weakest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS i FROM scored
), kept AS (
  SELECT * FROM weakest AS s WHERE i = 1 AND NOT EXISTS (
    SELECT 1 FROM f AS x WHERE x.k = 3 AND s.k = 2 AND x.lang = s.lang AND 100 * x.f >= 50 * s.a AND x.f >= 10
      AND s.phrase IN (array_to_string(string_split(x.phrase, ' ')[1:2], ' '), array_to_string(string_split(x.phrase, ' ')[2:3], ' ')))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""
