"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, all text outside the held-out fold is the unlabelled set.
Linear numpy classifiers over hashed words and word beginnings minimise the class-prior-corrected risk
prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), and their scores are averaged. The unlabelled part of the
risk and of its gradient is a sum over Spark partitions; the driver holds weights and sums alone.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, fold, remove_folder, shared_folder

#: Most labelled positive rows that a fit takes, the first by hash of their id.
POSITIVE_ROWS = 3_000
#: Classifiers, each without one of so many parts of the rows; most steps of a descent, and what a weight costs.
CLASSIFIERS, PARTS, STEPS, DECAY = 3, 5, 16, 2e-5
BUCKETS = 1 << 20
ROWS_AT_ONCE = 256
#: Words that a worker remembers; others are looked up again.
KNOWN_WORDS = 100_000
FEATURES = 600
#: Lengths of the word beginnings that are features beside the whole word.
STARTS = (4, 5, 6, 7, 8)
#: Least log-likelihood ratio (G squared) between the two sets for a feature to be used.
LEAST_GAIN = 20.0
_WORD = re.compile(r"[^\W\d_]+")


def _bucket(mark: str) -> int:
    return zlib.crc32(mark.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def word_buckets(word: str) -> list[int]:
    """The bucket of the word and those of its beginnings."""
    return [_bucket(word), *(_bucket(f"^{word[:k]}") for k in STARTS if len(word) > k)]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Model:
    """weights: by bucket, one column for each classifier; bias: one for each.

    A classifier's value is its bias plus the weights of all buckets of a text's distinct words,
    divided by the square root of their number.
    """

    weights: dict[int, np.ndarray]
    bias: np.ndarray

    def of_word(self, word: str) -> np.ndarray | None:
        found = [self.weights[b] for b in word_buckets(word) if b in self.weights]
        return np.sum(found, axis=0) if found else None

    def score(self, text: str | None, known: dict | None = None) -> float:
        known = {} if known is None else known
        words, found = words_of(text), []
        for w in words:
            v = known.get(w, known)
            if v is known:
                v = self.of_word(w)
                if len(known) < KNOWN_WORDS:
                    known[w] = v
            if v is not None:
                found.append(v)
        total = self.bias + np.sum(found, axis=0) / len(words) ** 0.5 if found else self.bias
        return float((1 / (1 + np.exp(-np.clip(total, -30, 30)))).mean())


def constant_model(share: float) -> Model:
    return Model({}, np.array([np.log((share + 1e-3) / (1 - share + 1e-3))]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def descent(x: np.ndarray, steps: int, memory: int = 8):
    """A minimum by limited-memory quasi-Newton steps. A generator: gives points, takes the value and
    gradient there, returns the last point that was accepted."""
    value, slope = yield x
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        d = slope.copy()
        back = []
        for s, y, r in reversed(moves):
            back.append(r * (s @ d))
            d -= back[-1] * y
        d *= 1 / (moves[-1][2] * (moves[-1][1] @ moves[-1][1])) if moves else 1 / max(1.0, float(np.abs(slope).sum()))
        for (s, y, r), a in zip(moves, reversed(back), strict=True):
            d += s * (a - r * (y @ d))
        along, size = -(slope @ d), 1.0
        if along > -1e-12:
            break
        while True:
            new = x - size * d
            new_value, new_slope = yield new
            if new_value <= value + 1e-4 * size * along or size < 1e-4:
                break
            size /= 2
        if new_value >= value:
            break
        s, y = new - x, new_slope - slope
        if s @ y > 1e-14:
            moves = [*moves[1 - memory :], (s, y, 1 / (s @ y))]
        done = value - new_value < 1e-5 * max(1.0, abs(value))
        x, value, slope = new, new_value, new_slope
        if done:
            break
    return x


def risk(x: np.ndarray, positives: np.ndarray, prior: float, unlabelled: tuple[float, np.ndarray]) -> tuple[float, np.ndarray]:
    """The non-negative risk at ``x`` (weights, then the bias) and its gradient, from rows of positives (with a last
    column of ones) and the unlabelled rows' mean loss as negatives and its gradient. Where the corrected negative part is below
    zero it counts zero."""
    g = positives @ x
    loss_u, slope_u = unlabelled
    as_positive, as_negative = np.logaddexp(0, -g).mean(), np.logaddexp(0, g).mean()
    p = _sigmoid(g)
    slope = prior * (positives.T @ (p - 1)) / len(g)
    value = prior * as_positive
    if loss_u - prior * as_negative > 0:
        value += loss_u - prior * as_negative
        slope = slope + slope_u - prior * (positives.T @ p) / len(g)
    w = np.append(x[:-1], 0)
    return value + DECAY / 2 * (w @ w), slope + DECAY * w


def classifiers(positives: list[np.ndarray], prior: float, means, width: int, steps: int = STEPS) -> list[np.ndarray]:
    """The minima of several classifiers' risks. ``means`` gives the unlabelled rows' mean loss and gradient for
    points by classifier; all that are still open are asked together, so a step is one pass."""
    start = np.append(np.zeros(width), math.log(prior / (1 - prior)))
    runs = {m: descent(start.copy(), steps) for m in range(len(positives))}
    points = {m: next(run) for m, run in runs.items()}
    out: dict[int, np.ndarray] = {}
    while points:
        found = means(points)
        for m, x in list(points.items()):
            try:
                points[m] = runs[m].send(risk(x, positives[m], prior, found[m]))
            except StopIteration as e:
                out[m] = e.value
                del points[m]
    return [out[m] for m in range(len(positives))]


def model_of(found: list[np.ndarray], buckets: list[int]) -> Model:
    weights = np.stack([x[:-1] for x in found], axis=1)
    return Model({int(c): weights[i] for i, c in enumerate(buckets)}, np.array([x[-1] for x in found]))


def fit_matrix(p: np.ndarray, u: np.ndarray, buckets: list[int], prior: float, steps: int = STEPS) -> Model:
    """Classifiers from positive rows ``p`` and unlabelled rows ``u`` in memory, whose columns stand for
    ``buckets``; each goes without one part of both."""
    if not len(p) or not len(u):
        return constant_model(prior if len(p) or len(u) else 0.0)
    wide = [np.hstack([x, np.ones((len(x), 1))]).astype(np.float64) for x in (p, u)]
    own_p, own_u = ([_without(x, np.arange(len(x)) % PARTS, m) for m in range(CLASSIFIERS)] for x in wide)

    def means(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        return {m: (float(np.logaddexp(0, own_u[m] @ x).mean()), own_u[m].T @ _sigmoid(own_u[m] @ x) / len(own_u[m])) for m, x in points.items()}

    return model_of(classifiers(own_p, prior, means, p.shape[1], steps), buckets)


def _without(rows: np.ndarray, parts: np.ndarray, m: int) -> np.ndarray:
    """The rows outside part ``m``; all, if that leaves none."""
    kept = rows[parts != m]
    return kept if len(kept) else rows


def _gain(a: int, c: int, n_p: int, n_u: int) -> float:
    """G squared of a feature that ``a`` of ``n_p`` positives and ``c`` of ``n_u`` unlabelled have."""
    share = (a + c) / (n_p + n_u)
    part = lambda o, e: o * math.log(o / e) if o > 0 else 0.0
    return 2 * (part(a, n_p * share) + part(c, n_u * share) + part(n_p - a, n_p * (1 - share)) + part(n_u - c, n_u * (1 - share)))


def _marks(held: np.ndarray):
    """A function from a text to the numbers of its features, repeats included, and the number of its
    distinct words. ``held`` has a feature's number for each bucket, else -1."""
    known: dict[str, tuple[int, ...]] = {}

    def of(text: str) -> tuple[list[int], int]:
        words = words_of(text)
        out: list[int] = []
        for w in words:
            own = known.get(w)
            if own is None:
                own = tuple([k for b in word_buckets(w) if (k := int(held[b])) >= 0])  # one object stands for all empty ones
                if len(known) < KNOWN_WORDS:
                    known[w] = own
            out += own
        return out, len(words)

    return of


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 4,
    held_out: int = 2,
    features: int = FEATURES,
) -> Model:
    """Fits on at most ``POSITIVE_ROWS`` confirmed documents and on all documents as the unlabelled ones,
    none of the held-out fold; the prior is the share of positives among the labelled ids there.

    The positive sample is bounded, so its ids are broadcast. Features are the buckets that tell it from
    all documents outside the held-out fold best, by counts of documents: Spark counts, over all those
    documents, the buckets that at least 3 positives have. Those that a document has are written once, so that
    texts are cut into words once for the fit; each step of the descent is a pass over them that returns sums. Null labels and ids take no
    part; null texts count as empty; of several texts of a positive id the first counts; an id with
    several labels is positive if one of them is; a row that repeats counts each time; other columns are ignored.
    """
    own = F.coalesce(fold(F.col(id_col), folds), F.lit(held_out)) != held_out
    named = labels.where(own & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(label) == 1).cast("int")).alias("_y"))
    n, hits = named.agg(F.count(F.lit(1)), F.coalesce(F.sum("_y"), F.lit(0))).first()
    if not hits:
        return constant_model(0.0)
    prior = float(np.clip(hits / n, 0.005, 0.9))
    positive = named.where("_y = 1").select("_id").orderBy(F.xxhash64("_id"), "_id").limit(POSITIVE_ROWS)
    texts = docs.where(own).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    # a positive id that stands for several texts counts with the first of them
    once = cut_lineage(texts.join(F.broadcast(positive), "_id").groupBy("_id").agg(F.min("_t").alias("_t")))

    def buckets(frames):
        for f in frames:
            yield pd.DataFrame({"_f": [sorted({b for w in words_of(t) for b in word_buckets(w)}) for t in f["_t"]]})

    frequent = once.select("_t").mapInPandas(buckets, "_f array<int>").select(F.explode("_f").alias("_b"))
    frequent = {r["_b"]: r["_a"] for r in frequent.groupBy("_b").agg(F.count(F.lit(1)).alias("_a")).where("_a >= 3").collect()}
    numbers = np.full(BUCKETS, -1, dtype=np.int32)
    numbers[sorted(frequent)] = np.arange(len(frequent))

    part = F.pmod(F.xxhash64("_id"), F.lit(PARTS)).cast("int").alias("_part")

    def marked(frames):
        """Of each row its part, the number of its distinct words, and its features among the frequent ones, repeats included."""
        of = _marks(numbers)
        for f in sliced(frames):
            rows = [of(t) for t in f["_t"]]
            yield pd.DataFrame({"_part": f["_part"], "_n": [n for _, n in rows], "_m": [np.array(m, np.int32) for m, _ in rows]})

    def marks_of(rows: DataFrame) -> DataFrame:
        return rows.select("_t", part).mapInPandas(marked, "_part int, _n int, _m array<int>")

    folder = f"{shared_folder(docs.sparkSession)}/toxicity-{uuid.uuid4().hex}"
    try:
        marks_of(texts).write.parquet(f"{folder}/marks")  # the texts are read for the last time
        marks = docs.sparkSession.read.parquet(f"{folder}/marks")
        own = cut_lineage(marks_of(once))  # so no task has two Python workers
        return _fitted(folder, once, own, marks, frequent, prior, features)
    finally:
        remove_folder(docs.sparkSession, folder)


def sliced(frames) -> Iterator[pd.DataFrame]:
    """The frames in parts of ``ROWS_AT_ONCE`` rows: a row has thousands of features."""
    for f in frames:
        for i in range(0, len(f), ROWS_AT_ONCE):
            yield f.iloc[i : i + ROWS_AT_ONCE]


def _in_rows(frame: pd.DataFrame, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and count of the features of a frame's rows (_m), renumbered by ``number``; those below 0 are left out."""
    row = np.repeat(np.arange(len(frame)), [len(m) for m in frame["_m"]])
    k = number[np.concatenate(list(frame["_m"])).astype(np.int64)] if len(row) else np.zeros(0, np.int64)
    width = max(1, len(number))
    pair, count = np.unique((row * width + k)[k >= 0], return_counts=True)
    return pair // width, pair % width, count


def _fitted(folder: str, once: DataFrame, own: DataFrame, marks: DataFrame, frequent: dict[int, int], prior: float, features: int) -> Model:
    """The model from the positives' and all rows' marks, which stand for the buckets of ``frequent`` in their order."""

    def everywhere(frames):
        same, counts, n = np.arange(len(frequent)), np.zeros(len(frequent), dtype=np.int64), 0
        for f in sliced(frames):
            counts += np.bincount(_in_rows(f, same)[1], minlength=len(frequent))
            n += len(f)
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"_k": np.append(at, -1), "_c": np.append(counts[at], n)})

    counted = marks.mapInPandas(everywhere, "_k int, _c long").groupBy("_k").agg(F.sum("_c").alias("_c"))
    in_all = {r["_k"]: r["_c"] for r in counted.collect()}
    n_p, n_u = once.count(), max(1, in_all.get(-1, 0))
    gains = sorted((-_gain(frequent[b], in_all.get(k, 0), n_p, n_u), b) for k, b in enumerate(sorted(frequent)))
    chosen = [b for g, b in gains if -g >= LEAST_GAIN][:features]
    place = np.full(len(frequent), -1, dtype=np.int64)
    at = {b: k for k, b in enumerate(sorted(frequent))}
    place[[at[b] for b in chosen]] = np.arange(len(chosen))

    if not n_p or not chosen:
        return constant_model(prior)

    def sparse(frames):
        """Features of each row; rows without any leave as their number, by part."""
        bare = np.zeros(PARTS)
        for f in sliced(frames):
            row, k, count = _in_rows(f, place)
            v = (count / np.maximum(1, f["_n"].to_numpy()[row]) ** 0.5).astype(np.float32)
            sizes = np.bincount(row, minlength=len(f))
            bare += np.bincount(f["_part"].to_numpy()[sizes == 0], minlength=PARTS)
            cuts = np.cumsum(sizes[sizes > 0])[:-1]
            full = np.flatnonzero(sizes)
            if len(full):  # lists of no rows have no type
                yield pd.DataFrame({"_part": f["_part"].to_numpy()[full], "_w": 1.0, "_k": np.split(k.astype(np.int32), cuts), "_v": np.split(v, cuts)})
        none = [np.zeros(0, np.int32)] * PARTS
        yield pd.DataFrame({"_part": range(PARTS), "_w": bare, "_k": none, "_v": none})

    schema = "_part int, _w double, _k array<int>, _v array<float>"
    p_rows, p_parts = [], []
    for r in own.mapInPandas(sparse, schema).where("size(_k) > 0").collect():  # POSITIVE_ROWS at most
        row = np.zeros(len(chosen) + 1)
        row[r["_k"]], row[-1] = r["_v"], 1.0
        p_rows.append(row)
        p_parts.append(r["_part"])
    bare = np.zeros((n_p - len(p_rows), len(chosen) + 1))
    bare[:, -1] = 1.0
    p = np.vstack([np.array(p_rows).reshape(len(p_rows), len(chosen) + 1), bare])
    parts = np.append(np.array(p_parts, int), np.arange(len(bare)) % PARTS)

    marks.mapInPandas(sparse, schema).where("_w > 0").write.parquet(f"{folder}/rows")
    rows = marks.sparkSession.read.parquet(f"{folder}/rows")
    means = lambda points: unlabelled_means(rows, points)
    return model_of(classifiers([_without(p, parts, m) for m in range(CLASSIFIERS)], prior, means, len(chosen)), chosen)


def unlabelled_means(rows: DataFrame, points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
    """For each classifier's point (weights, then the bias) the mean loss of sparse ``rows`` (_part, _w, _k, _v) as negatives,
    and its gradient; the part of the classifier's number is left out, unless there is no other."""
    width = len(next(iter(points.values())))

    def sums(frames):
        # by part, for each classifier: gradient, loss, weight
        total = {m: np.zeros((PARTS, width + 2)) for m in points}
        for f in frames:
            if not len(f):
                continue
            sizes = np.array([len(k) for k in f["_k"]])
            k, v = np.concatenate(list(f["_k"])).astype(np.int64), np.concatenate(list(f["_v"])).astype(np.float64)
            row = np.repeat(np.arange(len(f)), sizes)
            own, w = f["_part"].to_numpy(), f["_w"].to_numpy()
            for m, x in points.items():
                g = x[-1] + np.bincount(row, v * x[k], minlength=len(f))
                s, loss = w * _sigmoid(g), w * np.logaddexp(0, g)
                at = own[row] * (width + 2) + k
                total[m] += np.bincount(at, v * s[row], minlength=PARTS * (width + 2)).reshape(PARTS, -1)
                for i, what in ((width - 1, s), (width, loss), (width + 1, w)):
                    total[m][:, i] += np.bincount(own, what, minlength=PARTS)
        for m, t in total.items():
            part, i = np.nonzero(t)
            yield pd.DataFrame({"_m": m, "_part": part, "_i": i, "_s": t[part, i]})

    found = rows.mapInPandas(sums, "_m int, _part int, _i int, _s double").groupBy("_m", "_part", "_i").agg(F.sum("_s").alias("_s")).collect()
    by = {m: np.zeros((PARTS, width + 2)) for m in points}
    for r in found:  # classifiers x parts x features at most
        by[r["_m"]][r["_part"], r["_i"]] = r["_s"]
    out = {}
    for m, t in by.items():
        kept = np.delete(t, m, axis=0).sum(axis=0)
        kept = kept if kept[-1] else t.sum(axis=0)
        out[m] = (kept[width] / kept[-1], kept[:width] / kept[-1])
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and score (0 to 1) of every row; null and empty texts get the score of no words.

    Repeated rows and null ids stay, an empty table gives no rows, other columns are ignored.
    """

    def run(frames):
        known: dict = {}
        for f in frames:
            yield pd.DataFrame({"_id": f["_id"], "score": [model.score(t, known) for t in f["_t"]]})

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    return own.mapInPandas(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def op4_toxicity(spark, sf_dir):
    from .common import table

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
