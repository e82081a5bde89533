"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees are grown on the statistics of labelled documents, every path of a
tree becomes a conjunctive rule, an L1-penalised logistic regression picks and weighs the
rules, and the rules that keep a weight are compiled into one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, whole_text

#: Most labelled rows that a fit takes, the first by hash of their id.
FIT_ROWS = 20_000


def with_statistics(df: DataFrame, text_col: str, prefix: str = "_s_") -> tuple[DataFrame, list[str]]:
    """``df`` with column ``<prefix>values``, an array of the statistics of every whole text, and
    their names."""
    t = F.col(f"{prefix}text")
    words = F.col(f"{prefix}words")
    lines = F.col(f"{prefix}lines")
    chars = F.greatest(F.length(t), F.lit(1)).cast("double")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    made = {
        "log_chars": F.log1p(F.length(t).cast("double")),
        "log_words": F.log1p(F.size(words).cast("double")),
        "mean_word": chars / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)).cast("double"),
        "words_a_line": n_words / F.greatest(F.size(lines), F.lit(1)).cast("double"),
        "upper": F.regexp_count(t, F.lit(r"\p{Lu}")) / chars,
        "symbols": F.regexp_count(t, F.lit(r"[#$%&*|~^<>={}\[\]\\@_]")) / chars,
        "marks": F.regexp_count(t, F.lit(r"[!?]")) / n_words,
        "points": F.regexp_count(t, F.lit(r"[.,;:]")) / n_words,
        "digits": F.regexp_count(t, F.lit(r"[0-9]")) / chars,
    }
    names = [f"{prefix}{k}" for k in made]
    base = (
        df.withColumn(f"{prefix}text", whole_text(text_col))
        .withColumn(f"{prefix}words", F.split(F.trim(f"{prefix}text"), r"[ \t\n\x0B\f\r]+"))
        .withColumn(f"{prefix}lines", F.split(f"{prefix}text", "\n"))
    )
    # exploding an array of one element keeps the optimiser from repeating the statistics wherever they are used
    values = F.array(*[c.cast("double") for c in made.values()])
    out = base.withColumn(f"{prefix}values", F.explode(F.array(values)))
    return out.drop(f"{prefix}text", f"{prefix}words", f"{prefix}lines"), list(made)


def free_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` starts with."""
    prefix = "_s_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = f"_{prefix}"
    return prefix


@dataclass
class RuleModel:
    """score = sigmoid(intercept + sum of the weights of the rules that hold).

    A rule is a tuple of (feature, threshold, above): value > threshold if above, else <=.
    """

    features: list[str]
    intercept: float = 0.0
    rules: list[tuple[tuple[tuple[int, float, bool], ...], float]] = field(default_factory=list)

    def column(self, values: Column) -> Column:
        """The score as one expression over the array of statistics: each rule a conjunction of
        comparisons, added where it holds."""

        def holds(conditions) -> Column:
            tests = [F.get(values, F.lit(f)) > F.lit(float(t)) if up else F.get(values, F.lit(f)) <= F.lit(float(t)) for f, t, up in conditions]
            return reduce(lambda a, b: a & b, tests)

        terms = [F.lit(float(self.intercept)), *[F.when(holds(c), F.lit(float(w))).otherwise(F.lit(0.0)) for c, w in self.rules]]
        while len(terms) > 1:  # pairwise, so that the expression stays shallow
            terms = [sum(terms[i + 1 : i + 2], terms[i]) for i in range(0, len(terms), 2)]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-terms[0]))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for conditions, weight in self.rules:
            total += weight * rule_holds(x, conditions)
        return 1 / (1 + np.exp(-total))


def rule_holds(x: np.ndarray, conditions) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for f, threshold, above in conditions:
        out &= x[:, f] > threshold if above else x[:, f] <= threshold
    return out


def _grow(x, residual, at, depth, path, paths, values, feats, cuts, least):
    """One regression tree; appends every node's path to ``paths``, sets ``values`` at the leaves."""
    best = None
    if depth and len(at) >= 2 * least:
        r, total, n = residual[at], residual[at].sum(), len(at)
        for f in feats:
            v = x[at, f]
            for c in cuts[f]:
                left = v <= c
                k = int(left.sum())
                if least <= k <= n - least:
                    s = r[left].sum()
                    gain = s * s / k + (total - s) ** 2 / (n - k) - total * total / n
                    if best is None or gain > best[0] + 1e-12:
                        best = (gain, f, float(c), left)
    if best is None or best[0] <= 1e-9:
        values[at] = residual[at].mean()
        return
    _, f, c, left = best
    for above, own in ((False, at[left]), (True, at[~left])):
        step = (*path, (f, c, above))
        paths.append(step)
        _grow(x, residual, own, depth - 1, step, paths, values, feats, cuts, least)


def fit_rules(
    x: np.ndarray,
    y: np.ndarray,
    features: list[str],
    trees: int = 24,
    depth: int = 2,
    rate: float = 0.3,
    penalty: float = 0.002,
    steps: int = 400,
    seed: int = 7,
) -> RuleModel:
    """Trees are grown on half of the rows (drawn anew for each) and a part of the features;
    weights come from proximal gradient steps. With one class or no rows: the class share."""
    if len(y) == 0:
        return RuleModel(features)
    share = float(np.clip(y.mean(), 0.01, 0.99))
    if y.min() == y.max():
        return RuleModel(features, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    score = np.full(len(y), np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(c, np.linspace(0.02, 0.98, 25))) for c in x.T]
    paths: list = []
    for _ in range(trees):
        residual = y - 1 / (1 + np.exp(-score))
        own = np.sort(rng.permutation(len(y))[: max(2, len(y) // 2)])
        feats = np.sort(rng.permutation(x.shape[1])[: max(1, (2 * x.shape[1]) // 3)])
        start = len(paths)
        values = np.zeros(len(y))
        _grow(x, residual, own, depth, (), paths, values, feats, cuts, max(5, len(own) // 100))
        leaves = [p for p in paths[start:] if not any(q[: len(p)] == p and len(q) > len(p) for q in paths[start:])]
        for p in leaves:
            holds = rule_holds(x, p)
            inside = holds[own]
            if inside.any():
                score[holds] += rate * 4 * values[own][inside].mean()
    rules = list(dict.fromkeys(tuple(sorted(p)) for p in paths))
    held = np.stack([rule_holds(x, r) for r in rules], axis=1).astype(np.float64)
    centre = held.mean(0)
    spread = np.maximum(held.std(0), 1e-3)
    z = (held - centre) / spread
    w, b = np.zeros(z.shape[1]), float(np.log(share / (1 - share)))
    size = 4.0 / max(1e-9, np.linalg.norm(z, 2) ** 2 / len(y))
    look, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(z @ look + b)))
        new = look - size * (z.T @ (p - y)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - size * penalty, 0)
        b -= float((p - y).mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    weights = w / spread
    return RuleModel(
        features,
        float(b - (weights[kept] * centre[kept]).sum()),
        [(rules[i], float(weights[i])) for i in kept],
    )


def labelled_sample(labels: DataFrame, label: str, id_col: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """_id and _y of at most ``rows`` labelled ids outside the held-out fold, the first by hash. An id
    with several labels has the largest."""
    own = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col), folds) != held_out))
    return (
        own.groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label).cast("double")).alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 5,
    held_out: int = 0,
    rows: int = FIT_ROWS,
) -> RuleModel:
    """A model from at most ``rows`` labelled documents outside the held-out fold. The sample of
    ids is bounded by ``rows``, so it is broadcast to the documents. An id that stands for several
    texts counts once, with the smallest of their statistics; null texts count as empty."""
    sample = labelled_sample(labels, label, id_col, folds, held_out, rows)
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(sample), "_id")
    stats, names = with_statistics(own, "_t")
    got = stats.groupBy("_id", "_y").agg(F.min("_s_values").alias("_s_values")).toPandas().sort_values("_id")
    x = np.array(got["_s_values"].tolist(), dtype=np.float64).reshape(-1, len(names))
    return fit_rules(x, got["_y"].to_numpy(np.float64), names)


def score(docs: DataFrame, model: RuleModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with column ``out``, the probability of good quality.

    Null and empty texts are scored by their statistics like any other; repeated rows stay;
    an empty table stays empty; a column named ``out`` is replaced, others stay as they are.
    """
    prefix = free_prefix(docs)
    stats, _ = with_statistics(docs, text_col, prefix)
    return stats.withColumn(out, model.column(F.col(f"{prefix}values"))).drop(f"{prefix}values")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents that the classifier does not reject, all columns as they were."""
    name = f"{free_prefix(docs)}score"
    scored = score(docs, fit(docs, labels, text_col=text_col), text_col, name)
    return scored.where(F.col(name) >= threshold).select(*docs.columns)


def op6_quality_rules(spark, sf_dir):
    from .common import table

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
