"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Shallow boosted trees are grown over ratios of `textscan.MEASURES` of labelled texts; every path from a root becomes a
rule (a conjunction of thresholds); an L1-penalised logistic regression over the rules keeps few of them; and the kept
rules are compiled into one Spark column expression, so that scoring stays inside the JVM once the measures are there.

Training rows are bounded by `max_rows` (a documented parameter): those labelled documents with the smallest hashes of
their ids. Labels, language, source and id are never inputs of a score.

Defined results: null and empty texts are scored from zero measures; labels that are null or contradict each other for a
document are left out; without labels of both kinds the model is the constant share of label 1 (1.0 without any label);
repeated rows get equal scores, an empty table none; extra columns pass through, one named like the score is replaced by it.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from groundplan.llm.frames import fresh
from groundplan.llm.rules import measures

#: Ratios of measures: numerator, denominator (at least 1). The share of distinct words isn't among them: it falls with
#: the length of any text, also a clean one.
FEATURES: tuple[tuple[str, str, str], ...] = (
    ("words", "n_words", ""),
    ("word_length", "word_chars", "n_words"),
    ("symbols", "n_symbols", "n_words"),
    ("dup_lines", "n_dup_lines", "n_lines"),
    ("repeats", "n_repeat_words", "n_words"),
    ("line_words", "n_words", "n_lines"),
    ("upper", "n_upper", "word_chars"),
    ("digits", "n_digits", "word_chars"),
    ("punct", "n_punct", "n_words"),
    ("marks", "n_marks", "n_words"),
    ("running", "n_twice_running", "n_words"),
    ("non_ascii", "n_non_ascii", "word_chars"),
)
NAMES = tuple(n for n, _, _ in FEATURES)


@dataclass(frozen=True)
class Rule:
    """All of its (feature, '<=' or '>', threshold) hold."""

    terms: tuple[tuple[str, str, float], ...]
    weight: float = 0.0


@dataclass(frozen=True)
class Model:
    intercept: float
    rules: tuple[Rule, ...] = field(default=())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Model:
        raw = json.loads(text)
        return Model(raw["intercept"], tuple(Rule(tuple((a, b, c) for a, b, c in r["terms"]), r["weight"]) for r in raw["rules"]))

    def score(self, struct: str) -> Column:
        """The probability of label 1, from a struct of measures."""
        z = F.lit(float(self.intercept))
        for r in self.rules:
            test = F.lit(True)
            for name, op, x in r.terms:
                f = feature(struct, name)
                test = test & (f <= F.lit(x) if op == "<=" else f > F.lit(x))
            z = z + F.when(test, F.lit(float(r.weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def feature(struct: str, name: str) -> Column:
    _, top, bottom = next(f for f in FEATURES if f[0] == name)
    value = F.col(f"`{struct}`.`{top}`").cast("double")
    return value / F.greatest(F.col(f"`{struct}`.`{bottom}`"), F.lit(1)) if bottom else value


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


# Trees -----------------------------------------------------------------------------------------------------------


def _grow(binned: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, cuts: list[np.ndarray], path, paths, least: float = 8.0):
    """Grow one tree by second-order gain; append each node's path and return the rows' leaf values."""
    g, h = grad[rows].sum(), hess[rows].sum()
    leaf = g / (h + 1.0)
    if path:
        paths.append(tuple(path))
    if depth == 0 or h < 2 * least / 10 or len(rows) < 2 * least:
        return [(rows, leaf)]
    best = (1e-6, -1, -1)
    for k in range(binned.shape[1]):
        n_bins = len(cuts[k]) + 1
        if n_bins < 2:
            continue
        gs = np.cumsum(np.bincount(binned[rows, k], grad[rows], n_bins))[:-1]
        hs = np.cumsum(np.bincount(binned[rows, k], hess[rows], n_bins))[:-1]
        ns = np.cumsum(np.bincount(binned[rows, k], minlength=n_bins))[:-1]
        gain = gs**2 / (hs + 1.0) + (g - gs) ** 2 / (h - hs + 1.0) - g**2 / (h + 1.0)
        gain[(ns < least) | (len(rows) - ns < least)] = 0
        b = int(np.argmax(gain))
        if gain[b] > best[0]:
            best = (gain[b], k, b)
    _, k, b = best
    if k < 0:
        return [(rows, leaf)]
    left = binned[rows, k] <= b
    x = float(cuts[k][b])
    return _grow(binned, grad, hess, rows[left], depth - 1, cuts, [*path, (k, "<=", x)], paths, least) + _grow(
        binned, grad, hess, rows[~left], depth - 1, cuts, [*path, (k, ">", x)], paths, least
    )


def _simplify(path) -> tuple[tuple[int, str, float], ...]:
    """One bound for each feature and side."""
    bounds: dict[tuple[int, str], float] = {}
    for k, op, x in path:
        old = bounds.get((k, op))
        bounds[k, op] = x if old is None else (min(old, x) if op == "<=" else max(old, x))
    return tuple(sorted((k, op, x) for (k, op), x in bounds.items()))


def tree_rules(x: np.ndarray, y: np.ndarray, n_trees: int, depth: int, seed: int) -> list[tuple[tuple[int, str, float], ...]]:
    """Distinct simplified paths of boosted trees, in order of growth."""
    rng = np.random.default_rng(seed)
    cuts = []
    for k in range(x.shape[1]):
        v = np.unique(x[:, k])
        if len(v) > 64:
            v = np.unique(np.quantile(x[:, k], np.linspace(0, 1, 65), method="lower"))
        cuts.append((v[:-1] + v[1:]) / 2 if len(v) > 1 else np.empty(0))
    binned = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    z = np.full(len(y), np.log(p / (1 - p)))
    paths: list = []
    for _ in range(n_trees):
        prob = 1 / (1 + np.exp(-z))
        rows = np.sort(rng.choice(len(y), max(1, len(y) // 2), replace=False))
        _grow(binned, y - prob, prob * (1 - prob), rows, depth, cuts, [], new := [])
        paths += new
        # The step is taken on all rows, by the same leaves.
        for path in _leaves(new):
            hit = np.ones(len(y), bool)
            for k, op, c in path:
                hit &= (x[:, k] <= c) if op == "<=" else (x[:, k] > c)
            g, h = (y - prob)[hit].sum(), (prob * (1 - prob))[hit].sum()
            z[hit] += 0.3 * g / (h + 1.0)
    return list(dict.fromkeys(_simplify(p) for p in paths))


def _leaves(paths):
    inner = {p[:i] for p in paths for i in range(1, len(p))}
    return [p for p in paths if p not in inner]


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient."""
    n, k = x.shape
    both = np.hstack([np.ones((n, 1)), x])
    v = np.ones(k + 1) / np.sqrt(k + 1)
    for _ in range(20):
        v = both.T @ (both @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / max(float(v @ (both.T @ (both @ v))), 1e-9)
    w = np.zeros(k + 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[0] = np.log(p / (1 - p))
    at, t = w.copy(), 1.0
    for _ in range(steps):
        grad = both.T @ (1 / (1 + np.exp(-(both @ at))) - y) / n
        new = at - step * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return float(w[0]), w[1:]


def train(x: np.ndarray, y: np.ndarray, n_trees: int = 24, depth: int = 3, penalty: float = 2e-4, max_rules: int = 160, seed: int = 7) -> Model:
    """Fit a Model to features (columns as NAMES) and labels 0 or 1."""
    if len(y) == 0:
        return Model(20.0)
    p = y.mean()
    if p in (0.0, 1.0):
        return Model(20.0 if p else -20.0)
    paths = tree_rules(x, y, n_trees, depth, seed)[:max_rules]
    hits = np.ones((len(y), len(paths)))
    for j, path in enumerate(paths):
        for k, op, c in path:
            hits[:, j] *= (x[:, k] <= c) if op == "<=" else (x[:, k] > c)
    if not paths:
        return Model(float(np.log(p / (1 - p))))
    intercept, weights = lasso_logistic(hits, y, penalty)
    kept = [Rule(tuple((NAMES[k], op, c) for k, op, c in path), float(w)) for path, w in zip(paths, weights, strict=True) if abs(w) > 1e-6]
    return Model(intercept, tuple(kept))


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text", max_rows: int = 12_000, target: str = "quality") -> DataFrame:
    """y and the struct of measures of at most max_rows labelled documents that aren't held out, by the hashes of their ids.

    Of rows with one id, the one whose text has the smallest hash.
    """
    chosen = (
        labels.select(F.col("doc_id"), F.col(target).cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("y2"))
        .filter("y = y2")
        .select("doc_id", "y")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = docs.select("doc_id", F.col(text).cast("string").alias("text"))
    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("y").alias("y"), F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    return measures(one, "text").select("doc_id", "y", "measures")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", max_rows: int = 12_000, **how) -> Model:
    """Train on at most max_rows labelled documents; what reaches the driver is their numbers, not their texts."""
    rows = training_rows(docs, labels, text, max_rows)
    table = rows.select("doc_id", "y", *[feature("measures", n).alias(n) for n in NAMES]).toPandas()
    table = table.sort_values(["doc_id", *NAMES], kind="stable")
    return train(table[list(NAMES)].to_numpy(float), table["y"].to_numpy(float), **how)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """docs with the model's score of each whole text."""
    m = fresh(docs, "quality_measures")
    return measures(docs, text, m).withColumn(into, model.score(m)).drop(m)


def keep(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs scored at least `least`, with the columns of docs."""
    s = fresh(docs, "quality_score")
    return score(docs, model, text, s).filter(F.col(s) >= least).drop(s)


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Score every document with a model fitted to the labels that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
