"""Quality classifier: a sparse rule ensemble over text statistics, compiled to column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash63, sample_cut, text_or_empty

#: Labelled rows the rules are fitted on, about; a uniform sample by a hash of the id beyond that.
MOST_LABELLED = 20_000
TREES = 24
DEPTH = 3
CUTS = 32
LEAST_LEAF = 20
LASSO = 1e-3
STEPS = 400


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text, all as doubles and defined for the empty text."""
    n_chars = F.length(text)
    chars = F.greatest(n_chars, F.lit(1))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1))
    lines = F.split(text, "\n")
    rest = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    share = lambda pattern: (n_chars - rest(pattern)) / chars
    return {
        "log_chars": F.log1p(n_chars.cast("double")),
        "word_length": n_chars / n_words,
        "upper": share(r"\p{Lu}+"),
        "digits": share(r"[0-9]+"),
        "symbols": share(r"[^\p{L}\p{N}\s.,;:'\"?!-]+"),
        "marks": share(r"[.,;:'\"?!-]+"),
        "letters": share(r"\p{L}+"),
        "again": F.regexp_count(text, F.lit(r"(?<!\S)(\S+)(?=\s+\1(?!\S))")) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "line_words": n_words / F.size(lines),
    }


Condition = tuple[str, bool, float]  # statistic, whether above, cut


@dataclass
class RuleEnsemble:
    """score = 1 / (1 + exp(-(bias + sum of the weights of the rules that hold)))."""

    bias: float
    rules: list[tuple[float, tuple[Condition, ...]]]

    def column(self, stats: dict[str, Column]) -> Column:
        """The score as one expression over columns of statistics."""
        total = F.lit(float(self.bias))
        for weight, rule in self.rules:
            holds = reduce(lambda a, b: a & b, [stats[s] > cut if above else stats[s] <= cut for s, above, cut in rule])
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 0) -> list[tuple[Condition, ...]]:
    """Every path of a forest of small trees, each grown on a bootstrap and half of the statistics."""
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 2)[1:-1])) for j in range(x.shape[1])]
    rules: dict[frozenset, tuple[Condition, ...]] = {}

    def grow(rows: np.ndarray, columns: np.ndarray, path: tuple[Condition, ...]) -> None:
        if path:
            rules.setdefault(frozenset(path), path)
        ones = y[rows].sum()
        if len(path) == DEPTH or len(rows) < 2 * LEAST_LEAF or ones in (0, len(rows)):
            return
        best = None
        for j in columns:
            values = x[rows, j]
            order = np.argsort(values, kind="stable")
            below = np.concatenate([[0.0], np.cumsum(y[rows][order])])
            n = np.searchsorted(values[order], cuts[j], side="right")
            ok = (n >= LEAST_LEAF) & (len(rows) - n >= LEAST_LEAF)
            if not ok.any():
                continue
            n, at = n[ok], cuts[j][ok]
            a, b = below[n], ones - below[n]
            gini = a * (1 - a / n) + b * (1 - b / (len(rows) - n))
            k = int(gini.argmin())
            if best is None or gini[k] < best[0]:
                best = (gini[k], j, float(at[k]))
        if best is None or best[0] >= ones * (1 - ones / len(rows)) - 1e-9:
            return
        _, j, cut = best
        left = x[rows, j] <= cut
        grow(rows[left], columns, (*path, (names[j], False, cut)))
        grow(rows[~left], columns, (*path, (names[j], True, cut)))

    for _ in range(TREES):
        rows = random.integers(0, len(y), len(y))
        columns = np.sort(random.choice(x.shape[1], max(2, (x.shape[1] + 1) // 2), replace=False))
        grow(rows, columns, ())
    return sorted(rules.values())


def holds(rule: tuple[Condition, ...], x: np.ndarray, names: list[str]) -> np.ndarray:
    return np.logical_and.reduce([x[:, names.index(s)] > cut if above else x[:, names.index(s)] <= cut for s, above, cut in rule])


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Weights of binary columns by accelerated proximal gradient steps; the bias is not penalised."""
    a = np.hstack([np.ones((len(y), 1)), z])
    step = 4 * len(y) / max(1e-9, np.linalg.norm(a, 2) ** 2)
    w = v = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
        new = v - step * (a.T @ (p - y)) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, v, t = new, new + (t - 1) / t_new * (new - w), t_new
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], penalty: float = LASSO) -> RuleEnsemble:
    """Rules from trees, weights by lasso logistic regression; one class or no rows gives a constant."""
    ones = (y.sum() + 0.5) / (len(y) + 1)
    prior = RuleEnsemble(float(np.log(ones / (1 - ones))), [])
    if len(y) < 2 * LEAST_LEAF or y.min() == y.max():
        return prior
    rules = tree_rules(x, y, names)
    if not rules:
        return prior
    z = np.stack([holds(r, x, names) for r in rules], axis=1)
    _, first = np.unique(z, axis=1, return_index=True)  # rules that hold for the same rows count once
    first.sort()
    bias, weights = lasso_logistic(z[:, first].astype(float), y, penalty)
    return RuleEnsemble(bias, [(float(w), rules[i]) for w, i in zip(weights, first) if abs(w) > 1e-6])


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST_LABELLED) -> RuleEnsemble:
    """Fit on labelled rows that are not held out: about ``most`` at random (by a hash), all if fewer.

    Only the statistics of these rows come to the driver. Null labels and ids teach nothing;
    a document with several labels counts with each.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("double").alias("_y"))
    known = known.where(F.col("_id").isNotNull() & F.col("_y").isin(0.0, 1.0) & ~held_out(F.col("_id")))
    n = known.count()
    if n > most:
        known = known.where(hash63("_id") <= F.lit(sample_cut(most, n)))
    known = known.limit(2 * most)  # ids that repeat without end would share a hash
    stats = statistics(F.col("_text"))
    named = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(F.col(f"`{text_col}`")).alias("_text"))
    # a bounded sample of ids and labels, so it may be broadcast
    rows = named.join(F.broadcast(known), "_id").limit(4 * most).select("_y", *[c.cast("double").alias(s) for s, c in stats.items()]).collect()
    got = np.array([tuple(r) for r in rows], dtype=float).reshape(len(rows), len(stats) + 1)
    got = got[np.lexsort(got.T[::-1])]  # the same model whatever the order of the rows
    return fit_rules(got[:, 1:], got[:, 0], list(stats))


def score_quality(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) to every row, by the compiled rules alone.

    Only whole texts are looked at. A null text counts as empty and is scored like it; rows
    that repeat get equal scores; a column named like the result is replaced.
    """
    rest = [f"`{c}`" for c in docs.columns if c != score_col]
    stats = {s: F.col(f"_s_{s}") for s in statistics(F.lit(""))}
    # the row goes along as one column, so no name of its columns meets one used here
    measured = docs.select(F.struct(*rest).alias("_row"), text_or_empty(F.col(f"`{text_col}`")).alias("_text"))
    used = {s for _, rule in model.rules for s, _, _ in rule}
    measured = measured.select("_row", *[c.cast("double").alias(f"_s_{s}") for s, c in statistics(F.col("_text")).items() if s in used])
    return measured.select("_row.*", model.column(stats).alias(score_col))
