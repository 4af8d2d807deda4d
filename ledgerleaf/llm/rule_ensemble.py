r"""Quality: a sparse ensemble of rules over text statistics.

1. Statistics of whole texts are Spark expressions (``statistics``).
2. Boosted trees are grown on the statistics of labelled texts. Every path from
   a root to a node becomes a rule: a conjunction of bounds on statistics.
3. A logistic model over the rules is fitted with an L1 penalty (accelerated
   proximal gradient), which leaves few rules. The penalty is the strongest
   whose loss on a fold of the labelled rows is within ``SLACK`` of the best.
4. The rules that are left are compiled into one Spark column (``score``):
   scoring needs no Python, no shuffle and no model on the executors.

The model is fitted on a bounded sample of labelled rows, at most
``MAX_LABELLED`` of either class, chosen by a hash of the identifier; only their
statistics reach the driver. Rows whose crc32(identifier as text) mod 3 is 1 are
never used. Each class weighs in the fit as all its labelled rows do, so the
sample's balance moves no score. Language, source, identifier and labels never
enter a score.

Defined cases: a null text counts as empty; empty texts have the same statistics
(one line, else 0) and so one score. Labels other than 0 and 1 (null too) and null identifiers train
nothing; an identifier that several documents share counts once for each of its
labels, with the least statistics; with no usable labels of both classes every
score is 0.5. A null identifier is not held out. Repeated rows score alike.
Columns may have any name.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm.registry import query, table
from ledgerleaf.llm.trees import Boosted

MAX_LABELLED = 5000
FOLDS, HELD_OUT, CHECKED = 3, 1, 2
ROUNDS, DEPTH = 40, 3
#: Penalties tried, as shares of the least one that leaves no rule.
PENALTIES = np.geomspace(0.3, 0.0005, 14)
SLACK = 1.02
STEPS = 400

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


def _per(count: Column, of: Column) -> Column:
    """A share; 0 of nothing."""
    return count.cast("double") / F.greatest(of, F.lit(1)).cast("double")


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, all of them numbers without null."""
    text = F.coalesce(text, F.lit(""))
    chars = F.char_length(text)
    words = F.regexp_extract_all(text, F.lit(_WORD), 0)
    n_words = F.size(words)
    blanks = F.regexp_count(text, F.lit(_BLANK))
    lines = F.split(text, "\n", -1)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    without = lambda letters: chars - F.char_length(F.translate(text, letters, ""))
    return {
        "chars": chars.cast("double"),
        "words": n_words.cast("double"),
        "word_length": _per(chars - blanks, n_words),
        "distinct_words": _per(F.size(F.array_distinct(words)), n_words),
        "lines": F.size(lines).cast("double"),
        "distinct_lines": _per(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_length": _per(chars, F.size(lines)),
        "capitals": _per(without("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars),
        "digits": _per(without("0123456789"), chars),
        "stops": _per(without(".?!"), n_words),
        "commas": _per(without(",;:"), n_words),
        "signs": _per(without("#$%&*+/<=>@\\^_`{|}~"), chars),
        "calls": _per(without("!?"), chars),
        "brackets": _per(without("()[]{}\"'"), chars),
        "short_words": _per(count(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,3}(?![^\x20\x09-\x0D])"), n_words),
        "links": _per(count(r"https?:|www\.|@"), n_words),
        "item_lines": _per(count(r"(?m)^[\x20\x09]*[-*•>#]"), F.size(lines)),
    }


@dataclass(frozen=True)
class Rule:
    """Holds where every statistic in ``bounds`` is above its low and at most its high."""

    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for j, low, high in self.bounds:
            out &= (x[:, j] > low) & (x[:, j] <= high)
        return out

    def column(self, named: list[Column]) -> Column:
        out = F.lit(True)
        for j, low, high in self.bounds:
            if low > -np.inf:
                out = out & (named[j] > F.lit(float(low)))
            if high < np.inf:
                out = out & (named[j] <= F.lit(float(high)))
        return out

    def says(self, names: list[str]) -> str:
        parts = []
        for j, low, high in self.bounds:
            parts += [f"{names[j]} > {low:.6g}"] if low > -np.inf else []
            parts += [f"{names[j]} <= {high:.6g}"] if high < np.inf else []
        return " and ".join(parts)


def tree_rules(trees: list) -> list[Rule]:
    """The rules of all paths to nodes below a root, each once, in order of appearance."""
    found: dict[Rule, None] = {}
    for tree in trees:
        paths: dict[int, dict[int, tuple[float, float]]] = {0: {}}
        for node in range(len(tree.feature)):
            path = paths.pop(node, None)
            if path is None:
                continue
            if path:
                found[Rule(tuple((j, *path[j]) for j in sorted(path)))] = None
            j = int(tree.feature[node])
            if j < 0:
                continue
            low, high = path.get(j, (-np.inf, np.inf))
            limit = float(tree.limit[node])
            paths[2 * node + 1] = path | {j: (low, min(high, limit))}
            paths[2 * node + 2] = path | {j: (max(low, limit), high)}
    return list(found)


def lasso_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, start: np.ndarray | None = None) -> np.ndarray:
    """Weights of the columns and, last, the free term, which is not penalised.

    Least ``sum(weight * loss) + penalty * sum(|w|)`` for weights summing to 1.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    v = np.random.default_rng(0).random(x.shape[1])
    for _ in range(30):  # the largest curvature, by power iteration
        v = x.T @ (weight * (x @ v))
        v /= np.linalg.norm(v)
    step = 1 / (0.25 * float(v @ (x.T @ (weight * (x @ v)))) * 1.01 + 1e-12)
    now = np.zeros(x.shape[1]) if start is None else start.copy()
    ahead, pace = now.copy(), 1.0
    for _ in range(STEPS):
        slope = x.T @ (weight * (sigmoid(x @ ahead) - y))
        moved = ahead - step * slope
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - step * penalty, 0)
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead = moved + (pace - 1) / faster * (moved - now)
        change = np.abs(moved - now).max()
        now, pace = moved, faster
        if change < 1e-7:
            break
    return now


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def log_loss(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum())


@dataclass
class RuleEnsemble:
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    free: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, checked: np.ndarray) -> RuleEnsemble:
        """``checked`` marks the rows that choose the penalty; all rows then fit the weights."""
        inside = ~checked if 0 < y[~checked].sum() < (~checked).sum() else np.ones(len(y), bool)
        rules = tree_rules(Boosted.fit(x[inside], y[inside], rounds=ROUNDS, depth=DEPTH).trees)
        if not rules:
            share = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
            return cls(free=float(np.log(share / (1 - share))))
        hold = np.stack([rule.holds(x) for rule in rules], axis=1).astype(float)
        part = weight * inside / (weight * inside).sum()
        mean = (part * y).sum()
        most = float(np.abs(hold.T @ (part * (mean - y))).max())
        judge = checked if checked.any() else inside
        tries, start = [], None
        for share in PENALTIES:
            start = lasso_logistic(hold, y, part, share * most, start)
            p = sigmoid(hold[judge] @ start[:-1] + start[-1])
            tries.append((log_loss(p, y[judge], weight[judge]), share))
        least = min(loss for loss, _ in tries)
        share = next(share for loss, share in tries if loss <= least * SLACK)
        done = lasso_logistic(hold, y, weight / weight.sum(), share * most)
        kept = [j for j in range(len(rules)) if done[j]]
        return cls([rules[j] for j in kept], [float(done[j]) for j in kept], float(done[-1]))

    def scores(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), self.free)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            odds += weight * rule.holds(x)
        return 1 / (1 + np.exp(-odds))

    def column(self, named: list[Column]) -> Column:
        """The score as one expression over the statistics' columns."""
        odds = F.lit(self.free)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            odds = odds + F.when(rule.column(named), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def labelled_statistics(
    docs: DataFrame, labels: DataFrame, label: str, text: str, doc_id: str, most: int
) -> tuple[list[tuple], dict[int, int]]:
    """(identifier, label, statistics...) of the sample, and how many labelled
    identifiers each class has in the table."""
    usable = labels.select(labels[f"`{doc_id}`"].alias("id"), labels[f"`{label}`"].cast("int").alias("label"))
    usable = usable.filter(F.col("label").isin(0, 1) & (fold_of(F.col("id")) != HELD_OUT)).distinct()
    totals = {r.label: r.n for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = []
    for value in (0, 1):
        mine = usable.filter(F.col("label") == value)
        if totals.get(value, 0) > 2 * most:
            # By a hash range first, so that few rows are ordered; the limit bounds them exactly.
            mine = mine.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * 1.5 * most / totals[value]))
        parts.append(mine.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 30)), "id").limit(most))
    # At most 2 * most rows of an identifier and a label.
    chosen = parts[0].unionByName(parts[1]).select(F.col("id").alias("chosen_id"), "label")
    texts = docs.select(docs[f"`{doc_id}`"].alias("id"), docs[f"`{text}`"].alias("content"))
    met = texts.join(F.broadcast(chosen), F.col("id") == F.col("chosen_id"))
    stats = statistics(F.col("content"))
    rows = met.select("id", "label", *[c.alias(f"s_{name}") for name, c in stats.items()])
    one = rows.groupBy("id", "label").agg(F.min(F.struct(*[f"s_{name}" for name in stats])).alias("s"))
    return sorted((r.id, r.label, *r.s) for r in one.collect()), totals


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id", most: int = MAX_LABELLED
) -> RuleEnsemble:
    """A model of the labels; without labels of both classes one that says 0.5."""
    rows, totals = labelled_statistics(docs, labels, label, text, doc_id, most)
    y = np.array([r[1] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return RuleEnsemble()
    x = np.array([r[2:] for r in rows], float)
    of_class = {1: totals[1] / y.sum(), 0: totals[0] / (len(y) - y.sum())}
    weight = np.array([of_class[int(v)] for v in y])
    checked = np.array([zlib.crc32(str(r[0]).encode()) % FOLDS == CHECKED for r in rows])
    return RuleEnsemble.fit(x, y, weight, checked)


def score_texts(docs: DataFrame, model: RuleEnsemble, carried: list[str], text: str = "text", into: str = "score") -> DataFrame:
    """The carried columns with the score of each whole text."""
    row = F.struct(*[docs[f"`{name}`"] for name in carried]).alias("row")
    stats = statistics(docs[f"`{text}`"])
    measured = docs.select(row, *[c.alias(f"s_{name}") for name, c in stats.items()])
    score = model.column([F.col(f"s_{name}") for name in stats])
    return measured.select(*[F.col(f"row.`{name}`") for name in carried], score.alias(into))


@query("op12_rule_ensemble")
def op12_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    held_out = F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
