"""Quality classifier as a sparse rule ensemble.

Statistics of each text are Spark column expressions. Small boosted regression
trees over them are fitted on a bounded sample of labelled rows; every path from
a root to a node becomes a conjunctive rule (an interval per statistic); a
logistic model with a lasso penalty over the rules keeps few of them, with the
lasso's weights. The penalty is the one with the least loss in folds of the
learning rows (trees and weights anew in each), raised if need be until there are
at most a tenth as many rules as rows. The kept rules and weights are compiled
into one Spark column over the statistics, which are computed once a row, so
scoring is a narrow JVM job over whole texts.

Only the statistics of the text are inputs. The sample is the ``max_rows``
labelled rows with the smallest md5 of their id: it bounds what the driver holds,
everything else runs on all rows. Defined results: a null text counts as empty
and is scored; null labels and labels without a document are not learnt from;
repeated labels count repeatedly; with no labels, or one class only, the model
is the smoothed share of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 20_000      # labelled rows a model is fitted on, at most
FOLDS, FOLD_ROWS = 4, 2_000     # the penalty is chosen on this many of them, at most
ROWS_A_RULE = 10
PENALTIES = (0.1, 0.05, 0.02, 0.01, 0.005, 0.002, 0.001, 0.0005)
TREES, DEPTH, RATE = 40, 3, 0.2
TAILS = np.array([0.002, 0.004, 0.007, 0.01, 0.015, 0.02])      # junk stands at the ends of a statistic
LEVELS = np.unique(np.concatenate([np.arange(1, 32) / 32, TAILS, 1 - TAILS]))
BINS = len(LEVELS) + 1


def counts(text: Column) -> dict[str, Column]:
    """What is counted in a text, by name."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    size = F.octet_length(t).cast("double")

    def of(marks: str) -> Column:
        """How often the ASCII characters of ``marks`` stand in the text."""
        out = F.lit(0.0)
        for m in marks:
            out = out + (size - F.octet_length(F.replace(t, F.lit(m), F.lit(""))))
        return out

    def only(kept: str) -> Column:
        return F.char_length(F.regexp_replace(t, f"[^{kept}]+", "")).cast("double")

    # a word that stands again right after itself; possessive, so linear in the text
    again = F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D](?=\1(?![^\x20\x09-\x0D]))"))
    return {"chars": F.greatest(F.char_length(t), F.lit(1)).cast("double"), "words": of(" \n\t") + 1.0,
            "upper": only(r"\p{Lu}"), "digits": only("0-9"), "marks": of("!?"), "symbols": of("#$%&*@^~=_<>{}[]"),
            "bars": of("|"), "stops": of("."), "commas": of(",;:"), "lines": of("\n"), "repeats": again.cast("double")}


def shares(found) -> dict[str, Column]:
    """The statistics from the counts, which ``found`` gives by name."""
    out = {"log_chars": F.log(found("chars")), "word_chars": found("chars") / found("words")}
    for k in ("upper", "digits", "marks", "symbols", "bars", "stops", "commas", "lines", "repeats"):
        out[k] = found(k) / found("words")
    return out


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a text, by name; 0 where there is nothing to count."""
    return shares(counts(text).__getitem__)


@dataclass
class Rule:
    """lo < statistic <= hi for every statistic named; ``weight`` in the model."""
    bounds: dict[str, tuple[float, float]]
    weight: float = 0.0

    def column(self, stats: dict[str, Column]) -> Column:
        parts = []
        for name, (lo, hi) in sorted(self.bounds.items()):
            if np.isfinite(lo):
                parts.append(stats[name] > F.lit(float(lo)))
            if np.isfinite(hi):
                parts.append(stats[name] <= F.lit(float(hi)))
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out


@dataclass
class RuleModel:
    intercept: float = 0.0
    rules: list[Rule] = field(default_factory=list)
    rows: int = 0

    def score(self, text: Column) -> Column:
        """The probability of label 1 of a text. Its counts are one value that a
        lambda takes, so wherever the column is put they are made once."""
        def logistic(s: Column) -> Column:
            stats = shares(lambda k: s[k])
            z = F.lit(float(self.intercept))
            for r in self.rules:
                z = z + F.when(r.column(stats), F.lit(float(r.weight))).otherwise(F.lit(0.0))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

        return F.transform(F.array(F.struct(*[c.alias(k) for k, c in counts(text).items()])), logistic)[0]


def grow(codes: np.ndarray, target: np.ndarray, at: np.ndarray, depth: int, box: dict, out: list) -> list:
    """Split the rows ``at`` by the least squared error; ``out`` gets the boxes
    (statistic -> code interval) of all nodes below the root. Returns leaves."""
    best = (1e-9, None, None)
    total, n = target[at].sum(), len(at)
    if depth and n >= 20:
        for f in range(codes.shape[1]):
            s = np.bincount(codes[at, f], weights=target[at], minlength=BINS)
            c = np.bincount(codes[at, f], minlength=BINS)
            ls, lc = np.cumsum(s)[:-1], np.cumsum(c)[:-1]
            ok = (lc >= 5) & (n - lc >= 5)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, ls ** 2 / lc + (total - ls) ** 2 / (n - lc) - total ** 2 / n, -1.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], f, k)
    if best[1] is None:
        return [(at, total / max(1, n))]
    _, f, k = best
    left = codes[at, f] <= k
    leaves = []
    for side, rows in ((True, at[left]), (False, at[~left])):
        lo, hi = box.get(f, (-1, BINS))
        inner = dict(box)
        inner[f] = (lo, min(hi, k)) if side else (max(lo, k), hi)
        out.append(inner)
        leaves += grow(codes, target, rows, depth - 1, inner, out)
    return leaves


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalties, steps: int = 400) -> list[tuple[float, np.ndarray]]:
    """(intercept, weights) for each penalty, from the largest on, each started at
    the last; accelerated proximal gradient, the intercept is not penalised."""
    n, d = x.shape
    a = np.hstack([np.ones((n, 1), dtype=x.dtype), x])
    v = np.ones(d + 1) / np.sqrt(d + 1)
    for _ in range(20):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / float(np.linalg.norm(a @ v) ** 2) * 0.95
    w = np.zeros(d + 1)
    w[0] = np.log(y.mean() / (1 - y.mean()))
    out = []
    for penalty in penalties:
        z, t = w, 1.0
        for _ in range(steps):
            g = a.T @ (1 / (1 + np.exp(-(a @ z))) - y) / n
            new = z - step * g
            new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
            t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            z = new + (t - 1) / t2 * (new - w)
            moved = np.abs(new - w).max()
            w, t = new, t2
            if moved < 1e-4:
                break
        out.append((float(w[0]), w[1:].copy()))
    return out


def ensemble(x: np.ndarray, y: np.ndarray, names: list[str], seed: int) -> tuple[list[Rule], np.ndarray]:
    """The rules of boosted trees and which rows each covers (rows x rules). Of
    rules that cover the same rows the one with the fewest bounds stays."""
    n = len(y)
    cuts = [np.unique(np.quantile(x[:, f], LEVELS)) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    # a bound stands half way between the values that it parts
    for f, c in enumerate(cuts):
        v = np.unique(x[:, f])
        right = np.clip(np.searchsorted(v, c, side="right"), 1, max(1, len(v) - 1))
        cuts[f] = (v[right - 1] + v[np.minimum(right, len(v) - 1)]) / 2
    rng = np.random.default_rng(seed)
    margin = np.full(n, np.log(y.mean() / (1 - y.mean())))
    boxes: list[dict] = []
    for _ in range(TREES):
        at = np.sort(rng.permutation(n)[:max(50, n // 2)])
        residual = y - 1 / (1 + np.exp(-margin))
        found: list[dict] = []
        grow(codes, residual, at, DEPTH, {}, found)
        # move the margin by the leaves over all rows
        for rows, value in grow(codes, residual, np.arange(n), DEPTH, {}, []):
            margin[rows] += RATE * value * 4
        boxes += found
    best: dict[bytes, tuple] = {}
    for box in boxes:
        hit = np.ones(n, dtype=bool)
        bounds = {}
        for f, (lo, hi) in box.items():
            hit &= (codes[:, f] > lo) & (codes[:, f] <= hi)
            c = cuts[f]
            bounds[names[f]] = (float(c[lo]) if lo >= 0 else -np.inf, float(c[hi]) if hi < len(c) else np.inf)
        ends = int(sum(np.isfinite(v).sum() for v in bounds.values()))
        if 0 < hit.sum() < n and ends:
            key = np.packbits(hit).tobytes()
            if key not in best or ends < best[key][0]:
                best[key] = (ends, bounds, hit)
    rules = [Rule(b) for _, b, _ in best.values()]
    return rules, np.stack([h for _, _, h in best.values()], axis=1) if rules else np.empty((n, 0))


def scales(rules: list[Rule]) -> np.ndarray:
    """What a rule's column counts: the more statistics it names, the dearer its weight."""
    return np.array([1.0 / len(r.bounds) for r in rules])


def covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    hit = np.ones(len(x), dtype=bool)
    for name, (lo, hi) in rule.bounds.items():
        v = x[:, names.index(name)]
        hit &= (v > lo) & (v <= hi)
    return hit


def choose_penalty(x: np.ndarray, y: np.ndarray, names: list[str], seed: int) -> float:
    """The penalty with the least mean loss on the fold left out, for len(y) rows."""
    x, y = x[:FOLD_ROWS], y[:FOLD_ROWS]
    rank = np.empty(len(y), dtype=np.int64)           # each class is dealt to the folds in turn
    for label in (0, 1):
        at = np.flatnonzero(y == label)
        rank[at] = np.arange(len(at))
    loss = np.zeros(len(PENALTIES))
    for fold in range(FOLDS):
        out = rank % FOLDS == fold
        if not out.any() or y[~out].min() == y[~out].max():
            continue
        rules, design = ensemble(x[~out], y[~out], names, seed)
        test = np.stack([covers(r, x[out], names) for r in rules], axis=1) if rules else np.empty((out.sum(), 0))
        for k, (b, w) in enumerate(lasso_logistic(design * scales(rules), y[~out], PENALTIES)):
            z = b + test @ (w * scales(rules))
            loss[k] += np.logaddexp(0, np.where(y[out] > 0, -z, z)).sum()
    return PENALTIES[int(np.argmin(loss))]            # the larger of equal ones


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 17) -> RuleModel:
    """The model of rows of statistics and labels 0 and 1."""
    n = len(y)
    if n == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (n + 2) if n else 0.5
        return RuleModel(float(np.log(share / (1 - share))), [], n)
    penalty = choose_penalty(x, y, names, seed) * np.sqrt(min(n, FOLD_ROWS) / n)
    rules, design = ensemble(x, y, names, seed)
    path = [p for p in PENALTIES if p > penalty] + [penalty]
    while True:
        b, w = lasso_logistic(design * scales(rules), y, path)[-1]
        w = w * scales(rules)
        if (np.abs(w) > 1e-6).sum() <= max(1, n // ROWS_A_RULE) or len(path) == 1:
            break
        path.pop()
    kept = []
    for rule, weight in zip(rules, w):
        if abs(weight) > 1e-6:
            rule.weight = float(weight)
            kept.append(rule)
    return RuleModel(b, kept, n)


def held_out(doc_id: Column) -> Column:
    """True for the rows no label is learnt from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = MAX_ROWS) -> RuleModel:
    """Fit on labelled rows that are not held out, at most ``max_rows``."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "label").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    stats = statistics(F.col("text"))
    rows = (texts.join(F.broadcast(known), "doc_id")            # at most max_rows rows
            .select("doc_id", "label", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("at"),
                    *[c.alias(k) for k, c in stats.items()])
            .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "label", "at").limit(max_rows).collect())
    names = list(stats)
    x = np.array([[r[k] for k in names] for r in rows], dtype=np.float64).reshape(len(rows), len(names))
    y = np.array([r["label"] for r in rows], dtype=np.float64)
    return fit_rules(x, (y >= 0.5).astype(np.float64), names)


def apply(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with score and predicted (columns of these names are replaced)."""
    own = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = docs.select(*[F.col(f"`{c}`") for c in own], model.score(F.col(f"`{text_col}`")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model predicts label 1 for, columns as they are."""
    return docs.where(model.score(F.col(f"`{text_col}`")) >= 0.5)
