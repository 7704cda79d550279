"""Quality rules as a learned decision list (operator 5).

Statistics of every whole text are computed in vectorised batches. From the
statistics of labelled documents a decision list is learned by sequential
covering: each rule, a conjunction of thresholds, is grown on two thirds of what
earlier rules left, pruned on the last third, and kept while it is precise there.
The ordered rules become one Spark CASE expression over the statistics.

Defined results: null and empty texts have statistics of 0 and fail the base
rule; without labels of both kinds no rule is learned and the base rule decides;
null statistics can't occur; labels that are null or contradict each other for
one document are left out; repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Labelled documents the list is learned from, at most: those with the least hash of their id.
TRAINING_ROWS = 8_000
MAX_RULES = 12
MAX_CONDITIONS = 4
#: Least precision of a rule where it is pruned and over all training rows; least rows it covers.
PRECISION = 0.95
LEAST_COVERED = 5
THRESHOLDS = 64

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def statistics(text: str | None) -> tuple[float, ...]:
    """The base counts of a text, then lines, distinct words, capitals, digits, pipes and bytes."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return (0, 0, _count(raw, _SYMBOLS), 0, 0, 0, 0, 0, 0, 0, len(raw))
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    # code points: bytes that don't continue a character
    chars = sum(map(len, words)) - _count(raw, _CONTINUES)
    seen: set[bytes] = set()
    dup = lines = 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeated = 0
    if n >= 3:
        # a window's number: exact, as each step maps pairs to their rank
        pairs = seq[:-1] * len(ids) + seq[1:]
        _, pairs = np.unique(pairs, return_inverse=True)
        windows = pairs[:-1].astype(np.int64) * len(ids) + seq[2:]
        _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
        again = counts[where] > 1
        hit = np.zeros(n, bool)
        for k in range(3):
            hit[k : n - 2 + k] |= again
        repeated = int(hit.sum())
    return (n, chars, _count(raw, _SYMBOLS), dup, repeated, lines, len(ids), _count(raw, _UPPER), _count(raw, _DIGIT), raw.count(b"|"), len(raw))


_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True


def _count(raw: bytes, kind: np.ndarray) -> int:
    return int(np.count_nonzero(kind[np.frombuffer(raw, np.uint8)]))


COUNTS = (*BASE, "n_lines", "n_distinct", "n_upper", "n_digits", "n_pipes", "n_bytes")


def with_statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` and the counts of each whole ``text``."""

    def step(rows: dict[str, list]) -> dict[str, list]:
        counts = list(zip(*map(statistics, rows[text]), strict=True)) or [[] for _ in COUNTS]
        return {c: rows[c] for c in keep} | dict(zip(COUNTS, counts, strict=True))

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"{c} bigint" for c in COUNTS])
    return map_batches(docs, list(dict.fromkeys([*keep, text])), schema, step)


def features() -> dict[str, Column]:
    """The rules' ratios as Spark expressions of the counts."""
    rate = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "symbol_rate": rate("n_symbols", "n_words"), "dup_line_rate": rate("n_dup_lines", "n_lines"),
        "repeat_rate": rate("n_repeat_words", "n_words"), "mean_word": rate("word_chars", "n_words"),
        "upper_rate": rate("n_upper", "n_bytes"), "digit_rate": rate("n_digits", "n_bytes"),
        "pipe_rate": rate("n_pipes", "n_words"), "distinct_rate": rate("n_distinct", "n_words"),
        "line_words": rate("n_words", "n_lines"), "n_words": F.col("n_words").cast("double"),
    }


#: Base rule: too short, or mostly repeated.
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    value: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.value if self.above else x[self.feature] <= self.value

    def column(self) -> Column:
        f = features()[self.feature]
        return f > F.lit(self.value) if self.above else f <= F.lit(self.value)


Rule = tuple[Condition, ...]


def _holds(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def learn(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = MAX_RULES) -> list[Rule]:
    """Ordered rules for rejection. ``x``: a column of each feature; ``bad``: what to reject."""
    n, rules = len(bad), []
    if not bad.any() or bad.all():
        return []
    fold = np.arange(n) % 3 == 2
    left = np.ones(n, bool)
    while len(rules) < max_rules and (left & bad).any():
        rule = _grow(x, bad, left & ~fold)
        if not rule:
            break
        rule = _prune(rule, x, bad, left & fold)
        covered = _holds(rule, x, n)
        now = covered & left
        if now.sum() < LEAST_COVERED or bad[now].mean() < PRECISION or bad[covered].mean() < PRECISION:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, among: np.ndarray) -> Rule:
    """Add the condition of the greatest information gain until a rule is pure."""
    rule: list[Condition] = []
    inside = among.copy()
    while len(rule) < MAX_CONDITIONS:
        pos, neg = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not pos or not neg:
            break
        before, best, gain = np.log2(pos / (pos + neg)), None, 1e-9
        for name, values in x.items():
            own, labels = values[inside], bad[inside]
            for cut in _cuts(own):
                high = own > cut
                for above in (True, False):
                    side = high if above else ~high
                    p, m = int((side & labels).sum()), int(side.sum())
                    if p and m < len(own) and (g := p * (np.log2(p / m) - before)) > gain:
                        best, gain = Condition(name, above, float(cut)), g
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return tuple(rule)


def _cuts(values: np.ndarray) -> np.ndarray:
    """Thresholds at even ranks, each midway to the next value, so none lies on a value."""
    distinct = np.unique(values)
    if len(distinct) < 2:
        return distinct[:0]
    below = np.unique(np.searchsorted(distinct, np.quantile(values, np.linspace(0, 1, THRESHOLDS)), "right") - 1)
    below = np.clip(below, 0, len(distinct) - 2)
    return np.unique((distinct[below] + distinct[below + 1]) / 2)


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, among: np.ndarray) -> Rule:
    """Drop last conditions while the rule's worth on the pruning rows does not fall."""

    def worth(r: Rule) -> float:
        hit = _holds(r, x, len(bad)) & among
        p, m = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - m) / (p + m) if p + m else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn_from(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> list[Rule]:
    """Learn from ``labels`` (doc_id, quality) of ``docs``; at most ``rows`` of them reach the driver."""
    marks = (
        labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("label_id"), "quality")
    )
    # the size of ``marks`` is bounded by ``rows``
    found = with_statistics(
        docs.select("doc_id", "text").join(F.broadcast(marks), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "quality"),
        ("doc_id", "quality"),
    )
    table = found.where(f"not ({BASE_FAILED})").select("doc_id", "quality", *[c.alias(f"f_{k}") for k, c in features().items()])
    data = table.dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id", kind="stable")
    x = {k: data[f"f_{k}"].to_numpy(float) for k in features()}
    return learn(x, data["quality"].to_numpy() == 0)


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects, or null: one ordered CASE expression."""
    out: Column | None = None
    for i, rule in enumerate(rules):
        test = F.lit(True)
        for c in rule:
            test = test & c.column()
        out = F.when(test, F.lit(i + 1)) if out is None else out.when(test, F.lit(i + 1))
    return F.lit(None).cast("int") if out is None else out.cast("int")


def judged(docs: DataFrame, rules: list[Rule], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Base counts, base_failed, rule (the first that rejects) and kept of every document."""
    counted = with_statistics(docs, keep).withColumns({"base_failed": F.expr(BASE_FAILED), "rule": verdict(rules)})
    return counted.select(
        *keep, *BASE, "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule"
    )


def kept_rows(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns, whatever their names."""
    names = [f"own_{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    at = names[docs.columns.index("text")]
    counted = with_statistics(own, tuple(names), at).where(~F.expr(BASE_FAILED) & verdict(rules).isNull())
    return counted.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
