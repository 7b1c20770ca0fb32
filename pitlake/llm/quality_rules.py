"""Quality rules as a learned decision list, in DataFrame functions only.

``text_stats`` counts what a text is made of.  ``learn`` covers the labelled
rows sequentially: it grows a conjunction of thresholds by information gain on
two thirds of the rows left, prunes its last conditions on the other third,
keeps the rule while it is right on most rows it covers, removes the rows it
covers and goes on.  ``DecisionList.column`` emits the rules in their order as
one Spark conditional expression.

The labelled rows are a bounded sample: the ``sample_rows`` documents with the
smallest hash of doc_id among those in ``labels``; everything else covers all
rows.  Words are maximal runs without space and the controls 9 to 13.

Defined results: null and empty texts have no words and so fail the base rule;
a document with two labels counts as bad if one says so; without any label the
list is empty and keeps what the base rule keeps; repeated rows stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SAMPLE_ROWS = 20_000
_SPACE = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_exclaims", "n_stutters", "n_lines"]


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c))
    return text


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``STATS`` (long), which replace columns of these names."""
    keep = [c for c in docs.columns if c not in STATS]
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(t, F.lit(_SPACE))
    names = {c: f"__{c}" for c in ("t", "words", "hashes", "windows", "lines", "pairs", "at")}
    df = docs.select(*keep, t.alias(names["t"]), F.when(trimmed != "", F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")).otherwise(F.array().cast("array<string>")).alias(names["words"]))
    t, words = F.col(names["t"]), F.col(names["words"])
    blankless = _without(t, _SPACE)
    df = df.select(
        *keep,
        F.size(words).cast("long").alias("n_words"),
        F.char_length(blankless).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(_without(t, _SYMBOLS))).cast("long").alias("n_symbols"),
        (F.char_length(t) - F.char_length(F.replace(t, F.lit("!")))).cast("long").alias("n_exclaims"),
        F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(_SPACE)) != "").alias(names["lines"]),
        F.transform(words, lambda w: F.xxhash64(w)).alias(names["hashes"]),
    )
    lines, h = F.col(names["lines"]), F.col(names["hashes"])
    five = F.when(F.size(h) >= 5, F.transform(F.sequence(F.lit(0), F.size(h) - 5), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2), F.get(h, i + 3), F.get(h, i + 4)))).otherwise(F.array().cast("array<bigint>"))
    same_next = F.size(F.filter(F.transform(h, lambda x, i: x == F.get(h, i + 1)), lambda x: x))
    so_far = [*keep, "n_words", "word_chars", "n_symbols", "n_exclaims"]
    df = df.select(*so_far, F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), same_next.cast("long").alias("n_stutters"), five.alias(names["windows"]))
    so_far += ["n_lines", "n_dup_lines", "n_stutters"]
    w = F.col(names["windows"])
    # only a text in which a window occurs twice has its windows sorted, with their places
    sorted_pairs = F.when(F.size(F.array_distinct(w)) < F.size(w), F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    df = df.select(*so_far, sorted_pairs.alias(names["pairs"]))
    p = F.col(names["pairs"])
    twice = F.transform(p, lambda x, i: F.when((x["h"] == F.get(p, i + 1)["h"]) | (x["h"] == F.get(p, i - 1)["h"]), x["i"]))
    df = df.select(*so_far, F.sort_array(F.array_compact(twice)).alias(names["at"]))
    at = F.col(names["at"])
    covered = F.aggregate(F.transform(at, lambda x, i: F.least(F.lit(5), F.coalesce(F.get(at, i + 1) - x, F.lit(5)))), F.lit(0), lambda a, b: a + b)
    n_repeat = F.coalesce(covered, F.lit(0)).cast("long")
    # rand() is never negative; a column that isn't deterministic keeps Catalyst from copying
    # these array expressions into a filter below, where each would be worked out again and again
    n_repeat = F.when(F.rand(0) < 0, F.lit(0).cast("long")).otherwise(n_repeat)
    return df.select(*so_far, n_repeat.alias("n_repeat_words")).select(*keep, *STATS)


#: Statistic of the rules -> (numerator, denominator), both counts.
RATIOS = {
    "n_words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols_a_word": ("n_symbols", "n_words"),
    "exclaims_a_word": ("n_exclaims", "n_words"),
    "repeats_a_word": ("n_repeat_words", "n_words"),
    "stutters_a_word": ("n_stutters", "n_words"),
    "dup_lines_a_line": ("n_dup_lines", "n_lines"),
    "words_a_line": ("n_words", "n_lines"),
}


def _ratios(counts: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([counts[a] / np.maximum(counts[b], 1) if b else counts[a].astype(float) for a, b in RATIOS.values()], axis=1)


@dataclass(frozen=True)
class Condition:
    stat: str
    at_least: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, list(RATIOS).index(self.stat)]
        return v >= self.threshold if self.at_least else v <= self.threshold

    def column(self) -> Column:
        a, b = RATIOS[self.stat]
        v = F.col(a) / F.greatest(F.col(b), F.lit(1)) if b else F.col(a).cast("double")
        return v >= self.threshold if self.at_least else v <= self.threshold

    def __str__(self) -> str:
        return f"{self.stat} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    rules: list[tuple[list[Condition], float]] = field(default_factory=list)  # conditions, precision on its rows

    def rejects(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=bool)
        for conditions, _ in self.rules:
            out |= np.logical_and.reduce([c.holds(x) for c in conditions])
        return out

    def column(self) -> Column:
        """The number of the first rule that holds, from 1; 0 if none does."""
        out = None
        for i, (conditions, _) in enumerate(self.rules, 1):
            both = conditions[0].column()
            for c in conditions[1:]:
                both = both & c.column()
            out = F.when(both, i) if out is None else out.when(both, i)
        return F.lit(0) if out is None else out.otherwise(0)


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -np.inf)


def _best_condition(x: np.ndarray, bad: np.ndarray) -> tuple[float, Condition] | None:
    """The threshold with the largest information gain; halfway between two values."""
    best, p0, n0 = None, int(bad.sum()), int((~bad).sum())
    for k, stat in enumerate(RATIOS):
        order = np.argsort(x[:, k], kind="stable")
        v, hits = x[order, k], np.cumsum(bad[order])
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        below_p, below_n = hits[cuts], cuts + 1 - hits[cuts]
        for at_least, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            gain = _gain(p.astype(float), n.astype(float), p0, n0)
            i = int(gain.argmax())
            if gain[i] > 1e-9 and (best is None or gain[i] > best[0] + 1e-9):
                best = float(gain[i]), Condition(stat, at_least, float((v[cuts[i]] + v[cuts[i] + 1]) / 2))
    return best


def learn(x: np.ndarray, bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4, min_precision: float = 0.8, seed: int = 7) -> DecisionList:
    """Sequential covering of the rows where ``bad``."""
    out, rng = DecisionList(), np.random.default_rng(seed)
    left = np.arange(len(x))
    while len(out.rules) < max_rules and bad[left].sum() >= 5:
        mixed = rng.permutation(left)
        third = len(mixed) // 3
        prune, grow = mixed[:third], mixed[third:]
        rows, conditions = grow, []
        while len(conditions) < max_conditions and bad[rows].any() and not bad[rows].all():
            found = _best_condition(x[rows], bad[rows])
            if found is None:
                break
            conditions.append(found[1])
            rows = rows[found[1].holds(x[rows])]
        if not conditions:
            break
        worth = []
        for k in range(1, len(conditions) + 1):
            hit = np.logical_and.reduce([c.holds(x[prune]) for c in conditions[:k]])
            p, n = int((hit & bad[prune]).sum()), int((hit & ~bad[prune]).sum())
            worth.append((p - n) / (p + n) if p + n else -1.0)
        conditions = conditions[: int(np.argmax(worth)) + 1]
        hit = np.logical_and.reduce([c.holds(x[left]) for c in conditions])
        precision = float(bad[left][hit].mean()) if hit.any() else 0.0
        if precision < min_precision:
            break
        out.rules.append((conditions, precision))
        left = left[~hit]
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DecisionList:
    """Learn from at most ``sample_rows`` labelled documents, on those that the base rule keeps."""
    some = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # the bound of the broadcast
    rows = text_stats(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")).select("quality", *STATS).collect()
    if not rows:
        return DecisionList()
    values = np.array([list(r) for r in rows], dtype=np.int64)
    n, repeat = values[:, 1 + STATS.index("n_words")], values[:, 1 + STATS.index("n_repeat_words")]
    values = values[(n >= 10) & (100 * repeat <= 20 * n)]
    values = values[np.lexsort(values.T[::-1])]  # whatever order the rows came in
    return learn(_ratios({s: values[:, k + 1] for k, s in enumerate(STATS)}), values[:, 0] == 0)


def apply_rules(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``docs`` with its statistics, base_failed, rule (0: none) and kept, which replace columns of these names."""
    out = text_stats(docs.drop("base_failed", "rule", "kept")).withColumn("base_failed", base_failed())
    out = out.withColumn("rule", F.when(F.col("base_failed"), 0).otherwise(rules.column()))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    return apply_rules(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
