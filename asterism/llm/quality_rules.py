"""Quality rules: a learned decision list over statistics of each text.

The list is learned by sequential covering on labelled rows. A rule, a conjunction
of thresholds, is grown condition by condition on one part of the rows by
information gain, cut back on the other part, and accepted if it still holds there;
the rows it covers leave, and the next rule is learned on the rest. The accepted
rules become one ordered conditional expression. All counting is done by Spark on
binned statistics; the driver sees a row for each feature and bin.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import WHITE_SPACE, WORD, without
from asterism.sources.staging import stage

# The symbols that the statistics count.
SYMBOLS = "#*$%&|<>"
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PCT = 50
# labelled rows that are learned from, at most about
LABELLED = 20_000
BINS = 24
MOST_RULES, MOST_CONDITIONS = 8, 3
MIN_COVER, MIN_PRECISION = 4, 0.97

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# feature -> SQL over the statistics; null where there is nothing to divide by
FEATURES = {
    "f_words": "double(n_words)",
    "f_word_length": "try_divide(word_chars, n_words)",
    "f_symbol_pct": "try_divide(100 * n_symbols, word_chars)",
    "f_dup_line_pct": "try_divide(100 * n_dup_lines, n_lines)",
    "f_repeat_pct": "try_divide(100 * n_repeat_words, n_words)",
    "f_upper_pct": "try_divide(100 * n_upper, word_chars)",
}


def text_stats(docs: DataFrame) -> DataFrame:
    """Statistics of each whole text: a row per row of ``docs`` (doc_id, text).

    ``n_repeat_words`` is the number of words lying in a three-word window that the
    text has twice or more. Windows are compared by 64-bit hash within their text.
    A window hash with its place is sorted, equal neighbours keep their places, and
    each place adds the words up to the next one, at most three. A null text counts
    as empty, and an empty text has zeros. Repeated rows stay apart.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words, marks = F.col("_words"), F.col("_marks")
    rows = docs.select(
        "doc_id",
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
        F.length(without(text, WHITE_SPACE)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(without(text, _UPPER))).cast("long").alias("n_upper"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)).alias("_lines"),
    )
    rows = rows.select(
        "*",
        F.size(words).cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(words) > 3,
            F.transform(
                F.sequence(F.lit(0), F.size(words) - 3),
                lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
            ),
        ).alias("_windows"),
    ).drop("_words", "_lines")
    windows = F.col("_windows")
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    rows = rows.withColumn(
        "_marks",
        F.when(repeats, F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))),
    ).drop("_windows")
    twice = F.filter(
        marks,
        lambda m, i: F.coalesce(F.get(marks, i - 1)["h"] == m["h"], F.lit(False))
        | F.coalesce(F.get(marks, i + 1)["h"] == m["h"], F.lit(False)),
    )
    rows = rows.withColumn("_places", F.sort_array(F.transform(twice, lambda m: m["at"]))).drop("_marks")
    places = F.col("_places")
    steps = F.transform(places, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - at, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_places")


@dataclass(frozen=True)
class Condition:
    """``feature > threshold``, or ``feature <= threshold``; a null value meets neither."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        met = value > self.threshold if self.above else value <= self.threshold
        return F.coalesce(met, F.lit(False))


Rule = tuple[Condition, ...]


def _all_of(rule: Rule) -> Column:
    met = F.lit(True)
    for condition in rule:
        met = met & condition.column()
    return met


def with_features(stats: DataFrame) -> DataFrame:
    return stats.withColumns({name: F.expr(sql) for name, sql in FEATURES.items()})


def decision_list(rules: list[Rule]) -> Column:
    """Number of the first rule that a row meets, from 1, as one conditional expression; else null."""
    column = F.when(F.lit(False), F.lit(0))
    for number, rule in enumerate(rules, 1):
        column = column.when(_all_of(rule), F.lit(number))
    return column


def _base_failed() -> Column:
    return (F.col("n_words") < BASE_MIN_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PCT * F.col("n_words")
    )


def labelled_stats(stats: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """Features and label of the labelled rows that pass the base rule, about ``bound``
    of them at most.

    Rows are drawn by a hash of the id. An id with several labels counts as bad if
    one of them says so; null ids and labels are left out.
    """
    marked = labels.where("doc_id is not null and quality is not null")
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    total = marked.count()
    if total > bound:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (1 << 20) * bound // total)
    grow = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) < 2
    rows = stats.where(~_base_failed()).join(F.broadcast(marked), "doc_id")  # about bound rows of two numbers
    return rows.select(*FEATURES, (F.col("_quality") == 0).alias("bad"), grow.alias("grow"))


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Midpoints between the quantiles of each feature, over all rows and over the bad ones.

    A midpoint leaves a margin on both sides where the classes lie apart.
    """
    shares = [(i + 1) / (BINS + 1) for i in range(BINS)]
    cuts = [F.percentile_approx(name, shares, 10_000).alias(name) for name in FEATURES]
    found = [of.agg(*cuts).first() for of in (rows, rows.where("bad"))]
    values = {name: sorted({value for row in found for value in row[name] or []}) for name in FEATURES}
    return {name: [(a + b) / 2 for a, b in zip(of, of[1:])] for name, of in values.items()}


def learn_rules(rows: DataFrame) -> list[Rule]:
    """The decision list for ``bad`` rows of ``rows``, in the order in which it is to be tried."""
    rows = stage(rows)
    thresholds = _thresholds(rows)
    rules: list[Rule] = []
    left = rows
    while len(rules) < MOST_RULES:
        rule = _grow(left.where("grow"), thresholds)
        rule = _prune(left, rule) if rule else rule
        if not rule:
            break
        rules.append(rule)
        left = left.where(~_all_of(rule))
    return rules


def _counts_by_bin(rows: DataFrame, thresholds: dict[str, list[float]]) -> dict[tuple[str, int], tuple[int, int]]:
    """(bad, good) rows for each feature and number of thresholds below the value."""
    bins = [
        F.struct(
            F.lit(name).alias("feature"),
            F.when(
                F.col(name).isNotNull(),
                sum(((F.col(name) > t).cast("int") for t in cuts), F.lit(0)),
            ).alias("bin"),
        )
        for name, cuts in thresholds.items()
    ]
    counted = (
        rows.select("bad", F.explode(F.array(*bins)).alias("at"))
        .where("at.bin is not null")
        .groupBy("at.feature", "at.bin")
        .agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    )
    return {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in counted.toLocalIterator()}


def _grow(rows: DataFrame, thresholds: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < MOST_CONDITIONS:
        counts = _counts_by_bin(rows.where(_all_of(rule)), thresholds)
        some = next(iter(thresholds))
        bad, good = (sum(v[i] for (name, _), v in counts.items() if name == some) for i in (0, 1))
        best, gain = None, 0.0
        for name, cuts in thresholds.items():
            for i, cut in enumerate(cuts):
                for above in (True, False):
                    inside = [v for (f, b), v in counts.items() if f == name and (b > i) == above]
                    p, n = sum(v[0] for v in inside), sum(v[1] for v in inside)
                    if p >= MIN_COVER:
                        worth = p * (log2(p / (p + n)) - log2(bad / (bad + good)))
                        if worth > gain:
                            best, gain = Condition(name, above, cut), worth
        if best is None or best in rule:
            break
        rule = (*rule, best)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> Rule:
    """The beginning of ``rule`` that does best on the rows it wasn't grown on, of those
    that are precise on all rows and cover some of either part; nothing if none is.
    """
    starts = [rule[:k] for k in range(1, len(rule) + 1)]
    bad, new = F.col("bad"), ~F.col("grow")
    found = rows.agg(
        *(F.count_if(_all_of(s) & bad).alias(f"p{k}") for k, s in enumerate(starts)),
        *(F.count_if(_all_of(s) & ~bad).alias(f"n{k}") for k, s in enumerate(starts)),
        *(F.count_if(_all_of(s) & bad & new).alias(f"pn{k}") for k, s in enumerate(starts)),
        *(F.count_if(_all_of(s) & ~bad & new).alias(f"nn{k}") for k, s in enumerate(starts)),
    ).first()
    best, score = (), 0
    for k, start in enumerate(starts):
        p, n = found[f"p{k}"], found[f"n{k}"]
        worth = found[f"pn{k}"] - found[f"nn{k}"]
        if worth > score and p >= MIN_PRECISION * (p + n):
            best, score = start, worth
    return best


def apply_rules(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with base_failed, rule (number of the rule that rejects the row, or null) and kept."""
    judged = with_features(stats).withColumns({"base_failed": _base_failed(), "rule": decision_list(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_verdicts(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """Statistics and verdict for each row of ``docs``, by rules learned from ``labels``.

    Without labelled rows, or without a rule that holds, the base rule alone decides.
    """
    stats = stage(text_stats(docs))
    return apply_rules(stats, learn_rules(labelled_stats(with_features(stats), labels, bound)))
