"""Quality rules: base statistics in built-in expressions, and a learned decision list.

``quality_stats`` measures every whole text. ``learn_rules`` fits an ordered list of
threshold conjunctions by sequential covering (grow on two thirds of a bounded labelled
sample, prune on the rest). The list becomes one ordered ``CASE WHEN`` over the statistics,
so judging all documents is a narrow projection without any shuffle.

Defined results: a null or empty text has no words and fails the base rules; repeated rows
are judged alike; a null doc_id is kept as null; no labels (or none of one class) give an
empty list, which keeps whatever passes the base rules; extra columns pass through
``judge`` untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, WORD_SPACE_CLASS, count_chars, free_prefix

#: statistics the rules may test, all ratios so that they mean the same for any length
FEATURES = ("mean_word", "symbol_ratio", "upper_ratio", "digit_ratio", "shout_ratio",
            "dup_line_ratio", "repeat_ratio", "words_log")
#: at most so many labelled rows are used to fit the list (a documented bound)
SAMPLE_ROWS = 6000
MIN_WORDS = 50


def _neighbours(xs: Column) -> Column:
    """The array without its first element."""
    return F.slice(xs, F.lit(2), F.greatest(F.size(xs) - 1, F.lit(0)))


def with_stats(df: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``df`` with the statistics in extra columns, and the prefix of their names.

    n_repeat_words sorts a text's 3-word window hashes with their positions, keeps the
    positions whose hash has an equal neighbour, and adds up the words they cover; the
    work is n log n in one row and no row is exploded.
    """
    p = free_prefix(df, "q_")
    c = lambda name: F.col(p + name)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = df.withColumn(p + "t", text)
    trimmed = F.btrim(c("t"), F.lit(WORD_SPACE))
    out = out.withColumns({
        p + "words": F.when(trimmed == "", F.array().cast("array<string>"))
                      .otherwise(F.split(trimmed, WORD_SPACE_CLASS + "+")),
        p + "lines": F.filter(F.split(c("t"), "\n"),
                              lambda x: F.btrim(x, F.lit(WORD_SPACE)) != ""),
    })
    n = F.size(c("words"))
    pairs = F.zip_with(c("words"), _neighbours(c("words")), lambda a, b: F.xxhash64(a, b))
    triples = F.zip_with(pairs, F.slice(c("words"), F.lit(3), F.greatest(n - 2, F.lit(0))),
                         lambda h, w: F.xxhash64(h, w))
    triples = F.slice(triples, F.lit(1), F.greatest(n - 2, F.lit(0)))
    out = out.withColumn(p + "sorted", F.sort_array(
        F.transform(triples, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    out = out.withColumn(p + "same", F.zip_with(
        c("sorted"), _neighbours(c("sorted")),
        lambda x, y: x["h"].eqNullSafe(y["h"])))
    same_at = lambda i: F.coalesce(F.get(c("same"), i), F.lit(False))
    repeated = F.filter(c("sorted"), lambda x, i: same_at(i) | same_at(i - 1))
    out = out.withColumns({
        p + "at": F.sort_array(F.transform(repeated, lambda x: x["i"])),
        # what is left without lower-case letters and spaces: short, so counting in it is cheap
        p + "rest": F.regexp_replace(c("t"), r"[a-z\x20]+", "")})
    covered = F.aggregate(
        F.zip_with(c("at"), _neighbours(c("at")),
                   lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    # inline() of a one-element array: a filter on the statistics cannot be pushed below
    # it, which would repeat the whole chain of expressions inside the filter
    stats = F.struct(
        n.cast("long").alias(p + "n_words"),
        F.length(F.concat_ws("", c("words"))).cast("long").alias(p + "word_chars"),
        count_chars(c("rest"), "[#*$%&|<>]").cast("long").alias(p + "n_symbols"),
        (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long").alias(p + "n_dup_lines"),
        F.size(c("lines")).cast("long").alias(p + "n_lines"),
        covered.alias(p + "n_repeat_words"),
        count_chars(c("rest"), "[A-Z]").cast("long").alias(p + "n_upper"),
        count_chars(c("rest"), "[0-9]").cast("long").alias(p + "n_digit"),
        count_chars(c("rest"), "[!?]").cast("long").alias(p + "n_shout"))
    out = out.select(*[F.col(f"`{x}`") for x in df.columns], F.inline(F.array(stats)))
    return out, p


def features(p: str) -> dict[str, Column]:
    """The rule features over the columns ``with_stats`` made with prefix ``p``."""
    c = lambda name: F.col(p + name)
    ratio = lambda a, b: F.coalesce(F.try_divide(c(a).cast("double"), c(b).cast("double")), F.lit(0.0))
    return {"mean_word": ratio("word_chars", "n_words"), "symbol_ratio": ratio("n_symbols", "n_words"),
            "upper_ratio": ratio("n_upper", "word_chars"), "digit_ratio": ratio("n_digit", "word_chars"),
            "shout_ratio": ratio("n_shout", "n_words"), "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"),
            "words_log": F.log1p(c("n_words").cast("double"))}


def base_failed(p: str) -> Column:
    """Fewer than 50 words, or over half of them in repeated 3-word windows."""
    return ((F.col(p + "n_words") < MIN_WORDS)
            | (100 * F.col(p + "n_repeat_words") > 50 * F.col(p + "n_words")))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, '<=' or '>', threshold); a text that meets it is rejected."""

    tests: tuple[tuple[str, str, float], ...]

    def matches(self, x: dict[str, np.ndarray]) -> np.ndarray:
        ok = np.ones(len(next(iter(x.values()))), bool)
        for f, op, v in self.tests:
            ok &= (x[f] <= v) if op == "<=" else (x[f] > v)
        return ok

    def column(self, feats: dict[str, Column]) -> Column:
        out = F.lit(True)
        for f, op, v in self.tests:
            out = out & ((feats[f] <= v) if op == "<=" else (feats[f] > v))
        return out


def _grow(x, bad, max_tests: int, cuts: int) -> Rule:
    """Add the test with the best FOIL gain until the rule covers bad rows only."""
    rule, live = Rule(()), np.ones(len(bad), bool)
    while len(rule.tests) < max_tests:
        p0, n0 = (bad & live).sum(), (~bad & live).sum()
        if p0 == 0 or n0 == 0:
            break
        best = (1e-9, None)
        for f in FEATURES:
            values = x[f][live]
            marks = np.unique(np.quantile(values, np.linspace(0, 1, cuts)))
            mids = np.unique(np.concatenate([(marks[1:] + marks[:-1]) / 2, marks[:-1]]))
            order = np.sort(values[bad[live]]), np.sort(values[~bad[live]])
            below = [np.searchsorted(o, mids, side="right") for o in order]
            for op, (p, n) in (("<=", below), (">", [len(o) - b for o, b in zip(order, below)])):
                gain = np.where(p > 0, p * (np.log2((p + 1e-9) / (p + n + 1e-9)) - np.log2(p0 / (p0 + n0))), -1)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), (f, op, float(mids[gain.argmax()])))
        if best[1] is None:
            break
        rule = Rule((*rule.tests, best[1]))
        live &= Rule((best[1],)).matches(x)
    return rule


def _prune(rule: Rule, x, bad) -> tuple[Rule, int, int]:
    """The leading tests that score best, (p - n) / (p + n), on rows not used to grow."""
    best = (-2.0, rule, 0, 0)
    for k in range(len(rule.tests), 0, -1):
        cut = Rule(rule.tests[:k])
        m = cut.matches(x)
        p, n = int((bad & m).sum()), int((~bad & m).sum())
        score = (p - n) / (p + n) if p + n else -1.0
        if score >= best[0]:
            best = (score, cut, p, n)
    return best[1:]


def cover(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_tests: int = 4,
          min_precision: float = 0.97, min_rows: int = 3, cuts: int = 64) -> list[Rule]:
    """Sequential covering: grow a rule, prune it, accept it only if it is precise on the
    rows held out for pruning, remove what it covers, and go on with the rest."""
    hold = np.arange(len(bad)) % 3 == 2
    live, rules = np.ones(len(bad), bool), []
    take = lambda m: ({f: x[f][m] for f in FEATURES}, bad[m])
    while len(rules) < max_rules and (bad & live & ~hold).any():
        rule = _grow(*take(live & ~hold), max_tests, cuts)
        if not rule.tests:
            break
        rule, p, n = _prune(rule, *take(live & hold))
        if p < min_rows or p < min_precision * (p + n):
            break
        rules.append(rule)
        live &= ~rule.matches(x)
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Fit the decision list on at most ``sample_rows`` labelled documents that pass the
    base rules, taken by the smallest hash of doc_id. Only their statistics reach the driver.
    Labels with a null doc_id or quality teach nothing; a document labelled twice counts as
    good only if every label says so."""
    sample = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where("doc_id IS NOT NULL AND quality IS NOT NULL")
              .groupBy("doc_id").agg(F.min("quality").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id")  # at most sample_rows rows
    stats, p = with_stats(joined)
    rows = (stats.where(~base_failed(p))
            .select("doc_id", "label", *[v.alias(k) for k, v in features(p).items()])
            .dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).collect())
    bad = np.array([r["label"] == 0 for r in rows], bool)
    if not bad.any() or bad.all():
        return []
    return cover({f: np.array([r[f] for r in rows], float) for f in FEATURES}, bad)


def verdict(rules: list[Rule], p: str) -> Column:
    """The list as one ordered conditional expression: the first rule met rejects."""
    feats, out = features(p), None
    for rule in rules:
        cond = rule.column(feats)
        out = F.when(cond, False) if out is None else out.when(cond, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the base statistics, base_failed and kept, one row per row of ``docs``."""
    stats, p = with_stats(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")))
    failed = base_failed(p)
    return stats.select("doc_id", *[F.col(p + c).alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"), (~failed & verdict(rules, p)).alias("kept"))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the list, columns unchanged."""
    stats, p = with_stats(docs)
    return stats.where(~base_failed(p) & verdict(rules, p)).select(*[F.col(f"`{c}`") for c in docs.columns])
