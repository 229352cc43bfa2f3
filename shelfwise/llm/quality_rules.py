"""Quality rules: text statistics in SQL functions and a learned decision list over them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import bounded_sample, table

SPACE = "[\\x20\\x09-\\x0D]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Most labelled rows that the list is learned from (smallest key hashes first).
SAMPLE_ROWS = 20_000
FEATURES = (
    "mean_word_length",
    "symbols_per_word",
    "marks_per_word",
    "upper_share",
    "digit_share",
    "dup_line_share",
    "repeat_share",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once: a lambda's variable is evaluated, an alias may be inlined."""
    return F.transform(F.array(value), body)[0]


def _count(text: Column, characters: str) -> Column:
    """Characters of ``text`` in the class ``characters``."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur at least twice in ``words``.

    Equal window hashes tell where repeats may be, and only those windows are compared as text, so
    the count is exact and takes n log n steps however long the text is.
    """

    def window_hashes(h: Column) -> Column:
        def joined(a: Column, b: Column, shift: int) -> Column:
            return F.zip_with(a, F.slice(b, shift + 1, 2**31 - 1), lambda x, y: F.xxhash64(x, y))

        def five(two: Column) -> Column:
            return F.slice(joined(joined(two, two, 2), h, 4), F.lit(1), F.size(h) - F.lit(WINDOW - 1))

        return let(joined(h, h, 1), five)

    def twice(rows: Column) -> Column:
        """Of ascending structs, those whose first field another one shares."""

        def found(s: Column) -> Column:
            def same(k: Column) -> Column:
                return F.get(s, k)["col1"]

            return F.filter(s, lambda x, k: x["col1"].eqNullSafe(same(k - 1)) | x["col1"].eqNullSafe(same(k + 1)))

        return let(F.sort_array(rows), found)

    def pair(value: Column, i: Column) -> Column:
        return F.struct(value.alias("col1"), i.alias("i"))

    def repeated(ws: Column, h: Column) -> Column:
        def confirmed(maybe: Column) -> Column:
            return twice(
                F.transform(
                    maybe,
                    lambda x: pair(F.concat_ws(" ", *[F.get(ws, x["i"] + k) for k in range(WINDOW)]), x["i"]),
                )
            )

        def covered(at: Column) -> Column:
            gaps = F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))))
            return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

        hits = let(twice(F.transform(h, pair)), confirmed)
        return let(F.sort_array(F.transform(hits, lambda x: x["i"])), covered)

    def count(ws: Column) -> Column:
        def of_hashes(h: Column) -> Column:
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(ws, h))

        hashed = let(F.transform(ws, lambda w: F.xxhash64(w)), window_hashes)
        return F.when(F.size(ws) <= WINDOW, F.lit(0)).otherwise(let(hashed, of_hashes))

    return let(words, count).cast("long")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep``, the counts of the base rules and FEATURES; no shuffle, no Python.

    A null text has no words and all counts 0. Shares of nothing are 0.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), *keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text")
    )
    text, words, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    rows = rows.withColumns(
        {
            "__words": F.array_remove(F.split(text, f"{SPACE}+"), ""),
            "__lines": F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
        }
    )
    counts = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _count(text, "#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeat_words(words).alias("n_repeat_words"),
        F.size(lines).alias("__n_lines"),
        _count(text, "!?").alias("__marks"),
        _count(text, "\\p{Lu}").alias("__upper"),
        _count(text, "0-9").alias("__digits"),
    )
    # a generated row: conditions on the counts are not moved below it, where they would be computed again
    counted = rows.select("doc_id", *keep, F.inline(F.array(counts)))

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    shares = {
        "mean_word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "marks_per_word": share("__marks", "n_words"),
        "upper_share": share("__upper", "word_chars"),
        "digit_share": share("__digits", "word_chars"),
        "dup_line_share": share("n_dup_lines", "__n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
    }
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumns(shares | {"base_failed": failed}).drop(
        "__n_lines", "__marks", "__upper", "__digits"
    )


@dataclass(frozen=True)
class Rule:
    """A conjunction of thresholds on statistics; a text that meets all of them is rejected."""

    terms: tuple[tuple[str, str, float], ...]

    def condition(self) -> Column:
        tests = [F.col(f) <= t if op == "<=" else F.col(f) > t for f, op, t in self.terms]
        return reduce(lambda a, b: a & b, tests)

    def mask(self, x: np.ndarray) -> np.ndarray:
        hit = np.ones(len(x), bool)
        for f, op, t in self.terms:
            col = x[:, FEATURES.index(f)]
            hit &= (col <= t) if op == "<=" else (col > t)
        return hit


def _best_term(x: np.ndarray, bad: np.ndarray) -> tuple[float, tuple[str, str, float]] | None:
    """The threshold with the largest information gain for the rows still covered."""
    p, n = bad.sum(), len(bad) - bad.sum()
    before = np.log2(p / (p + n))
    best = None
    for j, name in enumerate(FEATURES):
        order = np.argsort(x[:, j], kind="stable")
        values = x[order, j]
        cuts = np.flatnonzero(values[1:] > values[:-1])
        if not len(cuts):
            continue
        below = np.cumsum(bad[order])[cuts].astype(float)
        for op, hit_bad, hit in (("<=", below, cuts + 1.0), (">", p - below, len(bad) - cuts - 1.0)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(hit_bad > 0, hit_bad * (np.log2(hit_bad / hit) - before), -np.inf)
            k = int(np.argmax(gain))
            if best is None or gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), (name, op, float((values[cuts[k]] + values[cuts[k] + 1]) / 2)))
    return best


def learn(x: np.ndarray, bad: np.ndarray, max_rules: int = 12, max_terms: int = 3, precision: float = 0.9) -> list[Rule]:
    """Sequential covering: grow a conjunction by information gain on two thirds of the rows, prune
    its last terms on the rest, keep it while at least ``precision`` of what it covers there is
    bad, remove what it covers, and go on.

    Without bad or without good rows there is nothing to tell apart and the list is empty.
    """
    rules: list[Rule] = []
    turn = np.arange(len(bad)) % 3
    left = np.ones(len(bad), bool)
    for _ in range(max_rules):
        grow, prune = left & (turn < 2), left & (turn == 2)
        if bad[grow].sum() < 5 or bad[grow].all():
            break
        terms: list[tuple[str, str, float]] = []
        covered = grow.copy()
        while len(terms) < max_terms and not bad[covered].all():
            term = _best_term(x[covered], bad[covered])
            if term is None or term[0] <= 1e-9:
                break
            terms.append(term[1])
            covered = grow & Rule(tuple(terms)).mask(x)
        if not terms:
            break

        def worth(k: int) -> float:
            hit = Rule(tuple(terms[:k])).mask(x) & prune  # noqa: B023
            b = bad[hit].sum()
            return float(2 * b - hit.sum()) / max(int(hit.sum()), 1)

        size = max(range(1, len(terms) + 1), key=lambda k: (round(worth(k), 9), -k))
        rule = Rule(tuple(terms[:size]))
        hit = rule.mask(x)
        checked = hit & prune
        if checked.sum() < 3 or bad[checked].mean() < precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from the statistics of at most ``sample_rows`` labelled documents (label column ``quality``, 0 is bad).

    Texts that fail the base rules teach nothing and are left out. Only that many rows of numbers
    reach the driver. Null labels and unlabelled texts are left out;
    a document labelled twice counts twice.
    """
    known = labels.where("doc_id is not null and quality is not null")
    known = known.select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen = bounded_sample(known, ["doc_id", "quality"], sample_rows)
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = statistics(labelled, keep=("quality",)).where("not base_failed").select(*FEATURES, "quality", "doc_id").collect()
    rows.sort(key=lambda r: (r["doc_id"] * 2654435761 % 2**32, tuple(r)))
    if not rows:
        return []
    x = np.array([r[: len(FEATURES)] for r in rows], float)
    return learn(x, np.array([r["quality"] == 0 for r in rows]))


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one conditional: the number of the first rule met, null if none is."""
    if not rules:
        return F.lit(None).cast("int")
    first, *rest = enumerate(rules, 1)
    out = F.when(first[1].condition(), F.lit(first[0]))
    for k, rule in rest:
        out = out.when(rule.condition(), F.lit(k))
    return out


def judge(docs: DataFrame, rules: list[Rule], keep: tuple[str, ...] = ()) -> DataFrame:
    """Statistics with base_failed, rule (the learned rule that rejects) and kept; one row per input row.

    Empty and null texts fail the base rules. Repeated ids are judged one by one.
    """
    rule = F.when(~F.col("base_failed"), verdict(rules))
    return statistics(docs, keep=keep).withColumn("rule", rule).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )


def filter_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are kept, with their columns; rules come from the labels table."""
    rules = fit(docs, table(spark, sf_dir, "labels"))
    names = [f"__c{i}" for i in range(len(docs.columns))]
    boxed = docs.toDF(*names).withColumns({"doc_id": F.col(names[docs.columns.index("doc_id")]), "text": F.col(names[docs.columns.index("text")])})
    return judge(boxed, rules, keep=tuple(names)).where("kept").select(*names).toDF(*docs.columns)


def op10_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the learned verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
