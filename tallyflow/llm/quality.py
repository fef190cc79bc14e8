"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule compares one ratio of a text with a cutoff, and a text is rejected if any rule rejects it. ``SETTINGS``
is one fixed order of cutoffs for all rules together, from loose to strict. Labelled good texts decide how far each
stratum (language) goes: a setting is certified if the exact binomial test rejects a false-rejection rate of
``RISK`` or more for the whole verdict, P(Bin(n, RISK) <= k) <= ``DELTA`` / strata, where k of the n good texts would
be rejected. Settings are tested in their order up to the first that is not certified, which needs no correction
along the order (a wrong certificate needs the first bad setting to pass); the strata are corrected for
(Bonferroni). So with probability 1 - ``DELTA`` at most ``RISK`` of the good texts that pass the base rule are rejected in
any stratum. The last certified setting is used; a stratum without one has the base rule only. With four strata
437 good texts without a rejection certify a setting, so small holdouts certify none.

A text counts once among the labelled ones, whatever its copies; near copies count each, as trials of their own.

Null and empty texts have no words and fail the base rule. A null language is a stratum. A null label, and
one of an id without a text, says nothing. Repeated ids are rows of
their own. Without labels only the base rule decides. Extra columns are not read.

A text's windows are compared by 64-bit hashes inside its own row; texts are never shuffled. The test adds up
k + 1 terms for each cutoff, for up to tens of millions of labelled texts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.sinks.scratch import stored

LEAST_WORDS = 20
MOST_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"

RISK = 0.01
DELTA = 0.05
#: rule: the counts it divides
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
#: cutoffs of the rules, in their order, from loose to strict
SETTINGS = (
    (0.5, 0.5, 0.8, 0.95, 0.3),
    (0.3, 0.3, 0.6, 0.9, 0.3),
    (0.2, 0.2, 0.5, 0.8, 0.3),
    (0.1, 0.1, 0.4, 0.7, 0.3),
    (0.05, 0.05, 0.3, 0.6, 0.28),
    (0.02, 0.02, 0.2, 0.5, 0.26),
    (0.01, 0.01, 0.1, 0.4, 0.24),
    (0.005, 0.005, 0.07, 0.3, 0.2),
    (0.002, 0.002, 0.05, 0.2, 0.15),
)
#: strata that may be sent to every task
FEW = 100_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur more than once, each counted once."""

    def covered(windows: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            again = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["w"] == x["w"])) | ((i < F.size(s) - 1) & (F.get(s, i + 1)["w"] == x["w"])))
            return _let(F.sort_array(F.transform(again, lambda x: x["i"])), of_places)

        def of_places(at: Column) -> Column:
            after = F.concat(F.slice(at, 2, F.size(at) - 1), F.array(F.element_at(at, -1) + WINDOW))
            return F.aggregate(F.zip_with(at, after, lambda a, b: F.least(F.lit(WINDOW), b - a)), F.lit(0), lambda s, x: s + x)

        places = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(places, of_sorted))

    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - WINDOW + 1), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
    return F.when(F.size(hashes) <= WINDOW, F.lit(0)).otherwise(_let(windows, covered))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(doc_id, stratum, text_key) and the counts of each text; equal texts have one key."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).alias("stratum"), F.coalesce(text_col, F.lit("")).alias("t"))
    t = F.col("t")
    hashes = F.transform(F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))
    words = _let(hashes, lambda h: F.struct(F.size(h).alias("n"), _repeat_words(h).alias("repeats")))
    lines = F.filter(F.split(t, "\n"), lambda x: _without(x, SPACES) > 0)
    line_counts = _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    out = rows.select(
        "doc_id", "stratum", F.xxhash64(t).alias("text_key"), words.alias("w"), line_counts.alias("l"), _without(t, SPACES).alias("word_chars"),
        *[(F.length(t) - _without(t, letters)).alias(name) for name, letters in (("n_symbols", SYMBOLS), ("n_marks", "!"), ("n_capitals", UPPER))],
    )
    counts = {"n_words": F.col("w.n"), "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"), "n_dup_lines": F.col("l.dup"), "n_repeat_words": F.col("w.repeats"), "n_lines": F.col("l.n"), "n_marks": F.col("n_marks"), "n_capitals": F.col("n_capitals")}
    failed = (F.col("w.n") < LEAST_WORDS) | (100 * F.col("w.repeats").cast("bigint") > MOST_REPEAT_PERCENT * F.col("w.n").cast("bigint"))
    return out.select("doc_id", "stratum", "text_key", *[c.cast("bigint").alias(k) for k, c in counts.items()], failed.alias("base_failed"))


def _ratio(rule: str) -> Column:
    part, whole = RULES[rule]
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def _log_tail(k: Column, n: Column, risk: float) -> Column:
    """log P(Bin(n, risk) <= k), summed term by term."""
    odds = risk / (1 - risk)
    first = n * F.log1p(F.lit(-risk))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i * odds)
        top = F.greatest(s["sum"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(-F.abs(s["sum"] - term)))).alias("sum"))

    start = F.struct(first.alias("term"), first.alias("sum"))
    return F.when(k == 0, first).otherwise(F.aggregate(F.sequence(F.lit(1).cast("bigint"), k), start, step, lambda s: s["sum"]))


def _rejects(cuts: list[Column]) -> Column:
    """Any rule's ratio is over its cutoff; a null cutoff rejects nothing."""
    return reduce(lambda a, b: a | b, [F.coalesce(_ratio(rule) > cut, F.lit(False)) for rule, cut in zip(RULES, cuts)])


def thresholds(measured: DataFrame, labels: DataFrame, label_col: str = "quality", label_id: str = "doc_id", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum: its good texts, the last certified setting (0 for none), and each rule's cutoff, null where there is none."""
    good = labels.where(F.col(label_col) == 1).select(F.col(label_id).alias("i"))
    held = measured.where("not base_failed").join(good, F.col("doc_id") == F.col("i")).dropDuplicates(["stratum", "text_key"])
    rejected = [F.count_if(_rejects([F.lit(c) for c in cuts])).alias(f"k_{j}") for j, cuts in enumerate(SETTINGS)]
    counted = stored(held.groupBy("stratum").agg(F.count("*").alias("n"), *rejected), "holdout")  # one row per stratum
    bar = F.log(F.lit(delta) / max(1, counted.count()))
    # a stricter setting rejects all that a looser one does, so the certified ones are the first ones; a rate of
    # the risk or more is never certified, which saves the sum
    certified = [F.when(F.col(f"k_{j}") < risk * F.col("n"), _log_tail(F.col(f"k_{j}"), F.col("n"), risk) <= bar).otherwise(False) for j in range(len(SETTINGS))]
    level = reduce(lambda a, b: a + b, [c.cast("int") for c in certified])
    own = counted.select(F.col("stratum").alias("s"), "n", level.alias("level"))
    return own.select("*", *[F.when(F.col("level") > 0, F.get(F.array(*[F.lit(cuts[r]) for cuts in SETTINGS]), F.col("level") - 1)).alias(f"cut_{rule}") for r, rule in enumerate(RULES)])


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """The counts of each text, whether the base rule fails it, and whether it is kept."""
    measured = stored(measures(docs, id_col, text_col, stratum_col), "measures")
    cut = stored(thresholds(measured, labels, label_col).drop("n", "level"), "thresholds")
    joined = measured.join(F.broadcast(cut) if cut.count() <= FEW else cut, F.col("stratum").eqNullSafe(F.col("s")), "left")
    rejected = _rejects([F.col(f"cut_{r}") for r in RULES])
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"))
