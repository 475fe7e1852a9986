"""Quality rules: a table of thresholds compiled into one Spark projection.

Main path: DataFrame functions only. A first projection counts words, symbols, lines and repetitions; the rule table is compiled into
ratios of those counts and one boolean per rule; no user function, join or shuffle takes part, so a text of any length costs its own
task only.

Defined cases: a null or empty text has no words, all counts are 0 and it fails the base rule; nulls in other columns and additional columns do
not matter; repeated rows are judged alike, one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.frames import let, words

# Frequent function words of the languages in use.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "with", "for", "is", "was", "on", "are", "as", "be", "at",
    "der", "die", "das", "und", "den", "zu", "von", "mit", "ist", "im", "für", "ein", "eine", "sich", "des",
    "le", "la", "les", "et", "une", "un", "du", "que", "est", "pour", "dans", "par", "sur", "avec", "au",
    "el", "los", "las", "y", "en", "por", "con", "para", "una", "se", "es", "no", "su", "al", "de",
)


@dataclass(frozen=True)
class Rule:
    """Keep a document whose ``top / bottom`` (``top`` alone if there is no bottom) is within ``low`` and ``high``."""

    name: str
    top: str
    bottom: str | None = None
    low: float | None = None
    high: float | None = None

    def ratio(self) -> Column:
        top = F.col(self.top).cast("double")
        # A ratio over nothing is 0.
        return top if self.bottom is None else F.when(F.col(self.bottom) > 0, top / F.col(self.bottom)).otherwise(0.0)

    def holds(self) -> Column:
        limits = [self.ratio() >= self.low] if self.low is not None else []
        limits += [self.ratio() <= self.high] if self.high is not None else []
        return reduce(lambda a, b: a & b, limits, F.lit(True))


RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.2),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
)


def _repeated_words(w: Column) -> Column:
    """Words inside three-word windows that stand twice or more in the text."""
    def in_windows(hashes: Column) -> Column:
        def covered(places: Column) -> Column:
            widths = F.transform(places, lambda p, i: F.when(
                i > 0, F.least(F.lit(3), p - F.get(places, i - 1))).otherwise(F.lit(3)))
            return F.aggregate(widths, F.lit(0).cast("bigint"), lambda total, n: total + n)

        def repeated(ordered: Column) -> Column:
            same = F.filter(ordered, lambda e, i: (e["h"] == F.get(ordered, i - 1)["h"])
                            | (e["h"] == F.get(ordered, i + 1)["h"]))
            return let(F.sort_array(F.transform(same, lambda e: e["p"])), covered)

        # The dearer way through sorted pairs is taken only by texts that repeat a window at all.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), repeated))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                          lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 3, F.lit(0).cast("bigint")).otherwise(let(windows, in_windows))


def text_counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the counts that rules are made of.

    ``_place`` is there for the optimizer only: a later filter on counts must not be moved below this projection, where it would
    compute every count anew.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    stop = F.array(*[F.lit(form) for s in STOP_WORDS for form in (s, s.capitalize())])
    split = docs.select(
        *keep, whole.alias("_text"), words(F.col(text)).alias("_words"),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("_lines"))

    def lines(condition) -> Column:
        return F.size(F.filter("_lines", condition)).cast("bigint")

    return split.select(
        *keep, F.monotonically_increasing_id().alias("_place"),
        F.size("_words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        lines(lambda line: line.rlike("(\\.\\.\\.|…)[ \\t-\\r]*$")).alias("n_ellipsis_lines"),
        lines(lambda line: line.rlike("^[ \\t-\\r]*[-*•]")).alias("n_bullet_lines"),
        # Distinct stop words that stand alone, in small letters or with a capital.
        F.size(F.array_intersect("_words", stop)).cast("bigint").alias("n_stop_words"),
    )


def judged(counts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``base_failed``, ``kept`` and ``failed_rules``, the names of the rules that do not hold."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    verdict = reduce(lambda a, b: a & b, [rule.holds() for rule in rules], F.lit(True))
    failed = F.concat_ws(",", *[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules])
    return counts.select("*", base.alias("base_failed"), (~base & verdict).alias("kept"), failed.alias("failed_rules"))


def quality(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
            rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and verdict of every document."""
    return judged(text_counts(docs, text, keep), rules).drop("_place")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    counts = text_counts(docs.select(row.alias("_doc"), F.col("text")), keep=("_doc",))
    return judged(counts, rules).where("kept and _place >= 0").select("_doc.*")
