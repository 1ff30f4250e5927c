"""Quality rules: a threshold table compiled into one projection, without user functions."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldhaul.llm.common import WORD, bound

# Very frequent function words of the four languages.
STOP_WORDS = {
    "en": "the of and to in is that for it as was with be by on are this from at have",
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine",
    "fr": "de la le et les des en un du une que est pour qui dans par plus sur",
    "es": "de la que el en y los del se las por un para con no una su",
}
BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Up to so many repeated windows are looked up one by one; this changes the way, not the result.
FEW = 24


class Rule(NamedTuple):
    """``low <= part / whole <= high``; a whole of 0 passes."""
    name: str
    part: str
    whole: str
    low: float | None
    high: float | None


#: The threshold table. Parts and wholes name measures of ``measures``.
RULES = [
    Rule("word_length", "word_chars", "n_words", 2.0, 16.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.25),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.02, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.50),
]


def stop_forms() -> list[str]:
    """The stop words as they stand in texts: in lower case or capitalised, with or without a closing mark."""
    words = {w for of in STOP_WORDS.values() for w in of.split()}
    return sorted(w + mark for w in words | {w.capitalize() for w in words} for mark in ("", ".", ","))


def _covered(at: Column) -> Column:
    """The words in the windows that start at the ascending places ``at``: the way to the next start, 3 at most."""
    steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
    return F.aggregate(steps, F.lit(0), lambda total, x: total + x)


def _repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window that the text holds twice or more.

    Windows are compared by a 64-bit hash of their words. Sorted, equal neighbours are the hashes found more than
    once. If they are few, as in prose, windows are looked up among them; else the places are sorted with the hashes.
    """
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.xxhash64(
        F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))

    def by_lookup(h: Column, twice: Column) -> Column:
        return bound(F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(twice, F.get(h, i))), _covered)

    def by_sorting(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))

        def starts(s: Column) -> Column:
            same = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["hash"] == x["hash"], F.lit(False))
                            | F.coalesce(F.get(s, i + 1)["hash"] == x["hash"], F.lit(False)))
            return F.sort_array(F.transform(same, lambda x: x["at"]))

        return bound(bound(placed, starts), _covered)

    def found(h: Column) -> Column:
        twice = bound(F.sort_array(h), lambda s: F.filter(s, lambda x, i: F.get(s, i + 1) == x))
        return bound(F.array_distinct(twice), lambda t: F.when(F.size(t) == 0, F.lit(0)).when(
            F.size(t) <= FEW, by_lookup(h, t)).otherwise(by_sorting(h)))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bound(hashes, found))


def measures(text: Column) -> Column:
    """A struct of the counts of one text, each long."""
    stop = stop_forms()

    def of_words(w: Column) -> list[Column]:
        return [F.size(w).alias("n_words"), _repeated_words(w).alias("n_repeat_words"),
                F.size(F.filter(w, lambda x: x.isin(stop))).alias("n_stop_words")]

    def of_lines(x: Column) -> list[Column]:
        return [F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")]

    def counts(t: Column) -> Column:
        words = bound(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.struct(*of_words(w)))
        lines = bound(F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)), lambda x: F.struct(*of_lines(x)))
        return F.struct(words.alias("words"), lines.alias("lines"), F.struct(
            F.regexp_count(t, F.lit(SYMBOLS)).alias("n_symbols"),
            (F.length(t) - F.regexp_count(t, F.lit(BLANK))).alias("word_chars")).alias("text"))

    names = {"words": ["n_words", "n_repeat_words", "n_stop_words"], "lines": ["n_lines", "n_dup_lines"],
             "text": ["n_symbols", "word_chars"]}
    return bound(bound(F.coalesce(text, F.lit("")), counts), lambda m: F.struct(
        *[m[part][name].cast("long").alias(name) for part, of in names.items() for name in of]))


def verdicts(m: Column, rules: list[Rule] = RULES) -> list[Column]:
    """One boolean per rule of the table: whether the measures keep it."""
    columns = []
    for rule in rules:
        part, whole = m[rule.part].cast("double"), m[rule.whole].cast("double")
        kept = F.lit(True)
        if rule.low is not None:
            kept = kept & (part >= whole * F.lit(rule.low))
        if rule.high is not None:
            kept = kept & (part <= whole * F.lit(rule.high))
        columns.append(kept.alias(rule.name))
    return columns


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def passes(m: Column, rules: list[Rule] = RULES) -> Column:
    """Whether a text of these measures is kept."""
    return reduce(lambda a, b: a & b, verdicts(m, rules), ~base_failed(m))


def judge(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept and ``failed_rules``.

    A null or empty text has no words, all counts are 0, and it fails the base. Repeated rows and ids are
    judged row by row. An empty table gives no rows; other columns are ignored. A text is judged whole, by one task;
    no row meets another, so nothing is shuffled.
    """
    measured = docs.select("doc_id", measures(F.col("text")).alias("m"))
    m = F.col("m")
    checks = verdicts(m, rules)
    broken = F.filter(F.array(*[F.when(~c, F.lit(r.name)) for c, r in zip(checks, rules)]), lambda x: x.isNotNull())
    return measured.select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        base_failed(m).alias("base_failed"), passes(m, rules).alias("kept"),
        broken.alias("failed_rules"), "m.n_lines", "m.n_stop_words")
