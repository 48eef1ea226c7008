"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Edge cases: a null or blank text has no words, so all measures are 0 and the document fails the base rules; repeated
rows are judged one by one; the projection adds its columns and passes all others on (a measure replaces an input
column of the same name); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, bind, words_of

#: Frequent function words of the four languages; fixed values.
STOP_WORDS = (
    "the of and to in a is that it for on was be as with by this are have from "
    "de la le et les des un une du que en il au est pour dans "
    "der die und das den ist ein nicht zu von mit sich dem im auf "
    "el los las y del se por con para es su lo como"
).split()


class Rule(NamedTuple):
    """A document passes if low <= measure <= high; a missing bound isn't tested."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The verdict: lengths, symbols, stop words and lines, as shares of words or lines.
RULES = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("words_per_line", 2.0, None),
)
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5


def _repeated_words(words: Column, n: int) -> Column:
    """How many words lie in an n-word window that the text holds twice or more.

    Windows are hashed; only a text with an equal pair sorts (hash, place), so the cost is linear for most texts and
    n log n for any.
    """
    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = bind(pairs, lambda s: F.filter(s, lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))))
        covered = F.aggregate(
            F.sort_array(F.transform(places, lambda e: e["i"])),
            F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(n), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)

    windows = F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, n)]))
    return bind(windows, count)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_stop_words")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The measured columns; words is a bound words_of(text)."""
    clean = F.coalesce(text, F.lit(""))
    n = F.size(words)
    lines = F.filter(F.split(clean, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return {
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.length(clean) - F.length(F.regexp_replace(clean, r"[#*$%&|<>]+", ""))).cast("long"),
        "n_dup_lines": bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_repeat_words": _repeated_words(words, WINDOW).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(F.btrim(w, F.lit(".,;:!?\"'()"))).isin(STOP_WORDS))).cast("long"),
    }


def ratios(m: Column) -> dict[str, Column]:
    """What the rules test, from a struct of measures."""
    per = lambda a, b: F.coalesce(F.try_divide(m[a].cast("double"), m[b]), F.lit(0.0))
    return {
        "mean_word_chars": per("word_chars", "n_words"),
        "symbol_ratio": per("n_symbols", "n_words"),
        "stop_word_ratio": (m["n_stop_words"] + 1) / (m["n_words"] + 1),  # one more, else a short text without any fails
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "words_per_line": per("n_words", "n_lines"),
    }


def compile_rules(rules: Sequence[Rule], m: Column) -> Column:
    """One boolean from the table."""
    known, verdict = ratios(m), F.lit(True)
    for rule in rules:
        if rule.low is not None:
            verdict &= known[rule.measure] >= rule.low
        if rule.high is not None:
            verdict &= known[rule.measure] <= rule.high
    return verdict


def quality(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """A struct of the measures, base_failed and kept: one expression, so that a filter on it evaluates it once."""

    def judge(m: Column) -> Column:
        failed = (m["n_words"] < MIN_WORDS) | (F.lit(100) * m["n_repeat_words"] > F.lit(MAX_REPEAT_PERCENT) * m["n_words"])
        return F.struct(*[m[c].alias(c) for c in MEASURES], failed.alias("base_failed"), (~failed & compile_rules(rules, m)).alias("kept"))

    return bind(bind(words_of(text), lambda w: F.struct(*[x.alias(c) for c, x in measures(text, w).items()])), judge)


def score_quality(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """docs with the measures, base_failed and kept; a narrow plan without shuffle."""
    added = [*MEASURES, "base_failed", "kept"]
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), quality(F.col(f"`{text_col}`"), rules).alias("judged"))
    return judged.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c not in added], *[F.col(f"judged.{c}").alias(c) for c in added])
