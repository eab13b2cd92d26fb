"""Quality rules that clean lines first and judge the document by what is lost."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, SPACES, body, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 40
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
BOILERPLATE_WORDS = 30
LONG_LINE_WORDS = 40
# phrases of notices, menus and licences; only in short lines they make the line one
BOILERPLATE = (
    "all rights reserved|licensed under|privacy policy|terms of (use|service)|cookie policy|"
    "accept (all )?cookies|powered by|subscribe (to|now)|click here|sign in|log in|"
    "copyright (\\(c\\)|©)|share (this|on)"
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas look at it again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _count(text: Column, chars: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def repeat_words(tokens: Column, size: int = 3) -> Column:
    """Words covered by a run of ``size`` words that occurs twice or more in ``tokens``.

    Runs are sorted with their places, so equal ones become neighbours. Texts without
    any equal runs, the usual case, are not sorted.
    """
    length = F.greatest(F.size(tokens) - (size - 1), F.lit(0))
    runs = F.slice(tokens, 1, length)
    for k in range(1, size):
        runs = F.zip_with(runs, F.slice(tokens, k + 1, length), lambda a, b: F.concat(a, F.lit(" "), b))

    def covered(runs: Column) -> Column:
        placed = F.array_sort(F.transform(runs, lambda run, at: F.struct(run.alias("run"), at.alias("at"))))

        def pairs(placed: Column) -> Column:
            n = F.size(placed) - 1
            none = F.array().cast("array<int>")
            return F.array_distinct(F.flatten(F.zip_with(
                F.slice(placed, 1, n), F.slice(placed, 2, n),
                lambda p, q: F.when(p["run"] == q["run"], F.array(p["at"], q["at"])).otherwise(none),
            )))

        places = F.flatten(F.transform(
            _let(placed, pairs), lambda at: F.array(*[at + k for k in range(size)])
        ))
        return F.when(
            F.size(F.array_distinct(runs)) < F.size(runs), F.size(F.array_distinct(places))
        ).otherwise(0)

    return _let(runs, covered)


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks a rule.

    Punctuation: symbols or exclamation marks for every second word, or a long line
    without the end of a sentence. Navigation: separators for every fourth word, two at
    least. Boilerplate: a known phrase in a short line.
    """
    def judge(n: Column) -> Column:
        marks = 2 * _count(line, SYMBOLS.replace("|", "")) >= n
        shout = 2 * _count(line, "!") >= n
        endless = (n >= LONG_LINE_WORDS) & ~line.rlike("[.!?…。؟।]")
        separators = _count(line, SEPARATORS)
        menu = (separators >= 2) & (4 * separators >= n)
        notice = (n <= BOILERPLATE_WORDS) & line.rlike(f"(?i){BOILERPLATE}")
        return (marks & (n > 1)) | (shout & (n > 1)) | endless | menu | notice

    return _let(F.size(words(line)), judge)


def judge_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per row of ``docs``: counts of the whole text, and the verdict.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` (lines with a word, equal
    to an earlier one) and ``n_repeat_words`` describe the text; ``base_failed`` is too
    few words, or too many of them repeated. Then each line with a word is judged; the
    lines that fail are taken out (``cleaned``, if asked for, holds the others), and a
    document that loses more than 40 % of its word characters this way is not ``kept``.
    NULL and empty texts have no words and fail. A narrow step: every text is judged in
    its row, whatever its length; other columns are ignored.
    """
    def_lines = F.filter(F.split("t", "\n", -1), lambda line: line.rlike(f"[^{SPACES}]"))
    read = docs.select(F.col(key).alias("doc_id"), body(text).alias("t"))
    judged = read.select(
        "doc_id",
        _let(words(F.col("t")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
        )).alias("w"),
        F.length(F.regexp_replace("t", GAP, "")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _let(def_lines, lambda lines: F.struct(
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            F.filter(lines, lambda line: ~line_fails(line)).alias("left"),
        )).alias("l"),
    )
    cleaned = F.array_join("l.left", "\n")
    base_failed = (F.col("w.n_words") < MIN_WORDS) | (
        100 * F.col("w.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("w.n_words")
    )
    lost = F.col("word_chars") - F.col("cleaned_chars")
    return judged.select(
        "doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
        base_failed.alias("base_failed"), "l.n_lines",
        (F.col("l.n_lines") - F.size("l.left")).alias("n_failed_lines"),
        F.length(F.regexp_replace(cleaned, GAP, "")).cast("long").alias("cleaned_chars"),
        *([cleaned.alias("cleaned")] if with_text else []),
    ).withColumn("kept", ~F.col("base_failed") & (100 * lost <= MAX_LOST_PERCENT * F.col("word_chars")))
