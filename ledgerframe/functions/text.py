"""Token and lexicon expressions; all of them stay on the JVM side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _col

WORD = "([a-zA-Z']+)"
# two or more letters, digits or underscores, in any script
TERM = r"([\p{L}\p{N}_]{2,})"


def words(text: Column | str) -> Column:
    """Lower-case ASCII words with apostrophes, in text order."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD), F.lit(1))


def terms(text: Column | str, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case terms of two or more characters, stop words taken out."""
    found = F.regexp_extract_all(F.lower(_col(text)), F.lit(TERM), F.lit(1))
    if not stop_words:
        return found
    return F.filter(found, lambda t: ~t.isin(*stop_words))


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring tokens joined by a blank; a run with a NULL is left out.

    Built from shifted copies of the array, so that no lambda looks back into the
    whole array for each element.
    """
    length = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
    shifted = [F.slice(tokens, F.lit(k + 1), length) for k in range(n)]
    blank = F.lit(" ")
    joined = reduce(
        lambda left, right: F.zip_with(left, right, lambda a, b: F.concat(a, blank, b)), shifted
    )
    return F.filter(joined, lambda g: g.isNotNull())


def lexicon_hits(
    tokens: Column,
    positive: Sequence[str],
    negative: Sequence[str],
    negations: Sequence[str],
    window: int,
) -> Column:
    """Struct ``(pos, neg)`` of lexicon hits.

    A hit is flipped when a negation stands among the ``window`` tokens before it. Words
    of no list are dropped first, the others keep their place and what they are in one
    number; the fold over these remembers the place of the last negation.
    """
    listed = sorted({*positive, *negative, *negations})

    def coded(word: Column, place: Column) -> Column:
        kind = F.when(word.isin(*positive), 1).when(word.isin(*negative), 2).otherwise(0)
        negation = F.when(word.isin(*negations), 4).otherwise(0)
        return F.when(word.isin(*listed), (place + 1).cast("long") * 8 + kind + negation)

    def step(acc: Column, code: Column) -> Column:
        place, kind = F.shiftright(code, 3), code.bitwiseAND(F.lit(3))
        negated = place - acc["last"] <= window
        up = ((kind == 1) & ~negated) | ((kind == 2) & negated)
        return F.struct(
            (acc["pos"] + up.cast("int")).alias("pos"),
            (acc["neg"] + ((kind > 0) & ~up).cast("int")).alias("neg"),
            F.when(code.bitwiseAND(F.lit(4)) > 0, place).otherwise(acc["last"]).alias("last"),
        )

    start = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("neg"), F.lit(-window).cast("long").alias("last"))
    hits = F.filter(F.transform(tokens, coded), lambda code: code.isNotNull())
    return F.aggregate(
        hits, start, step, lambda acc: F.struct(acc["pos"].alias("pos"), acc["neg"].alias("neg"))
    )


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas look at it again."""
    return F.element_at(F.transform(F.array(value), use), 1)
