"""Text quality from overlapping heuristics, without labels.

Heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation
over the patterns of votes estimates how far each labeller can be trusted and how likely
a document is good; these posteriors train a linear scorer on hashed word shapes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, body, keep, texts

ABSTAIN, BAD, GOOD = 0, 1, 2
ROUNDS = 50
LEAN = 0.05
# how often a labeller may call a good document bad: several kinds of bad documents are
# one class here, and the rarer ones would else pass for good ones that were misjudged
MAX_FALSE = 0.002
# words added to a text's length, so that a few words alone don't decide
SMOOTH_WORDS = 20
SAMPLE_ROWS = 6000
BUCKETS = 1 << 14
STEPS = 300
PENALTY = 1e-3
CUT = 0.5
LETTERS, DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")
REPEATED = re.compile(r"(.{1,3}?)\1+")
# longer words are described anew each time, so that what is remembered stays small
REMEMBERED_CHARS = 64


def measures(text: Column) -> dict[str, Column]:
    """What the labellers look at, but for equal words: counts over the whole text."""
    count = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]+", ""))
    matches = lambda p: F.size(F.regexp_extract_all(text, F.lit(p), F.lit(0)))
    words = F.split(F.trim(text), GAP)
    return {
        "words": F.greatest(F.size(words), F.lit(1)),
        "plain": matches(r"(?<!\S)\p{L}++[.,;:!?]?(?!\S)"),
        "visible": F.greatest(F.length(F.regexp_replace(text, GAP, "")), F.lit(1)),
        "alphanumeric": count(r"\p{L}\p{N}"),
        "letters": F.greatest(count(r"\p{L}"), F.lit(1)),
        "upper": count(r"\p{Lu}"),
        "ends": F.greatest(count(".!?…"), F.lit(1)),
        "symbols": count("#*$%&<>{}=\\\\^~"),
        "exclamations": count("!"),
        "separators": count("|»"),
    }


def votes(prefix: str = "m_") -> dict[str, Column]:
    """Each labeller's vote, from the measures as columns: 0 none, 1 bad, 2 good. Those who
    look at equal words vote where the words are at hand, see ``word_votes``."""
    m = {k: F.col(prefix + k) for k in measures(F.lit(""))}
    n, other = m["words"], m["visible"] - m["alphanumeric"]

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))

    return {
        "length": vote(F.lit(False), n >= 20),
        "plain_words": vote(m["plain"] * 10 < n * 6, m["plain"] * 10 >= n * 9),
        "other_characters": vote(other * 5 >= m["visible"], other * 10 < m["visible"]),
        "symbols": vote(m["symbols"] * 3 >= n, m["symbols"] * 20 < n),
        "shouting": vote(m["upper"] * 2 >= m["letters"], m["upper"] * 5 < m["letters"]),
        "exclamation": vote(m["exclamations"] * 3 >= n, m["exclamations"] * 20 < n),
        "separators": vote(m["separators"] * 5 >= n, m["separators"] * 50 < n),
        "sentences": vote(n > 100 * m["ends"], (n >= 3 * m["ends"]) & (n <= 60 * m["ends"])),
        "word_length": vote(
            (m["letters"] > 15 * n) | (m["letters"] < 2 * n), (m["letters"] >= 3 * n) & (m["letters"] <= 10 * n)
        ),
    }


def word_votes(words: list[str], doubled: int) -> tuple[int, int]:
    """The votes on variety and on doubled words: 0 none, 1 bad, 2 good."""
    n, distinct = max(len(words), 1), max(len(set(words)), 1)
    variety = BAD if n >= 50 and distinct * 10 < n else GOOD if distinct * 4 >= n else ABSTAIN
    doubling = BAD if doubled * 5 >= n else GOOD if doubled * 50 < n else ABSTAIN
    return variety, doubling


# labellers of both kinds
LABELLERS = 11


def _pattern() -> Column:
    """All votes on the measures as one number to the base of three."""
    out = F.lit(0)
    for v in votes().values():
        out = out * 3 + v
    return out.cast("int")


def posteriors(counts: dict[int, int], labellers: int, rounds: int = ROUNDS) -> dict[int, float]:
    """Probability of a good document for each pattern of votes.

    ``counts`` has how many documents show a pattern, all documents together. At the
    start two bad votes make a document bad, as heuristics speak up seldom; then the share of good documents and every
    labeller's chances to vote good, bad or not at all in either class are estimated from
    the posteriors, and the posteriors from them. The chances lean on a prior of right
    labellers that weighs as much as a twentieth of the documents, so that the classes
    stay good and bad and don't turn into some other split of the documents.
    """
    patterns = np.array(sorted(counts), np.int64)
    if not len(patterns):
        return {}
    weight = np.array([counts[p] for p in patterns.tolist()], float)
    vote = np.stack([patterns // 3**k % 3 for k in reversed(range(labellers))], axis=1)
    good = 1 / (1 + np.exp(3.0 * (vote == BAD).sum(axis=1) - 4.0))
    # chances to abstain, vote bad, vote good in the bad class and in the good one
    lean = np.array([[0.4, 0.4, 0.2], [0.3, 0.01, 0.69]]) * (weight.sum() * LEAN)
    for _ in range(rounds):
        share = np.stack([1 - good, good])  # class x pattern
        prior = np.log((share @ weight + 1) / (weight.sum() + 2))
        odds = np.repeat(prior[:, None], len(patterns), axis=1)
        for k in range(labellers):
            seen = np.stack([(share * weight) @ (vote[:, k] == v) for v in (ABSTAIN, BAD, GOOD)], axis=1) + lean
            chance = seen / seen.sum(axis=1, keepdims=True)
            chance[1, BAD] = min(chance[1, BAD], MAX_FALSE)
            odds += np.log(chance)[:, vote[:, k]]
        good = 1 / (1 + np.exp((odds[0] - odds[1]).clip(-50, 50)))
    return dict(zip(patterns.tolist(), good.tolist()))


# ---------------------------------------------------------------- scorer

def _shape(word: str) -> str:
    """A whole word with runs of letters as a, A or Aa and digits as 0; what repeats at
    once, up to three characters of it, stands once with a plus."""
    kind = lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a"
    return REPEATED.sub(r"\1+", DIGITS.sub("0", LETTERS.sub(kind, word)))


class Shapes:
    """Hashed features of texts: shares of word shapes, of doubled words, and the length."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _bucket(self, word: str) -> int:
        at = self.known.get(word)
        if at is None:
            if len(self.known) >= 200_000:
                self.known.clear()
            at = crc32(_shape(word).encode()) % BUCKETS
            if len(word) <= REMEMBERED_CHARS:
                self.known[word] = at
        return at

    def of(self, words: list[str], doubled: int) -> dict[int, float]:
        n = len(words) + SMOOTH_WORDS
        out = {b: c / n for b, c in Counter(map(self._bucket, words)).items()}
        for name, value in (
            (f"length {n.bit_length()}", 1.0),
            ("doubled", doubled / n),
        ):
            at = crc32(name.encode()) % BUCKETS
            out[at] = out.get(at, 0.0) + value
        return out


def fit_scorer(rows: list[tuple[list[int], list[float], float]]) -> np.ndarray:
    """Weights (the last is the bias) of a logistic model for soft targets."""
    w = np.zeros(BUCKETS + 1)
    if not rows:
        return w
    at = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    cols = np.array([b for r in rows for b in r[0]], np.int64)
    vals = np.array([v for r in rows for v in r[1]])
    target = np.array([r[2] for r in rows])
    curve = 0.25 * np.r_[np.bincount(cols, weights=3 * np.abs(vals), minlength=BUCKETS), 3.0 * len(rows)] / len(rows) + PENALTY
    before, t = w, 1.0
    look = w
    for _ in range(STEPS):
        odds = np.bincount(at, weights=vals * look[cols], minlength=len(rows)) + look[-1]
        gap = (1 / (1 + np.exp(-odds.clip(-30, 30))) - target) / len(rows)
        step = np.r_[np.bincount(cols, weights=vals * gap[at], minlength=BUCKETS) + PENALTY * look[:-1], gap.sum()]
        new = look - step / curve
        ahead = (1 + (1 + 4 * t * t) ** 0.5) / 2
        look = new + (t - 1) / ahead * (new - before)
        before, t = new, ahead
    return before


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, p_votes, score, kept)``, one row per row of ``docs``.

    ``p_votes`` is the posterior of the row's pattern of votes. The counts of patterns
    cover all documents; there are at most 3^11 of them, which is what reaches the driver
    and is joined back. The scorer is fitted on at most ``sample_rows`` distinct examples,
    those with the lowest hashes of key and text, and judges every whole text; a text is
    kept from a score of 0.5 on. NULL counts as empty; an empty text has the shape of no
    word and the length class of one. Other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    read = docs.select(F.col(key).alias("doc_id"), body(text).alias("text"))
    # two steps, so that every measure is taken once
    measured = read.select("*", *[c.alias(f"m_{k}") for k, c in measures(F.col("text")).items()])
    marked = measured.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"), _pattern().alias("pattern"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch, values in texts(batches):
            found, patterns = [], []
            for text, pattern in zip(values, batch.column(3).to_pylist()):
                words = text.split()
                doubled = sum(map(str.__eq__, words, words[1:]))
                variety, doubling = word_votes(words, doubled)
                patterns.append((pattern * 3 + variety) * 3 + doubling)
                found.append(sorted(shapes.of(words, doubled).items()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(patterns, pa.int32()),
                    pa.array([[b for b, _ in f] for f in found], pa.list_(pa.int32())),
                    pa.array([[v for _, v in f] for f in found], pa.list_(pa.float64())),
                ],
                ["doc_id", "h", "pattern", "buckets", "shares"],
            )

    # texts are read once; what is left of them is a few numbers each
    seen = keep(marked.mapInArrow(
        describe, f"doc_id {kind}, h bigint, pattern int, buckets array<int>, shares array<double>"
    ))
    counts = seen.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()
    good = posteriors({r["pattern"]: r["n"] for r in counts}, LABELLERS)
    low = seen.select("h").distinct().orderBy("h").limit(sample_rows).agg(F.max("h")).collect()[0][0]
    rows = seen.filter(F.col("h") <= F.lit(low)).select("pattern", "buckets", "shares").distinct()
    # the order makes the sums repeatable
    weights = fit_scorer(
        [(r["buckets"], r["shares"], good[r["pattern"]]) for r in rows.orderBy("pattern", "buckets", "shares").collect()]
    )
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            buckets, shares = batch.column(2), batch.column(3)
            at = np.repeat(np.arange(batch.num_rows), np.asarray(buckets.value_lengths()))
            parts = np.asarray(shares.flatten()) * w[np.asarray(buckets.flatten())]
            odds = w[-1] + np.bincount(at, weights=parts, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-odds.clip(-30, 30))), pa.float64())],
                ["doc_id", "pattern", "score"],
            )

    scored = seen.select("doc_id", "pattern", "buckets", "shares").mapInArrow(
        score, f"doc_id {kind}, pattern int, score double"
    )
    known = docs.sparkSession.createDataFrame(sorted(good.items()), "pattern int, p_votes double")
    return scored.join(F.broadcast(known), "pattern").select(
        "doc_id", F.round("p_votes", 6).alias("p_votes"), F.round("score", 6).alias("score"),
        (F.col("score") >= CUT).alias("kept"),
    )
