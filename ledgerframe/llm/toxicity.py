"""Toxicity by a chain of linear classifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, slices, texts

# the chain, in order: flooding and shouting, abuse, both of them
CATEGORIES = ("disruptive", "toxic", "disruptive_toxic")
SAMPLE_ROWS = 6000
FOLDS = 4
MIN_DOCS = 5
STEPS = 100
PENALTY = 0.3
# standard deviations by which a feature must differ between the outcomes to be used
SIGNAL = 4.0
# the same, for all that is brought to the driver; the models' own folds decide after it
PRESCREEN = 2.0
CUT = 0.5
# log-odds are held within these bounds
ODDS = 12.0
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)


def categories(quality: str = "quality", toxic: str = "toxic") -> list[Column]:
    """The chain's targets from a table of labels."""
    low, bad = F.col(quality) == 0, F.col(toxic) == 1
    return [low.alias("disruptive"), bad.alias("toxic"), (low & bad).alias("disruptive_toxic")]


def _features(text: str) -> set[str]:
    """The distinct words of a text and their beginnings, so that unseen inflections of a
    known stem count."""
    words = set(WORD.findall(text.lower()))
    return words.union(*[{"^" + w[:k] for w in words if len(w) >= k} for k in STEMS]) if words else words


@dataclass
class Chain:
    """Weights by feature (a row) and category (a column); ``feed[k, j]`` is what category
    ``j``'s log-odds add to category ``k``."""

    names: Sequence[str]
    index: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    bias: np.ndarray = field(default_factory=lambda: np.empty(0))
    feed: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))

    def probabilities(self, text: str) -> list[float]:
        own = self.bias.copy()
        rows = [i for i in map(self.index.get, _features(text)) if i is not None]
        if rows:
            own += self.weights[rows].sum(axis=0)
        odds = np.zeros(len(self.names))
        for k in range(len(self.names)):
            odds[k] = np.clip(own[k] + self.feed[k, :k] @ odds[:k], -ODDS, ODDS)
        return (1 / (1 + np.exp(-odds))).tolist()


def _fit(rows: np.ndarray, cols: np.ndarray, extra: np.ndarray, target: np.ndarray, width: int, weight: np.ndarray):
    """L2-penalised logistic regression on binary features and dense extra ones.

    Only features are used that stand out among the rows of positive weight; the others
    keep weight 0. Accelerated gradient steps, each feature scaled by a bound of its
    curvature. A sample without both outcomes gives the constant of its smoothed share.
    """
    total = weight.sum()
    prior = float(np.log((weight @ target + 0.5) / (total - weight @ target + 0.5))) if total else -ODDS
    w, b, v = np.zeros(width), prior, np.zeros(extra.shape[1])
    if not total or not 0 < weight @ target < total:
        return w, b, v
    share = (weight @ target) / total
    seen = np.bincount(cols, weights=weight[rows], minlength=width)
    hits = np.bincount(cols, weights=(weight * target)[rows], minlength=width)
    telling = np.abs(hits - seen * share) > SIGNAL * np.sqrt(seen * share * (1 - share))
    use = (weight[rows] > 0) & telling[cols]
    rows, cols = rows[use], cols[use]
    size = np.bincount(rows, minlength=len(target)) + 1.0
    # a bound of the curvature, feature by feature
    curve = 0.25 * np.bincount(cols, weights=size[rows], minlength=width) + PENALTY
    curve_v = 0.25 * (weight @ (extra**2 * (size + extra.shape[1])[:, None])) + PENALTY
    curve_b = 0.25 * (weight @ (size + extra.shape[1]))
    look, t = (w, b, v), 1.0
    for _ in range(STEPS):
        odds = np.bincount(rows, weights=look[0][cols], minlength=len(target)) + look[1] + extra @ look[2]
        gap = weight * (1 / (1 + np.exp(-odds.clip(-30, 30))) - target)
        new = (
            look[0] - (np.bincount(cols, weights=gap[rows], minlength=width) + PENALTY * look[0]) / curve,
            look[1] - gap.sum() / curve_b,
            look[2] - (gap @ extra + PENALTY * look[2]) / curve_v,
        )
        ahead = (1 + (1 + 4 * t * t) ** 0.5) / 2
        pull = (t - 1) / ahead
        look = tuple(n + pull * (n - o) for n, o in zip(new, (w, b, v)))
        (w, b, v), t = new, ahead
    return w, b, v


def _odds(rows, cols, extra, fitted, n):
    w, b, v = fitted
    return (np.bincount(rows, weights=w[cols], minlength=n) + b + extra @ v).clip(-ODDS, ODDS)


def train(
    sample: list[tuple[int, Sequence[int], Sequence[bool]]], index: dict[str, int], names: Sequence[str] = CATEGORIES
) -> Chain:
    """Fit the chain on ``(fold, features, outcomes)`` rows; features by their number.

    A category's model sees the log-odds of the categories before it. For its training
    they come from models fitted without the row's fold, so that they are as uncertain as
    those of new texts; the model that is kept is fitted on all rows.
    """
    rows = np.repeat(np.arange(len(sample)), [len(features) for _, features, _ in sample])
    cols = np.fromiter((i for _, features, _ in sample for i in features), np.int64, len(rows))
    folds = np.array([fold for fold, _, _ in sample], np.int64)
    outcome = np.array([o for _, _, o in sample], float).reshape(len(sample), len(names))
    chain = Chain(names, index, np.zeros((len(index), len(names))), np.zeros(len(names)), np.zeros((len(names),) * 2))
    before = np.zeros((len(sample), 0))
    for k in range(len(names)):
        held_out = np.zeros(len(sample))
        for fold in np.unique(folds):
            seen = (folds != fold).astype(float)
            fitted = _fit(rows, cols, before, outcome[:, k], len(index), seen)
            held_out = np.where(folds == fold, _odds(rows, cols, before, fitted, len(sample)), held_out)
        w, b, v = _fit(rows, cols, before, outcome[:, k], len(index), np.ones(len(sample)))
        chain.weights[:, k], chain.bias[k], chain.feed[k, : len(v)] = w, b, v
        before = np.column_stack([before, held_out])
    used = np.abs(chain.weights).max(axis=1, initial=0) > 0
    chain.index = {f: n for n, f in enumerate(f for f, i in index.items() if used[i])}
    chain.weights = chain.weights[used]
    return chain


def fit_chain(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> Chain:
    """Fit the chain on ``labels`` (key, quality, toxic) and the texts they name.

    At most ``sample_rows`` labelled keys are used, those with the lowest hash; that
    bound is why they may be broadcast and brought to the driver. Labels with a NULL are
    left out, repeated ones are settled for the worse. Without usable labels every
    probability is next to 0.
    """
    label = labels.select(F.col(key).alias("doc_id"), "quality", "toxic").dropna()
    label = label.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    draw = label.orderBy(F.xxhash64("doc_id", F.lit(0)), "doc_id").limit(sample_rows)
    drawn = draw.select("doc_id", F.array(*[c.cast("boolean") for c in categories()]).alias("outcomes"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in texts(batches):
            found = pa.array([sorted(_features(t)) for t in values], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), found], ["fold", "outcomes", "features"])

    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(drawn), "doc_id")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")
    described = picked.select(fold.alias("fold"), "text", "outcomes").mapInArrow(
        describe, "fold int, outcomes array<boolean>, features array<string>"
    )
    # repeated rows of a key are one example
    sample = keep(described.distinct())
    index = {f: i for i, f in enumerate(_telling(sample))}
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches):
            found = [[known[f] for f in features if f in known] for features in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["fold", "outcomes", "features"]
            )

    numbered = sample.mapInArrow(number, "fold int, outcomes array<boolean>, features array<int>")
    # the order makes the sums repeatable
    rows = numbered.orderBy("fold", "outcomes", "features").collect()
    return train([(r["fold"], r["features"], r["outcomes"]) for r in rows], index)


def _telling(sample: DataFrame) -> list[str]:
    """Features of ``MIN_DOCS`` rows or more that stand out, if slightly, for a category."""
    hits = [F.sum(F.col("outcomes")[k].cast("long")).alias(f"h{k}") for k in range(len(CATEGORIES))]
    total = sample.agg(F.count(F.lit(1)).alias("n"), *hits).collect()[0]
    if not total["n"]:
        return []
    counts = sample.select("outcomes", F.explode("features").alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), *hits
    )
    tests = F.lit(False)
    for k in range(len(CATEGORIES)):
        share = total[f"h{k}"] / total["n"]
        spread = share * (1 - share)
        gap = F.col(f"h{k}") - F.col("n") * share
        tests = tests | (gap * gap > PRESCREEN**2 * F.col("n") * spread)
    return sorted(r["f"] for r in counts.filter((F.col("n") >= MIN_DOCS) & tests).select("f").collect())


def _with_probabilities(docs: DataFrame, chain: Chain, text: str) -> DataFrame:
    """All columns of ``docs`` and ``__p``, the array of probabilities. A narrow step."""
    cols = docs.columns
    at = cols.index(text)
    # bounded by the sample; plain values, which need no module on the executors
    sent = docs.sparkSession.sparkContext.broadcast(
        (list(chain.names), chain.index, chain.weights, chain.bias, chain.feed)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Chain(*sent.value)
        for batch in slices(batches):
            found = [model.probabilities(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.float64()))], [*cols, "__p"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, __p array<double>")


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """``(doc_id, p_<category>..., kept)`` of each whole text, one row per row.

    A text is kept unless its probability of ``toxic`` reaches ``cut``. NULL and empty
    texts have no features and get the prior. Other columns are ignored.
    """
    rows = _with_probabilities(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), chain, "text")
    named = [F.round(F.col("__p")[k], 6).alias(f"p_{name}") for k, name in enumerate(chain.names)]
    kept = F.col("__p")[list(chain.names).index("toxic")] < cut
    return rows.select("doc_id", *named, kept.alias("kept"))


def keep_clean(docs: DataFrame, chain: Chain, text: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` without the texts whose probability of ``toxic`` reaches ``cut``."""
    rows = _with_probabilities(docs, chain, text)
    return rows.filter(F.col("__p")[list(chain.names).index("toxic")] < cut).select(*docs.columns)
