"""Commentary text: tone, keywords and topics."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon
from ..functions.lineage import cut
from ..functions.numeric import safe_div
from ..functions.text import let, lexicon_hits, ngrams, terms, words


def tokens(docs: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    """Replace the text by its lower-case words."""
    rest = [c for c in docs.columns if c != text]
    return docs.select(*rest, words(text).alias(out))


def sentiment(
    docs: DataFrame,
    text: str,
    positive: Sequence[str] = lexicon.POSITIVE,
    negative: Sequence[str] = lexicon.NEGATIVE,
    negations: Sequence[str] = lexicon.NEGATIONS,
    window: int = 2,
    cut_at: float = 0.2,
    keep_text: bool = False,
) -> DataFrame:
    """Lexicon score and tone of each text; the text itself is dropped unless kept.

    The score is the balance of positive and negative hits, 0 without hits; a negation
    among the ``window`` words before a hit flips it. The tone is taken from the score
    before rounding. A narrow step: nothing is shuffled.
    """
    rest = [c for c in docs.columns if keep_text or c != text]
    hits = docs.select(
        *rest, lexicon_hits(words(text), positive, negative, negations, window).alias("h")
    ).select(*rest, F.col("h.pos").alias("pos"), F.col("h.neg").alias("neg"))
    score = F.coalesce(safe_div(F.col("pos") - F.col("neg"), F.col("pos") + F.col("neg")), F.lit(0.0))
    tone = F.when(F.col("s") > cut_at, "Positive").when(F.col("s") < -cut_at, "Negative")
    return hits.withColumn("s", score).select(
        *rest,
        F.bround("s", 3).alias("sentiment_score"),
        tone.otherwise("Neutral").alias("predicted_tone"),
        F.col("pos").alias("positive_hits"),
        F.col("neg").alias("negative_hits"),
    )


def label_match(scored: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Attach the authored label and whether the tone agrees with it, whatever the case."""
    same = F.lower("predicted_tone") == F.lower("authored_tone_label")
    return scored.join(labels.select(key, "authored_tone_label"), key, "left").withColumn(
        "match_authored_label", same
    )


def tone_agreement(matched: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of labelled texts whose tone agrees with the label."""
    return matched.groupBy(*by).agg(
        F.count("match_authored_label").alias("labelled"),
        F.sum(F.col("match_authored_label").cast("int")).alias("matched"),
        F.round(F.avg(F.col("match_authored_label").cast("int")), 9).alias("agreement"),
    )


# ---------------------------------------------------------------- TF-IDF

# hash slots in which the counts of words are summed; see vocabulary
SLOTS = 1 << 14


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def vocabulary(
    docs: DataFrame, text: str, stop: Sequence[str], max_features: int, sizes: tuple[int, int] = (1, 2)
) -> list[str]:
    """The ``max_features`` n-grams with the highest total count (ties: by term), sorted.

    An n-gram is at most as frequent as its rarest word. So with c the count of the
    ``max_features``-th most frequent word, every n-gram that can reach the vocabulary
    consists of words counted c times or more, and the hash slots of these are counted that
    often too. Only n-grams of such slots are counted; one byte per slot says which, whatever
    the number of words or of equal counts. All counts are exact.
    """
    found = docs.select(terms(text, stop).alias("u"))
    counts = cut(
        found.select(F.explode("u").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    )

    def top(counted: DataFrame) -> dict[str, int]:
        rows = counted.orderBy(F.desc("total"), "term").limit(max_features).collect()
        return {r["term"]: r["total"] for r in rows}

    best = top(counts)
    totals = best if sizes[0] == 1 else {}
    if sizes[1] > 1:
        least = min(best.values()) if len(best) == max_features else 0
        slot = F.pmod(F.xxhash64("term"), F.lit(SLOTS)).cast("int").alias("slot")
        often = counts.groupBy(slot).agg(F.sum("total").alias("total")).filter(F.col("total") >= least)
        flags = bytearray(SLOTS)
        for r in often.select("slot").collect():
            flags[r["slot"]] = 1
    for n in range(max(2, sizes[0]), sizes[1] + 1):
        length = F.greatest(F.size("u") - F.lit(n - 1), F.lit(0))
        shifted = [F.slice("u", F.lit(k + 1), length).alias(f"w{k}") for k in range(n)]
        runs = found.select(*shifted).select(F.inline(F.arrays_zip(*[f"w{k}" for k in range(n)])))
        for k in range(n):
            place = F.pmod(F.xxhash64(f"w{k}"), F.lit(SLOTS)).cast("int") + 1
            runs = runs.filter(F.substr(F.lit(flags), place, F.lit(1)) == F.lit(bytearray([1])))
        grams = runs.select(F.concat_ws(" ", *[f"w{k}" for k in range(n)]).alias("term"))
        totals = totals | top(grams.groupBy("term").agg(F.count(F.lit(1)).alias("total")))
    return sorted(sorted(totals, key=lambda t: (-totals[t], t))[:max_features])


def term_vectors(
    docs: DataFrame,
    key: str,
    text: str,
    stop_words: Sequence[str] | None = None,
    max_features: int = 200,
    sizes: tuple[int, int] = (1, 2),
) -> tuple[DataFrame, list[str]]:
    """``(key, features)``, each document's weights of the vocabulary, and the vocabulary.

    Stop words go first, then 1- and 2-grams are built. idf is ln((1+n)/(1+df)) + 1 and
    the weights of a document have length one; a document without any term has none.

    The vocabulary is counted when the function is called (``max_features`` terms reach
    the driver); it then meets each document in its row by a hashed lookup, without a
    shuffle of documents.
    """
    stop = list(default_stop_words() if stop_words is None else stop_words)
    listed = vocabulary(docs, text, stop, max_features, sizes)
    if not listed:
        return docs.select(key, array_to_vector(F.expr("CAST(array() AS array<double>)")).alias("features")), []
    grams = [ngrams(F.col("u"), n) if n > 1 else F.col("u") for n in range(sizes[0], sizes[1] + 1)]
    rows = docs.select(key, terms(text, stop).alias("u")).select(key, F.coalesce(F.concat(*grams), F.array()).alias("g"))
    # read again for the document frequencies and for the weights
    counted = cut(CountVectorizerModel.from_vocabulary(listed, "g", "tf").transform(rows).select(key, "tf"))
    seen = counted.select(Summarizer.metrics("numNonZeros", "count").summary(F.col("tf")).alias("s")).first()["s"]
    idf = [math.log((1 + seen["count"]) / (1 + df)) + 1 for df in seen["numNonZeros"]]
    raw = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="raw").transform(counted)
    scaled = Normalizer(p=2.0, inputCol="raw", outputCol="features").transform(raw)
    return scaled.select(key, "features"), listed


def term_weights(
    docs: DataFrame,
    key: str,
    text: str,
    stop_words: Sequence[str] | None = None,
    max_features: int = 200,
    sizes: tuple[int, int] = (1, 2),
) -> DataFrame:
    """``(key, w)``: ``term_vectors`` as an array of structs (term, idx, weight) in each row.

    ``idx`` numbers the vocabulary alphabetically; weights of 0 are left out.
    """
    return listed_weights(*term_vectors(docs, key, text, stop_words, max_features, sizes), key)


def listed_weights(vectors: DataFrame, listed: Sequence[str], key: str) -> DataFrame:
    """``(key, w)`` from ``term_vectors``."""
    if not listed:
        none = F.expr("CAST(array() AS array<struct<term:string,idx:int,weight:double>>)")
        return vectors.select(key, none.alias("w"))
    names, places = F.lit(list(listed)), F.lit(list(range(len(listed))))

    def named(weights: Column) -> Column:
        own = F.filter(places, lambda i: F.get(weights, i) > 0)
        return F.transform(own, lambda i: F.struct(
            F.get(names, i).alias("term"), i.alias("idx"), F.get(weights, i).alias("weight")
        ))

    return vectors.select(key, let(vector_to_array("features"), named).alias("w"))


def tfidf(
    docs: DataFrame,
    key: str,
    text: str,
    stop_words: Sequence[str] | None = None,
    max_features: int = 200,
    sizes: tuple[int, int] = (1, 2),
) -> DataFrame:
    """``term_weights`` with one row per document and term: key, term, idx, weight."""
    rows = term_weights(docs, key, text, stop_words, max_features, sizes)
    return rows.select(key, F.explode("w").alias("x")).select(key, "x.*")


def row_top_terms(rows: DataFrame, key: str, k: int = 5, sep: str = ", ", digits: int = 9) -> DataFrame:
    """The ``k`` heaviest terms of each row of ``term_weights`` as one string, weights
    that agree in ``digits`` digits by term. Documents without terms are left out."""
    ranked = F.array_sort(F.transform("w", lambda x: F.struct(
        (-F.round(x["weight"], digits)).alias("r"), x["term"].alias("term")
    )))
    top = F.transform(F.slice(ranked, 1, k), lambda x: x["term"])
    return rows.filter(F.size("w") > 0).select(key, F.array_join(top, sep).alias("top_keywords"))


def top_terms(weights: DataFrame, key: str, k: int = 5, sep: str = ", ") -> DataFrame:
    """The ``k`` heaviest terms of each document as one string, equal weights by term."""
    order = Window.partitionBy(key).orderBy(F.desc("weight"), "term")
    kept = weights.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
    return kept.groupBy(key).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("r", "term"))), lambda x: x["term"]),
            sep,
        ).alias("top_keywords")
    )


# ---------------------------------------------------------------- topics

# Weights and distances are counted in whole units, so that sums and ties do not depend on
# the order of the rows.
WEIGHT_UNITS = 1_000_000
DISTANCE_UNITS = 1_000_000_000


def _whole_weights(vectors: DataFrame, key: str) -> DataFrame:
    """``(key, idx, x)``: the places and whole weights of each row's terms."""
    whole = F.transform(vector_to_array("features"), lambda v: F.round(v * WEIGHT_UNITS).cast("long"))
    places = let(whole, lambda w: F.struct(
        F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i) > 0).alias("idx"),
        F.filter(w, lambda v: v > 0).alias("x"),
    ))
    return vectors.select(key, places.alias("c")).select(key, "c.idx", "c.x")


def _first_documents(points: DataFrame, key: str, k: int, starts: int, seed: int) -> DataFrame:
    """The ``k`` documents each start begins with: those of the lowest hash."""
    name = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"))
    drawn = points.select(
        key, "idx", "x", F.explode(F.sequence(F.lit(seed), F.lit(seed + starts - 1))).alias("start")
    ).withColumn("h", F.md5(F.concat(name, F.col("start").cast("string"))))
    order = Window.partitionBy("start").orderBy("h", key)
    return drawn.withColumn("c", F.row_number().over(order) - 1).filter(F.col("c") < k)


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Whole squared distances to all centroids, less the row's own square."""
    products = x @ centroids.reshape(-1, centroids.shape[-1]).T / WEIGHT_UNITS
    apart = (centroids**2).sum(axis=2).reshape(-1) - 2 * products
    return np.rint(apart * DISTANCE_UNITS).reshape(len(x), *centroids.shape[:2])


def _dense(batch: pa.RecordBatch, size: int) -> np.ndarray:
    idx, x = batch.column("idx"), batch.column("x")
    row = np.repeat(np.arange(batch.num_rows), np.diff(idx.offsets.to_numpy()))
    out = np.zeros((batch.num_rows, size))
    out[row, idx.flatten().to_numpy()] = x.flatten().to_numpy()
    return out


def fit_topics(
    points: DataFrame, key: str, size: int, k: int = 5, starts: int = 10, seed: int = 42, rounds: int = 10
) -> tuple[np.ndarray, int]:
    """Centroids after Lloyd's rounds from several starts, and the cheapest start.

    All starts run at once: a round is one pass over the rows and one aggregation of
    ``starts * k * size`` whole numbers. A cluster that loses all its rows keeps its
    centroid; equal distances go to the first cluster, equal costs to the first start.
    """
    begun = _first_documents(points, key, k, starts, seed).select("start", "c", "idx", "x").collect()
    centroids = np.zeros((starts, max((r["c"] for r in begun), default=-1) + 1, size))
    for r in begun:
        centroids[r["start"] - seed, r["c"], r["idx"]] = np.array(r["x"], float) / WEIGHT_UNITS
    if not begun:
        return centroids, 0

    def summed(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums and numbers of rows of each cluster, and the cost of each start."""
        shape = (*centroids.shape[:2], size + 2)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = np.zeros(shape)
            for batch in batches:
                x = _dense(batch, size)
                apart = _distances(x, centroids)
                own = apart.argmin(axis=2)
                for s in range(shape[0]):
                    chosen = (own[:, s, None] == np.arange(shape[1])).astype(float)
                    cells[s, :, :size] += chosen.T @ x
                    cells[s, :, size] += chosen.sum(axis=0)
                    cells[s, 0, size + 1] += apart[:, s].min(axis=1).sum()
            at = np.nonzero(cells.reshape(-1))[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(cells.reshape(-1)[at].astype(np.int64))], ["cell", "value"]
            )

        found = points.mapInArrow(run, "cell bigint, value bigint").groupBy("cell").agg(F.sum("value").alias("value"))
        cells = np.zeros(np.prod(shape))
        for r in found.collect():
            cells[r["cell"]] = r["value"]
        cells = cells.reshape(shape)
        return cells[..., :size], cells[..., size], cells[:, 0, size + 1]

    for _ in range(rounds):
        sums, counts, _ = summed(centroids)
        filled = np.maximum(counts, 1)[..., None] * WEIGHT_UNITS
        moved = np.where(counts[..., None] > 0, sums / filled, centroids)
        if np.array_equal(moved, centroids):
            break
        centroids = moved
    return centroids, int(np.argmin(summed(centroids)[2]))


def topics(
    vectors: DataFrame,
    key: str,
    listed: Sequence[str],
    k: int = 5,
    starts: int = 10,
    seed: int = 42,
    top: int = 6,
    sep: str = ", ",
) -> tuple[DataFrame, DataFrame]:
    """Cluster of each document of ``term_vectors``, and the clusters' labels.

    A label is the ``top`` heaviest terms of the centroid, equal ones by term.
    """
    points = cut(_whole_weights(vectors, key))
    centroids, best = fit_topics(points, key, len(listed), k, starts, seed)
    chosen = centroids[best : best + 1]
    kind = points.schema[key].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _distances(_dense(batch, len(listed)), chosen)[:, 0].argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.astype(np.int32))], [key, "topic_cluster"])

    labels = []
    for c, centre in enumerate(chosen[0]):
        heavy = sorted((-round(float(v), 9), listed[i]) for i, v in enumerate(centre) if v > 0)
        labels.append((c, sep.join(t for _, t in heavy[:top])))
    named = vectors.sparkSession.createDataFrame(labels, "topic_cluster int, topic_cluster_label string")
    return points.mapInArrow(assign, f"`{key}` {kind}, topic_cluster int"), named


def topic_summary(scored: DataFrame) -> DataFrame:
    """Size and mean score of each topic."""
    return scored.groupBy("topic_cluster", "topic_cluster_label").agg(
        F.count(F.lit(1)).alias("comment_count"),
        F.avg("sentiment_score").alias("avg_sentiment"),
    )
