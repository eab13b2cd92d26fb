"""Commentary operators against plain Python on small texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerframe.functions import lexicon
from ledgerframe.functions.text import ngrams
from ledgerframe.operators import commentary, linkage


def plain_score(text, pos, neg, negations, window=2):
    words = re.findall(r"[a-zA-Z']+", text.lower())
    up = down = 0
    for i, w in enumerate(words):
        flipped = any(x in negations for x in words[max(0, i - window):i])
        if w in pos:
            up, down = up + (not flipped), down + flipped
        elif w in neg:
            up, down = up + flipped, down + (not flipped)
    return up, down


def score(spark, texts, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return {r["id"]: r for r in commentary.sentiment(docs, "text", **kw).collect()}


@pytest.mark.parametrize("window", [1, 2, 3])
def test_random_texts(spark, window):
    rng = random.Random(7)
    pool = ["strong", "growth", "risk", "weak", "not", "no", "the", "plan", "miss", "grew", "a"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(200)]
    got = score(spark, texts, window=window)
    for i, t in enumerate(texts):
        want = plain_score(t, lexicon.POSITIVE, lexicon.NEGATIVE, lexicon.NEGATIONS, window)
        assert (got[i]["positive_hits"], got[i]["negative_hits"]) == want


def test_edge_texts(spark):
    texts = [
        "not strong", "no real growth", "not a very strong", "over budget", "", "growth",
        "Strong, STRONG; strong!", " ".join(["strong"] * 17 + ["risk"] * 15),
    ]
    got = score(spark, texts)
    hits = [(got[i]["positive_hits"], got[i]["negative_hits"]) for i in range(len(texts))]
    assert hits == [(0, 1), (0, 1), (1, 0), (0, 0), (0, 0), (1, 0), (3, 0), (17, 15)]
    assert got[4]["sentiment_score"] == 0.0 and got[4]["predicted_tone"] == "Neutral"
    # 2 / 32 = 0.0625 rounds to even
    assert got[7]["sentiment_score"] == 0.062
    assert got[0]["predicted_tone"] == "Negative"


def test_a_word_in_several_lists(spark):
    lists = dict(positive=("up", "no"), negative=("up", "down"), negations=("no",))
    texts = ["up", "no up", "no no up", "down no down down down"]
    got = score(spark, texts, **lists)
    for i, t in enumerate(texts):
        want = plain_score(t, lists["positive"], lists["negative"], lists["negations"])
        assert (got[i]["positive_hits"], got[i]["negative_hits"]) == want


def test_label_agreement(spark):
    docs = spark.createDataFrame(
        [(1, "strong"), (2, "weak"), (3, "plain"), (4, "strong")], "id int, text string"
    )
    labels = spark.createDataFrame(
        [(1, "POSITIVE"), (2, "positive"), (3, "neutral")], "id int, authored_tone_label string"
    )
    matched = commentary.label_match(commentary.sentiment(docs, "text"), labels, "id")
    row = commentary.tone_agreement(matched).collect()[0]
    assert (row["labelled"], row["matched"]) == (3, 2)


def test_ngrams(spark):
    row = spark.range(1).select(
        F.array(*[F.lit(x) for x in "abc"]).alias("u"),
        F.array(F.lit("a"), F.lit(None).cast("string"), F.lit("c"), F.lit("d")).alias("gap"),
        F.array(F.lit("a")).alias("one"),
    ).select(
        ngrams(F.col("u"), 2), ngrams(F.col("u"), 3), ngrams(F.col("gap"), 2),
        ngrams(F.col("one"), 2), ngrams(F.col("gap"), 1),
    ).first()
    assert [list(x) for x in row] == [["a b", "b c"], ["a b c"], ["c d"], [], ["a", "c", "d"]]


def plain_tfidf(texts, stop, size):
    grams = []
    for t in texts:
        u = [w for w in re.findall(r"\w\w+", t.lower()) if w not in stop]
        grams.append(Counter(u + [f"{a} {b}" for a, b in zip(u, u[1:])]))
    total = Counter()
    for g in grams:
        total.update(g)
    vocab = {t for t, _ in sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))[:size]}
    df = Counter(t for g in grams for t in g if t in vocab)
    out = {}
    for i, g in enumerate(grams):
        raw = {t: n * (math.log((1 + len(texts)) / (1 + df[t])) + 1)
               for t, n in g.items() if t in vocab}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, t): v / norm for t, v in raw.items()})
    return out


@pytest.mark.parametrize("size", [5, 12, 40, 500])
def test_tfidf(spark, size):
    rng = random.Random(size)
    pool = ["plan", "cost", "team", "über", "année", "q3", "x", "the", "grew", "risk", "deal", "fee"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 25))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = commentary.tfidf(docs, "id", "text", ["the"], size).collect()
    got = {(r["id"], r["term"]): r["weight"] for r in rows}
    assert got == pytest.approx(plain_tfidf(texts, {"the"}, size), rel=1e-12)


def test_top_terms_break_ties_by_term(spark):
    rows = [(1, "b", 0.5), (1, "a", 0.5), (1, "c", 0.7), (2, "z", 0.1)]
    weights = spark.createDataFrame(rows, "id int, term string, weight double")
    got = {r["id"]: r["top_keywords"] for r in commentary.top_terms(weights, "id", 2).collect()}
    assert got == {1: "c, a", 2: "z"}


def test_default_stop_words(spark):
    assert {"the", "not"} <= set(commentary.default_stop_words())


def test_mode_tie_takes_the_smallest(spark):
    rows = [("q", "c", 1.0, "Positive"), ("q", "c", -1.0, "Negative")]
    scored = spark.createDataFrame(
        rows, "fiscal_quarter string, cost_center string, sentiment_score double, "
              "predicted_tone string",
    )
    assert linkage.quarterly_sentiment(scored).first()["predicted_tone_mode"] == "Negative"


def test_constant_tone_has_no_correlation(spark):
    pairs = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "x double, y double")
    assert linkage.correlation(pairs, "x", "y").first()["correlation"] is None
    two = pairs.limit(2)
    assert linkage.correlation(two, "y", "y").first()["correlation"] is None
    assert linkage.ols(pairs, "y", "x").first()["slope"] is None


def test_many_equal_counts(spark):
    texts = ["aa bb cc dd ee", "ff gg", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {(r["id"], r["term"]): r["weight"] for r in commentary.tfidf(docs, "id", "text", [], 2).collect()}
    assert got == pytest.approx(plain_tfidf(texts, set(), 2), rel=1e-12)


def plain_lloyd(x, names, k, starts, seed, rounds):
    """Centroid rows and the cheapest start, by plain loops over whole weights."""
    whole = np.rint(x * 1e6)
    best = None
    for s in range(seed, seed + starts):
        order = sorted(range(len(x)), key=lambda i: (hashlib.md5(f"{names[i]}:{s}".encode()).hexdigest(), names[i]))
        centres = [whole[i] / 1e6 for i in order[:k]]
        for last in [False] * rounds + [True]:
            apart = [[round((float(c @ c) - 2 * float(w @ c) / 1e6) * 1e9) for c in centres] for w in whole]
            own = [row.index(min(row)) for row in apart]
            if last:
                break
            for c in range(len(centres)):
                rows = [w for w, o in zip(whole, own) if o == c]
                if rows:
                    centres[c] = sum(rows) / (len(rows) * 1e6)
        cost = sum(map(min, apart))
        if best is None or cost < best[0]:
            best = cost, s - seed, centres, own
    return best[1:]


@pytest.mark.parametrize("k, starts, seed", [(3, 4, 42), (5, 2, 7)])
def test_topics_agree_with_plain_loops(spark, k, starts, seed):
    rng = random.Random(k)
    pools = [["plan", "cost", "team"], ["risk", "deal", "fee"], ["growth", "price", "sales", "cost"]]
    texts = [" ".join(rng.choices(rng.choice(pools), k=rng.randint(0, 12))) for _ in range(60)]
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "id string, text string").repartition(4)
    vectors, listed = commentary.term_vectors(docs, "id", "text", [], 20)
    rows = vectors.collect()
    x = np.array([r["features"].toArray() for r in rows])
    best, centres, own = plain_lloyd(x, [r["id"] for r in rows], k, starts, seed, 10)
    clusters, labels = commentary.topics(vectors, "id", listed, k, starts, seed)
    assert {r["id"]: r["topic_cluster"] for r in clusters.collect()} == dict(zip([r["id"] for r in rows], own))
    named = {r["topic_cluster"]: r["topic_cluster_label"] for r in labels.collect()}
    for c, centre in enumerate(centres):
        heavy = sorted((-round(float(v), 9), listed[i]) for i, v in enumerate(centre) if v > 0)
        assert named[c] == ", ".join(t for _, t in heavy[:6])


def test_topics_of_few_documents_and_of_none(spark):
    docs = spark.createDataFrame([(1, "plan plan"), (2, ""), (3, None)], "id int, text string")
    vectors, listed = commentary.term_vectors(docs, "id", "text", [], 20)
    clusters, _ = commentary.topics(vectors, "id", listed)
    assert {r["id"] for r in clusters.collect()} == {1, 2, 3}
    vectors, listed = commentary.term_vectors(docs.limit(0), "id", "text", [], 20)
    clusters, labels = commentary.topics(vectors, "id", listed)
    assert listed == [] and clusters.count() == 0 and labels.count() == 0
