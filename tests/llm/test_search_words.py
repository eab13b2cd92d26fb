"""Nearest neighbours, spelling variants and source divergence against brute force and SQL."""

import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from ledgerframe.llm import divergence, forest, spelling
from ledgerframe.llm.queries import QUERIES
from test_llm import MIDDLE, SMALL, docs_of, norm, sql

VECTORS = "vec_id long, embedding array<float>, score double, part int, rank int"


# ---------------------------------------------------------------- nearest neighbours

def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0.0, 1, 2) for i, v in rows], VECTORS)


def brute_nearest(rows, every=20, n=20):
    first = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            first[i] = min(first.get(i, v), v)
    size = max((len(v) for v in first.values()), default=0)
    padded = {i: [np.float64(np.float32(x)) for x in v] + [0.0] * (size - len(v)) for i, v in first.items()}
    out = []
    for q, x in padded.items():
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in padded.items() if i != q)
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:n])]
    return sorted(out)


def rows_of(found):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())


def recall(got, want):
    near = defaultdict(set)
    for q, _, i, _ in got:
        near[q].add(i)
    return np.mean([i in near[q] for q, _, i, _ in want])


def test_neighbours_of_the_given_table(spark):
    table = pd.read_parquet(f"{MIDDLE}/embeddings.parquet")
    want = brute_nearest(list(zip(table.vec_id.tolist(), table.embedding.map(list))))
    got = rows_of(QUERIES["op11_neighbours"](spark, MIDDLE))
    assert recall(got, want) >= 0.9
    exact = {(q, i): s for q, _, i, s in want}
    assert all(exact[q, i] == s for q, _, i, s in got if (q, i) in exact)
    assert Counter(q for q, *_ in got) == Counter(q for q, *_ in want)


def test_neighbours_of_odd_vectors_are_exact(spark):
    """Fewer rows than any ascent stops at: all are candidates."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(5).astype(np.float32).tolist()) for i in range(12)]
    rows += [(40, rows[3][1]), (60, rows[3][1]), (41, rows[3][1]), (41, rows[3][1]), (42, [2.0] * 5), (42, [1.0] * 5)]
    rows += [(80, None), (100, [0.0] * 5), (120, [1.0, None, 1.0, 1.0, 1.0]), (140, [float("nan")] * 5), (160, [float("inf")] + [1.0] * 4)]
    rows += [(None, [1.0] * 5), (180, []), (200, [3.0, 1.0]), (220, [50.0, -20.0, 0.5, 0.0, 1.0])]
    got = rows_of(forest.nearest(vectors_of(spark, rows)))
    assert [r[:3] for r in got] == [r[:3] for r in brute_nearest(rows)]
    assert np.allclose([r[3] for r in got], [r[3] for r in brute_nearest(rows)], rtol=1e-15)
    assert {q for q, *_ in got} == {0, 40, 60, 200, 220}


def test_neighbours_of_empty_tables_and_single_rows(spark):
    assert forest.nearest(vectors_of(spark, [])).count() == 0
    assert forest.nearest(vectors_of(spark, [(0, None)])).count() == 0
    assert forest.nearest(vectors_of(spark, [(0, [1.0, 2.0])])).count() == 0
    assert forest.nearest(vectors_of(spark, [(1, [1.0]), (2, [2.0])])).count() == 0


def test_copies_of_one_vector_are_ranked_by_key(spark):
    rows = [(i, [1.0, 0.5, 0.25]) for i in range(300)] + [(i, [1.0, 0.5, 0.2 + i / 1e4]) for i in range(300, 360)]
    assert [r[:3] for r in rows_of(forest.nearest(vectors_of(spark, rows)))] == [r[:3] for r in brute_nearest(rows)]


@pytest.mark.parametrize("kind", ["lengths", "dense"])
def test_neighbours_are_found_below_prefixes(spark, monkeypatch, kind):
    """Many short stretches, vectors of all lengths, a third of them in one dense place."""
    monkeypatch.setattr(forest, "SAMPLE_ROWS", 1500)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 12))
    if kind == "lengths":
        x *= rng.uniform(0.2, 2, (3000, 1))
    else:
        x[::3] = x[0] + rng.standard_normal((1000, 12)) * 1e-3
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    fitted = []
    fit = forest.fit
    monkeypatch.setattr(forest, "fit", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    got = rows_of(forest.nearest(vectors_of(spark, rows), leaf_rows=64))
    assert recall(got, brute_nearest(rows)) >= 0.9
    made = fitted[0]
    assert made.need < made.trees * made.sample.shape[1] and min(map(len, made.starts)) > 8


def test_prefixes_of_hash_strings():
    a = np.array([0, 5, (1 << forest.BITS) - 1], np.int64)
    assert forest._prefix_bits(a, np.array([0, 4, 0], np.int64)).tolist() == [forest.BITS, forest.BITS - 1, 0]


def test_the_dense_end_of_an_array_is_dealt_over_parts():
    made = forest.Forest(4, 1.0, trees=2)
    strings = np.r_[np.zeros((5000, 2), np.int64), np.arange(5000).repeat(2).reshape(-1, 2) << 40]
    made.fit_arrays(strings, len(strings), leaf_rows=100)
    parts = made.row_parts(strings, np.arange(len(strings)))
    counts = np.bincount(parts[:, 0])
    assert counts.max() <= 800 and made.parts[0].max() > 10
    assert not set(parts[:, 0]) & set(parts[:, 1])


# ---------------------------------------------------------------- spelling variants

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def brute_variants(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and distance(v, w) == 1] for w in counts}
    form = {}
    for w, found in near.items():
        top = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = top if top and counts[top] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def random_words(letters, n, seed):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))): rng.choice([3, 5, 9, 40, 1000]) for _ in range(n)}


@pytest.mark.parametrize("list_rows", [1, 4, 1000])
def test_variants_agree_with_brute_force(spark, list_rows):
    counts = {**random_words("abé", 500, 1), **random_words("abcdefgh", 300, 2)}
    counts |= {"aaaaa" + c + "zzzzz" + d: 7 for c in "abcdefghijk" for d in "abcdefghijk"}  # one crowded start
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(tuple(r) for r in spelling.spelling_variants(words, list_rows).collect())
    assert got == brute_variants(counts)


def test_rows_are_used_again_and_ranges_passed_over():
    words = sorted(random_words("abcdefghijkl", 4000, 3))
    shared = spelling.shared_letters(words)
    query = words[1234]
    found, taken = spelling.scan(query, words, shared)
    assert found == [i for i, w in enumerate(words) if distance(query, w) == 1]
    assert taken < 0.1 * sum(map(len, words)) and taken < len(words)


def test_no_list_grows_with_a_crowded_start(spark):
    letters = "abcdefghij"
    counts = {"start" + a + b + c: 3 for a in letters for b in letters for c in letters}
    lists = spelling._lists(spark.createDataFrame(list(counts.items()), "word string, n long"), 5)
    # one letter of the shorter word open, so two of the longer
    assert max(r["count"] for r in lists.groupBy("key").count().collect()) <= len(letters) ** 2 < len(counts)


def test_words_of_odd_texts(spark):
    texts = [None, "", "12 34", "Straße straße STRASSE über Über ÜBER", "naïve中naïve naïve × x÷y abcdeÿ", "häuser " * 30000, "a" * 50000]
    docs = docs_of(spark, texts * 3)
    got = {r["word"]: r["n"] for r in spelling.word_counts(docs, min_count=1).collect()}
    import re
    import zlib

    want = Counter()
    for i, t in enumerate(texts * 3):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += len(run) >= 5
    assert got == {w: n for w, n in want.items() if n}
    assert spelling.variants_of_texts(docs.limit(0)).count() == 0
    assert spelling.variants_of_texts(docs_of(spark, [None, "one two"])).count() == 0


def test_spilled_counts_add_up(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = sorted(tuple(r) for r in spelling.word_counts(docs).collect())
    monkeypatch.setattr(spelling, "SPILL_WORDS", 50)
    assert sorted(tuple(r) for r in spelling.word_counts(docs).collect()) == want


# ---------------------------------------------------------------- source divergence

def brute_audit(docs, min_docs=3, top=200):
    """``docs``: rows (text, lang, source)."""
    import re

    counts, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        counts[lang, source].update(terms)
        df[lang].update(terms.keys())
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        sources = sorted(s for g, s in groups if g == lang)

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda f: (f[0], f[1].encode()))
                out += [(lang, s, part, item, -v, k) for k, (v, item) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out)


def random_docs(seed, n=120):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "delta", "é", "日本", "x", "don't", "a1b", "Straße", "😀"] + [f"w{i}".translate({48 + k: 97 + k for k in range(10)}) for i in range(40)]
    docs = []
    for _ in range(n):
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", "s4", None])
        pool = words if source == "s1" else rng.sample(words, 12)
        docs.append((" ".join(rng.choice(pool) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None]), source))
    return docs + [(None, "en", "s9"), ("", "fr", "s1"), ("12 34", "fr", "s2"), ("alone", "it", "s1"), ("long word " * 20000, "en", "s2")]


@pytest.mark.parametrize("spill", [1, 200, 400_000])
def test_audit_agrees_with_brute_force(spark, spill, monkeypatch):
    monkeypatch.setattr(divergence, "MERGE_ROWS", 64 if spill == 200 else divergence.MERGE_ROWS)
    monkeypatch.setattr(divergence, "PAIR_CELLS", 16 if spill == 200 else divergence.PAIR_CELLS)
    docs = random_docs(7)
    frame = spark.createDataFrame([(*d, 1, "n") for d in docs], "text string, lang string, source string, df long, term string").repartition(5)
    got = sorted(tuple(r) for r in divergence.audit(frame, spill_cells=spill).collect())
    assert got == brute_audit(docs)


def test_audit_of_empty_tables_and_without_terms(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    docs = [("one two", "en", "a"), ("1", "en", "b"), (None, None, None)]
    got = sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(docs, schema)).collect())
    assert got == brute_audit(docs) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_audit_agrees_with_sql_on_rows_of_many_documents(spark, tmp_path):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    pd.concat([docs, docs.head(50), docs.tail(3).assign(lang=None, source=None, text=None)]).to_parquet(tmp_path / "documents.parquet")
    assert norm(QUERIES["op13_divergence"](spark, str(tmp_path)).toPandas()) == norm(sql("op13_divergence", str(tmp_path)))


def test_shares_stay_exact_for_large_counts():
    rng = random.Random(2)
    for _ in range(300):
        total = rng.randint(1, 8 * 10**15)
        count = rng.randint(0, total - 1)
        got = divergence._share(np.array([count]), np.array([total]))[0]
        assert got == 1 + 10**9 * (count + 1) // total
