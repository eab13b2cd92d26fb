"""The training-text operators against SQL, brute force, libraries and labels."""

import glob
import hashlib
import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerframe.llm import bpe, chat, exact, extract, packing, pii, quality, rules, simhash, toxicity
from ledgerframe.llm.components import components
from ledgerframe.llm.oracles import ORACLES
from ledgerframe.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, lang string, source string, n_chars long, h long, n int, length int, digest string"


def docs_of(spark, texts, extra=()):
    """A documents table with clashing extra columns; ids count from 0."""
    rows = [(i, t, None, "s", None, 1, 2, 3, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + list(extra), ODD)


def cases(spark):
    """NULLs, empty and very long texts, repeated rows."""
    long = " ".join(f"word{i % 977} text{i}" for i in range(20000))
    texts = [None, "", " \n ", "one", "same text here", "same text here", long, long + " end", "é 😀 ß", "a" * 30000]
    again = [(4, "same text here", None, "s", None, 1, 2, 3, "x"), (None, "no id", None, None, None, 1, 2, 3, "x")]
    return docs_of(spark, texts, again), 12


def norm(frame):
    """Sorted rows with NULLs as None and whole floats, as pandas makes them, as ints."""
    def cell(v):
        return None if pd.isna(v) else int(v) if isinstance(v, float) and v == int(v) else v

    rows = frame[sorted(frame)].astype(object).itertuples(index=False, name=None)
    return sorted((tuple(map(cell, r)) for r in rows), key=repr)


def sql(name, folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con.execute(ORACLES[name]).df()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert norm(QUERIES[name](spark, MIDDLE).toPandas()) == norm(sql(name, MIDDLE))


def documents(folder):
    return pd.read_parquet(f"{folder}/documents.parquet")


# ---------------------------------------------------------------- components, SimHash

def reach(nodes, pairs):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_components_of_chains_stars_and_nothing(spark):
    pairs = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(8, 40)] + [(1, 1), (2, 3), (3, 2)]
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = reach({n for p in pairs for n in p}, pairs)
    groups = {}
    for r in got:
        groups.setdefault(r["root"], set()).add(want[r["node"]])
    assert {r["node"] for r in got} == {n for a, b in pairs if a != b for n in (a, b)}
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({want[r["node"]] for r in got})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(ids, fps):
    codes = np.array(fps, np.uint64)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4
    pairs = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near)) if i < j]
    return reach(ids, pairs)


def test_simhash_agrees_with_brute_force(spark):
    got = QUERIES["op2_simhash"](spark, SMALL).toPandas().set_index("doc_id")
    table = documents(SMALL)
    fps = [brute_fingerprint(t) for t in table.text]
    want = brute_components(table.doc_id.tolist(), fps)
    assert got.fingerprint.to_dict() == {i: f"{f:016x}" for i, f in zip(table.doc_id, fps)}
    assert got.component_id.to_dict() == want


@pytest.mark.parametrize("node_rows", [2, 6, 2048])
def test_large_nodes_lose_no_link(spark, node_rows):
    rng = random.Random(node_rows)
    centre = [rng.getrandbits(64) for _ in range(4)]
    fps = {0}
    for c in centre:
        for _ in range(60):
            fps.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    # all of one upper node, far apart in the rest
    fps |= {(centre[0] & ((1 << 22) - 1)) | rng.getrandbits(42) << 22 for _ in range(80)}
    fps = sorted(fps)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed.values()], "fp long"), node_rows=node_rows)
    pairs = [(r["a"], r["b"]) for r in links.collect()]
    apart = [bin((a ^ b) & (1 << 64) - 1).count("1") for a, b in pairs]
    want = brute_components(list(signed.values()), fps)
    got = reach(list(signed.values()), pairs)
    assert Counter(Counter(want.values()).values()) == Counter(Counter(got.values()).values())
    assert all(want[a] == want[b] for a, b in pairs) and (node_rows < 2048 or len(apart) < len(fps) * 20)


def test_near_groups_of_odd_rows(spark):
    docs, n = cases(spark)
    got = simhash.near_groups(docs).collect()
    assert len(got) == n and {r["component_id"] for r in got if r["fp"] == 0} == {0}
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {0, 3, 4, None}
    assert simhash.near_dedup(docs.limit(0)).count() == 0


def test_near_dedup_of_odd_rows(spark):
    docs, _ = cases(spark)
    again = docs.unionAll(docs_of(spark, ["other text of id nought"]))
    kept = corpus_pipeline.drop_near_copies(spark, again, SMALL)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 0, 3, 4, 4, 6, 8, 9]
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), SMALL).count() == 0


# ---------------------------------------------------------------- exact duplicates

def test_exact_groups_of_odd_rows(spark):
    docs, n = cases(spark)
    got = {}
    for r in exact.exact_groups(docs, hash_all=True).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == n
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in got[4]] == [(5, 3, False)] * 2
    assert got[0][0]["keep_id"] == 1 and got[0][0]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    some = {r["doc_id"]: r["text_sha256"] for r in exact.exact_groups(docs).collect()}
    assert some[3] is None and some[5] == got[5][0]["text_sha256"]
    left = exact.exact_dedup(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.filter("doc_id IS NOT NULL").collect()) == [1, 2, 3, 5, 6, 7, 8, 9]
    assert exact.exact_groups(docs.limit(0)).count() == exact.exact_dedup(docs.limit(0)).count() == 0


def test_each_level_reads_only_what_the_one_before_left(spark):
    long = "z" * 300
    texts = ["a", "bb", "cc", "dd", "ee", "ee", long + "1", long + "2", "only this long", None, ""]
    read = lambda t: tuple(exact.refinement(docs_of(spark, t)).first())
    # one length each for "a" and the last but two; heads of the two long ones are equal
    assert read(texts) == (11, 9, 6)
    assert read([long[:n] for n in range(1, 200)]) == (199, 0, 0)
    assert read([]) == (0, 0, 0)


# ---------------------------------------------------------------- rules, quality

def test_rules_of_odd_rows(spark):
    docs, n = cases(spark)
    rows = rules.judge_lines(docs, with_text=True).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == n and by_id[0]["n_words"] == 0 and not by_id[0]["kept"] and by_id[0]["cleaned"] == ""
    assert by_id[6]["n_words"] == 40000
    text = "Home | News | About | Contact\nA plain sentence with quite a few words in it.\nAll rights reserved.\n" * 3
    row = rules.judge_lines(docs_of(spark, [text]), with_text=True).collect()[0]
    assert row["n_failed_lines"] == 6 and row["n_dup_lines"] == 6 and row["cleaned"].count("plain") == 3
    assert rules.judge_lines(docs.limit(0)).count() == 0


def test_repeated_words_by_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a b c d e".split()) for _ in range(rng.randint(0, 40))) for _ in range(200)]

    def brute(words):
        runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        counts = Counter(runs)
        return len({i + k for i, r in enumerate(runs) if counts[r] > 1 for k in range(3)})

    got = {r["doc_id"]: r["n_repeat_words"] for r in rules.judge_lines(docs_of(spark, texts)).collect()}
    assert got == {i: brute(t.split()) for i, t in enumerate(texts)}


def test_quality_agrees_with_held_out_labels(spark):
    got = QUERIES["op1_quality"](spark, MIDDLE).toPandas()
    both = got.merge(pd.read_parquet(f"{MIDDLE}/labels.parquet"), on="doc_id")
    good, bad = both[both.quality == 1], both[both.quality == 0]
    assert good.kept.mean() >= 0.98 and bad.kept.mean() <= 0.25
    docs, n = cases(spark)
    assert quality.judge(docs).count() == n and quality.judge(docs.limit(0)).count() == 0


def brute_votes(text):
    """The eleven votes on a text, as digits to the base of three."""
    words, ascii_words = text.split(), [w for w in re.split(r"[\x20\x09-\x0D]+", text.strip(" ")) if w]
    n, own = max(len(ascii_words), 1), max(len(words), 1)
    count = lambda pattern, s=text: len(regex.findall(pattern, s))
    visible, alike = max(count(r"[^\x20\x09-\x0D]"), 1), count(r"[\p{L}\p{N}]")
    letters, upper, ends = max(count(r"\p{L}"), 1), count(r"\p{Lu}"), max(count("[.!?…]"), 1)
    symbols, cries, bars = count(r"[#*$%&<>{}=\\^~]"), text.count("!"), text.count("|") + text.count("»")
    plain = sum(regex.fullmatch(r"\p{L}+[.,;:!?]?", w) is not None for w in ascii_words)
    doubled, distinct = sum(a == b for a, b in zip(words, words[1:])), max(len(set(words)), 1)
    other = visible - alike
    pairs = [  # bad, good
        (False, n >= 20),
        (plain * 10 < n * 6, plain * 10 >= n * 9),
        (other * 5 >= visible, other * 10 < visible),
        (symbols * 3 >= n, symbols * 20 < n),
        (upper * 2 >= letters, upper * 5 < letters),
        (cries * 3 >= n, cries * 20 < n),
        (bars * 5 >= n, bars * 50 < n),
        (n > 100 * ends, 3 * ends <= n <= 60 * ends),
        (letters > 15 * n or letters < 2 * n, 3 * n <= letters <= 10 * n),
        (own >= 50 and distinct * 10 < own, distinct * 4 >= own),
        (doubled * 5 >= own, doubled * 50 < own),
    ]
    return [1 if bad else 2 if good else 0 for bad, good in pairs]


def brute_posteriors(table):
    """Expectation-maximisation document by document; one probability each."""
    n = len(table)
    good = [1 / (1 + math.exp(3 * v.count(1) - 4)) for v in table]
    for _ in range(quality.ROUNDS):
        total, chance = sum(good), {}
        for k in range(11):
            for c, lean in enumerate(((0.4, 0.4, 0.2), (0.3, 0.01, 0.69))):
                seen = [n * quality.LEAN * x for x in lean]
                for v, g in zip(table, good):
                    seen[v[k]] += g if c else 1 - g
                chance[k, c] = [x / sum(seen) for x in seen]
            chance[k, 1][1] = min(chance[k, 1][1], quality.MAX_FALSE)
        priors = ((n - total + 1) / (n + 2), (total + 1) / (n + 2))
        odds = [[math.log(priors[c]) + sum(math.log(chance[k, c][v[k]]) for k in range(11)) for c in (0, 1)] for v in table]
        good = [1 / (1 + math.exp(min(max(b - g, -50), 50))) for b, g in odds]
    return good


def brute_scores(texts, targets):
    """Accelerated gradient steps on a logistic model, over dictionaries of hashed shapes."""
    def shape(word):
        word = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a", word)
        return re.sub(r"(.{1,3}?)\1+", r"\1+", re.sub(r"\d+", "0", word))

    rows = []
    for text in texts:
        words = text.split()
        n, row = len(words) + quality.SMOOTH_WORDS, Counter()
        for w in words:
            row[shape(w)] += 1 / n
        row[f"length {n.bit_length()}"] += 1
        row["doubled"] += sum(a == b for a, b in zip(words, words[1:])) / n
        hashed = Counter()
        for name, share in row.items():
            hashed[zlib.crc32(name.encode()) % quality.BUCKETS] += share
        rows.append({**hashed, -1: 1.0})
    # a row of equal features and target is one example
    found = {(tuple(sorted(r.items())), y) for r, y in zip(rows, targets)}
    m, curve = len(found), Counter()
    for row, _ in found:
        for k, v in row:
            curve[k] += 0.75 * v / m
    last, look, step = Counter(), Counter(), 1.0
    for _ in range(quality.STEPS):
        slope = Counter({k: quality.PENALTY * w for k, w in look.items() if k != -1})
        for row, y in found:
            gap = 1 / (1 + math.exp(-sum(v * look[k] for k, v in row))) - y
            for k, v in row:
                slope[k] += gap * v / m
        new = Counter({k: look[k] - slope[k] / (curve[k] + quality.PENALTY) for k in slope})
        after = (1 + math.sqrt(1 + 4 * step * step)) / 2
        look = Counter({k: w + (step - 1) / after * (w - last[k]) for k, w in new.items()})
        last, step = new, after
    return [1 / (1 + math.exp(-sum(v * last[k] for k, v in r.items()))) for r in rows]


def test_quality_by_brute_force(spark):
    table = documents(SMALL)
    texts = table.text.fillna("").tolist()
    texts += ["no no no no yes", "", "\u00a0a\u00a0b", "#" * 90, "LOUD! WORDS! HERE!", "x1 " * 80, "home | news | about » more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    good = brute_posteriors([brute_votes(t) for t in texts])
    assert all(abs(got[i]["p_votes"] - p) < 2e-6 for i, p in enumerate(good))
    # equal votes have one posterior; rounding here keeps equal targets equal
    scores = brute_scores(texts, [round(p, 12) for p in good])
    assert all(abs(got[i]["score"] - s) < 1e-4 for i, s in enumerate(scores))
    assert all(got[i]["kept"] == (s >= quality.CUT) for i, s in enumerate(scores) if abs(s - quality.CUT) > 1e-3)


def test_expectation_maximisation_trusts_what_tells():
    rng = np.random.default_rng(0)
    n, votes = 6000, []
    bad = rng.random(n) < 0.1
    for _ in range(4):  # they see six of ten bad documents and hardly ever err
        seen = np.where(bad, rng.random(n) < 0.6, rng.random(n) < 0.0005)
        votes.append(np.where(seen, quality.BAD, np.where(~bad & (rng.random(n) < 0.8), quality.GOOD, quality.ABSTAIN)))
    votes.append(np.where(rng.random(n) < 0.9, quality.GOOD, quality.ABSTAIN))  # says nothing about it
    pattern = sum(v * 3 ** (4 - k) for k, v in enumerate(votes))
    good = quality.posteriors(dict(Counter(pattern.tolist())), 5)
    told = np.array([good[p] < 0.5 for p in pattern.tolist()])
    assert told[bad].mean() > 0.95 and told[~bad].mean() < 0.02
    assert quality.posteriors({}, 4) == {}


# ---------------------------------------------------------------- packing

def naive_best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= length]
        best = min(fits, key=lambda b: b[0]) if fits else None
        if best is None:
            best = [capacity]
            bins.append(best)
        best[0] -= length
    return sorted(b[0] for b in bins)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
    plan = packing.best_fit_plan(dict(Counter(lengths)), capacity)
    bins, seen = {}, Counter()
    for length, rank, n, per_bin, first, offset in plan:
        assert rank == seen[length]
        seen[length] += n
        for k in range(n):
            bins.setdefault(first + k // per_bin, []).append((offset + k % per_bin * length, length))
    assert seen == Counter(lengths)
    for parts in bins.values():  # gapless from 0
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0
    assert sorted(capacity - sum(n for _, n in p) for p in bins.values()) == naive_best_fit(lengths, capacity)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs, _ = cases(spark)
    docs = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    pieces = packing.token_pieces(docs, path).cache()
    placed = packing.pack(pieces.drop("ids")).toPandas()
    ids = {}
    for r in pieces.orderBy("doc_id", "piece").collect():
        ids.setdefault(r["doc_id"], []).append(np.frombuffer(r["ids"], "<u4"))
    for r in docs.collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        parts = ids[r["doc_id"]]
        assert np.concatenate(parts).tolist() == want
        assert all(len(p) == 2048 for p in parts[1:]) and len(parts[0]) <= 2048
    for _, rows in placed.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *rows.length.cumsum().tolist()[:-1]] and rows.length.sum() <= 2048
    whole = packing.packed_sequences(pieces, packing.pack(pieces.drop("ids")))
    assert sum(len(r["ids"]) for r in whole.collect()) == 4 * placed.length.sum()
    assert packing.pack(pieces.drop("ids").limit(0)).count() == 0


def test_segments_encode_like_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    parts = [" ", "  ", "\n", "\t", "a", "b1", "'s", " ", "　", "<|endoftext|>", "é", "😀", "!", "\x1c", "\x0b", "\x85"]
    rng = random.Random(2)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    found = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    for remember in (10, 500_000):
        encoder = packing.SegmentEncoder(path, remember)
        for _ in range(2):
            got = {}
            for places, sizes, ids in encoder.encode(pa.array(texts)):
                cuts = np.split(ids, np.cumsum(sizes)[:-1])
                got.update((i, c.tolist()) for i, c in zip(places.tolist(), cuts))
            assert got == {i: e.ids for i, e in enumerate(found)}


def test_packing_query_digests(spark):
    got = QUERIES["op4_packing"](spark, SMALL).toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert len(got.sequence_id.unique()) <= -(-got.length.sum() // 2048) * 1.02 + 1
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = documents(SMALL).set_index("doc_id").text
    for r in got.head(40).itertuples():
        flat = np.array(library.encode(texts[r.doc_id], add_special_tokens=False).ids + [0], "<u4")
        assert zlib.crc32(flat[r.start : r.start + r.length].tobytes()) == r.ids_crc32


# ---------------------------------------------------------------- BPE

def test_bpe_agrees_with_the_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    odd = ["foo<|endoftext|>bar  it's we'LL 123 ÀÉ é ́x a b　c b\x1cc", "İstanbul ΣΑΣ ß 😀👍🏽 12½ Ⅷ 'S 're'",
           "aaaaaaaab" * 50, "<|startoftext|><|endoftext|>", "日本語 العربية", "a​z ﻿", "x" * 20000]
    docs, n = cases(spark)
    docs = docs.unionAll(docs_of(spark, odd + documents(SMALL).text.tolist()))
    rows = docs.select("text").collect()
    want = Counter()
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want[(len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))] += 1
    got = Counter((r["n_tokens"], r["ids"], r["decoded"]) for r in bpe.encode_decode(docs, path).collect())
    assert got == want
    assert bpe.encode_decode(docs.limit(0), path).count() == 0


def test_bpe_codes_letters_and_forgotten_chunks_as_the_library(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    chars = [chr(n) for n in range(0x21, 0x250)]
    values = [" ".join([c, f"a{c}", f"{c}'S{c}{c}"]) for c in chars] + ["", " \t ", "\u3000", "\n".join(chars)]
    values += ["Été <|endoftext|>Été <| ×2÷ß", "é" * 3000 + " " + "aé" * 3000] + values[:50]
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 30)
    monkeypatch.setattr(bpe, "TRIE_NODES", 40)
    coder = bpe.TextCoder(path)
    for at in range(0, len(values), 7):
        part = values[at : at + 7]
        counts, ids, decoded = coder.code(pa.array(part))
        want = [library.encode(v, add_special_tokens=False).ids for v in part]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.to_pylist() == [" ".join(map(str, w)) for w in want]
        assert decoded.to_pylist() == [library.decode(w, skip_special_tokens=False) for w in want]


def test_bpe_costs_no_collection_no_relearning_and_no_call_for_plain_words(monkeypatch):
    """What made it slow: trie nodes that the garbage collector visits, a full cache that
    forgot the chunks in use, and a call of the library for each word with an accent."""
    import gc

    coder = bpe.TextCoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 3)
    learned, called = [], []
    learn, words = coder._learn, coder._words
    monkeypatch.setattr(coder, "_learn", lambda chunks: (learned.extend(chunks), learn(chunks)))
    monkeypatch.setattr(coder, "_words", lambda part: (called.append(part), words(part))[1])
    for text in ["Été Straße, année old", "année old! Straße, Été", "a Straße, β"]:
        coder.code(pa.array([text]))
    assert sorted(learned) == sorted(["Été", "Straße,", "année", "old", "old!", "a", "β"])
    assert called == ["β"]
    gc.collect()
    assert coder.trie.nodes and not any(map(gc.is_tracked, coder.trie.nodes.values()))


# ---------------------------------------------------------------- HTML

def test_pages_give_their_articles(spark):
    import html

    got = QUERIES["op5_html_extraction"](spark, MIDDLE).toPandas().set_index("page_id")
    for r in pd.read_parquet(f"{MIDDLE}/pages.parquet").itertuples():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S)[1]
        flat = re.sub(r"<(?!/?b>)[^>]+>", " ", inner).replace("<b>", "").replace("</b>", "")
        assert got.text[r.page_id] == re.sub(r"\s+", " ", html.unescape(flat)).strip()


PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body class="menu-open">
<header><a href=/>Logo</a></header><div id="mainNav"><a href=1>One</a> <a href=2>Two</a></div>
<div class="post"><h1>A &amp; B</h1><p>First <i>para</i>graph,
 with text &lt;3.<p>Second one.<div class="ad-slot">Buy now, it is cheap and good for you.</div>
<ul><li>Point one.<li>Point two.</ul><form>Name <input name=x></form>
<section class="comments"><p>I liked this article a lot, thank you for it.</p></section></div>
<div class="cookie-notice"><p>We use cookies to make this site better for you.</p></div>
<aside><p>Related things.</p></aside><footer>(c) 2020</footer><!-- end"""


def test_boilerplate_is_cut_away(spark):
    assert extract.main_text(PAGE) == "A & B First paragraph, with text <3. Second one. Point one. Point two."
    assert extract.main_text("<script>x") == extract.main_text("") == extract.main_text("<") == ""
    rows = [(1, None, None, 5), (2, "u", "", 6), (2, "u", "<p>" + "Some long text here. " * 30000, 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract.extract(pages).collect()
    assert [len(r["text"]) for r in got] == [0, 0, 21 * 30000 - 1]
    assert extract.extract(pages.limit(0)).count() == 0
    assert len(extract.blocks("<div>" * 3000 + "x")) == 1


@pytest.mark.parametrize("head", ["<head><title>x</title>", "<head><title>x", "<head><noscript>y", "<head>", "<head><title>x</title></head>"])
def test_silent_elements_may_be_left_open(head):
    text = "A whole paragraph of the article, with words enough to count. " * 3
    for body in ("<body><article>", "<article>", "<BODY><div><article>"):
        assert extract.main_text(f"<html>{head}{body}<p>{text}</p></article>") == text.strip()
    for tag in ("svg", "object", "select", "video", "iframe", "canvas", "noscript", "template"):
        page = f"<html>{head}<body><div><{tag}>no</div><article><p>{text}</p></article><{tag}>no</{tag}>"
        assert extract.main_text(page) == text.strip(), tag


@pytest.mark.parametrize("opening, closing", [
    ('<div class="content no-sidebar"><article>', "</article></div>"),
    ('<form id="aspnetForm"><article>', "</article></form>"),
    ('<div class="post-with-comments">', "</div>"),
    ('<div class="layout has-menu with-ads"><main>', "</main></div>"),
    ('<div id="page-form"><div>', "</div></div>"),
    ('<div data-id="menu">', "</div>"),
    ('<aside class="sidebar"><article><p>Short teaser of another page.</p></article></aside><form><div class="entry">', "</div></form>"),
])
def test_wrappers_do_not_hide_the_article(opening, closing):
    sentence = "The long sentence of the article stands here, and it is told to its very end."
    text = " ".join([sentence] * 10)
    around = '<nav><a href="/">Home</a> <a href="/b">News</a></nav>{}<footer>Copyright 2024. All rights reserved.</footer>'
    page = f"<html><body>{around.format(opening + ''.join(f'<p>{sentence}</p>' for _ in range(10)) + closing)}</body></html>"
    assert extract.main_text(page).removeprefix("Short teaser of another page. ") == text


def test_deep_and_unmatched_tags_take_linear_time():
    import time

    begin = time.process_time()
    assert len(extract.blocks("<font>words<br>" * 100_000)) == 100_000
    assert len(extract.blocks("<font>" * 50_000 + "<h1>x</h2></b>" * 50_000)) == 50_000
    assert len(extract.blocks("<p><div>" + "<li>" * 50_000 + "<b>y<p>" * 50_000)) >= 1
    assert extract.main_text("<font>words<br>" * 20_000).count("words") in (0, 20_000)
    assert time.process_time() - begin < 60


def test_minimum_cut_by_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(1, 8)
        scores = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        cost = lambda keep: sum(max(s, 0) if not k else max(-s, 0) for s, k in zip(scores, keep)) + sum(  # noqa: E731, B023
            w for a, b, w in edges if keep[a] != keep[b])  # noqa: B023
        best = min(map(cost, itertools.product([True, False], repeat=n)))
        assert abs(cost(extract.minimum_cut(scores, edges)) - best) < 1e-6


# ---------------------------------------------------------------- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_by_brute_force(spark):
    rng = random.Random(3)
    parts = ["a", "b@c.de", "@", "+", ".", "-", "1", "22", "4111 1111 1111 1111", "4111111111111111", "10.0.0.1", "256", "+1 (017) 555-7713",
             " ", "\n", "é", "😀", "_", "x@y.z.w", "00", "(", ")"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    texts += ["1" * 50000, "a" * 50000 + "@", "1 " * 30000, "+1" * 20000, "1." * 30000]
    found = pii.found_spans(docs_of(spark, texts)).select("doc_id", pii.span_string(pii.all_spans(base_only=True)).alias("s"))
    assert {r["doc_id"]: r["s"] for r in found.collect()} == {i: ",".join(brute_spans(t)) for i, t in enumerate(texts)}


def test_query_spans_hold_the_base_spans(spark):
    got = QUERIES["op7_pii"](spark, MIDDLE).toPandas().set_index("doc_id")
    for r in documents(MIDDLE).itertuples():
        base = brute_spans(r.text)
        row = got.loc[r.doc_id]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == row.base_sha256
        assert set(base) <= set(row.spans.split(",")) | {""}
        assert row.n_email == sum(s.startswith("email") for s in base)


def test_contexts_discover_unseen_identifiers(spark):
    texts = [f"n{i} hotline: +1 (017) 555-77{i:02d} now" for i in range(12)]
    texts += ["x hotline: 0171 5557 712 now", "y amount 0171 5557 713 now", "nothing", None]
    rows = [(0, texts[0], None, "s", None, 1, 2, 3, "x"), (None, texts[12], None, None, None, 1, 2, 3, "x")]
    docs = docs_of(spark, texts, rows)
    got = [(r["doc_id"], [(x["kind"], x["s"], x["e"]) for x in r["extra"]]) for r in pii.found_spans(docs).collect()]
    assert len(got) == len(texts) + 2
    assert all(extra == ([("phone", 11, 24)] if i in (12, None) else []) for i, extra in got)
    clean = pii.mask(docs)
    text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in clean.collect()}
    assert clean.columns == docs.columns and clean.count() == len(texts) + 2
    assert text[12] == ("x hotline: [PHONE] now", 22) and text[3][0] == "n3 hotline: [PHONE] now"
    assert text[13][0] == texts[13] and text[15][0] is None
    assert pii.mask(docs.limit(0)).count() == pii.found_spans(docs.limit(0)).count() == 0


def planted_contexts():
    """Seeds among as many unseen values, a value that leads to a further pattern, a word
    longer than a line, and a context with many more unseen values than seeds."""
    far = "x" * 90 + ":"
    texts = [f"n{i} hotline: +1 (017) 555-77{i:02d} now" for i in range(12)]
    texts += [f"u{i} hotline: 0171 5557 7{i:02d} now" for i in range(12)]
    texts += [f"f{i} {far} +1 (018) 555-77{i:02d} then" for i in range(9)] + [f"g {far} 0181 5557 713 then"]
    texts += [f"line 0171 5557 7{i:02d} end" for i in range(9)] + ["line 0199 1234 567 end"]
    texts += [f"order {3000000 + i} paid" for i in range(80)] + [f"order +1 (019) 555-77{i:02d} paid" for i in range(4)]
    return texts + ["", None]


def test_unknown_values_do_not_silence_a_context(spark):
    texts = planted_contexts()
    got = {r["doc_id"]: [x["kind"] for x in r["extra"]] for r in pii.found_spans(docs_of(spark, texts)).collect()}
    want = {i: ["phone"] if (t or "").startswith(("u", "g", "line")) else [] for i, t in enumerate(texts)}
    assert got == want


def test_planted_contexts_by_sql(spark, tmp_path):
    docs = docs_of(spark, planted_contexts())
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(ORACLES["op7_pii"]).df().sort_values("doc_id")
    got = QUERIES["op7_pii"](spark, str(tmp_path)).toPandas().sort_values("doc_id")
    assert got.spans.tolist() == want.spans.tolist() and sum("phone" in x for x in got.spans) == 48


# ---------------------------------------------------------------- toxicity

def test_chain_holds_on_unseen_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = F.pmod("doc_id", F.lit(2)) == 0
    chain = toxicity.fit_chain(docs, labels.filter(seen))
    got = toxicity.score(docs, chain).join(labels.filter(~seen), "doc_id").toPandas()
    assert got[got.toxic == 0].kept.mean() > 0.98 and got[got.toxic == 1].kept.mean() < 0.2
    assert set(got) >= {"p_disruptive", "p_toxic", "p_disruptive_toxic"}


def test_chain_of_odd_rows(spark):
    docs, n = cases(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(3, 1, 0), (3, 0, 1), (4, None, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        chain = toxicity.fit_chain(docs, labels)
        assert toxicity.score(docs, chain).count() == n
        assert toxicity.keep_clean(docs, chain).columns == docs.columns
    assert toxicity.score(docs, toxicity.fit_chain(docs, none)).filter("NOT kept").count() == 0
    assert toxicity.keep_clean(docs.limit(0), chain).count() == 0


# ---------------------------------------------------------------- chats

def test_replies_follow_what_they_quote(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for c in range(25):
        said = []
        for t in range(rng.randint(1, 20)):
            own = [rng.choice(["Hello  there", "yes", ""]) if rng.random() < 0.3 else f"line {c} {t} {k}" for k in range(rng.randint(0, 3))]
            quoted = ["> " + line for line in rng.choice(said).split("\n")[:4]] if said and rng.random() < 0.6 else []
            said.append("\n".join(quoted + own if rng.random() < 0.5 else own + quoted))
            rows.append((c, t, rng.choice(["user", "assistant"]), said[-1]))
    rows += [rows[5], rows[9], (3, 2, "user", "tie"), (None, 1, None, None), (None, None, "user", "> tie")]
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    frame.to_parquet(tmp_path / "conversations.parquet")
    got = QUERIES["op10_chat_formatting"](spark, str(tmp_path)).toPandas()
    assert got.thread.max() > 0 and norm(got) == norm(sql("op10_chat_formatting", str(tmp_path)))


def test_nested_quotes_and_empty_chats(spark):
    rows = [(1, 0, "user", "Where is it?"), (1, 1, "assistant", "> Where is it?\nBehind the house."), (1, 2, "user", "And the key?"),
            (1, 3, "assistant", ">> Where is it?\n> Behind  the HOUSE.\nThanks.")]
    got = {r["turn"]: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[3]["reply_to"] == 1 and got[3]["text"] == "Thanks." and got[3]["thread"] == 3 and got[2]["thread"] == 0
    assert got[1]["formatted"] == "<|assistant|>\nBehind the house.<|end|>\n"
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, n long")
    assert chat.format_chats(empty).count() == 0


def folded(words, width, mark=""):
    return "\n".join(mark + " ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_passages_may_be_wrapped_anew_or_be_a_part(spark, tmp_path):
    rng = random.Random(5)
    rows, asked = [], {}
    for c in range(12):
        said = []
        for t in range(14):
            own = [f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(rng.randint(12, 40))]
            quoted = ""
            if t > 2 and rng.random() < 0.6:
                parent = rng.randrange(t)
                at = rng.randrange(len(said[parent]) - 8)
                part = said[parent][at : at + rng.randint(8, 30)]
                asked[c, t] = parent
                quoted = folded(part, rng.randint(2, 9), "> ") + "\n"
                if rng.random() < 0.5:  # what the quoted message itself quoted
                    quoted = folded(said[rng.randrange(t)][:9], 4, "> > ") + "\n" + quoted
            said.append(own)
            rows.append((c, t, "user", quoted + folded(own, rng.randint(3, 11))))
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    frame.to_parquet(tmp_path / "conversations.parquet")
    got = QUERIES["op10_chat_formatting"](spark, str(tmp_path)).toPandas()
    replies = {(r.conv_id, r.turn): r.reply_to for r in got.itertuples()}
    assert len(asked) > 50 and all(replies[k] == parent for k, parent in asked.items())
    assert all(replies[c, t] == t - 1 for c, t, *_ in rows if t and (c, t) not in asked)
    assert norm(got) == norm(sql("op10_chat_formatting", str(tmp_path)))


def test_chats_of_odd_rows(spark):
    long = [f"w{i}" for i in range(30000)]
    columns = "conv_id long, turn long, role string, text string, n long, c string, thread long, own string, pieces int"
    rows = [(1, 0, "user", folded(long, 7)), (1, 1, "assistant", "No."), (1, 2, "user", folded(long, 11, ">> ") + "\nwhy?")]
    # messages of one turn, a level without end, marks of the parser in a text
    rows += [(2, 5, "user", f"text {i}") for i in range(600)] + [(3, 0, None, ">" * 5000 + "a"), (3, 1, "user", "\x02\x03 > b\n> \x02"), (None, None, None, None)]
    odd = spark.createDataFrame([(*r, 9, "x", 8, "y", 7) for r in rows + rows[:5]], columns)
    got = chat.format_chats(odd).toPandas()
    assert len(got) == len(rows)
    last = got[(got.conv_id == 1) & (got.turn == 2)].iloc[0]
    assert last.reply_to == 0 and last.text == "why?" and last.n_quoted == -(-len(long) // 11)
    assert sorted(got[got.conv_id == 2].position) == list(range(600)) and set(got[got.conv_id == 2].thread) == {0}


# ---------------------------------------------------------------- pipeline

def test_pipeline_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.fit_chain(docs, labels)
    table = documents(SMALL)
    table = table[[chain.probabilities(t)[1] < toxicity.CUT for t in table.text]]
    table = table.sort_values("doc_id").drop_duplicates("text", keep="last")
    low = brute_components(table.doc_id.tolist(), [brute_fingerprint(t) for t in table.text])
    table = table[[low[i] == i for i in table.doc_id]]
    got = corpus_pipeline.run(spark, SMALL).toPandas()
    assert sorted(got.doc_id.unique()) == sorted(table.doc_id)
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    kinds = [f.__name__ for _, f in corpus_pipeline.STAGES]
    assert kinds == ["drop_toxic", "drop_exact_copies", "drop_near_copies", "mask_personal_data", "pack_windows"]
