"""Approximate nearest neighbours by inner product, from a forest of hash prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

NEIGHBOURS = 20
TREES = 16
SEED = 42
# A hash string: the sides of hyperplanes, then the place along a line, finer and finer. The
# line tells vectors apart that no hyperplane through the origin does.
SIDE_BITS, LINE_BITS = 40, 22
BITS = SIDE_BITS + LINE_BITS
# The bounded samples that the index is fitted on: vectors whose strings tell how many rows a
# prefix has, and queries whose true neighbours tell how far to ascend.
SAMPLE_ROWS = 65_536
SAMPLE_QUERIES = 128
TARGET_RECALL = 0.95
# rows of a stretch of a tree's sorted array that one task compares at once, and scores
LEAF_ROWS = 4096
BLOCK_SCORES = 1 << 22


def _planes(dimensions: int, trees: int) -> np.ndarray:
    """``trees * (SIDE_BITS + 1)`` directions, orthogonal as far as the space has room."""
    draw, made = np.random.default_rng(SEED), []
    while sum(map(len, made)) < trees * (SIDE_BITS + 1):
        made.append(np.linalg.qr(draw.standard_normal((dimensions, dimensions)))[0].T)
    return np.concatenate(made)[: trees * (SIDE_BITS + 1)]


def hash_strings(x: np.ndarray, planes: np.ndarray, trees: int) -> np.ndarray:
    """A row of ``trees`` strings of ``BITS`` bits for each unit vector; first bits count most."""
    sides = x @ planes[: trees * SIDE_BITS].T > 0
    weights = np.int64(1) << np.arange(BITS - 1, LINE_BITS - 1, -1, dtype=np.int64)
    line = (np.clip(x @ planes[trees * SIDE_BITS :].T, -1, 1) + 1) / 2 * ((1 << LINE_BITS) - 1)
    return (sides.reshape(len(x), trees, SIDE_BITS) * weights).sum(axis=2) + line.astype(np.int64)


def _prefix_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the strings' common prefix."""
    apart = (a ^ b).astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        apart |= apart >> np.uint64(shift)
    return BITS - np.bitwise_count(apart).astype(np.int64)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in the order of the components."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Vectors as rows; missing components at the end count as 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == dimensions).all():
        return flat.reshape(-1, dimensions)
    out = np.zeros((len(sizes), dimensions))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def best(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``n`` highest scores and of what ties with the last."""
    if scores.shape[1] > n:
        last = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
        # products of matrices round otherwise than the sums that decide
        return np.nonzero(scores >= (last - 1e-9 * np.abs(last) - 1e-300)[:, None])
    return np.nonzero(np.ones(scores.shape, bool))


class Forest:
    """What is fitted: directions, sorted strings of the sample, where to cut the arrays."""

    def __init__(self, dimensions: int, longest: float, trees: int):
        self.dimensions, self.longest, self.trees = dimensions, longest, trees
        self.planes = _planes(dimensions + 1, trees)
        self.need = 0

    def row_strings(self, x: np.ndarray) -> np.ndarray:
        """Strings of indexed vectors. A further component brings all to the longest one's
        length, so that the angle to a query ranks as the inner product does."""
        x = x / self.longest
        rest = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))
        return hash_strings(np.c_[x, rest], self.planes, self.trees)

    def query_strings(self, x: np.ndarray) -> np.ndarray:
        length = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return hash_strings(np.c_[x / length, np.zeros(len(x))], self.planes, self.trees)

    def fit_arrays(self, strings: np.ndarray, rows: int, leaf_rows: int) -> None:
        """Cut each tree's array at prefixes below which about ``leaf_rows`` rows stand.

        Of a prefix that stays frequent to its last bit the rows are dealt over several
        parts. A part has a number; those below a prefix follow one another.
        """
        self.sample = np.sort(strings.T, axis=1)
        scale = rows / max(1, self.sample.shape[1])
        self.starts, self.parts = [], []
        for array in self.sample:
            starts, parts, todo = [], [], [(0, 0)]
            while todo:
                start, depth = todo.pop()
                lo, hi = np.searchsorted(array, [start, start + (1 << (BITS - depth))])
                if (hi - lo) * scale > leaf_rows and depth < BITS:
                    # the lower half is taken next, so starts come in order
                    todo += [(start + (1 << (BITS - depth - 1)), depth + 1), (start, depth + 1)]
                else:
                    starts.append(start)
                    parts.append(max(1, -(-int((hi - lo) * scale) // (4 * leaf_rows))))
            self.starts.append(np.array(starts, np.int64))
            self.parts.append(np.array(parts, np.int64))
        sizes = np.cumsum([0, *[p.sum() for p in self.parts]])
        self.bases = [base + np.r_[0, np.cumsum(p)] for base, p in zip(sizes, self.parts)]

    def levels(self, strings: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """From the longest prefix up: for each query the sample rows below it in all trees
        together, and in the tree with most."""
        for level in range(BITS, -1, -1):
            shift = np.int64(BITS - level)
            lo = strings >> shift << shift
            found = np.stack([
                np.searchsorted(array, lo[:, t] + (1 << int(shift))) - np.searchsorted(array, lo[:, t])
                for t, array in enumerate(self.sample)
            ])
            yield found.sum(axis=0), found.max(axis=0)

    def ascend(self, strings: np.ndarray, need: int, at_least: int) -> np.ndarray:
        """The level of each query: all trees are left for shorter prefixes in step until
        they hold ``need`` sample rows together and one of them ``at_least``."""
        out = np.full(len(strings), -1)
        for above, (total, most) in enumerate(self.levels(strings)):
            out[(out < 0) & (total >= need) & (most >= at_least)] = BITS - above
            if (out >= 0).all():
                break
        return np.maximum(out, 0)

    def row_parts(self, strings: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The part of each row in each tree."""
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        out = np.empty_like(strings)
        for t in range(self.trees):
            leaf = np.searchsorted(self.starts[t], strings[:, t], "right") - 1
            out[:, t] = self.bases[t][leaf] + (mixed % self.parts[t][leaf].astype(np.uint64)).astype(np.int64)
        return out


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, vec)``, one row for each id, of the vectors that take part."""
    vec = F.col(vector)
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    good = vectors.filter(F.col(key).isNotNull() & finite & F.exists(vec, lambda x: x != 0))
    return good.groupBy(F.col(key).cast("long").alias("id")).agg(F.min(vector).alias("vec"))


def _distinct(rows: DataFrame, queries: DataFrame, keep_ids: int) -> DataFrame:
    """``(rep, ids, vec, asks)``: distinct vectors, named by their smallest id.

    Of the ids of equal vectors the ``keep_ids`` smallest are kept: no more can be among any
    query's nearest. The window's limit is applied before its shuffle, so a vector that a
    third of the rows share meets as few rows per task.
    """
    first = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= keep_ids)
    reps = few.groupBy("vec").agg(F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("ids"))
    asked = queries.groupBy("vec").agg(F.lit(True).alias("asks"))
    return reps.join(asked, "vec", "left").select("rep", "ids", "vec", F.coalesce("asks", F.lit(False)).alias("asks"))


def _true_neighbours(reps: DataFrame, forest: Forest, asked: pa.Table, n: int) -> list[tuple[int, int]]:
    """``(query, prefix)``: for each of the sampled queries' ``n`` nearest vectors, by
    comparison with all, the longest prefix that any tree has in common with the query."""
    q = _matrix(asked.column("vec").combine_chunks(), forest.dimensions)
    q_ids, q_strings = asked.column("rep").to_numpy(), forest.query_strings(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1), forest.dimensions)
            scores = q @ x.T
            scores[q_ids[:, None] == ids[None, :]] = -np.inf
            a, b = best(scores, n)
            prefix = _prefix_bits(q_strings[a], forest.row_strings(x)[b]).max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(ids[b]), pa.array(scores[a, b]), pa.array(prefix)], ["q", "rep", "score", "prefix"]
            )

    found = reps.select("rep", "vec").mapInArrow(run, "q bigint, rep bigint, score double, prefix bigint")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    nearest = found.withColumn("k", F.row_number().over(order)).filter((F.col("k") <= n) & (F.col("score") > float("-inf")))
    return [(r["q"], r["prefix"]) for r in nearest.select("q", "prefix").collect()]


def fit(reps: DataFrame, n: int = NEIGHBOURS, trees: int = TREES, leaf_rows: int = LEAF_ROWS) -> Forest | None:
    """The forest for the distinct vectors ``reps``; None if there are none.

    It is fitted on about ``SAMPLE_ROWS`` vectors (the lowest hashes; all, if fewer) and
    ``SAMPLE_QUERIES`` queries, whose true neighbours come from a comparison with all rows.
    ``need`` is the least number of sample rows to ascend for that keeps ``TARGET_RECALL``
    of these neighbours; if none does, all rows are candidates.
    """
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    told = reps.agg(
        F.count(F.lit(1)).alias("rows"), F.max(length).alias("longest"), F.max(F.size("vec")).alias("dimensions")
    ).first()
    if not told["rows"]:
        return None
    rows = told["rows"]
    forest = Forest(told["dimensions"], told["longest"], trees)
    share = min(1.0, SAMPLE_ROWS / rows)
    drawn = F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(1 << 30)) < F.lit(round(share * (1 << 30)))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = forest.row_strings(_matrix(batch.column(0), forest.dimensions))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.list_(pa.int64()))], ["s"])

    sample = reps.filter(drawn).select("vec").mapInArrow(strings, "s array<bigint>").toArrow().column("s").combine_chunks()
    forest.fit_arrays(sample.flatten().to_numpy().reshape(-1, trees), rows, leaf_rows)
    asked = reps.filter("asks").orderBy(F.xxhash64("rep", F.lit(SEED))).limit(SAMPLE_QUERIES).select("rep", "vec").toArrow()
    truth = np.array(_true_neighbours(reps, forest, asked, n), np.int64).reshape(-1, 2)
    asked_strings = forest.query_strings(_matrix(asked.column("vec").combine_chunks(), forest.dimensions))
    need, recall = n + 1, 0.0
    everything = trees * forest.sample.shape[1]
    while need <= everything:
        level = forest.ascend(asked_strings, need, n + 2)
        recall = float((truth[:, 1] >= level[truth[:, 0]]).mean()) if len(truth) else 1.0
        if recall >= TARGET_RECALL:
            break
        need = need + max(1, need // 5)
    forest.need = need
    return forest


def _deal(forest: Forest, n: int):
    """Arrow function: every vector into its part of each tree's array, every query to the
    parts below its prefixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vec = batch.column(0).to_numpy(), batch.column(1)
            x = _matrix(vec, forest.dimensions)
            strings = forest.row_strings(x)
            parts = forest.row_parts(strings, ids)
            for t in range(forest.trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts[:, t]), pa.array(np.full(len(ids), -1)), pa.array(strings[:, t]), batch.column(0), vec],
                    ["part", "level", "string", "rep", "vec"],
                )
            asks = np.nonzero(batch.column(2).to_numpy(zero_copy_only=False))[0]
            if not len(asks):
                continue
            strings = forest.query_strings(x[asks])
            level = forest.ascend(strings, forest.need, n + 2)
            shift = (BITS - level).astype(np.int64)
            for t in range(forest.trees):
                lo = strings[:, t] >> shift << shift
                first = np.searchsorted(forest.starts[t], lo, "right") - 1
                last = np.searchsorted(forest.starts[t], lo + (np.int64(1) << shift), "left") - 1
                begin, end = forest.bases[t][first], forest.bases[t][last + 1]
                who = np.repeat(np.arange(len(asks)), end - begin)
                part = np.arange(len(who)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin) + begin[who]
                take = pa.array(asks[who])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(level[who]), pa.array(lo[who]), batch.column(0).take(take), vec.take(take)],
                    ["part", "level", "string", "rep", "vec"],
                )

    return run


def _compare(rows: pa.RecordBatch, dimensions: int, n: int) -> Iterator[pa.RecordBatch]:
    """The best of one part for each query that reaches it; rows come sorted by string."""
    level, string, ids = (rows.column(c).to_numpy() for c in ("level", "string", "rep"))
    x = _matrix(rows.column("vec"), dimensions)
    own, asks = np.nonzero(level < 0)[0], np.nonzero(level >= 0)[0]
    if not len(own) or not len(asks):
        return
    lo = np.searchsorted(string[own], string[asks])
    hi = np.searchsorted(string[own], string[asks] + (np.int64(1) << (BITS - level[asks]).astype(np.int64)))
    order = np.lexsort((hi, lo))
    asks, lo, hi = asks[order], lo[order], hi[order]
    starts = np.nonzero(np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])[0]
    for at, until in zip(starts.tolist(), [*starts[1:].tolist(), len(asks)]):
        below = own[lo[at] : hi[at]]
        if not len(below):
            continue
        step = max(1, BLOCK_SCORES // len(below))
        for cut in range(at, until, step):
            some = asks[cut : min(cut + step, until)]
            a, b = best(x[some] @ x[below].T, n)
            a, b = some[a], below[b]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[a]), pa.array(ids[b]), pa.array(exact_scores(x[a], x[b]))], ["asker", "rep", "score"]
            )


def _search(dimensions: int, n: int):
    """Arrow function over rows sorted by part and string: whole parts one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            part = batch.column(0).to_numpy()
            cuts = [0, *(np.nonzero(part[1:] != part[:-1])[0] + 1).tolist(), len(part)]
            for at, until in zip(cuts, cuts[1:]):
                if at == until:
                    continue
                if held and held[-1].column(0)[0] != batch.column(0)[at]:
                    yield from _compare(pa.Table.from_batches(held).combine_chunks().to_batches()[0], dimensions, n)
                    held = []
                held.append(batch.slice(at, until - at))
        if held:
            yield from _compare(pa.Table.from_batches(held).combine_chunks().to_batches()[0], dimensions, n)

    return run


def nearest(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    n: int = NEIGHBOURS,
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``n`` nearest found by inner product.

    Queries are the rows whose key ``every`` divides, candidates all others. A tree is the
    array of all vectors in the order of their hash strings, dealt in stretches over the
    tasks. A query descends in every tree to its longest prefix and then ascends in all of
    them in step until enough rows stand below (``fit``); these are compared in double
    precision. Dense regions are left early, so no frequent prefix is compared with itself
    as a whole. Ties go to the smaller key.

    A vector that is NULL, zero or has a NULL or non-finite component takes no part, nor
    does a row with a NULL key. Of a repeated key the smallest vector counts. Equal vectors
    are searched once. Shorter vectors are padded with zeros. With fewer candidates than
    ``n`` all are returned; an empty table gives no rows.
    """
    rows = keep(_usable(vectors, key, vector))
    queries = rows.filter(F.col("id") % every == 0)
    reps = keep(_distinct(rows, queries, n + 1))
    forest = fit(reps, n, trees, leaf_rows)
    if forest is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    kind = reps.schema["vec"].dataType.simpleString()
    dealt = reps.select("rep", "vec", "asks").mapInArrow(
        _deal(forest, n), f"part bigint, level bigint, string bigint, rep bigint, vec {kind}"
    )
    by_part = dealt.repartition("part").sortWithinPartitions("part", "string")
    found = by_part.mapInArrow(_search(forest.dimensions, n + 1), "asker bigint, rep bigint, score double")
    # trees find the same vector
    distinct = found.groupBy("asker", "rep").agg(F.max("score").alias("score"))
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "rep")
    top = keep(distinct.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= n + 1))
    named = top.join(reps.select("rep", "ids"), "rep").select("asker", "score", F.explode("ids").alias("vec_id"))
    asking = queries.join(reps.filter("asks").select("vec", F.col("rep").alias("asker")), "vec").select(F.col("id").alias("query_id"), "asker")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asking.join(named, "asker")
        .filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= n)
        .select("query_id", "rank", "vec_id", "score")
    )
