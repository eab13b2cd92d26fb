"""SimHash near-duplicates through a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, texts
from .components import components

SHINGLE_WORDS = 4
HASH_SEED = 42
MAX_BITS = 4
# The 64 bits in six blocks. Fingerprints that differ in at most four bits agree in two
# blocks at least, so every link lies below one of the 15 upper nodes' masks.
BLOCKS = ((0, 11), (11, 22), (22, 33), (33, 44), (44, 54), (54, 64))
# fingerprints below one upper node that one task compares at once
NODE_ROWS = 2048
LEAF_ROWS = 32


# ---------------------------------------------------------------- fingerprints

def _fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    import xxhash

    parts = text.encode().lower().split()  # both work on ASCII alone
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) < shingle_words:
        cuts = [(0, len(joined))]
    else:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(sizes + 1) - 1
        cuts = list(zip((ends - sizes)[: len(parts) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist()))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(cuts), 1 << 16):  # bounded memory for a text of any length
        part = cuts[at : at + (1 << 16)]
        h = np.fromiter((digest(joined[a:b], HASH_SEED) for a, b in part), np.uint64, len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(cuts), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)``: the 64-bit SimHash of each whole text as a signed long.

    Words are runs without ASCII white space after lower-casing A-Z; a shingle is four
    words joined by blanks, every occurrence counts. A text of fewer words is one
    shingle, a text without words or a NULL has fingerprint 0. A narrow step.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in texts(batches):
            fps = pa.array([_fingerprint(t) for t in values], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, fp bigint")


# ---------------------------------------------------------------- index

def _spanning(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Lowest index reachable over the pairs (a, b), for each of ``size`` indices."""
    low = np.arange(size)
    while True:
        before = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        low = low[low]
        if np.array_equal(low, before):
            return low


def _leaf_pairs(codes: np.ndarray, other: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves whose shared bits alone do not differ too often.

    A leaf is a run of neighbours in Gray order. Its upper node keeps the bits all its
    members share and their mask; the differences of two nodes on bits both of them fix
    bound the distance of any two members from below.
    """
    def nodes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.arange(0, len(x), LEAF_ROWS)
        return np.bitwise_and.reduceat(x, starts), np.bitwise_or.reduceat(x, starts)

    (all_a, any_a), (all_b, any_b) = nodes(codes), nodes(other)
    apart = (all_a[:, None] & ~any_b[None, :]) | (~any_a[:, None] & all_b[None, :])
    return np.nonzero(np.bitwise_count(apart) <= bits)


def _close(codes: np.ndarray, other: np.ndarray, bits: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of at most ``bits`` differing bits; codes stand in Gray order."""
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    left, right = _leaf_pairs(codes, other, bits)
    for i, j in zip(left.tolist(), right.tolist()):
        if same and j < i:
            continue
        x, y = codes[i * LEAF_ROWS : (i + 1) * LEAF_ROWS], other[j * LEAF_ROWS : (j + 1) * LEAF_ROWS]
        p, q = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= bits)
        found_a.append(p + i * LEAF_ROWS)
        found_b.append(q + j * LEAF_ROWS)
    return np.concatenate(found_a), np.concatenate(found_b)


def _links(codes: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    """A link from each fingerprint to its group's representative, none to itself."""
    own = np.nonzero(low != np.arange(len(low)))[0]
    return pa.RecordBatch.from_arrays(
        [pa.array(codes[own].view(np.int64)), pa.array(codes[low[own]].view(np.int64))], ["a", "b"]
    )


def _run_links(node: np.ndarray, codes: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Links inside each run of equal ``node``; rows are sorted by node and Gray rank.

    Short runs are compared for all of them together, one distance in the order after
    the other; long runs go through their leaves. A group is linked as a star.
    """
    starts = np.nonzero(np.r_[True, node[1:] != node[:-1]])[0]
    sizes = np.diff(np.r_[starts, len(node)])
    short = np.repeat(sizes <= LEAF_ROWS, sizes)
    a_parts, b_parts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for step in range(1, min(LEAF_ROWS, int(sizes.max(initial=1)))):
        near = (node[step:] == node[:-step]) & short[step:]
        near &= np.bitwise_count(codes[step:] ^ codes[:-step]) <= bits
        at = np.nonzero(near)[0]
        a_parts.append(at)
        b_parts.append(at + step)
    a, b = np.concatenate(a_parts), np.concatenate(b_parts)
    if len(a):
        yield _links(codes, _spanning(a, b, len(codes)))
    for at, size in zip(starts[sizes > LEAF_ROWS].tolist(), sizes[sizes > LEAF_ROWS].tolist()):
        for cut in range(at, at + size, NODE_ROWS):
            own = codes[cut : min(cut + NODE_ROWS, at + size)]
            p, q = _close(own, own, bits, same=True)
            if len(p):
                yield _links(own, _spanning(p, q, len(own)))


def _linker(bits: int):
    """Arrow function over partitions sorted by (node, gray): links within each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def columns() -> tuple[np.ndarray, np.ndarray]:
            get = lambda k: np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held])
            return get(0), get(1).view(np.uint64)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 1 << 16:
                continue
            node, codes = columns()
            # the last run may go on in the next batch, unless it fills the block alone
            cut = int(np.searchsorted(node, node[-1])) or len(node)
            yield from _run_links(node[:cut], codes[:cut], bits)
            held = [pa.RecordBatch.from_arrays([pa.array(node[cut:]), pa.array(codes[cut:].view(np.int64))], ["node", "fp"])]
            held = [h for h in held if h.num_rows]
        if held:
            yield from _run_links(*columns(), bits)

    return run


def _upper_nodes(fps: DataFrame) -> DataFrame:
    """``(node, gray, fp)``: each fingerprint below the 15 masks of two blocks."""
    masks = [sum(((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in pair) for pair in combinations(BLOCKS, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    fp = F.col("fp")
    # the position in the sequence of Gray codes
    gray = fp
    for shift in (1, 2, 4, 8, 16, 32):
        gray = gray.bitwiseXOR(F.shiftrightunsigned(gray, shift))
    below = [F.xxhash64(F.lit(k), fp.bitwiseAND(F.lit(m))) for k, m in enumerate(signed)]
    # the rank is compared as a signed number, which moves the upper half of the order
    # before the lower one; neighbours stay neighbours
    return fps.select(gray.alias("gray"), "fp").select(
        F.explode(F.array(*below)).alias("node"), "gray", "fp"
    )


def near_links(fps: DataFrame, bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """``(a, b)``: links that connect just the fingerprints connected at ``bits`` bits.

    ``fps`` has distinct longs ``fp``. Every pair within ``bits`` bits lies below a common
    upper node; a node's members stand in Gray order, which brings shared bit patterns
    together, and are compared leaf by leaf. Instead of all pairs, stars are returned.

    A node of more than ``node_rows`` members is dealt out: first pieces of its Gray
    order link their own members, then the components found so far are carried to the
    node. A node with one component left needs nothing more; of the others, blocks of
    members are compared two by two, so that no task holds a node however large it is.
    """
    node_rows = min(node_rows, NODE_ROWS)
    nodes = _upper_nodes(fps)
    large = keep(
        nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > node_rows)
    )
    schema = "a bigint, b bigint"
    if not large.limit(1).count():
        dealt = nodes.repartition("node").sortWithinPartitions("node", "gray")
        return dealt.select("node", "fp").mapInArrow(_linker(bits), schema)
    small = nodes.join(large, "node", "left_anti").repartition("node").sortWithinPartitions("node", "gray")
    hot = nodes.join(large, "node")
    pieces = hot.repartitionByRange("node", "gray").sortWithinPartitions("node", "gray")
    first = keep(
        small.select("node", "fp").mapInArrow(_linker(bits), schema)
        .unionAll(pieces.select("node", "fp").mapInArrow(_linker(bits), schema))
    )
    roots = components(first).select(F.col("node").alias("fp"), "root")
    named = keep(hot.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    mixed = named.groupBy("node").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    side = F.ceil(F.col("size") / F.lit(node_rows)).cast("int")
    own = F.pmod(F.xxhash64("fp"), side).cast("int")
    blocks = (
        named.join(mixed.select("node"), "node", "left_semi")
        .select("node", "gray", "fp", "root", side.alias("side"), own.alias("own"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("side") - 1)))
        .select(
            F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("block"),
            F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("half"),
            "gray", "fp", "root",
        )
    )

    def compare(key: tuple, batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("gray")
        half = batch.column("half").to_numpy()
        codes = batch.column("fp").to_numpy().view(np.uint64)
        root = batch.column("root").to_numpy()
        inner = bool((half < 0).all())
        left, right = (np.arange(len(half)),) * 2 if inner else (np.nonzero(half == 0)[0], np.nonzero(half == 1)[0])
        got = []
        if len(left) and len(right) and root.min() != root.max():
            p, q = _close(codes[left], codes[right], bits, same=inner)
            p, q = left[p], right[q]
            new = root[p] != root[q]
            pairs = np.unique(np.sort(np.stack([root[p[new]], root[q[new]]], axis=1), axis=1), axis=0)
            got = [pairs]
        out = np.concatenate(got) if got else np.empty((0, 2), np.int64)
        return pa.table({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})

    second = blocks.groupBy("block").applyInArrow(compare, schema)
    return first.unionAll(second)


def near_components(
    prints: DataFrame, links: Callable[[DataFrame], DataFrame] = near_links
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row of ``(doc_id, fp)``.

    Rows whose fingerprints are connected by ``links`` (steps of at most four bits) share
    a component, named after its smallest doc_id; equal fingerprints are one step of none.
    NULL ids are ignored in the naming.
    """
    prints = keep(prints)
    fps = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(fps.select("fp"))).select(F.col("node").alias("fp"), "root")
    named = keep(fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = keep(named.groupBy("root").agg(F.min("first_id").alias("component_id")))
    of_fp = keep(named.join(least, "root").select("fp", "component_id"))
    return prints.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``near_components`` of the texts of ``docs``; fingerprints are taken once."""
    return near_components(fingerprints(docs, key, text))


def without_copies(docs: DataFrame, groups: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with the smallest key of each component of ``groups``.

    A key stays with all its rows if it is the smallest of any component, so a key that
    is repeated with other texts loses no group. Rows with a NULL key stay. Only the keys
    that go are joined back.
    """
    own = F.col("doc_id") == F.col("component_id")
    stays = groups.groupBy("doc_id").agg(F.max(own).alias("stays"))
    gone = keep(stays.filter("NOT stays").select(F.col("doc_id").alias(key)))
    return docs.join(gone, key, "left_anti").select(*docs.columns)


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the smallest key of each near-duplicate component at four bits."""
    return without_copies(docs, near_groups(docs, key, text), key)
