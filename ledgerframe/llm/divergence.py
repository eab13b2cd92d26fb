"""How far the sources of a language differ in their words, by in-mapper stripes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, slices

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
# cells of stripes that a task folds before it spills them to the shuffle
SPILL_CELLS = 400_000
# partial stripes merged, and pairs of cells compared, at once
MERGE_ROWS = 1 << 16
PAIR_CELLS = 1 << 20
STRIPE = "lang string, term binary, df bigint, sources array<string>, counts array<bigint>"
# bytes outside terms become blanks; every byte of a character beyond ASCII is inside
TERM_BYTES = bytes(
    b if chr(b).isalpha() and b < 0x80 or b >= 0x80 else 0x20 for b in range(256)
)


def term_counts(text: bytes) -> Counter:
    """How often each term stands in a UTF-8 text; only A-Z are lower-cased."""
    return Counter(text.lower().translate(TERM_BYTES).split())


# ---------------------------------------------------------------- stripes

def _stripe_batch(langs: list, terms: list, dfs: list, sizes: list, sources: pa.Array, counts: pa.Array) -> pa.RecordBatch:
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(terms, pa.binary()), pa.array(dfs, pa.int64()),
         pa.ListArray.from_arrays(offsets, sources), pa.ListArray.from_arrays(offsets, counts)],
        ["lang", "term", "df", "sources", "counts"],
    )


def _fold(spill_cells: int):
    """Arrow function: whole documents folded into stripes, spilled when they outgrow a bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, dict[bytes, list]] = {}  # lang -> term -> [df, {source: count}]
        cells = 0

        def spilled() -> Iterator[pa.RecordBatch]:
            for lang, stripes in table.items():
                items = list(stripes.items())
                for at in range(0, len(items), MERGE_ROWS):
                    part = items[at : at + MERGE_ROWS]
                    yield _stripe_batch(
                        [lang] * len(part), [t for t, _ in part], [s[0] for _, s in part], [len(s[1]) for _, s in part],
                        pa.array([k for _, s in part for k in s[1]], pa.string()),
                        pa.array([n for _, s in part for n in s[1].values()], pa.int64()),
                    )

        for batch in batches:
            for rows in slices([batch]):
                for lang, source, text in zip(*(c.to_pylist() for c in rows.columns)):
                    stripes = table.setdefault(lang, {})
                    for term, n in term_counts(text).items():
                        stripe = stripes.get(term)
                        if stripe is None:
                            stripes[term] = [1, {source: n}]
                            cells += 2
                        else:
                            stripe[0] += 1
                            seen = stripe[1].get(source)
                            cells += seen is None
                            stripe[1][source] = n + (seen or 0)
                    if cells > spill_cells:
                        yield from spilled()
                        table, cells = {}, 0
        yield from spilled()

    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For all cells of all stripes: the stripe's row, the source, the count."""
    sources, counts = batch.column(3), batch.column(4)
    sizes = np.diff(counts.offsets.to_numpy())
    return np.repeat(np.arange(batch.num_rows), sizes), sources.flatten(), counts.flatten().to_numpy()


def merge_stripes(rows: pa.Table) -> pa.RecordBatch:
    """One stripe per (lang, term) of rows sorted by them."""
    batch = rows.combine_chunks().to_batches()[0]
    langs = batch.column(0).dictionary_encode()
    terms = batch.column(1).dictionary_encode()
    lang, term = langs.indices.to_numpy(), terms.indices.to_numpy()
    first = np.nonzero(np.r_[True, (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])])[0]
    row, source, count = _flat(batch)
    names = source.dictionary_encode()
    stripe = np.searchsorted(first, row, "right") - 1
    cell = stripe * max(1, len(names.dictionary)) + names.indices.to_numpy()
    order = np.argsort(cell, kind="stable")
    starts = np.nonzero(np.r_[True, np.diff(cell[order]) != 0][: len(order)])[0]
    return _stripe_batch(
        batch.column(0).take(pa.array(first)), batch.column(1).take(pa.array(first)),
        np.add.reduceat(batch.column(2).to_numpy(), first),
        np.bincount(stripe[order][starts], minlength=len(first)),
        source.take(pa.array(order[starts])),
        pa.array(np.add.reduceat(count[order], starts) if len(starts) else np.empty(0, np.int64)),
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges sorted partial stripes; of a block's last key the merged stripe is carried on,
    so however many partial stripes a term has, few are held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, MERGE_ROWS):
            held.append(batch.slice(at, MERGE_ROWS))
            if sum(b.num_rows for b in held) >= MERGE_ROWS:
                merged = merge_stripes(pa.Table.from_batches(held))
                yield merged.slice(0, merged.num_rows - 1)
                held = [merged.slice(merged.num_rows - 1)]
    if held:
        yield merge_stripes(pa.Table.from_batches(held))


def stripes(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", spill_cells: int = SPILL_CELLS
) -> DataFrame:
    """``(lang, term, df, sources, counts)``: one merged stripe per term of a language.

    ``df`` counts the documents (rows) with the term, ``counts`` its occurrences in each of
    ``sources``. Partitions fold whole documents before anything is shuffled, so a frequent
    term costs a few rows per task. NULLs read as ''.
    """
    picked = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))],
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    spilled = picked.mapInArrow(_fold(spill_cells), STRIPE)
    sorted_by_key = spilled.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return sorted_by_key.mapInArrow(_merge, STRIPE)


# ---------------------------------------------------------------- divergences

def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / total)``, exact: three decimal digits at a time."""
    left, out = count + 1, np.zeros_like(count)
    for _ in range(3):
        whole, left = np.divmod(left * 1000, total)
        out = out * 1000 + whole
    return out + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def share(count: Column | str, total: Column | str) -> Column:
    """``_share`` as a column."""
    count = F.col(count) if isinstance(count, str) else count
    total = F.col(total) if isinstance(total, str) else total
    scaled = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", scaled, total.cast("decimal(19,0)")) + 1


def apart(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _emit(groups: list[tuple[str, str, int, int]], totals: dict[str, int]):
    """Arrow function over merged stripes: divergences of terms, and for each two sources
    that share terms how much their sum differs from that of sources that share none."""
    number = {(lang, source): i for i, (lang, source, _, _) in enumerate(groups)}
    total = np.array([n + v for _, _, n, v in groups], np.int64)

    def pairs(stripe: np.ndarray, group: np.ndarray, p: np.ndarray, none: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        first = np.searchsorted(stripe, stripe)
        size = np.searchsorted(stripe, stripe, "right") - first
        done = np.cumsum(size)
        cut = 0
        while cut < len(stripe):
            # whole cells, each with all cells of its stripe
            end = max(cut + 1, int(np.searchsorted(done, (done[cut - 1] if cut else 0) + PAIR_CELLS, "right")))
            a = np.repeat(np.arange(cut, end), size[cut:end])
            b = np.arange(len(a)) - np.repeat(np.cumsum(size[cut:end]) - size[cut:end], size[cut:end]) + first[a]
            a, b = a[a != b], b[a != b]
            more = _apart(p[a], p[b]) - _apart(p[a], none[b]) - _apart(none[a], p[b]) + _apart(none[a], none[b])
            code = group[a] * len(groups) + group[b]
            order = np.argsort(code, kind="stable")
            starts = np.nonzero(np.r_[True, np.diff(code[order]) != 0][: len(order)])[0]
            if len(starts):
                yield code[order][starts], np.add.reduceat(more[order], starts)
            cut = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            row, source, count = _flat(batch)
            langs = batch.column(0).to_pylist()
            group = np.array([number[langs[r], s] for r, s in zip(row.tolist(), source.to_pylist())], np.int64)
            p, none = _share(count, total[group]), _share(np.zeros_like(count), total[group])
            for code, value in pairs(row, group, p, none):
                for c, v in zip(code.tolist(), value.tolist()):
                    sums[c] = sums.get(c, 0) + v
            first = np.searchsorted(row, np.arange(batch.num_rows))
            all_counts = np.add.reduceat(count, first)
            q = _share(all_counts, np.array([totals[g] for g in langs], np.int64))[row]
            up = np.nonzero(p > q)[0]
            take = pa.array(row[up])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), source.take(pa.array(up)), pa.array(["term"] * len(up), pa.string()),
                 batch.column(1).take(take), pa.array(_apart(p[up], q[up]))],
                ["lang", "source", "part", "item", "value"],
            )
        found = [(*groups[c // len(groups)][:2], "pair", groups[c % len(groups)][1].encode(), v) for c, v in sums.items()]
        if found:
            kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["lang", "source", "part", "item", "value"]
            )

    return run


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    spill_cells: int = SPILL_CELLS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how each source of a language differs.

    A language keeps the V terms of at least ``min_docs`` of its documents. A term's share
    in a source is ``p = 1 + floor(10^9 (count + 1) / (N + V))``, N being the source's
    occurrences of kept terms; the divergence of p from q is ``floor((p - q)^2 / q)``. Part
    ``pair`` sums it over all kept terms against each other source of the language; part
    ``term`` has the ``top_terms`` terms that are more frequent in the source than in its
    language. All arithmetic is exact. Value descends with the rank; ties by item.

    Only sources that share a term meet in its stripe. What a pair's sum would be if they
    shared none follows from how many terms a source has how often, and the stripes add
    the difference. So work grows with the stripes, not with terms times sources squared.
    The groups (lang, source) reach the driver and the tasks: the result has a row for
    every two sources of a language, so their number is below the root of its rows.

    Every row counts, repeated ones too; NULL text, lang and source read as ''. A source
    without terms has pairs (value 0 where V is 0) and no term rows; a language's only
    source has no pairs; an empty table gives no rows. Texts of any length are folded whole.
    """
    kept = keep(stripes(docs, text, lang, source, spill_cells).filter(F.col("df") >= min_docs))
    cells = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).select(
        "lang", F.col("c.sources").alias("source"), F.col("c.counts").alias("c")
    )
    seen = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    ).distinct()
    # how many terms a source has how often
    spread = keep(cells.groupBy("lang", "source", "c").agg(F.count(F.lit(1)).alias("terms")))
    held = spread.groupBy("lang", "source").agg(F.sum(F.col("c") * F.col("terms")).alias("n"), F.sum("terms").alias("own"))
    groups = keep(
        seen.join(held, ["lang", "source"], "left")
        .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left")
        .fillna(0, ["n", "own", "v"])
        .withColumn("none", F.when(F.col("n") + F.col("v") > 0, share(F.lit(0), F.col("n") + F.col("v"))))
    )
    found = [(r["lang"], r["source"], r["n"], r["v"]) for r in groups.collect()]
    totals: dict[str, int] = {}
    for code, _, n, v in found:
        totals[code] = totals.get(code, v) + n
    emitted = keep(kept.mapInArrow(_emit(found, totals), "lang string, source string, part string, item binary, value bigint"))

    other = groups.select("lang", *[F.col(c).alias(f"other_{c}") for c in ("source", "n", "own", "none")])
    both = groups.join(other, "lang").filter(F.col("source") != F.col("other_source"))
    apart_none = F.when(F.col("v") == 0, 0).otherwise((F.col("v") - F.col("own") - F.col("other_own")) * apart("none", "other_none"))
    # each source's terms against the share of a term the other has not, and the reverse
    shared = spread.join(groups.drop("own"), ["lang", "source"]).withColumn("p", share("c", F.col("n") + F.col("v")))
    against = shared.join(groups.select("lang", F.col("source").alias("other_source"), F.col("none").alias("other_none")), "lang").filter(
        F.col("source") != F.col("other_source")
    )
    parts = (
        both.select("lang", "source", F.col("other_source").alias("item"), apart_none.alias("value"))
        .unionAll(against.select("lang", "source", "other_source", F.col("terms") * apart("p", "other_none")))
        .unionAll(against.select("lang", "other_source", "source", F.col("terms") * apart("other_none", "p")))
        .unionAll(emitted.filter("part = 'pair'").select("lang", "source", F.col("item").cast("string"), "value"))
    )
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = emitted.filter("part = 'term'").select("lang", "source", F.col("item").cast("string").alias("item"), "value")
    top = terms.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top_terms)
    every = pairs.withColumn("rank", F.row_number().over(ranked))
    return every.withColumn("part", F.lit("pair")).unionByName(top.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank"
    )
