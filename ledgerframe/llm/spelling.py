"""Spelling variants one edit apart, by dynamic programming over sorted word lists."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, slices

MIN_CHARS = 5
MIN_COUNT = 3
MODULUS = 97
# distinct words that a task counts before it passes them on
SPILL_WORDS = 400_000
# words of a list beyond which the list is divided further
LIST_ROWS = 128
# A-Z are lower-cased first; what is no letter becomes a blank
LETTERS = bytes(b if chr(b).isascii() and chr(b).isalpha() or b >= 0xC0 else 0x20 for b in range(256))


# ---------------------------------------------------------------- words

def _variants(key: str, text: str, modulus: int, min_chars: int) -> Iterator[tuple[bytes, int]]:
    """``(word, n)`` of one text; words are in Latin-1, a byte for each code point."""
    # characters beyond Latin-1 become question marks, which are no letters
    runs = text.encode("latin-1", "replace").lower().translate(LETTERS).split()
    start = zlib.crc32(f"{key}:".encode())
    for run, n in Counter(runs).items():
        if len(run) < min_chars:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % modulus == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < min_chars:
                continue
        yield run, n


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, modulus: int = MODULUS,
) -> DataFrame:
    """``(word, n)``: words of at least ``min_chars`` code points and ``min_count`` occurrences.

    Words are runs of ASCII letters and U+00C0 to U+00FF, with A-Z in lower case. One run in
    ``modulus``, chosen by the CRC32 of key and run, loses a code point chosen by it. Tasks
    count before they shuffle. NULL texts have no words; a NULL key reads as ''.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def counted() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in counts], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

        for part in slices(batches):
            for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for word, n in _variants(k, t, modulus, min_chars):
                    counts[word] = counts.get(word, 0) + n
            if len(counts) > SPILL_WORDS:
                yield counted()
                counts = {}
        yield counted()

    picked = docs.filter(F.col(text).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).alias("t")
    )
    summed = picked.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return summed.filter(F.col("n") >= min_count)


# ---------------------------------------------------------------- edit matrix

def _row_steps() -> tuple[list[tuple[int, ...]], list[list[int]]]:
    """Rows of the edit matrix in a band of one either side, and how they follow.

    A row is the band's three cells, counted up to 2. The next row depends on the row and on
    which of the three letters beside the diagonal equal the letter read: bit 0 the one
    before, bit 1 the one on it, bit 2 the one behind.
    """
    rows = list(product(range(3), repeat=3))
    number = {row: i for i, row in enumerate(rows)}
    steps = []
    for before, on, behind in rows:
        out = []
        for bits in range(8):
            first = min(before + (not bits & 1), on + 1)  # diagonal, above
            second = min(on + (not bits & 2), behind + 1, first + 1)
            third = min(behind + (not bits & 4), second + 1)
            out.append(number[min(first, 2), min(second, 2), min(third, 2)])
        steps.append(out)
    return rows, steps


ROWS, STEPS = _row_steps()
START = ROWS.index((2, 0, 1))
DEAD = ROWS.index((2, 2, 2))
# the row's cell below the word's end, where the read word is one shorter, as long, one longer


def scan(query: str, words: list[str], shared: list[int]) -> tuple[list[int], int]:
    """Indices of the words one edit from ``query``, and how many rows that took.

    ``words`` are sorted and ``shared[i]`` is how many letters ``words[i]`` has in common
    with the word before. The rows of those letters are used again; where a row has no cell
    below two, all words that share the letters read so far are passed over unread.
    """
    size = len(query)
    padded = "\0" + query + "\0\0\0"
    found, rows, taken = [], [START], 0
    i, kept, end = 0, 0, len(words)
    while i < end:
        del rows[kept + 1 :]
        word, depth, state = words[i], kept, rows[kept]
        length = len(word)
        while depth < length and state != DEAD and depth <= size + 1:
            letter = word[depth]
            state = STEPS[state][
                (padded[depth] == letter) | (padded[depth + 1] == letter) << 1 | (padded[depth + 2] == letter) << 2
            ]
            rows.append(state)
            depth += 1
        taken += depth - kept
        i += 1
        if depth < length or state == DEAD:
            while i < end and shared[i] >= depth:
                i += 1
        elif -1 <= size - length <= 1 and ROWS[state][1 + size - length] == 1:
            found.append(i - 1)
        if i < end:
            kept = min(depth, shared[i])
    return found, taken


def common_start(a: str, b: str) -> int:
    n, most = 0, min(len(a), len(b))
    while n < most and a[n] == b[n]:
        n += 1
    return n


def shared_letters(words: list[str]) -> list[int]:
    return [0, *map(common_start, words, words[1:])]


# ---------------------------------------------------------------- lists

def _lists(words: DataFrame, list_rows: int) -> DataFrame:
    """``(key, m, a, b, word, n)``: every two words one edit apart meet in just one list.

    A list holds words of ``m`` and ``m + 1`` letters that agree before letter ``a`` and
    behind letter ``b`` of the shorter one, so that the edit lies between. Of two words one
    edit apart the common start tells where: its end can be taken for the edit. Lists start
    as halves; those of more than ``list_rows`` words are halved until they are short or
    leave one letter open, where the alphabet bounds them. So no list grows with the table.
    """
    size = F.char_length("word")

    def keyed(rows: DataFrame) -> DataFrame:
        ahead = F.col("word").substr(F.lit(1), F.col("a"))
        behind = F.col("word").substr(F.col("b") + size - F.col("m") + 1, size)
        return rows.withColumn("key", F.xxhash64("m", "a", "b", ahead, behind))

    def halved(rows: DataFrame) -> DataFrame:
        mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        two = F.array(F.struct(F.col("a").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b").alias("b")))
        return keyed(rows.withColumn("r", F.explode(two)).select("word", "n", "m", F.col("r.a").alias("a"), F.col("r.b").alias("b")))

    whole = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"))
    live = halved(whole.withColumn("a", F.lit(0)).withColumn("b", F.col("m")))
    done: DataFrame | None = None
    while True:
        live = keep(live)
        long = live.filter("b - a > 1").groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > list_rows)
        marked = keep(live.join(long.select("key", F.lit(True).alias("long")), "key", "left"))
        short = marked.filter("long IS NULL OR b - a <= 1").select("key", "m", "a", "b", "word", "n")
        done = short if done is None else done.unionAll(short)
        long_rows = marked.filter("long AND b - a > 1")
        if not long_rows.limit(1).count():
            return done
        live = halved(long_rows)


def _near(rows: pa.RecordBatch) -> pa.RecordBatch:
    """For each word of a list with near ones there: how many, and the most frequent."""
    m, a, b, counts = (rows.column(c).to_pylist() for c in ("m", "a", "b", "n"))
    words = rows.column("word").to_pylist()
    columns = [rows.column(c).to_numpy() for c in ("key", "m", "a", "b")]
    starts = np.nonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])[0].tolist()
    out: list[tuple[str, int, int, str]] = []
    for lo, hi in zip(starts, [*starts[1:], len(words)]):
        if hi - lo == 1:
            continue
        part, size, first, last = words[lo:hi], m[lo], a[lo], b[lo]
        shared = shared_letters(part)
        seen: dict[int, list] = {}

        def note(i: int, j: int) -> None:
            best = (-counts[lo + j], part[j])
            known = seen.get(i)
            if known is None:
                seen[i] = [1, best]
            else:
                known[0] += 1
                known[1] = min(known[1], best)

        for i, word in enumerate(part):
            if len(word) != size:
                continue
            for j in scan(word, part, shared)[0]:
                at = common_start(word, part[j])
                # elsewhere the two meet in another list; two of m + 1 letters do so too
                if first <= at and (at < last or last == size) and len(part[j]) >= size:
                    note(i, j)
                    if len(part[j]) > size:
                        note(j, i)
        out += [(part[i], n, -best[0], best[1]) for i, (n, best) in seen.items()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds],
        ["word", "n_near", "form_n", "form"],
    )


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole lists, a block of them at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < 1 << 14:
            continue
        block = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        key = block.column("key").to_numpy()
        cut = int(np.nonzero(key != key[-1])[0][-1]) + 1 if key[0] != key[-1] else 0
        if cut:
            yield _near(block.slice(0, cut))
        held = [block.slice(cut)]
    if held:
        yield _near(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


# ---------------------------------------------------------------- forms

def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the last form from each word on, over ``(word, form)``.

    Every round doubles the steps. A form is at least twice as frequent as its word, so
    there are fewer than 64 steps.
    """
    roots = keep(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = keep(roots.join(onward, "root", "left"))
        if not ahead.filter("next IS NOT NULL").limit(1).count():
            return roots
        roots = ahead.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(words: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for the distinct ``words (word, n)``.

    Words are near if they differ by one inserted, deleted or replaced code point. A word's
    form is its most frequent near word (ties: smallest in code-point order) if that is at
    least twice as frequent, else NULL; ``form_n`` is its frequency. The root is reached
    from form to form, the word itself if it has no form. ``n_near`` counts near words.
    Words are at least two code points long.
    """
    lists = _lists(words, list_rows)
    dealt = lists.repartition("key").sortWithinPartitions("key", "m", "a", "b", "word")
    partial = dealt.mapInArrow(_near_words, "word string, n_near bigint, form_n bigint, form string")
    near = partial.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    )
    is_form = -F.col("best.less") >= 2 * F.col("n")
    told = keep(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(told.filter("form IS NOT NULL"))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants_of_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``spelling_variants`` of the words of all whole texts; see ``word_counts``.

    Repeated rows count every time. A table without words, or an empty one, gives no rows.
    """
    return spelling_variants(keep(word_counts(docs, key, text)))
