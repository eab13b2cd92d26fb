"""Best-fit decreasing packing of token sequences into fixed windows."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

CAPACITY = 2048
SPACE = " \t\n\v\f\r"
SEGMENT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# anything else that some definition takes for white space
OTHER_SPACE = r"\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}"
OTHER = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{int(m[1], 16):04x}", f"[{OTHER_SPACE}]"))
# texts that are more than words with a single blank or line feed between; empty ones
UNUSUAL = rf"  |\n\n| \n|\n |[\t\v\f\r{OTHER_SPACE}]|^[ \n]|[ \n]$|^$"
# segments that cannot stand behind others: without white space in front, or with some behind
APART = rf"^[^{SPACE}]|[{SPACE}]$"
# segments and bytes of them a task remembers before it forgets rare ones, and segments
# encoded in one go
KNOWN_SEGMENTS = 500_000
REMEMBERED_BYTES = 64 << 20
GROUP = 1000
# texts whose segments are looked up at once, and bytes of them
SLICE_TEXTS = 1024
SLICE_BYTES = 4 << 20


class SegmentEncoder:
    """The tokenizer's ids of whole texts, by remembered segments.

    A segment is a run of ASCII white space and the run without any behind it. The split
    into words neither looks back before such a run nor beyond a segment's end, so the
    segments' ids joined are the text's. Where other white space may stand beside it, the
    text is encoded in one piece.
    """

    def __init__(self, path: str, remember: int = KNOWN_SEGMENTS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        # a token's name has a character for each of its bytes
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        self.sizes[list(vocab.values())] = [len(name) for name in vocab]
        self.remember = remember
        # the remembered keys, and where the ids of each begin and end
        self.keys = pa.array([], pa.string())
        self.starts = self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")

    def _encode(self, values: list[str]) -> list[array]:
        found = self.library.encode_batch_fast(values, add_special_tokens=False)
        return [array("I", e.ids) for e in found]

    def _learn(self, keys: pa.Array) -> None:
        """Remember the segments of new keys. Those with white space in front are encoded
        many at a time, one behind the other as they stand in Arrow's buffer; the tokens'
        sizes tell where each one ends."""
        segments = _segments(keys)
        apart = pc.match_substring_regex(segments, APART)
        alone, joined = segments.filter(apart), segments.filter(pc.invert(apart))
        ends = np.frombuffer(joined.buffers()[1], "<i4", len(joined) + 1) if len(joined) else np.zeros(1, "<i4")
        borders = [*ends[:-1:GROUP].tolist(), int(ends[-1])]
        text = joined.buffers()[2] if len(joined) else b""
        groups = [text[lo:hi] for lo, hi in zip(borders, borders[1:])]
        raw = self._encode([*(g.to_pybytes().decode() for g in groups), *alone.to_pylist()])
        ids = np.frombuffer(b"".join(raw), "<u4")
        n = np.array([len(r) for r in raw], np.int64)
        behind = int(n[: len(groups)].sum())
        reached = np.cumsum(self.sizes[ids[:behind]])
        stops = np.searchsorted(reached, ends[1:] - ends[0]) + 1
        counts = np.r_[np.diff(stops, prepend=0), n[len(groups) :]]
        base = len(self.ids)
        self.keys = pa.concat_arrays([self.keys, keys.filter(pc.invert(apart)), keys.filter(apart)])
        self.ids = np.r_[self.ids, ids]
        self.starts = np.r_[self.starts, base + np.cumsum(counts) - counts]
        self.counts = np.r_[self.counts, counts]

    def _known(self, keys: pa.Array) -> np.ndarray:
        """Numbers of the remembered keys that equal ``keys``, which are all different."""
        if len(self.keys) > self.remember or self.keys.nbytes > REMEMBERED_BYTES:
            # what these texts use stays, so that common words are not learned anew
            used = pc.drop_null(pc.index_in(keys, self.keys)).to_numpy()
            counts = self.counts[used]
            self.ids = _take_runs(self.ids, self.starts[used], counts)
            self.keys, self.counts = self.keys.take(pa.array(used)), counts
            self.starts = np.cumsum(counts) - counts
        found = pc.index_in(keys, self.keys)
        if found.null_count:
            self._learn(keys.filter(pc.is_null(found)))
            found = pc.index_in(keys, self.keys)
        return found.to_numpy()

    def _usual(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and all ids, of texts of single blanks and line feeds.

        Arrow finds the segments and which of them are equal; each different one is looked
        up once, and its ids are copied by place.
        """
        # the key of a word behind a blank is the word, the first one's begins with \r
        marked = pc.replace_substring(pc.binary_join_element_wise("\r", values, ""), "\n", " \n")
        rows = pc.split_pattern(marked, " ")
        coded = rows.flatten().dictionary_encode()
        at = self._known(coded.dictionary)[coded.indices.to_numpy()]
        reached = np.r_[0, np.cumsum(self.counts[at])]
        taken = _take_runs(self.ids, self.starts[at], self.counts[at])
        return np.diff(reached[rows.offsets.to_numpy() - rows.offsets[0].as_py()]), taken

    def _unusual(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole = [bool(OTHER.search(v)) for v in values]
        keys = [[] if w else _keys(v) for v, w in zip(values, whole)]
        flat = list({k for row in keys for k in row})
        at = dict(zip(flat, self._known(pa.array(flat, pa.string()))))
        alone = iter(self._encode([v for v, w in zip(values, whole) if w]))
        found = []
        for row, w in zip(keys, whole):
            places = np.array([at[k] for k in row], np.int64)
            taken = _take_runs(self.ids, self.starts[places], self.counts[places])
            found.append(np.frombuffer(next(alone), "<u4") if w else taken)
        return np.array([len(f) for f in found], np.int64), np.concatenate(found)

    def encode(self, values: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of some values, their numbers of ids, and these one text after the other;
        every value comes once."""
        odd = pc.match_substring_regex(values, UNUSUAL).to_numpy(zero_copy_only=False)
        for run, places in ((self._usual, np.nonzero(~odd)[0]), (self._unusual, np.nonzero(odd)[0])):
            if len(places):
                some = values.take(pa.array(places))
                yield places, *run(some if run == self._usual else some.to_pylist())


def _keys(text: str) -> list[str]:
    """The keys of a text's segments.

    The key of a segment is itself, but for the usual one, a blank and a word: there it is
    the word. A first word, without a blank, is marked by a carriage return.
    """
    plain = [g[0] == " " and g[1:2] not in ("", *SPACE) for g in SEGMENT.findall(text)]
    return [g[1:] if p else "\r" + g for g, p in zip(SEGMENT.findall(text), plain)]


def _segments(keys: pa.Array) -> pa.Array:
    """The segments of keys, in an array of its own."""
    marked, led = pc.starts_with(keys, "\r"), pc.starts_with(keys, "\n")
    behind_blank = pc.binary_join_element_wise(" ", keys, "")
    unmarked = pc.replace_substring_regex(keys, "^\r", "")
    return pc.if_else(marked, unmarked, pc.if_else(led, keys, behind_blank))


def _take_runs(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``counts`` values from ``starts`` on, one behind the other."""
    reached = np.cumsum(counts)
    return values[np.repeat(starts - (reached - counts), counts) + np.arange(counts.sum())]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    remember: int = KNOWN_SEGMENTS,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: each whole text's ids in pieces that fit.

    The ids are the tokenizer's without special ones, then id 0. A document of more than
    ``capacity`` ids is cut into pieces of that length, the first of which may be shorter;
    ``start`` counts the document's ids before the piece. ``ids`` is the piece's ids as
    little-endian unsigned 32-bit numbers. A NULL or empty text is the end id alone.
    ``tokenizer`` is a file that every executor can open. A task remembers the ids of about
    ``remember`` segments, which bounds its memory. A narrow step.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SegmentEncoder(tokenizer, remember)
        for batch in batches:
            for part in _slices(batch):
                for places, sizes, ids in encoder.encode(pc.fill_null(part.column(1), "").cast(pa.string())):
                    yield _pieces(part.column(0).take(pa.array(places)), sizes, ids, capacity)

    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary"
    )


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``SLICE_TEXTS`` texts and, if more than one, ``SLICE_BYTES``."""
    reached = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())]
    at = 0
    while at < batch.num_rows:
        fitting = int(np.searchsorted(reached, reached[at] + SLICE_BYTES, "right")) - 1 - at
        yield batch.slice(at, max(1, min(fitting, SLICE_TEXTS)))
        at += max(1, min(fitting, SLICE_TEXTS))


def _pieces(keys: pa.Array, sizes: np.ndarray, ids: np.ndarray, capacity: int) -> pa.RecordBatch:
    """The pieces of texts with ``sizes`` ids, which stand one after the other in ``ids``."""
    ended = np.zeros(len(ids) + len(sizes), "<u4")
    ended[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
    sizes = sizes + 1
    pieces = -(-sizes // capacity)
    row = np.repeat(np.arange(len(sizes)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    head = (sizes - (pieces - 1) * capacity)[row]
    length = np.where(piece == 0, head, capacity)
    ends = np.r_[0, 4 * np.cumsum(length)]
    binary = pa.Array.from_buffers(
        pa.large_binary(), len(length), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ended)]
    )
    return pa.RecordBatch.from_arrays(
        [
            keys.take(pa.array(row)),
            pa.array(piece.astype(np.int32)),
            pa.array(np.where(piece == 0, 0, head + (piece - 1) * capacity)),
            pa.array(length),
            binary.cast(pa.binary()),
        ],
        ["doc_id", "piece", "start", "length", "ids"],
    )


# ---------------------------------------------------------------- plan

class CapacityTree:
    """Segment tree over remaining capacities; says which of them have an open bin."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        at = capacity + self.leaves
        self.open[at] = is_open
        while at > 1:
            at >>= 1
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def tightest(self, least: int) -> int:
        """Smallest open capacity of ``least`` or more; -1 if there is none."""
        at = least + self.leaves
        if self.open[at]:
            return least
        while at > 1:
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for ``counts[length]`` pieces of each length.

    Rows ``(length, rank, n, per_bin, first_bin, offset)``: the ``n`` pieces of that
    length from number ``rank`` on go ``per_bin`` to a bin into the bins from
    ``first_bin`` on, behind ``offset`` tokens. It is what placing piece after piece into
    the tightest open bin gives: equal pieces fill the tightest bin before the next, and
    bins of equal room are interchangeable, so whole runs of bins are placed at once.

    A length opens at most two runs of bins more than it uses up, and a run used by a
    length is left with less than half its room. So there are fewer than
    ``3 * capacity * log2(capacity)`` rows, however many pieces there are.
    """
    tree, rooms, plan, bins = CapacityTree(capacity), {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            rooms.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room < 0:
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            per_bin = room // length
            used = min(left, n * per_bin)
            full, rest = divmod(used, per_bin)
            plan.append((length, rank, used, per_bin, first, capacity - room))
            put(room - per_bin * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room, first + full + bool(rest), n - full - bool(rest))
            rank, left = rank + used, left - used
    return plan


# ---------------------------------------------------------------- placing

def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is 1 to ``capacity``.

    Best-fit decreasing over all pieces at once. It depends on the pieces' lengths alone,
    so the plan is made from their histogram (at most ``capacity`` numbers reach the
    driver) and has a bounded number of rows; a piece then finds its place from its number
    among the pieces of its length. That number is the number within its task, taken as
    the rows are written, plus those of the tasks before: no length, however frequent,
    meets in one task. Rows are written twice to the shared folder, so they should be
    narrow. Columns named ``sequence_id`` or ``offset`` are replaced; an empty table
    gives no rows.
    """
    cols = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    fields = [f for f in pieces.schema.fields if f.name in cols]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            length = batch.column(cols.index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            first = np.searchsorted(ordered, ordered)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - first + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(length), task, np.int32)), pa.array(rank)],
                [*cols, "__task", "__rank"],
            )

    # written before they are numbered: Python workers of two steps need not live side by
    # side, and the narrow rows are read again by few tasks, so there are few numbers to add up
    narrow = keep(pieces.select(*cols))
    rows = keep(narrow.mapInArrow(number, f"{schema}, __task int, __rank bigint"))
    per_task = rows.groupBy("length", "__task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    bases = keep(
        per_task.select(
            "length", "__task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base")
        )
    )
    counts = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(best_fit_plan(counts, capacity), np.int64).reshape(-1, 6)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    # one number orders the plan by length and rank
    span = int(max(counts.values(), default=0)) + 1
    starts = plan[:, 0] * span + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
            length, rank = get("length"), get("__rank") + get("__base")
            _, first_rank, _, per_bin, first_bin, offset = plan[
                np.searchsorted(starts, length * span + rank, "right") - 1
            ].T
            nth = rank - first_rank
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(batch.schema.get_field_index(c)) for c in cols],
                    pa.array(first_bin + nth // per_bin),
                    pa.array(offset + nth % per_bin * length),
                ],
                [*cols, "sequence_id", "offset"],
            )

    numbered = rows.join(bases.select("length", "__task", "__base"), ["length", "__task"])
    return numbered.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def packed_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the ids of each window, from pieces with ``ids``."""
    where = placed.select("doc_id", "piece", "sequence_id", "offset")
    parts = pieces.select("doc_id", "piece", "ids").join(where, ["doc_id", "piece"])
    listed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(
        F.aggregate(listed, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids")
    )
