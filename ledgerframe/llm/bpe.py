"""BPE encoding over a trie of words, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import _slices

# distinct white-space-free chunks and bytes of them a worker remembers before it forgets
# those not in use (and words before it forgets all), and nodes its trie may hold before
# it starts anew
CACHE_CHUNKS = 400_000
CACHE_BYTES = 64 << 20
TRIE_NODES = 600_000
# two numbers make a key by an odd factor, which spreads keys over a dictionary
BYTES = 257
# chunks of printable ASCII and of the Latin-1 letters: none of them is normalised but to
# lower case, and these are their words, and the ends of chunks
LATIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\n a-z0-9ß-öø-ÿ]+|\n")


# the character that stands for a byte in a tokenizer file's names, and back
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_OF = dict(zip(SHOWN, SHOWN)) | {256 + n: b for n, b in enumerate(sorted({*range(256)}.difference(SHOWN)))}


def in_bytes(name: str) -> bytes:
    return name.translate(BYTE_OF).encode("latin-1")


class TrieEncoder:
    """Byte-pair encoding of many words over one trie.

    The encoding of a prefix ends in exactly one token, and what stands before it is the
    encoding of the prefix without it. So the last token is all a trie node has to know:
    it is the one token that ends there and may follow the last token of the node where
    it starts. Words share the nodes of their common beginnings, and those of earlier
    calls, until ``clear``.
    """

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            pair = (vocab[left], vocab[right])
            self.rank[pair] = rank
            self.made.setdefault(vocab[left + right], (*pair, rank))
        self.never = len(self.rank)
        # tokens inside a word and at its end, and what either may begin with
        self.inner = {in_bytes(n): t for n, t in vocab.items() if not (suffix and n.endswith(suffix))}
        self.final = {in_bytes(n.removesuffix(suffix)): t for n, t in vocab.items() if n.endswith(suffix)}
        begun = {n[:i] for n in chain(self.inner, self.final) for i in range(1, len(n))}
        self.tails = [b"", *begun.union(self.inner)]
        self.tail_at = {tail: at for at, tail in enumerate(self.tails)}
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.width = max(vocab.values()) + 1 | 1
        self.clear()

    def clear(self) -> None:
        """Forget the words and what was found out for them; a node is (its number, last token, its length, its tail), where
        the tail is the longest end of its prefix that a token begins with. The nodes stand
        in one dictionary by the number above and the byte, as plain numbers, which cost the
        garbage collector nothing."""
        self.root = (0, -1, 0, 0)
        self.nodes: dict[int, tuple[int, int, int, int]] = {}
        self.steps: dict[int, tuple[int, list, list]] = {}
        self.fit: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at a side (0 left, 1 right) of a token while it is being built:
        each part with the rank of the merge that ends it."""
        got = self.edges.get((token, side))
        if got is None:
            got, ends, part = [], self.never, token
            while part in self.made:
                got.append((part, ends))
                ends, part = self.made[part][2], self.made[part][side]
            got.append((part, ends))
            got.reverse()
            self.edges[token, side] = got
        return got

    def _follows(self, left: int, right: int) -> bool:
        """Whether no merge ever reaches across the border of two neighbouring tokens.

        Merges run by rank, equal ones from the left, and a merge ranks behind those that
        made its parts. So both borders are followed through time.
        """
        ours, theirs, i, j = self._edge(left, 1), self._edge(right, 0), 0, 0
        while True:
            (a, a_ends), (b, b_ends) = ours[i], theirs[j]
            across = self.rank.get((a, b), self.never + 1)
            if across < a_ends and across <= b_ends:
                return False
            if a_ends == b_ends == self.never:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def _step(self, key: int) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]]]:
        """For a tail and the next byte: the next tail, and the tokens that end here inside
        a word and at its end, each with its length, the longest first."""
        tail, byte = divmod(key, BYTES)
        reached = self.tails[tail] + bytes([byte])
        ends = [reached[i:] for i in range(len(reached) + 1)]
        got = self.steps[key] = (
            next(self.tail_at[e] for e in ends if e in self.tail_at),
            [(self.inner[e], len(e)) for e in ends if e in self.inner],
            [(self.final[e], len(e)) for e in ends if e in self.final],
        )
        return got

    def encode(self, words: Iterable[bytes]) -> dict[bytes, tuple[int, ...]]:
        """Token ids of each distinct word. Sorted words visit the trie depth-first, so a
        node gets its last token when its first word comes by, below finished ancestors."""
        out: dict[bytes, tuple[int, ...]] = {}
        path, before = [self.root], b""
        nodes, steps, fit = self.nodes, self.steps, self.fit
        for word in sorted(set(words)):
            if len(nodes) + len(steps) > TRIE_NODES or len(fit) > TRIE_NODES:
                self.clear()
                path, before = [self.root], b""
                nodes, steps, fit = self.nodes, self.steps, self.fit
            # the path begins where it leaves that of the word before
            same = 0
            for one, other in zip(word[:-1], before[:-1]):
                if one != other:
                    break
                same += 1
            del path[same + 1 :]
            number, _, _, tail = path[same]
            size = len(word)
            for depth, byte in enumerate(word[same:], same + 1):
                key = number * BYTES + byte
                node = nodes.get(key) if depth < size else None
                if node is None:
                    step = steps.get(tail * BYTES + byte) or self._step(tail * BYTES + byte)
                    # the longest token that may follow the node where it starts
                    for token, length in step[1] if depth < size else step[2]:
                        left = path[depth - length][1]
                        if left < 0:
                            break
                        pair = left * self.width + token
                        fits = fit.get(pair)
                        if fits is None:
                            fits = fit[pair] = self._follows(left, token)
                        if fits:
                            break
                    else:
                        raise ValueError(f"no token ends {word[:depth]!r}")
                    if depth == size:
                        break
                    node = nodes[key] = (len(nodes) + 1, token, length, step[0])
                path.append(node)
                number, _, _, tail = node
            before = word
            ids, at = [token], size - length
            while at:
                _, token, length, _ = path[at]
                ids.append(token)
                at -= length
            out[word] = tuple(ids[::-1])
        return out


class TextCoder:
    """Encodes and decodes texts as the tokenizer file says, by remembered chunks.

    Neither normalisation nor the split into words reaches across ASCII white space, and
    no special token contains any, so a text is coded by its chunks between white space.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.trie = TrieEncoder(model["vocab"], pairs, model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        named = {i: s for s, i in (model["vocab"] | self.special).items()}
        self.names = pa.array([named.get(i) for i in range(max(named) + 1)])
        self.numbers = pa.array(map(str, range(len(self.names))), pa.string())
        # the remembered chunks and the ids of each
        self.chunks = pa.array([], pa.string())
        self.ids = pa.array([], pa.list_(pa.int32()))
        self._forget_words()

    def _forget_words(self) -> None:
        self.words: dict[bytes, tuple[int, ...]] = {s.encode(): (t,) for s, t in self.special.items()}
        self.words[b"\n"] = (-1,)  # the end of a chunk

    def _words(self, part: str) -> list[bytes]:
        normal = self.library.normalizer.normalize_str(part)
        return [in_bytes(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _split(self, chunks: list[str]) -> tuple[list[str], list[bytes]]:
        """The chunks in some order, and all their words, with a line feed behind each chunk."""
        latin = [c for c in chunks if "<|" not in c and LATIN.fullmatch(c)]
        words = " ".join(LATIN_WORDS.findall("\n".join([*latin, ""]).lower())).encode()
        words = words.split(b" ") if words else []
        others = list(set(chunks).difference(latin))
        for chunk in others:
            for part in filter(None, self.specials.split(chunk)):
                words += [part.encode()] if part in self.special else self._words(part)
            words.append(b"\n")
        return latin + others, words

    def _learn(self, chunks: list[str]) -> None:
        """Remember new chunks: their words go through the trie together."""
        if len(self.words) > CACHE_CHUNKS:
            self._forget_words()
        chunks, words = self._split(chunks)
        self.words.update(self.trie.encode(set(words).difference(self.words)))
        coded = np.array([*chain.from_iterable([self.words[w] for w in words])], np.int32)
        ends = np.flatnonzero(coded < 0)
        borders = np.r_[0, ends - np.arange(len(ends))].astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(borders), pa.array(coded[coded >= 0]))
        learned = pa.concat_arrays([self.chunks, pa.array(chunks, pa.string())])
        self.chunks, self.ids = learned, pa.concat_arrays([self.ids, ids])

    def _known(self, chunks: pa.Array) -> pa.Array:
        """Numbers of the remembered chunks that equal ``chunks``, which are all different."""
        if len(self.chunks) > CACHE_CHUNKS or self.chunks.nbytes + self.ids.nbytes > CACHE_BYTES:
            # what these texts use stays, so that common chunks are not learned anew
            used = pc.drop_null(pc.index_in(chunks, self.chunks))
            self.chunks, self.ids = self.chunks.take(used), self.ids.take(used)
            self._forget_words()
        found = pc.index_in(chunks, self.chunks)
        if found.null_count:
            self._learn(chunks.filter(pc.is_null(found)).to_pylist())
            found = pc.index_in(chunks, self.chunks)
        return found

    def code(self, values: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Number of tokens, ids and decoded text of each value; both joined by blanks.

        Arrow finds the chunks and which of them are equal; each different one is looked up
        once, and its ids are copied by place.
        """
        rows = pc.ascii_split_whitespace(values)
        coded = rows.flatten().dictionary_encode()
        at = self._known(coded.dictionary)
        ids = self.ids.take(at.take(coded.indices))
        row_ends = rows.offsets.to_numpy()
        borders = ids.offsets.to_numpy()[row_ends - row_ends[0]]
        flat = ids.flatten()

        def joined(tokens: pa.Array) -> pa.Array:
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(borders), tokens.take(flat)), " ")

        return np.diff(borders), joined(self.numbers), joined(self.names)


@cache
def text_coder(path: str) -> TextCoder:
    """One coder for the tasks that a Python worker runs one after the other."""
    return TextCoder(path)


def encode_decode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of each whole text, one row per row.

    ``ids`` are decimal and joined by blanks, without special tokens added; ``decoded`` is
    what decoding them gives, specials kept: the token strings joined by blanks, as the
    file has no decoder. NULL and empty texts have no ids. ``tokenizer`` is a file that
    every executor can open. A narrow step; a Python worker remembers a bounded number of
    chunks, from one task to the next.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_coder(tokenizer)
        for batch in batches:
            for part in _slices(batch):
                counts, ids, decoded = coder.code(pc.fill_null(part.column(1), "").cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts.astype(np.int64)), ids, decoded],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids string, decoded string")
