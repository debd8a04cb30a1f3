"""Byte-level BPE: vectorised pre-tokenisation, cached merging, exact decoding.

Boundaries of the words to merge are found with no regular expression. Every code point
gets a class from an array; with a look at its neighbours the class becomes one of nine
symbols, and a symbol is a function from scanner state to scanner state. Functions
compose associatively, so the text is cut into equal rows, the functions of all rows are
composed side by side, one short pass over the rows gives the state each row begins in,
and a last pass side by side gives the state, and so the boundary, at every position.

The pattern this equals: ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

The slices between boundaries go through caches of merged words: short ones, as two numbers
of eight bytes, through a table of fixed size that is looked up side by side, longer ones
through a bounded dictionary. Every token keeps the byte offset it ends at.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import with_columns

# Classes of code points. SPACE is U+0020 alone; END stands between documents.
OTHER, LETTER, NUMBER, SPACE, WHITE, QUOTE, END = range(7)
# The code points of \s besides U+0020.
WHITE_POINTS = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What may follow an apostrophe that begins a word.
SHORT_ENDS, LONG_ENDS = "stmd", ("re", "ve", "ll")
_END_POINT = 0x110000

# Scanner states: what the open word is made of.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, ONE_MORE, TWO_MORE, IN_BLANKS = range(8)
# Symbols: a class with what its neighbours make of it.
S_OTHER, S_LETTER, S_NUMBER, S_BLANK, S_LAST_BLANK, S_JOINING, S_SHORT, S_LONG, S_END = range(9)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    """next[symbol, state] and begins[symbol, state]: does a word begin here?"""
    after = np.zeros((9, 8), np.uint8)
    begins = np.ones((9, 8), bool)
    for symbol, state, runs in (
        (S_LETTER, IN_LETTERS, (IN_LETTERS, AFTER_SPACE)),
        (S_NUMBER, IN_NUMBERS, (IN_NUMBERS, AFTER_SPACE)),
        (S_OTHER, IN_OTHER, (IN_OTHER, AFTER_SPACE)),
        (S_BLANK, IN_BLANKS, (IN_BLANKS,)),
    ):
        after[symbol] = state
        begins[symbol, list(runs)] = False
    for symbol, state in ((S_SHORT, ONE_MORE), (S_LONG, TWO_MORE)):
        after[symbol] = state  # begins a contraction, unless a run of others is open
        after[symbol, [IN_OTHER, AFTER_SPACE]] = IN_OTHER
        begins[symbol, [IN_OTHER, AFTER_SPACE]] = False
    after[S_LETTER, TWO_MORE], after[S_LETTER, ONE_MORE] = ONE_MORE, FRESH
    begins[S_LETTER, [ONE_MORE, TWO_MORE]] = False
    after[S_LAST_BLANK], after[S_JOINING], after[S_END] = FRESH, AFTER_SPACE, FRESH
    return after, begins


_AFTER, _BEGINS = _functions()
_FLAT = _AFTER.ravel().copy()
_STARTS = _BEGINS.ravel().copy()
_CONSTANT = (_AFTER == _AFTER[:, :1]).all(axis=1)  # symbols that lead to one state from any


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point, by general category."""
    kinds = {"L": LETTER, "N": NUMBER}
    found = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    found[WHITE_POINTS] = WHITE
    found[ord(" ")], found[ord("'")] = SPACE, QUOTE
    return np.append(found, np.uint8(END))


def symbols(points: np.ndarray) -> np.ndarray:
    kind = classes()[points]
    blank = (kind == SPACE) | (kind == WHITE)
    before_word = np.zeros(len(kind), bool)  # the next code point is neither blank nor END
    before_word[:-1] = ~blank[1:] & (kind[1:] != END)
    made = np.array([S_OTHER, S_LETTER, S_NUMBER, S_BLANK, S_BLANK, S_OTHER, S_END], np.uint8)[kind]
    made[(kind == SPACE) & before_word] = S_JOINING
    made[(kind == WHITE) & before_word] = S_LAST_BLANK
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        padded = np.append(points, np.array([_END_POINT] * 2, points.dtype))
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in SHORT_ENDS])
        made[quotes[short]] = S_SHORT
        for a, b in LONG_ENDS:
            made[quotes[(one == ord(a)) & (two == ord(b))]] = S_LONG
    return made


def boundaries(points: np.ndarray) -> np.ndarray:
    """Positions where a word begins, END positions among them."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    length = max(64, int(np.sqrt(n / 16)))
    rows = -(-n // length)
    grid = np.full(rows * length, S_END, np.uint8)
    grid[:n] = symbols(points)
    grid = np.ascontiguousarray(grid.reshape(rows, length).T)  # one row a step

    def steps() -> Iterator[np.ndarray]:
        """Where the functions of a row's symbols begin in the table; a row at a time, as
        these numbers take eight times the room of the symbols."""
        return (row.astype(np.intp) * 8 for row in grid)

    # The function of each row. A product with a constant function in it is constant, so one
    # state tells it; all eight are composed in rows that have no such symbol.
    last = np.full(rows, FRESH, np.uint8)
    for at in steps():
        last = _FLAT[at + last]
    reached = np.repeat(last[:, None], 8, axis=1)
    free = np.flatnonzero(~_CONSTANT[grid].any(axis=0))
    if len(free):
        whole = np.tile(np.arange(8, dtype=np.uint8), (len(free), 1))
        for at in steps():
            whole = _FLAT[at[free, None] + whole]
        reached[free] = whole
    starts = np.zeros(rows, np.uint8)
    state = FRESH
    for i, function in enumerate(reached.tolist()):
        starts[i] = state
        state = function[state]
    states, now = np.empty((length, rows), np.uint8), starts
    for j, at in enumerate(steps()):
        states[j] = now
        now = _FLAT[at + now]
    states += grid * np.uint8(8)
    return np.flatnonzero(_STARTS[states].T.ravel()[:n])


_PLACES = 19  # bits of the pair table


def _place(keys: np.ndarray) -> np.ndarray:
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _PLACES)).view(np.int64)


class _Pieces(dict):
    """Numbers words as they are first met, and lists the ones not merged yet."""

    def __init__(self):
        super().__init__()
        self.waiting: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.waiting.append(word)
        return at


def _inside(counts: np.ndarray) -> np.ndarray:
    """0 … c - 1 for every count c, in a row."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


class ShortWords:
    """Ids of merged words of at most SHORT bytes, in a table with one place per hash; a
    word takes the place of another one, which is merged again when it is met again."""

    SHORT, PLACES = 16, 19  # bytes; bits of the table
    # By length: the bytes past a word's end are 0xFF, which UTF-8 never holds.
    PAST = np.where(np.arange(SHORT) < np.arange(SHORT + 1)[:, None], 0, 0xFF).astype(np.uint8).view(np.uint64)

    def __init__(self, kind: type):
        size = 1 << self.PLACES
        self.held = np.full((size, 2), np.uint64(0xFFFFFFFFFFFFFFFF))
        self.counts = np.zeros(size, np.uint8)
        self.ids = np.zeros(size * self.SHORT, kind)

    def keys(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words as two numbers each, and their places. ``data`` has SHORT bytes past its end."""
        keys = np.lib.stride_tricks.sliding_window_view(data, self.SHORT)[begins].view(np.uint64) | self.PAST[sizes]
        mixed = (keys[:, 0] ^ (keys[:, 0] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + keys[:, 1] * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return keys, (mixed >> np.uint64(64 - self.PLACES)).view(np.int64)

    def find(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        held = self.held[places]
        return (held[:, 0] == keys[:, 0]) & (held[:, 1] == keys[:, 1])

    def put(self, keys: np.ndarray, places: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Hold words and their ids (in a row). Of words with one place the first is held."""
        firsts = np.unique(places, return_index=True)[1]
        own = counts[firsts]
        self.held[places[firsts]], self.counts[places[firsts]] = keys[firsts], own
        into = np.repeat(places[firsts] * self.SHORT, own) + _inside(own)
        self.ids[into] = ids[np.repeat((np.cumsum(counts) - counts)[firsts], own) + _inside(own)]


class Vocabulary:
    """Ranks of byte strings, and a bounded cache of merged words."""

    most_cached = 100_000  # words longer than ShortWords.SHORT
    long_word = 64  # bytes; longer words are merged one by one with a heap

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._reset()

    def _reset(self) -> None:
        self.cache = _Pieces()
        self.cached_ids = np.zeros(0, np.int32)
        self.cached_begins = np.zeros(0, np.int64)
        self.cached_counts = np.zeros(0, np.int64)

    @staticmethod
    @lru_cache(4)
    def read(text: str) -> Vocabulary:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in (line.split() for line in text.splitlines() if line)})

    @cached_property
    def width(self) -> int:
        return max(self.ranks.values(), default=0) + 1

    @cached_property
    def short(self) -> ShortWords:
        return ShortWords(np.uint16 if self.width <= 1 << 16 else np.int32)

    @cached_property
    def byte_ids(self) -> np.ndarray:
        return np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int32)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, ...]:
        """Every two tokens that join to a third: a hash table of keys and ranks, and the
        few pairs whose place another one holds, sorted."""
        keys, joined = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    joined.append(rank)
        keys, joined = np.array(keys, np.int64), np.array(joined, np.int32)
        held, ranks = np.full(1 << _PLACES, -1, np.int64), np.full(1 << _PLACES, self.width, np.int32)
        at = _place(keys)
        held[at], ranks[at] = keys, joined  # of pairs with one place the last stays
        rest = np.flatnonzero(held[at] != keys)
        rest = rest[np.argsort(keys[rest])]
        crowded = np.zeros(1 << _PLACES, bool)
        crowded[at[rest]] = True
        return held, ranks, crowded, np.append(keys[rest], np.iinfo(np.int64).max), np.append(joined[rest], np.int32(self.width))

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank two neighbours join to; ``width`` if none."""
        held, ranks, crowded, rest_keys, rest_ranks = self.pairs
        key = left.astype(np.int64) * self.width + right
        at = _place(key)
        found = np.where(held[at] == key, ranks[at], np.int32(self.width))
        again = np.flatnonzero(crowded[at] & (found == self.width))
        if len(again):
            place = np.searchsorted(rest_keys, key[again])
            found[again] = np.where(rest_keys[place] == key[again], rest_ranks[place], self.width)
        return found

    def merge(self, word: bytes) -> list[int]:
        """Join the pair of lowest rank, the leftmost first, until no pair has a rank. A
        heap holds the pairs, so a very long word takes n log n steps."""
        n = len(word)
        parts = [word[i : i + 1] for i in range(n)]
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := self.ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i] if parts[i] else n
            if j >= n or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two has been joined since
            parts[i] += parts[j]
            parts[j] = b""
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := self.ranks.get(parts[i] + parts[k])) is not None:
                    heapq.heappush(heap, (r, i, len(parts[i]) + len(parts[k])))
            if (h := left[i]) >= 0 and (r := self.ranks.get(parts[h] + parts[i])) is not None:
                heapq.heappush(heap, (r, h, len(parts[h]) + len(parts[i])))
        return [self.ranks[p] for p in parts if p]

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many short words in a row, and the count of each, side by side: each round joins, in every word that
        still has a pair with a rank, the leftmost pair of its lowest rank."""
        done_ids, done_words = [], []
        token = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), np.fromiter(map(len, words), np.int64, len(words)))
        rank = np.full(len(token), self.width, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.pair_rank(token[inner], token[inner + 1])
        while len(token):
            firsts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, firsts)
            sizes = np.diff(np.append(firsts, len(token)))
            going = lowest < self.width
            if not going.all():
                stays = np.repeat(going, sizes)
                done_ids.append(token[~stays])
                done_words.append(word[~stays])
                token, word, rank = token[stays], word[stays], rank[stays]
                lowest, sizes = lowest[going], sizes[going]
                if not len(token):
                    break
                firsts = np.cumsum(sizes) - sizes
            hits = np.flatnonzero(rank == np.repeat(lowest, sizes))
            owner = word[hits]
            at = hits[np.append(True, owner[1:] != owner[:-1])]
            token[at] = rank[at]
            keep = np.ones(len(token), bool)
            keep[at + 1] = False
            token, word, rank = token[keep], word[keep], rank[keep]
            at = at - np.arange(len(at))
            for place in (at, at[at > 0] - 1):  # the pairs the new token is part of
                rank[place] = self.width
                paired = place[place + 1 < len(token)]
                paired = paired[word[paired] == word[paired + 1]]
                rank[paired] = self.pair_rank(token[paired], token[paired + 1])
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(words))

    def lookup(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and the number of ids of each."""
        if len(self.cache) > self.most_cached:
            self._reset()
        at = np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))
        waiting, self.cache.waiting = self.cache.waiting, []
        if waiting:
            is_long = np.fromiter((len(w) > self.long_word for w in waiting), bool, len(waiting))
            counts = np.zeros(len(waiting), np.int64)
            ids, counts[~is_long] = self.merge_all([w for w, long in zip(waiting, is_long) if not long])
            begins = np.zeros(len(waiting), np.int64)
            begins[~is_long] = np.cumsum(counts[~is_long]) - counts[~is_long]
            added = [self.cached_ids, ids.astype(np.int32)]
            size = len(ids)
            for i in np.flatnonzero(is_long).tolist():
                added.append(np.array(self.merge(waiting[i]), np.int32))
                begins[i], counts[i] = size, len(added[-1])
                size += len(added[-1])
            self.cached_begins = np.append(self.cached_begins, begins + len(self.cached_ids))
            self.cached_counts = np.append(self.cached_counts, counts)
            self.cached_ids = np.concatenate(added)
        counts = self.cached_counts[at]
        return self.cached_ids[np.repeat(self.cached_begins[at], counts) + _inside(counts)], counts

    def ids_of(self, data: bytes, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words (places in ``data``) in a row, and the number of each word's."""
        short = self.short
        is_short = sizes <= short.SHORT
        brief, long = np.flatnonzero(is_short), np.flatnonzero(~is_short)
        keys, places = short.keys(np.frombuffer(data + bytes(short.SHORT), np.uint8), begins[brief], sizes[brief])
        found = short.find(keys, places)
        missed = np.flatnonzero(~found)

        def cut(which: np.ndarray) -> list[bytes]:
            return [data[a : a + n] for a, n in zip(begins[which].tolist(), sizes[which].tolist())]

        numbers: dict[bytes, int] = {}
        number = np.array([numbers.setdefault(w, len(numbers)) for w in cut(brief[missed])], np.int64)
        new_ids, new_counts = self.merge_all(list(numbers))
        long_ids, long_counts = self.lookup(cut(long))

        counts = np.zeros(len(sizes), np.int64)
        hits, hit_places = brief[found], places[found]
        counts[hits], counts[brief[missed]], counts[long] = short.counts[hit_places], new_counts[number], long_counts
        firsts = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), np.int32)

        def fill(which: np.ndarray, held: np.ndarray, at: np.ndarray) -> None:
            own = counts[which]
            inside = _inside(own)
            ids[np.repeat(firsts[which], own) + inside] = held[np.repeat(at, own) + inside]

        fill(hits, short.ids, hit_places * short.SHORT)
        fill(brief[missed], new_ids, (np.cumsum(new_counts) - new_counts)[number])
        ids[np.repeat(firsts[long], long_counts) + _inside(long_counts)] = long_ids
        if len(numbers):
            once = missed[np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))]
            short.put(keys[once], places[once], new_ids, new_counts)
        return ids, counts

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' bytes in a row, and where each id begins."""
        by_id = [b""] * self.width
        for token, rank in self.ranks.items():
            by_id[rank] = token
        begins = np.concatenate([[0], np.cumsum([len(t) for t in by_id])]).astype(np.int64)
        return np.frombuffer(b"".join(by_id), np.uint8), begins

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the number of ids of each."""
        joined = "\0".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        seams = (np.cumsum(lengths) + np.arange(len(texts)))[:-1]
        points[seams] = _END_POINT
        starts = boundaries(points)
        inner = points[starts] != _END_POINT
        data = joined.encode()
        if len(data) > len(points):  # places of code points become places of bytes
            starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)[starts]
        sizes = np.diff(np.append(starts, len(data)))
        text_of = np.cumsum(~inner)[inner]
        ids, counts = self.ids_of(data, starts[inner], sizes[inner])
        return ids, np.bincount(text_of, counts, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids in a row."""
        data, begins = self.table
        sizes = begins[ids + 1] - begins[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return data[np.arange(total) + np.repeat(begins[ids] - (ends - sizes), sizes)]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts * values.itemsize)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def encoder(ranks: str) -> Callable[[], Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]]:
    """What a task makes once, to encode arrays of texts: all ids in a row and the number of
    each text's; null texts count as empty."""

    def make():
        vocabulary = Vocabulary.read(ranks)
        return lambda texts: vocabulary.encode([t or "" for t in texts.to_pylist()])

    return make


def encode(
    df: DataFrame, ranks: str, text: str = "text", ids: str = "ids", ends: str | None = "token_ends", packed: str | None = None
) -> DataFrame:
    """Append the token ids of a text column, and the byte offset each token ends at.
    ``packed`` gives the ids as the bytes of a number type instead of an array.

    ``ranks`` is the content of a rank file (about a megabyte, shipped with the task).
    A null text counts as empty; an empty one has no tokens. Texts are whole: a very
    long one is a step of its own. Existing columns of these names are replaced.
    """

    def make():
        vocabulary = Vocabulary.read(ranks)

        def run(texts: pa.Array) -> list[pa.Array]:
            found, counts = vocabulary.encode([t or "" for t in texts.to_pylist()])
            made = [_lists(found, counts) if packed is None else _packed(found.astype(packed), counts)]
            if ends:
                begins = vocabulary.table[1]
                last = np.cumsum(begins[found + 1] - begins[found])
                first = np.concatenate([[0], np.cumsum(counts)])[:-1]
                base = np.where(first > 0, np.append(last, 0)[first - 1], 0)
                made.append(_lists((last - np.repeat(base, counts)).astype(np.int32), counts))
            return made

        return run

    adds = [(ids, T.ArrayType(T.IntegerType()) if packed is None else T.BinaryType())] + ([(ends, T.ArrayType(T.IntegerType()))] if ends else [])
    return with_columns(df.drop(*[n for n, _ in adds]), [text], adds, make)


def decode(df: DataFrame, ranks: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Append the bytes that a column of token ids stands for; null for null ids."""

    def make():
        vocabulary = Vocabulary.read(ranks)

        def run(lists: pa.Array) -> list[pa.Array]:
            counts = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
            flat = lists.values.slice(lists.offsets[0].as_py(), int(counts.sum())).to_numpy(zero_copy_only=False)
            begins = vocabulary.table[1]
            sizes = np.concatenate([[0], np.cumsum(begins[flat + 1] - begins[flat])])
            at = sizes[np.concatenate([[0], np.cumsum(counts)])]
            data = vocabulary.decode(flat)
            mask = pa.array(np.asarray(lists.is_null()))
            made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data.tobytes())])
            return [pa.compute.if_else(mask, pa.scalar(None, pa.binary()), made.cast(pa.binary()))]

        return run

    return with_columns(df.drop(into), [ids], [(into, T.BinaryType())], make)
