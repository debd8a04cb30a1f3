"""Ranked lexical search, term-at-a-time and document-at-a-time.

Every task keeps its documents as shards of inverted lists over the terms of a block of
items. Within a shard an item is answered in two steps:

* its short lists are summed, term at a time, into accumulators;
* the accumulators are one more iterator, its bound the largest sum, beside the long lists,
  and all are gone through document at a time, window by window. A window is skipped when
  its largest entries cannot reach the worst of the best documents so far. Of the others
  only lists that can make a difference name candidates; the rest are looked up for
  candidates that can still get there, the list with the largest bound first.

The bounds are exact and a document is left out only when it lies strictly below, so ties
are all seen. A task keeps the best documents per item over all its shards; the tasks' best
are merged by a top-k. Items come in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import discard, pick, slices, staged

BLOCK_TERMS = 50_000  # distinct terms a block of items has at most (or one item)
SHARD_DOCS, SHARD_POSTINGS = 16_384, 2_000_000
WINDOW = 1_024
SHORT = 16  # a list is short when it names at most one document in SHORT
STATS = -1  # marks the rows with a task's counts

# ASCII letters are lower-cased and kept, digits and all bytes beyond ASCII are kept.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The maximal runs of letters and digits (all characters beyond ASCII count as such),
    A-Z lower-cased, as UTF-8. Null has none."""
    return text.encode().translate(_FOLD).split() if text else []


def blocks(items: DataFrame) -> Iterator[list[tuple[Row, list[bytes]]]]:
    """Items with their distinct terms, in blocks of bounded vocabulary; the driver holds one."""
    block, known = [], set()
    for row in items.toLocalIterator():
        own = sorted(set(terms(row["text"])))
        if block and len(known) + len(own) > BLOCK_TERMS:
            yield block
            block, known = [], set()
        block.append((row, own))
        known.update(own)
    if block:
        yield block


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(kind, doc_id, n, ids, counts): a row per document with a term of the vocabulary, and a
    row per task (kind ``STATS``) that holds the number of documents with terms as doc_id,
    the number of their terms as n, and the number of documents by term."""
    names = ["kind", "doc_id", "n", "ids", "counts"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, count, total = np.zeros(len(vocabulary), np.int64), 0, 0
        known = vocabulary.keys()
        for batch in batches:
            for part in slices(batch):
                out: list = [[], [], [], []]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = Counter(terms(text))
                    n = found.total()
                    if not n:
                        continue
                    count, total = count + 1, total + n
                    mine = sorted((vocabulary[t], found[t]) for t in known & found.keys())
                    if mine:
                        pairs = np.array(mine, np.int64)
                        df[pairs[:, 0]] += 1
                        for column, value in zip(out, (doc, n, pairs[:, 0].astype("<u4").tobytes(), pairs[:, 1].astype("<u4").tobytes())):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                arrays = [pa.array(np.zeros(len(out[0]), np.int32))] + [pa.array(c, k) for c, k in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names)
        has = np.flatnonzero(df)
        row = [[STATS], [count], [total], [has.astype("<u4").tobytes()], [df[has].astype("<i8").tobytes()]]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names)

    made = docs.select("doc_id", "text").mapInArrow(step, "kind int, doc_id long, n long, ids binary, counts binary")
    return staged(made, "postings", compression="zstd")


def counted(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the documents by term: the tasks' counts summed by range of tasks, so that
    what comes to the driver is bounded by the vocabulary."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, count, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for docs, n, ids, counts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                count, total = count + docs, total + n
                df[np.frombuffer(ids, "<u4")] += np.frombuffer(counts, "<i8")
        rows = np.append(np.flatnonzero(df), [size, size + 1])
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.append(df[rows[:-2]], [count, total]))], ["term", "n"])

    stats = found.filter(F.col("kind") == STATS).select("doc_id", "n", "ids", "counts")
    sums = stats.mapInArrow(add, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(size + 2, np.int64)
    for row in sums.toLocalIterator():
        df[row["term"]] = row["n"]
    return int(df[size]), int(df[size + 1]), df[:size]


class Shard:
    """Inverted lists of some documents: per term the places of its documents, ascending,
    and what the term adds to each one's score."""

    def __init__(self, doc_ids: list, sizes: list[int], ids: list[bytes], counts: list[bytes], weights: np.ndarray, n_docs: int, n_terms: int):
        self.doc_ids = doc_ids
        length = np.array([100 - 90 + (90 * n * n_docs) // n_terms for n in sizes], np.int64)
        term = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        tf = np.frombuffer(b"".join(counts), "<u4").astype(np.int64)
        doc = np.repeat(np.arange(len(doc_ids)), [len(b) // 4 for b in ids])
        order = np.argsort(term, kind="stable")
        term, tf, self.doc = term[order], tf[order], doc[order]
        self.adds = weights[term] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * length[self.doc]))
        self.starts = np.searchsorted(term, np.arange(len(weights) + 1))
        self.edges = np.arange(-(-len(doc_ids) // WINDOW) + 1) * WINDOW
        self.most = max(1, len(doc_ids) // SHORT)
        self.long: dict[int, Entries] = {}

    def lists(self, item: list[int]) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[Entries]]:
        """The short lists of some terms, and the long ones as iterators."""
        short, long = [], []
        for term in item:
            low, high = self.starts[term], self.starts[term + 1]
            if high - low > self.most:
                if term not in self.long:
                    self.long[term] = Entries(self.doc[low:high], self.adds[low:high], self.edges)
                long.append(self.long[term])
            elif high > low:
                short.append((self.doc[low:high], self.adds[low:high]))
        return short, long


class Entries:
    """An iterator over documents in ascending order that can skip by window: where each
    window begins, and the largest entry of each."""

    def __init__(self, docs: np.ndarray, adds: np.ndarray, edges: np.ndarray):
        self.docs, self.adds, self.cuts = docs, adds, np.searchsorted(docs, edges)
        self.tops = np.zeros(len(edges) - 1, np.int64)
        filled = np.flatnonzero(np.diff(self.cuts))
        if len(filled):
            self.tops[filled] = np.maximum.reduceat(adds, self.cuts[filled])

    def window(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.cuts[number], self.cuts[number + 1]
        return self.docs[low:high] - number * WINDOW, self.adds[low:high]


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the sums over some lists, as one list."""
    docs, place = np.unique(np.concatenate([d for d, _ in lists]), return_inverse=True)
    sums = np.zeros(len(docs), np.int64)
    np.add.at(sums, place, np.concatenate([a for _, a in lists]))
    return docs, sums


class Best:
    """The k best (score, doc_id) of an item; equal scores go by doc_id, null last."""

    def __init__(self, k: int):
        self.k, self.rows, self.floor = k, [], 1

    def offer(self, scores: np.ndarray, doc_ids: list) -> None:
        self.rows += [(-s, d is None, d) for s, d in zip(scores.tolist(), doc_ids)]
        self.rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.floor = -self.rows[-1][0]


def search(shard: Shard, item: list[int], best: Best) -> None:
    """Offer every document of the shard that can be among the best."""
    short, iterators = shard.lists(item)
    if short:
        iterators.append(Entries(*accumulate(short), shard.edges))
    if not iterators:
        return
    tops = np.array([x.tops for x in iterators])
    reach = tops.sum(0)
    for window in np.argsort(-reach, kind="stable").tolist():
        if reach[window] < best.floor:
            break  # windows come by falling bound, and the floor only rises
        order = np.argsort(tops[:, window], kind="stable").tolist()
        below = np.cumsum(tops[order, window])
        passive = int(np.searchsorted(below, best.floor))  # these lists together stay below the floor
        sums, seen = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, bool)
        for i in order[passive:]:
            docs, adds = iterators[i].window(window)
            sums[docs] += adds
            seen[docs] = True
        found = np.flatnonzero(seen)
        scores = sums[found]
        for place in range(passive - 1, -1, -1):
            keep = scores + below[place] >= best.floor
            found, scores = found[keep], scores[keep]
            docs, adds = iterators[order[place]].window(window)
            if len(found) and len(docs):
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                scores = scores + np.where(docs[at] == found, adds[at], 0)
        keep = np.flatnonzero(scores >= best.floor)
        if len(keep) > best.k:  # those equal to the k-th stay in
            least = np.partition(scores[keep], len(keep) - best.k)[len(keep) - best.k]
            keep = keep[scores[keep] >= least]
        best.offer(scores[keep], [shard.doc_ids[d + window * WINDOW] for d in found[keep].tolist()])


def best_by_task(found: DataFrame, items: list[tuple[int | None, list[int]]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(place of the item, item_id, doc_id, score): the k best of every task. ``items`` are
    their ids and terms."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        held: list = [[], [], [], []]
        size = 0

        def done() -> None:
            shard = Shard(*held, weights, n_docs, n_terms)
            for (_, item), own in zip(items, best):
                search(shard, item, own)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for column, value in zip(held, row):
                    column.append(value)
                size += len(row[2]) // 4
                if len(held[0]) >= SHARD_DOCS or size >= SHARD_POSTINGS:
                    done()
                    held, size = [[], [], [], []], 0
        if held[0]:
            done()
        rows = [(i, items[i][0], d, -s) for i, own in enumerate(best) for s, _, d in own.rows]
        columns = [pa.array([r[c] for r in rows], pa.int64()) for c in range(4)]
        yield pa.RecordBatch.from_arrays(columns, ["place", "item_id", "doc_id", "score"])

    docs = found.filter(F.col("kind") != STATS).select("doc_id", "n", "ids", "counts")
    return docs.mapInArrow(step, "place long, item_id long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k highest-scoring documents of each item: item_id, rank (from 1), doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text. Every row is a document, or an
    item, of its own, also repeated ones and those with a null id. Equal scores go by doc_id,
    null last. Items without terms, or whose terms no document holds, have no rows; nor has an
    empty table. Other columns don't matter, whatever their names.
    """
    docs = pick(docs, ("doc_id", "long"), ("text", "string"))
    items = pick(items, ("item_id", "long"), ("text", "string"))
    spark, results = docs.sparkSession, []
    for block in blocks(items):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in block for t in own}))}
        found = postings(docs, vocabulary)
        n_docs, n_terms, df = counted(found, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        asked = [(row["item_id"], [vocabulary[t] for t in own if df[vocabulary[t]]]) for row, own in block]
        best = best_by_task(found, asked, weights, n_docs, max(1, n_terms), k)
        order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        results.append(staged(top.select("item_id", "rank", "doc_id", "score"), "ranked"))
        discard(found)
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    while len(results) > 1:  # a balanced tree of unions
        results = [a if b is None else a.unionByName(b) for a, b in zip(results[::2], results[1::2] + [None])]
    return results[0]
