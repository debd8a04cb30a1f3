"""Ranked search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    held = [(doc, Counter(own)) for doc, own in ((d, terms(t)) for d, t in docs) if own]
    count, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for item, text in items:
        rows = []
        for doc, own in held:
            m = 100 - 90 + 90 * own.total() * count // total
            score = 0
            for t in set(terms(text)) & own.keys():
                w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * own[t] // (1000 * own[t] + 8 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        found += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(rows)[:k], 1)]
    return sorted(found, key=repr)


def test_terms_are_the_runs_of_the_contract():
    text = "It's ÀB-c\x00d_e \x7fÉé 12x　y\n" + "".join(map(chr, range(300)))
    assert [t.decode() for t in lexical.terms(text)] == terms(text) and lexical.terms(None) == []


def test_rank_of_edge_rows(spark):
    docs = [(1, "a b c"), (2, "a b c"), (2, "a b c"), (3, None), (4, ""), (None, "a rare"), (5, "--- !!"), (6, "a " * 50_000 + "rare"), (7, "É é ß")]
    docs += [(100 + i, "a b common") for i in range(40)]
    items = [(1, "A b? c!"), (1, "rare rare"), (2, None), (3, "..."), (None, "é ß"), (4, "absent"), (5, "common b")]
    extra = [(F.lit(1), n) for n in ("rank", "score", "n", "ids", "counts", "kind", "place")]
    d = spark.createDataFrame(docs, "doc_id long, text string").select("*", *[c.alias(n) for c, n in extra]).repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").select("*", *[c.alias(n) for c, n in extra])
    for k in (1, 10):
        assert sorted(map(tuple, lexical.rank(d, i, k).collect()), key=repr) == brute(docs, items, k)
    assert lexical.rank(d.filter("1 = 0"), i).count() == 0
    assert lexical.rank(d, i.filter("1 = 0")).count() == 0


def test_rank_over_blocks_of_items_is_the_same(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{min(int(rng.expovariate(0.03)), 400)}" for _ in range(40_000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(30)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 10)
    assert sorted(map(tuple, lexical.rank(d, i).collect()), key=repr) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 100)  # read on the driver
    assert sorted(map(tuple, lexical.rank(d, i).collect()), key=repr) == want


def test_search_skips_and_loses_nothing():
    """Large shards: many windows, short and long lists, equal scores."""
    rng = np.random.default_rng(5)
    size, vocabulary = 6000, 60
    weights = rng.integers(0, 6000, vocabulary)
    share = rng.random(vocabulary) ** 4
    ids, counts, own = [], [], []
    for _ in range(size):
        t = np.flatnonzero(rng.random(vocabulary) < share)
        c = rng.integers(1, 4, len(t))
        ids.append(t.astype("<u4").tobytes()), counts.append(c.astype("<u4").tobytes()), own.append(dict(zip(t.tolist(), c.tolist())))
    names = rng.permutation(size).tolist()
    shard = lexical.Shard(names, [20] * size, ids, counts, weights, size, size * 20)
    opened = []
    window = lexical.Entries.window
    lexical.Entries.window = lambda self, n: opened.append(1) or window(self, n)
    try:
        for _ in range(20):
            item = rng.choice(vocabulary, 15, replace=False).tolist()
            best = lexical.Best(10)
            lexical.search(shard, item, best)
            score = lambda o: sum(int(weights[t]) * (1_000_000_000 * o[t] // (1000 * o[t] + 800)) for t in item if t in o)
            want = sorted((-score(o), False, n) for o, n in zip(own, names) if score(o) > 0)[:10]
            assert best.rows == want
    finally:
        lexical.Entries.window = window
    assert len(opened) < 0.7 * 20 * 6 * 15  # lists and windows were skipped
