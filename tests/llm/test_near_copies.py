"""The near-copy join where groups of candidates are large, or chained."""

import random

import numpy as np
import pytest

from ledgerloom.llm import ngram_join


def linked(rows, width, num, den):
    """doc_id to the smallest id that links reach, by all pairs."""
    sets = [set(zip(*(t.split()[i:] for i in range(width)))) for _, t in rows]
    boss = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            if len(sets[x] & sets[y]) * den >= num * len(sets[x] | sets[y]):
                low, high = sorted((boss[x], boss[y]))
                boss = [low if b == high else b for b in boss]
    return {i: min(rows[x][0] for x in range(len(rows)) if boss[x] == boss[k]) for k, (i, _) in enumerate(rows)}


def families(seed=3):
    """Two families of near copies, some of them linked through others only, and documents
    that share most of a passage with them, which is not enough for a link."""
    rng, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(70)]
    for family in range(2):
        base = passage + [f"f{family}_{i}" for i in range(50)]
        for _ in range(30):
            words = list(base)
            for _ in range(rng.randrange(9)):
                words[rng.randrange(len(words))] = f"z{rng.randrange(999)}"
            rows.append(words)
    for i in range(20):
        rows.append(passage + [f"s{i}_{k}" for k in range(30 + i)])
    rng.shuffle(rows)
    return [(i, " ".join(words)) for i, words in enumerate(rows)]


@pytest.mark.parametrize("width, num, most, blocks", [(3, 90, 2, 1024), (3, 90, 2, 4), (5, 80, 2, 4), (5, 80, 64, 4), (2, 60, 4, 8)])
def test_links_by_large_groups(spark, monkeypatch, width, num, most, blocks):
    monkeypatch.setattr(ngram_join, "PAIR_MOST", most)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", blocks)
    rows = families()
    found = ngram_join.join_similar(spark.createDataFrame(rows, "doc_id long, text string"), width, num, 100).collect()
    assert {r.doc_id: r.component_id for r in found} == linked(rows, width, num, 100)


@pytest.mark.parametrize("width, num", [(3, 90), (5, 80)])
def test_chained_candidates_are_not_compared_all_with_all(spark, monkeypatch, width, num):
    """Each document shares enough with the next to be a candidate, and none is linked."""
    rng, n = random.Random(5), 240
    shared = [[f"a{i}_{k}" for k in range(30)] for i in range(n + 1)]
    rows = [(i, " ".join(shared[i] + shared[i + 1] + [f"b{i}_{k}" for k in range(rng.randrange(4))])) for i in range(n)]
    dealt, verify = [], ngram_join.verify

    def counted(docs, met, *more):
        dealt.append(met.count() if "block" in met.columns else n * -(-n // ngram_join.BLOCK_SETS))
        return verify(docs, met, *more)

    monkeypatch.setattr(ngram_join, "verify", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 16)
    found = ngram_join.join_similar(spark.createDataFrame(rows, "doc_id long, text string"), width, num, 100).collect()
    assert all(r.component_id == r.doc_id for r in found) and len(found) == n
    assert sum(dealt) <= 6 * n


@pytest.mark.parametrize("copies", [1, 12])
def test_the_order_of_ngrams_does_not_fill_up(spark, monkeypatch, copies):
    monkeypatch.setattr(ngram_join, "SHARED_BITS", 16)
    rng, passage = random.Random(9), " ".join(f"p{k}" for k in range(20))
    rows = [(passage + " " + " ".join(str(rng.random()) for _ in range(200)),) for _ in range(300 * copies)]
    shared = ngram_join.shared_grams(spark.createDataFrame(rows, "text string"), 5)
    assert len(shared) == 1 << 13 and np.bitwise_count(shared).sum() < 0.1 * (1 << 16)
    (own,) = ngram_join.Shingler(5).sets([passage])
    place = ngram_join.place_of(own, 1 << 16)
    assert all(shared[p >> 3] >> (p & 7) & 1 for p in place.tolist())


def test_linked_prefixes_share_several_keys():
    rng, shared = random.Random(1), np.zeros(1 << 13, np.uint8)
    shared[:4000] = rng.randbytes(1)[0] | 1
    for _ in range(200):
        size = rng.randrange(1, 60)
        base = [rng.getrandbits(64) for _ in range(size)]
        other = base[: size - rng.randrange(1 + size // 6)] + [rng.getrandbits(64) for _ in range(rng.randrange(1 + size // 6))]
        x, y = (np.unique(np.array(s, np.uint64)) for s in (base, other))
        both = len(np.intersect1d(x, y))
        if both * 100 < 80 * (len(x) + len(y) - both):
            continue
        keys, owner = ngram_join.prefix_keys([x, y], 80, 100, shared)
        common = np.intersect1d(keys[owner == 0], keys[owner == 1])
        assert len(common) >= min(ngram_join.PREFIX_KEYS, -(-80 * min(len(x), len(y)) // 100))


def test_linked_parts_share_a_key_and_small_parts_are_left_out():
    rng = random.Random(2)
    for num in (90, 80, 50):
        for _ in range(150):
            size = rng.randrange(1, 150)
            base = [rng.getrandbits(64) for _ in range(size)]
            other = base[: size - rng.randrange(1 + size // 8)] + [rng.getrandbits(64) for _ in range(rng.randrange(1 + size // 8))]
            x, y = (np.unique(np.array(s, np.uint64)) for s in (base, other))
            both = len(np.intersect1d(x, y))
            keys, owner = ngram_join.part_keys([x, y], num, 100)
            if both * 100 >= num * (len(x) + len(y) - both):
                assert len(np.intersect1d(keys[owner == 0], keys[owner == 1]))
    grams = np.unique(np.array([rng.getrandbits(64) for _ in range(400)], np.uint64))
    keys, _ = ngram_join.part_keys([grams], 90, 100)
    differ = [(int(s) - 1) * 10 // 90 for s in ngram_join._STARTS if s > 400][:2]
    assert len(keys) == sum(d + 1 for d in differ[: 1 + (400 * 100 >= 90 * int(ngram_join._STARTS[ngram_join._STARTS > 400][0]))])
