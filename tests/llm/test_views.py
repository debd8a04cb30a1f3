"""Features that don't depend on size, samples bounded by rows, an index without a switch."""

import numpy as np

from ledgerloom.llm import cotraining, multi_index


def test_letter_share_is_the_same_at_every_length():
    short, long = (cotraining.text_features("½²Ⅷ a " * n) for n in (300, 400))
    assert len("½²Ⅷ a " * 300) < 2000 < len("½²Ⅷ a " * 400)
    assert short[4] == long[4] == np.float32(1 / 6)


def test_sample_holds_a_row_of_each_id(spark):
    rows = [(1 if i < 400 else i, f"text number {i} " * 3, "s", "en", 10) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2 if i < 500 else None) for i in [1, *range(400, 550)]], "doc_id long, quality int")
    seen = []
    original = cotraining.co_train
    cotraining.co_train = lambda a, b, y, c, d: seen.append((len(y), len(c))) or original(a, b, y, c, d)
    try:
        cotraining.train(docs, labels)
    finally:
        cotraining.co_train = original
    held = [i for i in [1, *range(400, 600)] if cotraining_held(i)]
    labelled = [i for i in [1, *range(400, 500)] if i not in held]
    others = [i for i in range(500, 600) if i not in held]  # without a label, or with one that names no quality
    assert seen == [(len(labelled), len(others))]


def cotraining_held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 5 == 0


def test_walk_goes_on_until_enough_entries_at_every_size(spark):
    rng = np.random.default_rng(3)
    for n in (4, 90, 130, 400):
        points = rng.normal(size=(n, 8))
        df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
        found = multi_index.neighbours(df, every=10, k=5, visit=0.0).collect()
        unit = points / np.linalg.norm(points, axis=1)[:, None]
        hit = total = 0
        for q in range(0, n, 10):
            near = unit @ unit[q]
            near[q] = -np.inf
            own = [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q]
            assert len(own) == min(5, n - 1)
            best = np.argsort(-near)[: min(5, n - 1)].tolist()
            hit, total = hit + len(set(own) & set(best)), total + len(best)
        assert hit == total if n <= 100 else hit >= 0.6 * total
