"""Document quality by co-training of a text classifier and a metadata classifier.

The two views of a document are its text (shape statistics and hashed words) and its
metadata (source, language, stated length). Each view has a logistic classifier. In every
round each classifier labels the documents of an unlabelled pool that it is surest of, in
the class ratio of the labels, and hands them to the other one. At last both are
calibrated on labelled documents that neither was fitted to, and a logistic curve over
the two calibrated log-odds gives the score of every document.

Fitting uses a bounded sample (LABELLED and POOL documents, by a hash of the id): only
their features reach the driver. Scoring is one pass over all documents, whole texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import is_held_out, pick, staged, with_columns

LABELLED, POOL = 12_000, 12_000
WORD_BUCKETS, META_BUCKETS = 480, 128
ROUNDS, SHARE_A_ROUND, SURE = 4, 0.05, 0.9


def text_features(text: str | None) -> np.ndarray:
    """Statistics that do not depend on the language, and hashed word shares."""
    text = text or ""
    words, lines = text.lower().split(), [line for line in text.split("\n") if line]
    n, size = max(1, len(words)), max(1, len(text))
    counts, line_counts = Counter(words), Counter(lines)
    letters = sum(map(str.isalpha, text))
    upper, digits = sum(map(str.isupper, text)), sum(map(str.isdigit, text))
    spaces = text.count(" ") + text.count("\n")
    marks = size - letters - digits - spaces
    tails = sum(not w[-1].isalnum() for w in words)
    most = counts.most_common(1)[0][1] if counts else 0
    shape = [
        math.log1p(len(words)), math.log1p(len(counts)), len(counts) / n, most / n, letters / size, digits / size, upper / max(1, letters),
        spaces / size, marks / size, tails / n, size / n, math.log1p(len(lines)), len(line_counts) / max(1, len(lines)),
        math.log1p(size / max(1, len(lines))), sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(not any(map(str.isalpha, w)) for w in counts) / max(1, len(counts)), text.count("|") / n, text.count("!") / n,
        len(re.findall(r"[#$%&*]{2,}", text)) / n, text.count("http") / n, text.count("@") / n, float(not words),
    ]
    made = np.zeros(len(shape) + WORD_BUCKETS, np.float32)
    made[: len(shape)] = shape
    for word, count in counts.items():
        made[len(shape) + xxhash.xxh32_intdigest(word) % WORD_BUCKETS] += count
    made[len(shape) :] = np.sqrt(made[len(shape) :] / n)
    return made


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed source, language, size class and their pairs; null is a value."""
    size = "none" if n_chars is None else str(int(2 * math.log2(1 + max(0, n_chars))))
    made = np.zeros(META_BUCKETS, np.float32)
    for item in (f"s{source}", f"l{lang}", f"n{size}", f"l{lang}/n{size}"):
        made[xxhash.xxh32_intdigest(item) % META_BUCKETS] = 1
    return made


@dataclass
class Logistic:
    """Weights over standardised features; the last one is the constant."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 5.0) -> Logistic:
        mean, scale = x.mean(0), x.std(0) + 1e-6
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))]).astype(np.float64)
        w, penalty = np.zeros(z.shape[1]), np.append(np.full(z.shape[1] - 1, ridge), 1e-3)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            grad = z.T @ (y - p) - penalty * w
            hess = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hess, grad)
            w += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
            if np.abs(step).max() < 1e-4:
                break
        return Logistic(mean, scale, w)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1], -20, 20)


@dataclass
class Model:
    views: tuple[Logistic, Logistic] | None
    curves: tuple[Logistic, Logistic] | None
    joint: Logistic | None
    prior: float = 0.5

    def scores(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        """Probabilities: joint, text view, metadata view."""
        if self.views is None:
            return [np.full(len(text), self.prior)] * 3
        odds = [c.odds(v.odds(x)[:, None]) for v, c, x in zip(self.views, self.curves, (text, meta))]
        return [1 / (1 + np.exp(-o)) for o in (self.joint.odds(np.column_stack(odds)), *odds)]


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray) -> Model:
    """Fit both views; a fifth of the labelled documents is set aside for calibration."""
    aside = np.arange(len(y)) % 5 == 0
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        return Model(None, None, None, float(y.mean()) if len(y) else 0.5)
    seen, pools = (text[~aside], meta[~aside]), (pool_text, pool_meta)
    given: list[dict[int, float]] = [{}, {}]  # what each view was told about the pool
    views = None
    for round_ in range(ROUNDS + 1):
        views = []
        for own, pool, told in zip(seen, pools, given):
            at = np.fromiter(told, np.int64, len(told))
            views.append(Logistic.fit(np.vstack([own, pool[at]]), np.append(y[~aside], [told[i] for i in at.tolist()])))
        if round_ == ROUNDS or not len(pool_text):
            break
        for me, other in ((0, 1), (1, 0)):
            p = 1 / (1 + np.exp(-views[me].odds(pools[me])))
            rate = y[~aside].mean()
            for label, sure, share in ((1.0, p, rate), (0.0, 1 - p, 1 - rate)):
                order = np.argsort(-sure, kind="stable")
                fresh = [i for i in order.tolist() if sure[i] >= SURE and i not in given[other]]
                for i in fresh[: max(1, int(SHARE_A_ROUND * len(p) * share))]:
                    given[other][i] = label
    odds = [v.odds(x[aside]) for v, x in zip(views, (text, meta))]
    curves = tuple(Logistic.fit(o[:, None], y[aside], 1.0) for o in odds)
    joint = Logistic.fit(np.column_stack([c.odds(o[:, None]) for c, o in zip(curves, odds)]), y[aside], 1.0)
    return Model(tuple(views), curves, joint)


def features(docs: DataFrame) -> DataFrame:
    """(y, text, meta): features of the documents as float lists."""
    width = T.ArrayType(T.FloatType())

    def make():
        def run(texts, sources, langs, sizes) -> list[pa.Array]:
            text = [text_features(t) for t in texts.to_pylist()]
            meta = [meta_features(*m) for m in zip(sources.to_pylist(), langs.to_pylist(), sizes.to_pylist())]
            return [pa.array(text, pa.list_(pa.float32())), pa.array(meta, pa.list_(pa.float32()))]

        return run

    added = with_columns(docs, ["text", "source", "lang", "n_chars"], [("text_x", width), ("meta_x", width)], make)
    return added.select("y", "text_x", "meta_x")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most LABELLED labelled documents, of which none is held out, and POOL
    others, one row of each id. Without labels of both classes every document gets the base rate."""
    order = F.xxhash64("doc_id", F.lit(6))
    fold = labels.filter("doc_id is not null and quality is not null").filter(~is_held_out(F.col("doc_id")))
    marked = fold.groupBy("doc_id").agg(F.max("quality").cast("double").alias("y")).orderBy(order, "doc_id").limit(LABELLED)
    rest = docs.select("doc_id").filter("doc_id is not null").filter(~is_held_out(F.col("doc_id"))).distinct()
    judged = labels.filter("quality is not null").select("doc_id")  # a label without a quality says nothing of it
    pool = rest.join(judged, "doc_id", "left_anti").orderBy(order, "doc_id").limit(POOL)
    chosen = staged(marked.unionByName(pool.withColumn("y", F.lit(None).cast("double"))), "quality-sample").withColumnRenamed("doc_id", "__id")
    met = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))  # at most LABELLED + POOL ids
    one = met.groupBy("__id").agg(F.min(F.struct("text", "source", "lang", "n_chars", "y")).alias("row"))  # a row each
    sample = features(one.select("row.*"))
    rows = staged(sample, "quality-features").orderBy(F.xxhash64("text_x", "meta_x")).toArrow()
    if not rows.num_rows:
        return Model(None, None, None)
    y = rows.column("y").to_numpy()
    known = ~np.isnan(y)
    text, meta = (c.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1) for c in (rows.column("text_x"), rows.column("meta_x")))
    return co_train(text[known], meta[known], y[known], text[~known], meta[~known])


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, text_score, meta_score of every document.

    Labels are learnt from documents that are not held out; a null id is never learnt
    from. Null and empty texts have the features of no words; null metadata is a value
    of its own. Repeated rows are scored alike; an empty table gives no rows.
    """
    plain = pick(docs, ("doc_id", "long"), ("text", "string"), ("source", "string"), ("lang", "string"), ("n_chars", "long"))
    model = train(plain, pick(labels, ("doc_id", "long"), ("quality", "int")))

    def make():
        def run(texts, sources, langs, sizes) -> list[pa.Array]:
            text = np.array([text_features(t) for t in texts.to_pylist()])
            meta = np.array([meta_features(*m) for m in zip(sources.to_pylist(), langs.to_pylist(), sizes.to_pylist())])
            return [pa.array(p, pa.float64()) for p in model.scores(text, meta)]

        return run

    names = ("score", "text_score", "meta_score")
    scored = with_columns(plain, ["text", "source", "lang", "n_chars"], [(n, T.DoubleType()) for n in names], make)
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_score", "meta_score",
    )
