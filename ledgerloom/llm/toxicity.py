"""Toxic passages by maximum-scoring segments of token log-odds.

Training: words of labelled documents are counted per class. A word's odds ratio has a
Dirichlet prior whose mean is the ratio of its stem (its first letters, longest first),
and each stem's that of a shorter stem, so a rare or unseen form leans on its stem and a
rare stem on nothing. Words and stems that carry evidence make the lexicon; all other
words cost a little.

Scoring: one linear scan over a document's token scores finds all maximal scoring
segments. Under clean text the best of them follows an extreme-value law with a rate
``lam``, the root of E[exp(lam * score)] = 1, and a constant K fitted to clean training
documents; a segment is significant if its E-value K * n * exp(-lam * S) is small. A
document's evidence is that of its best segment plus what further significant ones add,
and a logistic curve fitted to the training labels, weighted to the class ratio of all
labels, turns it into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import is_held_out, pick, slices, staged, with_columns

# Bounds of the training: documents per class, entries of the lexicon, letters of a stem.
TRAIN_DOCS = 20_000
MOST_ENTRIES = 100_000
STEMS = (6, 5, 4, 3)
PRIOR = 30.0  # clean words that the prior of a word or stem weighs
OTHER_SCORE = -0.25  # of a word without evidence: what a passage may span
LEAST_EVIDENCE = 1.5  # log-odds from which an entry counts
SIGNIFICANT = 0.05  # E-value
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


@dataclass
class Model:
    scores: dict[str, float] = field(default_factory=dict)  # words, and stems with a "*"
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    offset: float = -1.0

    def score_words(self, cache: dict[str, float], words: list[str]) -> np.ndarray:
        def look(word: str) -> float:
            value = self.scores.get(word)
            for size in STEMS:
                if value is not None:
                    break
                if len(word) >= size:
                    value = self.scores.get(word[:size] + "*")
            return OTHER_SCORE if value is None else value

        if len(cache) > 300_000:
            cache.clear()
        for w in set(words):
            if w not in cache:
                cache[w] = look(w)
        scores = np.fromiter(map(cache.__getitem__, words), np.float64, len(words))
        scores[1:][[a == b for a, b in zip(words, words[1:])]] = OTHER_SCORE  # said already
        return scores

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> float:
        """-ln E of the best segment, and what other significant segments add."""
        if not segments:
            return -10.0
        logs = sorted((self.lam * s - math.log(max(self.k * n, 1e-300)) for _, _, s in segments), reverse=True)
        more = sum(x for x in logs[1:] if x > -math.log(SIGNIFICANT))
        return max(-10.0, min(60.0, logs[0] + 0.5 * more))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -30, 30)))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score), in one linear scan. Only words
    of positive score are visited; running totals stand for the words between."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # begin, end, total before, total after
    for at in np.flatnonzero(scores > 0).tolist():
        begin, end, low, high = at, at + 1, total[at], total[at + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:  # the last one that begins lower
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append([begin, end, low, high, j])
                break
            begin, low = found[j][0], found[j][2]
            del found[j:]
    return [(b, e, float(h - l)) for b, e, l, h, _ in found]


def sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """(text, toxic) of the training documents: labelled, not held out, at most
    TRAIN_DOCS of each class by a hash of the id (all of them, if fewer). That bound is
    what makes the label side small enough to broadcast. Beside it, the weight of a
    document of each class that gives the sample the class ratio of all labels of the
    fold, whatever the bound left out; weights have a mean of 1."""
    fold = labels.filter("doc_id is not null and toxic is not null").filter(~is_held_out(F.col("doc_id")))
    named = staged(fold.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-fold")
    order = F.xxhash64("doc_id", F.lit(11))
    few = [staged(named.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(TRAIN_DOCS), "toxic-labels") for c in (0, 1)]
    picked = few[0].unionByName(few[1]).withColumnRenamed("doc_id", "__id")
    there = {r["toxic"]: r["n"] for r in named.filter("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    taken = {c: min(n, TRAIN_DOCS) for c, n in there.items()}
    mean = sum(there.values()) / max(1, sum(taken.values()))
    weights = {c: n / taken[c] / mean for c, n in there.items()}
    return docs.join(F.broadcast(picked), F.col("doc_id") == F.col("__id")).select("text", "toxic"), weights


def count_words(train: DataFrame) -> DataFrame:
    """(word, toxic_n, clean_n): training documents with the word, summed per batch
    first. A document counts once, however often it repeats a word."""

    def step(batches):
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for part in slices(batch):
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    (toxic if label else clean).update(set(words_of(text)))
            names = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic[w] for w in names], pa.int64()), pa.array([clean[w] for w in names], pa.int64())],
                ["word", "toxic_n", "clean_n"],
            )

    counted = train.mapInArrow(step, "word string, toxic_n long, clean_n long")
    return counted.groupBy("word").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("clean_n").alias("clean_n"))


def lexicon(counts: DataFrame) -> dict[str, float]:
    """Scores of words and stems with evidence, and of the words under such a stem that
    speak against it. At most MOST_ENTRIES, those with the most evidence."""
    counts = staged(counts, "toxic-counts")
    total = counts.agg(F.sum("toxic_n"), F.sum("clean_n")).first()
    if not total[0] or not total[1]:
        return {}
    unit = total[1] / total[0]  # clean words for a toxic one
    ratio = (F.col("toxic_n") * unit + PRIOR * F.col("mean")) / (F.col("clean_n") + PRIOR)
    tables, parent = [], None
    for size in sorted(STEMS):
        stems = (
            counts.filter(F.char_length("word") >= size).groupBy(F.substring("word", 1, size).alias("stem"))
            .agg(F.sum("toxic_n").alias("toxic_n"), F.sum("clean_n").alias("clean_n"))
        )
        if parent is None:
            stems = stems.withColumn("mean", F.lit(1.0))
        else:
            shorter = parent.select(F.col("stem").alias("__up"), F.col("ratio").alias("mean"))
            stems = stems.join(shorter, F.substring("stem", 1, size - 1) == F.col("__up"), "left").fillna(1.0, ["mean"])
        parent = staged(stems.filter("toxic_n > 0").withColumn("ratio", ratio).select("stem", "toxic_n", "clean_n", "ratio"), "toxic-stems")
        tables.append(parent)
    keyed = counts
    means = []
    for size, stems in zip(sorted(STEMS), tables):
        name = f"m{size}"
        known = stems.select(F.col("stem").alias(f"s{size}"), F.col("ratio").alias(name))
        keyed = keyed.join(known, (F.substring("word", 1, size) == F.col(f"s{size}")) & (F.char_length("word") >= size), "left").drop(f"s{size}")
        means.append(F.col(name))
    words = keyed.withColumn("mean", F.coalesce(*reversed(means), F.lit(1.0))).withColumn("ratio", ratio)
    odd = F.abs(F.log("ratio"))
    told = words.filter((F.log("ratio") >= LEAST_EVIDENCE) & (F.col("toxic_n") > 0) | (F.log("mean") >= LEAST_EVIDENCE))
    parts = [told.select(F.col("word").alias("entry"), "ratio", "toxic_n")]
    for stems in tables:
        parts.append(stems.filter(F.log("ratio") >= LEAST_EVIDENCE).select(F.concat("stem", F.lit("*")).alias("entry"), "ratio", "toxic_n"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    rows = found.orderBy((F.col("toxic_n") * odd).desc(), "entry").limit(MOST_ENTRIES).collect()
    return {r["entry"]: max(OTHER_SCORE, min(8.0, math.log(r["ratio"]))) for r in rows}


def train_model(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit lexicon, extreme-value law and curve. Without labels of both classes the model
    knows nothing: every document gets the same low score."""
    train, weights = sampled(docs, labels)
    train = staged(train, "toxic-train")
    model = Model(lexicon(count_words(train)))
    if not model.scores:
        return model
    # the law of clean words: how often each score occurs among clean training documents
    def clean_scores(batches):
        cache: dict = {}
        for batch in batches:
            seen: Counter = Counter()
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    seen.update(np.round(model.score_words(cache, words_of(text)), 1).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.float64()), pa.array(list(seen.values()), pa.int64())], ["score", "n"])

    law = (
        train.filter("toxic = 0").select("text").mapInArrow(clean_scores, "score double, n long")
        .groupBy("score").agg(F.sum("n").alias("n")).collect()
    )
    model.lam = solve_rate(np.array([r["score"] for r in law]), np.array([r["n"] for r in law], float))

    def best(batches):
        cache: dict = {}
        for batch in batches:
            for part in slices(batch):
                rows = [segment_row(model, cache, t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).cast(pa.int32()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.float64())],
                    ["toxic", "n", "best"],
                )

    tops = train.select("text", "toxic").mapInArrow(best, "toxic int, n long, best double")
    tops = staged(tops, "toxic-tops")
    # the constant of the law by maximum likelihood over clean documents
    fit = tops.filter("toxic = 0 and n > 0").agg(F.count("*"), F.sum(F.col("n") * F.exp(-model.lam * F.col("best")))).first()
    model.k = max(1e-12, fit[0] / fit[1]) if fit[1] else 1.0

    def felt(batches):
        cache: dict = {}
        for batch in batches:
            for part in slices(batch):
                values = [evidence_of(model, cache, t)[0] for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(1).cast(pa.int32()), pa.array(values, pa.float64())], ["toxic", "x"])

    bins = (
        train.select("text", "toxic").mapInArrow(felt, "toxic int, x double")
        .groupBy(F.round("x", 1).alias("x")).agg(F.sum("toxic").alias("ones"), F.count("*").alias("n")).collect()
    )  # at most 701 rows
    weighted = [(r["x"], weights[1] * r["ones"], weights[0] * (r["n"] - r["ones"])) for r in bins]
    model.slope, model.offset = fit_curve([(x, ones, ones + zeros) for x, ones, zeros in weighted])
    return model


def solve_rate(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E[exp(lam * value)] = 1."""
    share = counts / counts.sum()
    if not (values > 0).any() or (share * values).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (share * np.exp(high * values)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (share * np.exp(mid * values)).sum() < 1 else (low, mid)
    return max(0.05, high)


def fit_curve(bins: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve by damped Newton steps."""
    x, ones, n = (np.array(c, float) for c in zip(*bins))
    ones = ones + 0.5 * n / n.sum()  # keeps a perfect separation finite
    a, b = 0.1, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = n * p * (1 - p)
        grad = np.array([((ones - n * p) * x).sum() - 0.01 * a, (ones - n * p).sum()])
        hess = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hess, grad), -1, 1)
        a, b = max(0.0, a + step[0]), b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def segment_row(model: Model, cache: dict, text: str | None) -> tuple[int, float]:
    words = words_of(text)
    found = segments(model.score_words(cache, words)) if words else []
    return len(words), max((s for _, _, s in found), default=0.0)


def evidence_of(model: Model, cache: dict, text: str | None) -> tuple[float, list[tuple[int, int, float]], int]:
    words = words_of(text)
    found = segments(model.score_words(cache, words)) if words else []
    return model.evidence(found, len(words)), found, len(words)


def score(docs: DataFrame, model: Model, text: str = "text", score: str = "score", passages: str = "passages") -> DataFrame:
    """Append a score from 0 to 1 and the significant passages of every row's whole text.

    A passage is (first word, word after the last, score, E-value), words counted from 0
    among runs of letters. Null, empty and wordless texts have no evidence and get the
    lowest score; a very long text is one scan. Existing columns of these names are
    replaced; ids, labels and all other columns play no part.
    """
    kind = T.ArrayType(
        T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("e_value", T.DoubleType())])
    )
    arrow = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))

    def make():
        cache: dict = {}

        def run(texts: pa.Array) -> list[pa.Array]:
            values, spans = [], []
            for t in texts.to_pylist():
                x, found, n = evidence_of(model, cache, t)
                values.append(x)
                marked = [(b, e, s, model.k * n * math.exp(-model.lam * s)) for b, e, s in found]
                spans.append([{"first": b, "last": e, "score": s, "e_value": v} for b, e, s, v in marked if v <= SIGNIFICANT])
            return [pa.array(model.probability(np.array(values, float)), pa.float64()), pa.array(spans, arrow)]

        return run

    return with_columns(docs.drop(score, passages), [text], [(score, T.DoubleType()), (passages, kind)], make)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, passages of every document. Labels are learnt
    from documents that are not held out; a null id is not held out and never learnt
    from. Repeated rows are scored alike; an empty table gives no rows."""
    plain = pick(docs, ("doc_id", "long"), ("text", "string"))
    model = train_model(plain, pick(labels, ("doc_id", "long"), ("toxic", "int")))
    return score(plain, model).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages",
    )
