"""Toxicity grades by cumulative-link ordinal regression over sparse text features."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import stored, text_batches

# Labelled rows that a model is fitted on, at most.
SAMPLE_ROWS = 6_000
# Features that a model has, at most, and rows in which each occurs, at least.
FEATURES, LEAST_ROWS = 300, 8
# Words added to a text's length, so that a few words alone prove little.
SMOOTHING = 20
# A document is rejected from this probability of any grade above 0.
REJECT = 0.5
PENALTY = 0.02
STEPS = 300
# Words whose weight a Python worker remembers; a cache, emptied when full.
CACHE = 150_000

_WORD = re.compile(r"[^\W\d_]+")
# Lengths of word beginnings, which bring together the forms of a stem.
_BEGINNINGS = (3, 4, 5, 6, 7)


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings, marked by a hyphen."""
    return [word, *[word[:n] + "-" for n in _BEGINNINGS if len(word) > n]]


def shares(text: str | None) -> dict[str, float]:
    """Per feature, the per cent of a text's words, and SMOOTHING more, that have it."""
    words = Counter(_WORD.findall((text or "").lower()))
    total = sum(words.values()) + SMOOTHING
    found: Counter[str] = Counter()
    for word, n in words.items():
        for feature in word_features(word):
            found[feature] += n
    return {feature: 100 * n / total for feature, n in found.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Grades:
    """P(grade > k) = sigmoid(weights . x - thresholds[k]), with thresholds that rise.

    All thresholds share the weights, of which there is one per feature.
    """

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > 0), P(grade > 1), ... per score."""
        return _sigmoid(np.asarray(score, float)[:, None] - np.array(self.thresholds)[None, :])

    def word_weight(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in word_features(word))


def fit_grades(x: np.ndarray, grades: np.ndarray, names: Sequence[str], penalty: float = PENALTY) -> Grades:
    """Fit by maximum likelihood with a ridge penalty, by full gradient steps (Adam).

    ``x`` (rows, features) is not negative; ``grades`` are 0, 1, ..., K - 1, K at
    least 2. Thresholds are a first one and positive gaps, so they stay in order.
    """
    kinds = int(grades.max()) + 1
    scale = np.maximum(np.sqrt((x * x).mean(0)), 1e-9)
    z = x / scale
    n, width = z.shape
    # weights, first threshold, logarithms of gaps
    state = np.zeros(width + kinds - 1)
    state[width] = 2.0
    first_moment, second_moment = np.zeros_like(state), np.zeros_like(state)
    rows = np.arange(n)
    for step in range(1, STEPS + 1):
        gaps = np.exp(state[width + 1 :])
        cuts = state[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        above = _sigmoid((z @ state[:width])[:, None] - cuts[None, :])
        edges = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        slope = edges * (1 - edges)
        chance = np.maximum(edges[rows, grades] - edges[rows, grades + 1], 1e-12)
        by_score = (slope[rows, grades] - slope[rows, grades + 1]) / chance
        by_cut = np.zeros((n, kinds + 1))
        by_cut[rows, grades] -= slope[rows, grades] / chance
        by_cut[rows, grades + 1] += slope[rows, grades + 1] / chance
        cut_slope = by_cut[:, 1:-1].mean(0)
        from_end = np.cumsum(cut_slope[::-1])[::-1]
        gradient = np.concatenate(
            [z.T @ by_score / n - penalty * state[:width], from_end[:1], from_end[1:] * gaps]
        )
        first_moment = 0.9 * first_moment + 0.1 * gradient
        second_moment = 0.999 * second_moment + 0.001 * gradient**2
        pace = 0.05 * first_moment / (1 - 0.9**step)
        state = state + pace / (np.sqrt(second_moment / (1 - 0.999**step)) + 1e-8)
    cuts = state[width] + np.concatenate([[0.0], np.cumsum(np.exp(state[width + 1 :]))])
    weights = {f: float(w) for f, w in zip(names, state[:width] / scale)}
    return Grades(weights, tuple(float(c) for c in cuts))


def association(with_toxic: np.ndarray, with_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Chi-squared of a feature's presence against the label, signed by its direction."""
    n = toxic + clean
    have = with_toxic + with_clean
    cross = with_toxic * (clean - with_clean) - with_clean * (toxic - with_toxic)
    under = np.maximum(toxic * clean * have * (n - have), 1)
    return np.sign(cross) * n * cross.astype(float) ** 2 / under


def _presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for text, toxic in zip(rows["text"], rows["toxic"]):
            features = list(shares(text if isinstance(text, str) else ""))
            # A text without words has no row.
            if features:
                yield pd.DataFrame({"feature": np.array(features, object), "toxic": int(toxic)})


def _chosen(names: list[str]):
    place = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            texts = [t if isinstance(t, str) else "" for t in rows["text"]]
            found = [{place[f]: s for f, s in shares(t).items() if f in place} for t in texts]
            yield pd.DataFrame(
                {"toxic": rows["toxic"], "at": [list(x) for x in found], "share": [list(x.values()) for x in found]}
            )

    return run


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Grades | None:
    """A model of three grades from labels of two; None without toxic or clean rows.

    ``labels`` has doc_id and toxic (0 or 1). The grades are 0 for clean
    documents, and 1 and 2 for toxic ones below and from the median, over toxic
    documents, of the share of words that speak for toxicity. At most
    ``sample_rows`` labelled rows are used, those of the least hash of doc_id, so
    the one task that fits them is bounded by that and by FEATURES. Features are
    the ones most strongly associated with the label.
    """
    wanted = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", "toxic")
    sample = wanted.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id", "toxic").limit(sample_rows)
    # A label that is repeated counts once; at most sample_rows small rows, so the join is broadcast.
    sample = stored(sample.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    rows = stored(documents.select("doc_id", "text").join(sample, "doc_id").select("text", "toxic"), "sample")
    toxic, clean = rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not toxic or not clean:
        return None
    present = rows.mapInPandas(_presence, "feature string, toxic int")
    counts = present.groupBy("feature").agg(
        F.sum("toxic").alias("with_toxic"), F.sum(1 - F.col("toxic")).alias("with_clean")
    )
    counts = stored(counts.where(F.col("with_toxic") + F.col("with_clean") >= LEAST_ROWS), "counts")
    n, t, c = F.lit(float(toxic + clean)), F.col("with_toxic"), F.col("with_clean")
    cross = (t * (clean - c) - c * (toxic - t)).cast("double")
    strength = n * cross * cross / F.greatest(F.lit(float(toxic) * clean) * (t + c) * (n - t - c), F.lit(1.0))
    best = counts.select("feature", strength.alias("strength"), (cross > 0).alias("speaks_for"))
    best = best.orderBy(F.desc("strength"), "feature").limit(FEATURES)
    # FEATURES rows in one, and then one row with a weight for each.
    chosen = best.agg(F.sort_array(F.collect_list(F.struct("feature", "speaks_for"))).alias("all")).first()["all"]
    if not chosen:
        return None
    names = [r.feature for r in chosen]
    found = rows.mapInPandas(_chosen(names), "toxic int, at array<int>, share array<double>")
    fitted = found.withColumn("sample", F.lit(0)).groupBy("sample").applyInPandas(
        _fit_rows(names, [r.speaks_for for r in chosen]), "weights array<double>, thresholds array<double>"
    )
    model = fitted.first()
    return Grades(dict(zip(names, model.weights)), tuple(model.thresholds))


def _fit_rows(names: list[str], speaks_for: list[bool]):
    """Fit a model on the sample, whose size is bounded, in one task."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        order = [repr((t, list(a), list(s))) for t, a, s in zip(rows["toxic"], rows["at"], rows["share"])]
        rows = rows.assign(order=order).sort_values("order", ignore_index=True)
        x = np.zeros((len(rows), len(names)))
        for i, (at, share) in enumerate(zip(rows["at"], rows["share"])):
            x[i, at] = share
        is_toxic = rows["toxic"].to_numpy() == 1
        evidence = x[:, speaks_for].sum(1)
        grades = np.where(is_toxic, np.where(evidence >= np.median(evidence[is_toxic]), 2, 1), 0)
        if not (grades == 1).any():
            grades = is_toxic.astype(int)
        model = fit_grades(x, grades, names)
        return pd.DataFrame({"weights": [[model.weights[f] for f in names]], "thresholds": [list(model.thresholds)]})

    return run


class _Weights(dict):
    """Weight per word, computed when first asked for."""

    def __init__(self, model: Grades):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = self.model.word_weight(word)
        return found


def _score(model: Grades):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = _Weights(model).__getitem__
        for rows in batches:
            scores = []
            for text in rows.pop("text"):
                words = _WORD.findall(text.lower()) if isinstance(text, str) else []
                scores.append(100 * sum(map(weight, words)) / (len(words) + SMOOTHING))
            above = model.above(np.array(scores))
            chance = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1), axis=1)
            rows["p_toxic"] = np.round(above[:, 0], 6)
            rows["severity"] = np.round(above.sum(1), 6)
            rows["grade"] = chance.argmax(1).astype(np.int32)
            yield rows

    return run


def grade(documents: DataFrame, model: Grades | None, reject: float = REJECT) -> DataFrame:
    """The columns of ``documents`` but text, with p_toxic, severity, grade, rejected.

    severity is the expected grade, the sum of the probabilities of each grade
    and those above. A document is rejected from a probability ``reject`` of any
    grade above 0. The score is additive over words and taken per word, so long
    texts are read whole and weigh no more than short ones. Without a model,
    and for texts without words, it rests on the thresholds alone: nothing is
    rejected where toxic documents are the fewer. Null text is an empty one.
    """
    taken = {"p_toxic", "severity", "grade", "rejected"} & set(documents.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} must be free")
    text_batches(documents.sparkSession)
    kept = [f"`{c}` {t}" for c, t in documents.dtypes if c != "text"]
    schema = ", ".join([*kept, "p_toxic double, severity double, grade int"])
    scored = documents.mapInPandas(_score(model or Grades({}, (40.0,))), schema)
    return scored.withColumn("rejected", F.col("p_toxic") >= reject)


def drop_toxic(documents: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """``documents`` without those that a model fitted on ``labels`` rejects.

    All columns stay, in order; rows that are not rejected are unchanged.
    """
    model = fit(documents, labels)
    inner = documents.withColumn("_text", F.col("text")).select(*[F.col(c) for c in documents.columns if c != "text"], "_text", "text")
    kept = grade(inner, model, reject).where(~F.col("rejected"))
    return kept.withColumnRenamed("_text", "text").select(*documents.columns)
