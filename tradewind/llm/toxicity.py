"""Toxicity by cumulative-link ordinal regression.

A document has a severity grade 0..K. With x its sparse word features and ordered
thresholds t_1 < ... < t_K, P(grade >= k) = 1 / (1 + exp(t_k - w.x)): one weight vector is
shared by all thresholds. The expected severity is the sum of P(grade >= k).

The labels only say toxic or not. The grades 1..K of toxic rows are set from how much of
the text is made of words that the labels associate with toxic rows: the rows are ranked
by that share and cut into K parts of equal size.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_rows, texts
from .decontaminate import words_of


@dataclass(frozen=True)
class Settings:
    """``max_sample`` bounds the fitting sample: so many labelled rows, those with the
    smallest hash of their id. ``max_words`` bounds the
    different words that one of them sends."""

    grades: int = 3
    max_sample: int = 6000
    max_words: int = 20000
    max_features: int = 6000  # those that tell toxic rows apart best
    min_rows: int = 10  # rows of the sample a feature must be in, and the share of them
    min_share: float = 1 / 300
    l1: float = 0.0003
    l2: float = 0.00001
    steps: int = 400
    toxic_from: float = 0.4


PREFIXES = (4, 5, 6, 7)


def stems(word: bytes) -> list[bytes]:
    """The features of a word: itself, marked by a blank, and its first bytes, so that
    words never seen that begin like known ones count too."""
    return [b" " + word, *[word[:k] for k in PREFIXES if len(word) > k]]


def counts(words: dict[bytes, int]) -> dict[bytes, int]:
    """How often each feature occurs, from how often each word does."""
    out: dict[bytes, int] = {}
    for w, n in words.items():
        for f in stems(w):
            out[f] = out.get(f, 0) + n
    return out


@dataclass
class Model:
    weights: dict[bytes, float]
    thresholds: np.ndarray


def sample(labelled: DataFrame, s: Settings) -> list[tuple[int, dict[bytes, int]]]:
    """(toxic, word counts) of the bounded sample. Only rows with a label and a text."""
    chosen = labelled.where("toxic is not null and text is not null").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "toxic").limit(s.max_sample)

    def fn(b: pa.RecordBatch) -> dict:
        found = [Counter(words_of(t)).most_common(s.max_words) for t in texts(b.column("text"))]
        return {"toxic": b.column("toxic"), "words": [b" ".join(w for w, _ in f) for f in found], "counts": [np.array([n for _, n in f], np.int32).tobytes() for f in found]}

    rows = map_rows(chosen, fn, "toxic int, words binary, counts binary").collect()
    return [(int(r["toxic"] > 0), dict(zip(bytes(r["words"]).split(b" ") if r["words"] else [], np.frombuffer(r["counts"], np.int32).tolist()))) for r in rows]


def fit(data: list[tuple[int, dict[bytes, int]]], s: Settings) -> Model:
    """Fit on (toxic, word counts). Without both kinds of rows nothing is ever toxic."""
    labels = np.array([t for t, _ in data], np.int64)
    if not len(labels) or labels.min() == labels.max():
        return Model({}, np.full(s.grades, 30.0))
    data = [(t, counts(words)) for t, words in data]
    number = chosen(data, labels, s)
    row, col, val = [], [], []
    for r, (_, c) in enumerate(data):
        for w, n in c.items():
            if (k := number.get(w)) is not None:
                row.append(r)
                col.append(k)
                val.append(np.log1p(n))
    words = list(number)
    x = _Sparse(np.array(row, np.int64), np.array(col, np.int64), np.array(val), len(data), len(number))
    grades = graded(data, labels, number, s)
    w, thresholds = cumulative_link(x, grades, s)
    return Model({words[k]: float(w[k]) for k in np.flatnonzero(w)}, thresholds)


def chosen(data: list, labels: np.ndarray, s: Settings) -> dict[bytes, int]:
    """Numbers for the features in enough rows that have the largest
    likelihood ratio between toxic and other rows; ties go by the feature itself."""
    rows_with, toxic_with = Counter(), Counter()
    for t, (_, c) in zip(labels, data):
        rows_with.update(c.keys())
        if t:
            toxic_with.update(c.keys())
    least = max(s.min_rows, s.min_share * len(labels))
    names = sorted(f for f, n in rows_with.items() if n >= least)
    n = np.array([rows_with[f] for f in names], float)
    k = np.array([toxic_with[f] for f in names], float)
    p = labels.mean()
    gain = _g(k, n * p) + _g(n - k, n * (1 - p))
    best = np.sort(np.argsort(-gain, kind="stable")[: s.max_features])
    return {names[i]: j for j, i in enumerate(best)}


def _g(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
    return seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))


def graded(data: list, labels: np.ndarray, number: dict[bytes, int], s: Settings) -> np.ndarray:
    """Severity grades: 0 for rows not toxic, 1..K for toxic rows by the share of their
    features that are at least four times as frequent in toxic rows."""
    toxic, other = np.ones(len(number)), np.ones(len(number))
    for t, (_, c) in zip(labels, data):
        mine = toxic if t else other
        for f in c:
            if (k := number.get(f)) is not None:
                mine[k] += 1
    odd = toxic / (labels.sum() + 2) >= 4 * other / (len(labels) - labels.sum() + 2)
    share = np.array([sum(n for f, n in c.items() if (k := number.get(f)) is not None and odd[k]) / max(1, sum(c.values())) for _, c in data])
    out = np.zeros(len(labels), np.int64)
    bad = np.flatnonzero(labels)
    ranks = np.empty(len(bad), np.int64)
    ranks[np.argsort(share[bad], kind="stable")] = np.arange(len(bad))
    out[bad] = 1 + ranks * s.grades // len(bad)
    return out


@dataclass
class _Sparse:
    row: np.ndarray
    col: np.ndarray
    val: np.ndarray
    rows: int
    cols: int

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], self.rows)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * g[self.row], self.cols)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def cumulative_link(x: _Sparse, grades: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by AdaGrad on the likelihood, with the elastic net's
    proximal step on the weights. The thresholds stay ordered: each is the one before
    plus an exponential."""
    n, k_max = len(grades), s.grades
    w = np.zeros(x.cols)
    share = [max(1e-3, min(1 - 1e-3, (grades >= k).mean())) for k in range(1, k_max + 1)]
    first = np.log((1 - share[0]) / share[0])
    gaps = np.zeros(k_max - 1)
    sum_w, sum_t = np.full(x.cols, 1e-8), np.full(k_max, 1e-8)
    for _ in range(s.steps):
        t = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = x.dot(w)
        above = _sigmoid(score[:, None] - t[None, :])  # P(grade >= k), k = 1..K
        wide = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        p = np.maximum(wide[np.arange(n), grades] - wide[np.arange(n), grades + 1], 1e-9)
        slope = wide * (1 - wide)
        upper, lower = slope[np.arange(n), grades] / p, slope[np.arange(n), grades + 1] / p
        g_score = -(upper - lower) / n
        g_t = np.zeros(k_max)
        for k in range(1, k_max + 1):
            g_t[k - 1] = (upper[grades == k].sum() - lower[grades == k - 1].sum()) / n
        g_w = x.back(g_score) + s.l2 * w
        g_all = np.concatenate([[g_t.sum()], [g_t[k:].sum() * np.exp(gaps[k - 1]) for k in range(1, k_max)]])
        sum_w += g_w * g_w
        sum_t += g_all * g_all
        rate = 0.5 / np.sqrt(sum_w)
        w = w - rate * g_w
        w = np.sign(w) * np.maximum(np.abs(w) - rate * s.l1, 0)
        step = 0.2 / np.sqrt(sum_t) * g_all
        first -= step[0]
        gaps = np.clip(gaps - step[1:], -6, 4)
    return w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


class Scorer:
    """Scores texts; remembers which weighted features the words met so far have."""

    def __init__(self, model: Model, remember: int = 400_000) -> None:
        self.model, self.remember = model, remember
        self.known: dict[bytes, tuple[bytes, ...]] = {}

    def above(self, text: bytes | None) -> np.ndarray:
        """P(grade >= k) for k = 1..K."""
        known, weights = self.known, self.model.weights
        if len(known) > self.remember:
            known.clear()
        words = words_of(text)
        for w in words:
            if w not in known:
                known[w] = tuple(f for f in stems(w) if f in weights)
        found = Counter(f for w in words if known[w] for f in known[w])
        total = sum(weights[f] * np.log1p(n) for f, n in found.items())
        return _sigmoid(total - self.model.thresholds)


def severity(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", settings: Settings = Settings()) -> DataFrame:
    """doc_id, expected_severity (0..K), p_grade (probabilities of 0..K), toxic, grade
    (the likeliest) for each row of ``df``; ``labels`` has the id and ``label_col``.

    A null, empty or blank text has no features and gets the model's base rates, and is
    not toxic. Rows without a label, or with a null one, are not learned from; neither are
    rows without an id. An id labelled twice counts as toxic if either label says so.
    The sample's bound counts labels of documents that ``df`` has; others take no place in it.
    Repeated rows are scored one by one; an empty table gives no rows, and without toxic
    and other labels nothing is toxic. Other columns are not looked at.
    """
    docs = documents(df, id_col, text_col)
    marks = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The sample is cut from the labels of documents that are there, on ids alone, so that
    # only its texts are joined.
    here = marks.where("toxic is not null").join(docs.select("doc_id"), "doc_id", "left_semi")
    cut = here.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_sample)
    model = fit(sample(docs.join(cut, "doc_id"), settings), settings)
    shared = df.sparkSession.sparkContext.broadcast(model)
    scorers: list[Scorer] = []

    def fn(b: pa.RecordBatch) -> dict:
        if not scorers:  # one a task
            scorers.append(Scorer(shared.value))
        scorer = scorers[0]
        at = [scorer.above(t) for t in texts(b.column("text"))]
        wide = [np.concatenate([[1.0], a, [0.0]]) for a in at]
        p = [w[:-1] - w[1:] for w in wide]
        blank = [not t or t.isspace() for t in texts(b.column("text"))]
        return {
            "doc_id": b.column("doc_id"),
            "expected_severity": [float(a.sum()) for a in at],
            "p_grade": [x.tolist() for x in p],
            "toxic": [bool(a[0] >= settings.toxic_from) and not e for a, e in zip(at, blank)],
            "grade": [int(x.argmax()) for x in p],
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, fn, f"doc_id {kind}, expected_severity double, p_grade array<double>, toxic boolean, grade bigint")
