"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams, trained with FTRL-proximal and an elastic net, calibrated by a temperature.

Document frequencies are counted over all rows that may be learned from; the weights are
fitted on a bounded sample of them. A term frequency is a share of the text's n-grams, so
a score is a sum over n-grams and long texts need no more memory than a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, texts

ORDERS = (1, 2, 3)
BITS = 15
SIZE = len(ORDERS) << BITS
CHUNK = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``per_language`` bounds the fitting sample: so many rows of each language, those
    with the smallest hash of their id."""

    per_language: int = 600
    epochs: int = 4
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    scale: float = 32.0
    calibration_every: int = 5  # every so many sample rows set the temperature only


@cache
def _letters() -> np.ndarray:
    """For every code point: its lower case if it is a letter, else a blank."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letters_of(text: bytes) -> np.ndarray:
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return _letters()[points]


def gram_numbers(letters: np.ndarray) -> Iterator[np.ndarray]:
    """The hashed n-grams of a text, order by order, of at most ``CHUNK`` letters each."""
    wide = letters.astype(np.uint64)
    for place, order in enumerate(ORDERS):
        for first in range(0, len(wide) - order + 1, CHUNK):
            last = min(len(wide) - order + 1, first + CHUNK)
            h = np.zeros(last - first, np.uint64)
            for k in range(order):
                h = (h + wide[first + k : last + k] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            # Grams of blanks alone say nothing; they go to a number of their own.
            yield (h >> np.uint64(64 - BITS)).astype(np.int64) + (place << BITS)


def learnable(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """doc_id, text, lang, held_out (crc32 of the id as text, modulo 3, is 1)."""
    rest = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.coalesce(rest == 1, F.lit(False)).alias("held_out"))


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many rows each n-gram number occurs, and the rows: over all of ``rows``.
    A task sends one count a number at most; SIZE bounds what the driver gets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE, np.int64)
        n = 0
        seen = np.zeros(SIZE, bool)
        for b in batches:
            for t in texts(b.column("text")):
                seen[:] = False
                for h in gram_numbers(letters_of(t or b"")):
                    seen[h] = True
                total += seen
                n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(total[at], n), pa.int64())], names=["number", "n"])

    out = np.zeros(SIZE, np.int64)
    n = 0
    for r in rows.select("text").mapInArrow(count, "number bigint, n bigint").groupBy("number").agg(F.sum("n").alias("n")).collect():
        if r["number"] < 0:
            n = r["n"]
        else:
            out[r["number"]] = r["n"]
    return out, n


def _sparse(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The different n-gram numbers of a text with their counts."""
    counts = np.zeros(SIZE, np.int64)
    for h in gram_numbers(letters_of(text)):
        counts += np.bincount(h, minlength=SIZE)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), counts[at].astype(np.int32)


def _lowest(narrow: DataFrame, least: int) -> DataFrame:
    """Of each language the rows up to some hash: ``least`` at least, if it has as many, and
    not many more, so that no task gets all rows of a language. The bounds follow from counts,
    one number a language."""
    counts = {r["lang"]: r["n"] for r in narrow.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = 2 * least + 500
    while True:
        # Hashes are spread evenly over all signed 64-bit numbers.
        bounds = {lang: -(1 << 63) + (wanted << 64) // n for lang, n in counts.items() if n > wanted}
        if not bounds:
            return narrow
        limits = narrow.sparkSession.createDataFrame([(lang, b) for lang, b in bounds.items()], "lang string, bound bigint")
        kept = narrow.join(limits, "lang", "left").where("bound is null or h <= bound").drop("bound")
        found = {r["lang"]: r["n"] for r in kept.where(F.col("lang").isin(list(bounds))).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
        if all(found.get(lang, 0) >= least for lang in bounds):
            return kept
        wanted *= 2  # ids that repeat share a hash


def sample(rows: DataFrame, per_language: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, numbers, counts) of the fitting sample; its size is bounded by the number
    of languages, ``per_language`` and SIZE."""
    # Cut on narrow rows; only the chosen ids' texts are fetched, and there are few.
    narrow = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    w = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = _lowest(narrow, per_language).withColumn("r", F.row_number().over(w)).where(F.col("r") <= per_language)
    chosen = rows.select("doc_id", "text", "lang").join(ids.groupBy("lang", "doc_id").agg(F.min("r").alias("r")), ["lang", "doc_id"])

    def fn(b: pa.RecordBatch) -> dict:
        found = [_sparse(t or b"") for t in texts(b.column("text"))]
        return {"lang": b.column("lang"), "r": b.column("r"), "at": [f[0].tobytes() for f in found], "n": [f[1].tobytes() for f in found]}

    got = map_rows(chosen, fn, "lang string, r int, at binary, n binary").collect()
    return [(r["lang"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["n"], np.int32)) for r in sorted(got, key=lambda r: (r["r"], r["lang"], r["at"]))]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (SIZE, languages), inverse document frequency and scale included
    bias: np.ndarray
    temperature: float


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on rows (doc_id, text, lang) that all may be learned from."""
    df, n_docs = document_frequencies(rows)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    data = [s for s in sample(rows, settings.per_language) if len(s[1])]
    languages = sorted({s[0] for s in data})
    if not languages:
        return Model([], np.zeros((SIZE, 0)), np.zeros(0), 1.0)
    number = {lang: k for k, lang in enumerate(languages)}
    examples = [(number[lang], at, n / n.sum() * idf[at] * settings.scale) for lang, at, n in data]
    train = [e for k, e in enumerate(examples) if k % settings.calibration_every or len(examples) < 2 * settings.calibration_every]
    weights, bias = ftrl(train, len(languages), settings)
    rest = [e for k, e in enumerate(examples) if k % settings.calibration_every == 0]
    logits = np.array([x @ weights[at] + bias for _, at, x in rest])
    temperature = calibrate(logits, np.array([e[0] for e in rest]))
    return Model(languages, weights * idf[:, None] * settings.scale, bias, temperature)


def ftrl(examples: list[tuple[int, np.ndarray, np.ndarray]], classes: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader, proximal form: a weight is worked out from its sums
    when an example needs it, and is zero while its sum is below ``l1``."""
    z, n = np.zeros((SIZE + 1, classes)), np.zeros((SIZE + 1, classes))

    def solved(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        l1 = np.where(at == SIZE, 0.0, s.l1)[:, None]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for label, at, x in examples:
            at, x = np.append(at, SIZE), np.append(x, 1.0)
            w = solved(at)
            p = _softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p[None, :]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha * w
            n[at] += g * g
    w = solved(np.arange(SIZE + 1))
    return w[:SIZE], w[SIZE]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden-section search
    on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return -float(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    low, high = np.log(0.05), np.log(20.0)
    ratio = (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def predict_text(text: bytes | None, model: Model) -> tuple[str, float]:
    if text is None:
        return "und", 0.0
    letters = letters_of(text)
    if not (letters != 32).any() or not model.languages:
        return "und", 0.0
    total = np.zeros(len(model.languages))
    n = 0
    for h in gram_numbers(letters):
        total += model.weights[h].sum(axis=0)
        n += len(h)
    p = _softmax((total / n + model.bias) / model.temperature)
    k = int(p.argmax())
    return model.languages[k], float(p[k])


def identify(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``df``.

    Learns from the text and language of rows whose language is not null and whose id's
    crc32 (as text) modulo 3 is 0 or 2; rows without an id are not held out, yet never
    learned from. lang_pred is "und" with score 0 if the text is null or has no letter, or
    if there was nothing to learn from; score is the calibrated probability. Ties go to
    the first language by name. Repeated rows are predicted one by one; an empty table
    gives no rows. Other columns are not looked at.
    """
    rows = learnable(df, id_col, text_col, lang_col)
    model = fit(rows.where(~F.col("held_out") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang"), settings)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def fn(b: pa.RecordBatch) -> dict:
        found = [predict_text(t, shared.value) for t in texts(b.column("text"))]
        return {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows.select("doc_id", "text", "held_out"), fn, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
