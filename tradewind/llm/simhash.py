"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments of 22, 21 and 21 bits, each read as
a word of the perfect binary Golay code [23, 12, 7]. Every 23-bit word lies within three
bits of exactly one codeword, so decoding names one codeword index for it; the indices
of all words one bit away are its nearby indices (one to six). Two words that differ in
at most one bit always share an index: what one decodes to is a nearby index of the
other.

At most three differing bits spread over three segments in one of two ways:
(a) no segment has more than one: the fingerprints agree on an index in each segment;
(b) some segment has two or three, so of the other two one has none and the other at
    most one: they agree on one whole segment and on an index of another.
Case (a) gives keys of three indices, case (b) keys of one segment and one index; the
left side of the self-join takes nearby indices where the right side decodes, and the
other way round for the third segment of (a), so that neither side has many keys.

Fingerprints that share a key are verified by their bit distance inside the key's
bucket, which hands out a spanning forest of its links and never all pairs; buckets are
of different fingerprints, not of documents. Components are then found over the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import append, components, documents, fresh, hex_of, map_rows, stored, texts

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42

# The generator polynomial of the binary Golay code,
# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, and the three segments as (shift, bits).
GENERATOR = 0b101011100011
SEGMENTS = ((42, 22), (21, 21), (0, 21))


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The majority of the bits of all shingle hashes; zero without a word."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        return digest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    stops = (ends - 1).tolist()[shingle_words - 1 :]
    ones = np.zeros(64, np.int64)
    for first in range(0, n, 1 << 16):  # bounded memory for a very long text
        last = min(n, first + (1 << 16))
        h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[first:last], stops[first:last])), np.uint64, last - first)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def syndrome_table() -> np.ndarray:
    """The error pattern (at most three bits) for each of the 2,048 remainders."""
    from itertools import combinations

    table = np.zeros(2048, np.int64)
    for weight in range(4):
        for places in combinations(range(23), weight):
            error = sum(1 << p for p in places)
            table[_remainder_of(error)] = error
    return table


def _remainder_of(word: int) -> int:
    for shift in range(11, -1, -1):
        if word >> (shift + 11) & 1:
            word ^= GENERATOR << shift
    return word


_REMAINDER = np.array([_remainder_of(1 << p) for p in range(23)], np.int64)
_ERRORS = syndrome_table()


def _remainders(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), np.int64)
    for p in range(23):
        out ^= np.where(words >> p & 1, _REMAINDER[p], 0)
    return out


def decode(words: np.ndarray) -> np.ndarray:
    """The index of the one codeword within three bits: the upper twelve bits of it."""
    return (words ^ _ERRORS[_remainders(words)]) >> 11


def nearby(words: np.ndarray, bits: int) -> list[np.ndarray]:
    """For each word the different indices of the words at most one bit away, where only
    the lower ``bits`` bits can differ."""
    rest = _remainders(words)
    around = [(words ^ _ERRORS[rest]) >> 11]
    for p in range(bits):
        other = words ^ (1 << p)
        around.append((other ^ _ERRORS[rest ^ _REMAINDER[p]]) >> 11)
    table = np.sort(np.stack(around, axis=1), axis=1)
    return [np.unique(row) for row in table]


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, side, key) of every fingerprint; a pair within three bits shares a key on
    different sides. The key's top bits tell the kinds of keys apart."""
    words = [(fps >> np.uint64(s) & np.uint64((1 << b) - 1)).astype(np.int64) for s, b in SEGMENTS]
    own = [decode(w) for w in words]
    near = [nearby(w, b) for w, (_, b) in zip(words, SEGMENTS)]
    rows: list[np.ndarray] = []
    sides: list[np.ndarray] = []
    keys: list[np.ndarray] = []

    def put(row: np.ndarray, side: int, kind: int, key: np.ndarray) -> None:
        rows.append(row)
        sides.append(np.full(len(row), side, np.int8))
        keys.append(key | kind << 56)

    def spread(segment: int, row: np.ndarray, key: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter((len(near[segment][r]) for r in row), np.int64, len(row))
        values = np.concatenate([near[segment][r] for r in row]) if len(row) else row
        return np.repeat(row, counts), np.repeat(key, counts) | values << shift

    each = np.arange(len(fps), dtype=np.int64)
    row, key = spread(0, each, own[2].copy(), 24)
    row, key = spread(1, row, key, 12)
    put(row, 0, 0, key)
    row, key = spread(2, each, own[0] << 24 | own[1] << 12, 0)
    put(row, 1, 0, key)
    kind = 1
    for whole in range(3):
        for part in range(3):
            if part != whole:
                row, key = spread(part, each, words[whole] << 12, 0)
                put(row, 0, kind, key)
                put(each, 1, kind, words[whole] << 12 | own[part])
                kind += 1
    return np.concatenate(rows), np.concatenate(sides), np.concatenate(keys)


def forest(values: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """A spanning forest of the links between different fingerprints: each is compared
    once with those that no tree has reached yet, so memory is linear and a dense group
    ends early."""
    out: list[tuple[int, int]] = []
    left = values
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            near = np.bitwise_count(left ^ one) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                front.extend(found)
                out.extend((int(one), int(x)) for x in found)
    return out


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints of ``fps`` (column fp, all different)
    enough to connect all that are at most three bits apart."""

    def to_keys(b: pa.RecordBatch) -> dict:
        values = np.asarray(b.column("fp")).astype(np.int64)
        row, side, key = keys_of(values.view(np.uint64))
        return {"key": key, "side": side, "fp": values[row]}

    def to_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by key: only the bucket at hand is held. It may go on in the next batch.
        rest = [np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.int64)]
        for b in batches:
            now = [np.concatenate([r, np.asarray(b.column(c))]) for r, c in zip(rest, ("key", "side", "fp"))]
            last = np.searchsorted(now[0], now[0][-1], "left") if len(now[0]) else 0
            yield _bucket_links(*(x[:last] for x in now))
            rest = [x[last:] for x in now]
        yield _bucket_links(*rest)

    keyed = map_rows(fps.select("fp"), to_keys, "key bigint, side byte, fp bigint")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(to_links, "a bigint, b bigint").distinct()


def _bucket_links(key: np.ndarray, side: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    out: list[tuple[int, int]] = []
    if len(key):
        cut = np.flatnonzero(np.diff(key)) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut, [len(key)]])
        rights = np.concatenate([[0], np.cumsum(side)])
        n_right = rights[last] - rights[first]
        mixed = (n_right > 0) & (n_right < last - first)
        # Most buckets are one fingerprint on both sides.
        two = np.flatnonzero(mixed & (np.maximum.reduceat(fp, first) != np.minimum.reduceat(fp, first)))
        unsigned = fp.view(np.uint64)
        for k in two:
            out.extend(forest(np.unique(unsigned[first[k] : last[k]])))
    pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
    low, high = pairs.min(axis=1, initial=2**63 - 1), pairs.max(axis=1, initial=-(2**63))
    return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["a", "b"])


def fingerprints(df: DataFrame, text_col: str, name: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with the fingerprint of the text as a long ``name``."""

    def fn(b: pa.RecordBatch) -> dict:
        return {name: np.array([fingerprint(t, shingle_words) for t in texts(b.column(text_col))], np.uint64).view(np.int64)}

    return append(df, fn, f"{name} bigint")


def groups(rows: DataFrame, fp: str = "fp") -> DataFrame:
    """(fp, class): each different fingerprint with the one that names its component."""
    different = stored(rows.select(F.col(fp).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "fps")
    found = components(links(different)).select(F.col("node").alias("fp"), "root")
    return different.join(found, "fp", "left").select("fp", "n", F.coalesce("root", "fp").alias("class"))


def near_dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and n_group for each row.

    Fingerprints at most three bits apart link; component_id is the smallest doc_id
    reachable, n_group the rows of the component. Null, empty and blank texts all have
    fingerprint zero and link like any other; repeated rows are a group. A component
    whose rows all lack a doc_id has a null component_id. An empty table gives no rows.
    Other columns are not looked at.
    """
    docs = documents(df, id_col, text_col)
    marked = stored(fingerprints(docs, "text", "fp", shingle_words).select("doc_id", "fp"), "simhash")
    classes = _named(marked, "doc_id", "fp")

    def to_hex(b: pa.RecordBatch) -> dict:
        return {"fingerprint": hex_of(np.asarray(b.column("fp")).astype(np.int64).view(np.uint64))}

    out = append(marked.join(classes, "fp", "left"), to_hex, "fingerprint string")
    return out.select("doc_id", "fingerprint", "component_id", "n_group")


def _named(marked: DataFrame, id_col: str, fp: str) -> DataFrame:
    """(fp, component_id, n_group) of every fingerprint."""
    least = marked.groupBy(F.col(fp).alias("fp")).agg(F.min(f"`{id_col}`").alias("first_id"), F.count(F.lit(1)).alias("rows"))
    classes = stored(groups(marked, fp).select("fp", "class").join(least, "fp"), "fp-classes")
    names = classes.groupBy("class").agg(F.min("first_id").alias("component_id"), F.sum("rows").alias("n_group"))
    return classes.select(F.col("fp").alias(fp), "class").join(names, "class").drop("class")


def keep_one(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component, the one with the smallest doc_id (rows without one come
    last, ties go by the text), with all its columns."""
    fp = fresh(df, "_tw_fp")
    marked = stored(fingerprints(df, text_col, fp, shingle_words), "simhash")
    classes = groups(marked, fp).select(F.col("fp").alias(fp), F.col("class").alias(f"{fp}_class"))
    order = [F.col(f"`{id_col}`").asc_nulls_last(), F.col(f"`{text_col}`").asc_nulls_last()]
    rank = f"{fp}_rank"
    # The first row of each fingerprint, cut down before any shuffle, then of each class.
    firsts = marked.withColumn(rank, F.row_number().over(Window.partitionBy(fp).orderBy(*order))).where(F.col(rank) == 1).drop(rank)
    joined = firsts.join(classes, fp)
    one = joined.withColumn(rank, F.row_number().over(Window.partitionBy(f"{fp}_class").orderBy(*order))).where(F.col(rank) == 1)
    return one.select(*[F.col(f"`{c}`") for c in df.columns])
