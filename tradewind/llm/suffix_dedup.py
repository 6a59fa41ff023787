"""Suffix-array dedup of long repeated byte strings, block by block with a difference cover.

A byte goes if it lies in a string of ``length`` bytes (200) that starts anywhere else
too. Only the first 200 bytes of a suffix matter here, so suffixes are ordered by names
(fingerprints) of their first bytes, and a tie is two suffixes of one name.

The cover. Positions whose remainder modulo 133 is in a difference cover of 12 remainders
are the sample. Any two positions have a shift below 133 that takes both into the sample,
so two equal strings of 200 bytes hold equal 68-byte strings that start at sample
positions. Steps, each over every block of documents:

1. Rank the sample: the 68-byte names of sample positions are dealt into buckets by name
   and sorted there, one bucket at a time. A name that is there once has a rank of its
   own; suffixes without a shared rank within reach cannot repeat and are dropped.
2. Long ties: samples of one rank are compared by the names of the 332 bytes around them,
   which hold every string of 200 bytes that has the sample in it. Samples with equal
   surroundings settle all those strings at once: they repeat. One of them goes on to the
   next step for all. The others of the rank go on as far as the names of the 134 bytes
   up to the sample's end, or from its start, are shared: every string of 200 bytes holds
   one of the two.
3. The suffixes that go on (those around the beginnings and ends of repeats) are sorted by
   the names of their 200 bytes, again one bucket at a time.

What travels is, for each block and bucket, the sorted different names (a name a third of
all documents share is sent once a block) and a few bits a name back. A block's bits come
back to it by a join on the block number; the blocks are a table bucketed by that number,
so their texts are written once and never shuffled. A bucket is sized by bytes, so memory
does not grow with the input.

Names that decide are 64-bit fingerprints, and the bucket comes from another one, which
adds as many bits as the buckets' number has. Names that only pass suffixes on are shorter;
a false tie among them costs work and changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from ..session import workspace
from .common import documents, schema_of, stored, texts

LENGTH = 200
# A difference cover modulo 133 (every remainder is a difference of two).
PERIOD = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)

BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20

_PAD = 0xFF  # never in UTF-8, so a string that runs over an end equals none that doesn't
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Block:
    """The documents of a block, one after the other with room between them."""

    def __init__(self, sizes: np.ndarray, text: bytes, length: int) -> None:
        self.length, self.reach = length, PERIOD - 1
        self.name_bytes = length - self.reach  # of a sample
        self.sizes = sizes
        room = length + 8
        self.starts = room + np.concatenate([[0], np.cumsum(sizes + room)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
        data = np.full(int(sizes.sum()) + room * (len(sizes) + 1), _PAD, np.uint8)
        source = np.frombuffer(text, np.uint8)
        ends = np.cumsum(sizes)
        for at, size, end in zip(self.starts, sizes, ends):
            data[at : at + size] = source[end - size : end]
        self.data = data
        self.words = np.ndarray(len(data) - 7, dtype="<u8", buffer=data.data, strides=(1,))

    def samples(self) -> np.ndarray:
        """Sample positions whose name lies in their document, in order."""
        cover = np.array(COVER)
        n = np.maximum(self.sizes - self.length, -1)  # documents too short for a repeat have none
        n = np.where(n >= 0, self.sizes - self.name_bytes + 1, 0)
        most = int(n.max(initial=0))
        pattern = (np.arange(-(-most // PERIOD))[:, None] * PERIOD + cover[None, :]).ravel()
        counts = np.searchsorted(pattern, n)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(self.starts, counts) + pattern[within]

    def names(self, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Two fingerprints of the ``size`` bytes at each place."""
        one = np.full(len(places), size, np.uint64)
        two = ~one
        for first in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
            w = self.words[places + first]
            one = (one ^ w) * _M1
            one ^= one >> np.uint64(32)
            two = (two + w) * _M2
            two ^= two >> np.uint64(29)
        return one, two

    def covered(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A flag for each byte: in some range [first, last)."""
        edge = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edge, first, 1)
        np.subtract.at(edge, last, 1)
        return np.cumsum(edge[:-1]) > 0

    def suffixes(self) -> np.ndarray:
        """A flag for each byte: a string of full length starts there in a document."""
        long = self.sizes >= self.length
        return self.covered(self.starts[long], self.starts[long] + self.sizes[long] - self.length + 1)


class Ranking:
    """One sorting: the records a block sends and what the answers say of its places.

    Places with one ``key`` are one record; ``columns`` are (values, bytes) that make it
    up, the low bytes of each.
    """

    def __init__(self, key: np.ndarray, where: np.ndarray, columns: list[tuple[np.ndarray, int]], buckets: int) -> None:
        _, first, self.inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        bucket = ((where[first] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        self.order = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.order].astype(np.int64)
        self.local = (counts > 1)[self.order]
        rows = first[self.order]
        self.raw = np.concatenate([c[rows].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n] for c, n in columns], axis=1)

    def _slices(self) -> list[tuple[int, int]]:
        cut = np.flatnonzero(np.diff(self.bucket)) + 1
        return [(int(lo), int(hi)) for lo, hi in zip([0, *cut], [*cut, len(self.bucket)]) if hi > lo]

    def messages(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(bucket, records, bits of records that the block itself has twice)."""
        for lo, hi in self._slices():
            yield int(self.bucket[lo]), np.ascontiguousarray(self.raw[lo:hi]).tobytes(), np.packbits(self.local[lo:hi]).tobytes()

    def answers(self, bits: list[dict], n: int) -> list[np.ndarray]:
        """The ``n`` flags of every place, from the buckets' answers."""
        of = {a["bucket"]: a["bits"] for a in bits or ()}
        flags = np.zeros((n, len(self.order)), bool)
        for lo, hi in self._slices():
            packed = np.frombuffer(of[int(self.bucket[lo])], np.uint8).reshape(n, -1)
            flags[:, lo:hi] = np.unpackbits(packed, axis=1, count=hi - lo).astype(bool)
        by_key = np.zeros_like(flags)
        by_key[:, self.order] = flags
        return [f[self.inverse] for f in by_key]


class Sorting:
    """The three sortings of a block, as far as the answers at hand go."""

    def __init__(self, block: Block, buckets: int, answers: list[list[dict]]) -> None:
        b, reach = block, block.reach
        size, half = b.name_bytes, reach // 2
        self.repeats: np.ndarray | None = None
        samples = b.samples()
        name, where = b.names(samples, size)
        self.now = Ranking(name, where, [(name, 4)], buckets)
        if len(answers) < 1:
            return
        (shared,) = self.now.answers(answers[0], 1)
        samples, name, where = samples[shared], name[shared], where[shared]
        around, _ = b.names(samples - reach, reach + b.length)
        left, _ = b.names(samples - half, half + size)
        right, _ = b.names(samples, size + reach - half)
        self.now = Ranking(around, where, [(name, 4), (around, 8), (left, 3), (right, 3)], buckets)
        if len(answers) < 2:
            return
        sure, to_left, to_right = self.now.answers(answers[1], 3)
        there = b.suffixes()
        known = b.covered(samples[sure] - reach, samples[sure] + 1) & there
        lefts, rights = samples[to_left], samples[to_right]
        open_ = b.covered(np.concatenate([lefts - reach, rights - (reach - half)]), np.concatenate([lefts - half + 1, rights + 1]))
        places = np.flatnonzero(open_ & there)
        whole, where = b.names(places, b.length)
        self.now = Ranking(whole, where, [(whole, 8)], buckets)
        if len(answers) < 3:
            return
        known[places[self.now.answers(answers[2], 1)[0]]] = True
        self.repeats = np.flatnonzero(known)


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: the key is there twice; it is the first of its kind."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice, first = np.zeros(len(keys), bool), np.ones(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    first[order[1:][same]] = False
    return twice, first


def _wide(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, : raw.shape[1]] = raw
    return out.view("<u8").ravel()


def _ties(raw: np.ndarray, local: np.ndarray) -> list[np.ndarray]:
    """Step 2 in a bucket: sure, and who goes on to the left and to the right."""
    around = _wide(raw[:, 4:12])
    twice, first = _twice(around)
    sure = twice | local
    out = [sure]
    for half in (raw[:, 12:15], raw[:, 15:18]):
        _, group, n = np.unique(_wide(np.concatenate([raw[:, :4], half], axis=1)), return_inverse=True, return_counts=True)
        unsure = np.bincount(group, ~sure, len(n)) > 0
        out.append(((n > 1) & unsure)[group] & (~sure | first))
    return out


def _sort_bucket(rows: pa.Table) -> pa.Table:
    """Sort one bucket's records, and answer every block with bits for its own."""
    width = rows.column("width")[0].as_py()
    blobs = [np.frombuffer(x, np.uint8).reshape(-1, width) for x in rows.column("records").to_pylist()]
    local = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(b)) for x, b in zip(rows.column("local").to_pylist(), blobs)]).astype(bool)
    raw = np.concatenate(blobs)
    # A name that a block has twice and no other block has is shared as well.
    flags = _ties(raw, local) if width == 18 else [_twice(_wide(raw))[0] | local]
    ends = np.cumsum([len(b) for b in blobs])
    out = [b"".join(np.packbits(f[end - len(b) : end]).tobytes() for f in flags) for b, end in zip(blobs, ends)]
    return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"), "bits": pa.array(out, pa.binary())})


def _block_rows(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[list, list[int], list[bytes]]]:
    ids: list = []
    sizes: list[int] = []
    data: list[bytes] = []
    held = 0
    for b in batches:
        for i, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
            t = t or b""
            if ids and held + len(t) > block_bytes:
                yield ids, sizes, data
                ids, sizes, data, held = [], [], [], 0
            ids.append(i)
            sizes.append(len(t))
            data.append(t)
            held += len(t)
    if ids:
        yield ids, sizes, data


def _write_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """The documents as one row a block, in a table bucketed by the block's number."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (ids, sizes, data) in enumerate(_block_rows(batches, block_bytes)):
            yield pa.RecordBatch.from_arrays([pa.array([task << 32 | k], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([sizes], pa.list_(pa.int64())), pa.array([b"".join(data)], pa.binary())], names=["block", "ids", "sizes", "data"])

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    path, name = workspace(spark, "suffix-blocks"), f"tradewind_blocks_{uuid.uuid4().hex[:12]}"
    # As many buckets as a shuffle has partitions, so that a join leaves the table alone.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.mapInArrow(pack, f"block bigint, ids array<{kind}>, sizes array<bigint>, data binary")
    packed.write.bucketBy(n, "block").option("path", path).saveAsTable(name)
    return spark.table(name)


def _answer(blocks: DataFrame, answers: list[DataFrame], length: int, buckets: int) -> DataFrame:
    """The next sorting: (block, answer) with the bits of every bucket a block sent to."""
    n = len(answers)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                now = Sorting(Block(np.array(r["sizes"], np.int64), r["data"], length), buckets, [r[f"answer{k}"] for k in range(n)]).now
                sent = list(now.messages())
                if sent:
                    yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(sent), pa.int64()), pa.array([s[0] for s in sent], pa.int64()), pa.array([now.raw.shape[1]] * len(sent), pa.int32()), pa.array([s[1] for s in sent], pa.binary()), pa.array([s[2] for s in sent], pa.binary())], names=["block", "bucket", "width", "records", "local"])

    sent = _with_answers(blocks, answers).select("block", "sizes", "data", *[f"answer{k}" for k in range(n)]).mapInArrow(send, "block bigint, bucket bigint, width int, records binary, local binary")
    bits = sent.groupBy("bucket").applyInArrow(_sort_bucket, "block bigint, bucket bigint, bits binary")
    return stored(bits, "suffix-bits")


def _with_answers(blocks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    for k, a in enumerate(answers):
        mine = a.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(f"answer{k}"))
        blocks = blocks.join(mine, "block", "left")
    return blocks


def dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end) for each row.

    ``length`` must be at least 141, so that a sample's name has eight bytes or more.
    A null text is empty; texts shorter than ``length`` lose nothing. Strings are judged
    on the input, overlaps within one document count, and matches never run from one
    document into the next. Of repeated rows all bytes in long strings go. An empty table
    gives no rows. Other columns are not looked at.
    """
    if length < PERIOD + 8:
        raise ValueError(f"length must be at least {PERIOD + 8}")
    docs = documents(df, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = _write_blocks(docs, block_bytes)
    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // bucket_bytes))
    answers: list[DataFrame] = []
    for _ in range(3):
        answers.append(_answer(blocks, answers, length, buckets))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                block = Block(np.array(r["sizes"], np.int64), r["data"], length)
                at = Sorting(block, buckets, [r[f"answer{k}"] for k in range(3)]).repeats
                gone = block.covered(at, at + length)
                edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
                first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                lo, hi = np.searchsorted(first, block.starts), np.searchsorted(first, block.starts + block.sizes)
                rows: list[tuple] = []
                for k, (start, size) in enumerate(zip(block.starts.tolist(), block.sizes.tolist())):
                    spans = list(zip((first[lo[k] : hi[k]] - start).tolist(), (last[lo[k] : hi[k]] - start).tolist()))
                    mine = block.data[start : start + size]
                    left = mine[~gone[start : start + size]] if spans else mine
                    rows.append((r["ids"][k], size, size - len(left), len(spans), hashlib.sha256(left.tobytes()).hexdigest(), [{"start": s, "end": e} for s, e in spans]))
                names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
                yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, zip(*rows), out_types)})

    ddl = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"
    out_types = [f.type for f in to_arrow_schema(schema_of(ddl))]
    return _with_answers(blocks, answers).drop("block").mapInArrow(finish, ddl)


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]])
