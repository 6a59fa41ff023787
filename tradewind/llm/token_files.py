"""Token ids as length-delimited binary records, with an offset index beside them.

A record file is a row of frames in ascending document order. A frame is

    length of the payload   8 bytes, little-endian
    masked checksum of the 8 length bytes   4 bytes
    payload
    masked checksum of the payload   4 bytes
    line feed   1 byte

and a payload is one flag byte (1: there is a document id, 2: ids take four bytes and not
two, 4: the document id is text), the id (8 bytes, signed; of a text its length, and the
text in UTF-8 behind it) and the token ids, all little-endian. The checksum is
CRC-32, masked as usual for such files: rotated right by 15 bits plus a constant, so that
checksums of data that holds checksums stay sound.

The index is a table with one row a record: file, offset and length of the frame, id,
number of tokens, and the number of tokens in all records before it. A shuffled read goes
by its offsets.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import documents, map_rows, texts

END_ID = 2
FILE_BYTES = 16 << 20  # of text a file, at least
SLICE_BYTES = 6 << 20  # of text encoded at a time
MOST_FILES = 100_000

_MASK = 0xA282EAD8  # fixed value


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(doc_id: int | str | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    name = doc_id.encode() if isinstance(doc_id, str) else b""
    number = len(name) if isinstance(doc_id, str) else doc_id or 0
    flags = (doc_id is not None) | wide << 1 | isinstance(doc_id, str) << 2
    payload = struct.pack("<Bq", flags, number) + name + ids.astype("<u4" if wide else "<u2").tobytes()
    size = struct.pack("<Q", len(payload))
    return b"".join([size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload)), b"\n"])


def read_frame(data: memoryview | bytes, at: int) -> tuple[int | str | None, np.ndarray, int]:
    """(id, token ids, offset of the next frame); raises if a checksum is wrong."""
    size = bytes(data[at : at + 8])
    (n,) = struct.unpack("<Q", size)
    payload = data[at + 12 : at + 12 + n]
    if struct.unpack_from("<I", data, at + 8)[0] != masked(size) or struct.unpack_from("<I", data, at + 12 + n)[0] != masked(payload):
        raise ValueError(f"checksum mismatch in the frame at {at}")
    flags, number = struct.unpack_from("<Bq", payload)
    first = 9 + number if flags & 4 else 9
    doc_id = bytes(payload[9:first]).decode() if flags & 4 else number if flags & 1 else None
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=first)
    return doc_id, ids.astype(np.uint32), at + 17 + n


# White space besides blank and line feed.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_ASCII_SPACE = [c for c in _OTHER_SPACE if c < "\x80"]
_RUNS = ("  ", "\n\n", " \n", "\n ")
# A word of Latin letters, which all versions of Unicode agree on; and the alphabet of
# byte-level models: bytes that print stand for themselves, the others follow from U+0100 on.
_LATIN = "^[ ]?[A-Za-zÀ-ÖØ-öø-ʯ]+$"
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_SHOWN_AS = np.array([b if b in _SHOWN else 256 + _HIDDEN.index(b) for b in range(256)], "<u4")
_SHOWN_AS[0] = 0  # no word has it: it sets words off
_ID = attrgetter("id")


def _binary(sizes: np.ndarray, data: bytes) -> pa.Array:
    """``data`` cut into values of so many bytes."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])


class Known:
    """Different pieces and the ids of each, side by side in Arrow: some 40 bytes a piece."""

    def __init__(self) -> None:
        self.pieces, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def add(self, pieces: pa.Array, ids: pa.Array) -> None:
        self.pieces, self.ids = pa.concat_arrays([self.pieces, pieces]), pa.concat_arrays([self.ids, ids])

    def __len__(self) -> int:
        return len(self.pieces)

    def __iter__(self) -> Iterator[str]:
        return iter(self.pieces.to_pylist())


class Encoder:
    """The tokenizer with a bounded memory of the pieces it has encoded: twice ``remember``
    pieces, and 16 times as many characters, beside those of the texts at hand.

    Between two characters that are not white space, a single blank or line feed is
    always the start of a new piece for this kind of tokenizer, and so is a comma or full
    stop after a letter. Texts whose white space is only that are encoded piece by piece,
    each different piece once. All other texts go to the tokenizer whole, and so do all
    texts if the file is of another kind.
    """

    def __init__(self, path: str, remember: int = 300_000, at_once: int = SLICE_BYTES) -> None:
        # A task has one core; the library's threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.remember, self.at_once = remember, at_once
        self.known, self.earlier = Known(), Known()
        self.held = 0  # characters of the known pieces
        # What the rules below rely on, and the one id of a line feed; else texts stay whole.
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        self.cuts = before.get("type") == "ByteLevel" and before.get("use_regex", False) and not before.get("add_prefix_space") and kind["normalizer"] is None
        # No added token is cut out of words of letters.
        self.plain = self.cuts and all(any(not c.isalpha() and c != " " for c in t["content"]) for t in kind["added_tokens"])
        self.model = self.tokenizer.model
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = line[0] if len(line) == 1 else None
        self.marks = pa.array([self._whole(","), self._whole(".")], pa.large_binary())

    def encode(self, batch: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; ``at_once``
        characters of texts are cut into pieces at a time."""
        first = size = 0
        for k, t in enumerate(batch):
            size += len(t)
            if size >= self.at_once:
                yield from self._encode(batch[first : k + 1])
                first, size = k + 1, 0
        yield from self._encode(batch[first:])

    def _encode(self, batch: list[str]) -> list[bytes]:
        if len(self.known) > self.remember or self.held > 16 * self.remember:
            # Of the pieces met so far, those that come again are kept for as long once more.
            self.known, self.earlier, self.held = Known(), self.known, 0
        cut = [self._cut(t) if self.cuts else None for t in batch]
        found = iter(self._by_pieces([t for t in cut if t is not None]))
        return [self._whole(t) if c is None else next(found) for t, c in zip(batch, cut)]

    def _by_pieces(self, cut: list[str]) -> list[bytes]:
        """The ids of texts whose pieces are set off; Arrow finds the different pieces, looks
        them up and puts their ids together, so that Python looks at each new one only."""
        if not cut:
            return []
        lists = pc.split_pattern(pa.array(cut, pa.large_string()), "\x00")
        pieces = lists.flatten().dictionary_encode()
        ids = self._ids(pieces.dictionary).take(pieces.indices)
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, np.int64)[lists.offsets.to_numpy()].tolist()
        view = memoryview(data or b"")
        return [bytes(view[i:j]) for i, j in zip(at, at[1:])]

    def _ids(self, pieces: pa.Array) -> pa.Array:
        """The ids of different pieces, which are then known."""
        n, before = len(pieces), len(self.known)
        last = pc.binary_slice(pieces.cast(pa.large_binary()), -1)
        ended = np.flatnonzero(pc.is_in(last, pa.array([b",", b"."], pa.large_binary())))
        ended = ended[pc.match_substring_regex(pieces.take(ended), r"\pL[,.]$").to_numpy(zero_copy_only=False)]
        # What stands before a comma or full stop is looked up with the pieces.
        asked = pa.concat_arrays([pieces, pc.utf8_slice_codeunits(pieces.take(ended), 0, -1)])
        held = pa.concat_arrays([self.known.pieces, self.earlier.pieces])
        place = pc.index_in(asked, held).fill_null(-1).to_numpy().astype(np.int64)
        by_end = np.flatnonzero(place[ended] < 0)
        new = place < 0
        new[ended] = False
        new[n:] = False
        new[n + by_end] = place[n + by_end] < 0
        todo = asked.filter(pa.array(new)).dictionary_encode()
        place[new] = len(held) + todo.indices.to_numpy()
        ids = pa.concat_arrays([self.known.ids, self.earlier.ids, self._learn(todo.dictionary)])
        # A piece that is new but for its end.
        marks = self.marks.take(pc.equal(last.take(ended[by_end]), b".").cast(pa.int8()))
        place[ended[by_end]] = len(ids) + np.arange(len(by_end))
        ids = pa.concat_arrays([ids, pc.binary_join_element_wise(ids.take(place[n + by_end]), marks, pa.scalar(b"", pa.large_binary()))])
        found = ids.take(place[:n])
        # Words met with their comma only take no place of their own.
        added = pa.array((place[:n] < 0) | (place[:n] >= before))
        self.known.add(pieces.filter(added), found.filter(added))
        self.held += pc.sum(pc.utf8_length(pieces.filter(added))).as_py() or 0
        return found

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """Encode new pieces. Latin letters, with or without a blank before them, are one word
        that the merges take as it is; other letters are encoded many in one text, as a line feed
        behind a piece sets it off, and what is not just letters by itself."""
        places, sizes, parts = [], [], []

        def learned(where: np.ndarray, n_ids: np.ndarray, ids: np.ndarray) -> None:
            places.append(where)
            sizes.append(4 * n_ids)
            parts.append(ids.tobytes())

        todo = np.arange(len(pieces))
        if self.plain:
            latin = pc.match_substring_regex(pieces, _LATIN).to_numpy(zero_copy_only=False)
            where, todo = np.flatnonzero(latin), np.flatnonzero(~latin)
            for first in range(0, len(where), 4000):
                some = where[first : first + 4000]
                text = "\x00".join(pieces.take(some).to_pylist()).encode()
                shown = _SHOWN_AS[np.frombuffer(text, np.uint8)].tobytes().decode("utf-32-le")
                words = list(map(self.model.tokenize, shown.split("\x00")))
                learned(some, np.fromiter(map(len, words), np.int64, len(words)), np.fromiter(map(_ID, chain.from_iterable(words)), np.uint32))
        names = pieces.take(todo).to_pylist()
        letters = np.fromiter((p.removeprefix(" ").isalpha() for p in names), bool, len(names))
        rest = [np.flatnonzero(~letters)]
        letters, feed = np.flatnonzero(letters), self.feed
        for first in range(0, len(letters), 4000):
            some = letters[first : first + 4000]
            lines = ["\n".join([*(names[i] for i in some[k : k + 200]), ""]) for k in range(0, len(some), 200)]
            ids = np.fromiter(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)), np.uint32)
            last = np.flatnonzero(ids == feed) if feed is not None else []
            if len(last) == len(some):
                learned(todo[some], np.diff(last, prepend=-1) - 1, np.delete(ids, last))
            else:
                rest.append(some)
        for first in range(0, len(alone := np.concatenate(rest)), 4000):
            some = alone[first : first + 4000]
            found = [e.ids for e in self.tokenizer.encode_batch_fast([names[i] for i in some], add_special_tokens=False)]
            learned(todo[some], np.fromiter(map(len, found), np.int64, len(found)), np.fromiter(chain.from_iterable(found), np.uint32))
        if not places:
            return pa.array([], pa.large_binary())
        order = np.empty(len(pieces), np.int64)
        order[np.concatenate(places)] = np.arange(len(pieces))
        return _binary(np.concatenate(sizes), b"".join(parts)).take(order)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def _cut(text: str) -> str | None:
        """The text with its pieces set off, or None if that cannot be told."""
        if not text:
            return ""
        if "<|" in text or "\x00" in text or text[0] in " \n" or text[-1] in " \n" or any(c in text for c in _RUNS) or any(c in text for c in (_ASCII_SPACE if text.isascii() else _OTHER_SPACE)):
            return None
        return text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a Python worker, whose tasks all use what it remembers."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _keyed(docs: DataFrame) -> DataFrame:
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    return docs.withColumn("doc_id", F.col("doc_id").cast("bigint" if whole else "string"))


def write_records(df: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Write the record files to ``path`` in ascending order of the id (nulls first, ties
    by the text's hash), about ``file_bytes`` of text each, or more if that were over
    ``MOST_FILES`` files. Ids that are no whole numbers are written as text."""
    docs = _keyed(documents(df, id_col, text_col))
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    files = max(1, min(MOST_FILES, -(-total // file_bytes)))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = docs.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def fn(b: pa.RecordBatch) -> dict:
        end = np.array([end_id], "<u4").tobytes()
        found = encoder(tokenizer).encode([(t or b"").decode("utf-8", "replace") for t in texts(b.column("text"))])
        # The writer adds the line feed that closes a frame.
        return {"frame": [frame(i, np.frombuffer(e + end, "<u4"))[:-1] for i, e in zip(b.column("doc_id").to_pylist(), found)]}

    # The more texts at once, the fewer pieces are looked up again.
    frames = map_rows(dealt, fn, "frame binary", slice_bytes=SLICE_BYTES)
    frames.select(F.col("frame").cast("string").alias("frame")).write.option("lineSep", "\n").text(path)


def parse_files(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Every record of the files, from their bytes alone: file_no, file, offset, length,
    doc_id, n_tokens, before (tokens before it in its file), ids (4 bytes each). ``id_type``
    is bigint or string, as the ids were written."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("file", "offset", "length", "doc_id", "n_tokens", "before", "ids")
        for b in batches:
            for file, data in zip(b.column("path").to_pylist(), b.column("content")):
                view = memoryview(data.as_buffer())
                at = before = 0
                rows: list[tuple] = []
                while at < len(view):
                    doc_id, ids, after = read_frame(view, at)
                    rows.append((file, at, after - at, doc_id, len(ids), before, ids.astype("<u4").tobytes()))
                    at, before = after, before + len(ids)
                    if len(rows) == 2000:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema=schema)

    kind = pa.string() if id_type == "string" else pa.int64()
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("doc_id", kind), ("n_tokens", pa.int64()), ("before", pa.int64()), ("ids", pa.binary())])
    records = files.mapInArrow(run, f"file string, offset bigint, length bigint, doc_id {id_type}, n_tokens bigint, before bigint, ids binary")
    return records.withColumn("file_no", F.regexp_extract("file", r"part-([0-9]+)", 1).cast("bigint"))


def write_index(spark: SparkSession, path: str, index_path: str, id_type: str = "bigint") -> DataFrame:
    """Write and return the index of the record files: file, offset, length, doc_id,
    start, n_tokens, ids_crc32. The files' totals are one row a file."""
    records = parse_files(spark, path, id_type).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    raw = f"{index_path}/records"
    records.write.parquet(raw)
    rows = spark.read.schema(records.schema).parquet(raw)
    totals = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_start"))
    out = rows.join(starts, "file_no").select("file", "offset", "length", "doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    out.write.parquet(f"{index_path}/index")
    return spark.read.schema(out.schema).parquet(f"{index_path}/index")


def read_records(spark: SparkSession, path: str, index: DataFrame, chosen: DataFrame) -> DataFrame:
    """The records of ``chosen`` (ids in doc_id), read at their offsets: doc_id, ids.

    Only files that hold one of them are parsed, and in those only their frames. Null ids are
    never chosen; an id that stands for several records gives all of them."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    wanted = index.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("file").agg(F.collect_list("offset").alias("offsets"))

    def fn(b: pa.RecordBatch) -> dict:
        found = [read_frame(c, o)[:2] for c, offsets in zip(b.column("content").to_pylist(), b.column("offsets").to_pylist()) for o in offsets]
        return {"doc_id": [f[0] for f in found], "ids": [f[1].astype(np.int64) for f in found]}

    return map_rows(files.join(wanted, "file"), fn, f"doc_id {index.schema['doc_id'].dataType.simpleString()}, ids array<bigint>")


def tokenize(df: DataFrame, path: str, tokenizer: str, **options) -> DataFrame:
    """Write ``df`` as record files to ``path``/files and their index to ``path``/index;
    return the index. A null text is an empty one: its record holds the end id alone.
    Repeated rows are records of their own; an empty table gives an empty index. Other
    columns are not looked at."""
    write_records(df, f"{path}/files", tokenizer, **options)
    kind = _keyed(documents(df, options.get("id_col", "doc_id"), options.get("text_col", "text"))).schema["doc_id"].dataType
    return write_index(df.sparkSession, f"{path}/files", f"{path}/index", kind.simpleString())
