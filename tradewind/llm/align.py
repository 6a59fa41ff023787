"""Two tokenizers on the same text: where their tokens meet, and which go together.

Tokenizer A is a byte-level model of the tokenizers library, B a SentencePiece model. The
libraries' spans are the coarse cuts: character offsets of A, the proto's byte spans of B.
A cut between two characters is taken as it is; tokens that share a character, or spell it
in bytes, are cut by the bytes they decode to. What a token decodes to must be what stands
there, else the text has no tokens.

Texts are cut into words where both tokenizers begin a new token whatever stands around,
and each different word is encoded and aligned once; only the words' results are put
together. A group is a run of bytes between two places where tokens of both sides end, so
a group lies within a word.

The count of a pair of ids is how often, over all documents, two of their tokens share a
byte. Pairs are counted in each task before they are shuffled. The pairs with the highest
counts, at most ``head_pairs`` of them, go to every task; links of rarer pairs, none of
which has many, are looked up by a join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _slices, documents, map_rows, small_batches, stored, texts

HEAD_PAIRS = 1 << 18
BATCH = "8m"  # of texts
SLICE_BYTES = 1 << 20  # of texts aligned at a time
SMALL = "512k"  # of ids, each of which takes several numbers of 8 bytes
BLANK = "▁"
_ID_AND_END = attrgetter("id", "end")


class Side:
    """What both tokenizers have in common here: ids, the bytes of each id, words."""

    raw: list[bytes]
    #: Nothing around a word that a single blank or line feed sets off changes its tokens.
    cuttable: bool
    #: A comma or full stop at a word's end is no part of a token with the letter before it.
    ends: bool

    def spans(self, words: list[str], whole: bool) -> Iterator[tuple[list[int], np.ndarray]]:
        """For every word the ids and the tokens' spans in bytes, as the library has them."""
        raise NotImplementedError


class ByteLevel(Side):
    """A byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        # A task has one core; the library's threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The byte alphabet of such models: bytes that print stand for themselves, the
        # others follow from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.raw = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.raw[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.ends = True
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.cuttable = bool(plain and kind["normalizer"] is None and all(t["special"] for t in kind["added_tokens"]))

    def spans(self, words: list[str], whole: bool) -> Iterator[tuple[list[int], np.ndarray]]:
        for word, e in zip(words, self.tokenizer.encode_batch(words, add_special_tokens=False)):
            spans = np.fromiter(chain.from_iterable(e.offsets), np.int64).reshape(-1, 2)
            if not word.isascii():
                code = np.frombuffer(word.encode("utf-32-le"), "<u4")
                at = np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
                spans = np.concatenate([[0], at])[spans]
            yield e.ids, spans


class Pieces(Side):
    """A SentencePiece model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
        self.adds_blank = m.normalizer_spec.add_dummy_prefix
        m.normalizer_spec.add_dummy_prefix = False
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
        sp = self.whole
        names = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.raw = [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]
        self.ends = not any(x.isalpha() and y in ",." for p in names for x, y in zip(p, p[1:]))
        normal = m.normalizer_spec
        alone = not any(BLANK in p.lstrip(BLANK) or ("\n" in p and p != "\n") for p in names)
        self.cuttable = alone and self.adds_blank and normal.escape_whitespaces and not (normal.precompiled_charsmap or normal.remove_extra_whitespaces or m.trainer_spec.treat_whitespace_as_suffix)

    def spans(self, words: list[str], whole: bool) -> Iterator[tuple[list[int], np.ndarray]]:
        # A whole text comes with the blank that this model puts in front itself.
        model, shift = (self.whole, 1) if whole and self.adds_blank else (self.inner, 0)
        for found in model.encode([w[shift:] for w in words], return_type="proto", num_threads=1):
            tokens = np.fromiter(chain.from_iterable(map(_ID_AND_END, found.pieces)), np.int64).reshape(-1, 2)
            ends = tokens[:, 1] + shift
            # A piece begins where the one before it ends.
            yield tokens[:, 0].tolist(), np.stack([np.concatenate([[0], ends[:-1]])[: len(ends)], ends], axis=1)


def token_ends(body: bytes, ids: list[int], spans: np.ndarray, raw: list[bytes]) -> list[int] | None:
    """Where each token ends in ``body``, or None if the tokens do not spell it."""
    at, ends = 0, []
    for i, (begin, end) in zip(ids, spans.tolist()):
        piece = raw[i]
        # Tokens that share a character have one span; their own bytes divide it.
        if begin != at or end - begin != len(piece):
            end = at + len(piece)
        if body[at:end] != piece:
            return None
        ends.append(end)
        at = end
    return ends if at == len(body) else None


def grouped(a_ids: list[int], a_ends: list[int], b_ids: list[int], b_ends: list[int]) -> tuple[int, str]:
    """The number of groups, and ``a1,a2|b1;a3|b2`` for them."""
    common = set(a_ends) & set(b_ends)
    parts, i, j = [], 0, 0
    for end in sorted(common):
        a, b = [], []
        while i < len(a_ids) and a_ends[i] <= end:
            a.append(str(a_ids[i]))
            i += 1
        while j < len(b_ids) and b_ends[j] <= end:
            b.append(str(b_ids[j]))
            j += 1
        parts.append(",".join(a) + "|" + ",".join(b))
    return len(common), ";".join(parts)


# White space besides blank and line feed, and runs of both.
_OTHER = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_ASCII_OTHER = [c for c in _OTHER if c < "\x80"]
_RUNS = ("  ", "\n\n", " \n", "\n ")
_NO_SPACE = f"^ ?[^ \n{''.join(_OTHER)}]+$"
_CUTS = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


def _set_off(text: str) -> str | None:
    """``text`` with a zero character between its words, or None if a pattern has to tell them."""
    if not text or "\x00" in text or any(c in text for c in _RUNS) or any(c in text for c in (_ASCII_OTHER if text.isascii() else _OTHER)):
        return None
    return text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ").strip("\x00")


def words_of(texts: list[str]) -> tuple[pa.ListArray, np.ndarray]:
    """Texts in words, each with the blank in front of it; line feeds are words. White space
    of another kind, and runs, stay inside words. The lists, and the place of each text's."""
    marked = [_set_off(t) for t in texts]
    odd = np.fromiter((m is None for m in marked), bool, len(marked))
    plain = pc.split_pattern(pa.array([m for m in marked if m is not None], _TEXT), "\x00")
    rest = pa.array([_CUTS.split(texts[k]) if texts[k] else [] for k in np.flatnonzero(odd)], plain.type)
    place = np.where(odd, len(plain) + np.cumsum(odd), np.cumsum(~odd)) - 1
    return pa.concat_arrays([plain, rest]), place


#: a_ids and b_ids of a word, four bytes each; the number of groups; the groups.
Word = tuple[bytes, bytes, int, str]

_BINARY, _TEXT = pa.large_binary(), pa.large_string()
#: What is kept of a word; nulls if its tokens of one side do not spell it.
_KEPT = pa.schema([("word", _TEXT), ("a", _BINARY), ("b", _BINARY), ("names", _TEXT)])
LONGEST = 256  # a longer word is no word that comes again
ROOM = 160  # bytes for a word that is kept, on average


def _nothing() -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in _KEPT], schema=_KEPT)


def _kept(words: pa.Array, *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([words, *columns], schema=_KEPT)


def _gathered(batches: list[pa.RecordBatch], place: np.ndarray) -> pa.RecordBatch:
    """Rows by their places in ``batches`` laid one behind the other."""
    first = np.cumsum([0, *map(len, batches)])
    which = np.searchsorted(first, place, "right") - 1
    # Of two batches that begin at one place the first is empty.
    found = pa.concat_batches([b.take(pa.array(place[which == k] - first[k])) for k, b in enumerate(batches)])
    order = np.empty(len(place), np.int64)
    order[np.argsort(which, kind="stable")] = np.arange(len(place))
    return found.take(pa.array(order))


def _binary(data: bytes, ends: np.ndarray) -> pa.Array:
    """``data`` in values that end at ``ends``."""
    ends = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(_BINARY, len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _parts(values: pa.Array, offsets: np.ndarray) -> list[bytes]:
    """Runs of binary values, each joined."""
    _, ends, data = values.buffers()
    at = np.frombuffer(ends, np.int64)[values.offset + offsets].tolist()
    view = memoryview(data or b"")
    return [bytes(view[i:j]) for i, j in zip(at, at[1:])]


class Aligner:
    """Both tokenizers, with a bounded memory of the words they have aligned: up to
    ``remember`` new ones (or ``ROOM`` times as many bytes), and as many before them, of
    which those met again are kept."""

    def __init__(self, a_path: str, b_path: str, remember: int = 200_000) -> None:
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.cuttable = self.a.cuttable and self.b.cuttable
        self.remember = remember
        self.forget()
        self.a_sizes = np.array([len(r) for r in self.a.raw], np.int64)
        self.b_sizes = np.array([len(r) for r in self.b.raw], np.int64)
        self.a_names = np.array([str(i) for i in range(len(self.a.raw))], object)
        self.b_names = np.array([str(i) for i in range(len(self.b.raw))], object)
        self.marks = self._learn(pa.array([",", "."], _TEXT)) if self.cuttable else _nothing()

    def forget(self) -> None:
        self.known, self.earlier = _nothing(), _nothing()

    def learn(self, words: list[str], whole: bool = False) -> list[Word | None]:
        """Words, or whole texts, one by one."""
        out: list[Word | None] = []
        for word, (a_ids, a_spans), (b_ids, b_spans) in zip(words, self.a.spans(words, whole), self.b.spans(words, whole)):
            body = word.encode()
            a_ends, b_ends = token_ends(body, a_ids, a_spans, self.a.raw), token_ends(body, b_ids, b_spans, self.b.raw)
            if a_ends is None or b_ends is None:
                out.append(None)
            else:
                out.append((array("I", a_ids).tobytes(), array("I", b_ids).tobytes(), *grouped(a_ids, a_ends, b_ids, b_ends)))
        return out

    def _learn(self, words: pa.Array) -> pa.RecordBatch:
        """Different words. Those without white space but for one blank in front are learned many
        in one text: a line feed behind a word sets it off as it does in any text."""
        lines = pc.match_substring_regex(words, _NO_SPACE).to_numpy(zero_copy_only=False)
        in_lines = np.flatnonzero(lines)
        todo = [in_lines[k : k + 4000] for k in range(0, len(in_lines), 4000)]
        alone = [np.flatnonzero(~lines)]
        places, found = [], [_nothing()]
        while todo:
            some = todo.pop()
            columns = self._lines(words.take(pa.array(some)))
            if columns is not None:
                places.append(some)
                found.append(columns)
            elif len(some) > 16:  # one of them is not spelled by its tokens
                todo += [some[: len(some) // 2], some[len(some) // 2 :]]
            else:
                alone.append(some)
        rest = np.concatenate(alone)
        for first in range(0, len(rest), 4000):
            some = words.take(pa.array(rest[first : first + 4000]))
            learned = [w or (None,) * 4 for w in self.learn(some.to_pylist())]
            found.append(_kept(some, *(pa.array([w[k] for w in learned], f.type) for k, f in zip((0, 1, 3), list(_KEPT)[1:]))))
        order = np.empty(len(words), np.int64)
        order[np.concatenate([*places, rest])] = np.arange(len(words))
        return pa.concat_batches(found).take(pa.array(order))

    def _lines(self, words: pa.Array) -> pa.RecordBatch | None:
        names = words.to_pylist()
        lines = ["\n".join([*names[k : k + 200], ""]) for k in range(0, len(names), 200)]
        bodies = [x.encode() for x in lines]
        starts = np.cumsum([0, *map(len, bodies)])
        body = b"".join(bodies)
        sides = []
        for side, sizes in ((self.a, self.a_sizes), (self.b, self.b_sizes)):
            found = list(side.spans(lines, False))
            ids = list(chain.from_iterable([f[0] for f in found]))
            if b"".join([side.raw[i] for i in ids]) != body:
                return None
            ids = np.array(ids, np.int64)
            spans = np.concatenate([f[1] + start for f, start in zip(found, starts)])
            decoded = np.cumsum(sizes[ids])
            own = (spans[:, 0] == decoded - sizes[ids]) & (spans[:, 1] == decoded)
            # Tokens that share a character have one span; their own bytes divide it.
            sides.append((ids, np.where(own, spans[:, 1], decoded)))
        lengths = pc.binary_length(words).to_numpy()
        last = np.cumsum(lengths + 1) - 1  # where the line feed behind a word stands
        (a, a_ends), (b, b_ends) = sides
        # For every byte, whether a token of A, or of B, or a line feed ends there.
        at_a, at_b, at_feed = (np.zeros(len(body) + 1, bool) for _ in range(3))
        at_a[a_ends] = at_b[b_ends] = at_feed[last + 1] = True
        both = at_a & at_b
        if not (both[last].all() and both[last + 1].all()):
            return None
        in_a, in_b = ~at_feed[a_ends], ~at_feed[b_ends]
        a, a_ends, b, b_ends = a[in_a], a_ends[in_a], b[in_b], b_ends[in_b]
        common = np.flatnonzero(both & ~at_feed)
        groups = np.concatenate([np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)])
        from_b = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * groups + from_b, kind="stable")
        group, side = groups[order], from_b[order]
        word = np.searchsorted(last, common)  # of each group
        # What stands behind a token: it goes on, B follows, a group follows, a word follows.
        marks = np.array([",", "|", ";", "\n"], object)
        kind = np.where(np.diff(group) == 0, np.diff(side), 2 + (np.diff(word[group]) > 0))
        written = np.empty(2 * len(order), object)
        written[::2] = np.concatenate([self.a_names[a], self.b_names[b]])[order]
        written[1:-1:2] = marks[kind]
        written[-1] = ""
        groups_of = pc.split_pattern(pa.array(["".join(written.tolist())], _TEXT), "\n").flatten()
        sides = (_binary(x.astype("<u4").tobytes(), 4 * np.searchsorted(ends, last, "right")) for x, ends in ((a, a_ends), (b, b_ends)))
        return _kept(words, *sides, groups_of)

    def _rows(self, words: pa.Array) -> pa.RecordBatch:
        """What is kept of different words, which are then known."""
        n, before = len(words), len(self.known)
        last = pc.binary_slice(words.cast(_BINARY), -1)
        # A comma or full stop behind a letter is a token of its own for both; what stands
        # before it is looked up with the words.
        ended = np.flatnonzero(pc.is_in(last, pa.array([b",", b"."], _BINARY))) if self.a.ends and self.b.ends else np.zeros(0, np.int64)
        ended = ended[pc.match_substring_regex(words.take(pa.array(ended)), r"\pL[,.]$").to_numpy(zero_copy_only=False)]
        asked = pa.concat_arrays([words, pc.utf8_slice_codeunits(words.take(pa.array(ended)), 0, -1)])
        held = pa.chunked_array([self.known.column("word"), self.earlier.column("word")])
        place = pc.index_in(asked, held).fill_null(-1).to_numpy().astype(np.int64)
        by_end = np.flatnonzero(place[ended] < 0)
        new = place < 0
        new[ended] = False
        new[n:] = False
        new[n + by_end] = place[n + by_end] < 0
        todo = asked.filter(pa.array(new)).dictionary_encode()
        place[new] = len(held) + todo.indices.to_numpy()
        batches = [self.known, self.earlier, self._learn(todo.dictionary)]
        ended = ended[by_end]
        x = _gathered(batches, place[n + by_end])
        y = self.marks.take(pc.equal(last.take(pa.array(ended)), b".").cast(pa.int8()))
        joined = [pc.binary_join_element_wise(x.column(k), y.column(k), pa.scalar(z, _KEPT.field(k).type)) for k, z in (("a", b""), ("b", b""), ("names", ";"))]
        place[ended] = sum(map(len, batches)) + np.arange(len(ended))
        found = _gathered([*batches, _kept(words.take(pa.array(ended)), *joined)], place[:n])
        short = pc.less_equal(pc.utf8_length(words), LONGEST).to_numpy(zero_copy_only=False)
        added = found.filter(pa.array((place[:n] >= before) & short))
        self.known = pa.concat_batches([self.known, added])
        return found

    def align(self, batch: list[str]) -> list[Word | None]:
        """Every text with a blank in front: ids, number of groups, and the groups."""
        if not self.cuttable:
            different = list({f" {t}" for t in batch if t})
            found = dict(zip(different, self.learn(different, whole=True)))
            return [found[f" {t}"] if t else (b"", b"", 0, "") for t in batch]
        if len(self.known) > self.remember or self.known.nbytes > ROOM * self.remember:
            self.known, self.earlier = _nothing(), self.known
        lists, place = words_of([f" {t}" if t else "" for t in batch])
        words = lists.flatten().dictionary_encode()
        rows = self._rows(words.dictionary)
        offsets = lists.offsets.to_numpy()
        a, b, names = (rows.column(k).take(words.indices) for k in ("a", "b", "names"))
        # Null if one of its words is.
        names = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, names), pa.scalar(";", _TEXT)).to_pylist()
        out = [None if g is None else (x, y, g.count(";") + 1 if g else 0, g) for x, y, g in zip(_parts(a, offsets), _parts(b, offsets), names)]
        return [out[k] for k in place.tolist()]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner a Python worker."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


@dataclass(frozen=True)
class Aligned:
    """Documents in tokens of both sides, as a written table: row (a number of its own),
    doc_id, a_ids, b_ids, n_groups, groups_sha256."""

    table: DataFrame
    a_path: str
    b_path: str


def _lists(found: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(f) // 4 for f in found]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))


def align(df: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> Aligned:
    """Both tokenizations of every text, with a blank in front.

    Null and empty texts, and texts whose tokens of one side do not spell them, have no
    tokens. Strings of special tokens are plain text. Every row of ``df`` is a row of the
    result, whatever its id; other columns are not looked at.
    """
    docs = documents(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id())

    def fn(b: pa.RecordBatch) -> dict:
        found = aligner(a_path, b_path).align([(t or b"").decode("utf-8", "replace") for t in texts(b.column("text"))])
        kept = [f or (b"", b"", 0, "") for f in found]
        return {
            "row": b.column("row"),
            "doc_id": b.column("doc_id"),
            "a_ids": _lists([k[0] for k in kept]),
            "b_ids": _lists([k[1] for k in kept]),
            "n_groups": [k[2] for k in kept],
            "groups_sha256": [hashlib.sha256(k[3].encode()).hexdigest() if k[2] else "" for k in kept],
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"row bigint, doc_id {kind}, a_ids array<int>, b_ids array<int>, n_groups bigint, groups_sha256 string"
    made = map_rows(docs, fn, ddl, slice_bytes=SLICE_BYTES)
    with small_batches(df.sparkSession, BATCH):
        return Aligned(stored(made, "aligned"), a_path, b_path)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists, and the place after each list's last one."""
    first = column.offsets[0].as_py()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values, column.offsets.to_numpy()[1:].astype(np.int64) - first


def links(batch: pa.RecordBatch, both: Aligner) -> tuple[np.ndarray, np.ndarray]:
    """The pair of ids (A's in the upper half) of every link of the batch, in the order of
    the text, and the place after each document's last link.

    Two tokens that share bytes share one run of them, which ends where either ends. So the
    different ends of tokens are the links.
    """
    a, a_last = _flat(batch.column("a_ids"))
    b, b_last = _flat(batch.column("b_ids"))
    a_ends, b_ends = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b])
    ends = np.concatenate([a_ends, b_ends])
    order = np.argsort(ends, kind="stable")
    ends = ends[order]
    first = np.flatnonzero(np.diff(ends, prepend=0) > 0)
    ends = ends[first]
    # As many of A's tokens end before a link as stand before the one it belongs to.
    from_a = np.cumsum(order < len(a))
    a_before = np.where(first > 0, from_a[first - 1], 0)
    pairs = a[a_before] << 32 | b[first - a_before]
    bytes_so_far = np.concatenate([[0], a_ends])[a_last]
    return pairs, np.searchsorted(ends, bytes_so_far, "right")


def pair_counts(aligned: Aligned, at_once: int = 1 << 18) -> DataFrame:
    """pair, n: how many links hold each pair of ids linked. Counted in the tasks first,
    ``at_once`` different pairs at a time."""
    a_path, b_path = aligned.a_path, aligned.b_path
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        both.forget()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pairs, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return pairs, np.bincount(place, np.concatenate([h[1] for h in held]), len(pairs)).astype(np.int64)

        for b in _slices(batches):
            held.append(np.unique(links(b, both)[0], return_counts=True))
            size += len(held[-1][0])
            if size > at_once:
                held = [merged()]
                size = len(held[0][0])
                if size > at_once // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], schema=schema)

    found = aligned.table.select("a_ids", "b_ids").mapInArrow(run, "pair bigint, n bigint")
    return found.groupBy("pair").agg(F.sum("n").alias("n"))


def ranked(counts: DataFrame) -> DataFrame:
    """pair, n, best: whether no other pair of the same B id has a higher count."""
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b_id")
    top = counts.groupBy(b_id).agg(F.max("n").alias("top"))
    return counts.withColumn("b_id", b_id).join(top, "b_id").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _least(pairs: DataFrame, head_pairs: int) -> int:
    """The smallest power of two that at most ``head_pairs`` counts reach."""
    sizes = pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("c")).collect()  # 64 rows at most
    total, least = 0, 1 << 63
    for k, c in sorted(((r["k"], r["c"]) for r in sizes), reverse=True):
        total += c
        if total > head_pairs:
            break
        least = 1 << k
    return least


def score(aligned: Aligned, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """For every row of ``aligned``: doc_id, n_a, n_b, n_groups, n_links, n_best (links
    whose pair's count is the highest of its B id), count_sum (of the links' pairs),
    groups_sha256.

    ``head_pairs`` bounds what every task gets (17 bytes a pair); it changes no result.
    """
    a_path, b_path = aligned.a_path, aligned.b_path
    spark = aligned.table.sparkSession
    with small_batches(spark, SMALL):
        counts = stored(pair_counts(aligned), "pair-counts")
    pairs = stored(ranked(counts), "pairs")
    # Powers of two as text: the largest is beyond a long.
    frequent = F.col("n") >= F.lit(str(_least(pairs, head_pairs))).cast("decimal(20,0)")
    head = pairs.where(frequent).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast((head.column("pair").to_numpy(), head.column("n").to_numpy(), head.column("best").to_numpy().astype(np.int64)))

    def fn(b: pa.RecordBatch) -> dict:
        both = aligner(a_path, b_path)
        both.forget()  # words are of no use here
        found, last = links(b, both)
        known, counts, best = shared.value
        different, place = np.unique(found, return_inverse=True)
        at = np.minimum(np.searchsorted(known, different), max(0, len(known) - 1))
        hit = known[at] == different if len(known) else np.zeros(len(different), bool)
        first = np.concatenate([[0], last[:-1]]) if len(last) else last

        def per_row(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values[place])])
            return total[last] - total[first]

        rare = ~hit[place]
        rest = np.concatenate([[0], np.cumsum(rare)])[np.concatenate([[0], last])]
        return {
            "row": b.column("row"),
            "doc_id": b.column("doc_id"),
            "n_a": pc.list_value_length(b.column("a_ids")),
            "n_b": pc.list_value_length(b.column("b_ids")),
            "n_groups": b.column("n_groups"),
            "n_links": last - first,
            "head_best": per_row(np.where(hit, best[at] if len(known) else 0, 0)),
            "head_sum": per_row(np.where(hit, counts[at] if len(known) else 0, 0)),
            "rest": pa.ListArray.from_arrays(pa.array(rest.astype(np.int32)), pa.array(found[rare])),
            "groups_sha256": b.column("groups_sha256"),
        }

    kind = aligned.table.schema["doc_id"].dataType.simpleString()
    ddl = f"row bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, head_best bigint, head_sum bigint, rest array<bigint>, groups_sha256 string"
    with small_batches(spark, SMALL):
        rows = stored(map_rows(aligned.table, fn, ddl), "aligned-scores")
    rare = rows.select("row", F.explode("rest").alias("pair")).groupBy("row", "pair").agg(F.count(F.lit(1)).alias("k"))
    looked_up = rare.join(pairs.where(~frequent), "pair")
    rest = looked_up.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("rest_best"), F.sum(F.col("k") * F.col("n")).alias("rest_sum"))
    out = rows.drop("rest").join(rest, "row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("head_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
        (F.col("head_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def spans(aligned: Aligned) -> DataFrame:
    """Every group as a row: doc_id, start, end (bytes of the text with a blank in front),
    a_ids, b_ids."""
    a_path, b_path = aligned.a_path, aligned.b_path

    def fn(b: pa.RecordBatch) -> dict:
        both = aligner(a_path, b_path)
        out: dict[str, list] = {"doc_id": [], "start": [], "end": [], "a_ids": [], "b_ids": []}
        for doc_id, a, c in zip(b.column("doc_id").to_pylist(), b.column("a_ids"), b.column("b_ids")):
            a, c = a.values.to_numpy().astype(np.int64), c.values.to_numpy().astype(np.int64)
            a_ends, b_ends = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[c])
            ends = np.intersect1d(a_ends, b_ends)
            starts = [0, *ends[:-1].tolist()]
            a_parts = np.split(a, np.searchsorted(a_ends, ends, "right")[:-1]) if len(ends) else []
            b_parts = np.split(c, np.searchsorted(b_ends, ends, "right")[:-1]) if len(ends) else []
            for s, e, x, y in zip(starts, ends.tolist(), a_parts, b_parts):
                for name, value in zip(out, (doc_id, s, e, x, y)):
                    out[name].append(value)
        return out

    kind = aligned.table.schema["doc_id"].dataType.simpleString()
    return map_rows(aligned.table, fn, f"doc_id {kind}, start bigint, end bigint, a_ids array<int>, b_ids array<int>")
