"""SentencePiece encoding and decoding: by merges, or by a max-plus scan.

The scores of a BPE model are merge ranks. Its encoding is what merging the best ranked
neighbours leaves, and no sum of scores tells that; it is made word by word, and a chunk of
a long text is the words that begin in it.

For other models the scores add up. A segmentation's weight is the sum of its pieces' scores; the encoding is the heaviest
segmentation of the text (blanks as U+2581, one in front). A long text is cut into chunks
anywhere. The state at a cut is how many characters of the next chunk the piece across the
cut covers, so a chunk is a matrix: from each state at its beginning to each state at its
end, the weight of the best way. Matrices are combined associatively in the max-plus
semiring, first those of a block of chunks, then the blocks of a text; that fixes the
state at every cut, and every chunk is traced back on its own.

Equal scores: the segmentation with fewer pieces wins, then the one whose pieces begin
earlier in sum, then the one whose last pieces are longer; at a cut the smaller state.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_rows, stored, texts

BLANK = "▁"
CHUNK_CHARS = 1 << 14
BLOCK_CHUNKS = 64

# Scores decide, then the number of pieces, then the sum of the places they begin at.
_UNIT = 1 << 20
_PLACES = 24
_NONE = None
# The same for words of up to so many characters, whose places add up to less than 1 << 12.
_WORD_CHARS = 64
_WORD_PLACES = 12


def _merger(path: str):  # noqa: ANN202
    """The library's encoder for a model of merges, with no blank put in front; None for
    another model, whose scores add up."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    if m.trainer_spec.model_type != pb.TrainerSpec.BPE:
        return None
    m.normalizer_spec.add_dummy_prefix = False
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


class Model:
    """Pieces and scores of a SentencePiece model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.merges = _merger(path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.bytes = [-1] * 256
        self.weights: dict[str, tuple[int, int]] = {}
        lowest = 0.0
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.bytes[int(p[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                score = sp.get_score(i)
                lowest = min(lowest, score)
                self.weights[p] = ((round(score * _UNIT) - 1) << _PLACES, i)
        # What a piece begins with, so that a search ends where no piece goes on.
        self.begins: dict[str, int | None] = {p[:k]: None for p in self.weights for k in range(1, len(p))}
        self.begins.update((p, w) for p, (w, _) in self.weights.items())
        # Fixed value: an unknown character weighs ten points less than the rarest piece.
        self.unknown = (round((lowest - 10.0) * _UNIT) - 1) << _PLACES
        self.unknown_id = sp.unk_id()
        self.longest = max(map(len, self.weights), default=1)
        inside = {c for p in self.weights if len(p) > 1 for c in p}
        self.breaks_at_blank = not any(BLANK in p.lstrip(BLANK) for p in self.weights)
        self.alone_line = "\n" not in inside
        raw = [p.replace(BLANK, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.bytes):
            if i >= 0:
                raw[i] = bytes([b])
        for i in range(len(raw)):
            if sp.is_control(i):
                raw[i] = b""
        self.raw = raw
        self.known: dict[str, bytes] = {}  # ids of words met

    @cached_property
    def trie(self) -> Trie:
        return Trie(self)

    @property
    def cuttable(self) -> bool:
        """No piece goes across the blank in front of a word, or a line feed."""
        return self.breaks_at_blank and self.alone_line

    def forget(self) -> None:
        self.known.clear()

    def word(self, unit: str) -> bytes:
        found = self.known.get(unit)
        if found is None:
            found = self.known[unit] = self.merged([unit])[0] if self.merges else _ids(segment(unit.replace(" ", BLANK), self), self)
        return found

    def merged(self, units: list[str]) -> list[bytes]:
        """The ids of every unit in the model's merge order."""
        return [array("I", ids).tobytes() for ids in self.merges.encode(units, out_type=int, num_threads=1)]

    def weight(self, piece: str) -> int:
        found = self.weights.get(piece)
        return found[0] if found else self.unknown

    def ids_of(self, piece: str) -> list[int]:
        found = self.weights.get(piece)
        if found:
            return [found[1]]
        raw = [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
        return raw if min(raw) >= 0 else [self.unknown_id]


class Trie:
    """A model's pieces as arrays, in which many words are looked up at once: a state is a
    beginning of a piece, and an open-addressed table leads from state and character to
    the next state."""

    _SPREAD = np.uint64(0x9E3779B97F4A7C15)
    _FREE = np.uint64(2**64 - 1)

    def __init__(self, model: Model) -> None:
        number = {"": 0} | {p: k for k, p in enumerate(model.begins, 1)}
        self.weight = np.zeros(len(number), np.int64)  # 0: no piece ends here
        self.id = np.full(len(number), -1, np.int64)
        # The model's weights without a common factor, which only has to exceed a word's
        # number of pieces; sums of them then fit in 64 bits. State 0 is an unknown character.
        scores = [(w >> _PLACES) + 1 for w, _ in model.weights.values()] + [(model.unknown >> _PLACES) + 1]
        factor = math.gcd(*scores) or 1
        scale = min(factor, 2 * _WORD_CHARS)
        at = [*map(number.get, model.weights), 0]
        self.weight[at] = [(s // factor * scale - 1) << _WORD_PLACES for s in scores]
        self.id[at[:-1]] = [i for _, i in model.weights.values()]
        self.word_chars = min(_WORD_CHARS, (1 << 62) // -int(self.weight.min()))
        keys = np.array([number[p[:-1]] << 21 | ord(p[-1]) for p in model.begins], np.uint64)
        bits = (8 * len(number)).bit_length()
        self.shift = np.uint64(64 - bits)
        self.last = np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, self._FREE)
        self.next = np.zeros(1 << bits, np.int32)
        left, at = np.arange(len(keys)), (keys * self._SPREAD) >> self.shift
        while left.size:
            free = self.keys[at[left]] == self._FREE
            _, first = np.unique(at[left][free], return_index=True)
            put = left[free][first]
            self.keys[at[put]], self.next[at[put]] = keys[put], put + 1
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + np.uint64(1)) & self.last

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The states after one more character; 0 where no piece goes on."""
        key = state.astype(np.uint64) << np.uint64(21) | char
        at = (key * self._SPREAD) >> self.shift
        out = np.zeros(len(key), np.int32)
        left = np.arange(len(key))
        while left.size:
            found = self.keys[at]
            same = found == key
            out[left[same]] = self.next[at[same]]
            on = np.flatnonzero(~same & (found != self._FREE))
            left, key, at = left[on], key[on], (at[on] + np.uint64(1)) & self.last
        return out


def segment_words(words: list[str], model: Model) -> list[bytes]:
    """The ids of every word, as ``segment`` finds them, for all words in the same steps."""
    trie = model.trie
    size = np.fromiter(map(len, words), np.int64, len(words))
    chars = np.frombuffer("".join(words).replace(" ", BLANK).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum(size)
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(chars)) - (ends - size)[word]

    # Every piece that begins at a character, all characters a step further at a time.
    begin, state = np.arange(len(chars)), np.zeros(len(chars), np.int32)
    froms, lengths, states = [], [], []
    for k in range(1, model.longest + 1):
        state = trie.step(state, chars[begin + k - 1])
        ok = trie.weight[state] != 0 if k == 1 else (state > 0) & (trie.weight[state] != 0)
        if k == 1:  # a character that is no piece stands for itself, as state 0
            froms.append(begin)
            states.append(np.where(ok, state, 0))
        else:
            froms.append(begin[ok])
            states.append(state[ok])
        lengths.append(np.full(len(froms[-1]), k, np.int64))
        on = (state > 0) & (begin + k < ends[word[begin]])
        begin, state = begin[on], state[on]
        if not begin.size:
            break
    start, length, piece = map(np.concatenate, (froms, lengths, states))

    # Ways by where they begin in their word and their length: each word at most once a group.
    group = place[start] * (model.longest + 1) + length
    order = np.argsort(group.astype(np.int16), kind="stable")
    start, length, piece, group = start[order], length[order], piece[order], group[order]
    node, weight = start + word[start], trie.weight[piece] - place[start]
    first = np.arange(len(words)) + ends - size  # a word's node before its first character
    best = np.full(len(chars) + len(words), np.iinfo(np.int64).min, np.int64)
    best[first] = 0
    back, via = np.zeros(len(best), np.int64), np.zeros(len(best), np.int32)
    cuts = np.flatnonzero(np.diff(group, prepend=-1, append=-1)).tolist()
    for a, b in zip(cuts, cuts[1:]):
        now = best[node[a:b]] + weight[a:b]
        to = node[a:b] + length[a]
        better = now > best[to]
        to = to[better]
        best[to], back[to], via[to] = now[better], length[a], piece[a:b][better]

    # All words back from their ends, a piece at a time.
    at, open_, rounds = first + size, np.arange(len(words)), []
    while (open_ := open_[at[open_] > first[open_]]).size:
        rounds.append((open_, trie.id[via[at[open_]]]))
        at[open_] -= back[at[open_]]
    count = np.zeros(len(words), np.int64)
    for which, _ in rounds:
        count[which] += 1
    until = np.cumsum(count)
    ids = np.zeros(int(count.sum()), np.int64)
    for k, (which, found) in enumerate(rounds):
        ids[until[which] - 1 - k] = found
    raw = ids.astype("<u4").tobytes()
    out = [raw[4 * a : 4 * b] for a, b in zip((until - count).tolist(), until.tolist())]
    for k in np.unique(np.repeat(np.arange(len(words)), count)[ids < 0]).tolist():  # bytes of unknown characters
        out[k] = _ids(segment(words[k].replace(" ", BLANK), model), model)
    return out


def learn(units: Iterable[str], model: Model, remember: int = 400_000) -> None:
    """Encode the words not met before; beyond ``remember`` words, older ones are forgotten
    and would be encoded again."""
    if len(model.known) > remember:
        model.forget()
    known = model.known
    if model.merges:
        new = [u for u in set(units) if u not in known]
        for k in range(0, len(new), 1 << 12):
            some = new[k : k + (1 << 12)]
            known.update(zip(some, model.merged(some)))
        return
    new = [u for u in set(units) if u not in known and 0 < len(u) <= model.trie.word_chars]
    new.sort(key=len)
    for k in range(0, len(new), 1 << 12):
        some = new[k : k + (1 << 12)]
        known.update(zip(some, segment_words(some, model)))


def segment(text: str, model: Model, entry: int = 0, exit_: int = 0, ahead: str = "", base: int = 0) -> list[str]:
    """The pieces of the heaviest segmentation of text[entry:] + ahead[:exit_]; ``base`` is
    where the text begins."""
    body = text + ahead[:exit_]
    n, size = len(body), len(text)
    # No piece may begin between the chunk's end and the state's end.
    last = size if exit_ else n
    best: list[int | None] = [_NONE] * (n + 1)
    came = [0] * (n + 1)
    best[entry] = 0
    begins, unknown = model.begins, model.unknown
    for i in range(entry, last):
        now = best[i]
        if now is None:
            continue
        now -= base + i
        j = i + 1
        found = begins.get(body[i], 0)
        if not found and (j <= last or j == n):
            # A character that is no piece stands for itself.
            w = now + unknown
            old = best[j]
            if old is None or w > old:
                best[j] = w
                came[j] = i
        while found != 0:
            if found is not None and (j <= last or j == n):
                w = now + found
                old = best[j]
                if old is None or w > old:
                    best[j] = w
                    came[j] = i
            j += 1
            if j > n:
                break
            found = begins.get(body[i:j], 0)
    out: list[str] = []
    j = n
    while j > entry:
        i = came[j]
        out.append(body[i:j])
        j = i
    return out[::-1]


def normalized(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


_UNITS = re.compile(f"\n|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+")


def _units(text: str) -> list[str]:
    """The words of a text, each with the blanks in front of it, and its line feeds."""
    if "  " in text or BLANK in text or "\x00" in text or text[:1] == " ":
        return _UNITS.findall(normalized(text))
    # The same words, quicker to cut; an empty one between two cuts has no ids.
    return f" {text}".replace("\n", "\x00\n\x00").replace(" ", "\x00 ").split("\x00") if text else []


def encode_texts(bodies: list[str], model: Model) -> list[bytes]:
    """The ids of texts of one chunk, four bytes each; every different word is a text of
    its own and encoded once."""
    if not model.cuttable:
        if model.merges:
            return model.merged([normalized(t) for t in bodies])
        return [_ids(segment(normalized(t), model), model) for t in bodies]
    cut = [_units(t) for t in bodies]
    learn(chain.from_iterable(cut), model)
    return [_known(units, model) for units in cut]


def encode_text(text: str, model: Model) -> bytes:
    return encode_texts([text], model)[0]


def _known(units: list[str], model: Model) -> bytes:
    ids = list(map(model.known.get, units))
    if None in ids:
        ids = list(map(model.word, units))
    return b"".join(ids)


def _split(text: str, model: Model) -> tuple[int, int, list[str]]:
    """Where a chunk's first and last inner word begin, and the words between; a chunk
    without two such places is (0, 0, [])."""
    places = [m.start() for m in _UNITS.finditer(text)][1:] if model.cuttable else []
    if not places:
        return 0, 0, []
    return places[0], places[-1], [text[a:b] for a, b in zip(places, places[1:])]


def trace(rows: list[tuple[str, str, int, int, int]], model: Model) -> list[bytes]:
    """The ids of chunks (text, ahead, base, entry, exit) between their two states."""
    cut = [_split(r[0], model) for r in rows]
    learn(chain.from_iterable(units for _, _, units in cut), model)
    out = []
    for (text, ahead, base, entry, exit_), (first, last, units) in zip(rows, cut):
        if not first:
            out.append(_ids(segment(text, model, entry, exit_, ahead, base), model))
            continue
        head, tail = segment(text[:first], model, entry, 0, "", base), segment(text[last:], model, 0, exit_, ahead, base + last)
        out.append(b"".join([_ids(head, model), _known(units, model), _ids(tail, model)]))
    return out


def _ids(pieces: list[str], model: Model) -> bytes:
    weights = model.weights
    try:
        return array("I", [weights[p][1] for p in pieces]).tobytes()
    except KeyError:
        return array("I", [i for p in pieces for i in model.ids_of(p)]).tobytes()


Matrix = list[list[int | None]]


def transfer(text: str, ahead: str, base: int, model: Model) -> Matrix:
    """A chunk's matrix; ``ahead`` is the text after it, as far as a piece can reach. All
    ways meet where a word begins, so only the ends of the chunk have several. The words
    between weigh the same on every way; they are left out, as only differences count."""
    first, last, _ = _split(text, model)
    if not first:
        return _transfer(text, ahead, base, model)
    head = [row[0] for row in _transfer(text[:first], "", base, model)]
    tail = _transfer(text[last:], ahead, base + last, model)[0]
    return [[_NONE if h is None or t is None else h + t for t in tail] for h in head]


def _transfer(text: str, ahead: str, base: int, model: Model) -> Matrix:
    states = model.longest
    size = len(text)
    body = text + ahead
    out: Matrix = []
    tails: dict[int, list[int | None]] = {}
    get, alone = model.begins.get, model.weights

    def ends(i: int) -> Iterator[tuple[int, int]]:
        if body[i] not in alone:
            yield i + 1, model.unknown - base - i
        for j in range(i + 1, min(len(body), i + states) + 1):
            found = get(body[i:j], 0)
            if found == 0:
                return
            if found is not None:
                yield j, found - base - i

    # Backward over the chunk: the best way from a character to each state at its end.
    for i in range(size - 1, -1, -1):
        row: list[int | None] = [_NONE] * states
        for j, w in ends(i):
            if j >= size:
                if j - size < states and (row[j - size] is None or w > row[j - size]):
                    row[j - size] = w
            else:
                for t, rest in enumerate(tails[j]):
                    if rest is not None and (row[t] is None or w + rest > row[t]):
                        row[t] = w + rest
        tails[i] = row
        tails.pop(i + states, None) if i >= states else None
    for s in range(states):
        if s < size:
            out.append(tails[s] if s in tails else [_NONE] * states)
        else:
            # A piece over the whole chunk: it ends s - size characters into the next.
            out.append([0 if t == s - size else _NONE for t in range(states)])
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    """Max-plus: the best way through both."""
    n = len(a)
    out: Matrix = [[_NONE] * n for _ in range(n)]
    for s in range(n):
        row = out[s]
        for m, w in enumerate(a[s]):
            if w is None:
                continue
            for t, v in enumerate(b[m]):
                if v is not None and (row[t] is None or w + v > row[t]):
                    row[t] = w + v
    return out


def states_at_cuts(matrices: list[Matrix], entry: int, exit_: int) -> list[int]:
    """The state at every cut, both ends included, of the best way from ``entry`` to
    ``exit_``; of equal ways the one with the smaller state, from the end."""
    n = len(matrices[0])
    forward: list[list[int | None]] = [[0 if s == entry else _NONE for s in range(n)]]
    for m in matrices:
        last = forward[-1]
        row: list[int | None] = [_NONE] * n
        for s, w in enumerate(last):
            if w is not None:
                for t, v in enumerate(m[s]):
                    if v is not None and (row[t] is None or w + v > row[t]):
                        row[t] = w + v
        forward.append(row)
    out = [exit_]
    for k in range(len(matrices) - 1, -1, -1):
        t = out[-1]
        ways = [(forward[k][s] + matrices[k][s][t], -s) for s in range(n) if forward[k][s] is not None and matrices[k][s][t] is not None]
        out.append(-max(ways)[1])
    return out[::-1]


_models: dict[str, Model] = {}


def model_at(path: str) -> Model:
    """One model a Python worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _pack(m: Matrix) -> list[str]:
    return ["" if w is None else str(w) for row in m for w in row]


def _unpack(flat: list[str]) -> Matrix:
    n = int(len(flat) ** 0.5 + 0.5)
    return [[int(w) if w else _NONE for w in flat[k * n : (k + 1) * n]] for k in range(n)]


@dataclass(frozen=True)
class Cutting:
    chunk_chars: int = CHUNK_CHARS
    block_chunks: int = BLOCK_CHUNKS


def _chunks(long: DataFrame, path: str, cut: Cutting) -> DataFrame:
    """(row, chunk, block, base, text, ahead) of every chunk of the long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        schema = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("block", pa.int64()), ("base", pa.int64()), ("text", pa.string()), ("ahead", pa.string())])
        for b in batches:
            for r, t in zip(b.column("row").to_pylist(), texts(b.column("text"))):
                body = normalized(t.decode("utf-8", "replace"))
                for k, at in enumerate(range(0, len(body), cut.chunk_chars)):
                    end = at + cut.chunk_chars
                    yield pa.RecordBatch.from_pydict({"row": [r], "chunk": [k], "block": [k // cut.block_chunks], "base": [at], "text": [body[at:end]], "ahead": [body[end : end + model.longest - 1]]}, schema=schema)

    return long.select("row", "text").mapInArrow(run, "row bigint, chunk bigint, block bigint, base bigint, text string, ahead string")


def _word_chunks(long: DataFrame, path: str, cut: Cutting) -> DataFrame:
    """(row, chunk, units) of every chunk of the long texts: the words that begin in it. A
    word is never cut, as merges at its end may hang on its beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        schema = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("units", pa.string())])
        for b in batches:
            for r, t in zip(b.column("row").to_pylist(), texts(b.column("text"))):
                body = normalized(t.decode("utf-8", "replace"))
                end, chunk, first, at = cut.chunk_chars, 0, 0, 0
                begins = (m.start() for m in _UNITS.finditer(body)) if model.cuttable else iter((0,))
                for at in chain(begins, (len(body),)):
                    while at >= end or at == len(body) and chunk * cut.chunk_chars < at:
                        yield pa.RecordBatch.from_pydict({"row": [r], "chunk": [chunk], "units": [body[first:at]]}, schema=schema)
                        first, chunk, end = at, chunk + 1, end + cut.chunk_chars

    return long.select("row", "text").mapInArrow(run, "row bigint, chunk bigint, units string")


def _merged(long: DataFrame, path: str, cut: Cutting) -> DataFrame:
    """(row, chunk, ids) of every chunk of the long texts in the model's merge order."""

    def fn(b: pa.RecordBatch) -> dict:
        model = model_at(path)
        bodies = b.column("units").to_pylist()
        if not model.cuttable:
            found = model.merged(bodies)
        else:
            units = [_UNITS.findall(t) for t in bodies]
            learn(chain.from_iterable(units), model)
            found = [_known(u, model) for u in units]
        return {"row": b.column("row"), "chunk": b.column("chunk"), "ids": _lists(found)}

    return map_rows(_word_chunks(long, path, cut).repartition("row", "chunk"), fn, "row bigint, chunk bigint, ids array<int>", lambda: model_at(path).forget())


def _scan(chunks: DataFrame, path: str) -> DataFrame:
    """(row, chunk, entry, exit): the states of every chunk, by combining matrices."""

    def matrices(b: pa.RecordBatch) -> dict:
        model = model_at(path)
        made = [_pack(transfer(*r, model)) for r in zip(*(b.column(c).to_pylist() for c in ("text", "ahead", "base")))]
        return {"row": b.column("row"), "chunk": b.column("chunk"), "block": b.column("block"), "matrix": made}

    each = stored(map_rows(chunks, matrices, "row bigint, chunk bigint, block bigint, matrix array<string>", lambda: model_at(path).forget()), "piece-matrices")

    def combine(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["chunk"])
        total = _unpack(rows[0]["matrix"])
        for r in rows[1:]:
            total = product(total, _unpack(r["matrix"]))
        return pa.Table.from_pylist([{"row": rows[0]["row"], "block": rows[0]["block"], "matrix": _pack(total)}], pa.schema([("row", pa.int64()), ("block", pa.int64()), ("matrix", pa.list_(pa.string()))]))

    blocks = each.groupBy("row", "block").applyInArrow(combine, "row bigint, block bigint, matrix array<string>")

    def over_blocks(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["block"])
        at = states_at_cuts([_unpack(r["matrix"]) for r in rows], 0, 0)
        return pa.table({"row": pa.array([r["row"] for r in rows], pa.int64()), "block": pa.array([r["block"] for r in rows], pa.int64()), "from": pa.array(at[:-1], pa.int64()), "to": pa.array(at[1:], pa.int64())})

    ends = blocks.groupBy("row").applyInArrow(over_blocks, "row bigint, block bigint, from bigint, to bigint")

    def over_chunks(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["chunk"])
        at = states_at_cuts([_unpack(r["matrix"]) for r in rows], rows[0]["from"], rows[0]["to"])
        return pa.table({"row": pa.array([r["row"] for r in rows], pa.int64()), "chunk": pa.array([r["chunk"] for r in rows], pa.int64()), "entry": pa.array(at[:-1], pa.int64()), "exit": pa.array(at[1:], pa.int64())})

    return each.join(ends, ["row", "block"]).groupBy("row", "block").applyInArrow(over_chunks, "row bigint, chunk bigint, entry bigint, exit bigint")


def encode(df: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", cut: Cutting = Cutting()) -> DataFrame:
    """doc_id, ids (array of int), n_chunks for each row of ``df``.

    A null or empty text has no ids and no chunk. Texts longer than ``cut.chunk_chars``
    code points take the chunked way, whose result does not depend on where the cuts are
    but for segmentations of equal weight. Repeated rows are encoded one by one; an empty
    table gives no rows. Other columns are not looked at.
    """
    docs = documents(df, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    is_long = F.coalesce(F.char_length("text") >= cut.chunk_chars, F.lit(False))

    def short(b: pa.RecordBatch) -> dict:
        model = model_at(model_path)
        found = encode_texts([(t or b"").decode("utf-8", "replace") for t in texts(b.column("text"))], model)
        return {"doc_id": b.column("doc_id"), "ids": _lists(found), "n_chunks": [1 if f else 0 for f in found]}

    def forget() -> None:  # a worker lives on after its task
        model_at(model_path).forget()

    whole = map_rows(docs.where(~is_long), short, f"doc_id {kind}, ids array<int>, n_chunks bigint", forget)

    # Numbered once, in a written table: a number computed twice may come out differently.
    long = stored(docs.where(is_long).withColumn("row", F.monotonically_increasing_id()), "piece-texts")
    def back(b: pa.RecordBatch) -> dict:
        model = model_at(model_path)
        rows = list(zip(*(b.column(c).to_pylist() for c in ("text", "ahead", "base", "entry", "exit"))))
        return {"row": b.column("row"), "chunk": b.column("chunk"), "ids": _lists(trace(rows, model))}

    if _merger(model_path):
        traced = _merged(long, model_path, cut)
    else:
        chunks = _chunks(long, model_path, cut)
        traced = map_rows(chunks.join(_scan(chunks, model_path), ["row", "chunk"]), back, "row bigint, chunk bigint, ids array<int>", forget)
    joined = traced.groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"), F.count(F.lit(1)).alias("n_chunks"))
    return whole.union(long.select("row", "doc_id").join(joined, "row").select("doc_id", "ids", "n_chunks"))


def _lists(found: list[bytes]) -> pa.Array:
    """Lists of ids from their bytes, without a Python object for each id."""
    ends = np.cumsum([0, *(len(f) // 4 for f in found)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32()))


def decode_ids(ids: np.ndarray, model: Model) -> bytes:
    """The text of the ids: blanks restored, the one put in front taken off."""
    out = b"".join([model.raw[i] for i in ids.tolist()])
    return out[1:] if out[:1] == b" " else out


def decode(df: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text from ids. Null ids give a null text; U+2581 in an encoded text comes
    back as a blank, as in SentencePiece."""
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def fn(b: pa.RecordBatch) -> dict:
        model = model_at(model_path)
        found = [None if x is None else decode_ids(x, model) for x in _arrays(b.column("ids"))]
        return {"doc_id": b.column("doc_id"), "text": pa.array([None if f is None else f.decode("utf-8", "replace") for f in found], pa.string())}

    return map_rows(rows, fn, f"doc_id {kind}, text string")


def _arrays(column: pa.ListArray) -> list[np.ndarray | None]:
    offsets, values = np.asarray(column.offsets), np.asarray(column.values)  # offsets count from the whole array
    return [values[a:b] if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist())]


def digest(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, text_sha256 (of the decoded text), n_chunks."""
    import hashlib
    import zlib

    kind = encoded.schema["doc_id"].dataType.simpleString()

    def fn(b: pa.RecordBatch) -> dict:
        model = model_at(model_path)
        ids = _arrays(b.column("ids"))
        return {
            "doc_id": b.column("doc_id"),
            "n_tokens": [len(x) for x in ids],
            "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
            "text_sha256": [hashlib.sha256(decode_ids(x, model)).hexdigest() for x in ids],
            "n_chunks": b.column("n_chunks"),
        }

    return map_rows(encoded, fn, f"doc_id {kind}, n_tokens bigint, ids_crc32 bigint, text_sha256 string, n_chunks bigint")
