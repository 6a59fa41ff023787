"""Benchmark decontamination with suffix arrays of the training text.

Each task builds the word suffix array of its shard of documents and looks every
suffix of every benchmark item up in it by binary search. What comes back are the
places where the next ``window`` words agree, which make up the longest verbatim
matches, the words they hit, and the verdict for each document. Documents are never
shuffled; the benchmark is the stated query set and goes to the tasks in blocks.

A shard's suffix array leaves out suffixes whose first word no benchmark item has:
no query can end at them. Ties are broken to ``window`` words and no further, since
equal places are all reported anyway.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append, documents, texts

# Words are runs of a-z, 0-9 and everything outside ASCII, after lower-casing A-Z.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

BLOCK_BYTES = 16 << 20


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


@dataclass
class Queries:
    """A block of benchmark items in numbers: what every task of a pass holds."""

    items: list[str]
    vocabulary: dict[bytes, int]
    windows: np.ndarray  # distinct windows by size: (count, window) word numbers, 0 beyond a short one
    sizes: np.ndarray  # words in each window
    owners: list[np.ndarray]  # items (numbers) that have the window
    places: list[list[tuple[int, int]]]  # (item number, first word) of each window


def prepare(items: list[tuple[str, bytes | None]], window: int) -> Queries:
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for k, (_, text) in enumerate(items):
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            found.setdefault(tuple(ids[i : i + window]), []).append((k, i))
    keys = sorted(found)
    table = np.zeros((len(keys), window), np.int64)
    for r, key in enumerate(keys):
        table[r, : len(key)] = key
    owners = [np.unique([k for k, _ in found[key]]) for key in keys]
    return Queries([i for i, _ in items], vocabulary, table, np.array([len(k) for k in keys], np.int64), owners, [found[key] for key in keys])


def _packed(ids: np.ndarray, places: np.ndarray, first: int, last: int, per: int, bits: int) -> np.ndarray:
    out = np.zeros(len(places), np.int64)
    for k in range(first, last):
        out = (out << bits) | ids[places + k]
    return out << (bits * (per - (last - first)))


def search(columns: list[np.ndarray], ids: np.ndarray, sizes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The range [low, high) of suffixes that begin with each query, by binary search
    one column after the other; a short query takes every way to go on."""
    depth = ids.shape[1]
    per = max(1, 63 // bits)
    low = np.zeros(len(ids), np.int64)
    high = np.full(len(ids), len(columns[0]), np.int64)
    whole = bits * per
    for c, column in enumerate(columns):
        first = c * per
        lo_key = np.zeros(len(ids), np.int64)
        for k in range(first, first + per):
            lo_key = (lo_key << bits) | (ids[:, k] if k < depth else 0)
        free = np.clip(first + per - sizes, 0, per) * bits
        hi_key = np.where(free >= whole, np.iinfo(np.int64).max, lo_key + (np.int64(1) << np.minimum(free, 62)) - 1)
        if c == 0:
            low, high = np.searchsorted(column, lo_key, "left"), np.searchsorted(column, hi_key, "right")
        else:
            low, high = _between(column, low, high, lo_key, "left"), _between(column, low, high, hi_key, "right")
    return low, high


def _between(column: np.ndarray, low: np.ndarray, high: np.ndarray, key: np.ndarray, side: str) -> np.ndarray:
    """searchsorted inside a sorted range for each key, all keys at once."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        value = column[np.minimum(middle, len(column) - 1)]
        right = open_ & ((value < key) if side == "left" else (value <= key))
        high = np.where(open_ & ~right, middle, high)
        low = np.where(right, middle + 1, low)
    return low


def shard_matches(docs: list[list[bytes]], q: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every place of the shard where a window occurs: (document, first word, window)."""
    none = np.zeros(0, np.int64)
    if not len(q.sizes) or not docs:
        return none, none, none
    depth = q.windows.shape[1]
    get = q.vocabulary.get
    flat: list[int] = []
    starts = np.zeros(len(docs) + 1, np.int64)
    gap = [0] * depth  # no match runs from one document into the next
    for k, words in enumerate(docs):
        flat.extend([get(w, 0) for w in words])
        flat.extend(gap)
        starts[k + 1] = len(flat)
    ids = np.array(flat, np.int64)
    # The query's largest number decides the packing, so that both sides pack alike.
    bits = max(1, len(q.vocabulary).bit_length())
    places, columns = suffix_array(ids, depth, bits)
    if not len(places):
        return none, none, none
    low, high = search(columns, q.windows, q.sizes, bits)
    count = high - low
    hit = np.flatnonzero(count > 0)
    if not len(hit):
        return none, none, none
    window = np.repeat(hit, count[hit])
    within = np.arange(len(window)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
    at = places[np.repeat(low[hit], count[hit]) + within]
    doc = np.searchsorted(starts, at, "right") - 1
    return doc, at - starts[doc], window


def suffix_array(ids: np.ndarray, depth: int, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions with a known word, sorted by their next ``depth`` words, and the sort
    columns in that order: each packs as many word numbers as fit into 63 bits."""
    per = max(1, 63 // bits)
    places = np.flatnonzero(ids)
    columns = [_packed(ids, places, first, min(first + per, depth), per, bits) for first in range(0, depth, per)]
    order = np.lexsort(columns[::-1])
    return places[order], [c[order] for c in columns]


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[list[tuple[str, bytes | None]]]:
    """The benchmark's items in blocks of about ``block_bytes``, one pass each. The
    benchmark is the stated query set; a block is what driver and tasks hold at once."""
    out: list[list[tuple[str, bytes | None]]] = [[]]
    size = 0
    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("i"), F.encode(F.col(f"`{text_col}`").cast("string"), "utf-8").alias("t"))
    for r in rows.orderBy("i", "t").toLocalIterator():
        more = len(r["t"] or b"")
        if out[-1] and size + more > block_bytes:
            out.append([])
            size = 0
        out[-1].append((r["i"], bytes(r["t"]) if r["t"] is not None else None))
        size += more
    return out


def mark(
    df: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted text), longest, contaminated, matches.

    ``matches`` are the longest verbatim matches: item_id, item_word, doc_word (first
    words) and n_words. They are made of windows: matches below ``window`` words are not
    reported, and ``longest`` is 0 then. A null or empty text has no words and no hit. An item of fewer
    than ``window`` words is one window; one without words has none. Null item ids are
    read as the text "null". Repeated rows are marked one by one; an empty table gives
    no rows, an empty benchmark no hits. Other columns are not looked at.
    """
    docs = documents(df, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = _find(docs, benchmark, "text", item_col, item_text_col, window, block_bytes, "")
    return found.select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        "n_words",
        F.col("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["n_words"])), F.lit(0).cast("long")).alias("longest"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "matches",
    )


_MATCH = "array<struct<item_id:string,item_word:bigint,doc_word:bigint,n_words:bigint>>"


def _find(df, benchmark, text_col, item_col, item_text_col, window, block_bytes, prefix):
    """``df`` with n_words, n_hit, items and matches, one pass of map tasks a block."""
    names = {n: prefix + n for n in ("hits", "n_words", "n_hit", "items", "matches")}
    ddl = f"{prefix}hits_new binary, {prefix}n_words_new bigint, {prefix}n_hit_new bigint, {prefix}items_new array<string>, {prefix}matches_new {_MATCH}"
    first = True
    for items in blocks(benchmark, item_col, item_text_col, block_bytes):
        q = df.sparkSession.sparkContext.broadcast(prepare([("null" if i is None else i, t) for i, t in items], window))
        df = append(df, _pass(q, text_col, names, first), ddl)
        if not first:
            df = df.drop(*names.values())
        df = df.withColumnsRenamed({f"{n}_new": n for n in names.values()})
        first = False
    return df


def _pass(q, text_col: str, names: dict[str, str], first: bool):
    """One block's pass over a batch; earlier passes' hits come in as a bitmap."""

    def fn(b: pa.RecordBatch) -> dict:
        block = q.value
        docs = [words_of(t) for t in texts(b.column(text_col))]
        before = None if first else {n: b.column(names[n]).to_pylist() for n in ("hits", "items", "matches")}
        doc, at, win = shard_matches(docs, block)
        order = np.argsort(doc, kind="stable")
        doc, at, win = doc[order], at[order], win[order]
        edges = np.searchsorted(doc, np.arange(len(docs) + 1))
        hits, n_hit, items, matches = [], [], [], []
        for k, words in enumerate(docs):
            lo, hi = edges[k], edges[k + 1]
            old = before["hits"][k] if before else b""
            if lo == hi and not old:
                hits.append(b"")
                n_hit.append(0)
                items.append([])
                matches.append([])
                continue
            mask = np.unpackbits(np.frombuffer(old, np.uint8), count=len(words)).astype(bool) if old else np.zeros(len(words), bool)
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, at[lo:hi], 1)
            np.subtract.at(edge, at[lo:hi] + block.sizes[win[lo:hi]], 1)
            mask |= np.cumsum(edge[:-1]) > 0
            mine = {block.items[i] for w in np.unique(win[lo:hi]) for i in block.owners[w]}
            hits.append(np.packbits(mask).tobytes())
            n_hit.append(int(mask.sum()))
            items.append(sorted(mine | set(before["items"][k] if before else ())))
            matches.append([*(before["matches"][k] if before else ()), *longest_matches(at[lo:hi], win[lo:hi], block)])
        return {f"{names['hits']}_new": hits, f"{names['n_words']}_new": [len(w) for w in docs], f"{names['n_hit']}_new": n_hit, f"{names['items']}_new": items, f"{names['matches']}_new": matches}

    return fn


def longest_matches(at: np.ndarray, win: np.ndarray, q: Queries) -> list[dict]:
    """Windows that follow each other in document and item alike, joined into runs."""
    rows = sorted({(item, int(a) - start, int(a), int(w)) for a, w in zip(at, win) for item, start in q.places[w]})
    out: list[dict] = []
    last = None
    for item, shift, a, w in rows:
        size = int(q.sizes[w])
        if last == (item, shift, a - 1):
            out[-1]["n_words"] += 1
        else:
            out.append({"item_id": q.items[item], "item_word": a - shift, "doc_word": a, "n_words": size})
        last = (item, shift, a)
    return out


def remove(df: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``df`` that hold no window of the benchmark, all columns as they are.

    Null and empty texts hold none and stay, as do all rows if the benchmark is empty or has
    no words. Repeated rows go or stay alike; an empty table stays empty.
    """
    prefix = fresh_prefix(df)
    found = _find(df, benchmark, text_col, item_col, item_text_col, window, block_bytes, prefix)
    return found.where(F.col(f"{prefix}n_hit") == 0).select(*[F.col(f"`{c}`") for c in df.columns])


def fresh_prefix(df: DataFrame) -> str:
    prefix = "_tw_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def digest(marks: DataFrame) -> DataFrame:
    """The registered query's columns from those of ``mark``."""
    return marks.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated", "longest")
