"""Line-first quality cleaning.

Every line is judged on its own by punctuation, navigation and boilerplate rules;
lines that fail are removed, and a document that loses too much of its text, or fails
the base rules on the whole text, is rejected. One pass over the rows, no shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append, documents, fresh, map_rows, texts

# The characters that count as symbols, those that end a sentence,
# separators of menus, and phrases of site boilerplate.
SYMBOLS = b"#*$%&|<>"
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
)

_NOT_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)
_BOILER = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
_SEPARATED = re.compile(rb"(?<!\S)(?:[|>]|\xc2\xbb|\xe2\x80\xa2)+(?!\S)")
_SHOUT = re.compile(rb"[!?]{2,}(?:\s|$)")


@dataclass(frozen=True)
class Rules:
    """Parameters of the rules; the defaults are those of the registered query."""

    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    # Line rules.
    max_symbol_words: float = 0.3  # words ending or beginning in a symbol
    max_menu_separators: float = 0.2  # separators standing alone, per word
    max_shouts: float = 0.3  # words with two or more end marks
    boilerplate_words: int = 20  # a short line with a boilerplate phrase is boilerplate
    # Document rule.
    min_kept_chars: float = 0.5


def line_fails(line: bytes, rules: Rules) -> bool:
    """Whether a line with at least one word is menu, boilerplate or broken punctuation."""
    words = line.split()
    n = len(words)
    if line.translate(None, _NOT_SYMBOL):
        marked = sum(1 for w in words if w[-1:] in b"#*$%&|<>" or w[:1] in b"#*$%&|<>")
        alone = len(_SEPARATED.findall(line))
        if marked - alone > rules.max_symbol_words * n or (n >= 4 and alone > rules.max_menu_separators * n):
            return True
    if b"!!" in line or b"??" in line or b"!?" in line:
        if len(_SHOUT.findall(line)) > rules.max_shouts * n:
            return True
    return n <= rules.boilerplate_words and _BOILER.search(line.lower()) is not None


def repeated_words(words: list[bytes], window: int) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[k : k + n]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.subtract.at(edge, np.flatnonzero(twice) + window, 1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def judge(text: bytes | None, rules: Rules) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_lines_removed, cleaned text) of one document."""
    body = text or b""
    words = body.split()
    stripped = b"".join(words)
    lines = body.split(b"\n")
    seen: set[bytes] = set()
    dup = removed = lost = total = 0
    keep = []
    for line in lines:
        if not line or line.isspace():
            keep.append(line)
            continue
        if line in seen:
            dup += 1
        else:
            seen.add(line)
        total += len(line)
        if line_fails(line, rules):
            removed += 1
            lost += len(line)
        else:
            keep.append(line)
    n_repeat = repeated_words(words, rules.window)
    base_failed = len(words) < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * len(words)
    kept = not base_failed and total - lost >= rules.min_kept_chars * total
    cleaned = text if not removed else b"\n".join(keep)
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    return len(words), len(stripped.decode("utf-8", "replace")), symbols, dup, n_repeat, base_failed, kept, removed, cleaned


_FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines_removed long"


def assess(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``df``: doc_id, the counts, base_failed, kept, n_lines_removed.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged
    one by one. An empty table gives no rows. Other columns of ``df`` are not looked at.
    """
    names = [f.split()[0] for f in _FIELDS.split(", ")]

    def fn(b: pa.RecordBatch) -> dict:
        rows = [judge(t, rules)[:8] for t in texts(b.column("text"))]
        return {"doc_id": b.column("doc_id")} | dict(zip(names, zip(*rows)))

    docs = documents(df, id_col, text_col)
    return map_rows(docs, fn, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_FIELDS}")


def clean(df: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The kept rows of ``df``, all its columns, failing lines taken out of the text.

    Null, empty and blank texts have no words, fail the base rules and go. Repeated rows are
    judged one by one; an empty table stays empty.
    """
    keep, text = fresh(df, "_tw_keep"), fresh(df, "_tw_text")

    def fn(b: pa.RecordBatch) -> dict:
        rows = [judge(t, rules) for t in texts(b.column(text_col))]
        return {keep: [r[6] for r in rows], text: pa.array([r[8] for r in rows], pa.binary()).cast(pa.string())}

    out = append(df, fn, f"{keep} boolean, {text} string").where(F.col(keep))
    return out.withColumn(text_col, F.col(text)).drop(keep, text)
