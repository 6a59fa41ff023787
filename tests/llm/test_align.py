"""Tokenizer alignment against both libraries on whole texts."""

from __future__ import annotations

import hashlib
import os
import sys
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from odd_rows import RARE
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
from tradewind.llm import align

SF_DIR = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alphabet():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def plain(texts):
    """The contract, one whole text at a time: a row for every text."""
    tok, sp, back = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), alphabet()
    tok.encode_special_tokens = True
    counts, docs = Counter(), []
    for t in texts:
        a, b = ([], []) if not t else (tok.encode(f" {t}", add_special_tokens=False).ids, sp.encode(t))
        a_raw = [bytes(back[c] for c in tok.id_to_token(i)) for i in a]
        b_raw = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(a_raw) != f" {t}".encode() or b"".join(b_raw) != f" {t}".encode():
            docs.append(([], [], [], []))
            continue
        ends = []
        for raw in (a_raw, b_raw):
            at, out = 0, []
            for r in raw:
                at += len(r)
                out.append(at)
            ends.append(out)
        pairs, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            pairs.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
        counts.update(pairs)
        groups, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = [], []
            while i < len(a) and ends[0][i] <= e:
                x.append(str(a[i]))
                i += 1
            while j < len(b) and ends[1][j] <= e:
                y.append(str(b[j]))
                j += 1
            groups.append(f"{','.join(x)}|{','.join(y)}")
        docs.append((a, b, groups, pairs))
    top = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return [
        (len(a), len(b), len(g), len(p), sum(counts[x] == top[x[1]] for x in p), sum(counts[x] for x in p), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for a, b, g, p in docs
    ]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are not here")
def test_query_equals_libraries_on_whole_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in entry_point.queries()["op13_tokenizer_alignment"](spark, SF_DIR).collect()}
    assert found == dict(zip((r["doc_id"] for r in docs), plain([r["text"] for r in docs])))


ODD = [*RARE, (20, "a  b \n c d 　ﬁ 😀é<0x41> z  "), (21, "<|endoftext|> <s> </s> <unk>"), (22, "▁ in a text"), (23, "x\ny z\n\nw\n"), (24, " \x1c\x85 \xa0 end "), (25, " lead"), (26, "\n"), (27, "漢" * 300 + "𝔘𝔫𝔦 ñandú́"), (28, "it's we'll 'tis don't\nit's")]


@pytest.mark.parametrize("head_pairs", [1 << 18, 40, 0])
def test_odd_rows_and_rare_pairs(spark, head_pairs):
    """However many pairs go to every task, the result is the same."""
    df = spark.createDataFrame([(i, t, "x", 1, "x") for i, t in ODD], "doc_id bigint, text string, row string, pair int, a_ids string")
    found = align.score(align.align(df, A, B), head_pairs).collect()
    want = Counter((i, *w) for (i, _), w in zip(ODD, plain([t for _, t in ODD])))
    assert Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in found) == want


def test_empty_table_and_text_ids(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert align.score(align.align(none, A, B)).count() == 0
    one = spark.createDataFrame([("a1", "one text")], "doc_id string, text string")
    assert [(r["doc_id"], r["n_links"]) for r in align.score(align.align(one, A, B)).collect()] == [("a1", plain(["one text"])[0][3])]


def test_words_change_nothing(spark):
    """Whole texts through the libraries' spans give what words give."""
    texts = [t for _, t in ODD if t and len(t) < 10000]
    by_words = align.Aligner(A, B)
    whole = align.Aligner(A, B)
    whole.cuttable = False
    assert by_words.cuttable
    assert by_words.align(texts) == whole.align(texts)


def test_spans_cover_every_text(spark):
    df = spark.createDataFrame([(1, "ﬁ 😀 words"), (2, None)], "doc_id bigint, text string")
    found = sorted((r["start"], r["end"]) for r in align.spans(align.align(df, A, B)).collect())
    assert found[0][0] == 0 and found[-1][1] == len(" ﬁ 😀 words".encode())
    assert all(a[1] == b[0] for a, b in zip(found, found[1:]))


def test_new_words_cost_no_calls_each_and_little_room():
    """Words are looked up, aligned and kept as columns; Python makes no call for each."""
    parts = ["ba", "rio", "thé", "ñu", "ling", "sto", "qué", "wer", "lon", "ü", "zim", "ka"]
    words = [f"{a}{b}{c}{d}" for a in parts for b in parts for c in parts for d in parts[:4]]
    both, calls = align.Aligner(A, B), Counter()
    text = " ".join(words)
    before = sys.getprofile()
    sys.setprofile(lambda frame, event, arg: calls.update([event] if frame.f_code.co_filename == align.__file__ else []))
    try:
        found = both.align([text])
    finally:
        sys.setprofile(before)
    both.cuttable = False
    assert found == both.align([text])
    assert calls.total() < 2 * len(words)
    assert both.known.num_rows == len(words) and both.known.nbytes < 200 * len(words)


def test_words_with_and_without_their_end_are_found_wherever_they_are_kept():
    texts = [t for _, t in ODD if t and len(t) < 2000] + ["the cat, sat", "", "the, cat sat.", "да, нет. 漢, x.", "a,", ",", "., a. 3, 3.", "é, é", "▁a, ▁a", "a▁, a▁", "the, the. the"]
    whole = align.Aligner(A, B)
    whole.cuttable = False
    want = whole.align(texts)
    for remember, step in ((0, 1), (3, 1), (30, 5), (30, 100), (100_000, 1)):
        both = align.Aligner(A, B, remember)
        for _ in range(3):
            assert [x for k in range(0, len(texts), step) for x in both.align(texts[k : k + step])] == want
        kept = both.known.column("word").to_pylist()
        assert len(set(kept)) == len(kept) and max(map(len, kept), default=0) <= align.LONGEST
