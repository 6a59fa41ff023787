"""The corpus pipeline against plain versions of its stages, one after the other; the
max-plus scan through ``encode``; ids of other types."""

from __future__ import annotations

import os
import sys
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from odd_rows import LONG, RARE
from pyspark.sql import functions as F

import corpus_pipeline
from tradewind.llm import language, pieces, quality, token_files, toxicity
from tradewind.session import workspace

SF_DIR = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def plain(docs, items):
    """doc_id and ids of what is left; docs are (id, text)."""
    judged = [(i, quality.judge((t or "").encode(), quality.Rules())) for i, t in docs]
    left = [(i, j[8].decode()) for i, j in judged if j[6]]
    for (_, t), (_, j) in zip(docs, judged):  # what the verdict rests on
        assert j[:6] == brute.quality(t)
    left = [(i, line[4]) for (i, _), line in zip(left, brute.lines(left))]
    left.sort()
    first = brute.groups([brute.fingerprint(t) for _, t in left])
    left = [x for k, x in enumerate(left) if first[k] == k]
    marks = brute.decontaminate([t for _, t in left], items)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return {i: sp.encode(t) for (i, t), m in zip(left, marks) if not m[4]}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are not here")
def test_pipeline_equals_plain_stages(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    want = plain(docs, items)
    assert 0 < len(want) < len(docs)
    assert got == want


def test_each_stage_keeps_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """A copy of the model whose scores are to be added up."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(m.SerializeToString())
    return str(path)


@pytest.mark.parametrize("size", [17, 64])
def test_scan_in_chunks_equals_whole_texts(spark, unigram, size):
    """Transfer matrices of chunks, combined and traced back, give what one search gives."""
    rows = [(1, "ab" * 300 + " 日本語 " + "x y z  " * 20), (2, "nospaces" * 60), (3, LONG[:2000]), (4, "a\n" * 90), (None, "b" * 100), (5, "internationalization " * 30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = {r["doc_id"]: r["ids"] for r in pieces.encode(df, unigram, cut=pieces.Cutting(100_000, 4)).collect()}
    cut = pieces.encode(df, unigram, cut=pieces.Cutting(size, 4)).collect()
    assert min(r["n_chunks"] for r in cut) > 1
    assert {r["doc_id"]: r["ids"] for r in cut} == whole
    model = pieces.Model(unigram)
    assert model.merges is None
    for i, t in rows:
        alone = pieces._ids(pieces.segment(pieces.normalized(t), model), model)
        assert np.array(whole[i], "<u4").tobytes() == alone


def test_token_records_with_text_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(None if i is None else f"a{i}", t) for i, t in RARE]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    folder = workspace(spark, "text-ids")
    index = token_files.tokenize(df, folder, path, file_bytes=20_000)
    assert Counter(r["doc_id"] for r in index.collect()) == Counter(i for i, _ in rows)
    back = token_files.read_records(spark, f"{folder}/files", index, spark.createDataFrame([("a8",), ("zz",)], "doc_id string")).collect()
    whole = token_files.Encoder(path).tokenizer.encode(RARE[10][1], add_special_tokens=False).ids
    assert [(r["doc_id"], r["ids"]) for r in back] == [("a8", [*whole, 2])]


def test_pieces_met_again_are_the_same(spark):
    """A small memory that forgets changes no id."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").limit(60).collect()]
    small, tokenizer = token_files.Encoder(path, remember=50, at_once=4000), token_files.Encoder(path).tokenizer
    assert small.cuts and small.feed is not None
    for t, e in zip(texts, small.encode(texts)):
        assert np.frombuffer(e, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    other = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.cuts
    assert [np.frombuffer(e, "<u4").tolist() for e in other.encode(texts[:5])] == [other.tokenizer.encode(t, add_special_tokens=False).ids for t in texts[:5]]


def test_labels_of_other_documents_take_no_place(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    more = labels.unionByName(spark.range(5_000_000, 5_050_000).select(F.col("id").alias("doc_id"), F.lit(0).cast("bigint").alias("toxic")))
    found = [{r["doc_id"] for r in toxicity.severity(docs, x).where("toxic").collect()} for x in (labels, more)]
    assert found[0] and found[0] == found[1]


def test_language_sample_is_the_lowest_hashes(spark):
    """Bounds by hash choose the rows that a plain ranking does."""
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.when(F.col("id") % 10 < 8, "a").when(F.col("id") % 1000 == 9, "rare").otherwise("b").alias("lang"))
    narrow = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    kept = language._lowest(narrow, 300)
    assert kept.count() < 6000
    for lang in ("a", "b", "rare"):
        first, want = ([r["doc_id"] for r in x.where(F.col("lang") == lang).orderBy("h").limit(300).collect()] for x in (kept, narrow))
        assert first == want
    same = narrow.withColumn("h", F.lit(2**62).cast("bigint"))
    assert language._lowest(same, 300).count() == 30_000


def test_memory_of_pieces_is_bounded_in_characters():
    """It outlives its task, so long words must not fill it."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_files.Encoder(path, remember=50, at_once=1)
    words = [f"{'x' * 400}{k}y" for k in range(60)]
    ids = [encoder.encode([w]).__next__() for w in words]
    assert ids == [encoder._whole(w) for w in words]
    assert sum(map(len, [*encoder.known, *encoder.earlier])) < 4000


def test_words_of_letters_are_merged_as_they_are():
    """Without the tokenizer's own splitting; a word met with its comma only is not kept."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_files.Encoder(path)
    texts = ["don't naïve ʰx Ωmega 漢字 x.y", "", "ªº µ ˈa Ⅷ ① ǅ ﬁne", "Érévion, lonely.\nwords là ÿes ʯ ß × ÷ z", "a"]
    assert encoder.plain
    assert list(encoder.encode(texts)) == [encoder._whole(t) for t in texts]
    assert "Érévion," in encoder.known and "Érévion" not in encoder.known


def test_new_words_cost_no_calls_each_and_little_room():
    """Words are looked up, encoded and kept as columns; Python makes no call for each."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    parts = ["ba", "rio", "thé", "ñu", "ling", "sto", "qué", "wer", "lon", "ü", "zim", "ka"]
    words = [f"{a}{b}{c}{d}" for a in parts for b in parts for c in parts for d in parts[:4]]
    encoder, calls = token_files.Encoder(path), Counter()
    text = " ".join(words)
    before = sys.getprofile()
    sys.setprofile(lambda frame, event, arg: calls.update([event] if frame.f_code.co_filename == token_files.__file__ else []))
    try:
        (ids,) = encoder.encode([text])
    finally:
        sys.setprofile(before)
    assert ids == encoder._whole(text)
    assert calls.total() < len(words) / 2
    assert encoder.known.pieces.nbytes + encoder.known.ids.nbytes < 80 * len(words)


def test_words_with_and_without_their_end_are_found_wherever_they_are_kept():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["the cat, sat", "the, cat sat.", "", "да, нет. 漢, x.", "да нет 漢 x", "a,", ",", "., a. 3, 3.", "é, é", "cat", "don't, can't. don't", "the, the. the", "ⅷ, 🙂. a🙂,"]
    for remember, at_once in ((0, 1), (3, 1), (3, 30), (1000, 1), (1000, 1000)):
        encoder = token_files.Encoder(path, remember=remember, at_once=at_once)
        for batch in (texts, texts[::-1], texts):
            assert list(encoder.encode(batch)) == [encoder._whole(t) for t in batch]
        assert len(set(encoder.known)) == len(encoder.known)
