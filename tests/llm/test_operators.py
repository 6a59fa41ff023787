"""The text operators against plain versions, on the driver's small tables and odd rows."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from odd_rows import LONG, RARE
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tradewind.llm import common, decontaminate, language, line_dedup, pieces, pii, quality, simhash, suffix_dedup, token_files, toxicity
from tradewind.session import workspace

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are not here")


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    return sorted(rows)


def run(spark, name):
    return sorted(entry_point.queries()[name](spark, SF_DIR).collect(), key=lambda r: r["doc_id"])


def counted(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


# SimHash


def test_golay_code_is_perfect():
    words = np.arange(1 << 23)
    code = simhash.decode(words[:: 4099])
    assert code.max() < 4096
    # Every remainder has its one error pattern of at most three bits.
    assert len(set(simhash.syndrome_table().tolist())) == 2048
    a = np.array([0b1011, 123456, 7654321])
    for bit in range(22):
        b = a ^ (1 << bit)
        near = simhash.nearby(a, 22)
        assert all(x in n for x, n in zip(simhash.decode(b), near))


def test_close_fingerprints_share_a_key():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    for bits in (1, 2, 3):
        other = base.copy()
        for k in range(len(base)):
            for b in rng.choice(64, bits, replace=False):
                other[k] ^= np.uint64(1) << np.uint64(b)
        left, right = (set(zip(k.tolist(), s.tolist(), r.tolist())) for r, s, k in (simhash.keys_of(base), simhash.keys_of(other)))
        by = [{(k, s) for k, s, r in left if r == n} for n in range(len(base))]
        to = [{(k, s) for k, s, r in right if r == n} for n in range(len(base))]
        assert all(any((k, 1 - s) in t for k, s in b) for b, t in zip(by, to))


def test_op1_equals_brute_force(spark, docs):
    fps = [brute.fingerprint(t) for _, t in docs]
    want = [(i, f"{f:016x}", docs[g][0]) for (i, _), f, g in zip(docs, fps, brute.groups(fps))]
    assert [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in run(spark, "op1_simhash_near_dedup")] == want


def test_simhash_dense_group(spark):
    """A dense group is one component and hands out no more links than a forest has."""
    rng = np.random.default_rng(3)
    values = {0x0123456789ABCDEF}
    while len(values) < 400:
        v = list(values)[int(rng.integers(len(values)))]
        values.add(v ^ 1 << int(rng.integers(63)))
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    found = simhash.links(fps)
    assert common.components(found).select("root").distinct().count() == 1
    assert brute.groups(sorted(values)) == [0] * 400


def test_simhash_odd_rows(rare, nothing):
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_dedup(rare).collect()}
    fps = [brute.fingerprint(t) for _, t in RARE]
    assert {(i, f) for i, f, _ in got} == {(i, f"{f:016x}") for (i, _), f in zip(RARE, fps)}
    assert all(c == 1 for i, f, c in got if f == "0" * 16 and i is not None)
    assert simhash.near_dedup(rare).count() == len(RARE)
    assert simhash.near_dedup(nothing).count() == 0
    kept = simhash.keep_one(rare)
    assert kept.columns == rare.columns
    assert kept.where("doc_id = 4").count() == 1
    assert kept.where("doc_id in (8, 9) and text ilike 'the quick%'").count() == 1
    assert simhash.keep_one(nothing).count() == 0


def test_components(frame):
    chain = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 102), (7, 7)]
    got = {r["node"]: r["root"] for r in common.components(frame(chain, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(51)) and got[101] == 100 and got[103] == 102 and len(got) == 55


# Decontamination


def test_op2_equals_brute_force(spark, docs):
    items = [(str(r["item_id"]), r["text"]) for r in table(spark, "benchmark").collect()]
    want = [(i, *x) for (i, _), x in zip(docs, brute.decontaminate([t for _, t in docs], items))]
    assert any(x[2] for x in want)
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert [tuple(r[c] for c in cols) for r in run(spark, "op2_benchmark_decontamination")] == want


def test_decontamination_in_blocks_and_odd_rows(spark, rare, nothing):
    items = [("1", "The quick, BROWN fox jumps over the lazy dog near the river"), ("2", "short"), ("3", None), ("4", "!!"), (None, "lorem ipsum dolor sit amet consectetur lorem ipsum dolor sit amet"), ("5", "dog near the river bank today")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = Counter((i, *x[:3], x[4]) for (i, _), x in zip(RARE, brute.decontaminate([t for _, t in RARE], [(str(i) if i else "null", t) for i, t in items])))
    for size in (1 << 20, 40, 1):
        got = decontaminate.mark(rare, bench, block_bytes=size)
        assert counted(got, "doc_id", "n_words", "n_hit", "n_items", "contaminated") == want
    match = decontaminate.mark(rare, bench).where("doc_id = 8").first()["matches"]
    assert ("1", 0, 0, 12) in {tuple(m) for m in match}
    assert decontaminate.mark(nothing, bench).count() == 0
    assert decontaminate.mark(rare, bench.where("1 = 0")).where("contaminated").count() == 0
    kept = decontaminate.remove(rare, bench)
    assert kept.columns == rare.columns
    assert kept.count() == sum(n for k, n in want.items() if not k[4])


# Token records


def encoded(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_op3_equals_whole_encoding(spark, docs):
    start, want = 0, []
    for i, t in docs:
        ids = encoded(t)
        want.append((i, start, len(ids), brute.crc32_of(ids)))
        start += len(ids)
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in run(spark, "op3_token_records")] == want


def test_token_records_odd_rows(spark, rare, nothing):
    folder = workspace(spark, "test-records")
    index = token_files.tokenize(rare, folder, public_tokenizers.path("byte_bpe_50k.json"), file_bytes=20_000)
    want = Counter((i, len(e := encoded(t)), brute.crc32_of(e)) for i, t in RARE)
    assert counted(index, "doc_id", "n_tokens", "ids_crc32") == want
    rows = sorted(index.collect(), key=lambda r: r["start"])
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(len(rows))]
    chosen = spark.createDataFrame([(8,), (4,), (77,)], "doc_id bigint")
    back = token_files.read_records(spark, f"{folder}/files", index, chosen).collect()
    assert sorted(r["doc_id"] for r in back) == [4, 4, 8]
    assert {tuple(r["ids"]) for r in back if r["doc_id"] == 8} == {tuple(encoded(RARE[10][1]))}
    assert token_files.tokenize(nothing, workspace(spark, "none"), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_broken_record_is_noticed():
    data = bytearray(token_files.frame(5, np.array([1, 2, 70000], np.uint32)))
    assert token_files.read_frame(bytes(data), 0)[0] == 5
    data[14] ^= 1
    with pytest.raises(ValueError):
        token_files.read_frame(bytes(data), 0)


# Toxicity


def test_op4_finds_toxic_documents(spark):
    found = entry_point.queries()["op4_toxicity"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    rows = found.join(labels, "doc_id").collect()
    assert found.count() == 1000
    caught = [r for r in rows if r["label"]]
    clean = [r for r in rows if not r["label"]]
    assert sum(r["toxic"] for r in caught) >= 0.8 * len(caught)
    assert sum(r["toxic"] for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r["expected_severity"] <= 3 for r in rows)


def test_toxicity_learns_ordered_grades_and_odd_rows(spark, rare, nothing):
    rng = np.random.default_rng(2)
    plain = [f"word{k}" for k in range(60)]
    rows, marks = [], []
    for i in range(400):
        words = list(rng.choice(plain, 40))
        bad = i % 4 == 0
        if bad:
            words[: int(rng.integers(1, 12))] = ["vile"] * int(rng.integers(1, 12))
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (5, None)], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in toxicity.severity(df, labels).collect()}
    assert sum(got[i]["toxic"] != bool(t) for i, t in marks) <= 4
    assert np.corrcoef([rows[i][1].split().count("vile") for i in range(0, 400, 4)], [got[i]["expected_severity"] for i in range(0, 400, 4)])[0, 1] > 0.8
    assert all(abs(sum(r["p_grade"]) - 1) < 1e-9 for r in got.values())
    odd = toxicity.severity(rare, labels)
    assert odd.count() == len(RARE) and odd.where("toxic").count() == 0
    assert toxicity.severity(nothing, labels).count() == 0
    assert toxicity.severity(rare, labels.where("1 = 0")).where("toxic").count() == 0


# SentencePiece


@pytest.fixture(scope="module")
def model_path():
    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram(model_path):
    """The library's own search for the heaviest segmentation over the same pieces."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(model_path, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


def test_words_are_heaviest_segmentations(docs, model_path, unigram):
    """The library's lattice search (its list of the best two) finds none that is heavier."""
    model = pieces.Model(model_path)
    words = sorted({u for _, t in docs[:60] for u in pieces._UNITS.findall(pieces.normalized(t or "")) if u[0] == "▁" and len(u) > 1})
    assert len(words) > 1000
    for w in words:
        best = unigram.nbest_encode_as_pieces(w[1:], 2)[0]
        mine = pieces.segment(w, model)
        assert "".join(mine) == w
        assert sum(model.weight(p) >> pieces._PLACES for p in mine) == sum(model.weight(p) >> pieces._PLACES for p in best), w


def every_way(text, model):
    """All segmentations of a short text, by trying every one."""
    if not text:
        return [[]]
    return [[text[:k], *rest] for k in range(1, len(text) + 1) if k == 1 or text[:k] in model.weights for rest in every_way(text[k:], model)]


def test_segmentation_equals_all_ways(model_path):
    model = pieces.Model(model_path)
    for w in ("▁entebest", "▁the", "ßüüßa", "bbbbbbbb", "▁▁▁日x", "stststst"):
        def weight(way):
            at = [sum(map(len, way[:k])) for k in range(len(way))]
            return sum(model.weight(p) for p in way) - sum(at)

        assert weight(pieces.segment(w, model)) == max(map(weight, every_way(w, model)))


def test_words_together_equal_words_alone(docs, model_path):
    """Ties, characters without a piece, words of blanks and long ones included."""
    model = pieces.Model(model_path)
    words = sorted({u for _, t in docs for u in pieces._units(t or "") if 0 < len(u) <= model.trie.word_chars})
    words += [" ", "   ", "bbbbbbbb", " ßüüßa日本x", "\n", "\x00", " \U0001f600ก", "ab" * 32, " " * 64]
    alone = [pieces._ids(pieces.segment(w.replace(" ", pieces.BLANK), model), model) for w in words]
    assert pieces.segment_words(words, model) == alone


def test_op5_round_trips(spark, docs):
    got = run(spark, "op5_sentencepiece")
    assert [(r["doc_id"], r["text_sha256"]) for r in got] == [(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in docs]
    assert max(r["n_chunks"] for r in got) > 1


def test_ids_are_the_library_s(spark, docs, model_path):
    """In the model's merge order, whole or in chunks."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    some = [(k, t) for k, (_, t) in enumerate([*docs[:100], *RARE]) if t and len(t) < 40_000 and "\x00" not in t]
    some += [(1000, "president"), (1001, "nospaces" * 60), (1002, "  two  blanks \n\n a\nb  "), (1003, "日本語ß" * 40)]
    df = spark.createDataFrame(some, "doc_id bigint, text string")
    for cut in (pieces.Cutting(), pieces.Cutting(64, 4)):
        got = {r["doc_id"]: r["ids"] for r in pieces.encode(df, model_path, cut=cut).collect()}
        assert [k for k, t in some if got[k] != sp.encode(t)] == []


@pytest.mark.parametrize("size", [3, 17, 64])
def test_chunks_change_nothing(spark, model_path, size):
    rows = [(1, "ab" * 300 + " 日本語 " + "x y z  " * 20), (2, "nospaces" * 60), (3, LONG[:2000]), (4, "a\n" * 90), (None, "b" * 100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = counted(pieces.encode(df, model_path).withColumn("ids", F.col("ids").cast("string")), "doc_id", "ids")
    cut = pieces.encode(df, model_path, cut=pieces.Cutting(size, 4))
    assert cut.agg(F.min("n_chunks")).first()[0] > 1
    assert counted(cut.withColumn("ids", F.col("ids").cast("string")), "doc_id", "ids") == whole


def test_sentencepiece_odd_rows(rare, nothing, model_path):
    for cut in (pieces.Cutting(), pieces.Cutting(50, 2)):
        back = pieces.decode(pieces.encode(rare, model_path, cut=cut), model_path)
        assert counted(back, "doc_id", "text") == Counter((i, (t or "").replace("▁", " ")) for i, t in RARE)
    assert pieces.encode(nothing, model_path).count() == 0


def test_product_is_associative(model_path):
    model = pieces.Model(model_path)
    text = "internationalization" * 3
    a, b, c = (pieces.transfer(text[k : k + 20], text[k + 20 :][:15], k, model) for k in (0, 20, 40))
    assert pieces.product(pieces.product(a, b), c) == pieces.product(a, pieces.product(b, c))


# PII


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_op6_equals_brute_force(spark, docs):
    got = run(spark, "op6_pii")
    for (i, t), r in zip(docs, got):
        spans = brute.pii(t)
        assert r["doc_id"] == i
        assert r["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert set(listed(spans).split(",")) <= set(r["spans"].split(","))


def test_pii_odd_rows(spark, rare, nothing):
    more = [
        (20, "x.y+z@a-b.co.uk, a@b.c@d.e.f a@b @c.d ..@1.2 é@é.fr e@f.gé"),
        (21, "256.1.1.1 1.2.3.4 001.002.003.0255 1.2.3.99999999999999999999 1.2.3.4.5.6.7.8.9"),
        (22, "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 0000000000000000000 1 2 3"),
        (23, "+1 (227) 555-6608 and +1 2 +12345678901234567 +1.2.3.4.5.6.7.8. +"),
        (24, "9" * 30000 + "a" * 30000 + "@" + "b." * 30000),
        (25, "1 " * 20000),
        (26, "10.0.0.1 and 0.0.0.0, 00.1.2.3 192.168.0.1 0.0.0.256 " + "0" * 4000 + ".0.0.0"),
    ]
    df = rare.select("doc_id", "text", "block").union(spark.createDataFrame([(i, t, "x") for i, t in more], "doc_id bigint, text string, block string"))
    got = counted(pii.digest(pii.find(df)), "doc_id", "base_sha256")
    assert got == Counter((i, hashlib.sha256(listed(brute.pii(t)).encode()).hexdigest()) for i, t in [*RARE, *more])
    assert pii.find(nothing).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"some words here then my phone number +1 (227) 555-{1000 + i} and more of it") for i in range(30)]
    rows += [(100, "later my phone number 227-555-9999, they said"), (101, "in the year 2019-2020 it rained"), (102, "again 227-555-9999 was called")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.find(df).collect()}
    assert [tuple(x) for x in got[100]["found"]] == [("phone", 22, 34)]
    assert [tuple(x) for x in got[102]["found"]] == [("phone", 6, 18)]
    assert got[101]["found"] == [] and got[0]["found"] == []
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df, pii.find(df)).collect()}
    assert clean[100] == "later my phone number <phone>, they said" and clean[101] == rows[31][1]


def test_contexts_discover_other_shapes(spark):
    """Identifiers without a digit or with blanks, and contexts that have digits themselves."""
    rows = [(i, f"some words here then my phone number +1 (227) 555-{1000 + i} and write to mail address user{i}@example.com or on line 00{10 + i} dial 9 +1 (227) 556-{1000 + i}") for i in range(40)]
    more = {
        100: ("later my phone number (227) 555-9999, they said", [("phone", "(227) 555-9999")]),
        101: ("so my phone number 227 555 9999.", [("phone", "227 555 9999")]),
        102: ("the mail address anna@localhost is old", [("email", "anna@localhost")]),
        103: ("a mail address jane.doe(at)example.com is new", [("email", "jane.doe(at)example.com")]),
        104: ("a mail address john (at) example.com is new", [("email", "john (at) example.com")]),
        105: ("they sat on line 0077 dial 8 x227-557-1111 now", [("phone", "x227-557-1111")]),
        106: ("see 10 20 30 40, anna@localhost and (227) 555-9999", [("email", "anna@localhost"), ("phone", "(227) 555-9999")]),
        107: ("1 2 3 x@ (at) @ (a) 5 (", []),
    }
    df = spark.createDataFrame([*rows, *((i, t) for i, (t, _) in more.items())], "doc_id bigint, text string")
    got = {r["doc_id"]: r["found"] for r in pii.find(df).collect()}
    for i, (t, want) in more.items():
        assert [(x["kind"], t[x["start"] : x["end"]]) for x in got[i]] == want, t
    assert all(got[i] == [] for i, _ in rows)


# Suffix arrays


def test_difference_cover():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


def test_op7_equals_brute_force(spark, docs):
    want = [(i, *x) for (i, _), x in zip(docs, brute.suffix([t for _, t in docs]))]
    assert any(x[2] for x in want)
    got = run(spark, "op7_suffix_dedup")
    assert [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == want


@pytest.mark.parametrize("block", [1000, 1 << 20])
def test_suffix_odd_rows(spark, rare, nothing, block):
    rng = np.random.default_rng(5)
    noise = "".join(map(chr, rng.integers(97, 123, 6000)))
    more = [(20, noise[:199]), (21, noise[:200]), (22, "q" + noise[:200] + "r"), (23, noise[1000:1350] + "|" + noise[1100:1300]), (24, noise[2000:2700]), (25, noise[2150:2360] + "é" + noise[2400:2650]), (26, "z" * 201), (27, "w" * 200)]
    df = rare.select("doc_id", "text", "block").union(spark.createDataFrame([(i, t, "x") for i, t in more], "doc_id bigint, text string, block string"))
    every = [*RARE, *more]
    want = Counter((i, *x) for (i, _), x in zip(every, brute.suffix([t for _, t in every])))
    got = suffix_dedup.dedup(df, block_bytes=block, bucket_bytes=block * 3)
    assert counted(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_dedup.dedup(nothing).count() == 0
    assert suffix_dedup.cut(b"abcdef", [(1, 3), (5, 6)]) == b"ade"


# Language


def test_op8_on_held_out_documents(spark):
    found = entry_point.queries()["op8_language"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", F.char_length("text").alias("n"))
    rows = found.join(truth, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_rows(spark, rare, nothing):
    got = language.identify(rare)
    assert got.count() == len(RARE)
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3) or (r["doc_id"] is None and r["score"] == 0)) for r in got.collect())
    assert language.identify(nothing).count() == 0
    unknown = language.identify(rare.withColumn("lang", F.lit(None).cast("string")))
    assert unknown.select("lang_pred").distinct().collect()[0][0] == "und"


# Lines


@pytest.mark.parametrize("batches,fan_out", [(1, 4), (5, 2), (7, 3)])
def test_line_runs_equal_brute_force(spark, docs, batches, fan_out):
    got = line_dedup.report(table(spark, "documents"), batches=batches, fan_out=fan_out)
    want = Counter(brute.lines(docs))
    assert any(k[2] for k in want)
    assert counted(got, "doc_id", "n_lines", "n_dropped", "kept_sha256", "text") == want


def test_lines_odd_rows(rare, nothing):
    got = line_dedup.report(rare, batches=3, fan_out=2)
    big = 2**63 - 1
    want = Counter((None if i == big else i, n, d, h) for i, n, d, h, _ in brute.lines([(big if i is None else i, t) for i, t in RARE]))
    assert counted(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == want
    assert line_dedup.report(nothing).count() == 0
    cleaned = line_dedup.clean(rare)
    assert cleaned.columns == rare.columns and cleaned.count() == len(RARE)
    assert cleaned.where("doc_id = 1 and text is null").count() == 1
    assert cleaned.where("doc_id = 9 and text = ''").count() == 1


def test_runs_are_compacted(spark, frame):
    store = line_dedup.LineRuns(spark, workspace(spark, "test-runs"), fan_out=2)
    for k in range(7):
        store.add(frame([(bytes([k]) * 16, k)], "key binary, first_id bigint"))
    assert sorted(r.level for r in store.runs) == [0, 1, 2]
    assert store.known().count() == 7


# Quality


def test_op10_equals_brute_force(spark, docs):
    want = [(i, *brute.quality(t)) for i, t in docs]
    got = run(spark, "op10_quality")
    assert [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got] == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_keeps_the_good_and_drops_the_bad(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = quality.assess(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    good = [r for r in got if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in good) >= 0.98 * len(good)


def test_quality_lines_and_odd_rows(spark, rare, nothing):
    body = "\n".join(f"Sentence {k}: " + " ".join(f"word{(7 * k + 3 * j) % 97}" for j in range(12)) + "." for k in range(8))
    text = "Home | About | Contact | Shop | Login\n" + body + "\nClick here to accept cookies now"
    out = quality.clean(spark.createDataFrame([(1, text), (2, "Home | About | Us | More | x\n" * 9 + body[:60])], "doc_id bigint, text string"))
    assert [tuple(r) for r in out.collect()] == [(1, body)]
    got = counted(quality.assess(rare), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == Counter((i, *brute.quality(t)) for i, t in RARE)
    assert quality.assess(nothing).count() == 0 and quality.clean(nothing).count() == 0
    assert quality.clean(rare).columns == rare.columns
