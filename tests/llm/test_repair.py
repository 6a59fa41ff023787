"""Conversation repair against trying all edits, and against a plain version."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry_point
from tradewind.llm import repair

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def best(seq):
    """(cost, audit, roles) by a table of whole audits; seq holds (role initial, fault)."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    table = {"": (0, "", ())}

    def inserted(table):
        for _ in range(2):
            for state, (c, audit, roles) in list(table.items()):
                for r in "ua":
                    to = after.get((state, r))
                    if to is not None:
                        new = (c + 5, audit + "I", (*roles, r))
                        if to not in table or new < table[to]:
                            table[to] = new
        return table

    for role, fault in seq:
        new = {}
        for state, (c, audit, roles) in inserted(dict(table)).items():
            options = [(state, c + 2, "D", roles)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (state, role) in after:
                    options.append((after[state, role], c + more, "K", (*roles, role)))
                for r in "ua":
                    if (state, r) in after:
                        options.append((after[state, r], c + more + 1, "R", (*roles, r)))
            for to, cost, letter, out in options:
                found = (cost, audit + letter, out)
                if to not in new or found < new[to]:
                    new[to] = found
        table = new
    return min(v for k, v in inserted(dict(table)).items() if k in ("", "a")) if seq else (0, "", ())


def all_edits(seq):
    """(cost, audit) by trying every string of edits."""
    found = []
    legal = re.compile(r"(s?(ua)+)?")
    options = []
    for role, fault in seq:
        o = [(2, "D", "")]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            o += [(more, "K", role), (more + 1, "R", "u"), (more + 1, "R", "a")]
        options.append([(c + 5 * len(ins), "I" * len(ins) + letter, ins + out) for ins in ("", "u", "a", "ua", "au") for c, letter, out in o])
    for chosen in itertools.product(*options):
        for last in ("", "u", "a", "ua", "au"):
            if legal.fullmatch("".join(x[2] for x in chosen) + last):
                found.append((sum(x[0] for x in chosen) + 5 * len(last), "".join(x[1] for x in chosen) + "I" * len(last)))
    return min(found)


def symbol(role, fault):
    return repair._symbol("sua".find(role) if role in "sua" else 3, fault)


ALPHABET = [(r, f) for r in "suax" for f in ("ok", "blank", "duplicate", "truncated")]


def test_costs_and_ties_equal_all_edits():
    rng = random.Random(3)
    grammar = repair.Grammar([])
    for n in (0, 1, 1, 1, 2, 2, 2, 3, 3, 3):
        for _ in range(40 if n < 3 else 15):
            seq = [rng.choice(ALPHABET) for _ in range(n)]
            want = all_edits(seq)
            assert best(seq)[:2] == want
            assert grammar.solve("".join(symbol(*s) for s in seq)) == want


def test_rules_change_nothing():
    """Deep rules, also of long runs, give what single symbols give."""
    rng = random.Random(5)
    base = [symbol(*s) for s in ALPHABET]
    rules, names = [], list(base)
    for k in range(100):
        new = chr(0x100 + k)
        rules.append((new, rng.choice(names), rng.choice(names[-12:])))
        names.append(new)
    grammar, plain = repair.Grammar(rules), repair.Grammar([])
    sides = {new: (left, right) for new, left, right in rules}

    def spelled(s):
        return spelled(sides[s][0]) + spelled(sides[s][1]) if s in sides else s

    checked = 0
    for s in names:
        if len(spelled(s)) < 5000:
            for more in ("", rng.choice(base)):
                assert grammar.solve(more + s + more) == plain.solve(more + spelled(s) + more)
            checked += 1
    assert checked > 60


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)


def plain(rows, damage=True):
    """The contract, one conversation at a time."""
    convs = {r[0]: [] for r in rows}
    for r in damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]:
        convs[r[0]].append(r[1:])
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, seq = set(), []
        for _, role, text in turns:
            last = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "ok" if last[-1] in ".!?" else "truncated"
            seen.add((role, text))
            seq.append((role[:1], fault))
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(seq, seq[1:]))
        cost, audit, roles = best(seq)
        rows_left, names, lines = iter(turns), iter(roles), []
        for edit in audit:
            turn = next(rows_left) if edit != "I" else None
            if edit == "D":
                continue
            name = {"s": "system", "u": "user", "a": "assistant"}[next(names)]
            lines.append(f"{turn[1] if edit == 'K' else name}:{turn[2] if turn else ''}")
        out[conv] = (gaps, *(sum(f == x for _, f in seq) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines)))
    return out


def result(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are not here")
def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(entry_point.queries()["op12_conversation_repair"](spark, SF_DIR)) == plain(rows)


def odd():
    rng = random.Random(11)
    rows = []
    for conv in (None, *range(40)):
        for _ in range(rng.randrange(0, 14)):
            turn = rng.choice([None, 0, 0, 1, 2, 3, 5, 9, -4])
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "", None, "sys", "User"]), rng.choice(["ok.", "ok.", "cut", " \t\n", "", None, "wait!\x0b ", "why?", "long " * 5000 + "end."])))
    return rows


@pytest.mark.parametrize("chunk", [4096, 3, 1])
def test_odd_rows_in_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair.sequences, "__defaults__", (chunk,))
    rows = odd()
    df = spark.createDataFrame([(*r, "x", "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, h string, seq string, copies int")
    fixed = repair.plan_repairs(repair.rows_of(df))
    assert result(repair.digest(fixed)) == plain(rows, damage=False)
    hurt = repair.plan_repairs(repair.damage(repair.rows_of(df)), max_rules=5)
    assert result(repair.digest(hurt)) == plain(rows)


def test_repaired_rows_are_legal(spark):
    rows = odd()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = repair.plan_repairs(repair.rows_of(df))
    lines = defaultdict(list)
    for r in sorted(repair.mended(out).collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append((r["role"], r["text"]))
    want = plain(rows, damage=False)
    assert {c: sha("\n".join(f"{r}:{t}" for r, t in lines[c])) for c in want} == {c: w[-1] for c, w in want.items()}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in x)) for x in lines.values())


def test_one_row_a_thousand_times_and_empty_table(spark):
    ddl = "conv_id string, turn bigint, role string, text string"
    rows = [("c", 1, "user", "same.")] * 1000 + [("c", t, "assistant", "again.") for t in range(2, 300)] + [("d", 0, "system", "s.")]
    assert result(repair.digest(repair.plan_repairs(repair.rows_of(spark.createDataFrame(rows, ddl))))) == plain(rows, damage=False)
    assert repair.digest(repair.plan_repairs(repair.rows_of(spark.createDataFrame([], ddl)))).count() == 0


def test_pairs_become_rules(spark):
    seqs = spark.createDataFrame([("EIEIEIEI",), ("EIEI",), ("EIA",), ("",)], "seq string")
    rules = repair.re_pair(seqs)
    assert rules[0] == ("Ā", "E", "I") and ("ā", "Ā", "Ā") in rules
    assert repair.Grammar(rules).compress(["EIEIEIEI", "", "A"])[1:] == ["", "A"]
    assert repair.re_pair(seqs, 1) == rules[:1]
