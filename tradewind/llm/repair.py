"""Conversations put in order by the cheapest edits.

Each row of a conversation is a symbol: the initial of its role (s, u, a or another) and its
first fault (blank, duplicate of an earlier row, truncated, or none). The repaired roles
are ``(s?(ua)+)?``, four states:

    0  nothing yet     1  after s     2  after u     3  after a

What a symbol costs between two states is a min-plus matrix; a run of symbols has the
product of theirs. An entry is the least cost and, among the audits (the edits' initials) of
that cost, the ASCII-least. Inserts count to the row behind them, so all audits of a run
have as many letters besides I and end in one: none begins another, and of two products
the one whose left part is less is less. So an entry needs only the state it passes and the
rank of its audit among those from the same state; the audit is a rope that hangs on the
two symbols' ropes and is spelled out once, at the end.

Re-Pair makes the symbols of all conversations into a grammar: round by round the most
frequent pairs of neighbours, counted in Spark, become new symbols. Each rule has one matrix
with its rope, made bottom-up once and used by all conversations. How far the grammar goes
(``max_rules``) changes the work and never the result.

Rows are numbered by a range partitioning and never gathered with their texts; what is one
value for a conversation is its symbols, its audit (a byte a row) and the digest, for which
its rows pass through one task as a stream.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import drop_stored, map_rows, stored, stored_at

CHUNK = 4096  # symbols that a task puts together before they are shuffled
MAX_RULES = 128
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # what edits cost

_SPACE = " \t\n\x0b\x0c\r"
_ENDS = ".!?"
_ROLES = "sua"
_FAULTS = ("ok", "blank", "duplicate", "truncated")
_NEXT = (2, 2, 3, 2)  # the state after an inserted or reroled row
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_FINAL = {0: "", 1: "II", 2: "I", 3: ""}  # inserts that end a conversation
_STATES = range(4)
_NEVER = 1 << 60


def _symbol(role: int, fault: str) -> str:
    """``role`` is the place of the initial in ``_ROLES``, or 3."""
    return chr(ord("A") + role * 4 + _FAULTS.index(fault))


BASE = {_symbol(r, f): ("sua-"[r], f) for r in range(4) for f in _FAULTS}


@dataclass(frozen=True)
class Matrix:
    """Min-plus costs between states; for each entry the state passed between the two
    parts (of a base symbol: the audit itself), and its audit's rank among those from the
    same state."""

    cost: tuple[tuple[int, ...], ...]
    via: tuple[tuple[object, ...], ...]
    rank: tuple[tuple[int, ...], ...]


def base_matrix(symbol: str) -> Matrix:
    role, fault = BASE[symbol]
    cost, via, rank = [], [], []
    for i in _STATES:
        best: dict[int, tuple[int, str]] = {}
        at = i
        for inserts in range(4):  # the fourth state comes again
            options = [(DELETE, "D", at)]
            if fault in ("ok", "truncated"):
                more = TRUNCATED if fault == "truncated" else 0
                options.append((REROLE + more, "R", _NEXT[at]))
                if (at, role) in _KEPT:
                    options.append((KEEP + more, "K", _KEPT[at, role]))
            for c, letter, to in options:
                found = (c + INSERT * inserts, "I" * inserts + letter)
                best[to] = min(best.get(to, (_NEVER, "")), found)
            at = _NEXT[at]
        order = {a: k for k, a in enumerate(sorted(a for _, a in best.values()))}
        cost.append(tuple(best[j][0] if j in best else _NEVER for j in _STATES))
        via.append(tuple(best[j][1] if j in best else None for j in _STATES))
        rank.append(tuple(order[best[j][1]] if j in best else -1 for j in _STATES))
    return Matrix(tuple(cost), tuple(via), tuple(rank))


def product(left: Matrix, right: Matrix) -> Matrix:
    cost, via, rank = [], [], []
    for i in _STATES:
        row = [min((left.cost[i][k] + right.cost[k][j], left.rank[i][k], k) for k in _STATES) for j in _STATES]
        ends = [j for j in _STATES if row[j][0] < _NEVER]
        ends.sort(key=lambda j: (row[j][1], right.rank[row[j][2]][j]))
        cost.append(tuple(row[j][0] if j in ends else _NEVER for j in _STATES))
        via.append(tuple(row[j][2] if j in ends else None for j in _STATES))
        rank.append(tuple(ends.index(j) if j in ends else -1 for j in _STATES))
    return Matrix(tuple(cost), tuple(via), tuple(rank))


class Grammar:
    """Rules (new symbol, left, right) and their matrices, bottom-up."""

    def __init__(self, rules: list[tuple[str, str, str]]) -> None:
        self.rules = rules
        self.sides = {new: (left, right) for new, left, right in rules}
        self.matrix = {s: base_matrix(s) for s in BASE}
        for new, left, right in rules:
            self.matrix[new] = product(self.matrix[left], self.matrix[right])
        # What can be reached from a state, so that a walk looks at nothing else.
        self.steps = {s: [[(j, m.cost[i][j], m.rank[i][j]) for j in _STATES if m.cost[i][j] < _NEVER] for i in _STATES] for s, m in self.matrix.items()}
        self.spelled: dict[tuple[str, int, int], str] = {}

    def compress(self, sequences: list[str]) -> list[str]:
        text = "\n".join(sequences)
        for new, left, right in self.rules:
            text = text.replace(left + right, new)
        return text.split("\n")

    def audit(self, symbol: str, i: int, j: int) -> str:
        """The rope of an entry, spelled out; entries met before are kept."""
        key = (symbol, i, j)
        if key not in self.spelled:
            via = self.matrix[symbol].via[i][j]
            if symbol in self.sides:
                left, right = self.sides[symbol]
                self.spelled[key] = self.audit(left, i, via) + self.audit(right, via, j)
            else:
                self.spelled[key] = via
        return self.spelled[key]

    def solve(self, compressed: str) -> tuple[int, str]:
        """(cost, audit) of a conversation."""
        if not compressed:
            return 0, ""
        now = {0: (0, 0)}  # state: cost, rank
        came: list[dict[int, int]] = []
        for symbol in compressed:
            steps, best = self.steps[symbol], {}
            for k, (c, r) in now.items():
                for j, more, inner in steps[k]:
                    found = (c + more, r, inner, k)
                    if j not in best or found[:2] < best[j][:2]:
                        best[j] = found
            order = sorted(best, key=lambda j: best[j][1:3])
            now = {j: (best[j][0], order.index(j)) for j in best}
            came.append({j: b[3] for j, b in best.items()})
        cost, _, state = min((c + INSERT * len(_FINAL[j]), r, j) for j, (c, r) in now.items())
        parts, j = [_FINAL[state]], state
        for symbol, back in zip(reversed(compressed), reversed(came)):
            parts.append(self.audit(symbol, back[j], j))
            j = back[j]
        return cost, "".join(reversed(parts))


_AS_ROLES = str.maketrans({s: role for s, (role, _) in BASE.items()})
_OF_FAULT = {f: [s for s, (_, g) in BASE.items() if g == f] for f in _FAULTS}


def faults(sequence: str) -> tuple[int, int, int, int]:
    """blank, duplicate, truncated, illegal."""
    roles = sequence.translate(_AS_ROLES)
    legal = roles.count("su") + roles.count("ua") + roles.count("au")
    return (*(sum(sequence.count(s) for s in _OF_FAULT[f]) for f in _FAULTS[1:]), max(0, len(roles) - 1) - legal)


def rows_of(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies. Null roles and texts are one space."""
    space = F.lit(" ")
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), space).alias(n) for c, n in ((role_col, "role"), (text_col, "text")))
    return df.select(F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), role, text, F.lit(1).cast("bigint").alias("copies"))


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` with one in four rows dropped (no copies), emptied, without its ends of
    sentences, repeated (two copies) or given to the user, by the checksum of id and turn."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", _ENDS, "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1) * F.col("copies")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


_ORDER = ("conv_id", "turn", "role", "h")


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("h", F.unhex(F.md5("text")))


def symbols(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, h (the text's hash), n, one, more: rows that are alike are one
    row of ``n``; the symbol of the first and of the others."""
    end = F.rtrim(F.col("text"), F.lit(_SPACE))
    state = F.when(end == "", "blank").when(F.right(end, F.lit(1)).isin(*_ENDS), "ok").otherwise("truncated")
    narrow = _hashed(rows).select(*_ORDER, state.alias("state"), "copies")
    alike = narrow.groupBy(*_ORDER, "state").agg(F.sum("copies").alias("n"))
    # The first row of a role and text; nulls come first, as in the order of turns.
    turn = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    firsts = alike.where("n > 0").groupBy("conv_id", "role", "h").agg(F.min(turn).alias("t"))
    firsts = firsts.select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "h")], F.col("t.turn").alias("_turn"), F.lit(True).alias("first"))
    # Every row of either side has another key, so no key is hot.
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _ORDER]
    marked = alike.join(firsts, same[0] & same[1] & same[2] & same[3], "left")
    initial = F.when(F.col("role") == "", 0).otherwise(F.instr(F.lit(_ROLES), F.left("role", F.lit(1))))
    role = F.when(initial == 0, 3).otherwise(initial - 1)

    def symbol(fault: Column) -> Column:
        place = F.array_position(F.array(*map(F.lit, _FAULTS)), fault).cast("int") - 1
        return F.char(F.lit(ord("A")) + role * 4 + place)

    blank = F.col("state") == "blank"
    one = F.when(blank | F.col("first"), F.col("state")).otherwise("duplicate")
    return marked.select(*_ORDER, "n", symbol(one).alias("one"), symbol(F.when(blank, "blank").otherwise("duplicate")).alias("more"))


def sequences(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, gaps, seq (the symbols in order) of every conversation, as a written table.

    Rows are ordered by turn, nulls first, then by role and by the text's hash.
    """
    dealt = symbols(rows).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    kind = dealt.schema["conv_id"].dataType
    spark_schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL("turn bigint, role string, h binary, i bigint, seq string, n_turns bigint, first_turn bigint, last_turn bigint")])
    schema = to_arrow_schema(spark_schema)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        parts: list[str] = []
        head: tuple = ()  # conv_id, turn, role, h, i of the chunk's first row
        size = n_turns = 0
        first = last = None

        def close() -> None:
            nonlocal size, n_turns, first, last
            if head:
                out.append((*head, "".join(parts), n_turns, first, last))
            parts.clear()
            size = n_turns = 0
            first = last = None

        for b in batches:
            for conv, turn, role, h, n, one, more in zip(*(b.column(c).to_pylist() for c in (*_ORDER, "n", "one", "more"))):
                if not head or conv != head[0]:
                    close()
                    head = (conv, turn, role, h, 0)
                if n and turn is not None and turn != last:
                    first = turn if first is None else first
                    last = turn
                    n_turns += 1
                at = 0
                while at < n:  # a row's copies may fill many chunks
                    if size >= chunk:
                        close()
                        head = (conv, turn, role, h, at)
                        if turn is not None:
                            first = last = turn
                            n_turns = 1
                    take = min(n - at, chunk - size)
                    parts.append(one + more * (take - 1) if at == 0 else more * take)
                    size += take
                    at += take
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out))), schema=schema)
                    out = []
        close()
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out))), schema=schema)

    chunks = dealt.mapInArrow(run, spark_schema)
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "role", "h", "i", "seq", "n_turns", "first_turn", "last_turn")
    lists = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list(place)).alias("c"))
    # A turn that a cut runs through counts once.
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("last"))

    def add(acc: Column, c: Column) -> Column:
        again = F.coalesce((c["first_turn"] == acc["last"]).cast("bigint"), F.lit(0))
        return F.struct((acc["n"] + c["n_turns"] - again).alias("n"), F.coalesce(c["last_turn"], acc["last"]).alias("last"))

    low = F.array_min(F.transform("c", lambda c: c["first_turn"]))
    high = F.array_max(F.transform("c", lambda c: c["last_turn"]))
    gaps = F.coalesce(high - low + 1 - F.aggregate("c", start, add)["n"], F.lit(0))
    seq = F.array_join(F.transform("c", lambda c: c["seq"]), "")
    return stored(lists.select("conv_id", gaps.alias("gaps"), seq.alias("seq")), "symbols")


def _pairs(b: pa.RecordBatch) -> dict:
    counts: Counter[str] = Counter()
    for seq, weight in zip(b.column("seq").to_pylist(), b.column("weight").to_pylist()):
        for pair in {x + y for x, y in zip(seq, seq[1:])}:
            counts[pair] += weight * seq.count(pair)
    return {"pair": list(counts), "n": list(counts.values())}


def re_pair(seqs: DataFrame, max_rules: int = MAX_RULES) -> list[tuple[str, str, str]]:
    """Rules (new symbol, left, right) for the sequences of ``seq``, in the order to apply
    them. Each round takes the most frequent pairs that share no symbol with one taken
    before; it ends when no pair occurs twice, or with ``max_rules``, which bounds what the
    driver holds."""
    spark = seqs.sparkSession
    table, place = stored_at(seqs.groupBy("seq").agg(F.count(F.lit(1)).alias("weight")).where(F.length("seq") > 1), "re-pair")
    rules: list[tuple[str, str, str]] = []
    while len(rules) < max_rules:
        counts = map_rows(table, _pairs, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(max_rules).collect()
        taken: set[str] = set()
        fresh = []
        for r in top:
            if len(rules) + len(fresh) < max_rules and not taken & set(r["pair"]):
                taken |= set(r["pair"])
                fresh.append((chr(0x100 + len(rules) + len(fresh)), *r["pair"]))
        if not fresh:
            break
        rules += fresh
        seq = F.col("seq")
        for new, left, right in fresh:
            seq = F.replace(seq, F.lit(left + right), F.lit(new))
        after, there = stored_at(table.select(seq.alias("seq"), "weight").where(F.length("seq") > 1), "re-pair")
        drop_stored(spark, place)
        table, place = after, there
    drop_stored(spark, place)
    return rules


@dataclass(frozen=True)
class Repair:
    """Rows and, for each conversation, what is wrong and the edits that mend it:
    ``plan`` has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""

    rows: DataFrame
    plan: DataFrame


def plan_repairs(rows: DataFrame, max_rules: int = MAX_RULES) -> Repair:
    """The cheapest edits for every conversation of ``rows`` (see ``rows_of``).

    Conversations whose rows have no copies have zeros and an empty audit. Rows without an id
    are one conversation; null turns come first. Rows of one turn are ordered by role and
    text hash; repeated rows are duplicates. An empty table gives an empty one.
    """
    seqs = sequences(rows)
    rules = re_pair(seqs.select("seq"), max_rules)
    kind = seqs.schema["conv_id"].dataType.simpleString()
    held: list[Grammar] = []

    def fn(b: pa.RecordBatch) -> dict:
        if not held:
            held.append(Grammar(rules))
        grammar = held[0]
        found = b.column("seq").to_pylist()
        different = list(set(found))
        solved = {s: (*faults(s), *grammar.solve(c)) for s, c in zip(different, grammar.compress(different))}
        columns = list(zip(*(solved[s] for s in found)))
        return {"conv_id": b.column("conv_id"), "gaps": b.column("gaps"), **dict(zip(("blank", "duplicate", "truncated", "illegal", "cost", "audit"), columns))}

    ddl = f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
    return Repair(rows, stored(map_rows(seqs, fn, ddl), "repair-plan"))


_PLAN = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, plan, None) where a conversation begins, then (conv, role, text) for each of
    its repaired rows, roles and texts as bytes."""
    conv, audit, at, state = None, "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _NEXT[state]
            yield conv, "I", b"user" if state == 2 else b"assistant", b""

    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("conv_id", "copies", "role", "body", *_PLAN)]
        for new, copies, role, body, *plan in zip(*columns):
            if copies is None:  # the plan comes before the rows
                yield from inserted()
                conv, audit, at, state = new, plan[-1], 0, 0
                yield conv, None, plan, None
                continue
            for _ in range(copies):
                yield from inserted()
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = _KEPT[state, role[:1]]
                    yield conv, edit, role.encode(), body
                elif edit == "R":
                    state = _NEXT[state]
                    yield conv, edit, b"user" if state == 2 else b"assistant", body
    yield from inserted()


def _stream(repair: Repair) -> DataFrame:
    """Every conversation's plan and rows, one after the other in one task."""
    rows = _hashed(repair.rows).where("copies > 0").select("conv_id", "turn", "role", "h", "copies", F.col("text").cast("binary").alias("body"))
    both = repair.plan.unionByName(rows, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("copies").isNotNull(), "turn", "role", "h")


def mended(repair: Repair) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""
    dealt = _stream(repair)
    kind = dealt.schema["conv_id"].dataType
    spark_schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL("place bigint, edit string, role string, text string")])
    schema = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place = [], 0
        for conv, edit, role, body in _mended(batches):
            if edit is None:
                place = 0
                continue
            out.append((conv, place, edit, role.decode(), body.decode("utf-8", "replace")))
            place += 1
            if len(out) == 2000:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out))), schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out))), schema=schema)

    return dealt.mapInArrow(run, spark_schema)


def digest(repair: Repair) -> DataFrame:
    """The plan of every conversation and repaired_sha256, the hash of its repaired rows as
    ``role:text`` lines; the rows pass as a stream."""
    dealt = _stream(repair)
    kind = dealt.schema["conv_id"].dataType
    spark_schema = T.StructType([T.StructField("conv_id", kind), *[repair.plan.schema[c] for c in _PLAN], T.StructField("repaired_sha256", T.StringType())])
    schema = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        open_: list = []  # conv_id and plan, and the hash so far
        for conv, edit, role, body in _mended(batches):
            if edit is None:
                if open_:
                    out.append((*open_[0], open_[1].hexdigest()))
                open_ = [(conv, *role), hashlib.sha256(), False]
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out))), schema=schema)
                    out = []
                continue
            open_[1].update(b"\n" + role + b":" if open_[2] else role + b":")
            open_[1].update(body)
            open_[2] = True
        if open_:
            out.append((*open_[0], open_[1].hexdigest()))
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out))), schema=schema)

    return dealt.mapInArrow(run, spark_schema)
