"""Conversations of many layouts as one chat template with a loss mask.

A record is a variant value. The paths of its fields, without their types and without
their values, are its shape; the shape's hash picks the layout, a declared mapping from
fields to turns. A record whose shape no layout has keeps its place with null turns, and
``survey`` counts records by shape, so that a mapping can be declared for what is there.

Turns are rendered as

    <|im_start|>role
    text<|im_end|>

with one line feed after each. Inside roles and texts a backslash is put between the ``<``
and the ``|`` of anything that could be taken for a control string; one that has
backslashes there already gets one more, so taking one away restores it. In roles, ``%``
and the line feed are written as ``%25`` and ``%0A``. Everything is built from DataFrame
functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
LEARNED = ("assistant",)  # roles under the loss mask

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Said:
    """One turn from the values at ``paths``, joined by an empty line; no turn if all of
    them are null or, but for ``always``, empty."""

    role: str
    paths: tuple[str, ...]
    always: bool = False


@dataclass(frozen=True)
class Layout:
    """How records of one shape become turns.

    ``parts`` are turns of single fields. ``each`` is a list whose elements are turns, with
    the fields ``role`` and ``text`` in them; ``texts`` is set if ``text`` is again a list,
    of which it names the field with the text. ``roles`` renames roles. ``optional`` paths
    may be there or not, and are read if a part or ``order`` names them. ``order`` is the
    place of the record in its conversation, if a conversation has several.
    """

    name: str
    parts: tuple[Said, ...] = ()
    each: str = ""
    role: str = "role"
    text: str = "content"
    texts: str = ""
    roles: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    others: tuple[str, ...] = ()
    order: str = ""

    def shapes(self) -> list[str]:
        """The shapes this mapping is for: with each choice of optional paths, and with an
        empty list of turns."""
        inside = [self.role, f"{self.text}[].{self.texts}" if self.texts else self.text]
        named = [p for s in self.parts for p in s.paths] + list(self.others) + ([self.order] if self.order else [])
        fixed = [p for p in named if p not in self.optional]
        listed = [f"{self.each}[].{p}" for p in inside] if self.each else []
        found = []
        for n in range(len(self.optional) + 1):
            for chosen in combinations(self.optional, n):
                found.append(shape_of([*fixed, *chosen, *listed]))
                if self.each and not any(c.startswith(f"{self.each}[].") for c in chosen):
                    found.append(shape_of([*fixed, *chosen, f"{self.each}[]"]))
        return found


_CHAT_ROLES = (("human", "user"), ("prompter", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))

ROW = Layout("row", others=("role", "text"), order="turn")
LAYOUTS = (
    ROW,
    Layout("messages", each="messages", roles=_CHAT_ROLES, optional=("messages[].name", "messages[].weight", "system"), parts=(Said("system", ("system",)),)),
    Layout("message_parts", each="messages", texts="text", others=("messages[].content[].type",), roles=_CHAT_ROLES),
    Layout("from_value", each="conversations", role="from", text="value", roles=_CHAT_ROLES, optional=("system",), parts=(Said("system", ("system",)),)),
    Layout("prompt_completion", parts=(Said("user", ("prompt",), True), Said("assistant", ("completion",), True))),
    Layout("prompt_response", parts=(Said("system", ("system",)), Said("user", ("prompt",), True), Said("assistant", ("response",), True)), optional=("system",)),
    Layout("instruction", parts=(Said("system", ("system",)), Said("user", ("instruction", "input"), True), Said("assistant", ("output",), True)), optional=("system", "input")),
    Layout("question_answer", parts=(Said("user", ("context", "question"), True), Said("assistant", ("answer",), True)), optional=("context",)),
)


def shape_of(paths: Sequence[str]) -> str:
    """The shape of a record with fields at ``paths``: names in order, ``[]`` for a list."""
    tree: dict = {}
    for p in paths:
        at = tree
        for step in p.replace("[]", ".[]").split("."):
            at = at.setdefault(step, {})

    def text(node: dict) -> str:
        if "[]" in node:
            return f"ARRAY<{text(node['[]'])}>"
        return "OBJECT<" + ", ".join(f"{k}: {text(node[k])}" for k in sorted(node)) + ">" if node else ""

    return text(tree)


def shape(record: Column) -> Column:
    """The shape of a variant; lists of unlike things stay ``VARIANT``."""
    scalar = r"(?:STRING|BIGINT|BOOLEAN|DOUBLE|FLOAT|DATE|TIMESTAMP(?:_NTZ)?|BINARY|UUID|VOID|DECIMAL\([0-9]+,[0-9]+\))"
    return F.regexp_replace(F.schema_of_variant(record), rf"(?:(?<=: )|(?<=ARRAY<)){scalar}(?=[,>])", "")


def _turns(record: Column, layout: Layout) -> Column:
    """The turns of a record of ``layout``."""
    if layout == ROW:
        said = F.struct(F.variant_get(record, "$.role", "string").alias("role"), F.variant_get(record, "$.text", "string").alias("text"))
        return F.array(said).cast(TURNS)
    found = []
    for s in layout.parts:
        values = [F.try_variant_get(record, f"$.{p}", "string") for p in s.paths]
        filled = F.filter(F.array(*values), lambda v: v != "")  # noqa: PLC1901 (a column)
        one = F.array(F.struct(F.lit(s.role).alias("role"), F.concat_ws("\n\n", filled).alias("text"))).cast(TURNS)
        found.append(one if s.always else F.when(F.size(filled) > 0, one).otherwise(F.array().cast(TURNS)))
    if layout.each:
        inner = f"array<struct<`{layout.texts}`:string>>" if layout.texts else "string"
        listed = F.try_variant_get(record, f"$.{layout.each}", f"array<struct<`{layout.role}`:string,`{layout.text}`:{inner}>>")
        renamed = F.create_map(*[F.lit(x) for pair in layout.roles for x in pair]) if layout.roles else None

        def turn(t: Column) -> Column:
            role, text = t[layout.role], t[layout.text]
            if layout.texts:
                text = F.array_join(F.transform(text, lambda x: x[layout.texts]), "")
            return F.struct((F.coalesce(renamed[role], role) if renamed is not None else role).alias("role"), text.alias("text"))

        found.append(F.coalesce(F.transform(listed, turn), F.array()).cast(TURNS))
    return F.concat(*found)


def map_layouts(records: DataFrame, id_col: str = "conv_id", record_col: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, fingerprint (the hash of the shape), shape, layout, place, turns.

    ``record_col`` is a variant, or text with JSON. Text that is no JSON and null have a
    null shape; they and shapes without a layout have null layout and turns. No row goes.
    Other columns are not looked at. An empty table gives an empty one.
    """
    kind = dict(records.dtypes)[record_col]
    record = F.col(f"`{record_col}`")
    base = records.select(F.col(f"`{id_col}`").alias("conv_id"), (record if kind == "variant" else F.try_parse_json(record.cast("string"))).alias("_r"))
    known = {}
    for layout in layouts:
        for s in layout.shapes():
            if known.setdefault(s, layout.name) != layout.name:
                raise ValueError(f"layouts {known[s]} and {layout.name} are for the same shape {s}")
    chosen = F.create_map(*[c for s, name in known.items() for c in (F.xxhash64(F.lit(s)), F.lit(name))])
    base = base.withColumn("shape", shape(F.col("_r"))).withColumn("fingerprint", F.when(F.col("shape").isNotNull(), F.xxhash64("shape")))
    base = base.withColumn("layout", F.when(F.col("fingerprint").isNotNull(), chosen[F.col("fingerprint")]))

    def by_layout(value) -> Column:  # noqa: ANN001
        return reduce(lambda c, x: c.when(F.col("layout") == x.name, value(x)), layouts[1:], F.when(F.col("layout") == layouts[0].name, value(layouts[0])))

    place = by_layout(lambda x: F.try_variant_get("_r", f"$.{x.order}", "bigint") if x.order else F.lit(None).cast("bigint"))
    return base.select("conv_id", "fingerprint", "shape", "layout", place.alias("place"), by_layout(lambda x: _turns(F.col("_r"), x)).alias("turns"))


def survey(records: DataFrame, id_col: str = "conv_id", record_col: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """fingerprint, shape, layout and the number of records of each, also of those that no
    layout has."""
    mapped = map_layouts(records, id_col, record_col, layouts)
    return mapped.groupBy("fingerprint", "shape", "layout").agg(F.count(F.lit(1)).alias("n_records"))


def row_records(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A table of one row a turn as records of the layout ``row``: conv_id, record."""
    fields = F.struct(F.col(f"`{turn_col}`").cast("bigint").alias("turn"), F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return df.select(F.col(f"`{id_col}`").alias("conv_id"), F.to_variant_object(fields).alias("record"))


def conversations(mapped: DataFrame) -> DataFrame:
    """conv_id and turns of each conversation, from the mapped records.

    Records are ordered by place, nulls first, and by their turns where places are equal;
    repeated records stay. Null roles and texts become empty ones. Records without a
    layout add no turn. Rows without an id are one conversation. A conversation is one
    value, as its formatted text is.
    """
    record = F.struct("place", F.coalesce("turns", F.array().cast(TURNS)).alias("turns"))
    ordered = F.sort_array(F.collect_list(record))
    flat = F.flatten(F.transform(ordered, lambda r: r["turns"]))
    clean = F.transform(flat, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return mapped.groupBy("conv_id").agg(clean.alias("turns"))


def escape(text: Column) -> Column:
    """``text`` without control strings; :func:`unescape` restores it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(convs: DataFrame, learned: Sequence[str] = LEARNED) -> DataFrame:
    """conv_id, formatted, segments: the formatted text, and the same text in segments of
    (text, loss). Loss is true for the texts of ``learned`` roles and for nothing else. A
    conversation without turns is an empty text."""

    def segments(t: Column) -> Column:
        def segment(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        head = F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))
        return F.array(segment(head, F.lit(False)), segment(escape(t["text"]), t["role"].isin(*learned)), segment(F.lit(f"{END}\n"), F.lit(False)))

    made = convs.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"))
    return made.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse(formatted: Column) -> Column:
    """The turns of a formatted text."""
    pieces = F.filter(F.split(formatted, START.replace("|", r"\|")), lambda p, i: i > 0)  # the first is empty

    def turn(p: Column) -> Column:
        # A role holds no line feed, and an escaped text no control string.
        role = F.substring_index(p, "\n", 1)
        text = F.substring(p, F.char_length(role) + 2, F.char_length(p) - F.char_length(role) - len(END) - 2)
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def format_records(records: DataFrame, id_col: str = "conv_id", record_col: str = "record", layouts: Sequence[Layout] = LAYOUTS, learned: Sequence[str] = LEARNED) -> DataFrame:
    """Records of any declared layouts as formatted conversations: conv_id, formatted,
    segments."""
    return render(conversations(map_layouts(records, id_col, record_col, layouts)), learned)


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    read = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), F.array_join(loss, "").alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
