"""Personal data: base patterns, and bootstrapped contextual extraction beside them.

The base kinds are found by regular expressions. They seed the bootstrap: the words in
front of an entity are its contexts, and a graph joins contexts (patterns) to the
identifier-like texts that occur behind them (instances): words with a digit or an @, names
and hosts around a bracketed "at", and runs of digit groups with blanks or brackets. Round by round a pattern scores
the share of its instances that are known to be of a kind, and an instance scores what
its confident patterns say; instances that reach the threshold are new entities of that
kind wherever they occur. Everything is built from DataFrame functions.

Positions come from splitting: between two matches lies a gap, so the running sum of the
lengths of gaps and matches is where a match ends, in code points. The spans are rows of
a written table, a few for each document; the texts themselves are never shuffled.

The expressions are written so that Java's engine needs time in proportion to the text:
possessive where nothing can be given back, and a match may only begin where a run of its
first characters begins or the match before ended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, stored

KINDS = ("email", "ip", "card", "phone")

# What each base kind looks like.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Identifier-like texts: a run without white space that has a digit or an @; two words around
# an "at" in brackets, with a blank on either side or none; digit groups with one or two blanks
# between, of which none goes on as a word.
_SHAPES = {
    "word": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+",
    "at": r"(?<![^\x20\x09-\x0D])[(\[{<]*+[^\x20\x09-\x0D(\[{<@]++(?<=[\p{L}\p{N}])\x20?[(\[{<]\x20?(?:[Aa][Tt]|@)\x20?[)\]}>]\x20?[\p{L}\p{N}][^\x20\x09-\x0D]*+",
    "run": r"(?<![^\x20\x09-\x0D])[+(\[]*+[0-9][0-9().\[\]/-]*+(?:[\x20\xA0]{1,2}+[(\[]?+[0-9][0-9().\[\]/-]*+(?![\p{L}\p{N}@]))++",
}
# So many characters in front of a match are looked at for its contexts.
_LEFT = 80

_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Bootstrap:
    """Rounds and thresholds: a pattern needs ``min_known`` different known instances of a
    kind and ``min_precision`` of all its instances; an instance needs ``min_score``."""

    rounds: int = 3
    min_known: int = 5
    min_precision: float = 0.8
    min_score: float = 0.8
    min_chars: int = 5


def _found(kind: str) -> Column:
    """Array of (kind, i, gap, match, left) from the columns of ``_cut``: left is the text
    just before, for contexts."""
    matches, gaps = F.col(f"m_{kind}"), F.col(f"g_{kind}")

    def last(c: Column) -> Column:
        return F.substring(c, -_LEFT, _LEFT)

    # Where the gap is short, the gaps and matches before it come in front: each match has a
    # character at least, so a fixed number of them is enough. A run of digits too short for a
    # card is dropped later and needs none.
    def left(x: Column, i: Column) -> Column:
        near = (i > 0) & (F.char_length(x["g"]) < _LEFT)
        if kind == "card":
            near &= F.char_length(x["m"]) >= 16
        at, n = F.greatest(i - (_LEFT - 1), F.lit(1)), F.least(i, F.lit(_LEFT))
        pairs = F.zip_with(F.slice(gaps, at, n), F.slice(matches, at, n), lambda g, m: last(F.concat(last(g), last(m))))
        return last(F.when(near, F.concat(F.array_join(pairs, ""), x["g"])).otherwise(x["g"]))

    return F.transform(
        F.arrays_zip(matches.alias("m"), gaps.alias("g")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.char_length(x["g"]).cast("long").alias("gap"), x["m"].alias("match"), left(x, i).alias("left")),
    )


def _cut(kind: str, pattern: str, guard: Column) -> list[Column]:
    """The matches and the gaps, as columns, so that they are found once."""
    none = F.array().cast("array<string>")
    return [F.when(guard, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none).alias(f"m_{kind}"), F.when(guard, F.split("text", pattern, -1)).otherwise(none).alias(f"g_{kind}")]


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backward = F.reverse(digits)
    doubled = F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length(digits), F.lit(1))),
        lambda k: F.when(k % 2 == 1, F.substr(backward, k, F.lit(1)).cast("int")).otherwise(2 * F.substr(backward, k, F.lit(1)).cast("int") - F.when(F.substr(backward, k, F.lit(1)).cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.char_length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", match.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"))
        .when(kind == "card", F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(8, 15))
        .otherwise(False)
    )


def _spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, kind, start, end, match, left): base spans and candidates by shape, with
    one row of null kind for a document that has neither. Written once."""
    digit, at = F.col("text").rlike("[0-9]"), F.contains("text", F.lit("@"))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digit", digit).withColumn("at", at)
    guards = {"email": F.col("at"), "ip": F.col("digit"), "card": F.col("digit"), "phone": F.contains("text", F.lit("+")), "word": F.col("digit") | F.col("at"), "at": F.col("text").rlike(r"(?:[Aa][Tt]|@)\x20?[)\]}>]"), "run": F.col("digit")}
    patterns = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE, **_SHAPES}
    cut = numbered.select("row", "doc_id", *[c for k, p in patterns.items() for c in _cut(k, p, guards[k])])
    # The split leaves one gap more than there are matches; that last row has none.
    held = F.filter(F.concat(*map(_found, patterns)), lambda x: x["match"].isNotNull())
    found = cut.select("row", "doc_id", F.explode_outer(held).alias("s"))
    rows = stored(found.select("row", "doc_id", "s.kind", "s.i", "s.gap", "s.match", "s.left"), "pii-found")
    # Card runs are long lists of digits: only those that can pass go on, after the sum.
    run = Window.partitionBy("row", "kind").orderBy("i")
    size = F.char_length("match").cast("long")
    placed = rows.withColumn("end", F.sum(F.col("gap") + size).over(run)).withColumn("start", F.col("end") - size)
    keep = F.col("kind").isNull() | F.col("kind").isin(*_SHAPES) | _valid(F.col("kind"), F.col("match"))
    return stored(placed.select("row", "doc_id", F.when(keep, F.col("kind")).alias("kind"), "start", "end", "match", "left"), "pii-spans")


def _contexts(left: Column) -> Column:
    """The patterns of what stands before: its last word, and its last two."""
    low = F.lower(F.regexp_replace(left, "[0-9]", "0"))
    one = F.regexp_extract(low, r"([^\x20\x09-\x0D]{1,40})[\x20\x09-\x0D]*$", 1)
    two = F.regexp_extract(low, r"([^\x20\x09-\x0D]{1,40}[\x20\x09-\x0D]+[^\x20\x09-\x0D]{1,40})[\x20\x09-\x0D]*$", 1)
    return F.filter(F.array(F.concat(F.lit("1 "), one), F.concat(F.lit("2 "), two)), lambda p: F.char_length(p) > 2)


def _candidates(spans: DataFrame, min_chars: int) -> DataFrame:
    """Candidates that touch no base span, without the marks around them. Of those that begin
    together only the longest has a ``left``: one text behind a context is one instance."""
    by_start = Window.partitionBy("row").orderBy("start", "end")
    shaped = F.col("kind").isin(*_SHAPES)
    before = F.max(F.when(~shaped, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(~shaped, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    free = spans.where("kind is not null").withColumn("before", before).withColumn("after", after)
    words = free.where(shaped & F.coalesce(F.col("before") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("after") >= F.col("end"), F.lit(True)))
    # A bracket around the first digits belongs to them: (227) 555-9999.
    plain = F.regexp_extract("match", r"^[^\p{L}\p{N}+]*+", 0)
    opened = F.regexp_extract("match", r"^[^\p{L}\p{N}+]*?(?=[(\[][0-9]++[)\]].*[0-9])", 0)
    paired = F.col("match").rlike(r"^[^\p{L}\p{N}+]*?[(\[][0-9]++[)\]].*[0-9]")
    lead = F.char_length(F.when(paired, opened).otherwise(plain)).cast("long")
    trail = F.char_length(F.regexp_extract("match", r"[^\p{L}\p{N}]+$", 0)).cast("long")
    cut = words.withColumn("lead", lead).withColumn("trail", trail).where(F.char_length("match") - F.col("lead") - F.col("trail") >= min_chars)
    core = F.substr(F.col("match"), (F.col("lead") + 1).cast("int"), (F.char_length("match") - F.col("lead") - F.col("trail")).cast("int"))
    longest = F.max("end").over(Window.partitionBy("row", "start"))
    told = cut.withColumn("left", F.when(F.col("end") == longest, F.col("left")))
    return told.select("row", "doc_id", (F.col("start") + F.col("lead")).alias("start"), (F.col("end") - F.col("trail")).alias("end"), core.alias("instance"), "left").distinct()


def _discover(spans: DataFrame, s: Bootstrap) -> tuple[DataFrame, DataFrame]:
    """(candidates, entities): entities are (instance, kind, score) found by patterns."""
    words = stored(_candidates(spans, s.min_chars), "pii-words")
    known = spans.where(F.col("kind").isin(*KINDS)).select("kind", F.col("match").alias("instance"), "left")
    both = known.select("instance", "kind", "left").union(words.select("instance", F.lit(None).cast("string"), "left"))
    # One edge for each pattern and instance, however often copies repeat them.
    edges = stored(both.select(F.explode(_contexts(F.col("left"))).alias("pattern"), "instance", "kind").groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii-edges")
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    scores = edges.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    new = None
    for _ in range(s.rounds):
        gained = edges.select("pattern", "instance").join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("known"))
        good = gained.where(F.col("known") >= s.min_known).join(size, "pattern").withColumn("precision", F.col("known") / F.col("n")).where(F.col("precision") >= s.min_precision).select("pattern", "kind", "precision")
        unseen = edges.where("kind is null").select("pattern", "instance").join(scores.where("score = 1").select("instance").distinct(), "instance", "left_anti")
        # An instance is of a kind unless every confident pattern is wrong about it.
        miss = F.sum(F.log(F.greatest(1 - F.col("precision"), F.lit(1e-6))))
        told = unseen.join(good, "pattern").groupBy("instance", "kind").agg((1 - F.exp(miss)).alias("score"))
        rank = Window.partitionBy("instance").orderBy(F.col("score").desc(), "kind")
        new = stored(told.where(F.col("score") >= s.min_score).withColumn("r", F.row_number().over(rank)).where("r = 1").select("instance", "kind", "score"), "pii-entities")
        seeds = edges.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
        scores = seeds.union(new.where("score < 1").select("instance", "kind", "score"))
    return words, new


def find(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", settings: Bootstrap = Bootstrap()) -> DataFrame:
    """doc_id, base, found (arrays of kind, start, end, sorted by kind as in KINDS and
    start) for each row of ``df``; offsets are code points, ends exclusive.

    ``base`` holds the spans of the base patterns, ``found`` those the bootstrap adds; they
    never touch a base span, and none lies within another. Null and empty texts have none. Copies of a row have the
    same spans each; an empty table gives no rows. Other columns are not looked at.
    """
    spans = _spans(documents(df, id_col, text_col))
    words, entities = _discover(spans, settings)
    # A word within a longer candidate is not told of beside it.
    wider = Window.partitionBy("row").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    alone = words.join(entities, "instance").withColumn("until", F.max("end").over(wider)).where("until is null or until < end")
    added = alone.select("row", "kind", "start", "end", F.lit(False).alias("base"))
    base = spans.where(F.col("kind").isin(*KINDS)).select("row", "kind", "start", "end", F.lit(True).alias("base"))
    number = F.coalesce(*[F.when(F.col("kind") == k, F.lit(n)) for n, k in enumerate(KINDS)])
    span = F.struct(number.alias("n"), "start", "end", "kind")
    lists = base.union(added).groupBy("row").agg(F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("b"), F.sort_array(F.collect_list(F.when(~F.col("base"), span))).alias("f"))
    rows = spans.groupBy("row").agg(F.first("doc_id").alias("doc_id"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")

    def listed(c: str) -> Column:
        return F.coalesce(F.transform(c, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))), none)

    return rows.join(lists, "row", "left").select("doc_id", listed("b").alias("base"), listed("f").alias("found"))


def redact(df: DataFrame, spans: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with every span replaced by its kind in angle brackets, for tables
    whose ids differ; ``spans`` as from ``find``. Overlapping spans: the first wins. A null
    text stays null, an empty one empty, and one without spans as it is; an empty table
    gives no rows."""
    docs = documents(df, id_col, text_col)
    every = F.array_sort(F.transform(F.concat("base", "found"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    at = F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("out"))
    done = F.aggregate(
        "s",
        at,
        lambda a, x: F.when(x["start"] < a["end"], a).otherwise(F.struct(x["end"].alias("end"), F.concat(a["out"], F.substr(F.col("text"), (a["end"] + 1).cast("int"), (x["start"] - a["end"]).cast("int")), F.lit("<"), x["kind"], F.lit(">")).alias("out"))),
    )
    joined = docs.join(spans.select("doc_id", every.alias("s")), "doc_id", "left").withColumn("a", done)
    rest = F.concat(F.col("a.out"), F.substr(F.col("text"), (F.col("a.end") + 1).cast("int"), F.char_length("text")))
    return joined.select("doc_id", F.when(F.col("s").isNull(), F.col("text")).otherwise(rest).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The registered query's columns from those of ``find``."""

    def text(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    number = {k: n for n, k in enumerate(KINDS)}

    def place(x: Column) -> Column:
        return F.coalesce(*[F.when(x["kind"] == k, F.lit(n)) for k, n in number.items()])

    both = F.transform(
        F.array_sort(F.transform(F.concat("base", "found"), lambda x: F.struct(place(x).alias("n"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))),
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
    )
    def _is(kind: str):
        return lambda x: x["kind"] == kind

    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"), text(both).alias("spans"), F.size("found").cast("long").alias("n_found"))
