"""Secret scans: credential patterns, and weak parts linked by an interval join within scopes.

Strong spans (assignments, access keys, long hexadecimal runs) are always reported.
Weak parts - identifiers, bare high-entropy words, endpoints - are reported only when a
complementary part stands in the same scope within ``reach`` code points: a bare word
or an endpoint needs an identifier or an access key, an identifier needs a secret
(an assignment, a hexadecimal run or a bare word). A scope is a paragraph: text between
blank lines.

All of it is DataFrame functions. Regular expressions give matches and the text between
them; running sums of their lengths give positions in code points, in blocks of ``BLOCK``
matches, so that the work follows the number of matches. Parts and scopes are found in one
pass over the texts and written; both sides of the join read them there. The interval join
matches parts on document, scope and a bucket of ``reach`` code points (and its
neighbours), so a document of any length spreads over many keys and a part meets only
parts within twice its reach. Parts are at least six code points, which bounds the
partners of a part by the reach.

Defined cases: a null text counts as empty and has no spans; repeated rows each get
their row; a null id is an id like any other; an empty table gives no rows; columns
named as the added ones are replaced; other columns must be of kinds that Parquet holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import written
from tidemart.operators.projections import once

REACH = 160
#: Elements of an array that are walked together; a walk copies what it gives at each step.
BLOCK = 256

# The contract's patterns; letters of keywords in either case are spelled
# out, so that no engine's case folding beyond ASCII takes part.


def either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.isalpha() else c for c in words)


ASSIGN = "(" + either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"  # a run of 18 or more characters in all; a shorter one cannot match at a later AKIA either
HEX = "[0-9a-f]{16,}"
IDENT = either_case("client_?id|account_?id|access_?key_?id|username") + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{6,}"""
BARE = r"[A-Za-z0-9+/]{32,}"
ENDPOINT = r"(?:https?|ftp|wss?|s3|jdbc|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9][A-Za-z0-9./:_%-]{4,}"
SCOPE = r"\n[\x20\x09]*\n"
#: Kinds in the order that breaks ties between spans of one start.
KINDS = ("assign", "access", "hex", "ident", "bare", "endpoint")
_PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "ident": IDENT, "bare": BARE, "endpoint": ENDPOINT}
FIRST_WEAK = 3
#: Roles that a weak part of a kind needs beside it.
NEEDS = {"ident": ("assign", "hex", "bare"), "bare": ("access", "ident"), "endpoint": ("access", "ident")}


_SPAN = "array<struct<start:int,kind:int,end:int>>"
_SCOPED = "array<struct<start:int,kind:int,end:int,scope:int>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression that uses a value several times and computes it once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _walked(
    items: Column, advance: Callable[[Column, Column], Column], of_block: Callable[[Column, Column], Column]
) -> Column:
    """What a walk over an array gives, block after block.

    ``advance`` takes the walk's number (from 0) past an element; ``of_block`` gives the array
    of a block from the number at its start.
    """

    def cut(array: Column) -> Column:
        last = F.call_function("div", F.size(array) - 1, F.lit(BLOCK)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(array, b * BLOCK + 1, F.lit(BLOCK)))

    def joined(blocks: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(blocks, first, lambda done, block: F.struct(
            F.aggregate(block, done["at"], advance).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts")))
        return F.flatten(F.zip_with(starts["starts"], blocks, of_block))

    return _let(_let(items, cut), joined)


def _collected(
    block: Column, at: Column, kind: str, advance: Callable[[Column, Column], Column], give: Callable[[Column, Column], Column]
) -> Column:
    """The arrays (of ``kind``) that the elements of a block give, from the number before each of them."""
    first = F.struct(at.alias("at"), F.array().cast(kind).alias("out"))
    return F.aggregate(block, first, lambda done, x: F.struct(
        advance(done["at"], x).alias("at"), F.concat(done["out"], give(done["at"], x)).alias("out")))["out"]


def spans_of(text: Column, kind: str, passes: Callable[[Column], Column] | None = None) -> Column:
    """Array of (start, kind, end) of a pattern's matches whose text passes a test."""
    pattern = _PATTERNS[kind]
    return _spans(text, pattern, F.lit(KINDS.index(kind)), passes)


def _spans(text: Column, pattern: str, kind: Column, passes: Callable[[Column], Column] | None) -> Column:
    nothing = F.array().cast(_SPAN)

    def paired(matches: Column) -> Column:
        return F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)),
            matches,
            lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("n"), match.alias("text")),
        )

    def advance(at: Column, x: Column) -> Column:
        return at + x["gap"] + x["n"]

    def give(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        here = F.array(F.struct(start.alias("start"), kind.alias("kind"), (start + x["n"]).alias("end")))
        return here if passes is None else F.when(passes(x["text"]), here).otherwise(nothing)

    pairs = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), paired)
    found = _walked(pairs, advance, lambda at, block: _collected(block, at, _SPAN, advance, give))
    return F.when(text.rlike(pattern), found).otherwise(nothing)


def all_parts(text: Column) -> Column:
    """The matches of every kind that pass the kind's own test."""
    passes = {
        "assign": lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12,
        "bare": lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]"),
    }
    return F.concat(*[spans_of(text, k, passes.get(k)) for k in KINDS])


def _in_scopes(parts: str, scopes: str) -> Column:
    """Parts with the number of scope borders that end at or before them."""
    border = F.lit(-1)
    ends = F.transform(scopes, lambda end: F.struct(end.alias("start"), border.alias("kind"), end.alias("end")))

    def advance(n: Column, x: Column) -> Column:
        return n + (x["kind"] == border).cast("int")

    def give(n: Column, x: Column) -> Column:
        here = F.array(F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), n.alias("scope")))
        return F.when(x["kind"] == border, F.array().cast(_SCOPED)).otherwise(here)

    return _walked(F.array_sort(F.concat(parts, ends)), advance, lambda n, block: _collected(block, n, _SCOPED, advance, give))


def linked(rows: DataFrame, reach: int = REACH) -> DataFrame:
    """(__key, __found): the weak parts with a complementary part in reach, per document key.

    ``rows`` has ``__key``, ``__parts`` and ``__scopes`` (ends of the scope borders).
    """
    needs = F.array(*[F.array(*[F.lit(KINDS.index(r)) for r in NEEDS.get(k, ())]).cast("array<int>") for k in KINDS])
    part = rows.distinct().select("__key", F.explode(_in_scopes("__parts", "__scopes")).alias("p")).select(
        "__key", "p.*", F.floor(F.col("p.start") / reach).alias("bucket"))
    weak = part.filter(F.col("kind") >= FIRST_WEAK).withColumns({
        "needs": F.element_at(needs, F.col("kind") + 1),
        "bucket": F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)),
    })
    other = part.select(
        "__key", "scope", "bucket", F.col("start").alias("o_start"), F.col("kind").alias("o_kind"), F.col("end").alias("o_end")
    )
    near = F.abs(F.col("o_start") - F.col("start")) <= reach
    apart = (F.col("o_end") <= F.col("start")) | (F.col("end") <= F.col("o_start"))
    met = weak.join(other, ["__key", "scope", "bucket"]).filter(near & apart & F.array_contains("needs", F.col("o_kind")))
    return met.groupBy("__key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("__found"))


def with_parts(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Documents with a ``__key`` of their own parts, all ``__parts``, the ``__scopes`` and whether a join can add any (``__weak``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    columns = [c for c in docs.columns if c.lower() not in ("base", "spans") and (keep_text or c != text_col)]
    weak = F.exists("__parts", lambda p: p["kind"] >= FIRST_WEAK) & (F.size("__parts") > 1)
    borders = F.transform(_spans(text, SCOPE, F.lit(0), None), lambda s: s["end"])
    parted = once(docs, __parts=all_parts(text)).withColumn("__weak", weak)
    scoped = once(parted, __scopes=F.when(F.col("__weak"), borders).otherwise(F.array().cast("array<int>")))
    # Documents that need no join get keys of their own, so that they spread over all tasks.
    key = F.when(F.col("__weak"), F.sha2(F.to_json(F.struct("__parts", "__scopes")), 256)).otherwise(
        F.concat(F.lit("-"), F.xxhash64(*[c for c in columns if not _nested(docs, c)]).cast("string"))
    )
    return scoped.select(*columns, key.alias("__key"), "__weak", "__parts", "__scopes")


def find_secrets(docs: DataFrame, text_col: str = "text", reach: int = REACH, keep_text: bool = True) -> DataFrame:
    """Documents with ``base`` and ``spans``: sorted arrays of (start, kind number, end); without the text if so told."""
    keyed = written(with_parts(docs, text_col, keep_text), "secret-parts")
    columns = [c for c in keyed.columns if not c.startswith("__")]
    found = linked(keyed.filter("__weak").select("__key", "__parts", "__scopes"), reach)
    base = F.array_sort(F.filter("__parts", lambda p: p["kind"] < FIRST_WEAK))
    spans = F.array_sort(F.concat(F.filter("__parts", lambda p: p["kind"] < FIRST_WEAK), F.coalesce("__found", F.array().cast(_SPAN))))
    return keyed.join(found, "__key", "left").select(*columns, base.alias("base"), spans.alias("spans"))


def _nested(df: DataFrame, column: str) -> bool:
    return "map<" in dict(df.dtypes)[column]


def listed(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redacted(docs: DataFrame, mark: str = "[REDACTED]", reach: int = REACH) -> DataFrame:
    """Documents with every reported span replaced by ``mark``; overlapping spans are replaced together.

    All columns stay; ``n_chars``, where there is one, follows a changed text.
    """
    found = find_secrets(docs, "text", reach)
    text = F.col("text")

    def advance(at: Column, s: Column) -> Column:
        return F.greatest(at, s["end"])

    def of_block(at: Column, block: Column) -> Column:
        """Kept texts and marks of a block of spans, cut from the block's own stretch of the text."""

        def cut(stretch: Column) -> Column:
            def give(now: Column, s: Column) -> Column:
                kept = F.substring(stretch, now - at + 1, s["start"] - now)
                return F.when(s["start"] >= now, F.array(kept, F.lit(mark))).otherwise(F.array().cast("array<string>"))

            return _collected(block, at, "array<string>", advance, give)

        return _let(F.substring(text, at + 1, F.aggregate(block, at, advance) - at), cut)

    changed = F.size("spans") > 0
    clean = once(found, __pieces=F.when(changed, _walked(F.col("spans"), advance, of_block)))
    rest = F.substring(text, F.array_max(F.transform("spans", lambda s: s["end"])) + 1, F.length(text))
    clean = clean.withColumn("text", F.when(changed, F.concat(F.array_join("__pieces", ""), rest)).otherwise(text))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)
