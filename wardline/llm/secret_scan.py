"""Secrets in text: patterns, and weak candidates that count only next to their complement.

Only DataFrame functions. Patterns are found while the table is scanned. Weak candidates (an access
identifier, a secret value, an endpoint, each too common to report alone) become rows and meet over
an interval join: within one document, a part is reported if what it lacks lies within reach: an identifier needs a
secret, a secret an identifier or an endpoint, and an endpoint a secret, unless it carries user and password itself.

Running sums over the matches of a text go block by block, so a text's work grows with its matches, not their square.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import let, store

# Kinds of the result's definition in their order, patterns, least characters of the group.
BASE_KINDS = [
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]

# Weak parts: (kind, role, pattern). A key identifier, a bare secret of 32 characters or more, a service endpoint with user
# and password, and one without. None has a most length: the rest of a longer part would be left in the text.
WEAK_KINDS = [
    ("identifier", "id", r"(?i:client|account|access|tenant|key|user)_?(?i:id|name)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]{4,}"),
    ("value", "secret", r"[A-Za-z0-9+/]{32,}={0,2}"),
    ("endpoint", "whole", r"(?:https?|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._-]+:[A-Za-z0-9._-]+@[A-Za-z0-9._:@-]{4,}"),
    ("endpoint", "endpoint", r"(?:https?|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._:@-]{4,}"),
]
BASE_ROLES = ["secret", "id", "hash"]
ROLES = BASE_ROLES + [role for _, role, _ in WEAK_KINDS]
# For each role of a weak part, sets of roles of which one has to lie within reach as a whole.
# Hex strings are as often names of commits as keys, so for an endpoint one counts only beside an identifier.
NEEDS = {
    "id": [{"secret"}, {"hash"}],
    "secret": [{"id"}, {"endpoint"}, {"whole"}],
    "endpoint": [{"secret"}, {"id", "hash"}],
    "whole": [set()],
}

# Characters between the beginnings of parts that complement each other.
REACH = 300


PLACES = "array<struct<start:int,end:int>>"
# Entries of a list that are gone through one by one; longer lists are cut into blocks.
BLOCK = 512


def block_by_block(entries: Column, total: Callable[[Column], Column], join: Callable[[Column], Column], use: Callable[[Column, Column], Column]) -> Column:
    """The lists that ``use`` (of a block of entries, and the total of all blocks before it) gives, laid end to end.

    ``total`` sums up a block as an int, ``join`` a list of such totals.
    """

    def of_blocks(blocks: Column) -> Column:
        return let(
            F.transform(blocks, total),
            lambda totals: F.flatten(F.transform(blocks, lambda b, k: let(join(F.slice(totals, F.lit(1), k)), lambda before: use(b, before)))),
        )

    last = F.greatest(F.lit(0), F.floor((F.size(entries) - 1) / BLOCK).cast("int"))
    return let(F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(entries, k * BLOCK + 1, F.lit(BLOCK))), of_blocks)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _greatest(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0))


def matches(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None, group: int = 0) -> Column:
    """Array of (start, end) of all leftmost non-overlapping matches, in code points, end exclusive.

    What lies between matches and the matches themselves alternate, so places are sums of lengths.
    ``keep`` judges the text of a group of each match.
    """

    def found(start: Column, n: Column) -> Column:
        return F.struct(start.alias("start"), (start + n).alias("end"))

    def places(block: Column, before: Column) -> Column:
        begin = F.struct(before.alias("at"), F.array().cast(PLACES).alias("out"))

        def step(acc: Column, s: Column) -> Column:
            start = acc["at"] + s["gap"]
            more = F.array_append(acc["out"], found(start, s["n"]))
            return F.struct(
                (start + s["n"]).alias("at"), (F.when(s["good"], more).otherwise(acc["out"]) if keep else more).alias("out")
            )

        return F.aggregate(block, begin, step, lambda acc: acc["out"])

    def fold(steps: Column) -> Column:
        return let(steps, lambda all: block_by_block(all, lambda b: _sum(F.transform(b, lambda s: s["gap"] + s["n"])), _sum, places))

    def steps(gaps: Column, whole: Column, groups: Column) -> Column:
        def step(m: Column, i: Column) -> Column:
            good = [keep(F.get(groups, i)).alias("good")] if keep else []
            return F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("n"), *good)

        return F.transform(whole, step)

    def extract(k: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(k))

    whole = let(
        F.split(text, pattern, -1),
        lambda gaps: let(extract(0), lambda m: fold(let(extract(group), lambda g: steps(gaps, m, g)) if group else steps(gaps, m, m))),
    )
    return F.when(F.rlike(text, F.lit(pattern)), whole).otherwise(F.array().cast(PLACES))


def strong(match: Column) -> Column:
    """Whether a bare value looks drawn at random: digits and letters of both cases."""
    return F.rlike(match, F.lit("[0-9]")) & F.rlike(match, F.lit("[a-z]")) & F.rlike(match, F.lit("[A-Z]"))


def _tagged(spans: Column, kind: str, order: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind."""
    return {
        kind: matches(text, pattern, lambda m, least=least: F.length(m) >= least, group)
        for kind, pattern, group, least in BASE_KINDS
    }


def joined(spans: Column) -> Column:
    """kind:start:end of each span by start, then kind in the listed order, comma-joined."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _text_key() -> list[Column]:
    """Two hashes and the length: rows of equal text have equal spans, so a text stands for all its rows."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("_t1"), F.xxhash64(F.reverse(text)).alias("_t2"), F.length(text).alias("_t3")]


def _outermost(spans: Column) -> Column:
    """Without weak spans that begin inside an earlier span: they are part of it."""

    def outer(block: Column, before: Column) -> Column:
        begin = F.struct(before.alias("at"), F.array().cast(SPAN).alias("out"))

        def step(acc: Column, s: Column) -> Column:
            inside = (s["rank"] >= len(BASE_KINDS)) & (s["start"] < acc["at"])
            return F.struct(
                F.greatest(acc["at"], s["end"]).alias("at"),
                F.when(inside, acc["out"]).otherwise(F.array_append(acc["out"], s)).alias("out"),
            )

        return F.aggregate(block, begin, step, lambda acc: acc["out"])

    return let(F.array_sort(spans), lambda all: block_by_block(all, lambda b: _greatest(F.transform(b, lambda s: s["end"])), _greatest, outer))


def parts(docs: DataFrame) -> DataFrame:
    """_t1.._t3, start, rank, end, kind, role: base spans and weak candidates of each distinct text that may report one."""
    text = F.coalesce("text", F.lit(""))
    arrays = [_tagged(s, k, i) for i, (k, s) in enumerate(base_spans(text).items())]
    arrays += [
        _tagged(matches(text, p, strong if role == "secret" else None), k, len(BASE_KINDS) + i)
        for i, (k, role, p) in enumerate(WEAK_KINDS)
    ]
    weak = F.lit(False)
    for _, _, p in WEAK_KINDS:
        weak = weak | F.rlike(text, F.lit(p))
    rows = docs.where(weak).select(*_text_key(), _outermost(F.concat(*arrays)).alias("_s"))
    rows = rows.where(F.exists("_s", lambda s: s["rank"] >= len(BASE_KINDS)))
    rows = rows.select("_t1", "_t2", "_t3", F.explode("_s").alias("_s")).select("_t1", "_t2", "_t3", "_s.*")
    role = F.array(*[F.lit(r) for r in ROLES])
    return rows.withColumn("role", F.get(role, F.col("rank"))).distinct()


def linked(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """_t1.._t3, extra: the weak spans of each text that have what they need (see ``NEEDS``) within reach.

    Parts are put in bins of ``reach`` characters, and each
    bin keeps only the first and the last start of a role, so a text with many parts joins three bins
    with each part, never parts with parts: within a part's own bin every other start is in reach, and
    in the bins beside it the nearest one decides.
    """
    key = ["_t1", "_t2", "_t3"]
    found = store(parts(docs).withColumn("bin", F.floor(F.col("start") / reach)), "secret-parts")
    bins = found.groupBy(*key, "bin", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    sides = store(bins.withColumnRenamed("role", "other"), "secret-bins")
    weak = found.where(F.col("rank") >= len(BASE_KINDS))
    probes = weak.withColumn("step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn("bin", F.col("bin") + F.col("step"))
    near = (
        F.when(F.col("step") == 0, True)
        .when(F.col("step") < 0, F.col("start") - F.col("last") <= reach)
        .otherwise(F.col("first") - F.col("start") <= reach)
    )
    part = [*key, "start", "rank", "end", "kind", "role"]
    pairs = probes.join(sides, [*key, "bin"], "left").where((F.col("role") != F.col("other")) & near | (F.col("role") == "whole"))
    met = pairs.groupBy(*part).agg(F.collect_set("other").alias("others"))
    enough = F.lit(False)
    for role, choices in NEEDS.items():
        for needed in choices:
            there = [F.array_contains("others", r) for r in sorted(needed)]
            enough = enough | reduce(Column.__and__, there, F.col("role") == role)
    spans = met.where(enough).groupBy(*key).agg(F.collect_set(F.struct("start", "rank", "end", "kind")).alias("extra"))
    return store(spans, "secret-links")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_linked of every row.

    Null text counts as empty and has no spans; repeated rows stay repeated; ids may be null; other
    columns are not looked at; empty tables give no rows. Texts of any length are taken whole.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", *_text_key(), *[s.alias("_" + k) for k, s in base_spans(text).items()])
    base = F.concat(*[_tagged(F.col("_" + k), k, i) for i, (k, *_) in enumerate(BASE_KINDS)])
    sizes = {f"n_{k}": F.size("_" + k).cast("long") for k, *_ in BASE_KINDS}
    found = found.select("doc_id", "_t1", "_t2", "_t3", *[c.alias(n) for n, c in sizes.items()], base.alias("_base"))
    rows = found.join(linked(docs, reach), ["_t1", "_t2", "_t3"], "left")
    extra = F.coalesce("extra", F.array().cast(SPAN))
    return rows.select(
        "doc_id", *sizes, F.sha2(joined(F.col("_base")), 256).alias("base_sha256"),
        joined(F.concat("_base", extra)).alias("spans"), F.size(extra).cast("long").alias("n_linked"),
    )


def mask(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span replaced by ``<kind>``; overlapping spans become one, named by the first.

    All columns stay; ``n_chars``, if there, follows the text. Null texts stay null.
    """
    text = F.coalesce("text", F.lit(""))
    base = F.concat(*[_tagged(s, k, i) for i, (k, s) in enumerate(base_spans(text).items())])
    keyed = docs.select("*", *_text_key(), base.alias("_base"))
    rows = keyed.join(linked(docs, reach), ["_t1", "_t2", "_t3"], "left")
    spans = F.array_sort(F.concat("_base", F.coalesce("extra", F.array().cast(SPAN))))

    def pieces(block: Column, before: Column) -> Column:
        """What stands before each span and its mark, cut from the block's part of the text; spans within others give nothing."""
        upto = _greatest(F.transform(block, lambda s: s["start"]))
        part = F.substring(F.col("text"), before + 1, F.greatest(F.lit(0), upto - before))

        def put(acc: Column, s: Column, own: Column) -> Column:
            inside = s["start"] < acc["at"]
            gap = F.substring(own, acc["at"] - before + 1, s["start"] - acc["at"])
            piece = F.concat(gap, F.lit("<"), s["kind"], F.lit(">"))
            return F.struct(
                F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(F.array_append(acc["out"], piece)).alias("out")
            )

        begin = F.struct(before.alias("at"), F.array().cast("array<string>").alias("out"))
        return let(part, lambda own: F.aggregate(block, begin, lambda acc, s: put(acc, s, own), lambda acc: acc["out"]))

    masked = let(spans, lambda all: block_by_block(all, lambda b: _greatest(F.transform(b, lambda s: s["end"])), _greatest, pieces))
    end = _greatest(F.transform(spans, lambda s: s["end"]))
    new = F.concat(F.array_join(masked, ""), F.substring(F.col("text"), end + 1, F.length("text")))
    hit = (F.size("_base") > 0) | F.col("extra").isNotNull()
    out = rows.withColumn("_hit", hit).withColumn("text", F.when(F.col("_hit"), new).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_hit"), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
