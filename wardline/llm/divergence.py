"""Divergence of sources: how far the term distributions of the sources of a language lie apart.

A term has one count in each group (language and source), so a group's counts cut the terms into levels. With a column
for each (group, level) that is 1 at the terms of that level, the product of the transposed indicator matrix with
itself holds the joint table of every two groups: the number of terms with these two levels. As a term's price depends on its
level alone, the distance of two groups is their joint table times the differences of the prices.

Terms in order of frequency are cut into blocks of rows, sources into blocks of columns. In a block few levels occur, so its
indicator matrices are small; Spark deals out the products and sums them. All figures are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import column, store
from wardline.operators.ordering import dense_sequence
from wardline.session import lookup_side

# Fixed values of the result's definition.
LEAST_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
# Bytes of a term: letters, the upper case folded, and all that is not ASCII; the rest separates.
_FOLD = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

TERM_BLOCK = 256
SOURCE_BLOCK = 32
# Columns of a product that are made at once: bounds a task's memory.
COLUMNS_AT_ONCE = 1024
# Texts whose terms are counted at once.
TEXT_BYTES = 16 * 1024 * 1024


class Counts(NamedTuple):
    """groups: lang, source, v (kept terms of the language), n (occurrences of them in the group).

    terms: lang, term, place (by frequency within all languages), c (occurrences in the language), v, n (of the language).
    cells: lang, source, term, place, c (above 0), v, n (of the group).
    """

    groups: DataFrame
    terms: DataFrame
    cells: DataFrame


def _some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``TEXT_BYTES`` of text."""
    sizes = np.cumsum(pc.binary_length(column(batch, "text")).to_numpy())
    at = 0
    while at < batch.num_rows:
        done = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + TEXT_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def _words(text: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(row, term) of every term of every text, in lower case; the empty term may be among them."""
    n = len(text)
    cuts = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + n + 1]
    data = text.buffers()[2].slice(cuts[0], cuts[-1] - cuts[0]).to_pybytes() if cuts[-1] > cuts[0] else b""
    # One byte becomes one byte, so the texts keep their places.
    folded = pa.StringArray.from_buffers(n, pa.py_buffer((cuts - cuts[0]).tobytes()), pa.py_buffer(data.translate(_FOLD)))
    split = pc.ascii_split_whitespace(folded)
    return np.repeat(np.arange(n), pc.list_value_length(split).to_numpy()), split.flatten().dictionary_encode()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, docs, c of runs of rows; the empty term stands for the group itself, with its rows."""
    for rows in (r for batch in batches for r in _some(batch)):
        pairs = pa.StructArray.from_arrays([column(rows, "lang"), column(rows, "source")], ["lang", "source"]).to_pylist()
        groups = {g: k for k, g in enumerate(dict.fromkeys((p["lang"], p["source"]) for p in pairs))}
        group = np.array([groups[p["lang"], p["source"]] for p in pairs], np.int64)
        row, term = _words(column(rows, "text"))
        n_terms = max(1, len(term.dictionary))
        once, n = np.unique(row * n_terms + term.indices.to_numpy(), return_counts=True)
        key, at = np.unique(group[once // n_terms] * n_terms + once % n_terms, return_inverse=True)
        docs, c = np.bincount(at, minlength=len(key)), np.bincount(at, n, minlength=len(key)).astype(np.int64)
        terms = term.dictionary.take(pa.array(key % n_terms)) if len(key) else pa.array([], pa.string())
        real = pc.not_equal(terms, "").to_numpy(zero_copy_only=False)
        names = [pa.array([g[k] for g in groups], pa.string()) for k in (0, 1)]
        owner = np.concatenate([(key // n_terms)[real], np.arange(len(groups))])
        yield pa.RecordBatch.from_pydict({
            "lang": names[0].take(pa.array(owner)), "source": names[1].take(pa.array(owner)),
            "term": pa.concat_arrays([terms.filter(pa.array(real)), pa.array([""] * len(groups), pa.string())]),
            "docs": pa.array(np.concatenate([docs[real], np.bincount(group, minlength=len(groups))]), pa.int64()),
            "c": pa.array(np.concatenate([c[real], np.zeros(len(groups), np.int64)]), pa.int64()),
        })


def count_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> Counts:
    """Counts of the terms that stand in ``least_docs`` documents of their language or more.

    Rows are added up in Python and again on the map side before anything is shuffled, so a source or a term with a third of all
    rows costs a row a task.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = rows.mapInArrow(_count, "lang string, source string, term string, docs bigint, c bigint")
    found = store(parts.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("c").alias("c")), "term-counts")
    in_lang = found.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("c").alias("c"))
    terms = dense_sequence(in_lang.where(F.col("docs") >= least_docs).drop("docs"), ["lang", "c", "term"], "place")
    langs = lookup_side(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")))
    terms = store(terms.join(langs, "lang"), "kept-terms")
    cells = store(found.join(lookup_side(terms.select("lang", "term", "place", "v")), ["lang", "term"]).drop("docs"), "term-cells")
    sums = cells.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = found.where("term = ''").select("lang", "source").join(langs.select("lang", "v"), "lang", "left").join(sums, ["lang", "source"], "left")
    groups = store(groups.fillna(0, ["v", "n"]), "term-groups")
    return Counts(groups, terms, cells.join(lookup_side(groups.select("lang", "source", "n")), ["lang", "source"]))


def price(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), in whole numbers of any size."""
    whole = lambda c: c.cast("decimal(20,0)")
    above = (whole(count) + F.lit(PRIOR)).cast("decimal(24,0)") * F.lit(SCALE)
    below = whole(total) + whole(terms) * F.lit(PRIOR)
    return F.call_function("div", above, below) + F.lit(1)


def _priced(levels: np.ndarray, total: int, terms: int) -> np.ndarray:
    return np.array([1 + SCALE * (c + PRIOR) // (total + PRIOR * terms) for c in levels.tolist()], np.int64)


class _Side(NamedTuple):
    """A block of indicator columns: 1 where a term (row) has the level, of the group, that the column stands for."""

    matrix: np.ndarray
    level: np.ndarray
    group: np.ndarray
    prices: np.ndarray


def _side(n_terms: int, groups: list[dict], term: np.ndarray, group: np.ndarray, c: np.ndarray, v: int) -> _Side:
    counts = np.zeros((len(groups), n_terms), np.int64)
    counts[group, term] = c
    matrices, levels, owners, prices = [], [], [], []
    for g, own in enumerate(counts):
        level, at = np.unique(own, return_inverse=True)
        ones = np.zeros((n_terms, len(level)), np.float32)
        ones[np.arange(n_terms), at] = 1
        matrices.append(ones)
        levels.append(level)
        owners.append(np.full(len(level), g))
        prices.append(_priced(level, groups[g]["n"], v))
    return _Side(np.concatenate(matrices, 1), *map(np.concatenate, (levels, owners, prices)))


def _blocks(counts: Counts) -> DataFrame:
    """A row for each product: two blocks of sources of a language and a block of its terms.

    lang, v, n_terms, first (place of the first term); groups and others (lists of g, source, n); and for each of both the
    cells as lists of places, groups and counts, null where a block has none.
    """
    in_order = Window.partitionBy("lang").orderBy("source")
    numbered = counts.groups.where("v > 0").withColumn("g", F.row_number().over(in_order) - 1)
    numbered = numbered.withColumn("block", F.expr(f"g div {SOURCE_BLOCK}"))
    sources = numbered.groupBy("lang", "block").agg(
        F.first("v").alias("v"), F.array_sort(F.collect_list(F.struct("g", "source", "n"))).alias("groups")
    )
    rows = counts.terms.select("lang", F.expr(f"place div {TERM_BLOCK}").alias("rows"), "place")
    rows = rows.groupBy("lang", "rows").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n_terms"))
    cells = counts.cells.join(lookup_side(numbered.select("lang", "source", "g", "block")), ["lang", "source"])
    lists = cells.groupBy("lang", F.expr(f"place div {TERM_BLOCK}").alias("rows"), "block").agg(
        F.collect_list(F.struct("place", "g", "c")).alias("of")
    )
    lists = store(lists.select("lang", "rows", "block", *[F.col(f"of.{x}").alias(x) for x in ("place", "g", "c")]), "term-blocks")
    one = sources.join(lookup_side(rows), "lang")
    two = sources.select("lang", F.col("block").alias("other"), F.col("groups").alias("others"))
    work = one.join(lookup_side(two), "lang").where("block <= other")
    theirs = lists.select("lang", "rows", F.col("block").alias("other"), *[F.col(x).alias(f"other_{x}") for x in ("place", "g", "c")])
    # A block with itself needs its cells once.
    theirs = theirs.withColumn("apart", F.lit(True))
    work = work.join(lists, ["lang", "rows", "block"], "left").withColumn("apart", F.col("block") < F.col("other"))
    return work.join(theirs, ["lang", "rows", "other", "apart"], "left")


def _products(of: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, _Side, _Side, slice, np.ndarray]]:
    """Each row of ``_blocks`` with its two sides and their product, the joint tables of its terms, some columns of the first side at a time."""
    plain = ["lang", "block", "other", "v", "n_terms", "first", "groups", "others"]
    for batch in of:
        for k in range(batch.num_rows):
            some = batch.slice(k, 1)
            row = some.select(plain).to_pylist()[0]

            def side(groups: list[dict], prefix: str) -> _Side:
                place, g, c = (column(some, prefix + x).flatten().to_numpy() for x in ("place", "g", "c"))
                return _side(row["n_terms"], groups, place - row["first"], g - groups[0]["g"], c, row["v"])

            a = side(row["groups"], "")
            b = a if row["block"] == row["other"] else side(row["others"], "other_")
            for at in range(0, a.matrix.shape[1], COLUMNS_AT_ONCE):
                part = slice(at, at + COLUMNS_AT_ONCE)
                # Exact: sums of at most TERM_BLOCK ones.
                yield row, a, b, part, (a.matrix[:, part].T @ b.matrix).astype(np.int64)


def joint_tables(counts: Counts) -> DataFrame:
    """lang, source, other, level, other_level, terms: how many kept terms have these counts in two sources, source < other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, a, b, part, product in _products(batches):
            i, j = np.nonzero(product)
            terms, i = product[i, j], i + part.start
            before = np.array([g["g"] for g in row["groups"]])[a.group[i]] < np.array([g["g"] for g in row["others"]])[b.group[j]]
            i, j, terms = i[before], j[before], terms[before]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([row["lang"]] * len(i), pa.string()),
                "source": pa.array([row["groups"][g]["source"] for g in a.group[i]], pa.string()),
                "other": pa.array([row["others"][g]["source"] for g in b.group[j]], pa.string()),
                "level": pa.array(a.level[i], pa.int64()), "other_level": pa.array(b.level[j], pa.int64()),
                "terms": pa.array(terms, pa.int64()),
            })

    parts = _blocks(counts).mapInArrow(run, "lang string, source string, other string, level bigint, other_level bigint, terms bigint")
    return parts.groupBy("lang", "source", "other", "level", "other_level").agg(F.sum("terms").alias("terms"))


def distances(counts: Counts) -> DataFrame:
    """lang, source, item, value of every two sources of a language that has kept terms: their joint tables, priced.

    A product is priced where it is made, so only a row for each two sources of a block is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, a, b, part, product in _products(batches):
            product *= np.abs(a.prices[part, None] - b.prices[None, :])
            owner = a.group[part]
            starts = [np.flatnonzero(np.diff(g, prepend=-1)) for g in (owner, b.group)]
            sums = np.add.reduceat(np.add.reduceat(product, starts[0], 0), starts[1], 1)
            mine = [row["groups"][g] for g in owner[starts[0]]]
            pairs = [(x["source"], y["source"], v) for x, own in zip(mine, sums.tolist()) for y, v in zip(row["others"], own) if x["g"] < y["g"]]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([row["lang"]] * len(pairs), pa.string()), "source": pa.array([p[0] for p in pairs], pa.string()),
                "item": pa.array([p[1] for p in pairs], pa.string()), "value": pa.array([p[2] for p in pairs], pa.int64()),
            })

    parts = _blocks(counts).mapInArrow(run, "lang string, source string, item string, value bigint")
    half = store(parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "source-distances")
    return half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def over_represented(counts: Counts) -> DataFrame:
    """lang, source, item, value: terms of a group whose price there is above that in its language, and by how much."""
    whole = lookup_side(counts.terms.select("lang", "term", price(F.col("c"), F.col("n"), F.col("v")).alias("q")))
    own = counts.cells.select("lang", "source", "term", price(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    return own.join(whole, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: per group the distance to each other source, and its ``top_terms`` most over-represented terms.

    Null text, lang and source count as empty; a group whose texts have no terms is as far from others as the prior alone makes it;
    a language without kept terms has distances of 0; a language of one source has no pairs. Repeated rows
    count each; ties rank by item, bytewise; empty tables give no rows; other columns are not looked at.
    """
    counts = count_terms(docs, least_docs)
    none = counts.groups.where("v = 0")
    others = none.select("lang", F.col("source").alias("item"))
    flat = none.select("lang", "source").join(others, "lang").where("source <> item").withColumn("value", F.lit(0).cast("bigint"))
    pairs = distances(counts).unionByName(flat).withColumn("part", F.lit("pair"))
    terms = over_represented(counts).withColumn("part", F.lit("term"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by_value)
    ranked = pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top_terms))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
