"""Similarity join of word n-gram sets by token-combination prefixes, and its connected components.

A token is the hash of ``SHINGLE`` consecutive words. Two sets of sizes n and m can reach the similarity only if
they share ceil(0.8 * n) tokens, so in any common order of tokens their first p(n) = n - ceil(0.8 * n) + 1
tokens share one, and prefixes longer by k - 1 share k.

1. In hash order, prefixes longer by a tenth of the set must share that many tokens with other sets. This
   leaves out nearly all sets while only a part of all tokens is shuffled.
2. The tokens of the sets left are ordered by frequency. Rare ones in a prefix are indexed alone. Of frequent
   ones, prefixes longer by g share g + 1, so with tokens dealt to g cells two fall in one cell: the index
   has the pairs of frequent tokens of each cell.
3. Sets under one index key are compared with a few pivots of the key, more in each round, until all
   that are left under the key are connected or compared. Candidates are verified on their whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import column, in_groups, store, store_alone, texts
from wardline.llm.components import components
from wardline.llm.skew import semi_join
from wardline.llm.substring_dedup import _BASES, _mix, rolling, text_key
from wardline.session import BROADCAST_LIMIT_BYTES, lookup_side, materialize, scratch_path, scratch_scope

SHINGLE = 5
PERCENT = 80
# Sets that hold a token, from which on it is frequent.
FREQUENT = 256
# Pivots of each key in the first round; each further round takes eight times as many.
FIRST_PIVOTS = 4
REMEMBERED_WORDS = 400_000


def words(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case: exactly what bytes methods take for letters and white space."""
    return text.encode().lower().split()


class Codes:
    """64-bit codes of words, with a memory."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.codes = np.zeros(0, np.uint64)

    def of(self, batch: list[list[bytes]]) -> np.ndarray:
        if len(self.place) > REMEMBERED_WORDS:
            self.__init__()
        new = list(set().union(*batch).difference(self.place))
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.codes = np.concatenate([self.codes, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))])
        get = self.place.__getitem__
        n = sum(map(len, batch))
        return self.codes[np.fromiter((i for ws in batch for i in map(get, ws)), np.int64, n)]


_codes = Codes()


def token_sets(batch: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, token) of the distinct tokens of each text, by text, then token in unsigned order.

    A text with fewer words than a shingle has one token, of all of them; one without words has none.
    """
    split = [words(t) for t in batch]
    codes = _codes.of(split)
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    owner = np.repeat(np.arange(len(split)), sizes)
    n = max(0, len(codes) - shingle + 1)
    inside = np.flatnonzero(owner[:n] == owner[shingle - 1 : shingle - 1 + n])
    text, token = owner[inside], rolling(codes, shingle, _BASES[0])[inside]
    ends = np.cumsum(sizes)
    for k in range(1, shingle):
        short = np.flatnonzero(sizes == k)
        if len(short):
            start = ends[short] - k
            h = np.full(len(short), k, np.uint64)
            for j in range(k):
                h = _mix(h ^ codes[start + j])
            text, token = np.concatenate([text, short]), np.concatenate([token, h])
    order = np.lexsort((token, text))
    text, token = text[order], token[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (token[1:] != token[:-1])
    return text[new], token[new]


def shortest(n):
    """ceil(0.8 * n): tokens that a set of n shares at least with any partner."""
    return -(-PERCENT * n // 100)


def prefix(n):
    return n - shortest(n) + 1


def _keys(text: np.ndarray, token: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's set, whatever its order."""
    out = []
    for salt in (np.uint64(0x1234567), np.uint64(0x7654321)):
        total = np.zeros(n_texts, np.uint64)
        with np.errstate(over="ignore"):
            np.add.at(total, text, _mix(token ^ salt))
        out.append(_mix(total ^ salt).view(np.int64))
    return out[0], out[1]


def _base(rows: DataFrame, shingle: int) -> DataFrame:
    """uid, doc_id, t1, t2, s1, s2, n, prefix: the set's key and size, and its prefix in hash order, a tenth longer."""

    def run(batches):
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            at, parts = 0, []
            for group in in_groups(column(batch, "text").to_pylist()):
                text, token = token_sets(group, shingle)
                n = np.bincount(text, minlength=len(group))
                s1, s2 = _keys(text, token, len(group))
                take = np.minimum(n, prefix(n) + n // 10)
                begin = np.cumsum(n) - n
                keep = np.arange(len(text)) - begin[text] < take[text]
                cuts = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(token[keep].view(np.int64)))
                numbers = uid + np.arange(len(group))
                same = [column(batch, c).slice(at, len(group)) for c in ("doc_id", "t1", "t2")]
                parts.append(pa.RecordBatch.from_arrays(
                    [pa.array(numbers), *same, pa.array(s1), pa.array(s2), pa.array(n), lists],
                    ["uid", "doc_id", "t1", "t2", "s1", "s2", "n", "prefix"],
                ))
                at += len(group)
                uid += len(group)
            yield from parts

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"uid bigint, doc_id {kind}, t1 bigint, t2 bigint, s1 bigint, s2 bigint, n bigint, prefix array<bigint>")


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """s1, n, tokens of rows (text, wanted) whose set has the wanted key."""

    def run(batches):
        for batch in batches:
            wanted, at = column(batch, "wanted").to_numpy(zero_copy_only=False), 0
            for group in in_groups(column(batch, "text").to_pylist()):
                text, token = token_sets(group, shingle)
                n = np.bincount(text, minlength=len(group))
                s1, _ = _keys(text, token, len(group))
                right = s1 == wanted[at : at + len(group)]
                cuts = np.concatenate([[0], np.cumsum(n[right])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(token[right[text]].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(s1[right]), pa.array(n[right]), lists], ["s1", "n", "tokens"])
                at += len(group)

    return rows.mapInArrow(run, "s1 bigint, n bigint, tokens array<bigint>")


def _survivors(base: DataFrame) -> DataFrame:
    """s1, uid of a row of each set whose hash-order prefix shares enough tokens with other sets."""
    tokens = base.where("n > 0").select("uid", "s1", "n", F.explode("prefix").alias("h"))
    counted = tokens.groupBy("h").agg(F.count("*").alias("rows"), F.min("s1").alias("low"), F.max("s1").alias("high"))
    shared = store(counted.where("low <> high").select("h", "rows"), "shared-tokens")
    hits = semi_join(tokens, shared, ["h"], "rows").groupBy("uid", "s1", "n").count()
    # A partner may have a fifth fewer tokens, and a tenth of that as its extension.
    least = F.floor(F.floor(F.col("n") * 4 / 5) / 10) + 1
    return hits.where(F.col("count") >= least).groupBy("s1").agg(F.min("uid").alias("uid"))


def cells(n: int) -> int:
    """Cells that a set of n tokens deals its frequent tokens to."""
    return 1 if n < 32 else 1 << int(np.log2(n / 5))


def _index(sets: DataFrame) -> DataFrame:
    """key, c, n, k: index entries of each set, its size, and how many of its tokens other sets have too."""
    tokens = sets.select(F.col("s1").alias("c"), "n", F.explode("tokens").alias("h"))
    df = store(tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "frequencies")
    common = tokens.join(df, "h").groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("common"))

    def run(batches):
        for batch in batches:
            keys, owners, sizes, shared = [], [], [], []
            for row in batch.to_pylist():
                n, common = row["n"], row["common"]
                unique = n - len(common)
                if unique >= prefix(n):
                    continue
                levels = sorted({cells(m) for m in (shortest(n), n, 100 * n // PERCENT)})
                found: set[int] = set()
                for g in levels:
                    # Unique tokens come first in the order, and no partner has them.
                    own = common[: max(0, prefix(n) + g - unique)]
                    found.update(x["h"] for x in own if x["df"] <= FREQUENT)
                    dealt: dict[int, list[int]] = {}
                    for x in own:
                        if x["df"] > FREQUENT:
                            dealt.setdefault(x["h"] % g, []).append(x["h"])
                    for cell in dealt.values():
                        cell.sort()
                        for i, a in enumerate(cell):
                            for b in cell[i + 1 :]:
                                packed = np.array([g, a, b], np.int64).tobytes()
                                found.add(int.from_bytes(xxhash.xxh3_64_digest(packed), "big", signed=True))
                keys += found
                owners += [row["c"]] * len(found)
                sizes += [n] * len(found)
                shared += [len(common)] * len(found)
            columns = {"key": keys, "c": owners, "n": sizes, "k": shared}
            yield pa.RecordBatch.from_pydict({name: pa.array(v, pa.int64()) for name, v in columns.items()})

    return common.mapInArrow(run, "key bigint, c bigint, n bigint, k bigint")


def _different(index: DataFrame) -> DataFrame:
    """The index with one key of those that have the same sets: the others would give the same pairs again.

    A long passage that many texts share gives hundreds of such keys. Lists are told apart by their length and 128 bits.
    """
    same = [F.bit_xor(F.xxhash64("c", F.lit(salt))) for salt in (1, 2)]
    lists = index.groupBy("key").agg(F.count("*").alias("rows"), same[0].alias("x"), same[1].alias("y")).where("rows > 1")
    chosen = store(lists.groupBy("rows", "x", "y").agg(F.min("key").alias("key")).select("key", "rows"), "keys")
    return semi_join(index, chosen, ["key"], "rows")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b of the pairs (a, pivot b) that reach the similarity.

    Pivots are few: their sets are broadcast if they measure small, and then no row with a set of a pair is
    shuffled; else they join by shuffle.
    """
    pivots = pairs.select(F.col("b").alias("s1")).distinct()
    two = store(sets.join(pivots, "s1", "left_semi").select(F.col("s1").alias("b"), F.col("tokens").alias("y")), "pivot-sets")
    width = two.agg(F.coalesce(F.sum(F.size("y")), F.lit(0))).first()[0] * 8
    two = F.broadcast(two) if width <= BROADCAST_LIMIT_BYTES else two
    one = sets.select(F.col("s1").alias("a"), F.col("tokens").alias("x"))
    both = pairs.join(one, "a").join(two, "b")
    both = both.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("k"))
    return both.where(100 * F.col("k") >= PERCENT * (F.col("n") + F.col("m") - F.col("k"))).select("a", "b")


def _linked_classes(sets: DataFrame) -> DataFrame:
    """node, component over the sets' keys: components of the links between different sets.

    A round keeps its links, labels and what is left of the index; all else that it stores is deleted at its end.
    """
    spark = sets.sparkSession
    index = store_alone(spark, "index", lambda: _different(store(_index(sets), "all-keys")))
    labels = spark.createDataFrame([], "node bigint, component bigint")
    edges, pivots_per_key = None, FIRST_PIVOTS
    while True:
        kept = {label: scratch_path(spark, f"llm-{label}") for label in ("links", "labels", "index")}
        with scratch_scope(spark):
            placed = index.join(labels.withColumnRenamed("node", "c"), "c", "left")
            placed = store(placed.select("key", "c", "n", "k", F.coalesce("component", "c").alias("label")), "placed")
            counted = placed.groupBy("key").agg(F.count("*").alias("rows"), F.min("label").alias("low"), F.max("label").alias("high"))
            open_keys = store(counted.where("low <> high").select("key", "rows"), "open-keys")
            if open_keys.isEmpty():
                return labels
            placed = store(semi_join(placed, open_keys, ["key"], "rows"), "open-index")
            cell = F.pmod(F.xxhash64("c"), F.lit(pivots_per_key))
            # A set with few tokens of its own is in the middle of a group of near copies, and links most of them.
            own = ((F.col("n") - F.col("k")) / F.col("n")).alias("own")
            entry = F.struct(own, F.xxhash64("c").alias("o"), F.col("c").alias("pivot"), F.col("n").alias("m"), F.col("k").alias("l"), F.col("label").alias("other"))
            pivots = store(placed.groupBy("key", cell.alias("cell")).agg(F.min(entry).alias("p")).select("key", "p.pivot", "p.m", "p.l", "p.other"), "pivots")
            # Two sets share at most what either shares with anyone.
            most = F.least("k", "l")
            possible = 100 * most >= PERCENT * (F.col("n") + F.col("m") - most)
            pairs = placed.join(pivots, "key").where((F.col("label") != F.col("other")) & possible)
            pairs = store(pairs.select(F.col("c").alias("a"), F.col("pivot").alias("b")).distinct(), "pairs")
            links = materialize(_verified(pairs, sets), "links", kept["links"])
            if not links.isEmpty():
                edges = links if edges is None else edges.unionByName(links)
                labels = materialize(components(edges), "labels", kept["labels"])
            # A pivot has met all of its key.
            done = pivots.select("key", F.col("pivot").alias("c"))
            left = placed.select("key", "c", "n", "k").join(done, ["key", "c"], "left_anti")
            index = materialize(left, "index", kept["index"])
        pivots_per_key *= 8


def classes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Rows whose sets are equal or linked, directly or over others, share the smallest doc_id among them. Null
    and empty texts have no shingles and are linked with nothing. Repeated rows stay; other columns are
    not looked at. Sets are compared by 64-bit tokens, and told apart by 128 bits where they are equal.
    """
    spark = docs.sparkSession
    rows = texts(docs).select("*", *text_key(F.col("text")))
    base = store(_base(rows, shingle), "sets")
    survivors = store_alone(spark, "survivors", lambda: _survivors(base))
    # A set is read again from one row: by its text, as ids may be null or repeat, and of copies by the id.
    chosen = survivors.join(base.select("uid", "doc_id", "t1", "t2"), "uid").select("t1", "t2", F.col("doc_id").alias("id"), F.col("s1").alias("wanted"))
    again = rows.join(lookup_side(store(chosen, "wanted")), ["t1", "t2"]).where(F.col("doc_id").eqNullSafe(F.col("id")))
    found = _sets(again.select("text", "wanted"), shingle)
    sets = store(found.dropDuplicates(["s1"]), "survivor-sets")
    labels = _linked_classes(sets)
    placed = base.select("doc_id", "n", "s1", "s2").join(labels.withColumnRenamed("node", "s1"), "s1", "left")
    # A set without links is told apart by both halves of its key.
    joint = F.col("component").isNotNull()
    placed = placed.select(
        "doc_id", "n", F.coalesce("component", "s1").alias("g1"), F.when(joint, 0).otherwise(F.col("s2")).alias("g2"), joint.alias("g3")
    )
    placed = store(placed, "placed-docs")
    least = store(placed.where("n > 0").groupBy("g1", "g2", "g3").agg(F.min("doc_id").alias("least")), "class-ids")
    out = placed.join(least, ["g1", "g2", "g3"], "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each class, all columns kept: that of the smallest doc_id, then of the smallest text key.

    Null ids come last. Rows of equal doc_id and text become one; rows without words are otherwise no one's copies.
    """
    key = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), *text_key(F.coalesce("text", F.lit(""))))
    found = classes(docs.select(key.alias("doc_id"), "text"), shingle)
    first = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_first")).agg(F.count("*").alias("_rows"))
    first = store(first, "firsts")
    kept = docs.withColumn("_key", key).join(lookup_side(first), F.col("_key").eqNullSafe(F.col("_first")))
    single = kept.where("_rows = 1").select(*docs.columns)
    if first.where("_rows > 1").isEmpty():
        return single
    return single.unionByName(kept.where("_rows > 1").dropDuplicates(["_key"]).select(*docs.columns))
