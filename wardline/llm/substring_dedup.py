"""Removal of repeated passages: Rabin-Karp hashes of every window of words, counted in Spark.

Every window of ``width`` words of every text gets a rolling hash. A window can repeat only if its
anchor does: the leftmost smallest hash among its runs of ``ANCHOR`` words, the same for equal windows. One
anchor serves many windows, so anchors are counted first, and the hashes of all windows whose anchor stands
in one place only need no shuffle: their count is one. All others are counted in Spark by their 128-bit hash.
Repeated windows of a text merge into maximal intervals, which are removed.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import WORD_GAP, column, in_groups, map_batches, store
from wardline.llm.skew import semi_join

WIDTH = 35
ANCHOR = 12
REMEMBERED_WORDS = 400_000
WORD = re.compile("[^ \t-\r]+")
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rolling(codes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash modulo 2**64 of every window of ``width`` codes.

    The base is odd, so it has an inverse, and a window is a difference of two prefix sums.
    """
    n = len(codes)
    if n < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)
        down = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64), dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * down, dtype=np.uint64)])
        return _mix((sums[width:] - sums[:-width]) * up[: n - width + 1])


def leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in every window of ``width`` values."""
    at, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        reach += step
    return at


class Hasher:
    """Rolling hashes of texts, with a memory of words."""

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.codes = np.zeros(0, np.uint64)

    def codes_of(self, batch: list[list[str]]) -> np.ndarray:
        if len(self.place) > REMEMBERED_WORDS:
            self._forget()
        new = list({w for ws in batch for w in ws if w not in self.place})
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            more = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in new), np.uint64, len(new))
            self.codes = np.concatenate([self.codes, more])
        get = self.place.__getitem__
        n = sum(map(len, batch))
        return self.codes[np.fromiter((i for ws in batch for i in map(get, ws)), np.int64, n)]


_hasher = Hasher()


class Windows:
    """Windows of a group of texts: where each starts, its text, and its anchor."""

    def __init__(self, split: list[list[str]], width: int):
        self.width = width
        self.codes = _hasher.codes_of(split)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        self.begin = np.cumsum(sizes) - sizes
        anchor = min(ANCHOR, width)
        self.grams = rolling(self.codes, anchor, _BASES[0])
        windows = max(0, len(self.codes) - width + 1)
        at = leftmost_smallest(self.grams, width - anchor + 1) if windows else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(split)), sizes)
        # Windows that do not cross into the next text.
        self.start = np.flatnonzero(owner[:windows] == owner[width - 1 : width - 1 + windows])
        self.owner = owner[self.start]
        self.anchor = at[self.start]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of every place that is an anchor."""
        place, first = np.unique(self.anchor, return_index=True)
        return self.owner[first], self.grams[place].view(np.int64)

    def hashes(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = self.start[some]
        return tuple(rolling(self.codes, self.width, b)[start].view(np.int64) for b in _BASES)


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.concat(F.lit("#"), text)).alias("t2")]


def _anchors(rows: DataFrame, width: int) -> DataFrame:
    """t1, t2, h, many: anchors of each row, and whether one stands in several places of the text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, at = [], 0
        for group in in_groups(column(batch, "text").to_pylist()):
            owner, h = Windows([WORD.findall(t) for t in group], width).anchors()
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(new)
            parts.append((owner[first] + at, h[first], np.diff(np.append(first, len(h))) > 1))
            at += len(group)
        owner, h, many = (np.concatenate(x) for x in zip(*parts))
        rows = pa.array(owner)
        return pa.RecordBatch.from_pydict({"t1": column(batch, "t1").take(rows), "t2": column(batch, "t2").take(rows), "h": pa.array(h), "many": pa.array(many)})

    return map_batches(rows, work, "t1 bigint, t2 bigint, h bigint, many boolean")


def _windows(rows: DataFrame, width: int) -> DataFrame:
    """t1, t2, at, h1, h2: windows whose anchor is in the row's list."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, at = [], 0
        lists = column(batch, "anchors")
        for group in in_groups(column(batch, "text").to_pylist()):
            w = Windows([WORD.findall(t) for t in group], width)
            own = lists.slice(at, len(group))
            listed = own.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            # Anchors belong to a row: the row's number is mixed into both sides.
            row = np.repeat(np.arange(len(group)), own.value_lengths().to_numpy(zero_copy_only=False)).astype(np.uint64)
            wanted = np.unique(_mix(_mix(listed) ^ row))
            mine = _mix(_mix(w.grams[w.anchor]) ^ w.owner.astype(np.uint64))
            some = np.flatnonzero(np.isin(mine, wanted))
            h1, h2 = w.hashes(some)
            parts.append((w.owner[some] + at, w.start[some] - w.begin[w.owner[some]], h1, h2))
            at += len(group)
        owner, start, h1, h2 = (np.concatenate(x) for x in zip(*parts))
        rows = pa.array(owner)
        return pa.RecordBatch.from_pydict({"t1": column(batch, "t1").take(rows), "t2": column(batch, "t2").take(rows), "at": pa.array(start.astype(np.int32)), "h1": pa.array(h1), "h2": pa.array(h2)})

    return map_batches(rows, work, "t1 bigint, t2 bigint, at int, h1 bigint, h2 bigint")


def covered(starts: list[int], width: int, n: int) -> np.ndarray:
    """Which of n words the windows at these starts cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.asarray(starts, np.int64) + width, -1)
    return np.cumsum(edge)[:n] > 0


def _removals(rows: DataFrame, width: int) -> DataFrame:
    """t1, t2, n_removed, kept: each text without the words under its repeated windows."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        removed, kept = [], []
        for text, starts in zip(column(batch, "text").to_pylist(), column(batch, "starts").to_pylist()):
            ws = WORD.findall(text)
            gone = covered(starts, width, len(ws))
            removed.append(int(gone.sum()))
            kept.append(" ".join([w for w, g in zip(ws, gone.tolist()) if not g]))
        return pa.RecordBatch.from_pydict({"t1": column(batch, "t1"), "t2": column(batch, "t2"), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    return map_batches(rows, work, "t1 bigint, t2 bigint, n_removed bigint, kept string")


def repeated_passages(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """t1, t2, n_removed, kept, whole: texts that may lose words, by the key of ``text_key``.

    A text of several rows has only ``whole`` set: all its words go if it has a window at all, as every
    window of it starts in the other rows too.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", *text_key(F.col("text")))
    copies = rows.select("t1", "t2", "doc_id").groupBy("t1", "t2").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first"))
    copies = store(copies, "texts")
    anchors = store(_anchors(rows.select("t1", "t2", "text"), width), "anchors")
    counted = anchors.groupBy("h").agg(F.count("*").alias("n"), F.min("t1").alias("low"), F.max("t1").alias("high"), F.bool_or("many").alias("many"))
    shared = store(counted.where("many OR low <> high").select("h", "n"), "shared-anchors")
    lists = semi_join(anchors.select("t1", "t2", "h"), shared, ["h"], "n").groupBy("t1", "t2").agg(F.collect_set("h").alias("anchors"))
    lists = store(lists.join(copies, ["t1", "t2"]), "anchor-lists")
    # One row of each text goes on: that of its smallest doc_id.
    chosen = rows.join(lists, ["t1", "t2"]).where(F.col("doc_id").eqNullSafe(F.col("first"))).select("t1", "t2", "text", "anchors", "rows")
    chosen = store(chosen, "candidates")
    windows = store(_windows(chosen.select("t1", "t2", "text", "anchors"), width), "windows")
    place = F.xxhash64("t1", "at")
    counted = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high"))
    repeated = store(counted.where("low <> high").select("h1", "h2", "n"), "repeated-windows")
    starts = semi_join(windows, repeated, ["h1", "h2"], "n").groupBy("t1", "t2").agg(F.collect_set("at").alias("starts"))
    single = chosen.where("rows = 1").select("t1", "t2", "text").join(store(starts, "starts"), ["t1", "t2"])
    some = _removals(single, width).withColumn("whole", F.lit(False))
    every = copies.where("rows > 1").select("t1", "t2", F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept"), F.lit(True).alias("whole"))
    return store(some.unionByName(every), "removals")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP, -1), lambda w: w != "")


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by single spaces) of every row.

    Null and empty texts, and texts of fewer than ``width`` words, keep all they have. Repeated rows lose
    all words if they have a window. Ids may be null or repeat; other columns are not looked at.
    """
    text = F.coalesce("text", F.lit(""))
    words = words_of(text)
    base = docs.select("doc_id", *text_key(text), F.size(words).cast("long").alias("n_words"), F.array_join(words, " ").alias("all"))
    return _decided(base, repeated_passages(docs, width), width, F.lit("")).withColumnRenamed("left", "kept")


def _decided(base: DataFrame, gone: DataFrame, width: int, nothing: Column) -> DataFrame:
    rows = base.join(gone, ["t1", "t2"], "left")
    whole = F.coalesce("whole", F.lit(False))
    lost = F.when(whole & (F.col("n_words") >= width), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    left = F.when(whole & (F.col("n_words") >= width), nothing).when(whole | F.col("kept").isNull(), F.col("all")).otherwise(F.col("kept"))
    return rows.select("doc_id", "n_words", lost.cast("long").alias("n_removed"), left.alias("left"))


def dedup_digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """As ``dedup``, with the SHA-256 of the kept words; texts are digested before they meet, so none is shuffled."""
    text = F.coalesce("text", F.lit(""))
    words = words_of(text)
    base = docs.select("doc_id", *text_key(text), F.size(words).cast("long").alias("n_words"), F.sha2(F.array_join(words, " "), 256).alias("all"))
    gone = repeated_passages(docs, width).withColumn("kept", F.sha2("kept", 256))
    return _decided(base, gone, width, F.sha2(F.lit(""), 256)).withColumnRenamed("left", "kept_sha256")
