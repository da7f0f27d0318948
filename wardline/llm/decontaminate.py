"""Benchmark items in documents, within an error budget: pigeonhole pieces, then Myers' bit-parallel distance.

Texts are compared as sequences of lower-case words; in scripts without spaces every character is a word. An item of n words
may differ from a passage by k = floor(rate * n) inserted, deleted or replaced words, a short one by none. Cut into k + 1 pieces, at least one piece
of the item then stands unchanged in the passage. Pieces are found by rolling hashes over word ids; around
each hit the whole item is compared, one machine word of bits for each column of the distance matrix.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import column, in_groups, map_batches, store, texts
from wardline.llm.substring_dedup import text_key
from wardline.session import lookup_side, measured_bytes

ERROR_RATE = 0.2
# Items of fewer words have to stand there exactly: one of few words with an error says too little to be called a leak.
EXACT_BELOW = 8
# Text of items that one pass over the documents looks for; more items take more passes.
BLOCK_BYTES = 32 * 1024 * 1024

# Fixed value: Thai to Tibetan, Burmese, Khmer, kana and Han, which are written without spaces.
DENSE = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[{DENSE}]|[^\W_{DENSE}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def pieces(n: int, k: int) -> list[tuple[int, int]]:
    """(offset, length) of k + 1 pieces of n words, as even as can be."""
    cuts = [i * n // (k + 1) for i in range(k + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every window of ``length`` ids, modulo 2**64."""
    n = len(ids) - length + 1
    out = np.zeros(max(n, 0), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(length if n > 0 else 0):
            out = out * _BASE + ids[j : j + n].astype(np.uint64)
    return out


class Pattern:
    """An item's words as bits: where each word stands, forwards and backwards."""

    def __init__(self, ids: list[int]):
        self.n = len(ids)
        self.forward, self.backward = defaultdict(int), defaultdict(int)
        for i, w in enumerate(ids):
            self.forward[w] |= 1 << i
            self.backward[w] |= 1 << (self.n - 1 - i)
        self.forward, self.backward = dict(self.forward), dict(self.backward)

    def distances(self, text: list[int], where: dict[int, int], anchored: bool) -> list[int]:
        """Edit distance of the item to the text that ends at each word.

        The text begins anywhere, or with ``anchored`` at its first word.
        """
        full, top = (1 << self.n) - 1, 1 << (self.n - 1)
        up, down, score, out = full, 0, self.n, []
        for w in text:
            eq = where.get(w, 0)
            vertical = eq | down
            across = (((eq & up) + up) ^ up) | eq
            plus = down | ~(across | up) & full
            minus = up & across
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
            plus = plus << 1 | anchored
            up = (minus << 1 | ~(vertical | plus)) & full
            down = plus & vertical & full
            out.append(score)
        return out

    def best(self, text: list[int], most: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of the closest passage of ``text``, the first and longest of equals; None above ``most``."""
        ends = self.distances(text, self.forward, False)
        if not ends or (least := min(ends)) > most:
            return None
        end = ends.index(least) + 1
        starts = self.distances(text[:end][::-1], self.backward, True)
        length = max(i + 1 for i, d in enumerate(starts) if d == least)
        return least, end - length, end


class Benchmark:
    """Pieces and patterns of a block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float, exact_below: int):
        self.ids: dict[str, int] = {}
        self.items: list[tuple[int, Pattern, int]] = []
        by_length: dict[int, list[tuple[np.ndarray, int, int]]] = defaultdict(list)
        seen: dict[tuple[str, ...], int] = {}
        for item_id, text in items:
            ws = tuple(words(text))
            if ws:
                seen[ws] = min(item_id, seen.get(ws, item_id))
        for ws, item_id in seen.items():
            own = [self.ids.setdefault(w, len(self.ids) + 1) for w in ws]
            k = int(rate * len(own)) if len(own) >= exact_below else 0
            for offset, length in pieces(len(own), k):
                by_length[length].append((np.array(own[offset : offset + length]), len(self.items), offset))
            self.items.append((item_id, Pattern(own), k))
        self.pieces = {}
        for length, found in by_length.items():
            hashes = np.array([rolling(p, length)[0] for p, _, _ in found], np.uint64)
            order = np.argsort(hashes, kind="stable")
            owners = np.array([(i, o) for _, i, o in found], np.int64)[order]
            self.pieces[length] = (hashes[order], owners)

    def hits(self, flat: np.ndarray) -> np.ndarray:
        """(place, item, offset) of every piece found in a sequence of word ids; 0 stands for all other words."""
        out = [np.zeros((0, 3), np.int64)]
        known = np.concatenate([[0], np.cumsum(flat > 0)])
        for length, (hashes, owners) in self.pieces.items():
            if len(flat) < length:
                continue
            place = np.flatnonzero(known[length:] - known[:-length] == length)
            window = rolling(flat, length)[place]
            first = np.searchsorted(hashes, window, "left")
            n = np.searchsorted(hashes, window, "right") - first
            hit = np.flatnonzero(n)
            n, first = n[hit], first[hit]
            row = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out.append(np.column_stack([np.repeat(place[hit], n), owners[row]]))
        return np.concatenate(out)

    def search(self, batch: list[str]) -> list[tuple[int, int, int, int, int, bool]]:
        """(text number, item_id, distance, first word, word after the last, closest) of each passage of each pair.

        Places an item may stand at that overlap are one passage, the closest in them; ``closest`` marks the first
        of the closest ones of a pair.
        """
        get = self.ids.get
        split = [words(t) for t in batch]
        ends = np.cumsum([len(ws) + 1 for ws in split])
        flat = np.fromiter((i for ws in split for i in (*(get(w, 0) for w in ws), 0)), np.int64, int(ends[-1]))
        hits = self.hits(flat)
        doc = np.searchsorted(ends, hits[:, 0], "right")
        begin = np.concatenate([[0], ends[:-1]])
        at = hits[:, 0] - begin[doc] - hits[:, 2]
        out = []
        order = np.lexsort((at, hits[:, 1], doc))
        spans: dict[tuple[int, int], list[list[int]]] = {}
        for d, item, a in zip(doc[order].tolist(), hits[order, 1].tolist(), at[order].tolist()):
            _, pattern, k = self.items[item]
            low, high = max(0, a - k), a + pattern.n + k
            runs = spans.setdefault((d, item), [])
            if runs and low <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], high)
            else:
                runs.append([low, high])
        for (d, item), runs in spans.items():
            item_id, pattern, k = self.items[item]
            found = []
            for low, high in runs:
                text = flat[begin[d] + low : min(begin[d] + high, ends[d] - 1)].tolist()
                if best := pattern.best(text, k):
                    found.append((best[0], low + best[1], low + best[2]))
            out += [(d, item_id, *f, f == min(found)) for f in found]
        return out


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, exact_below: int = EXACT_BELOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, distance, start_word, end_word, start, end: the closest of the ``passages`` of each pair.

    Nulls, ties, repeated rows and empty tables as there.
    """
    return passages(docs, benchmark, rate, exact_below, block_bytes).where("closest").drop("closest")


def passages(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, exact_below: int = EXACT_BELOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, distance, start_word, end_word, start, end, closest: all passages of each pair within budget.

    ``start`` and ``end`` are code points, end exclusive; the distance is in words. ``closest`` marks one passage of a
    pair, the first of equals. Null texts and items, and those without words, match nothing. Items of equal words count as
    the one with the smallest item_id. Repeated rows of documents give repeated rows. Empty tables give no rows. Other
    columns are not looked at. The benchmark's own size decides how many passes are made: one for each ``block_bytes`` of
    its text, each with its own broadcast, so a benchmark of any size is searched whole.
    """
    spark = docs.sparkSession
    rows = texts(docs).where("text <> ''")
    kind = rows.schema["doc_id"].dataType.simpleString()
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    items = items.groupBy("text").agg(F.min("item_id").alias("item_id"))
    blocks = max(1, -(-measured_bytes(items) // block_bytes))
    schema = f"doc_id {kind}, item_id bigint, distance int, start_word bigint, end_word bigint, start bigint, end bigint, closest boolean"

    def passed(block: int) -> DataFrame:
        some = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        found = spark.sparkContext.broadcast([(r.item_id, r.text) for r in some.collect()])
        number = uuid.uuid4().hex

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            own = _prepared(number, found.value, rate, exact_below)
            ids, out, at = column(batch, "doc_id").to_pylist(), [], 0
            for group in in_groups(column(batch, "text").to_pylist()):
                seen, places = -1, []
                for d, item_id, distance, first, last, closest in own.search(group):
                    if d != seen:
                        seen, places = d, [m.span() for m in WORD.finditer(_as_lower(group[d]))]
                    out.append((ids[at + d], item_id, distance, first, last, places[first][0], places[last - 1][1], closest))
                at += len(group)
            columns = list(zip(*out)) or [[]] * 8
            types = [batch.schema.field("doc_id").type, pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.bool_()]
            names = ["doc_id", "item_id", "distance", "start_word", "end_word", "start", "end", "closest"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        return map_batches(rows, work, schema)

    out = passed(0)
    for block in range(1, blocks):
        out = out.unionByName(passed(block))
    return out


def _as_lower(text: str) -> str:
    """Lower case of the same length, so that places stay; letters whose lower case is longer are left."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


_ready: dict[str, Benchmark] = {}


def _prepared(number: str, items: list[tuple[int, str]], rate: float, exact_below: int) -> Benchmark:
    """The block's patterns, built once in each worker; of other blocks none is kept."""
    if number not in _ready:
        _ready.clear()
        _ready[number] = Benchmark(items, rate, exact_below)
    return _ready[number]


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark passage; all columns stay.

    Rows are told by a key of their text, so null and repeated ids do no harm. The keys found are stored, and
    broadcast only if they measure small.
    """
    key = F.concat_ws(":", *text_key(F.coalesce("text", F.lit(""))))
    hit = leaks(docs.select(key.alias("doc_id"), "text"), benchmark, rate).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(lookup_side(store(hit, "leaks")), key == F.col("_hit"), "left_anti")
