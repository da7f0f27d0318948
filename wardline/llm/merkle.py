"""Merkle manifest of a table: a tree of three children a parent for each source, and one over the sources.

A parent is the SHA-256 of its children's digests as hex text. Such a digest fills a block of the hash exactly, so the
hash state before each child slot is a chaining value of 32 bytes. A parent retains these states next to its digest;
folding a changed child into the tree resumes the state of its slot and takes in the replacement and the siblings to its
right, but none to its left.

The tree is built and kept in chunks of ``CHUNK`` nodes: a row holds all levels above so many neighbours, so a source
with a third of all rows is dealt out like any other, and each round leaves 1 row for 729.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import column, store
from wardline.operators.ordering import dense_sequence
from wardline.session import lookup_side

FANOUT = 3
CHUNK_LEVELS = 6
CHUNK = FANOUT**CHUNK_LEVELS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]  # fixed value: order of the fields in a leaf
# Chunks that are built or folded together: bounds a task's memory.
AT_ONCE = 32


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid - 1)
    return low


# The constants of SHA-256: fractions of the square and cube roots of the first primes.
_START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_ROUND = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]
_HEX = np.frombuffer(b"".join(b"%02x" % b for b in range(256)), np.uint16)


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """SHA-256's chaining values (n, 8) after one more block (n, 16) each."""
    w = list(np.ascontiguousarray(blocks.T))
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        s0 = _turned(x, 7) ^ _turned(x, 18) ^ (x >> np.uint32(3))
        s1 = _turned(y, 17) ^ _turned(y, 19) ^ (y >> np.uint32(10))
        w.append(w[i - 16] + s0 + w[i - 7] + s1)
    a, b, c, d, e, f, g, h = begin = np.ascontiguousarray(states.T)
    for k, x in zip(_ROUND, w):
        t = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + ((e & f) ^ (~e & g)) + k + x
        u = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return np.stack([a, b, c, d, e, f, g, h], 1) + begin.T


def hex_text(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 8) as lowercase hex (n, 64) bytes."""
    return _HEX[digests.astype(">u4").view(np.uint8)].view(np.uint8).reshape(-1, 64)


def take(states: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """States after one more child."""
    return absorb(states, hex_text(digests).view(">u4").astype(np.uint32))


def close(states: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Digests of states that took in ``width`` children each: one block of padding and length."""
    last = np.zeros((len(states), 16), np.uint32)
    last[:, 0] = 1 << 31
    last[:, 15] = 512 * width
    return absorb(states, last)


class Chunk(NamedTuple):
    """All levels over the nodes of some chunks, level by level; chunk c has ``counts[level][c]`` nodes there."""

    counts: list[np.ndarray]
    digests: list[np.ndarray]
    states: list[np.ndarray]

    def starts(self, level: int) -> np.ndarray:
        return np.cumsum(self.counts[level]) - self.counts[level]


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def levels_over(counts: np.ndarray, nodes: np.ndarray, whole: np.ndarray) -> Chunk:
    """Build the levels over chunks of ``counts`` nodes each.

    A chunk that is all its tree has (``whole``) goes up to one node; others go up by all levels, so a last one of
    few nodes is as high as its neighbours. ``states`` of a level hold a parent's states before its second and third slot.
    """
    out = Chunk([counts], [nodes], [])
    for _ in range(CHUNK_LEVELS):
        n = out.counts[-1]
        up = np.where(whole & (n <= 1), 0, -(-n // FANOUT))
        if not up.any():
            break
        place = _within(up)
        first = np.repeat(out.starts(len(out.counts) - 1), up) + FANOUT * place
        width = np.minimum(FANOUT, np.repeat(n, up) - FANOUT * place)
        below = out.digests[-1]
        state = take(np.broadcast_to(_START, (len(first), 8)), below[first])
        states = np.zeros((len(first), FANOUT - 1, 8), np.uint32)
        for k in range(1, FANOUT):
            states[:, k - 1] = state
            more = width > k
            state = state.copy()
            state[more] = take(state[more], below[first[more] + k])
        out.counts.append(up)
        out.states.append(states)
        out.digests.append(close(state, width))
    return out


class Steps(NamedTuple):
    """For each of some nodes its place under a parent: slot, number of children, state before the slot, siblings in order."""

    slot: np.ndarray
    width: np.ndarray
    state: np.ndarray
    siblings: np.ndarray

    BYTES = 2 + 32 * FANOUT

    def pack(self) -> np.ndarray:
        """A row of ``BYTES`` each."""
        words = np.concatenate([self.state[:, None], self.siblings], 1).astype(">u4")
        return np.concatenate([self.slot[:, None].astype(np.uint8), self.width[:, None].astype(np.uint8), words.view(np.uint8).reshape(-1, 32 * FANOUT)], 1)

    @classmethod
    def unpack(cls, rows: np.ndarray) -> Steps:
        words = np.ascontiguousarray(rows[:, 2:]).view(">u4").astype(np.uint32).reshape(-1, FANOUT, 8)
        return cls(rows[:, 0].astype(np.int64), rows[:, 1].astype(np.int64), words[:, 0], words[:, 1:])

    def fold(self, nodes: np.ndarray) -> np.ndarray:
        """Digests of the parents if ``nodes`` stood in these places."""
        state = take(self.state, nodes)
        for k in range(FANOUT - 1):
            right = (k >= self.slot) & (k < self.width - 1)
            state[right] = take(state[right], self.siblings[right, k])
        return close(state, self.width)


def steps_in(chunk: Chunk, level: int) -> tuple[np.ndarray, Steps]:
    """Of every lowest node its step from ``level``; also which nodes have one, in chunks that go higher than this."""
    place = _within(chunk.counts[0]) // FANOUT**level
    owner = np.repeat(np.arange(len(chunk.counts[0])), chunk.counts[0])
    higher = chunk.counts[level + 1][owner] > 0
    place, owner = place[higher], owner[higher]
    parent, slot = place // FANOUT, place % FANOUT
    width = np.minimum(FANOUT, chunk.counts[level][owner] - FANOUT * parent)
    at = chunk.starts(level + 1)[owner] + parent
    state = np.where((slot == 0)[:, None], _START, chunk.states[level][at, np.maximum(slot - 1, 0)])
    first = chunk.starts(level)[owner] + FANOUT * parent
    siblings = np.zeros((len(place), FANOUT - 1, 8), np.uint32)
    for k in range(FANOUT - 1):
        there = k < width - 1
        siblings[there, k] = chunk.digests[level][(first + k + (k >= slot))[there]]
    return higher, Steps(slot, width, state, siblings)


def _words(values: pa.Array) -> np.ndarray:
    """Binary digests as (n, 8) words."""
    return np.frombuffer(b"".join(values.to_pylist()), ">u4").astype(np.uint32).reshape(-1, 8)


def _bytes(digests: np.ndarray) -> list[bytes]:
    data = digests.astype(">u4").tobytes()
    return [data[k : k + 32] for k in range(0, len(data), 32)]


def _load(batch: pa.RecordBatch) -> Chunk:
    """The retained levels of some chunk rows."""
    rows = [np.frombuffer(x, ">u4").astype(np.uint32) for x in column(batch, "tree").to_pylist()]
    counts = np.array([[*c, *[0] * (CHUNK_LEVELS + 1 - len(c))] for c in column(batch, "counts").to_pylist()], np.int64).reshape(-1, CHUNK_LEVELS + 1)
    out = Chunk([], [], [])
    at = np.zeros(len(rows), np.int64)
    for level in range(CHUNK_LEVELS + 1):
        n = counts[:, level]
        out.counts.append(n)
        out.digests.append(np.concatenate([r[a : a + 8 * k] for r, a, k in zip(rows, at, n)]).reshape(-1, 8))
        at = at + 8 * n
        if level:
            out.states.append(np.concatenate([r[a : a + 16 * k] for r, a, k in zip(rows, at, n)]).reshape(-1, FANOUT - 1, 8))
            at = at + 16 * n
    return out


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, chunk, counts, tree, top of rows with key, chunk, size, nodes (a list of digests)."""
    for batch in (b.slice(k, AT_ONCE) for b in batches for k in range(0, b.num_rows, AT_ONCE)):
        nodes = column(batch, "nodes")
        counts = np.array([len(x) for x in nodes], np.int64)
        whole = column(batch, "size").to_numpy() <= CHUNK
        built = levels_over(counts, _words(nodes.flatten()), whole)
        trees, tops, heights = [], [], []
        starts = [built.starts(k) for k in range(len(built.counts))]
        for c in range(len(counts)):
            own = [k for k in range(len(built.counts)) if built.counts[k][c]]
            parts = []
            for k in own:
                some = slice(starts[k][c], starts[k][c] + built.counts[k][c])
                parts.append(built.digests[k][some].astype(">u4").tobytes())
                if k:
                    parts.append(built.states[k - 1][some].astype(">u4").tobytes())
            trees.append(b"".join(parts))
            tops.append(built.digests[own[-1]][starts[own[-1]][c]].astype(">u4").tobytes())
            heights.append([int(built.counts[k][c]) for k in own])
        yield pa.RecordBatch.from_pydict({
            "key": column(batch, "key"), "chunk": column(batch, "chunk"), "size": column(batch, "size"),
            "counts": pa.array(heights, pa.list_(pa.int32())), "tree": pa.array(trees, pa.binary()), "top": pa.array(tops, pa.binary()),
        })


def build(nodes: DataFrame) -> list[DataFrame]:
    """The trees over ``nodes`` (key, seq from 0 within the key, size of the key, digest), a stored table for each round.

    A row is a chunk: key, chunk, size (nodes of the key in this round), counts (its nodes by level), tree (by level the
    digests, above the lowest also the states of each) and top. The chunks' tops are the nodes of the next round.
    """
    rounds = []
    while True:
        grouped = nodes.groupBy("key", F.expr(f"seq div {CHUNK}").alias("chunk")).agg(
            F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("seq", "digest"))).alias("nodes")
        )
        rows = grouped.select("key", "chunk", "size", F.col("nodes.digest").alias("nodes"))
        schema = "key string, chunk bigint, size bigint, counts array<int>, tree binary, top binary"
        rounds.append(store(rows.mapInArrow(_build, schema), "merkle"))
        nodes = rounds[-1].where(F.col("size") > CHUNK).select(
            "key", F.col("chunk").alias("seq"), F.expr(f"(size + {CHUNK - 1}) div {CHUNK}").alias("size"), F.col("top").alias("digest")
        )
        if nodes.isEmpty():
            return rounds


def tops(rounds: list[DataFrame]) -> DataFrame:
    """key and the digest at the head of its tree."""
    heads = [r.where(F.col("size") <= CHUNK).select("key", F.col("top").alias("digest")) for r in rounds]
    return reduce(DataFrame.unionByName, heads)


def _node_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, seq and steps of every node of some chunk rows, their chunk's steps (``above``) put behind."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            chunk = _load(row)
            n = int(chunk.counts[0][0])
            packed = [steps_in(chunk, level)[1].pack() for level in range(CHUNK_LEVELS) if chunk.counts[level + 1][0]]
            own = np.concatenate(packed, 1).tobytes() if packed else b""
            width, above = len(own) // n, column(row, "above")[0].as_py()
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(column(row, "key").to_pylist() * n, pa.string()),
                "chunk": pa.array(column(row, "chunk")[0].as_py() * CHUNK + np.arange(n), pa.int64()),
                "above": pa.array([own[i * width : (i + 1) * width] + above for i in range(n)], pa.binary()),
            })


def above_chunks(rounds: list[DataFrame], heads: DataFrame) -> DataFrame:
    """key, chunk, above: the packed steps from each lowest chunk's top up; ``heads`` (key, above) are those from each tree's head."""
    top = lookup_side(heads)
    above = None
    for k in range(len(rounds) - 1, -1, -1):
        single = rounds[k].where(F.col("size") <= CHUNK).select("key", "chunk").join(top, "key")
        here = single if above is None else single.unionByName(above)
        if k == 0:
            return here
        # The nodes of this round are the chunks of the one before.
        rows = rounds[k].select("key", "chunk", "counts", "tree").join(here, ["key", "chunk"])
        above = store(rows.mapInArrow(_node_steps, "key string, chunk bigint, above binary"), "merkle-steps")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column | None = None) -> Column:
    """Digest (hex) of a document's row; ``text`` stands in for its text."""
    parts = [_field(text if text is not None and name == "text" else F.col(name)) for name in FIELDS]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """key, source, doc_id, seq, size, digest and changed (a digest to fold in, or null) of every row.

    ``seq`` counts a source's rows by doc_id, nulls first, rows of one doc_id by their digests; ``key`` names the source.
    """
    rows = docs.select(
        _field(F.col("source")).alias("key"), F.col("source").cast("string").alias("source"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(leaf()).alias("digest"), F.unhex(leaf(changed) if changed is not None else F.lit(None).cast("string")).alias("changed"),
    )
    placed = dense_sequence(rows, ["source", "doc_id", "digest", "changed"], "_seq")
    placed = placed.withColumn("changed", F.when(F.col("changed") != F.col("digest"), F.col("changed")))
    firsts = placed.groupBy("key").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("size"))
    return placed.join(lookup_side(firsts), "key").withColumn("seq", F.col("_seq") - F.col("_first")).drop("_seq", "_first")


class Manifest(NamedTuple):
    """The trees over the leaves of each source, and the one over their heads."""

    sources: list[DataFrame]
    heads: list[DataFrame]


def manifest(rows: DataFrame) -> Manifest:
    """The trees over ``leaves``."""
    sources = build(rows.select("key", "seq", "size", "digest"))
    named = tops(sources).join(rows.where("seq = 0").select("key", "source"), "key")
    placed = dense_sequence(named, ["source"])
    whole = placed.select(F.lit("").alias("key"), "seq", placed.agg(F.count(F.lit(1))).scalar().alias("size"), "digest")
    return Manifest(sources, build(whole))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds the leaves of chunk rows; all chunks of a batch at once, level by level."""

    def hexed(digests: np.ndarray) -> pa.Array:
        n = len(digests)
        data = pa.py_buffer(hex_text(digests).tobytes()) if n else pa.py_buffer(b"")
        return pa.StringArray.from_buffers(n, pa.py_buffer(np.arange(0, 64 * n + 1, 64, dtype=np.int32).tobytes()), data)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        chunk = _load(batch)
        n_leaves = chunk.counts[0]
        owner = np.repeat(np.arange(len(n_leaves)), n_leaves)
        original = chunk.digests[0]
        now = original.copy()
        changed = column(batch, "changed").flatten()
        there = np.flatnonzero(np.array(changed.is_valid()))
        if len(there):
            now[there] = _words(changed.drop_null())
        pieces = []  # (leaves, their siblings in this step)

        def step(some: np.ndarray, steps: Steps) -> None:
            now[some] = steps.fold(now[some])
            for k in range(FANOUT - 1):
                has = steps.width - 1 > k
                pieces.append((some[has], steps.siblings[has, k]))

        for level in range(CHUNK_LEVELS):
            if chunk.counts[level + 1].any():
                higher, steps = steps_in(chunk, level)
                step(np.flatnonzero(higher), steps)
        above = column(batch, "above").to_pylist()
        heights = np.array([len(x) // Steps.BYTES for x in above])
        for k in range(heights.max(initial=0)):
            high = np.flatnonzero(heights > k)
            rows = np.stack([np.frombuffer(above[c], np.uint8, Steps.BYTES, k * Steps.BYTES) for c in high])
            of = np.zeros(len(above), np.int64)
            of[high] = np.arange(len(high))
            some = np.flatnonzero(heights[owner] > k)
            step(some, Steps(*[x[of[owner[some]]] for x in Steps.unpack(rows)]))
        # Siblings of each leaf side by side: pieces come step by step, so a running place for each leaf will do.
        total = np.zeros(len(now), np.int64)
        for some, _ in pieces:
            total[some] += 1
        begin = np.cumsum(total) - total
        at, text = begin.copy(), np.zeros((int(total.sum()), 64), np.uint8)
        for some, siblings in pieces:
            text[at[some]] = hex_text(siblings)
            at[some] += 1
        data = memoryview(text.tobytes())
        proofs = [hashlib.sha256(data[64 * a : 64 * b]).hexdigest() for a, b in zip(begin.tolist(), (begin + total).tolist())]
        return pa.RecordBatch.from_pydict({
            "doc_id": column(batch, "doc_ids").flatten(), "leaf": hexed(original),
            "subroot": hexed(_words(column(batch, "subroot"))[owner]), "root": hexed(_words(column(batch, "root"))[owner]),
            "proof_sha256": pa.array(proofs, pa.string()), "folded_root": hexed(now),
        })

    for batch in batches:
        for k in range(0, batch.num_rows, AT_ONCE):
            yield work(batch.slice(k, AT_ONCE))


def fold(rows: DataFrame, built: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of ``leaves``, by the states of ``built``.

    A leaf with a ``changed`` digest is folded with that one. ``proof_sha256`` is the hash of the siblings from the leaf up.
    """
    whole = tops(built.heads).agg(F.first("digest")).scalar()
    above_heads = above_chunks(built.heads, rows.sparkSession.createDataFrame([("", b"")], "key string, above binary"))
    # Every node of the tree over the heads, by its place; places follow the sources.
    of_head = above_heads.join(built.heads[0].select("key", "chunk", "counts", "tree"), ["key", "chunk"])
    steps = of_head.mapInArrow(_head_steps, "digest binary, above binary")
    # Sources of one subroot cannot be: a leaf holds its source.
    heads = store(tops(built.sources).withColumnRenamed("digest", "subroot").join(steps.withColumnRenamed("digest", "subroot"), "subroot"), "merkle-heads")
    above = above_chunks(built.sources, heads.select("key", "above"))
    lists = rows.groupBy("key", F.expr(f"seq div {CHUNK}").alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("seq", "doc_id", "changed"))).alias("of")
    )
    chunks = (
        built.sources[0].select("key", "chunk", "counts", "tree")
        .join(lists.select("key", "chunk", F.col("of.doc_id").alias("doc_ids"), F.col("of.changed").alias("changed")), ["key", "chunk"])
        .join(above, ["key", "chunk"]).join(lookup_side(heads.select("key", "subroot")), "key").withColumn("root", whole)
    )
    schema = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return chunks.drop("key", "chunk").mapInArrow(_fold, schema).withColumn("verified", F.col("folded_root") == F.col("root"))


def _head_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """digest and steps of every node of some chunk rows."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            chunk = _load(row)
            for some in _node_steps(iter([row])):
                yield pa.RecordBatch.from_pydict({"digest": pa.array(_bytes(chunk.digests[0]), pa.binary()), "above": column(some, "above")})


def audit(docs: DataFrame, tampered: Column) -> DataFrame:
    """Fold every row of ``docs`` into the manifest of ``docs``, with its text as ``tampered`` gives it.

    doc_id, leaf, subroot, root, proof_sha256 (all of the untouched table), folded_root, and verified: whether that is the
    root. Null values count as such, apart from empty ones; repeated rows are leaves of their own; null sources
    are one source, the first; null doc_ids come first in their source; empty tables give no rows; other columns
    are not looked at.
    """
    rows = store(leaves(docs, tampered), "merkle-leaves")
    return fold(rows, manifest(rows))
