"""Token ids as raw binary shards with a minimal perfect hash index of document keys.

A store is a folder of Parquet files with one row for each shard:

    part, shard     place in the global order: all ids of smaller (part, shard) come before
    first_doc, last_doc   smallest and largest document key (null keys come first)
    n_docs, n_ids   documents and ids in the shard
    width           bytes of an id, 2 or 4
    payload         the ids of all documents one after the other, little endian
    docs            number of null keys; document keys in order of the payload; where each document's ids begin, and the end
    index           minimal perfect hash over the distinct keys; see ``KeyIndex``

A keyed read takes one shard's row, a fixed number of probes into its index and two places in ``docs``, all read where
they lie, and one slice of the payload.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import column, in_groups, map_batches, texts
from wardline.llm.memory import Memory
from wardline.session import partitions_for

SHARD_IDS = 8 * 1024 * 1024
PARTITION_BYTES = 24 * 1024 * 1024
# Bytes of a generation of remembered words, and of stems; a worker holds two of each.
REMEMBERED_BYTES = 24 * 1024 * 1024
ENCODED_AT_ONCE = 4_096
ROWS_AT_ONCE = 1_000
MOST_KEYS = 1_000
PARALLELISM = "TOKENIZERS_PARALLELISM"

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key; another one for each seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + _MIX[0] * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


class KeyIndex:
    """Minimal perfect hash from distinct 64-bit keys to slots, with a fingerprint and a place in each slot.

    Level by level, keys that alone hash to a bit of the level take it; the others go
    on to the next level. The slot is the number of bits set before. Keys left after
    the last level are kept in a sorted list and take the last slots.
    """

    LEVELS = 24
    FINGERPRINT_SEED = 1 << 20

    def __init__(self, levels, before, rest, fingerprints, first, count):
        """``before`` holds for each word of a level the bits set before it, in all levels."""
        self.levels, self.before, self.rest = levels, before, rest
        self.fingerprints, self.first, self.count = fingerprints, first, count
        self.in_levels = len(first) - len(rest)

    @classmethod
    def build(cls, keys: np.ndarray, first: np.ndarray, count: np.ndarray) -> KeyIndex:
        """Of sorted distinct keys; document number ``first`` is the key's first of ``count`` in the shard."""
        levels, left = [], keys
        while len(left) and len(levels) < cls.LEVELS:
            words = (2 * len(left) + 63) // 64
            at = (mixed(left, len(levels)) % np.uint64(64 * words)).astype(np.int64)
            alone = np.bincount(at, minlength=64 * words)[at] == 1
            bits = np.zeros(words, np.uint64)
            np.bitwise_or.at(bits, at[alone] // 64, np.uint64(1) << (at[alone] % 64).astype(np.uint64))
            levels.append(bits)
            left = left[~alone]
        before, total = [], 0
        for bits in levels:
            ones = np.bitwise_count(bits).astype(np.int64)
            before.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
        index = cls(levels, before, np.sort(left), np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<i8"), np.zeros(len(keys), "<i8"))
        slot = index.slots(keys)
        index.fingerprints[slot] = index.fingerprint(keys)
        index.first[slot], index.count[slot] = first, count
        return index

    def fingerprint(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys, self.FINGERPRINT_SEED) >> np.uint64(32)).astype("<u4")

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has its bit; a key that was never added may get any slot."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.levels, self.before)):
            at = (mixed(keys[todo], level) % np.uint64(64 * len(bits))).astype(np.int64)
            word, bit = bits[at // 64], (at % 64).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[todo[hit]] = (before[at // 64] + below)[hit]
            todo = todo[~hit]
        if len(self.rest) and len(todo):
            place = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            found = self.rest[place] == keys[todo]
            out[todo[found]] = self.in_levels + place[found]
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document number and number of documents of each key; -1 and 0 where it is not here."""
        slot = self.slots(keys)
        here = slot >= 0
        here[here] = self.fingerprints[slot[here]] == self.fingerprint(keys[here])
        return np.where(here, self.first[slot], -1) if len(self.first) else slot, np.where(here, self.count[slot], 0) if len(self.count) else 0 * slot

    def to_bytes(self) -> bytes:
        head = [len(self.levels), *map(len, self.levels), len(self.rest), len(self.first)]
        parts = [np.array([len(head), *head], "<i8"), *self.levels, *self.before, self.rest.astype("<i8"), self.first, self.count, self.fingerprints]
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes | memoryview) -> KeyIndex:
        """The index as it lies in ``data``: nothing but the head, of a size for each level, is read or copied."""
        n = int(np.frombuffer(data, "<i8", 1)[0])
        head = np.frombuffer(data, "<i8", n, 8).tolist()
        at = 8 * (n + 1)

        def take(kind: str, length: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, length, at)
            at += out.nbytes
            return out

        sizes, rest, size = head[1 : 1 + head[0]], head[-2], head[-1]
        levels, before = [take("<u8", k) for k in sizes], [take("<i8", k) for k in sizes]
        rest = take("<i8", rest)
        first, count = take("<i8", size), take("<i8", size)
        return cls(levels, before, rest, take("<u4", size), first, count)


@contextmanager
def _single_threaded() -> Iterator[None]:
    """The tokenizers library without its thread pool; the setting before is restored after."""
    before = os.environ.get(PARALLELISM)
    os.environ[PARALLELISM] = "false"
    try:
        yield
    finally:
        if before is None:
            del os.environ[PARALLELISM]
        else:
            os.environ[PARALLELISM] = before


class WordEncoder:
    """The tokenizers library behind a memory of words.

    The vocabulary's pre-tokenizer never joins text across white space nor a letter to punctuation, its
    normalizer treats what lies between by itself and lower-cases it, so each word is encoded
    once, without the punctuation after it.
    """

    GAP = re.compile("[ \t\n\r]+")
    # Python splits at these too, the pre-tokenizer does not.
    NO_GAPS = re.compile("[\x1c-\x1f]").search
    MARKS = ".,;:!?"

    def __init__(self, definition: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = {2: "H", 4: "I"}[width]
        self.width = width
        self.words, self.stems = Memory(REMEMBERED_BYTES), Memory(REMEMBERED_BYTES)

    def parts(self, word: str) -> tuple[str, str]:
        """What is encoded by itself: the word in lower case if it is ASCII, and the marks behind its last letter."""
        stem, marks = word, ""
        if word[-1:] in self.MARKS:
            stem = word.rstrip(self.MARKS)
            if stem and stem[-1] < "\u0250" and stem[-1].isalpha() and stem[-1] != "İ":
                marks = word[len(stem) :]
            else:
                stem = word
        return (stem.lower() if stem.isascii() else stem), marks

    def _learn(self, stems: list[str]) -> None:
        """Encode stems into ``stems``.

        A task has one core: the library's own thread pool would only spin on it, so it is off while stems are encoded.
        """
        for at in range(0, len(stems), ENCODED_AT_ONCE):
            some = stems[at : at + ENCODED_AT_ONCE]
            with _single_threaded():
                ids = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            packed, begin = array(self.kind, chain.from_iterable(ids)).tobytes(), 0
            for stem, own in zip(some, ids):
                end = begin + self.width * len(own)
                self.stems.put(stem, packed[begin:end])
                begin = end

    def encode(self, batch: list[str]) -> list[bytes]:
        """Ids of each text, packed."""
        self.words.turn()
        self.stems.turn()
        split = [self.GAP.split(t) if self.NO_GAPS(t) else t.split() for t in batch]
        new = {w: self.parts(w) for w in self.words.missing(set().union(*split))}
        self._learn(self.stems.missing({p for parts in new.values() for p in parts}))
        stems = self.stems.young
        for w, (stem, marks) in new.items():
            self.words.put(w, stems[stem] + stems[marks])
        get = self.words.young.__getitem__
        return [b"".join(map(get, ws)) for ws in split]


_encoders: dict[tuple[int, int], WordEncoder] = {}


def _encoder(definition: str, width: int) -> WordEncoder:
    key = (zlib.crc32(definition.encode()), width)
    if key not in _encoders:
        _encoders[key] = WordEncoder(definition, width)
    return _encoders[key]


STORE_SCHEMA = (
    "part int, shard int, first_doc bigint, last_doc bigint, n_docs bigint, n_ids bigint, width int, "
    "payload binary, docs binary, index binary"
)


def _shard(part: int, shard: int, width: int, ids: list, null: list, encoded: list[bytes]) -> dict:
    keys = np.array(ids, np.int64)
    there = ~np.array(null, bool)
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // width
    distinct, first, count = np.unique(keys[there], return_index=True, return_counts=True)
    index = KeyIndex.build(distinct, first + int((~there).sum()), count)
    known = keys[there]
    row = {
        "part": part, "shard": shard, "first_doc": int(known[0]) if len(known) else None,
        "last_doc": int(known[-1]) if len(known) else None, "n_docs": len(keys), "n_ids": int(lengths.sum()), "width": width,
        "payload": b"".join(encoded), "docs": np.array([int((~there).sum()), *keys, 0, *np.cumsum(lengths)], "<i8").tobytes(), "index": index.to_bytes(),
    }
    types = {"part": pa.int32(), "shard": pa.int32(), "width": pa.int32(), "payload": pa.binary(), "docs": pa.binary(), "index": pa.binary()}
    return {k: pa.array([v], types.get(k, pa.int64())) for k, v in row.items()}


def write_store(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1, partition_bytes: int = PARTITION_BYTES) -> None:
    """Encode every text, append ``end_id`` and write the shards in ascending order of doc_id.

    Null and empty texts consist of the end id alone. Rows with null doc_id come first and
    have no index entry; repeated doc_ids lie side by side (ordered by a hash of their text)
    and share an entry in each shard that holds them. Other columns are not looked at.
    A partition is cut into shards of about ``SHARD_IDS`` ids, which bounds a task's memory.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    definition = spark.sparkContext.broadcast(text)
    width = 2 if _largest_id(text, end_id) < 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = _encoder(definition.value, width), TaskContext.get().partitionId()
        end = array(own.kind, [end_id]).tobytes()
        shard, size, ids, null, encoded = 0, 0, [], [], []
        for batch in batches:
            names = column(batch, "doc_id").to_pylist()
            parts = (column(batch, "text").slice(k, ROWS_AT_ONCE).to_pylist() for k in range(0, len(names), ROWS_AT_ONCE))
            coded = (p for some in parts for group in in_groups(some) for p in own.encode(group))
            for name, packed in zip(names, coded):
                ids.append(0 if name is None else name)
                null.append(name is None)
                encoded.append(packed + end)
                size += len(packed) // width + 1
                if size >= SHARD_IDS:
                    yield pa.RecordBatch.from_pydict(_shard(part, shard, width, ids, null, encoded))
                    shard, size, ids, null, encoded = shard + 1, 0, [], [], []
        if ids:
            yield pa.RecordBatch.from_pydict(_shard(part, shard, width, ids, null, encoded))

    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    order = ["doc_id", F.xxhash64("text")]
    parts = partitions_for(docs, target_bytes=partition_bytes)
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, STORE_SCHEMA).write.parquet(path)


def _largest_id(definition: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_str(definition).get_vocab_size() - 1, end_id)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, shard, start: the ids before each shard. One row for each shard, of about 16 MB, in the window."""
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = spark.read.parquet(path).select("part", "shard", "n_ids")
    return sizes.select("part", "shard", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("start"))


class Shard:
    """A shard's row for keyed reads; its parts are looked into where they lie."""

    def __init__(self, n_docs: int, width: int, payload: bytes | memoryview, docs: bytes | memoryview, index: bytes | memoryview):
        data = np.frombuffer(docs, "<i8")
        self.keys, self.starts, self.n_null = data[1 : n_docs + 1], data[n_docs + 1 :], int(data[0])
        self.ids = np.frombuffer(payload, f"<u{width}")
        self.index = KeyIndex.from_bytes(index)

    @classmethod
    def of(cls, batch: pa.RecordBatch, row: int) -> Shard:
        payload, docs, index = (memoryview(column(batch, c)[row].as_buffer()) for c in ("payload", "docs", "index"))
        return cls(column(batch, "n_docs")[row].as_py(), column(batch, "width")[row].as_py(), payload, docs, index)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The documents of distinct keys, by their numbers in the shard."""
        first, count = self.index.find(keys)
        here = count > 0
        first, count = first[here], count[here]
        return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())

    def read(self, number: int) -> np.ndarray:
        """The ids of a document: one slice of the payload."""
        return self.ids[self.starts[number] : self.starts[number + 1]].astype("<u4")


def _read_docs(shard: Shard, wanted: np.ndarray | None = None) -> dict:
    """Documents of a shard through its index; ``wanted`` are distinct keys, else all documents."""
    if wanted is None:
        at = np.concatenate([np.arange(shard.n_null), shard.numbers(np.unique(shard.keys[shard.n_null :]))])
    else:
        at = shard.numbers(wanted)
    names = pa.array(shard.keys[at], pa.int64(), mask=at < shard.n_null)
    slices = [shard.read(i).tobytes() for i in at.tolist()]
    return {"doc_id": names, "offset": shard.starts[at], "n_tokens": shard.starts[at + 1] - shard.starts[at], "ids": slices}


def read_store(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and the ids (packed unsigned 32-bit) of every document, found through the index.

    Rows of null or repeated keys are there as often as they were written; an empty store gives no rows.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(batch.num_rows):
            found = _read_docs(Shard.of(batch, k))
            part, shard = column(batch, "part")[k].as_py(), column(batch, "shard")[k].as_py()
            out = {
                "part": pa.array([part] * len(found["ids"]), pa.int32()), "shard": pa.array([shard] * len(found["ids"]), pa.int32()),
                "doc_id": found["doc_id"], "offset": pa.array(found["offset"], pa.int64()), "n_tokens": pa.array(found["n_tokens"], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x) for x in found["ids"]], pa.int64()),
            }
            if with_ids:
                out["ids"] = pa.array(found["ids"], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from work(batch.slice(k, 1))

    schema = "part int, shard int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    docs = spark.read.parquet(path).mapInArrow(run, schema)
    placed = docs.join(shard_starts(spark, path), ["part", "shard"])
    return placed.select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of up to ``MOST_KEYS`` keys; only shards whose range holds one of them are read.

    A key that is not in the store gives no row, one that is asked for twice gives its documents once, one that several
    documents have gives a row for each. For more keys, join ``read_store``.
    """
    if not doc_ids:
        return spark.createDataFrame([], "doc_id bigint, ids binary")
    if len(set(doc_ids)) > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} keys: join read_store instead")
    wanted = np.unique(np.array(doc_ids, np.int64))
    ranges = [(F.col("first_doc") <= int(k)) & (F.col("last_doc") >= int(k)) for k in set(doc_ids)]
    some = ranges[0]
    for r in ranges[1:]:
        some = some | r

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_read_docs(Shard.of(batch, k), wanted) for k in range(batch.num_rows)]
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([x for f in found for x in f["doc_id"].to_pylist()], pa.int64()),
            "ids": pa.array([x for f in found for x in f["ids"]], pa.binary()),
        })

    return map_batches(spark.read.parquet(path).where(some), work, "doc_id bigint, ids binary")
