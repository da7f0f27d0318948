"""Byte-pair encoding and decoding by speculation and verification.

Greedy longest match proposes tokens for each distinct piece of text. A sequence
of tokens is the encoding of its text exactly if every two neighbours are
compatible, that is, if no merge across their border comes due before both are
complete. These checks run on arrays over all distinct neighbours of a batch; only
pieces that fail one go through merging in rank order.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wardline.llm.common import column, in_groups, map_batches, texts
from wardline.llm.memory import Memory

# Fixed value: the pre-tokenizer's pattern, white space spelt out as Unicode's White_Space.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^%(s)s\p{L}\p{N}]+|[%(s)s]+(?![^%(s)s])|[%(s)s]+"
    % {"s": _SPACE}
)

# Bytes of a generation of remembered words, and of pieces; a worker holds two of each.
REMEMBERED_BYTES = 40 * 1024 * 1024
NEVER = 1 << 40
# Bytes up to which a piece is merged by rescanning its pairs.
SHORT_PIECE = 64


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteBpe:
    """Encoder and decoder for one byte-level vocabulary with ranked merges."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        symbols = byte_symbols()
        vocabulary: dict[str, int] = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocabulary.values(), *self.specials.values()]) + 1
        self.token = [b""] * size
        for text, i in vocabulary.items():
            self.token[i] = bytes(symbols[c] for c in text)
        for text, i in self.specials.items():
            self.token[i] = text.encode()
        self.size = size
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.rank = {(a, b): (r, m) for r, (a, b, m) in enumerate(zip(left.tolist(), right.tolist(), made.tolist()))}
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank = keys[order], order.astype(np.int64)
        self.byte_id = [vocabulary[s] for s, _ in sorted(symbols.items(), key=lambda x: x[1])]
        self._spines(left, right, made)
        self._vocabulary(left, right, made)
        self.find = regex.compile(PATTERN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        # Spaces that the pattern does not simply put before the next word.
        self.spaces = [c for c in map(chr, range(0x3001)) if re.match(f"[{_SPACE}]", c)]
        self.known, self.words = Memory(REMEMBERED_BYTES), Memory(REMEMBERED_BYTES)
        # The bytes of all tokens one after the other, to be taken by id.
        self.token_bytes = pa.array(self.token, pa.binary())

    def _spines(self, left, right, made) -> None:
        """For each token, its outermost parts on either side and the rank of the merge that ends each part."""
        first = [[(i, NEVER)] for i in range(self.size)]
        last = [[(i, NEVER)] for i in range(self.size)]
        for r, (a, b, m) in enumerate(zip(left.tolist(), right.tolist(), made.tolist())):
            first[m] = [(m, NEVER), (a, r), *first[a][1:]]
            last[m] = [(m, NEVER), (b, r), *last[b][1:]]
        self.first, self.last = _ragged(first), _ragged(last)

    def _vocabulary(self, left, right, made) -> None:
        """The tokens that merging their own text gives back; greedy matching proposes only these."""
        crossed = self.crosses(left, right, np.arange(len(left), dtype=np.int64))
        sound = np.zeros(self.size, bool)
        sound[self.byte_id] = True
        for a, b, m, bad in zip(left.tolist(), right.tolist(), made.tolist(), crossed.tolist()):
            sound[m] = not bad and sound[a] and sound[b]
        self.ids = {self.token[i]: i for i in np.flatnonzero(sound).tolist()}
        lengths: dict[bytes, set[int]] = {}
        for t in self.ids:
            if len(t) > 2:
                lengths.setdefault(t[:3], set()).add(len(t))
        self.lengths = {k: sorted(v, reverse=True) for k, v in lengths.items()}

    def crosses(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """For neighbours a and b: does a merge across their border come due while both its parts stand?

        Of two merges of the same rank the left one goes first, so the left part
        must stand longer than the merge's rank and the right part at least as long.
        """
        (starts_a, tokens_a, ends_a), (starts_b, tokens_b, ends_b) = self.last, self.first
        most = np.full(len(a), NEVER) if until is None else until
        bad = np.zeros(len(a), bool)
        depth_a, depth_b = starts_a[a + 1] - starts_a[a], starts_b[b + 1] - starts_b[b]
        for i in range(int(depth_a.max(initial=0))):
            for j in range(int(depth_b.max(initial=0))):
                at = np.flatnonzero((depth_a > i) & (depth_b > j) & ~bad)
                if not len(at):
                    continue
                x, y = starts_a[a[at]] + i, starts_b[b[at]] + j
                key = tokens_a[x] * self.size + tokens_b[y]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = np.where(self.keys[place] == key, self.key_rank[place], NEVER)
                bad[at] = (rank < np.minimum(ends_a[x], most[at])) & (rank <= np.minimum(ends_b[y], most[at]))
        return bad

    def propose(self, piece: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, end, find, lengths = [], 0, len(piece), self.ids.get, self.lengths.get
        while at < end:
            for n in lengths(piece[at : at + 3], ()):
                part = piece[at : at + n]
                if (token := find(part)) is not None and len(part) == n:
                    break
            else:
                if (token := find(part := piece[at : at + 2])) is None:
                    token = find(part := part[:1])
            out.append(token)
            at += len(part)
        return out

    def merge(self, piece: bytes) -> list[int]:
        """Exact encoding: merge by rank, the leftmost of equals first."""
        ids = [self.byte_id[b] for b in piece]
        if len(ids) > SHORT_PIECE:
            return self._merge_long(ids)
        get, never = self.rank.get, (NEVER, -1)
        pairs = [get(p, never) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best[1] < 0:
                break
            i = pairs.index(best)
            ids[i : i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get((ids[i - 1], ids[i]), never)
            if i < len(pairs):
                pairs[i] = get((ids[i], ids[i + 1]), never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same over a linked list and a heap, as rescanning a long piece takes its square."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        due: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := self.rank.get((ids[i], ids[j]))):
                heapq.heappush(due, (found[0], i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while due:
            _, i, a, b = heapq.heappop(due)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i] = self.rank[a, b][1]
            ids[j] = -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [t for t in ids if t >= 0]

    def learn(self, pieces: list[str]) -> tuple[int, int]:
        """Encode new pieces into ``known``; returns how many were new and how many failed a check."""
        if not pieces:
            return 0, 0
        raw = [p.encode() for p in pieces]
        proposed = [self.propose(p) for p in raw]
        counts = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(pieces)), counts)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        code, back = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        bad = self.crosses(code // self.size, code % self.size)[back]
        failed = np.unique(owner[inside[bad]])
        packed = flat.astype("<u4").tobytes()
        ends = (4 * np.cumsum(counts)).tolist()
        begin = 0
        for p, end in zip(pieces, ends):
            self.known.put(p, packed[begin:end])
            begin = end
        for i in failed.tolist():
            self.known.put(pieces[i], array("I", self.merge(raw[i])).tobytes())
        return len(pieces), len(failed)

    def split(self, text: str) -> list[str]:
        if self.special is None or "<" not in text:
            return self.find(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out.extend([part] if i % 2 else self.find(part))
        return out

    def loose(self, text: str) -> bool:
        if "  " in text or text[:1] in self.spaces or text[-1:] in self.spaces:
            return True
        return any(c in text and (" " + c in text or c + " " in text) for c in self.spaces if c != " ")

    def encode(self, batch: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Words between single spaces are looked up whole, with the space before them, as no
        piece crosses from one to the next; other texts are looked up by piece.
        """
        self.known.turn()
        self.words.turn()
        special = [s for s in self.specials]
        plan, loose, spaced = [], [], []
        for text in batch:
            if self.loose(text) or any(s in text for s in special):
                plan.append((False, self.split(text)))
                loose.append(plan[-1][1])
            else:
                first, *rest = text.split(" ")
                plan.append((True, (self.find(first), rest)))
                loose.append(plan[-1][1][0])
                spaced.append(rest)
        pieces_of = {w: self.find(" " + w) for w in self.words.missing(set().union(*spaced))}
        self.known_specials()
        self.learn(self.known.missing(set().union(*loose, *pieces_of.values())))
        get = self.known.young.__getitem__
        for w, pieces in pieces_of.items():
            self.words.put(w, b"".join(map(get, pieces)) if len(pieces) > 1 else get(pieces[0]) if pieces else b"")
        word = self.words.young.__getitem__
        return [
            b"".join(map(get, parts[0])) + b"".join(map(word, parts[1])) if spaced else b"".join(map(get, parts))
            for spaced, parts in plan
        ]

    def known_specials(self) -> None:
        for text in self.known.missing(self.specials):
            self.known.put(text, np.array([self.specials[text]], "<u4").tobytes())

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0].decode(errors="replace")

    def decode_all(self, batch: list[bytes]) -> list[bytes]:
        """The bytes of each text's tokens: one lookup of all ids in the table of tokens."""
        ends = np.cumsum(np.fromiter(map(len, batch), np.int64, len(batch))) // 4
        found = self.token_bytes.take(pa.array(np.frombuffer(b"".join(batch), "<u4")))
        cuts = np.frombuffer(found.buffers()[1], np.int32)[: len(found) + 1] if len(found) else np.zeros(1, np.int32)
        data = found.buffers()[2].to_pybytes() if len(found) else b""
        borders = [0, *cuts[ends].tolist()]
        return [data[a:b] for a, b in zip(borders, borders[1:])]


def _ragged(rows: list[list[tuple[int, int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    flat = [x for r in rows for x in r]
    return starts, np.array([t for t, _ in flat], np.int64), np.array([e for _, e in flat], np.int64)


_coders: dict[str, ByteBpe] = {}


def coder(definition: str) -> ByteBpe:
    """One coder a worker and vocabulary."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _coders:
        _coders[key] = ByteBpe(definition)
    return _coders[key]


def encode_decode(docs: DataFrame, tokenizer_path: str, keep: bool = False) -> DataFrame:
    """doc_id, ids (packed unsigned 32-bit), the decoded text and digests of both, a row for each row.

    Null and empty texts have no ids and decode to the empty text. Repeated rows stay
    repeated; a null doc_id stays null. Columns other than doc_id and text are not
    looked at. Without ``keep`` the ids and the text themselves are left out.
    The vocabulary file (of fixed size) is read by the driver and broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = coder(definition.value)
        n, ids_sha, text_sha, ids, decoded = [], [], [], [], []
        for group in in_groups(column(batch, "text").to_pylist()):
            encoded = own.encode(group)
            for packed, text in zip(encoded, own.decode_all(encoded)):
                # Ids of a text give back its bytes; what is no text would come out with replacement characters.
                text = text.decode(errors="replace")
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                text_sha.append(hashlib.sha256(text.encode()).hexdigest())
                if keep:
                    ids.append(packed)
                    decoded.append(text)
        out = {"doc_id": column(batch, "doc_id"), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
        if keep:
            out |= {"ids": pa.array(ids, pa.binary()), "decoded": pa.array(decoded, pa.string())}
        return pa.RecordBatch.from_pydict(out)

    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(rows, work, schema + ", ids binary, decoded string" * keep)
