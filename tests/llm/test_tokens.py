import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wardline.llm import bpe, token_store

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def strange_texts(n):
    draw = random.Random(5)
    points = [c for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(chr(draw.choice(points)) for _ in range(50)) for _ in range(n)]
    texts += ["".join(draw.choice("aZÉñ,.;:!?'s ́\x1c ​ $1<|>\n\tKİΣ-=") for _ in range(60)) for _ in range(4 * n)]
    texts += ["".join(draw.choice("thenrdai") for _ in range(40)) for _ in range(n)]
    return texts + ["a" * 3000, "aaab" * 500, "x<|endoftext|>y <|endoftext|>.", " \n\n  x\t\t y  ", "don't I'M 'll", "", "İ.", "ΑΣ. Α"]


def test_bytes_encode_and_decode_as_the_library_does():
    own, library = bpe.ByteBpe(open(BYTES).read()), Tokenizer.from_file(BYTES)
    texts = strange_texts(150)
    for text, packed in zip(texts, own.encode(texts)):
        ids = np.frombuffer(packed, "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, ascii(text)
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_checks_fail_exactly_where_greedy_is_wrong():
    own = bpe.ByteBpe(open(BYTES).read())
    pieces = [w for t in strange_texts(150) for w in own.find(t)]
    for piece in dict.fromkeys(pieces):
        raw = piece.encode()
        greedy, exact = own.propose(raw), own.merge(raw)
        pairs = np.array(list(zip(greedy, greedy[1:])), np.int64).reshape(-1, 2)
        assert own.crosses(pairs[:, 0], pairs[:, 1]).any() == (greedy != exact), ascii(piece)


def test_long_pieces_merge_alike(monkeypatch):
    own = bpe.ByteBpe(open(BYTES).read())
    texts = [t.encode()[:300] for t in strange_texts(10)]
    short = [own.merge(t) for t in texts]
    monkeypatch.setattr(bpe, "SHORT_PIECE", 0)
    assert [own.merge(t) if len(t) else [] for t in texts] == short


def test_encode_decode_of_odd_rows(spark, odd_docs, no_docs):
    out = bpe.encode_decode(odd_docs, BYTES, keep=True).collect()
    assert len(out) == 8
    for r in out:
        assert hashlib.sha256(r.decoded.encode()).hexdigest() == r.decoded_sha256 and 4 * r.n_tokens == len(r.ids)
    assert sorted(r.decoded for r in out) == sorted(r.text or "" for r in odd_docs.collect())
    assert bpe.encode_decode(no_docs, BYTES).count() == 0


def test_words_encode_as_the_library_does():
    own, library = token_store.WordEncoder(open(WORDS).read(), 2), Tokenizer.from_file(WORDS)
    texts = strange_texts(150)
    for text, packed in zip(texts, own.encode(texts)):
        assert np.frombuffer(packed, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


@pytest.mark.parametrize("n", [0, 1, 2, 100, 5000])
def test_key_index_is_minimal_and_perfect(n):
    draw = random.Random(n)
    keys = np.array(sorted({draw.randrange(-(2**62), 2**62) for _ in range(n)}), np.int64)
    first = np.arange(len(keys))
    index = token_store.KeyIndex.from_bytes(token_store.KeyIndex.build(keys, first, first + 1).to_bytes())
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    at, count = index.find(keys)
    assert (at == first).all() and (count == first + 1).all()
    missing = np.array([draw.randrange(2**62, 2**63 - 1) for _ in range(200)], np.int64)
    assert (index.find(missing)[0] == -1).all()


def test_keys_left_after_the_last_level_are_found(monkeypatch):
    monkeypatch.setattr(token_store.KeyIndex, "LEVELS", 1)
    keys = np.arange(0, 7000, 7)
    index = token_store.KeyIndex.from_bytes(token_store.KeyIndex.build(keys, keys, keys).to_bytes())
    assert len(index.rest) and (index.find(keys)[0] == keys).all()


def test_store_round_trip_in_several_shards(spark, odd_docs, fresh_dir, monkeypatch):
    library = Tokenizer.from_file(WORDS)
    token_store.write_store(odd_docs, WORDS, f"{fresh_dir}/store", partition_bytes=100)
    rows = sorted(token_store.read_store(spark, f"{fresh_dir}/store").collect(), key=lambda r: r.start)
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    begin = 0
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        (text,) = texts[r.doc_id]
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (begin, len(ids), zlib.crc32(r.ids))
        begin += len(ids)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 5, 5, 7, 8]
    found = token_store.lookup(spark, f"{fresh_dir}/store", [5, 8, 99]).collect()
    assert sorted(r.doc_id for r in found) == [5, 5, 8]


def test_empty_store(spark, no_docs, fresh_dir):
    token_store.write_store(no_docs, WORDS, f"{fresh_dir}/store")
    assert token_store.read_store(spark, f"{fresh_dir}/store").count() == 0
    assert token_store.lookup(spark, f"{fresh_dir}/store", []).count() == 0
