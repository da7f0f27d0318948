import os

import public_tokenizers

from wardline.llm import token_store

WORDS = public_tokenizers.path("word_bpe_49k.json")


class Spy:
    """The tokenizer, noting the thread setting that each batch is encoded under."""

    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, []

    def encode_batch_fast(self, *args, **kwargs):
        self.seen.append(os.environ.get(token_store.PARALLELISM))
        return self.tokenizer.encode_batch_fast(*args, **kwargs)


def test_stems_are_encoded_without_the_thread_pool_and_the_setting_comes_back(monkeypatch):
    monkeypatch.setenv(token_store.PARALLELISM, "true")
    own = token_store.WordEncoder(open(WORDS).read(), 2)
    plain = token_store.WordEncoder(open(WORDS).read(), 2)
    own.tokenizer = Spy(own.tokenizer)
    texts = ["the cat sat, on the mat.", "", "Don't stop!", "naïve café"]
    assert own.encode(texts) == plain.encode(texts)
    assert own.tokenizer.seen and set(own.tokenizer.seen) == {"false"}
    assert os.environ[token_store.PARALLELISM] == "true"
