"""A worker's memory of results by word, bounded in bytes."""

from __future__ import annotations

from collections.abc import Iterable

# What an entry takes besides its characters and bytes: two objects' heads and its place in the table.
ENTRY_BYTES = 190


class Memory:
    """Bytes by word in two generations: when the younger is full it becomes the older one, and what is asked for moves back.

    So words in use outlive the rest, and a worker holds no more than twice ``most_bytes``, whatever it has seen.
    """

    def __init__(self, most_bytes: int):
        self.most_bytes = most_bytes
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def turn(self) -> None:
        """Begin a new generation if this one is full; only between batches, as a batch counts on what it asked for."""
        if self.size > self.most_bytes:
            self.old, self.young, self.size = self.young, {}, 0

    def missing(self, words: Iterable[str]) -> list[str]:
        """Which of these distinct words are not known; the others are in ``young`` from now on."""
        out = []
        for w in set(words).difference(self.young):
            found = self.old.get(w)
            if found is None:
                out.append(w)
            else:
                self.put(w, found)
        return out

    def put(self, word: str, value: bytes) -> None:
        self.young[word] = value
        self.size += len(word) + len(value) + ENTRY_BYTES
