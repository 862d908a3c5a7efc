"""Numbers for different words, in one pass."""

from __future__ import annotations


class Numbers(dict):
    """Numbers words in the order in which they are first asked for; ``new`` has the latest."""

    def __init__(self, words: list[str]):
        super().__init__(zip(words, range(len(words))))
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n
