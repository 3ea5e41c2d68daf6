"""Word and line statistics of one text, on its UTF-8 bytes (bytes.split cuts at ASCII white space)."""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

_SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b".,;:!?()[]{}\"'-_=+/\\@~`^"


class Stats(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_capitals: int
    n_digits: int
    n_marks: int


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text has at least twice, first ones included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if count[window] > 1:
            covered += at + 3 - max(end, at)
            end = at + 3
    return covered


def text_stats(text: str) -> tuple[Stats, list[bytes]]:
    """The statistics and the words of a whole text."""
    data = text.encode()
    words = data.split()
    seen, duplicates, with_word = set(), 0, 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            with_word += 1
            if line in seen:
                duplicates += 1
            else:
                seen.add(line)
    return Stats(len(words), len(text) - sum(map(data.count, _SPACES)), sum(map(data.count, _SYMBOLS)), duplicates,
                 repeated_words(words), with_word, *(len(data) - len(data.translate(None, c)) for c in (_CAPITALS, _DIGITS, _MARKS))), words
