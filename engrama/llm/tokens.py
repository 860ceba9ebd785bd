"""Token ids of whole texts by a public vocabulary, as little-endian unsigned 32-bit bytes.

The vocabulary's splitter never joins a character to white space behind it, and
takes of a run of white space all but the last character, so a text of single
spaces and newlines falls apart at them without changing its ids.  Such pieces
repeat all the time: each distinct one is encoded once and kept.  A piece of
common letters is split by the vocabulary's own pattern and given to the
tokenizer's model; other pieces, and texts with longer or other white space, go
through the whole tokenizer.  So do texts that hold the string of an added token,
such as an end-of-text mark, which the library finds before it splits a text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence
from functools import lru_cache
from struct import pack

import numpy as np
import regex

END_ID = 0
DEFAULT_VOCABULARY = "byte_bpe_50k.json"
KEPT_PIECES = 600_000  # pieces that a worker remembers

_LONG_RUN = re.compile(r"\s{3}|\s\s\Z")
_OTHER_SPACE = re.compile("[\x00\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff]")
_UNCOMMON = re.compile("[^\n -~\u00a1-\u024f]")
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKS = r"!-&(-/:-@\[-`{-~"  # of ASCII, without the apostrophe, which begins words of its own
_SIMPLE = re.compile(f"( ?[{_LETTERS}]+)([{_MARKS}]*)| ?[{_MARKS}]+")


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Where the installed tokenizer files are; a caller may pass any other path instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letters a byte-level vocabulary writes bytes as: printable ones as they are, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


class Remembered(dict):
    """Values of a function by argument; long arguments aren't kept.

    Once half of what may be kept is held, it becomes the older half, of which
    only what is asked for again is carried over.
    """

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) < 64:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > KEPT_PIECES // 2:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Encodes batches of texts with one byte-level tokenizer file.

    With ``plain`` the strings of added tokens are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if t.content and not (plain and t.special)]
        self.words_in = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = _byte_letters()
        self.known = Remembered(self._piece)
        self.words = Remembered(self._word)

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _holds_added(self, text: str) -> bool:
        return any(content in text for content in self.added)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable() and not word.isspace():
            spelled = word.replace(" ", self.letters[32])
        else:
            spelled = word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        simple = _SIMPLE.fullmatch(piece) if len(piece) < 64 else None
        if simple:  # letters, then marks: one word of the pattern each
            return self.known[simple[1]] + self.known[simple[2]] if simple[2] else self._word(piece)
        if len(piece) > 63 or _UNCOMMON.search(piece) or "\n" in piece[1:] or self._holds_added(piece):
            return self._whole(piece)
        return b"".join(map(self.words.__getitem__, self.words_in(piece)))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text; null is empty."""
        split: list[list[str]] = []
        for text in texts:
            if not text:
                split.append([])
            elif _OTHER_SPACE.search(text) or self._holds_added(text) or (
                ("  " in text or "\n\n" in text or " \n" in text or "\n " in text) and _LONG_RUN.search(text)
            ):
                split.append([text])
            else:
                split.append(text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00"))
        known = self.known
        known.trim(), self.words.trim()
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]


@lru_cache(maxsize=4)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder per worker process, file and kind."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, plain)
