"""Tokenizing whole texts with the tokenizers library, with a bounded memory of pieces.

A text is cut where the tokenizer's own pattern always cuts: before white space that follows
something else. The pieces between such cuts are encoded once and remembered, as text repeats
its words, and the ids of a text are the ids of its pieces in order.
"""

from __future__ import annotations

import re
import unicodedata
from array import array

import numpy as np

from .common import worker_cache

CHUNK = re.compile(r"\s*\S+|\s+")
#: White space that isn't single spaces and line ends after something else, and NUL: pairs, then characters.
PAIRS = ["  ", " \n", "\n ", "\n\n"]
ASCII_AWKWARD = "\x00\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
OTHER_AWKWARD = re.compile("[\x85\xa0\u1680-\u3000]")
#: Characters on which libraries disagree whether they are white space: such a text goes whole.
ODD_SPACE = re.compile("[\x1c-\x1f᠎​﻿]")
#: Remembered pieces in each of a worker's two generations, and the longest that is remembered.
MOST_PIECES = 300_000
LONGEST_PIECE = 64


def awkward(text: str) -> bool:
    """Searches for fixed strings, which are far quicker than a pattern over every character."""
    if text[:1] in (" ", "\n") or any(p in text for p in PAIRS) or any(c in text for c in ASCII_AWKWARD):
        return True
    return not text.isascii() and OTHER_AWKWARD.search(text) is not None


def chunks(text: str) -> list[str]:
    """Runs of white space with what follows them; in plain texts the cuts are before each space and line end."""
    if awkward(text):
        return CHUNK.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: its own if it can be printed, else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


def latin_classes() -> tuple[str, str]:
    """Letters and numbers below U+0250, as the inside of a character class each."""
    points = [chr(i) for i in range(0x21, 0x250)]
    kinds = [unicodedata.category(c)[0] for c in points]
    return tuple(re.escape("".join(c for c, k in zip(points, kinds) if k == kind)) for kind in "LN")


class Latin:
    """Ids of a Latin word by the merges of a vocabulary alone; None for what needs the whole tokenizer.

    For characters below U+0250 without white space or apostrophe, the split patterns cut runs
    of letters, of numbers and of what is left. A word vocabulary lower-cases, takes numbers
    singly and drops white space; composed characters need no normalising. In a byte vocabulary
    one space goes with what follows it, and one line end before a word stands alone.
    """

    def __init__(self, tokenizer, words: bool):
        self.words, self.tokenize = words, tokenizer.model.tokenize
        letters, numbers = latin_classes()
        one = "" if words else "+"
        self.plain = re.compile("[!-&(-~¡-ɏ]+").fullmatch
        self.split = re.compile(f"[{letters}]+|[{numbers}]{one}|[^{letters}{numbers}]+").findall
        self.shown = byte_characters()

    def part_ids(self, part: str, before: str = "") -> list[int]:
        """Of a part without white space, ``before`` being what is shown for the space that goes with it."""
        # printed ASCII characters stand for themselves
        shown = part if part.isascii() else "".join([self.shown[b] for b in part.encode()])
        return [t.id for t in self.tokenize(before + shown)]

    def ids(self, piece: str) -> list[int] | None:
        space = "" if self.words or piece[0] not in " \n" else piece[0]
        word = piece[len(space) :]
        if not self.plain(word):
            return None
        if self.words:
            low = word.lower()
            if low.isascii():
                return [t.id for part in self.split(low) for t in self.tokenize(part)]
            if not self.plain(low) or not unicodedata.is_normalized("NFC", word):
                return None
            return [i for part in self.split(low) for i in self.part_ids(part)]
        first, *parts = self.split(word)
        ids = self.part_ids(first, self.shown[32]) if space == " " else self.part_ids(first)
        if space == "\n":
            ids = [t.id for t in self.tokenize(self.shown[10])] + ids
        return ids + [i for part in parts for i in self.part_ids(part)]


class Pieces(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers.

    When the young generation is full it becomes the old one; a piece found there comes back.
    """

    def __init__(self, tokenizer, words: bool | None = None):
        self.whole = tokenizer.encode
        # the library gives these strings their own id wherever they stand in a text
        added = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or r"(?!)")
        self.latin = (lambda piece: None) if words is None else Latin(tokenizer, words).ids
        # white space around words gives no ids in a word vocabulary
        self.cut = str.split if words else chunks
        self.old: dict[str, bytes] = {}

    def encode(self, piece: str) -> bytes:
        ids = self.latin(piece)
        if ids is not None:
            return array("I", ids).tobytes()
        return self.encode_whole(piece)

    def encode_whole(self, text: str) -> bytes:
        return np.array(self.whole(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= LONGEST_PIECE:
            if len(self) >= MOST_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def pieces_of(path: str, words: bool | None = None) -> Pieces:
    """The memory of this worker for one vocabulary.

    ``words``: True if the vocabulary lower-cases and drops white space, False if it is one of
    bytes, for a quicker way; None for any other.
    """
    from tokenizers import Tokenizer

    cache, key = worker_cache(), ("pieces", path, words)
    if key not in cache:
        cache[key] = Pieces(Tokenizer.from_file(path), words)
    return cache[key]


def encode_text(text: str, pieces: Pieces) -> bytes:
    """The ids of a whole text as little-endian unsigned 32-bit integers.

    As the library's plain call gives them: a string of the vocabulary's added tokens, like
    <|endoftext|>, becomes that token's id. A text with one goes whole.
    """
    if not text:
        return b""
    if ODD_SPACE.search(text) or pieces.added.search(text):
        return pieces.encode_whole(text)
    return b"".join(map(pieces.__getitem__, pieces.cut(text)))
