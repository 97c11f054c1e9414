"""Cut a text where a byte-level BPE cuts in any case, and encode every distinct piece once.

The pattern of byte-level BPE always begins a token at a space that is
followed by something other than white space. A text may therefore be cut
before every such space, and the ids of the whole are those of the pieces in
turn. Words repeat, so the ids of a piece are kept. A line feed that stands
alone in white space is a token of its own, so a text may be cut before it,
too (``cuttable``): what follows it is a piece that begins with it. The cache has two
generations of bounded size: a full one becomes the old one, from which pieces
that are met again move on, so what is common stays and what is rare goes.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

WHITE = regex.compile(r"\s")
STOPS = ".,;:!?"

#: Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that vocabulary files write for each byte: itself if visible in Latin-1, else one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def special_splitter(specials: dict[str, int]) -> Callable[[str], list[str]]:
    """Cuts a text at special tokens, of which the longest is taken, and keeps them."""
    longest_first = sorted(map(re.escape, specials), key=len, reverse=True)
    return re.compile("(" + "|".join(longest_first) + ")").split if specials else lambda text: [text]


def cuttable(text: str) -> str | None:
    """The text to be split at spaces, None if it can't be: a space goes before every line feed, unless white space of several signs may be there.

    The first piece has no space in front, the others have one or begin with a line feed.
    """
    if "\n" in text:
        if " \n" in text:
            return None
        if "\n\n" not in text and "\r" not in text and "\t" not in text:
            text = text.replace("\n", " \n")
    first = text.partition(" ")[0]
    return None if first and WHITE.match(first[-1]) else text


def is_regular(piece: str) -> bool:
    """False if white space is at an end of the piece, but for one line feed in front: its text isn't cut."""
    body = piece.removeprefix("\n")
    return piece == "\n" or bool(body) and not WHITE.match(body[0]) and not WHITE.match(body[-1])


class Irregular(Exception):
    """A space before white space or at the end: the text isn't cut."""


class _Cache(dict):
    def __init__(self, encode: Callable[[str], bytes], capacity: int):
        super().__init__()
        self.encode, self.capacity, self.older = encode, capacity, {}
        self.stops = {c: encode(c) for c in STOPS}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            if not piece or WHITE.match(piece):
                raise Irregular
            if piece[-1] in STOPS and piece[:-1].isalpha():  # letters and one sign are a token each
                ids = self[piece[:-1]] + self.stops[piece[-1]]
            else:
                ids = self.encode(" " + piece)
        if len(piece) < 64:
            if len(self) >= self.capacity:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class PieceEncoder:
    """Turns a text into ids as little-endian unsigned 32-bit integers; ``encode`` does so for a text without special tokens."""

    def __init__(self, encode: Callable[[str], bytes], specials: dict[str, int], capacity: int = 250_000):
        self.encode = encode
        self.cache = _Cache(encode, capacity)
        self.specials = {k: v.to_bytes(4, "little") for k, v in specials.items()}
        self.split = special_splitter(specials)

    def plain(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            tail = b"".join(map(self.cache.__getitem__, rest))
        except Irregular:
            return self.encode(text)
        return (self.encode(first) if first else b"") + tail

    def __call__(self, text: str) -> bytes:
        parts = self.split(text)
        if len(parts) == 1:
            return self.plain(text) if text else b""
        return b"".join(self.specials.get(x) or self.plain(x) for x in parts if x)
