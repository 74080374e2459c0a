"""Token ids of public tokenizers, from whole texts.

Both vocabularies cut a text at single blanks wherever no other white space is near, so
the ids of a text are those of its pieces. A task keeps the ids of pieces it has met and
asks the tokenizers library for new ones only. A new piece that is a word with or without
punctuation after it goes straight to the library's merges, as its cut is plain; others
go through the whole library, many at once. A text with a piece that white space may
join with its neighbours is encoded whole.
"""

from __future__ import annotations

import os

import numpy as np

#: Pieces a task remembers before it starts anew.
REMEMBERED = 500_000
#: Punctuation that makes one token run after a word; an apostrophe may start a suffix.
AFTER = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters below this one have their case and composition the same everywhere.
PLAIN_BELOW = "İ"


def _byte_letters() -> dict[int, str]:
    """The visible letter that byte-level vocabularies write for each byte (fixed)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + i)
    return table


class _Pieces(dict):
    """Ids by piece; learns a piece when it is first asked for. None: may join."""

    def __init__(self, lib, lead: str, joins: bool, lower: bool, width: list[bytes]):
        super().__init__()
        self._lib, self._merge = lib, lib.model.tokenize
        self._letters = _byte_letters()
        self._lead = lead.translate(self._letters)
        self._blank, self._joins, self._lower, self._width = lead, joins, lower, width
        self.tails: dict[str, bytes] = {}
        self.bare: _Pieces = self  # pieces without the blank

    def _line(self) -> bytes:
        if "\n" not in self.tails:
            found = self._lib.encode("a\nb", add_special_tokens=False).ids
            ends = [self._lib.encode(c, add_special_tokens=False).ids for c in "ab"]
            self.tails["\n"] = b"".join(self._width[i] for i in found[len(ends[0]) : len(found) - len(ends[1])])
        return self.tails["\n"]

    def _run(self, lead: str, text: str) -> bytes:
        """Ids of letters, or of punctuation: one run that isn't cut."""
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self._letters)
        width = self._width
        return b"".join([width[t.id] for t in self._merge(lead + text)])

    def __missing__(self, piece: str) -> bytes | None:
        stem = piece.rstrip(AFTER)
        if stem.isalpha() and max(stem) < PLAIN_BELOW:
            ids = self.get(stem)
            if ids is None:
                ids = self[stem] = self._run(self._lead, stem.lower() if self._lower else stem)
            if len(stem) < len(piece):
                tail = piece[len(stem) :]
                if tail not in self.tails:
                    self.tails[tail] = self._run("", tail)
                ids = self[piece] = ids + self.tails[tail]
            return ids
        one, line, rest = piece.partition("\n")
        if one and rest and not one[-1].isspace() and not rest[0].isspace():
            # A lone line break is a run of its own; what follows has no blank before it.
            before = self[one]
            return None if before is None else before + self._line() + self.bare[rest]
        if self._joins and (not piece or piece[0].isspace()):
            # White space at the start of a piece may join with what is before it.
            ids = self[piece] = None
            return ids
        found = self._lib.encode(self._blank + piece, add_special_tokens=False).ids
        ids = self[piece] = b"".join([self._width[i] for i in found])
        return ids


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, in bytes."""

    def __init__(self, path: str, blank_joins: bool, lower: bool):
        """``blank_joins``: the blank before a word is part of its token; ``lower``: the
        vocabulary has lower-case words only."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._lib = Tokenizer.from_file(path)
        self._width = [i.to_bytes(4, "little") for i in range(self._lib.get_vocab_size())]
        self._first = _Pieces(self._lib, "", blank_joins, lower, self._width)
        self._later = _Pieces(self._lib, " ", True, lower, self._width) if blank_joins else self._first
        self._later.bare = self._first

    def _whole(self, text: str) -> bytes:
        return np.array(self._lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = []
        for held in (self._first, self._later):
            if len(held) > REMEMBERED:
                held.clear()
                held.tails.clear()
        first, later = self._first, self._later.__getitem__
        for text in texts:
            if not text:
                out.append(b"")
                continue
            pieces = text.split(" ")
            parts = [first[pieces.pop(0)]]
            parts += map(later, pieces)
            out.append(self._whole(text) if None in parts else b"".join(parts))
        return out


_encoders: dict[tuple[str, bool, bool], Encoder] = {}


def encoder(path: str, blank_joins: bool, lower: bool) -> Encoder:
    """The worker process's encoder, shared by the tasks it runs."""
    key = (path, blank_joins, lower)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def in_steps(texts: list[str], size: int = 4 << 20):
    """Slices of consecutive texts of about ``size`` characters."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield texts[start : i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield texts[start:]
