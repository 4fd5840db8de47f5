"""Whole texts to ids with the tokenizers library, distinct pieces once.

A byte-level BPE never merges across its pre-tokens, and a space or line end before a character that isn't white space
always begins one. So a text may be cut there, and a piece that comes again takes its ids from a table. A new piece is
cut into its pre-tokens, whose ids the library's model gives. Texts in which white space meets white space, or with a
special token, go to the library as they are, and so do pieces with uncommon characters.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: White space beside white space, or other than space and line end: such a text isn't cut.
UNCUT = re.compile(r"\s\s|[^\S \n]")
#: Letters, numbers and the pre-token pattern of byte-level vocabularies, for characters up to U+017F.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
UNCOMMON = re.compile("[^\n\x20-\x7e\xa1-ſ]")
#: Pieces in each of the worker's two tables; when the newer is full, the older is dropped. Two tables of 400,000 made 200 MB of a worker.
MOST_PIECES = 200_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else one from U+0100 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(others)) for b in range(256)]


class ByteLevelEncoder:
    """encode(texts): for each text its ids as little-endian unsigned 32-bit integers, as encode(text, add_special_tokens=False) has them."""

    def __init__(self, path: str, most_pieces: int = MOST_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.tokenize = self.library.model.tokenize
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.raw = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.spelling = {i: s for i, s in enumerate(byte_symbols())}
        self.stops = {s: self._whole(s) for s in ".,"}
        self.most = most_pieces
        self.known = _Pieces(self)
        self.older: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, spelled: str) -> bytes:
        """The ids of a pre-token that is spelled in the vocabulary's characters."""
        return b"".join([self.raw[t.id] for t in self.tokenize(spelled)])

    def _ids(self, text: str) -> bytes:
        """The ids of a text without special tokens."""
        if UNCOMMON.search(text):
            return self._whole(text)
        return b"".join([self._word(w.encode("utf-8").decode("latin-1").translate(self.spelling)) for w in PRETOKEN.findall(text)])

    def piece(self, piece: str) -> bytes:
        """The ids of a new piece; pieces begin with a line end, or stand for themselves after a space."""
        ids = self.older.get(piece)
        if ids is not None:
            return ids
        if piece.isalpha():  # one pre-token
            if piece.isascii():
                return self._word("Ġ" + piece)
            if max(piece) <= "ſ":
                return self._word("Ġ" + piece.encode("utf-8").decode("latin-1").translate(self.spelling))
        stop = self.stops.get(piece[-1:])
        if stop and piece[:-1].isalpha() and piece.isascii():  # the stop is a pre-token of its own
            return self.known[piece[:-1]] + stop
        return self._ids(piece if piece[:1] == "\n" else " " + piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.most:
            self.known, self.older = _Pieces(self), dict(self.known)
        get, specials, out = self.known.__getitem__, self.specials, []
        for text in texts:
            if UNCUT.search(text) or any(s in text for s in specials):
                out.append(self._whole(text))
            else:
                first, *pieces = text.replace("\n", " \n").split(" ")
                out.append(self._ids(first) + b"".join(map(get, pieces)))
        return out


class _Pieces(dict):
    def __init__(self, encoder: ByteLevelEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.encoder.piece(piece)
        return ids


_ENCODERS: dict[str, ByteLevelEncoder] = {}


def encoder(path: str) -> ByteLevelEncoder:
    """The worker's encoder for a tokenizer's file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteLevelEncoder(path)
    return _ENCODERS[path]


def forget() -> bool:
    """Drop the worker's encoders with the pieces they remember; whether there were any."""
    any_ = bool(_ENCODERS)
    _ENCODERS.clear()
    return any_


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
