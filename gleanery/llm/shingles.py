"""Word shingles as 64-bit numbers.

Numbers of different shingles agree with chance 2**-64 a pair; since they are only ever compared inside a pair of documents
or passages once candidates are found, that is the chance of an error there too.

Words are numbered without making them: a word's number is a polynomial over its bytes, taken from running sums over many
texts at a time, so that a pass over all texts costs array operations and no object for each word.
"""

from __future__ import annotations

from functools import cache

import numpy as np

WIDTH = 5
#: Bytes that are numbered at a time.
PIECE = 1 << 18
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33))
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_BASE = 0x27BB2EE687B0B0FD
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    a, b, shift = _MIX
    x = x ^ (x >> shift)
    x = x * a
    x = x ^ (x >> shift)
    x = x * b
    return x ^ (x >> shift)


@cache
def _byte_numbers() -> np.ndarray:
    """A number for each byte; the letters A to Z have those of a to z."""
    numbers = mixed(mixed(np.arange(1, 257, dtype=np.uint64) * _PLACE[0]))
    numbers[ord("A") : ord("Z") + 1] = numbers[ord("a") : ord("z") + 1]
    return numbers


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@cache
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, PIECE), _powers(pow(_BASE, -1, 1 << 64), PIECE)


def _piece_numbers(piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a piece begin, and their numbers."""
    white = np.concatenate([[True], _WHITE[piece], [True]])
    starts = np.flatnonzero(white[:-1] & ~white[1:])
    ends = np.flatnonzero(~white[:-1] & white[1:])
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    power, inverse = _usual_powers() if len(piece) <= PIECE else (_powers(_BASE, len(piece)), _powers(pow(_BASE, -1, 1 << 64), len(piece)))
    total = np.zeros(len(piece) + 1, dtype=np.uint64)
    np.cumsum(_byte_numbers()[piece] * power[: len(piece)], out=total[1:])
    return starts, mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def words_of_texts(texts: list[str]) -> list[np.ndarray]:
    """A number for each word of each text, letters A to Z in lower case; words stand between ASCII white space."""
    raw = [x.encode("utf-8", "surrogatepass") for x in texts]
    buffer = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    at, begins, numbers = 0, [], []
    while at < len(buffer):
        end = min(len(buffer), at + PIECE)
        if end < len(buffer):  # no word is cut: a longer one makes a longer piece
            last = np.flatnonzero(_WHITE[buffer[at:end]])
            if len(last):
                end = at + int(last[-1]) + 1
            else:
                while end < len(buffer) and not _WHITE[buffer[end : end + PIECE]].any():
                    end += PIECE
                end = min(len(buffer), end + PIECE) if end >= len(buffer) else end + int(np.argmax(_WHITE[buffer[end : end + PIECE]])) + 1
        starts, found = _piece_numbers(buffer[at:end])
        begins.append(starts + at)
        numbers.append(found)
        at = end
    if not begins:
        return [np.zeros(0, dtype=np.uint64) for _ in texts]
    begins_, numbers_ = np.concatenate(begins), np.concatenate(numbers)
    cuts = np.searchsorted(begins_, np.cumsum([0, *(len(x) + 1 for x in raw)])).tolist()
    return [numbers_[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def word_numbers(text: str) -> np.ndarray:
    return words_of_texts([text])[0]


def shingle_numbers(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A number for each run of width words, in order; with fewer words, one for the whole sequence; none without words."""
    n = len(words)
    if not n:
        return words
    if n < width:
        width = n
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = out + mixed(words[k : k + len(out)] + _PLACE[k]) * _PLACE[k]
    return mixed(out)


def shingles_of_texts(words: list[np.ndarray], width: int = WIDTH) -> list[np.ndarray]:
    """shingle_numbers of several texts at a time."""
    lengths = [len(w) for w in words]
    if sum(lengths) < width:
        return [shingle_numbers(w, width) for w in words]
    together = shingle_numbers(np.concatenate(words), width)
    starts = np.cumsum([0, *lengths]).tolist()
    return [together[a : a + n - width + 1] if n >= width else shingle_numbers(w, width) for a, n, w in zip(starts, lengths, words, strict=False)]


def distinct(shingles: np.ndarray) -> np.ndarray:
    """The distinct ones, ascending."""
    shingles = np.sort(shingles)
    return shingles[np.concatenate([[True], shingles[1:] != shingles[:-1]])] if len(shingles) else shingles


def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending."""
    return [distinct(x) for x in shingles_of_texts(words_of_texts(texts), width)]


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    return shingle_sets([text], width)[0]
