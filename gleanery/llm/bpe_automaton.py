"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that BPE makes. It begins with one state, in which any
symbol may follow any other, and takes the merges in order of priority. The gadget for the merge of u and v: the state
behind u is split, the copy loses its arc v, and all arcs u now lead to the copy; where u was followed by v, an arc uv is
added that leads to where v led.

All arcs of one label lead to one state at any time, so a state is kept as its label and the number of merges at which it
was branched off: its lost arcs are the ones that the label's own list has from before that number, and those of the state
it was copied from. arc(a, b) answers from these tables, and each answer is kept as an entry of the transition table.

A word has one path through the automaton whose labels spell it. The encoder follows arcs, longest token first, and marks
positions from which no path went on, so no position is tried twice. Decoding emits the labels of the arcs.

Defined cases: a null or empty text has no ids and decodes to an empty text; repeated rows are encoded each; other columns
are ignored; an empty table gives an empty result; texts of any length are encoded whole, a piece between white space at a
time.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import shared
from gleanery.llm.tokenizing import LETTERS, NUMBERS, byte_symbols

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NEVER = 1 << 40
#: What ends a word's last symbol, in the words and labels that the automaton reads.
END = "\0"
#: Pieces and words kept in a worker; beyond it the tables start anew.
MOST_PIECES = 500_000

#: White space up to U+017F.
WHITE = r"\t-\r \x85\xa0"
#: Beyond these characters the library's own normaliser and pre-tokenizer split the text.
UNCOMMON = re.compile("[^\x00-\x1b\x20-ſ]")
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{WHITE}{LETTERS}{NUMBERS}]+")


class MergeAutomaton:
    """The automaton of an ordered list of merges over the given symbols; tokens are numbered in order of their making."""

    def __init__(self, symbols: Iterable[str], merges: Iterable[tuple[str, str]]):
        self.labels = list(symbols)
        self.number = {s: i for i, s in enumerate(self.labels)}
        n = len(self.labels)
        self.made = [NEVER] * n  # the merge that made the token
        self.parts: list[tuple[int, int] | None] = [None] * n
        self.lost: list[dict[int, int]] = [{} for _ in range(n)]  # arcs that the state behind a label has lost, and when
        self.table: dict[int, bool] = {}
        self.unused: set[int] = set()  # labels of merges that never apply
        for when, (left, right) in enumerate(merges):
            self._gadget(when, self.number[left], self.number[right])
        self.number = {label: i for label, i in self.number.items() if i not in self.unused}
        self._shorter = [self._prefix(s) for s in self.labels]
        self.longest = max(map(len, self.labels), default=0)

    def _gadget(self, when: int, u: int, v: int) -> None:
        """Splits the state behind u, drops its arc v, and adds the arcs uv, which lead to the state behind v as it is now.

        Where u is followed by v nowhere, since earlier merges took these arcs, the merge never applies and adds none.
        """
        label = self.labels[u] + self.labels[v]
        applies = u not in self.unused and v not in self.unused and self._arc(u, v)
        if label in self.number and (applies or self.number[label] not in self.unused):
            if applies:
                raise ValueError(f"two merges make {label!r}")
            return
        if not applies:
            self.unused.add(len(self.labels))
        self.lost[u].setdefault(v, when)
        self.number[label] = len(self.labels)
        self.labels.append(label)
        self.made.append(when)
        self.parts.append((u, v))
        self.lost.append({})

    def _prefix(self, label: str) -> int | None:
        """The longest token that the label begins with, but for itself."""
        return next((self.number[label[:i]] for i in range(len(label) - 1, 0, -1) if label[:i] in self.number), None)

    def arc(self, a: int, b: int) -> bool:
        """Whether the state behind a has the arc b."""
        key = a << 24 | b
        known = self.table.get(key)
        if known is None:
            known = self.table[key] = self._arc(a, b)
        return known

    def _arc(self, a: int, b: int) -> bool:
        """The arc b came from the arc of its left part, and so on; each of these must have been there when it was used.

        The state behind a was copied from the state behind its right part when a was made, and has what that one had lost.
        """
        before = NEVER
        while True:
            lost = self.lost[a]
            if lost:
                part, used = b, NEVER
                while True:
                    when = lost.get(part)
                    if when is not None and when < before and when <= used:
                        return False
                    if self.parts[part] is None:
                        break
                    used = self.made[part]
                    part = self.parts[part][0]
            if self.parts[a] is None:
                return True
            before = min(before, self.made[a])
            a = self.parts[a][1]

    def _from(self, word: str, at: int) -> int | None:
        number = self.number
        for end in range(min(len(word), at + self.longest), at, -1):
            found = number.get(word[at:end])
            if found is not None:
                return found
        return None

    def path(self, word: str) -> list[int]:
        """The labels of the path that spells the word."""
        out: list[int] = []
        at, n, ends = 0, len(word), set()
        token = self._from(word, 0)
        labels, shorter, arc = self.labels, self._shorter, self.arc
        while at < n:
            if token is None:
                if not out:
                    raise ValueError(f"no path spells {word!r}")
                ends.add(at)
                token = shorter[out[-1]]
                at -= len(labels[out.pop()])
                continue
            end = at + len(labels[token])
            if end not in ends and (not out or arc(out[-1], token)):
                out.append(token)
                at = end
                token = self._from(word, at)
            else:
                token = shorter[token]
        return out


class WordCodec:
    """Encodes and decodes with a vocabulary file of the kind BPE with word ends, as the tokenizers library does with it."""

    def __init__(self, path: str, most_pieces: int = MOST_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        suffix = model.get("end_of_word_suffix") or ""
        ended = (lambda s: s[: -len(suffix)] + END if suffix and s.endswith(suffix) else s)
        self.suffix, self.end = suffix, END if suffix else ""
        pairs = [tuple(map(ended, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        self.bytes = byte_symbols()
        symbols = [*self.bytes, *(s + END for s in self.bytes if suffix)]
        self.automaton = MergeAutomaton(symbols, pairs)
        ids = {ended(s): i for s, i in model["vocab"].items()}
        self.raw = [ids[label].to_bytes(4, "little") for label in self.automaton.labels]
        self.label = {i: s for s, i in model["vocab"].items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
        self.special = {t["content"]: t["id"].to_bytes(4, "little") for t in file["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.library = Tokenizer.from_file(path)  # normaliser and pre-tokenizer for uncommon characters
        self.most = most_pieces
        self.pieces, self.words = _Known(self._piece), _Known(self._word)

    def _word(self, word: str) -> bytes:
        spelled = word if word.isascii() and word.isprintable() and " " not in word else "".join(self.bytes[b] for b in word.encode("utf-8"))
        return self._symbols(spelled)

    def _symbols(self, spelled: str) -> bytes:
        return b"".join([self.raw[t] for t in self.automaton.path(spelled + self.end)])

    def _piece(self, piece: str) -> bytes:
        return b"".join([self.words[w] for w in WORD.findall(piece)])

    def _ordinary(self, text: str) -> bytes:
        if UNCOMMON.search(text):
            split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return b"".join([self._symbols(word) for word, _ in split])
        return b"".join(map(self.pieces.__getitem__, text.lower().split()))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.pieces) > self.most:
            self.pieces.clear()
        if len(self.words) > self.most:
            self.words.clear()
        if len(self.automaton.table) > 4 * self.most:
            self.automaton.table.clear()
        if not self.cut or "<" not in text:
            return self._ordinary(text)
        return b"".join([self.special.get(x) or self._ordinary(x) for x in self.cut.split(text)])

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, with a space between, as the library joins them without a decoder."""
        return " ".join(map(self.label.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Known(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        made = self[key] = self.make(key)
        return made


_CODECS: dict[str, WordCodec] = {}


def codec(path: str) -> WordCodec:
    """The worker's codec for a vocabulary file."""
    if path not in _CODECS:
        _CODECS[path] = WordCodec(path)
    return _CODECS[path]


def with_ids(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (binary) and decoded text of each document."""
    return _mapped(docs, tokenizer, "doc_id long, ids binary, decoded string", lambda ids, text: (ids, text))


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """RESULT for each document."""
    digests = lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode("utf-8")).hexdigest())
    return _mapped(docs, tokenizer, RESULT, digests)


def _mapped(docs: DataFrame, tokenizer: str, ddl: str, row) -> DataFrame:
    shared.ship(docs.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, own = shared.schema_of(ddl), codec(tokenizer)
        for batch in shared.slices(batches, "text"):
            ids = [own.encode(x) for x in shared.texts_of(batch)]
            rows = [row(x, own.decode(x)) for x in ids]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {f.name: [r[i] for r in rows] for i, f in enumerate(list(schema)[1:])}, schema=schema)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encoded, ddl)
