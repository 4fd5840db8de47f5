"""Secret scans: fixed patterns, and a guess-cost dynamic programme over values in the context of a credential.

The fixed patterns find assigned tokens, access keys and hexadecimal strings. Besides these, a value that stands behind a
credential word is segmented into dictionary words, dates, repeats, sequences, keyboard walks and brute-force spans so
that the guesses it takes are fewest; if even these are many, the value is a secret. Behind "is" an unquoted value of letters
alone is a word of prose and isn't asked. A value that a fixed pattern's span covers
whole needs no second span; one that it covers in part gets its own.

Spans are in code points, ends exclusive. Defined cases: a null or empty text has no spans; repeated rows are scanned
each; other columns are ignored; an empty table gives an empty result; long values are segmented whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import shared
from gleanery.llm.tokenizing import byte_symbols, tokenizer_path

RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"
KINDS = ("assign", "access", "hex", "guess")

# The base patterns with the least length of what they must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

# Words before a credential's value, and what stands between.
CONTEXT = re.compile(r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code|wort)|pwd|kennwort|mot\x20de\x20passe|contrase[ñÑ]a|secret|token|api[_-]?key|credentials?|(?:access|auth|client|private|secret)[_-](?:key|token|secret))["']?(?:\x20*[:=]\x20*|\x20+(?:is|est|ist|es)\x20+)(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"'<>,;]{6,}))""", re.I | re.A)
#: What follows "is", "est", "ist" or "es" without quotes and is letters alone, with the marks that end a clause, is prose and no value.
PROSE, ASSIGNED = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*[.!?:)…]*"), re.compile(r"[:=]")
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "api", "credential", "kennwort", "contrase", "_key", "-key", "_token", "-token", "_secret", "-secret")
#: log10 of the guesses from which a value in context is a secret.
LEAST_GUESSES = 8.0

# Common passwords and what stands for one in prose, most common first.
WORDS = """password admin login user guest root test welcome secret token example changeme letmein default master hello dragon monkey
shadow sunshine princess football baseball superman batman michael jordan charlie freedom whatever trustno love iloveyou summer
winter spring autumn required invalid missing expired reset forgot none null true false value string empty unknown optional
hidden strong weak""".split()  # fmt: skip
#: The vocabulary whose entries are the rest of the dictionary, and the letters of a word in it.
DICTIONARY = "byte_bpe_50k.json"
LEAST_LETTERS, MOST_LETTERS = 3, 20
# Rows of the keyboard.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("04317$5@", "oaeltssa")

_NEAR = {pair for row in KEYBOARD for a, b in zip(row, row[1:], strict=False) for pair in ((a, b), (b, a))}
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d", re.A)


@functools.lru_cache(maxsize=1)
def dictionary() -> tuple[dict[str, int], frozenset[str]]:
    """The rank of each word in lower case, and all beginnings of words from LEAST_LETTERS on."""
    with open(tokenizer_path(DICTIONARY), encoding="utf-8") as f:
        entries = sorted(json.load(f)["model"]["vocab"].items(), key=lambda e: e[1])
    of_symbol = {s: i for i, s in enumerate(byte_symbols())}
    ranks = {w: i + 1 for i, w in enumerate(WORDS)}
    for spelled, _ in entries:
        word = bytes(of_symbol[c] for c in spelled).decode("utf-8", "replace").strip().lower() if all(c in of_symbol for c in spelled) else ""
        if word.isalpha() and LEAST_LETTERS <= len(word) <= MOST_LETTERS:
            ranks.setdefault(word, len(ranks) + 1)
    return ranks, frozenset(w[:k] for w in ranks for k in range(LEAST_LETTERS, len(w) + 1))


def forget() -> bool:
    """Drop the worker's dictionary; whether there was one."""
    any_ = dictionary.cache_info().currsize > 0
    dictionary.cache_clear()
    return any_


#: Kinds of runs: name, whether b follows a, and log10 of the guesses for a run of one character.
_RUNS = (("repeat", lambda a, b: a == b, 1.0), ("sequence", lambda a, b: abs(ord(b) - ord(a)) == 1, 1.2), ("walk", lambda a, b: (a, b) in _NEAR, 1.6))


def run_ends(low: str) -> list[list[int]]:
    """For each kind of run and each start, where the run ends; one pass from the end for each kind."""
    out = []
    for _, follows, _ in _RUNS:
        ends = list(range(1, len(low) + 1))
        for i in range(len(low) - 2, -1, -1):
            if follows(low[i], low[i + 1]):
                ends[i] = ends[i + 1]
        out.append(ends)
    return out


def segments(value: str, start: int, low: str, ends: list[list[int]]) -> Iterator[tuple[int, float, str]]:
    """End, log10 of the guesses, and kind of each segment from start; a brute-force span is one character at a time. low: the value
    in lower case, character by character; ends: its run_ends."""
    yield start + 1, 1.0, "brute"
    ranks, beginnings = dictionary()
    for end in range(start + LEAST_LETTERS, min(len(value), start + MOST_LETTERS) + 1):
        part = low[start:end]
        plain = part.translate(LEET)
        if part not in beginnings and plain not in beginnings:
            break
        rank = ranks.get(part) or ranks.get(plain)
        if rank:
            varied = math.log10(2) * ((part not in ranks) + (value[start:end] not in (part, part.capitalize())) + (value[start:end] == part.capitalize() != part))
            yield end, math.log10(rank + 1) + varied, "word"
    for (kind, _, base), of_kind in zip(_RUNS, ends, strict=True):
        end = of_kind[start]
        if end - start >= 3:
            yield end, base + math.log10(end - start), kind
    if date := _DATE.match(value, start):
        yield date.end(), 4.0 if date.end() - start > 4 else 2.0, "date"


def guess_cost(value: str, enough: float = math.inf) -> tuple[float, list[tuple[int, int, str]]]:
    """log10 of the guesses of the cheapest segmentation, and its segments with brute-force characters put together. If it is
    found to take enough guesses or more, that number and no segments, as soon as no cheaper way leads on."""
    n = len(value)
    best: list[float] = [0.0] + [math.inf] * n
    came: list[tuple[int, str]] = [(0, "")] * (n + 1)
    low = "".join(x if len(x) == 1 else c for c in value for x in [c.lower()])
    ends = run_ends(low)
    reach = 0  # how far a way of less than enough has come
    for start in range(n):
        if start > reach:
            return enough, []
        if best[start] >= enough:
            continue
        for end, cost, kind in segments(value, start, low, ends):
            # each further segment multiplies the orders in which they may be tried; brute force goes on at no such cost
            order = 0.0 if kind == "brute" and came[start][1] in ("brute", "") else 0.3
            ahead = best[start] + cost + order
            if ahead < best[end]:
                best[end], came[end] = ahead, (start, kind)
                if end > reach and ahead < enough:
                    reach = end
    if best[n] >= enough:
        return enough, []
    out: list[tuple[int, int, str]] = []
    end = n
    while end:
        start, kind = came[end]
        if out and kind == "brute" == out[-1][2]:
            out[-1] = (start, out[-1][1], kind)
        else:
            out.append((start, end, kind))
        end = start
    return best[n], out[::-1]


def scan(text: str, least_guesses: float = LEAST_GUESSES) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and further spans, each (start, kind's place in KINDS, end), in order."""
    low = text.lower()
    base: list[tuple[int, int, int]] = []
    if any(w in low for w in ASSIGN_WORDS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    more = []
    if any(w in low for w in CONTEXT_WORDS):
        taken = [(a, b) for a, _, b in base]
        for m in CONTEXT.finditer(text):
            start, end = m.span(m.lastindex)
            if m.lastindex == 3 and PROSE.fullmatch(text, start, end) and not ASSIGNED.search(text, m.start(), start):
                continue
            if not any(a <= start and end <= b for a, b in taken) and guess_cost(text[start:end], least_guesses)[0] >= least_guesses:
                more.append((start, 3, end))
    return base, more


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def secrets(docs: DataFrame, least_guesses: float = LEAST_GUESSES) -> DataFrame:
    """RESULT for each document."""
    shared.ship(docs.sparkSession)
    ddl = RESULT

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = shared.schema_of(ddl)
        for batch in shared.slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), shared.texts_of(batch), strict=True):
                base, more = scan(text, least_guesses)
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((doc_id, *counts, hashlib.sha256(named(base).encode()).hexdigest(), named(base + more), len(more)))
            yield pa.RecordBatch.from_pydict({f.name: [r[i] for r in rows] for i, f in enumerate(schema)}, schema=schema)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(shared.lean(scanned, __name__), RESULT)


def redact(text: str, mark: str = "[SECRET]", least_guesses: float = LEAST_GUESSES) -> str:
    """The text with each span, overlapping ones as one, replaced by the mark."""
    base, more = scan(text, least_guesses)
    out, at = [], 0
    for start, _, end in sorted(base + more):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, mark: str = "[SECRET]", least_guesses: float = LEAST_GUESSES) -> DataFrame:
    """docs with the secrets of their texts replaced by the mark, and n_chars after it; a null text stays null."""
    shared.ship(docs.sparkSession)
    replace = shared.lean_column(lambda x: None if x is None else redact(x, mark, least_guesses), "string", __name__)
    out = docs.withColumn("text", replace(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
