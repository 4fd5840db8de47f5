"""Quality rules: line sequence labelling.

The lines of a document are labelled content or boilerplate by Viterbi decoding of a linear-chain conditional random field;
the share of its words in content lines decides whether the document stays. Counts of symbols, repeated lines and repeated
8-word windows are given beside it, and a document with too few words or too much repetition fails before the field is
asked.

The field is fitted by gradient steps on its log-likelihood (forward-backward) over a bounded sample of labelled documents
(SAMPLE_DOCS of them, the ones with the smallest hash of doc_id, so the same ones at every run; of each one row, and of long
ones runs of lines from all over it, SAMPLE_LINES in all; what the base rules fail isn't learned from). A line of the sample takes its document's label; beside the
documents themselves the field sees as many spliced ones, whose lines come from a kept and a rejected document in turn, so
that it learns where labels change. Everything else covers all rows.

Defined cases: a null or empty text has no words and fails; with no labelled documents of both kinds that pass the base rules the field isn't fitted
and the base rules alone decide; repeated rows are judged each; of several labels of a doc_id the least counts, and of several
texts of a labelled doc_id that with the least features is learned; other
columns are ignored; an empty table gives an empty result; long texts are decoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import shared

RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
WINDOW = 8
LEAST_WORDS = 20
#: Labelled documents that the field is fitted on, at most.
SAMPLE_DOCS = 1000
#: Lines of a training sequence; longer documents are trained on in several.
SEQUENCE = 48
#: Lines of a labelled document that the field is fitted on, at most: whole sequences, evenly spread over it.
SAMPLE_LINES = 4 * SEQUENCE
STEPS = 40
#: Share of the words in content lines from which a document is kept.
CONTENT_SHARE = 0.5
BINS = 8
N_FEATURES = 9
CONTENT, BOILERPLATE = 1, 0
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) + 2 * k & (1 << 64) - 1 | 1 for k in range(WINDOW)], dtype=np.uint64)


def words_of(text: str) -> list[bytes]:
    """Words between the ASCII white space characters."""
    return text.encode("utf-8", "surrogatepass").split()


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.uint64)
    mixed = (ids + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    hashes = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        hashes += mixed[k : k + n] * _ODD[k]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return 0
    maybe = np.zeros(n, dtype=bool)
    maybe[order[1:][same]] = maybe[order[:-1][same]] = True
    at = np.flatnonzero(maybe)
    rows = np.stack([ids[at + k] for k in range(window)], axis=1)  # the hash only narrows the search
    _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    twice = at[counts[inverse.reshape(-1)] > 1]
    covered[twice] += 1
    np.subtract.at(covered, twice + window, 1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def base_fails(words: list[bytes], repeated: int) -> bool:
    """Whether a text with these words, so many of them in repeated windows, has too few words or too much repetition."""
    return len(words) < LEAST_WORDS or 100 * repeated > 30 * len(words)


def _bin(x: float, edges: tuple[float, ...]) -> int:
    k = 0
    for edge in edges:
        if x < edge:
            break
        k += 1
    return k


def line_features(line: str, words: list[str], seen: bool) -> tuple[int, ...]:
    """Bins of what tells boilerplate from content in a line with a word."""
    n = len(words)
    symbols = sum(map(line.count, SYMBOLS))
    upper = sum(map(str.isupper, words))
    digits = sum(map(str.isdigit, words))
    return (
        _bin(symbols / n, (0.02, 0.1, 0.3, 0.6, 1.0, 2.0)),
        _bin(upper / n, (0.05, 0.2, 0.4, 0.6, 0.8, 0.95)),
        _bin(n, (2, 4, 8, 16, 32, 64, 128)),
        _bin(line.count("!") / n, (0.02, 0.1, 0.3, 0.6, 1.0)),
        int(seen),
        _bin(len(set(words)) / n, (0.1, 0.2, 0.35, 0.5, 0.7, 0.85)),
        _bin(len(line) / n, (2.5, 4, 5, 6, 8, 11, 16)),
        int(line.rstrip()[-1:] in ".!?…\"'”»:") + 2 * int(line.lstrip()[:1].isupper()),
        _bin(digits / n, (0.02, 0.1, 0.3, 0.6)),
    )


def lines_of(text: str) -> tuple[list[tuple[int, ...]], list[int], int]:
    """Features and number of words of each line with a word, and how many of these lines equal an earlier one."""
    features, counts, seen, again = [], [], set(), 0
    for line in text.split("\n"):
        words = line.split()
        if not words and not line.strip(WHITE):
            continue
        words = words or [line]
        known = line in seen
        again += known
        seen.add(line)
        features.append(line_features(line, words, known))
        counts.append(len(words))
    return features, counts, again


class LineField:
    """A linear-chain conditional random field over two labels with binned features."""

    def __init__(self, emit: np.ndarray, step: np.ndarray):
        self.emit, self.step = emit, step  # feature x bin x label; label x label

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Line x label."""
        return self.emit[np.arange(features.shape[-1]), features].sum(axis=-2)

    def decode(self, scores: list[list[float]]) -> list[int]:
        """Viterbi: the labels of the likeliest sequence; ties go to content."""
        (bb, bc), (cb, cc) = self.step.tolist()
        b, c = scores[0]
        came: list[tuple[int, int]] = []
        for eb, ec in scores[1:]:
            to_b, to_c = (BOILERPLATE if b + bb > c + cb else CONTENT), (BOILERPLATE if b + bc > c + cc else CONTENT)
            came.append((to_b, to_c))
            b, c = max(b + bb, c + cb) + eb, max(b + bc, c + cc) + ec
        label = CONTENT if c >= b else BOILERPLATE
        out = [label]
        for back in reversed(came):
            label = back[label]
            out.append(label)
        return out[::-1]


def spliced(cut: list[tuple[np.ndarray, int]], seed: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each sequence with its label, one that goes on where it stops with lines of a sequence of the other label, and may turn
    back once: line features and line labels."""
    rng = np.random.default_rng(seed)
    others = [[s for s, y in cut if y != k] for k in (0, 1)]
    out = []
    for s, y in cut:
        if not others[y]:
            continue
        other = others[y][int(rng.integers(len(others[y])))]
        stop, length = int(rng.integers(1, len(s) + 1)), int(rng.integers(1, len(other) + 1))
        start = int(rng.integers(len(other) - length + 1))
        parts = [s[:stop], other[start : start + length], s[stop:] if rng.random() < 0.5 else s[:0]]
        labels = np.repeat([y, 1 - y, y], [len(p) for p in parts])
        out.append((np.concatenate(parts)[:SEQUENCE], labels[:SEQUENCE]))
    return out


def fit(sequences: list[np.ndarray], labels: list[int], steps: int = STEPS, ridge: float = 1e-3) -> LineField:
    """Fits the field to sequences of line features, of which all lines have the sequence's label, and to splices of them."""
    cut = [(s[i : i + SEQUENCE], y) for s, y in zip(sequences, labels, strict=True) for i in range(0, len(s), SEQUENCE)]
    mixed = spliced(cut)
    y = np.array([y for _, y in cut])
    share = np.array([(y == k).mean() for k in (0, 1)])
    weight = np.concatenate([(0.5 / np.maximum(share, 1e-9))[y], np.ones(len(mixed))])[:, None]  # both labels count alike
    lines = [(s, np.full(len(s), y)) for s, y in cut] + mixed
    n, most = len(lines), max(len(s) for s, _ in lines)
    x = np.zeros((n, most, N_FEATURES), dtype=np.int64)
    there = np.zeros((n, most), dtype=bool)
    gold = np.zeros((n, most, 2))
    for i, (s, of_lines) in enumerate(lines):
        x[i, : len(s)], there[i, : len(s)], gold[i, : len(s)] = s, True, np.eye(2)[of_lines]
    emit, step = np.zeros((N_FEATURES, BINS, 2)), np.zeros((2, 2))
    moments = [np.zeros_like(emit) + 1e-8, np.zeros_like(step) + 1e-8]
    for _ in range(steps):
        score = emit[np.arange(N_FEATURES), x].sum(axis=2)
        forward = np.zeros((n, most, 2))
        forward[:, 0] = score[:, 0]
        for t in range(1, most):
            ahead = np.logaddexp(forward[:, t - 1, :1] + step[0], forward[:, t - 1, 1:] + step[1]) + score[:, t]
            forward[:, t] = np.where(there[:, t, None], ahead, forward[:, t - 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        back = np.zeros((n, most, 2))
        d_step = np.zeros((2, 2))
        for t in range(most - 2, -1, -1):
            after = back[:, t + 1] + score[:, t + 1]
            both = forward[:, t, :, None] + step + after[:, None, :] - total[:, None, None]
            live = (there[:, t + 1, None, None]) * weight[:, :, None]
            d_step += (live * (gold[:, t, :, None] * gold[:, t + 1, None, :] - np.exp(both))).sum(axis=0)
            back[:, t] = np.where(there[:, t + 1, None], np.logaddexp(step[:, 0] + after[:, :1], step[:, 1] + after[:, 1:]), back[:, t + 1])
        gap = (gold - np.exp(forward + back - total[:, None, None])) * there[:, :, None] * weight[:, :, None]
        d_emit = np.zeros_like(emit)
        for f in range(N_FEATURES):
            for label in (0, 1):
                d_emit[f, :, label] = np.bincount(x[:, :, f].reshape(-1), gap[:, :, label].reshape(-1), BINS)
        for value, gradient, moment in ((emit, d_emit, moments[0]), (step, d_step, moments[1])):
            gradient = gradient / n - ridge * value
            moment += gradient**2
            value += 0.5 * gradient / np.sqrt(moment)
    return LineField(emit, step)


def _spread(lines: np.ndarray, most: int = SAMPLE_LINES) -> np.ndarray:
    """The lines, or of more than so many, sequences of them from start to end."""
    if len(lines) <= most:
        return lines
    starts = np.linspace(0, len(lines) - SEQUENCE, most // SEQUENCE).astype(np.int64)
    return lines[(starts[:, None] + np.arange(SEQUENCE)).reshape(-1)]


def labelled_lines(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> tuple[list[np.ndarray], list[int]]:
    """Line features and label of the sampled documents; the driver gets a byte for each feature of their lines."""
    spark = docs.sparkSession
    shared.ship(spark)
    least = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    chosen = least.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = shared.schema_of("doc_id long, quality int, features binary")
        for batch in shared.slices(batches, "text"):
            features = []
            for text in shared.texts_of(batch):
                words = words_of(text)
                # the field isn't asked about what the base rules fail, so it learns nothing from it
                asked = not base_fails(words, repeated_words(words))
                features.append(_spread(np.array(lines_of(text)[0], dtype=np.uint8)).tobytes() if asked else b"")
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "features": features}, schema=schema)

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    joined = texts.join(F.broadcast(chosen.select("doc_id", F.col("quality").cast("int").alias("quality"))), "doc_id")
    rows = joined.select("doc_id", "quality", "text").mapInArrow(shared.lean(featured), "doc_id long, quality int, features binary")
    first = rows.where("length(features) > 0").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("features").alias("features"))
    found = [(np.frombuffer(r["features"], np.uint8).reshape(-1, N_FEATURES).astype(np.int64), int(r["quality"] > 0)) for r in first.collect()]
    found.sort(key=lambda x: (x[1], x[0].tobytes()))
    return [s for s, _ in found], [y for _, y in found]


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> LineField | None:
    sequences, kinds = labelled_lines(docs, labels, sample)
    return fit(sequences, kinds) if len(set(kinds)) == 2 else None


def judged(docs: DataFrame, field: LineField | None, content_share: float = CONTENT_SHARE) -> DataFrame:
    """RESULT for each document."""
    shared.ship(docs.sparkSession)
    ddl = RESULT

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = shared.schema_of(ddl)
        for batch in shared.slices(batches, "text"):
            rows, features, spans = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), shared.texts_of(batch), strict=True):
                words = words_of(text)
                lines, counts, again = lines_of(text)
                repeated = repeated_words(words)
                failed = base_fails(words, repeated)
                rows.append([doc_id, len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), again, repeated, failed])
                spans.append((len(features), counts))
                features += lines
            scores = field.scores(np.array(features, dtype=np.int64)).tolist() if field and features else []
            for row, (start, counts) in zip(rows, spans, strict=True):
                if field is None or not counts:
                    share = float(bool(counts))
                else:
                    share = sum(n for n, y in zip(counts, field.decode(scores[start : start + len(counts)]), strict=True) if y == CONTENT) / sum(counts)
                row += [not row[6] and share >= content_share, share]
            yield pa.RecordBatch.from_pydict({f.name: [r[i] for r in rows] for i, f in enumerate(schema)}, schema=schema)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(shared.lean(judge), RESULT)


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, content_share: float = CONTENT_SHARE) -> DataFrame:
    return judged(docs, fitted(docs, labels, sample), content_share)


def kept_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, content_share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of docs that the rules keep, as they are. The verdict is taken beside each row, so nothing is joined."""
    field = fitted(docs, labels, sample)
    schema = docs.schema
    shared.ship(docs.sparkSession)
    keeps = shared.lean_column(lambda x: _keeps(x or "", field, content_share), "boolean")
    return docs.where(keeps(F.col("text").cast("string"))).select(*schema.names)


def _keeps(text: str, field: LineField | None, content_share: float) -> bool:
    words = words_of(text)
    if base_fails(words, repeated_words(words)):
        return False
    lines, counts, _ = lines_of(text)
    if field is None or not counts:
        return True
    labels = field.decode(field.scores(np.array(lines, dtype=np.int64)).tolist())
    return sum(n for n, y in zip(counts, labels, strict=True) if y == CONTENT) >= content_share * sum(counts)
