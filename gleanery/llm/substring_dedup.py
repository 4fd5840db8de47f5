"""Substring dedup: compact windows.

A text is a sequence of 5-word shingles; its passages are windows of SPAN shingles (MIN_WORDS words) or more. For each of
several hash functions the Cartesian tree over the shingles' hashes groups the windows: a node of the tree is a compact window
(l, c, r), and all windows inside l..r that hold place c have the shingle at c as their least. Only nodes at least SPAN wide
are made, about 2 n / SPAN of them in a text of n shingles. Windows that agree with another text's have the same least
shingle by chance of their likeness, so several functions find nearly all.

Rows of compact windows meet at a key: the least shingle and those beside it. Under the first function a row is made for the
seven on its right and one for the seven on its left, one of which lies inside any window; under the others, one for the two on
either side. A row is made for every place that is some window's first least, so windows that are equal have rows of the same key
at the same place of them, however often their least shingle recurs; places in a row whose surroundings are the same, as in a
line that is one word, have one row that stands for all of them. Where a key's shingles are one again and again, a
run of it has rows for the first and the last place alone: a window that opens inside the run goes by the last one, and one that lies
inside it equals the one that opens where the run does. So a text has two rows of such a key for a run, however long. Keys of one text alone go. What is left is joined by intervals inside each key: laid upon each other at c, two
compact windows and what stands around them show at once which of the windows that hold c agree, so no text is read again. A
window agrees if AGREE of its shingles (for sets of a size that is a Jaccard similarity of 75 %) stand in the other text
within SPAN - AGREE places of the same place, and as many of a window there stand in it; words put in or left out move what
follows by no more. The rows of a key never become pairs outside its task.

In a key, whatever its size, each row meets the rows of all texts of lesser numbers, as long as it has windows that none of
those met before has, or a text of a still lesser number may have one. In a key of over PAIRED rows, pairs that can't agree
aren't laid upon each other: a window that agrees leaves SLACK places open at most, so if it has more than these that few texts have
near the same place, it meets these texts alone; for other windows, chunks of CHUNK places leave no more open either, and
bitmaps of chunks show at once how many places of each can't stand in the other text; of
what they leave open, a row's places are looked for in many texts at once. The rows of a key of over LARGE rows are
dealt into blocks by text, and each two blocks meet inside a task; what they find of a row is put together. So no size of a key
changes what is found. Of texts that share a passage, the one whose number is least keeps it. Equal texts are one node; copies after the first doc_id are
reported whole.

Defined cases: a null or empty text, or one under MIN_WORDS words, has no passages; rows with the same doc_id are told apart
by their texts; a null doc_id sorts first and is reported as null; other columns are ignored; an empty table gives an empty
result; texts of any length are taken whole. A passage that only one document has, however often, isn't reported.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm import shared
from gleanery.llm.shingles import WIDTH, mixed, shingles_of_texts, words_of_texts

MIN_WORDS = 50
SPAN = MIN_WORDS - WIDTH + 1
#: Of SPAN shingles, how many must agree, and how many places apart they may stand.
AGREE = -(-6 * SPAN // 7)
SLACK = SPAN - AGREE
#: Hash functions; shingles on one side, and on either side, that make a key with the least one.
FUNCTIONS, SIDE, BESIDE = 3, 8, 2
#: Places on each side of c that windows with c can agree with.
REACH = SPAN - 1 + SLACK
WIDE = 2 * REACH + 1
#: Rows of a key whose pairs are all laid upon each other, and that one task takes; larger keys are dealt into blocks.
PAIRED, LARGE = 48, 8192
#: Places of a chunk, and chunks on either side of c (the first on the left holds c).
CHUNK = (SPAN - 2) // 4
CHUNKS = SPAN // CHUNK
#: Whole chunks on the left and on the right in each of the windows that hold c.
CHUNKS_IN = [((SPAN - s) // CHUNK, s // CHUNK) for s in range(SPAN)]
#: Pairs that are laid upon each other at a time, and that bitmaps are compared of.
PAIRS_AT_ONCE, MARKED_AT_ONCE = 1 << 14, 1 << 18
#: Texts that the rows of a key meet first, and at a time later on; of so many that bitmaps leave open, places are looked at.
FIRST_MET, MOST_MET, LEAST_MARKED = 8, 512, 16
#: Of so many places of a window that agrees, one agrees.
RARE = SLACK + 1
#: Ids that may be broadcast.
BROADCAST_IDS = 1_000_000
REMEMBERED = 100_000
_LOW = np.uint64((1 << 23) - 1)
#: A place c in a column has how far beyond it the last place is that its row stands for in the bits from BEYOND on; with the bit
#: IN_RUN, that is the last place of c's run of one shingle, and the row stands for the windows inside the run alone.
BEYOND, IN_RUN = 32, 1 << 62
_PLACE, _FAR = (1 << BEYOND) - 1, (1 << 30) - 1
_SEEDS = np.array([0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2127599BF4325C37, 0x880355F21E6D1965], dtype=np.uint64)

TEXTS = "_id long, node long, n_words long, sequence binary, rows binary"
ROWS = "part long, key long, node long, c long, known boolean"
PLACES = "key long, node long, c long"
AROUND = "group long, node long, c long, left int, around binary"
IN_BLOCKS = f"{AROUND}, key long"
SPANS = "node long, pivot long, start long, end long"
SPANS_AT = f"{SPANS}, key long, c long"
RESULT_COLUMNS = ("doc_id", "start_word", "end_word", "other_doc_id")


def node_of(words: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(words.tobytes()) - (1 << 63)


def least_of_windows(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each window of span hashes, where its least one stands (the first of equal ones); prefix and suffix minima of blocks."""
    n = len(hashes)
    marked = (hashes & ~_LOW) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // span)
    full = np.full(blocks * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[:n] = marked
    square = full.reshape(blocks, span)
    before = np.minimum.accumulate(square, axis=1).reshape(-1)
    after = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(after[: n - span + 1], before[span - 1 : n]) & _LOW).astype(np.int64)


def compact_windows(hashes: np.ndarray, owner: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, c and r (inclusive) of the nodes, span or more wide, of the Cartesian trees over the hashes of several texts that
    stand one after another; owner: which text each is of. A node that wide is the least of some window of span, and the
    windows that it is the least of are one run, so a pass over the windows makes the nodes without the narrow ones below them;
    l and r reach as far as such windows do, span - 1 places from c."""
    if len(hashes) < span:
        return (np.zeros(0, dtype=np.int64),) * 3
    inside = owner[: len(owner) - span + 1] == owner[span - 1 :]
    least = least_of_windows(hashes, span)
    new = np.ones(len(least), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(least)) - 1
    held = inside[starts]
    return starts[held], least[starts[held]], ends[held] + span - 1


def places_of(hashes: np.ndarray, owner: np.ndarray, span: int = SPAN) -> np.ndarray:
    """So few places c of the compact windows that each window still holds one, where the least shingle stands again and again. Keys are
    made of all places: with these alone, texts whose windows are equal may hold different places of them."""
    low, c, high = compact_windows(hashes, owner, span)
    again = np.zeros(len(c) + 1, dtype=bool)
    again[1:-1] = (hashes[c[1:]] == hashes[c[:-1]]) & (owner[c[1:]] == owner[c[:-1]])
    if not again.any():
        return c
    lone = ~again[:-1] & ~again[1:]
    taken: list[int] = []
    first = np.flatnonzero(~again[:-1] & again[1:])
    last = np.flatnonzero(again[:-1] & ~again[1:])
    for i, j in zip(first.tolist(), last.tolist(), strict=True):
        places, start, end = c[i : j + 1].tolist(), int(low[i]), int(high[j]) - span + 1
        while start <= end:
            taken.append(places[bisect.bisect_right(places, start + span - 1) - 1])
            start = taken[-1] + 1
    return np.sort(np.concatenate([c[lone], np.array(taken, dtype=np.int64)]))


def places_with_runs(shingles: np.ndarray, hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """All places c of the compact windows. Those that follow each other with the same surroundings (WIDE shingles), as in a line that
    is one word, are the first of them and, from the bit BEYOND on, how far beyond it the last one is: what another text shares around
    one it shares around each."""
    c = compact_windows(hashes, owner)[1]
    first = np.ones(len(c), dtype=bool)
    again = np.flatnonzero((hashes[c[1:]] == hashes[c[:-1]]) & (owner[c[1:]] == owner[c[:-1]]))
    again = again[(c[again] >= REACH) & (c[again + 1] + REACH < len(hashes))]
    again = again[owner[c[again] - REACH] == owner[c[again + 1] + REACH]]
    around = np.arange(-REACH, REACH + 1)
    for k in range(0, len(again), 1 << 12):
        some = again[k : k + (1 << 12)]
        first[some + 1] = (shingles[c[some][:, None] + around] != shingles[c[some + 1][:, None] + around]).any(axis=1)
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(c)) - 1
    return c[starts] + ((c[ends] - c[starts]) << BEYOND) if len(c) else c


def runs_around(places: np.ndarray, shingles: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last place of the run of one shingle that each place is in."""
    new = np.ones(len(shingles), dtype=bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    firsts = np.flatnonzero(new)
    run = np.searchsorted(firsts, places & _PLACE, side="right") - 1
    return firsts[run], np.append(firsts[1:], len(shingles))[run] - 1


def ends_of_runs(places: np.ndarray, first: np.ndarray, last: np.ndarray, low: int, high: int) -> np.ndarray:
    """The places that make a row of a key of the shingles from low to high around them: where these are one run's, the first and the
    last place of the run at which they are. A window that opens inside a run, which is its least, goes by the last one if it reaches
    beyond the run, whether it opens at the run's first place or further on; if it doesn't, it equals the window from there on."""
    c, far = places & _PLACE, (places & _PLACE) + (places >> BEYOND)
    ends = np.unique(last[(last - first >= high - low) & (far + SPAN > last)]) - high
    inside = (c + low >= first) & (far + high <= last)
    lead = np.flatnonzero(inside)
    lead = lead[np.concatenate([[True], first[lead[1:]] != first[lead[:-1]]])] if len(lead) else lead
    long = np.where(last[lead] - c[lead] + 1 >= SPAN, IN_RUN | ((last[lead] - c[lead]) << BEYOND), 0)
    return np.concatenate([places[~inside], c[lead] + long, np.setdiff1d(ends, c[lead])])


def keys_of(shingles: np.ndarray, owner: np.ndarray, functions: int = FUNCTIONS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of the compact windows, and their places c (with what they stand for): with the shingles on the right and with those on
    the left under the first hash function, with those on either side under each other one."""

    def contents(length: int) -> tuple[np.ndarray, np.ndarray]:
        n = max(0, len(shingles) - length + 1)
        content = np.zeros(n, dtype=np.uint64)
        for k in range(length):
            content = mixed(content + shingles[k : k + n])
        return content, owner[:n] == owner[length - 1 :][:n]

    one_side, either_side = contents(SIDE), contents(2 * BESIDE + 1)
    for f in range(functions):
        found = places_with_runs(shingles, mixed(shingles ^ _SEEDS[f]), owner)
        first, last = runs_around(found, shingles, owner)
        for k, (low, high, (content, whole)) in enumerate([(-BESIDE, BESIDE, either_side)] if f else [(0, SIDE - 1, one_side), (1 - SIDE, 0, one_side)]):
            places = ends_of_runs(found, first, last, low, high)
            start = (places & _PLACE) + low
            there = (start >= 0) & (start < len(content))
            there[there] = whole[start[there]]
            yield mixed(content[start[there]] + _SEEDS[4] * np.uint64(2 * f + k + 1)), places[there]


def brief(shingles: np.ndarray) -> np.ndarray:
    """The upper 16 bits of each number, which is what texts are compared by: a window needs AGREE of SPAN places to agree, so
    unlike windows pass with a chance under 2**-400, and a place too many counts in about one of 5,000."""
    return (shingles >> np.uint64(48)).astype(np.uint16)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """TEXTS of the documents. sequence and rows (keys, then places) are of texts of MIN_WORDS words or more that the task has not had."""
    schema, seen = shared.schema_of(TEXTS), set()
    for batch in shared.slices(batches, "text", most=1 << 20):
        words = words_of_texts(shared.texts_of(batch))
        nodes = [node_of(w) for w in words]
        sequences: list[bytes | None] = [None] * len(words)
        rows: list[bytes | None] = [None] * len(words)
        at = []
        for i, (w, node) in enumerate(zip(words, nodes, strict=True)):
            if len(w) >= MIN_WORDS and node not in seen:
                if len(seen) < REMEMBERED:
                    seen.add(node)
                at.append(i)
        parts = shingles_of_texts([words[i] for i in at])
        for i, part in zip(at, parts, strict=True):
            sequences[i] = brief(part).tobytes()
        for i, keys, places in _rows(parts):
            rows[at[i]] = keys.tobytes() + places.tobytes()
        columns = (batch.column("_id"), nodes, [len(w) for w in words], sequences, rows)
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)


def _rows(parts: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Keys and places of each text. Places must fit the low bits, so a longer text is taken in pieces that overlap by a window
    and its surroundings, and few texts are taken at a time."""
    most, held = int(_LOW) + 1, 0
    while held < len(parts):
        if len(parts[held]) > most:
            found = []
            for start in range(0, len(parts[held]), most - WIDE):
                piece = parts[held][start : start + most]
                found += [(key, c + start) for key, c in keys_of(piece, np.zeros(len(piece), dtype=np.int8))]
            yield held, np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])
            held += 1
            continue
        end, size = held, 0
        while end < len(parts) and size + len(parts[end]) <= most:
            size += len(parts[end])
            end += 1
        lengths = np.array([len(p) for p in parts[held:end]])
        owner = np.repeat(np.arange(end - held, dtype=np.int32), lengths)
        starts = np.cumsum(lengths) - lengths
        found = list(keys_of(np.concatenate(parts[held:end]), owner))
        key, c = (np.concatenate(x) for x in zip(*found, strict=True))
        own = owner[c & _PLACE]
        order = np.argsort(own, kind="stable")
        key, c, own = key[order], c[order], own[order]
        cuts = np.searchsorted(own, np.arange(end - held + 1))
        for i in range(end - held):
            if cuts[i] < cuts[i + 1]:
                yield held + i, key[cuts[i] : cuts[i + 1]], c[cuts[i] : cuts[i + 1]] - starts[i]
        held = end


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ROWS of each batch, combined before they are moved: of a key that several texts of the batch have, only the first row goes to
    the key's task, and the others, known to be shared, anywhere. A hot key is then a row a batch in its task."""
    schema = shared.schema_of(ROWS)
    for batch in batches:
        held, nodes = batch.column("rows").to_pylist(), batch.column("node").to_numpy()
        lengths = np.array([len(x) // 16 for x in held], dtype=np.int64)
        if not lengths.sum():
            continue
        key = np.concatenate([np.frombuffer(x, np.uint64, n) for x, n in zip(held, lengths, strict=True)])
        c = np.concatenate([np.frombuffer(x, np.int64, n, 8 * n) for x, n in zip(held, lengths, strict=True)])
        node = np.repeat(nodes, lengths)
        order = np.lexsort((c, node, key))
        key, node, c = key[order], node[order], c[order]
        first, several = runs_of(key, node)
        part = np.where(first | ~several, key, mixed(key + mixed(node.view(np.uint64) + c.astype(np.uint64))))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part.view(np.int64), key.view(np.int64), node, c, several)], schema=schema)


def runs_of(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order of key and node: which are a key's first, and which have a key that several nodes have."""
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(key)) - 1
    return first, np.repeat(node[starts] != node[ends], ends - starts + 1)


def _shared_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PLACES of the rows whose key several texts have; rows come in order of part, key and node. Holds a key's rows between batches."""
    schema = shared.schema_of(PLACES)
    held: list[np.ndarray] | None = None  # the last key's rows: key, node, c, known

    def told(key: np.ndarray, node: np.ndarray, c: np.ndarray, known: np.ndarray) -> Iterator[pa.RecordBatch]:
        first, several = runs_of(key, node)
        starts = np.flatnonzero(first)
        out = several | np.repeat(np.logical_or.reduceat(known, starts), np.diff(np.append(starts, len(key))))
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (key, node, c)], schema=schema)

    for batch in batches:
        part, *columns = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("part", "key", "node", "c", "known"))
        apart = part != columns[0]
        if apart.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[apart]) for x in columns[:3]], schema=schema)
        columns = [x[~apart] for x in columns]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        others = np.flatnonzero(columns[0] != columns[0][-1])
        cut = int(others[-1]) + 1 if len(others) else 0
        held = [x[cut:] for x in columns]
        if cut:
            yield from told(*(x[:cut] for x in columns))
    if held is not None:
        yield from told(*held)


def stretch(sequence: bytes, c: int) -> tuple[int, bytes]:
    """The shingles from REACH places before c, or the text's first, to REACH behind it, and how many stand before c."""
    left = min(c, REACH)
    return left, sequence[2 * (c - left) : 2 * (c + REACH + 1)]


def laid_out(left: np.ndarray, around: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Stretches as rows of WIDE shingles with c in the middle, and which of them there are."""
    lengths = np.array([len(x) // 2 for x in around], dtype=np.int64)
    place = np.arange(WIDE)
    there = (place >= REACH - left[:, None]) & (place < REACH - left[:, None] + lengths[:, None])
    x = np.zeros(there.shape, dtype=np.uint16)
    x[there] = np.frombuffer(b"".join(around), np.uint16)
    return x, there


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """AROUND of each place of a text."""
    schema = shared.schema_of(AROUND)
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            lengths = np.diff(batch.column("places").offsets.to_numpy())
            key, c = (batch.column("places").flatten().field(x) for x in ("key", "c"))
            row = np.repeat(np.arange(batch.num_rows), lengths)
            sequences = batch.column("sequence").to_pylist()
            found = [stretch(sequences[i], k & _PLACE) for i, k in zip(row.tolist(), c.to_pylist(), strict=True)]
            columns = [key, batch.column("node").take(pa.array(row)), c, pa.array([x for x, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """IN_BLOCKS of rows of large keys: each in a group for its block with each other one. The rows of a text are in one block."""
    schema = shared.schema_of(IN_BLOCKS)
    for whole in batches:
        counts = whole.column("blocks").to_numpy()
        for n in np.unique(counts).tolist():
            at = np.flatnonzero(counts == n)
            for start in range(0, len(at), max(1, 4096 // n)):
                batch = whole.take(pa.array(at[start : start + max(1, 4096 // n)]))
                key, node = (batch.column(x).to_numpy().view(np.uint64) for x in ("group", "node"))
                own = (mixed(node ^ _SEEDS[4]) % np.uint64(n)).astype(np.int64)[:, None]
                row, other = np.nonzero(own != np.arange(n))
                mine = own[row, 0]
                group = mixed(key[row] + mixed((np.minimum(mine, other) * n + np.maximum(mine, other) + 1).astype(np.uint64)))
                taken = batch.take(pa.array(row))
                columns = [pa.array(group.view(np.int64)), *(taken.column(x) for x in ("node", "c", "left", "around", "group"))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)


def agreeing(x: np.ndarray, x_there: np.ndarray, y: np.ndarray, y_there: np.ndarray) -> np.ndarray:
    """For pairs of rows (WIDE shingles around c, and which of them there are): which of the SPAN windows of x that hold c agree with
    one of y. Column s is the window from c - SPAN + 1 + s."""
    of_x, of_y = np.zeros(x.shape, dtype=bool), np.zeros(y.shape, dtype=bool)
    for d in range(-SLACK, SLACK + 1):
        a, b = slice(max(0, -d), WIDE - max(0, d)), slice(max(0, d), WIDE - max(0, -d))
        same = (x[:, a] == y[:, b]) & x_there[:, a] & y_there[:, b]
        of_x[:, a] |= same
        of_y[:, b] |= same
    good_x, good_y = _full(of_x) >= AGREE, _full(of_y) >= AGREE
    good_x &= _full(x_there) == SPAN
    good_y &= _full(y_there) == SPAN
    beside = np.concatenate([np.zeros((len(y), 1), dtype=np.int16), np.cumsum(good_y, axis=1, dtype=np.int16)], axis=1)
    return good_x[:, SLACK : SLACK + SPAN] & (beside[:, 2 * SLACK + 1 :] > beside[:, : SPAN])


def _full(marks: np.ndarray) -> np.ndarray:
    """How many marks each window of SPAN places holds, row by row."""
    total = np.zeros((len(marks), WIDE + 1), dtype=np.int16)
    np.cumsum(marks, axis=1, dtype=np.int16, out=total[:, 1:])
    return total[:, SPAN:] - total[:, :-SPAN]


def chunk_bitmaps(x: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each chunk (those on the left, from c on, then those on the right) and each row a bitmap of 64 bits of the places of the
    chunk, and one of the places that these may agree with in another row."""
    bits = np.where(there, np.uint64(1) << (x.astype(np.uint64) & np.uint64(63)), np.uint64(0))
    firsts = [REACH + 1 - CHUNK * (k + 1) for k in range(CHUNKS)] + [REACH + 1 + CHUNK * k for k in range(CHUNKS)]
    own = [np.bitwise_or.reduce(bits[:, a : a + CHUNK], axis=1) for a in firsts]
    zone = [np.bitwise_or.reduce(bits[:, max(0, a - SLACK) : a + CHUNK + SLACK], axis=1) for a in firsts]
    return np.array(own), np.array(zone)


def may_agree(own: np.ndarray, zone: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Which rows (own bitmaps) may have a live window that agrees with one of the others (by their zones): a bit that a chunk has and
    the zone hasn't is a place at least that agrees with none, of which a window has SLACK at most."""
    sides = []
    for side in (0, CHUNKS):
        gone = [np.zeros((own.shape[1], zone.shape[1]), dtype=np.uint8)]
        for k in range(side, side + CHUNKS):
            gone.append(gone[-1] + np.bitwise_count(own[k][:, None] & ~zone[k]))
        sides.append(gone)
    out = np.zeros((own.shape[1], zone.shape[1]), dtype=bool)
    for a, b in dict.fromkeys(CHUNKS_IN):
        rows = live[:, [s for s in range(SPAN) if CHUNKS_IN[s] == (a, b)]].any(axis=1)
        if rows.any():
            out |= (sides[0][a] + sides[1][b] <= SLACK) & rows[:, None]
    return out


def agree_one_way(x: np.ndarray, others: np.ndarray, live: np.ndarray) -> np.ndarray:
    """In which of the others (a column each) AGREE places of a live window of x stand near the same place, or may."""
    first = SLACK + int(live[0])
    places = slice(first, SLACK + int(live[-1]) + SPAN)
    same = np.zeros((places.stop - first, others.shape[1]), dtype=bool)
    for d in range(-SLACK, SLACK + 1):
        same |= x[places, None] == others[first + d : places.stop + d]
    total = np.zeros((len(same) + 1, others.shape[1]), dtype=np.int8)
    np.cumsum(same, axis=0, dtype=np.int8, out=total[1:])
    at = live - int(live[0])
    return (total[at + SPAN] - total[at] >= AGREE).any(axis=0)


class Group:
    """Rows around places, with what is found of each: the windows that agree with a text before, and the first such text's row."""

    def __init__(self, node: np.ndarray, x: np.ndarray, there: np.ndarray, c: np.ndarray | None = None):
        self.node, self.x, self.there, self.c = node, x, there, c
        self.found = np.zeros((len(node), SPAN), dtype=bool)
        self.other = np.full(len(node), len(node), dtype=np.int64)

    def meet(self, i: np.ndarray, j: np.ndarray) -> None:
        """Rows i with rows j, which are of texts of lesser numbers; i ascending."""
        for start in range(0, len(i), PAIRS_AT_ONCE):
            a, b = i[start : start + PAIRS_AT_ONCE], j[start : start + PAIRS_AT_ONCE]
            good = agreeing(self.x[a], self.there[a], self.x[b], self.there[b])
            some = good.any(axis=1)
            a, b, good = a[some], b[some], good[some]
            np.minimum.at(self.other, a, b)
            if len(a):
                rows = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                self.found[a[rows]] |= np.logical_or.reduceat(good, rows, axis=0)

    def equal_windows(self, group: np.ndarray) -> None:
        """Windows that are equal to one of a text before in the same group, by their content; c may stand elsewhere in it."""
        x = self.x.astype(np.uint64)
        content = np.repeat(mixed(group.view(np.uint64))[:, None], SPAN, axis=1)
        for k in range(SPAN):
            content = (content ^ x[:, SLACK + k : SLACK + k + SPAN]) * _SEEDS[0] + _SEEDS[k % 6]
        row, s = np.nonzero(_full(self.there)[:, SLACK : SLACK + SPAN] == SPAN)
        if not len(row):
            return
        content = mixed(content[row, s])
        order = np.argsort(content, kind="stable")
        content, row, s = content[order], row[order], s[order]
        new = np.ones(len(content), dtype=bool)
        new[1:] = content[1:] != content[:-1]
        lead = row[np.flatnonzero(new)[np.cumsum(new) - 1]]
        later = self.node[lead] != self.node[row]
        self.found[row[later], s[later]] = True
        np.minimum.at(self.other, row[later], lead[later])

    def outermost(self, start: int, end: int) -> np.ndarray:
        """Which windows of the rows from start to end hold no place of their text's row before, or none of the row behind. A window that
        holds many of a text's places, as in a run of one word, is asked at the first and the last of them, where other texts are laid
        on it from where the run begins and from where it ends. Rows whose surroundings aren't the same text moved on count as apart."""
        if self.c is None:
            return np.ones((end - start, SPAN), dtype=bool)
        node, x, c = self.node[start:end], self.x[start:end], self.c[start:end] & _PLACE
        last = c + stood_for(self.c[start:end])
        on = c[1:] - last[:-1]
        near = np.flatnonzero((node[1:] == node[:-1]) & (on > 0) & (on < SPAN))
        moved = np.arange(WIDE) + on[near][:, None]
        same = np.zeros(len(on), dtype=bool)
        same[near] = ((np.take_along_axis(x[near], np.minimum(moved, WIDE - 1), axis=1) == x[near + 1]) | (moved >= WIDE)).all(axis=1)
        before = np.concatenate([[-1], np.where(same, last[:-1], -1)])
        behind = np.concatenate([np.where(same, c[1:], _PLACE), [_PLACE]])
        ends = c[:, None] + np.arange(SPAN)
        return (ends - SPAN + 1 > before[:, None]) | (ends < behind[:, None])

    def by_rare_places(self, start: int, end: int, windows: np.ndarray) -> np.ndarray:
        """Meets, for the rows from start to end, all texts that those of the windows (not found yet) that hold RARE places seldom had in the
        group may agree with, and tells which windows these are: a window leaves SLACK places open at most, so one of any RARE places
        stands near the same place in each text that it agrees with. Rows of the same text don't count: a text with a run of one word has
        many, each with the others' surroundings a place further on."""
        n, settled = end - start, np.zeros_like(windows)
        text = np.cumsum(np.concatenate([[0], self.node[start + 1 : end] != self.node[start : end - 1]])) << (7 + 16)
        code = (self.x[start:end].astype(np.int64) << 7) + np.arange(WIDE)
        row, place = np.nonzero(self.there[start:end])
        held = code[row, place]
        of_text = np.sort(text[row] + held)
        order = np.argsort(held, kind="stable")
        held, row = held[order], row[order]
        some = np.flatnonzero(windows.any(axis=1))
        for k in range(0, len(some), 256):
            rows = some[k : k + 256]
            near = code[rows]
            low, high = np.searchsorted(held, near - SLACK), np.searchsorted(held, near + SLACK, side="right")
            own = near + text[rows][:, None]
            others = high - low - (np.searchsorted(of_text, own + SLACK, side="right") - np.searchsorted(of_text, own - SLACK))
            alone = windows[rows] & (_full(others == 0)[:, SLACK : SLACK + SPAN] >= RARE)
            settled[rows] |= alone
            i, s = np.nonzero(windows[rows] & ~alone)
            if not len(i):
                continue
            of_windows = np.lib.stride_tricks.sliding_window_view(others, SPAN, axis=1)[i, SLACK + s]
            rarest = np.argpartition(of_windows, RARE - 1, axis=1)[:, :RARE]
            seldom = np.take_along_axis(of_windows, rarest, axis=1).sum(axis=1) <= n // 8
            settled[rows[i[seldom]], s[seldom]] = True
            chosen = np.zeros(near.shape, dtype=bool)
            chosen[i[seldom][:, None], SLACK + s[seldom][:, None] + rarest[seldom]] = True
            i, at = np.nonzero(chosen & (others > 0))
            if not len(i):
                continue
            counts = (high - low)[i, at]
            cuts = np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum(), MARKED_AT_ONCE))
            for a, b in zip(cuts, [*cuts[1:], len(i)], strict=True):
                m = counts[a:b]
                j = row[np.repeat(low[i[a:b], at[a:b]] - (np.cumsum(m) - m), m) + np.arange(m.sum())]
                mine = np.repeat(rows[i[a:b]], m)
                less = self.node[start + j] < self.node[start + mine]
                pairs = np.unique(mine[less] * n + j[less])
                self.meet(start + pairs // n, start + pairs % n)
        return settled

    def large(self, start: int, end: int) -> None:
        """What the rows from start to end, in order of node, find among themselves: what all their pairs would, but windows of rare
        places meet few texts, and pairs whose bitmaps leave no window open that agrees, and rows that need no further text, aren't laid upon each other."""
        node, there = self.node[start:end], self.there[start:end]
        full = (_full(there)[:, SLACK : SLACK + SPAN] == SPAN) & self.outermost(start, end)
        full &= ~self.by_rare_places(start, end, full & ~self.found[start:end])
        own, zone = chunk_bitmaps(self.x[start:end], there)
        columns = np.ascontiguousarray(self.x[start:end].T)
        at, size = 0, FIRST_MET
        while at < end - start:
            until = min(end - start, at + size)
            rows = at + np.flatnonzero(node[at:] > node[at])
            live = full[rows] & (~self.found[start + rows] | (self.other[start + rows] > start + at)[:, None])
            rows, live = rows[live.any(axis=1)], live[live.any(axis=1)]
            step = max(1, MARKED_AT_ONCE // (until - at))
            for k in range(0, len(rows), step):
                some = rows[k : k + step]
                may = may_agree(own[:, some], zone[:, at:until], live[k : k + step]) & (node[at:until] < node[some][:, None])
                for r in np.flatnonzero(may.sum(axis=1) >= LEAST_MARKED).tolist():
                    may[r] &= agree_one_way(columns[:, some[r]], columns[:, at:until], np.flatnonzero(live[k + r]))
                i, j = np.nonzero(may)
                self.meet(start + some[i], start + at + j)
            at, size = until, min(2 * size, MOST_MET)

    def small(self, sizes: np.ndarray, starts: np.ndarray) -> None:
        """All pairs of rows of groups of a size up to PAIRED."""
        size_of, start_of = np.repeat(sizes, sizes), np.repeat(starts, sizes)
        at = np.arange(len(size_of)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        back = at - start_of  # rows before this one in its group
        for first in range(0, len(at), PAIRS_AT_ONCE // 8):
            rows, n = at[first : first + PAIRS_AT_ONCE // 8], back[first : first + PAIRS_AT_ONCE // 8]
            i = np.repeat(rows, n)
            j = np.repeat(rows - n, n) + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            less = self.node[j] < self.node[i]
            self.meet(i[less], j[less])


def stood_for(c: np.ndarray) -> np.ndarray:
    """How far beyond their places the last one is around which the rows of c share what they share around theirs."""
    return np.where((c & IN_RUN) > 0, 0, (c >> BEYOND) & _FAR)


def interval(found: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the windows found of each row, which all hold c and so are one interval."""
    if not len(c):
        return c, c
    low, high = found.argmax(axis=1), SPAN - 1 - found[:, ::-1].argmax(axis=1)
    start = c - SPAN + 1 + low
    return start, start + high - low + SPAN


def spans_of(group: np.ndarray, node: np.ndarray, c: np.ndarray, left: np.ndarray, around: list[bytes]) -> tuple[np.ndarray, pa.RecordBatch] | None:
    """Which rows of whole groups, that come in order of group, node and place, have windows that a text of a lesser number has, and
    SPANS of them. The windows of a row all hold c, so it has one span, with the least of all such texts."""
    again = np.zeros(len(group), dtype=bool)
    again[1:] = (group[1:] == group[:-1]) & (node[1:] == node[:-1]) & (c[1:] == c[:-1])
    first, several = runs_of(group, node)
    keep = several & ~again
    if not keep.any():
        return None
    at = np.flatnonzero(keep)
    group, node, c, left = group[at], node[at], c[at], left[at]
    x, there = laid_out(left, [around[i] for i in at])
    rows = Group(node, x, there, c)
    rows.equal_windows(group)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(group)))
    few = sizes <= PAIRED
    rows.small(sizes[few], starts[few])
    for start, size in zip(starts[~few].tolist(), sizes[~few].tolist(), strict=True):
        rows.large(start, start + size)
    hit = np.flatnonzero(rows.found.any(axis=1))
    if not len(hit):
        return None
    # a row that stands for several places has their spans, each of which reaches the next one's; where the window from a run's first
    # place on is found, so are all that lie inside the run
    place, far = c[hit] & _PLACE, (c[hit] >> BEYOND) & _FAR
    start, end = interval(rows.found[hit], place)
    in_run = ((c[hit] & IN_RUN) > 0) & rows.found[hit, -1]
    end = np.where(in_run, np.maximum(end, place + far + 1), end + stood_for(c[hit]))
    return at[hit], pa.RecordBatch.from_arrays([pa.array(x) for x in (node[hit], node[rows.other[hit]], start, end)], schema=shared.schema_of(SPANS))


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SPANS of the rows of AROUND, which come in order of group, node and place."""
    for table in shared.whole_groups(batches, "group"):
        found = spans_of(*(table.column(c).to_numpy() for c in ("group", "node", "c", "left")), table.column("around").to_pylist())
        if found is not None:
            yield found[1]


def _spans_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SPANS_AT of the rows of IN_BLOCKS, which come in order of group, node and place."""
    schema = shared.schema_of(SPANS_AT)
    for table in shared.whole_groups(batches, "group"):
        found = spans_of(*(table.column(c).to_numpy() for c in ("group", "node", "c", "left")), table.column("around").to_pylist())
        if found is not None:
            rows = (pa.array(table.column(c).to_numpy()[found[0]]) for c in ("key", "c"))
            yield pa.RecordBatch.from_arrays([*found[1].columns, *rows], schema=schema)


def passages(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SPANS of the texts that share passages, and _id, node and n_words of all documents."""
    spark = docs.sparkSession
    shared.ship(spark)
    n = 2 * shared.partitions(spark)
    texts = docs.select(shared.long_id(docs, "doc_id").alias("_id"), docs["text"].cast("string").alias("text"))
    texts = shared.written(texts.mapInArrow(shared.lean(_texts), TEXTS), "texts")
    sequences = texts.where("sequence is not null").select("node", "sequence")

    def looked_up(rows: DataFrame, keys: DataFrame, few: bool, how: str = "inner") -> DataFrame:
        return rows.join(F.broadcast(keys) if few else keys, "key", how)

    def around(rows: DataFrame) -> DataFrame:
        """AROUND of the places; only texts that have any are moved."""
        by_node = rows.groupBy("node").agg(F.collect_set(F.struct("key", "c")).alias("places"))
        ids = rows.select("node").distinct()
        own = sequences.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "node", "left_semi").dropDuplicates(["node"])
        return by_node.join(own, "node").select("node", "places", "sequence").mapInArrow(shared.lean(_around), AROUND)

    rows = texts.where("rows is not null").select("node", "rows").mapInArrow(shared.lean(_dealt), ROWS)
    places = shared.written(rows.repartition(n, "part").sortWithinPartitions("part", "key", "node").mapInArrow(shared.lean(_shared_places), PLACES), "places")
    # a key is large if it has over LARGE rows, so there are few
    large = shared.written(places.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(f"n > {LARGE}"), "large-keys")
    n_large = large.count()
    few = n_large <= BROADCAST_IDS
    usual = around(looked_up(places, large.select("key"), few, "left_anti") if n_large else places)
    spans = shared.written(usual.repartition(n, "group").sortWithinPartitions("group", "node", "c").mapInArrow(shared.lean(_spans), SPANS), "spans")
    if n_large:
        hot = around(looked_up(places, large.select("key"), few)).withColumnRenamed("group", "key")
        blocks = large.select("key", F.ceil(F.col("n") * 2 / LARGE).cast("int").alias("blocks"))
        dealt = looked_up(hot, blocks, few).withColumnRenamed("key", "group").mapInArrow(shared.lean(_blocks), IN_BLOCKS)
        found = shared.written(dealt.repartition(n, "group").sortWithinPartitions("group", "node", "c").mapInArrow(shared.lean(_spans_at), SPANS_AT), "spans-of-blocks")
        found = found.groupBy("key", "node", "c").agg(F.min("pivot").alias("pivot"), F.min("start").alias("start"), F.max("end").alias("end"))
        spans = spans.unionByName(found.select("node", "pivot", "start", "end"))
    return spans, texts.select("_id", "node", "n_words")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word (words of the passage, end exclusive) and other_doc_id, which keeps it, of each passage
    that another document has too. Passages of a document that overlap or touch are one row, with the least of the others."""
    spans, nodes = passages(docs)
    groups = nodes.where(f"n_words >= {MIN_WORDS}").groupBy("node").agg(F.min("_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"))
    first = shared.written(groups, "first")
    own = spans.join(first.select("node", "first_id"), "node").join(first.select(F.col("node").alias("pivot"), F.col("first_id").alias("other_id")), "pivot")
    parts = own.where("first_id <> other_id").select(F.col("first_id").alias("_id"), "node", F.col("start").alias("start_word"), (F.col("end") + WIDTH - 1).alias("end_word"), "other_id").distinct()
    # spans of one text that overlap or touch are one passage; a text has few, so its window is small
    in_order = Window.partitionBy("node").orderBy("start_word", "end_word", "other_id")
    opens = F.col("start_word") > F.max("end_word").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = parts.withColumn("_opens", F.coalesce(opens, F.lit(True)).cast("int")).withColumn("_passage", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = numbered.groupBy("node", "_id", "_passage").agg(F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word"), F.min("other_id").alias("other_id")).drop("node", "_passage")
    copied = first.where("n_copies > 1").select("node", "first_id", "n_copies")
    total = nodes.count()
    copies = shared.join_groups(nodes.where(f"n_words >= {MIN_WORDS}"), copied, "node", "n_copies", total).where("_id > first_id")
    whole = copies.select("_id", F.lit(0).cast("long").alias("start_word"), F.col("n_words").alias("end_word"), F.col("first_id").alias("other_id"))
    null = F.lit(-(2**63))
    named = lambda c: F.when(F.col(c) != null, F.col(c))
    return parts.unionByName(whole).select(named("_id").alias("doc_id"), "start_word", "end_word", named("other_id").alias("other_doc_id"))


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans, and without the white space behind each."""
    import re

    at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out, end = [], 0
    for a, b in sorted(spans):
        start = at[a][0] if a < len(at) else len(text)
        if start > end:
            out.append(text[end:start])
        end = max(end, at[b][0] if b < len(at) else len(text))
    return "".join([*out, text[end:]])


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without the passages that another document keeps, and n_chars after it; a document of which no word is left goes.

    The spans of a document are joined to it: by a broadcast if few documents have any, else by a shuffle.
    """
    spans = repeated_passages(docs).where("doc_id is not null").groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "end_word")).alias("_spans"))
    spans = shared.written(spans.withColumnRenamed("doc_id", "_doc"), "doc-spans")
    few = spans.agg(F.coalesce(F.sum(F.size("_spans")), F.lit(0))).first()[0] <= BROADCAST_IDS // 4
    cut = shared.lean_column(lambda t, s: t if s is None or t is None else without(t, [(x["start_word"], x["end_word"]) for x in s]), "string")
    cut = cut.asNondeterministic()  # else the filter below takes it a second time, in a second worker for each task
    found = spans["_spans"]
    joined = docs.join(F.broadcast(spans) if few else spans, docs["doc_id"].cast("long") == spans["_doc"], "left")
    own = [docs[c] for c in docs.columns]  # by reference: docs may have columns of any name
    changed = joined.where(found.isNotNull()).select(*(cut(docs[c], found).alias(c) if c == "text" else docs[c] for c in docs.columns))
    out = joined.where(found.isNull()).select(*own).unionByName(changed.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
