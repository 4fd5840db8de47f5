"""N-gram Jaccard join: size-aware, heavy and light.

Two documents link when their sets of 5-word shingles have a Jaccard similarity of 75 % or more. Equal sets are one node.

Shingles have one order for all sets: frequent ones last, else by their number. A set of a shingles shares at least
o = ceil(0.75 a) with any set it links to, so both share a shingle among their first a - o + 1, and two among their first
a - o + 2. Small sets (light) enumerate the subsets of two of that longer prefix; a pair of small sets meets at such a
subset. Large sets (heavy) are found by scanning the inverted lists of single shingles of the prefix, in which small sets
that are large enough to link to a large one stand too. The boundary is where the estimated number of rows is least, given
how many sets have each size and how long the lists are.

Before the shingles of a pair are compared, parity bitmaps are: each bit of a set's is the parity of the shingles that fall
on it, and two sets differ in at least as many shingles as their bitmaps, folded to one length, differ in bits. A pair whose
bitmaps differ in more than linked sets may differ in doesn't link; only what is left needs the texts again.

The rows of a key never become all their pairs. First each is checked against the key's least set only; linked sets are
one component from then on. Only keys whose sets are of several components are looked at again: the sets of such a key, or,
where it has over BLOCK, of each two of the blocks that it is dealt into, meet inside a task, which tests sizes, components
and bitmaps and gives out only pairs that may link. Before that, a set meets its likest partner alone at one in SOME of these keys,
so that sets with many links are one component by then. Every link thus joins sets that are found connected, so components
are exact.

Frequent shingles are counted over all documents: a task counts its own and hands on, every two million, what it has seen twice,
so a count is too low by one for each such part; the FREQUENT most frequent ones are known to all tasks. They change which
candidates are looked at, never which pairs link.

Defined cases: a null or empty text, or one of white space, has an empty set, links with nothing and is its own component;
rows with one doc_id are one document that has the links of each; a null doc_id sorts first and has a null component if
it is the least; other columns are ignored; an empty table gives an empty result; texts of any length are taken whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import shared
from gleanery.llm.components import components
from gleanery.llm.shingles import mixed, shingle_sets

RESULT_COLUMNS = ("doc_id", "n_shingles", "component_id")
NUM, DEN = 75, 100
#: Frequent shingles that all tasks know, at 8 bytes each, and the count from which a shingle is one.
FREQUENT, LEAST_COUNT = 1 << 19, 16
#: Bits of a set's parity bitmap: a power of two from LEAST_MARK on, about four for each shingle.
LEAST_MARK = 2048
#: Largest size up to which sets may be small.
MOST_SMALL = 64
#: Ids that may be broadcast.
BROADCAST_IDS = 1_000_000
#: Distinct sets that a task remembers so as not to emit a copy's keys again.
REMEMBERED = 100_000
#: Shingles that a task counts at a time.
COUNTED = 1 << 21
#: Sets of a key that meet in one task.
BLOCK = 1 << 11
#: Sets of a key whose pairs are listed at once, together with those of other keys; larger keys go set by set.
FEW = 32
#: One in so many keys is looked at first, for the likest partners.
SOME = 8
#: Times that bitmaps are folded for these meetings; the pairs that are given out are looked at by whole bitmaps again.
FOLDS = 1
LEAST_FOLDED = LEAST_MARK >> FOLDS
SURVEY = "size long, shingle long, times long"
SETS = "_id long, node long, n_shingles long, mark binary, keys binary"
KEYS = "part long, key long, node long, pivot long"
RUNS = "key long, node long, pivot long"
MEMBERS = "group long, node long, n long, component long, mark binary"
PAIRS = "u long, v long"


def overlap(a: np.ndarray | int):
    """The least number of shingles that a set of a shares with one it links to."""
    return -(-NUM * a // DEN)


def node_of(shingles: np.ndarray) -> int:
    """The number of a set; equal sets have the same."""
    import xxhash

    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def mark_of(shingles: np.ndarray) -> bytes:
    """The parity bitmap of a set."""
    bits = max(LEAST_MARK, 1 << (4 * len(shingles) - 1).bit_length())
    at = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1).tobytes()


def folded(mark: bytes, times: int = FOLDS) -> bytes:
    """The bitmap folded to half its length so many times."""
    bits = np.frombuffer(mark, np.uint8)
    for _ in range(times):
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits.tobytes()


def marks_apart(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ, the longer one folded to the length of the other."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count((a ^ b).view(np.uint64)).sum())


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common > 0 and DEN * common >= NUM * (len(x) + len(y) - common)


def ordered_prefix(shingles: np.ndarray, frequent: np.ndarray, n: int) -> np.ndarray:
    """The first n of a set's shingles: those that aren't frequent, then those that are, each ascending."""
    if not len(frequent):
        return shingles[:n]
    at = np.searchsorted(frequent, shingles)
    often = frequent[np.minimum(at, len(frequent) - 1)] == shingles
    return np.concatenate([shingles[~often], shingles[often]])[:n]


def keys_of(shingles: np.ndarray, frequent: np.ndarray, small: int) -> np.ndarray:
    """The keys at which a set meets the ones it links to."""
    a = len(shingles)
    if a < 3:  # a set of one or two links only to an equal one
        return np.zeros(0, dtype=np.uint64)
    p = a - overlap(a) + 1
    prefix = ordered_prefix(shingles, frequent, p + 1)
    out = []
    if a <= small:
        i, j = np.triu_indices(len(prefix), 1)
        low, high = np.minimum(prefix[i], prefix[j]), np.maximum(prefix[i], prefix[j])
        out.append(mixed(mixed(low) + high))
    if a > small or DEN * a >= NUM * (small + 1):
        out.append(mixed(prefix[:p]))
    return np.concatenate(out)


def boundary(sizes: dict[int, int], list_length: float) -> int:
    """The largest small size, by cost: a row for each key, and for a single shingle what its list makes one scan."""
    def rows(small: int) -> float:
        cost = 0.0
        for a, n in sizes.items():
            p = a - overlap(a) + 1
            if a <= small:
                cost += n * p * (p + 1) / 2
            if a > small or DEN * a >= NUM * (small + 1):
                cost += n * p * list_length
        return cost

    return min(range(2, MOST_SMALL + 1), key=rows)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's counts of shingles, and of sets by size; what its lists make in scans (the sum of squares) under size -1, and their
    rows under size -2."""
    schema = shared.schema_of(SURVEY)
    sizes: Counter[int] = Counter()

    def counts(held: np.ndarray) -> pa.RecordBatch:
        held.sort()
        first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
        times = np.diff(np.append(first, len(held)))
        sizes[-1] += int((times**2).sum())
        sizes[-2] += len(held)
        twice = np.flatnonzero(times > 1)
        return pa.RecordBatch.from_arrays([pa.nulls(len(twice), pa.int64()), pa.array(held[first[twice]].view(np.int64)), pa.array(times[twice])], schema=schema)

    held, size = np.empty(COUNTED, dtype=np.uint64), 0
    for batch in shared.slices(batches, "text", most=1 << 20):
        for shingles in shingle_sets(shared.texts_of(batch)):
            sizes[len(shingles)] += 1
            start = 0
            while start < len(shingles):
                part = shingles[start : start + COUNTED - size]
                held[size : size + len(part)] = part
                start, size = start + len(part), size + len(part)
                if size == COUNTED:
                    yield counts(held)
                    size = 0
    if size:
        yield counts(held[:size])
    if sizes:
        yield pa.RecordBatch.from_arrays([pa.array(sizes.keys(), pa.int64()), pa.nulls(len(sizes), pa.int64()), pa.array(sizes.values(), pa.int64())], schema=schema)


def _keyed(frequent: np.ndarray, small: int):
    """SETS of the documents; bitmap and keys of sets that the task has not had."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, seen = shared.schema_of(SETS), set()
        for batch in shared.slices(batches, "text", most=1 << 20):
            rows = []
            for id_, shingles in zip(batch.column("_id").to_pylist(), shingle_sets(shared.texts_of(batch)), strict=True):
                node = node_of(shingles) if len(shingles) else None
                new = len(shingles) > 2 and node not in seen
                if new and len(seen) < REMEMBERED:
                    seen.add(node)
                rows.append((id_, node, len(shingles), *((mark_of(shingles), keys_of(shingles, frequent, small).tobytes()) if new else (None, None))))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return keyed


def combined(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    """KEYS of the rows of a batch, combined before they are moved: a key's least node goes to the key's task, and the other
    rows, which have that node as their pivot already, anywhere. A hot key is then a row a batch in its task."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    lead = np.flatnonzero(first)[np.cumsum(first) - 1]
    part = np.where(first, keys, mixed(keys + mixed(nodes.view(np.uint64))))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (part.view(np.int64), keys.view(np.int64), nodes, nodes[lead])], schema=shared.schema_of(KEYS))


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 2048):
            part = batch.slice(start, 2048)
            held = part.column("keys").to_pylist()
            lengths = [len(x) // 8 for x in held]
            if sum(lengths):
                yield combined(np.frombuffer(b"".join(held), np.uint64), np.repeat(part.column("node").to_numpy(), lengths))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of part and node, those whose key has several nodes, with the key's least node, or with the pivot that they
    came with; holds the last key's rows between batches, a row a batch at most."""
    schema = shared.schema_of(RUNS)
    held = [np.zeros(0, dtype=np.int64)] * 2

    def told(key: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        keep = np.ones(len(key), dtype=bool)
        keep[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node = key[keep], node[keep]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        lengths = np.diff(np.append(starts, len(key)))
        several = np.repeat(lengths > 1, lengths)
        if several.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[several]) for x in (key, node, np.repeat(node[starts], lengths))], schema=schema)

    for batch in batches:
        key, node, came = (batch.column(c).to_numpy() for c in ("key", "node", "pivot"))
        star = node != came
        if star.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[star]) for x in (key, node, came)], schema=schema)
        key, node = (np.concatenate(x) for x in zip(held, (key[~star], node[~star]), strict=True))
        if not len(key):
            continue
        others = np.flatnonzero(key != key[-1])
        cut = int(others[-1]) + 1 if len(others) else 0
        held = [key[cut:], node[cut:]]
        if cut:
            yield from told(key[:cut], node[:cut])
    if len(held[0]):
        yield from told(*held)


def _maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose bitmaps leave it open whether they link."""
    schema = shared.schema_of(PAIRS)
    for batch in batches:
        sizes = (batch.column("n_u").to_numpy() + batch.column("n_v").to_numpy()).tolist()
        marks = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), sizes, strict=True)
        keep = pa.array([marks_apart(x, y) * (NUM + DEN) <= n * (DEN - NUM) for x, y, n in marks], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("u", "v")], schema=schema)


def groups_of(key: int, node: int, blocks: int) -> list[int]:
    """The groups of a set whose key is dealt into blocks: one for its block with each other, and one with itself."""
    own = int(mixed(np.array([node]).view(np.uint64))[0] % np.uint64(blocks))
    pairs = np.array([min(own, b) * blocks + max(own, b) + 1 for b in range(blocks)], dtype=np.uint64)
    return mixed(np.array([key]).view(np.uint64) + mixed(pairs)).view(np.int64).tolist()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """MEMBERS: each set in each group of each of its keys."""
    schema = shared.schema_of(MEMBERS)
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            lengths = np.diff(batch.column("keys").offsets.to_numpy())
            key, blocks = (batch.column("keys").flatten().field(c).to_numpy() for c in ("key", "blocks"))
            row = np.repeat(np.arange(batch.num_rows), lengths)
            group = [key[blocks == 1]]
            rows = [row[blocks == 1]]
            node = batch.column("node").to_numpy()
            for k in np.flatnonzero(blocks > 1).tolist():
                group.append(np.array(groups_of(int(key[k]), int(node[row[k]]), int(blocks[k])), dtype=np.int64))
                rows.append(np.full(len(group[-1]), row[k]))
            group, taken = np.concatenate(group), pa.array(np.concatenate(rows))
            marks = pa.array([folded(m) for m in batch.column("mark").to_pylist()], pa.binary())
            columns = [pa.array(group), *(batch.column(c).take(taken) for c in ("node", "n", "component")), marks.take(taken)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def pairs_of(node: np.ndarray, n: np.ndarray, component: np.ndarray, marks: list[bytes], likest: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets of one group, which come in order of size, that are of different components and may link, by sizes and bitmaps.
    likest: of each set with smaller ones of a length of bitmap, only the pair that is."""
    lengths = np.array([len(m) for m in marks])
    of_length = {int(k): np.frombuffer(b"".join(m for m in marks if len(m) == k), np.uint64).reshape(-1, k // 8) for k in np.unique(lengths)}
    at_length = {k: np.flatnonzero(lengths == k) for k in of_length}
    least = overlap(n)  # what a set must have at least to link to one of n
    for i in range(1, len(node)):
        low = int(np.searchsorted(n[:i], least[i]))
        if low == i or (component[low:i] == component[i]).all():
            continue
        mark = np.frombuffer(marks[i], np.uint8)
        for k in sorted(of_length, reverse=True):
            at = at_length[k]
            a, b = np.searchsorted(at, (low, i))
            if a == b:
                continue
            while len(mark) > k:
                mark = mark[: len(mark) // 2] ^ mark[len(mark) // 2 :]
            apart = np.bitwise_count(of_length[k][a:b] ^ mark.view(np.uint64)).sum(axis=1, dtype=np.int64)
            others = at[a:b]
            may = (apart * (NUM + DEN) <= (n[others] + n[i]) * (DEN - NUM)) & (component[others] != component[i])
            like = others[may]
            if len(like):
                like = like[[np.argmin(apart[may])]] if likest else like
                yield np.full(len(like), node[i]), node[like]


def pairs_within(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row of groups of rows with each row before it in its group."""
    rows = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    before = rows - np.repeat(starts, sizes)
    i = np.repeat(rows, before)
    return i, np.repeat(rows - before, before) + np.arange(len(i)) - np.repeat(np.cumsum(before) - before, before)


def _met(likest: bool):
    """PAIRS of the groups, which come in order of group and size; a group, of two blocks at most, is held between batches. likest: of
    each set only the likest pair that a table of groups shows."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = shared.schema_of(PAIRS)
        for table in shared.whole_groups(batches, "group"):
            group, node, n, component = (table.column(c).to_numpy() for c in ("group", "node", "n", "component"))
            marks = table.column("mark").to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            ends = np.append(starts[1:], len(group))
            few = ends - starts <= FEW
            i, j = pairs_within(starts[few], (ends - starts)[few])
            may = (component[i] != component[j]) & (np.minimum(n[i], n[j]) * DEN >= np.maximum(n[i], n[j]) * NUM)
            i, j = i[may], j[may]
            u, v = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
            order = np.lexsort((v, u))  # a pair may meet at many keys
            order = order[np.concatenate([[True], (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])])] if len(order) else order
            i, j, u, v = i[order], j[order], u[order], v[order]
            apart = bits_apart(marks, i, j)
            like = np.flatnonzero(apart * (NUM + DEN) <= (n[i] + n[j]) * (DEN - NUM))
            if likest and len(like):
                like = like[np.lexsort((apart[like], u[like]))]
                like = like[np.concatenate([[True], u[like][1:] != u[like][:-1]])]
            if len(like):
                yield pa.RecordBatch.from_arrays([pa.array(u[like]), pa.array(v[like])], schema=schema)
            for a, b in zip(starts[~few].tolist(), ends[~few].tolist(), strict=True):
                if (component[a:b] != component[a]).any():
                    new = a + np.flatnonzero(np.concatenate([[True], node[a + 1 : b] != node[a : b - 1]]))
                    for x, y in pairs_of(node[new], n[new], component[new], [marks[k] for k in new], likest):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], schema=schema)

    return met


def bits_apart(marks: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which the folded bitmaps of each pair differ; those of the usual length all at once."""
    lengths = np.array([len(m) for m in marks])
    usual = lengths == LEAST_FOLDED // 8
    rows = np.zeros((len(marks), LEAST_FOLDED // 64), dtype=np.uint64)
    rows[usual] = np.frombuffer(b"".join(m for m in marks if len(m) == LEAST_FOLDED // 8), np.uint64).reshape(-1, LEAST_FOLDED // 64)
    out = np.zeros(len(i), dtype=np.int64)
    both = usual[i] & usual[j]
    for start in range(0, len(i), 1 << 14):
        part = start + np.flatnonzero(both[start : start + (1 << 14)])
        out[part] = np.bitwise_count(rows[i[part]] ^ rows[j[part]]).sum(axis=1, dtype=np.int64)
    for k in np.flatnonzero(~both).tolist():
        out[k] = marks_apart(marks[i[k]], marks[j[k]])
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = shared.schema_of(PAIRS)
    for batch in batches:
        x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
        good = [i for i in range(len(x)) if linked(np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64))]
        if good:
            yield pa.RecordBatch.from_arrays([batch.column("u").take(pa.array(good)), batch.column("v").take(pa.array(good))], schema=schema)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = shared.schema_of("node long, shingles binary")
    for batch in shared.slices(batches, "text", most=1 << 20):
        sets = [s for s in shingle_sets(shared.texts_of(batch)) if len(s)]
        yield pa.RecordBatch.from_pydict({"node": [node_of(s) for s in sets], "shingles": [s.tobytes() for s in sets]}, schema=schema)


def verified(texts: DataFrame, first: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) that link. first: node, size and bitmap of each set and the _id of a document with it; only the texts of
    pairs that the bitmaps leave open are read again."""
    a, b = first.alias("a"), first.alias("b")  # the same rows by the same key, so that they are moved once
    marked = pairs.join(a, F.col("u") == F.col("a.node")).join(b, F.col("v") == F.col("b.node")).where(near("a.n_shingles", "b.n_shingles"))
    marked = marked.select("u", "v", F.col("a.n_shingles").alias("n_u"), F.col("b.n_shingles").alias("n_v"), F.col("a.mark").alias("x"), F.col("b.mark").alias("y"))
    pairs = shared.written(marked.mapInArrow(shared.lean(_maybe), PAIRS), "maybe")
    nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    ids = shared.written(first.join(nodes, "node", "left_semi").select("_id").distinct(), "verify-ids")
    chosen = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "_id", "left_semi")
    sets = shared.written(chosen.select("text").mapInArrow(shared.lean(_sets), "node long, shingles binary"), "verify-sets")
    a, b = sets.alias("a"), sets.alias("b")
    both = pairs.join(a, F.col("u") == F.col("a.node")).join(b, F.col("v") == F.col("b.node"))
    both = both.select("u", "v", F.col("a.shingles").alias("x"), F.col("b.shingles").alias("y"))
    return shared.written(both.mapInArrow(shared.lean(_verified), PAIRS), "links")


def bounded(rows: DataFrame) -> DataFrame:
    """rows of two or three numbers, to be broadcast if they are BROADCAST_IDS at most, else to be joined by a shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def near(n: str, m: str) -> str:
    """Sizes that two linked sets may have."""
    return f"least({n}, {m}) * {DEN} >= greatest({n}, {m}) * {NUM}"


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each document."""
    spark = docs.sparkSession
    shared.ship(spark)
    n_parts = 2 * shared.partitions(spark)
    texts = docs.select(shared.long_id(docs, "doc_id").alias("_id"), docs["text"].cast("string").alias("text"))
    survey = shared.written(texts.select("text").mapInArrow(shared.lean(_survey), SURVEY), "survey")
    counted = survey.where("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times")).where(f"times >= {LEAST_COUNT}")
    most = counted.orderBy(F.desc("times"), "shingle").limit(FREQUENT).select("shingle").toArrow()
    frequent = np.sort(most.column("shingle").to_numpy().view(np.uint64))
    sizes = {r["size"]: r["times"] for r in survey.where(f"shingle is null and (size < 0 or size between 3 and {MOST_SMALL * DEN // NUM})").groupBy("size").agg(F.sum("times").alias("times")).collect()}
    small = boundary({a: n for a, n in sizes.items() if a > 0}, sizes.get(-1, 1) / max(1, sizes.get(-2, 1)))

    sets = shared.written(texts.mapInArrow(shared.lean(_keyed(frequent, small)), SETS), "sets")
    keys = sets.where("length(keys) > 0").select("node", "keys").mapInArrow(shared.lean(_dealt), KEYS)
    runs = shared.written(keys.repartition(n_parts, "part").sortWithinPartitions("part", "node").mapInArrow(shared.lean(_runs), RUNS), "runs")
    # a pivot that is the only row of its key's task has no row of its own: all rows of the key have been tied to it before
    nodes = runs.select("node").unionByName(runs.select(F.col("pivot").alias("node"))).distinct()
    nodes = shared.written(nodes, "nodes-in-runs")
    marked = sets.where("keys is not null").join(bounded(nodes), "node", "left_semi").groupBy("node").agg(F.min_by(F.struct("_id", "n_shingles", "mark"), "_id").alias("s"))
    first = shared.written(marked.select("node", "s._id", "s.n_shingles", "s.mark"), "first")

    stars = shared.written(runs.where("node <> pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct(), "stars")
    links = verified(texts, first, stars)
    groups = shared.written(components(links), "groups")

    def met(runs: DataFrame, groups: DataFrame, tested: DataFrame, likest: bool) -> DataFrame:
        """Pairs that may link, of sets of different components that share a key; not those that were tested."""
        # all sets of a key with one pivot have met it; what is left is pairs of the others
        labelled = runs.join(bounded(groups), "node", "left").select("key", "node", "pivot", F.coalesce("component", "node").alias("component"))
        labelled = shared.written(labelled, "labelled")
        other = lambda f, c: f(F.when(F.col("node") != F.col("pivot"), F.col(c)))
        one = F.min("pivot") == F.max("pivot")
        of_keys = labelled.groupBy("key").agg(one.alias("one"), F.min("component").alias("a"), F.max("component").alias("b"), other(F.min, "component").alias("c"), other(F.max, "component").alias("d"), F.count(F.lit(1)).alias("n"))
        open_keys = of_keys.where("a <> b and (not one or c <> d)")
        open_keys = shared.written(open_keys.select("key", "one", F.when(F.col("n") <= 2 * BLOCK, 1).otherwise(F.ceil(F.col("n") / BLOCK)).cast("int").alias("blocks")), "open-keys")
        opened = labelled.join(bounded(open_keys), "key").where("not one or node <> pivot").groupBy("node", "component").agg(F.collect_set(F.struct("key", "blocks")).alias("keys"))
        members = opened.join(first, "node").select("node", F.col("n_shingles").alias("n"), "component", "mark", "keys").mapInArrow(shared.lean(_members), MEMBERS)
        pairs = members.repartition(n_parts, "group").sortWithinPartitions("group", "n", "node").mapInArrow(shared.lean(_met(likest)), PAIRS).distinct()
        return shared.written(pairs.join(tested, ["u", "v"], "left_anti"), "pairs")

    tested = stars.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    for rows, likest in ((runs.where(F.pmod("key", F.lit(SOME)) == 0), True), (runs, False)):
        pairs = met(rows, groups, tested, likest)
        if not pairs.isEmpty():
            links = links.unionByName(verified(texts, first, pairs))
            groups = shared.written(components(links), "groups")
            tested = tested.unionByName(pairs)

    copies = sets.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("n_copies"), F.min("_id").alias("_id"))
    labels = shared.written(copies.join(groups, "node", "left").select("node", "n_copies", "_id", F.coalesce("component", "node").alias("component")), "labels")
    least = labels.groupBy("component").agg(F.min("_id").alias("component_id"))
    by_node = shared.written(labels.select("node", "n_copies", "component").join(least, "component").select("node", "n_copies", "component_id"), "nodes")
    out = shared.join_groups(sets.select("_id", "node", "n_shingles"), by_node, "node", "n_copies", sets.count())
    null = F.lit(-(2**63))
    component = F.coalesce("component_id", "_id")
    return out.select(F.when(F.col("_id") != null, F.col("_id")).alias("doc_id"), "n_shingles", F.when(component != null, component).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the least of its component, with all columns as they are.

    Rows that go are known by doc_id. Their ids are broadcast if they are BROADCAST_IDS at most, else joined by a
    shuffle; rows with a null doc_id stay.
    """
    found = joined(docs).where("doc_id is not null and doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    gone = shared.written(found, "gone")
    few = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti").select(*docs.columns)
