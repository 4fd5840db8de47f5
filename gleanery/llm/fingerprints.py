"""Document fingerprints: canonical exact digest.

A text's canonical form is its NFKC form, case-folded, with each run of white space as one space and none at the ends. Its
fingerprint is the wide xxhash (128 bits) of that form in UTF-8, in hexadecimal. Documents are grouped by it, and inside
each group of equal digests the canonical bytes are compared; should two forms ever share a digest (chance 2**-128 a pair),
the operator fails and names it, rather than call different documents equal.

Defined cases: a null text is empty; an empty text has the fingerprint of the empty form; documents with the same doc_id
stand in the order of their texts; a null doc_id sorts first; other columns of the input are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import shared

RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
CANONICAL = "digest string, canonical string"
#: Ids that may be broadcast, at 8 bytes each.
BROADCAST_IDS = 1_000_000


def canonical(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        text = unicodedata.normalize("NFKC", text.casefold())
    else:
        text = text.lower()
    return " ".join(text.split())


def digest(form: str) -> str:
    import xxhash

    return xxhash.xxh3_128_hexdigest(form.encode("utf-8", "surrogatepass"))


def fingerprint(text: str) -> str:
    return digest(canonical(text))


def edited(text: str, following: str) -> str:
    """text with its last quarter replaced by as much of the beginning of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def with_next(docs: DataFrame) -> tuple[DataFrame, shared.Ranges]:
    """doc_id, text, bucket, ahead: each range of doc_id in one partition and in order, then (ahead = 1) the first document of the next range.

    The last range is followed by the first document of all. Only the heads of ranges are copied; the driver holds a head
    and a bound for each range.
    """
    spark = docs.sparkSession
    rows = docs.select(shared.long_id(docs, "doc_id").alias("_id"), docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    ids = rows.select("_id")
    n = shared.partitions(spark)
    ranges = shared.Ranges(ids, "_id", n)
    heads = sorted((r["bucket"], r["head"]) for r in ids.groupBy(ranges.of(F.col("_id")).alias("bucket")).agg(F.min("_id").alias("head")).collect())
    before = {heads[i][1]: heads[i - 1][0] for i in range(len(heads))}
    bounds = ranges.bounds

    @F.pandas_udf("array<int>")
    def places(ids):
        """Twice the own bucket, and for a head once more: twice the bucket before, plus one."""
        import numpy as np
        import pandas as pd

        own = np.searchsorted(np.array(bounds, dtype=np.int64), ids.to_numpy(dtype=np.int64), side="right")
        return pd.Series([[2 * int(b), 2 * before[i] + 1] if i in before else [2 * int(b)] for i, b in zip(ids.tolist(), own, strict=True)], dtype=object)

    placed = rows.withColumn("_place", F.explode(places("_id"))).select("_id", "doc_id", "text", (F.col("_place") / 2).cast("int").alias("bucket"), (F.col("_place") % 2).alias("ahead"))
    return placed.repartitionById(len(ranges), F.col("bucket")).sortWithinPartitions("bucket", "ahead", "_id", "text").drop("_id"), ranges


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = shared.schema_of(RESULT)
    before: tuple | None = None  # bucket, doc_id, text, fingerprint
    for batch in shared.slices(batches, "text"):
        rows: list[tuple] = []
        for doc_id, text, bucket, ahead in zip(batch.column("doc_id").to_pylist(), shared.texts_of(batch), batch.column("bucket").to_pylist(), batch.column("ahead").to_pylist(), strict=True):
            own = fingerprint(text)
            if before and before[0] == bucket:
                _, at, then, mark = before
                new = edited(then, text)
                new_mark = fingerprint(new)
                rows.append((at, len(then), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), mark, new_mark, float(mark == new_mark), float(mark == own)))
            before = None if ahead else (bucket, doc_id, text, own)
        yield pa.RecordBatch.from_pydict({f.name: [r[i] for r in rows] for i, f in enumerate(schema)}, schema=schema)


def _canonical_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = shared.schema_of(CANONICAL)
    for batch in shared.slices(batches, "text"):
        forms = [canonical(x) for x in shared.texts_of(batch)]
        yield pa.RecordBatch.from_pydict({"digest": [digest(x) for x in forms], "canonical": forms}, schema=schema)


def colliding(docs: DataFrame, members: DataFrame, n_members: int) -> DataFrame:
    """The digests that stand for two canonical forms or more, after comparing the bytes inside each group.

    members: doc_id of the documents whose digest several have. Only their texts are read again; up to BROADCAST_IDS ids
    are broadcast, so that no text moves before its task has kept the least and greatest form of each digest; beyond that
    the ids are joined by a shuffle. A group of any size is two rows a task.
    """
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    ids = members.select("doc_id").distinct()
    ids = ids.withColumnRenamed("doc_id", "_member")
    chosen = texts.join(F.broadcast(ids) if n_members <= BROADCAST_IDS else ids, texts["doc_id"].eqNullSafe(ids["_member"]), "left_semi")
    forms = chosen.select("text").mapInArrow(_canonical_forms, CANONICAL)
    return forms.groupBy("digest").agg(F.min("canonical").alias("least"), F.max("canonical").alias("greatest")).where("least <> greatest").select("digest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """RESULT for each document, and the smallest doc_id of its group of equal canonical texts and that group's size.

    near_edited and near_next are 1.0 if the fingerprints are equal, else 0.0: an exact digest knows no other likeness.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    ordered, _ = with_next(docs)
    marks = shared.written(ordered.mapInArrow(_fingerprinted, RESULT), "fingerprints")
    groups = marks.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_copies"), F.min("doc_id").alias("first_doc_id")).where("n_copies > 1")
    total = marks.count()
    joined = shared.join_groups(marks, groups, "fingerprint", "n_copies", total)
    members = joined.where("n_copies > 1")
    collisions = [r["digest"] for r in colliding(docs, members, members.count()).limit(1).collect()]
    if collisions:
        raise RuntimeError(f"two canonical texts share the digest {collisions[0]}")
    return joined.select(*marks.columns, F.coalesce("first_doc_id", "doc_id").alias("first_doc_id"), F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"))
