"""Substring deduplication by content-defined chunks under a gear rolling hash.

The bytes of a text are cut after each position where the top bits of a rolling hash
of the last 32 bytes are zero. A cut depends on what stands before it and on nothing
else, so an insertion moves cuts only near itself and a shared passage is cut alike in
every document. Chunks meet by digest; neighbouring chunks that other documents hold
too form repeated passages.

A digest has 64 bits. A passage needs several neighbouring chunks (``PASSAGE`` bytes of
some 32 each), so two chunks that share a digest by chance do not make one.

Defined results: null and empty texts have no chunks. What repeats only inside one
document, or in rows of one doc_id, is not a repeat across documents. Rows with a null doc_id, and different
texts under one doc_id, are texts of their own (told apart by a hash of 64 bits); equal rows
have their passages once. The smallest doc_id
that holds a chunk keeps it; a null doc_id never does and makes nothing repeated. Texts
of any length are read whole, in windows of eight megabytes; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratingloom.llm.common import staged

#: Bytes: no chunk but a document's last is shorter; ``2**CUT_BITS`` more are expected; none is longer.
SHORTEST, CUT_BITS, LONGEST = 16, 4, 2048
#: Bytes that a repeated passage holds at least, in neighbouring chunks: some 25 words. Of a
#: shared passage the chunks inside it match, all but some 16 to 60 bytes at either end.
PASSAGE = 160
WINDOW, MEMORY = 8_000_000, 32

_GEAR = np.frombuffer(hashlib.shake_128(b"gear").digest(1024), "<u4").copy()


def _cut_points(data: bytes):
    """Positions after which the rolling hash allows a cut, window by window."""
    for begin in range(0, len(data), WINDOW):
        lead = min(begin, MEMORY - 1)
        h = _GEAR[np.frombuffer(data, np.uint8, min(WINDOW, len(data) - begin) + lead, begin - lead)]
        # The hash is the sum of gear[byte] << age; each step doubles the ages it covers.
        for age in (1, 2, 4, 8, 16):
            h[age:] += h[:-age] << np.uint32(age)
        hits = np.flatnonzero(h[lead:] < np.uint32(1 << (32 - CUT_BITS))) + 1 + begin
        yield from hits.tolist()


def chunk_spans(data: bytes) -> list[tuple[int, int]]:
    """(start, end) of the chunks of UTF-8 bytes; no character is cut apart."""
    spans, start, end = [], 0, len(data)

    def whole(cut: int) -> int:
        while cut < end and data[cut] & 0xC0 == 0x80:
            cut += 1
        return cut

    for cut in _cut_points(data):
        while cut - start > LONGEST:
            at = whole(start + LONGEST)
            spans.append((start, at))
            start = at
        if cut - start >= SHORTEST:
            at = whole(cut)
            spans.append((start, at))
            start = at
    while start < end:
        at = whole(min(start + LONGEST, end))
        spans.append((start, at))
        start = at
    return spans


def _chunks(batches):
    for batch in batches:
        ids, hashes, texts = batch.column("doc_id"), batch.column("of_text"), batch.column("text").to_pylist()
        rows, digests, starts, lengths, held = [], [], [], [], 0

        def flushed():
            repeated = pa.array(np.repeat(rows, [len(x) for x in starts]))
            columns = [
                ids.take(repeated),
                hashes.take(repeated),
                pa.array(np.concatenate(digests).view(np.int64)),
                pa.array(np.concatenate(starts)),
                pa.array(np.concatenate(lengths)),
            ]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "of_text", "digest", "start", "length"])

        for i, text in enumerate(texts):
            data = (text or "").encode("utf-8", "surrogatepass")
            if not data:
                continue
            spans = chunk_spans(data)
            edges = np.array(spans, np.int64)
            rows.append(i)
            digests.append(np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in spans], np.uint64))
            starts.append(edges[:, 0])
            lengths.append(edges[:, 1] - edges[:, 0])
            held += len(spans)
            if held >= 200_000:
                yield flushed()
                rows, digests, starts, lengths, held = [], [], [], [], 0
        if held:
            yield flushed()


def _of_text() -> Column:
    """What tells the texts of one doc_id apart."""
    return F.xxhash64("text").alias("of_text")


def _passages(docs: DataFrame, least: int) -> DataFrame:
    """Repeated passages with ``cuts``, the chunks in them that this document does not keep."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks = staged(
        docs.select("doc_id", _of_text(), "text").mapInArrow(
            _chunks, f"doc_id {kind}, of_text bigint, digest bigint, start bigint, length bigint"
        ),
        "chunks",
    )
    shared = staged(
        chunks.groupBy("digest")
        .agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"), F.count("*").alias("copies"))
        .filter("first_doc_id <> last")
        .drop("last"),
        "shared-chunks",
    )
    # Equal rows combine before the chunks of a text meet in one task.
    found = chunks.join(shared, "digest").distinct()
    own = W.partitionBy("doc_id", "of_text").orderBy("start")
    joins = F.lag(F.col("start") + F.col("length")).over(own) >= F.col("start")
    elsewhere = ~F.col("doc_id").eqNullSafe(F.col("first_doc_id"))
    return (
        found.withColumn("begins", F.when(joins, 0).otherwise(1))
        .withColumn("passage", F.sum("begins").over(own))
        .groupBy("doc_id", "of_text", "passage")
        .agg(
            F.min("start").alias("start"),
            (F.max(F.col("start") + F.col("length")) - F.min("start")).alias("length"),
            F.count("*").alias("chunks"),
            F.max("copies").alias("copies"),
            F.min("first_doc_id").alias("first_doc_id"),
            (F.count_if(elsewhere) == 0).alias("kept"),
            F.collect_list(F.when(elsewhere, F.struct("start", "length"))).alias("cuts"),
        )
        .filter(F.col("length") >= least)
        .drop("passage")
    )


def repeated_passages(docs: DataFrame, least: int = PASSAGE) -> DataFrame:
    """Passages that other documents hold too, one row for each occurrence.

    doc_id, start and length (bytes of the UTF-8 text), chunks, copies (the most
    occurrences that a chunk of it has), first_doc_id (the smallest document that holds a
    chunk of it), kept (whether this document keeps all of it). Documents without a
    repeated passage have no row.
    """
    return _passages(docs, least).drop("of_text", "cuts")


def without_repeats(docs: DataFrame, least: int = PASSAGE) -> DataFrame:
    """``docs`` without the chunks of repeated passages that a smaller doc_id keeps; the rest stays as it is."""
    spans = (
        _passages(docs, least)
        .filter("NOT kept")
        .groupBy(F.col("doc_id").alias("of"), F.col("of_text").alias("cut_text"))
        .agg(F.array_distinct(F.sort_array(F.flatten(F.collect_list("cuts")))).alias("cuts"))
    )
    same = (F.col("of_text") == F.col("cut_text")) & F.col("doc_id").eqNullSafe(F.col("of"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", _of_text(), "text").join(staged(spans, "spans"), same, "left")
    rows = rows.select("row", "text", "cuts")

    def cut(batches):
        for batch in batches:
            texts = []
            for text, cuts in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist(), strict=True):
                if cuts and text:
                    data, kept, at = text.encode("utf-8", "surrogatepass"), [], 0
                    for span in cuts:
                        kept.append(data[at : span["start"]])
                        at = span["start"] + span["length"]
                    text = b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    cut_rows = rows.mapInArrow(cut, rows.select("row", "text").schema)
    return cut_rows.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))
