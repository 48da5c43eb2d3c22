"""Substring dedup with content-defined chunks.

A gear hash rolls over the bytes of a text: ``h = (h << 1) + gear[byte]``. Some of its bits,
which depend on the last ``REACH`` bytes alone, say where a chunk ends, so chunks meet
again behind an insertion, wherever a passage stands. What is deduplicated are runs of
``RUN`` consecutive chunks, by digest: single chunks of a few words recur by chance. A
run that occurred before, in another text, is marked; marked chunks that lie together are cut
if they make up at least ``LEAST_BYTES``. The cut begins and ends between words, or between
characters where no space lies within ``TRIM`` bytes. The first text of the table, in its order, that holds a passage keeps it.

How it runs: texts are gathered in blocks. A block tells its digests in packed arrays,
split by hash range; a range compares the digests of all blocks and answers each with one
bit per digest; the block then cuts its texts. No digest set is broadcast, and a digest
that a third of all texts share costs its bits, no more: texts that share it are
never paired.

Defined results: text null: stays null, nothing removed. Rows with equal texts: the first
keeps its text, the later ones lose what is long enough. Repeats inside one text stay. doc_id null
or repeated: rows are told apart by their place. An empty table gives no rows. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IS_SPACE, U, mixed, query, sliced, table, written
from .context_tree import squeezed, unsqueezed

#: A chunk ends where these bits of the gear hash are zero: at one byte in sixteen.
ENDS = np.uint32(0b1111 << 17)
REACH = 21
LEAST_CHUNK = 8
MOST_CHUNK = 256
RUN = 4
LEAST_BYTES = 128
TRIM = 40
BLOCK_BYTES = 8 << 20
RANGE_BYTES = 4 << 20

GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> U(32)).astype(np.uint32)
PACKED = "kind string, block long, bucket long, packed binary"
RESULT = "doc_id long, n_bytes long, bytes_removed long, n_spans int, text string"


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        # h holds the sum of the last ``step`` bytes; twice as many after this.
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    ends = np.flatnonzero((h & ENDS) == 0) + 1
    if len(ends):
        ends = ends[np.diff(ends, prepend=-LEAST_CHUNK) >= LEAST_CHUNK]
    ends = np.unique(np.append(ends, len(data)))
    gaps = np.diff(ends, prepend=0)
    more = (gaps - 1) // MOST_CHUNK
    if more.any():
        start = np.repeat(ends - gaps, more)
        nth = np.arange(len(start)) - np.repeat(np.cumsum(more) - more, more) + 1
        ends = np.sort(np.append(ends, start + nth * MOST_CHUNK))
    return ends


def run_digests(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digests of all runs of ``RUN`` consecutive chunks; one of all chunks, if they are fewer."""
    value = mixed(data.astype(np.uint64) + U(1))
    start = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(data)) - np.repeat(start, ends - start)
    chunk = mixed(np.add.reduceat(mixed(value + place.astype(np.uint64) * U(0x9E3779B97F4A7C15)), start) + (ends - start).astype(np.uint64))
    run = min(RUN, len(chunk))
    digest = np.zeros(len(chunk) - run + 1, np.uint64)
    for k in range(run):
        digest = digest * U(0x9E3779B97F4A7C15) + chunk[k : k + len(digest)]
    return mixed(digest + U(run))


def cut(data: np.ndarray, ends: np.ndarray, seen: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans to remove, given which runs occurred before."""
    run = min(RUN, len(ends))
    change = np.zeros(len(ends) + 1, np.int64)
    at = np.flatnonzero(seen)
    np.add.at(change, at, 1)
    np.add.at(change, at + run, -1)
    marked = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    spans = []
    for first, behind in zip(edges[::2], edges[1::2]):
        a, b = int(ends[first - 1]) if first else 0, int(ends[behind - 1])
        if a:
            near = np.flatnonzero(IS_SPACE[data[a - 1 : min(a + TRIM, b)]])
            if len(near):
                a += int(near[0])
            while a < b and data[a] & 0xC0 == 0x80:
                a += 1
        if b < len(data):
            near = np.flatnonzero(IS_SPACE[data[max(b - TRIM, a) : b + 1]][::-1])
            if len(near):
                b -= int(near[0])
            while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                b -= 1
        if b - a >= LEAST_BYTES:
            spans.append((a, b))
    return spans


def _gather(ranges: int, bits: int):
    schema = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("bucket", pa.int64()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def flush():
            digests, text, order, buckets = _sorted_digests(texts, ranges, bits)
            digests, text = digests[order], text[order]
            rows = [("text", 0, squeezed(ids, texts, level=6))]
            cuts = np.flatnonzero(np.diff(buckets[order])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(order)]):
                if a < b:
                    gaps = np.diff(digests[a:b], prepend=U(0))
                    rows.append(("digest", int(buckets[order[a]]), squeezed(gaps, text[a:b].astype(np.uint32))))
            kinds, at, packed = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array([task << 24 | number] * len(rows)), pa.array(at), pa.array(packed, pa.binary())], schema=schema
            )

        for batch in batches:
            for part in sliced(batch, "text"):
                names = part.schema.get_field_index
                for doc_id, text in zip(part.column(names("doc_id")).to_pylist(), part.column(names("text")).to_pylist()):
                    ids.append(doc_id)
                    texts.append(text)
                    size += len(text or "")
                    if size >= BLOCK_BYTES:
                        yield flush()
                        number, ids, texts, size = number + 1, [], [], 0
        if texts:
            yield flush()

    return run


def _sorted_digests(texts: list, ranges: int, bits: int) -> tuple:
    """Digests of all runs, their texts, the order by digest, and buckets (rising with the digest)."""
    found, sizes = [], []
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        found.append(run_digests(data, chunk_ends(data)) if len(data) else np.zeros(0, np.uint64))
        sizes.append(len(found[-1]))
    digests = np.concatenate(found) >> U(64 - bits)
    return digests, np.repeat(np.arange(len(texts)), sizes), np.argsort(digests, kind="stable"), _bucket(digests, ranges, bits)


def _bucket(digests: np.ndarray, ranges: int, bits: int) -> np.ndarray:
    return ((digests >> U(bits - 24)) * U(ranges) >> U(24)).astype(np.int64)


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """Of one range of digests: for each block, which of its digests an earlier text has."""
    group = group.sort_values("block")
    parts = [unsqueezed(p) for p in group["packed"]]
    digests = np.concatenate([np.cumsum(gaps, dtype=np.uint64) for gaps, _ in parts])
    text = np.concatenate([k << 32 | t.astype(np.int64) for k, (_, t) in enumerate(parts)])
    at = np.unique(digests, return_inverse=True)[1]
    first = np.full(at.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, at, text)
    seen = np.split(text > first[at], np.cumsum([len(t) for _, t in parts])[:-1])
    return pd.DataFrame(
        {"kind": "digest", "block": group["block"], "bucket": group["bucket"], "packed": [squeezed(np.packbits(s), len(s)) for s in seen]}
    )


def _cut_texts(ranges: int, bits: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, texts = unsqueezed(group.loc[group["kind"] == "text", "packed"].iloc[0])
        digests, text, order, _ = _sorted_digests(texts, ranges, bits)
        seen = np.zeros(len(digests), dtype=bool)
        answers = [unsqueezed(p) for p in group[group["kind"] == "digest"].sort_values("bucket")["packed"]]
        if answers:
            seen[order] = np.concatenate([np.unpackbits(p, count=n) for p, n in answers]).astype(bool)
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        out = []
        for k, t in enumerate(texts):
            raw = (t or "").encode()
            mine = seen[bounds[k] : bounds[k + 1]]
            spans = []
            if mine.any():
                data = np.frombuffer(raw, np.uint8)
                spans = cut(data, chunk_ends(data), mine)
            kept, at = [], 0
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            left = b"".join(kept)
            out.append((ids[k], len(raw), len(raw) - len(left), len(spans), None if t is None else left.decode()))
        frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "bytes_removed", "n_spans", "text"])
        return frame.astype({"doc_id": "Int64"})

    return run


def chunk_dedup(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, bytes_removed, n_spans and the text that is left."""
    rows = documents.select("doc_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Four million values for each byte of text, whatever the size: chance repeats stay rare.
    ranges, bits = 1 + size // RANGE_BYTES, min(64, 22 + max(8, int(size).bit_length()))
    gathered = written(rows.mapInArrow(_gather(ranges, bits), PACKED), by="kind")
    answers = gathered.where("kind = 'digest'").groupBy("bucket").applyInPandas(_compare, PACKED)
    texts = gathered.where("kind = 'text'").select("kind", "block", "bucket", "packed")
    return answers.union(texts).groupBy("block").applyInPandas(_cut_texts(ranges, bits), RESULT)


@query("op6_chunk_dedup")
def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup(table(spark, sf_dir, "documents"))
