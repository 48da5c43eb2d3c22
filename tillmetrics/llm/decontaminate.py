"""Benchmark decontamination with SimHash over item-sized windows.

Every benchmark item and every window of a document of as many words gets a 64-bit SimHash
of its word pairs. The fingerprints of items are filed by four blocks of 16 bits, under
all values within three bits of the item's block: two fingerprints that differ in at most
15 bits differ in at most three in some block, so a window finds every item within
``RADIUS``. What it finds is compared in full, and counts if the weighted Jaccard
similarity of the five-word shingles (by how often each occurs) is at least ``SIMILARITY``.

Windows that cannot reach that similarity are left out before: with s shingles shared, at
least s + 4 of its words occur in the items at hand. This bound loses nothing.

Items are taken in blocks of about ``ITEMS`` and sent to the tasks; each block is one pass
over all windows of all documents, without a shuffle of text. A document with fewer
words than the item is compared as a whole.

Defined results: text null or empty (document or item): no match. Items with fewer than
five words are not searched for; they cannot be told from ordinary text. Equal items match
under each of their ids. doc_id null or repeated: matches are reported under what it is,
and the pipeline stage judges each row alone. An empty table on either side: no matches.
Other columns, whatever their names, are not read (the stage passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U, Words, mixed, query, sliced, table

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 4, 16
#: Bits by which fingerprints may differ; BLOCKS * (NEAR + 1) - 1.
NEAR = 3
RADIUS = BLOCKS * (NEAR + 1) - 1
#: Items of one pass: so many that their index takes about 50 MB.
ITEMS = 2000
FLAGS = 1 << 20

MATCHES = "doc_id long, item_id long, first_word long, n_words long, similarity double, hamming int"
NEIGHBOURS = np.array(
    [sum(1 << b for b in bits) for k in range(NEAR + 1) for bits in combinations(range(BLOCK_BITS), k)], np.int64
)


def pairs(token: np.ndarray) -> np.ndarray:
    return mixed(token[:-1] * U(0x9E3779B97F4A7C15) + token[1:])


def simhash(rows: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of pair hashes: the majority of each bit."""
    bits = np.unpackbits(np.ascontiguousarray(rows).view(np.uint8).reshape(*rows.shape, 8), axis=2, bitorder="little")
    major = 2 * bits.sum(axis=1, dtype=np.int32) > rows.shape[1]
    return np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()


def block_values(prints: np.ndarray) -> np.ndarray:
    """The four blocks of each fingerprint, with the number of the block above its bits."""
    k = np.arange(BLOCKS)
    cut = (prints[:, None] >> (U(BLOCK_BITS) * k.astype(np.uint64))) & U((1 << BLOCK_BITS) - 1)
    return cut.astype(np.int64) | k << BLOCK_BITS


def shingle_counts(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rolled = np.zeros(len(token) - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * U(0x9E3779B97F4A7C15) + token[k : k + len(rolled)]
    return np.unique(mixed(rolled), return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][at_a], b[1][at_b]).sum())
    return shared / (int(a[1].sum()) + int(b[1].sum()) - shared)


class Items:
    """A block of benchmark items: shingles, fingerprints and, for each size, the index."""

    def __init__(self, rows: list[tuple[int, str]]):
        words = Words(pa.array([text for _, text in rows], pa.string()))
        token = words.hashes()
        self.ids, self.shingles, self.sizes = [], [], {}
        self.vocabulary = [np.zeros(0, np.uint64)]
        prints: dict[int, list] = {}
        for (item_id, _), a, b in zip(rows, words.first[:-1], words.first[1:]):
            if b - a < SHINGLE:
                continue
            prints.setdefault(int(b - a), []).append((len(self.ids), simhash(pairs(token[a:b])[None, :])[0]))
            self.ids.append(item_id)
            self.shingles.append(shingle_counts(token[a:b]))
            self.vocabulary.append(token[a:b])
        self.vocabulary = np.unique(np.concatenate(self.vocabulary))
        self.flags = np.zeros(FLAGS, dtype=bool)
        self.flags[(self.vocabulary & U(FLAGS - 1)).astype(np.int64)] = True
        for size, found in prints.items():
            own = np.array([p for _, p in found], np.uint64)
            number = np.array([n for n, _ in found])
            near = block_values(own)[:, :, None] ^ NEIGHBOURS
            keys, holder = near.ravel(), np.repeat(np.arange(len(own)), BLOCKS * len(NEIGHBOURS))
            order = np.argsort(keys, kind="stable")
            self.sizes[size] = (number, own, keys[order], holder[order])

    def known(self, token: np.ndarray) -> np.ndarray:
        """Which words occur in the items."""
        known = self.flags[(token & U(FLAGS - 1)).astype(np.int64)]
        maybe = np.flatnonzero(known)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.vocabulary, token[maybe]), len(self.vocabulary) - 1)
            known[maybe] = self.vocabulary[at] == token[maybe]
        return known


def least_shared(a: int, b: int) -> int:
    """Least number of shingles that sets of a and b shingles share at the similarity asked for."""
    return int(np.ceil(SIMILARITY * (a + b) / (1 + SIMILARITY) - 1e-9))


def candidates(items: Items, token: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, first word, words, item, differing bits) of the windows that the index finds."""
    if not len(token) or not items.ids:
        return
    run = np.concatenate([[0], np.cumsum(items.known(token))])
    pair = pairs(token) if len(token) > 1 else token[:0]
    words_of = np.diff(first)
    text = np.repeat(np.arange(len(words_of)), words_of)
    for size, index in items.sizes.items():
        inside = np.arange(max(0, len(token) - size + 1))
        enough = run[size:] - run[:-size] >= least_shared(size - 4, size - 4) + 4 if len(inside) else np.zeros(0, bool)
        starts = inside[enough]
        starts = starts[starts + size <= first[text[starts] + 1]]
        groups = [(size, starts)]
        # Texts with fewer words than the item are one window each.
        for n in range(size - 1, SHINGLE - 1, -1):
            if (n - 4) < SIMILARITY * (size - 4):
                break
            at = first[:-1][words_of == n]
            groups.append((n, at[run[at + n] - run[at] >= least_shared(n - 4, size - 4) + 4]))
        for n, at in groups:
            for part in np.array_split(at, 1 + len(at) * n // 100_000):
                if len(part):
                    prints = simhash(pair[part[:, None] + np.arange(n - 1)])
                    for window, item, bits in _near(prints, index):
                        yield int(text[part[window]]), int(part[window]), n, item, bits


def _near(prints: np.ndarray, index: tuple) -> Iterator[tuple[int, int, int]]:
    """(window, item, differing bits) within the radius."""
    number, own, keys, holder = index
    looked = block_values(prints).ravel()
    low, high = np.searchsorted(keys, looked, "left"), np.searchsorted(keys, looked, "right")
    hits = high - low
    if not hits.any():
        return
    window = np.repeat(np.repeat(np.arange(len(prints)), BLOCKS), hits)
    offset = np.arange(hits.sum()) - np.repeat(np.cumsum(hits) - hits, hits)
    found = np.unique(window * len(own) + holder[np.repeat(low, hits) + offset])
    window, item = np.divmod(found, len(own))
    bits = np.bitwise_count(prints[window] ^ own[item])
    for k in np.flatnonzero(bits <= RADIUS):
        yield int(window[k]), int(number[item[k]]), int(bits[k])


def matches(items: Items, texts: pa.Array) -> list[tuple[int, int, int, int, float, int]]:
    """(text, item id, first word in its text, words, similarity, bits): the best window of each text and item."""
    words = Words(texts)
    token, best, known = words.hashes(), {}, {}
    for text, start, n, item, bits in candidates(items, token, words.first):
        if (start, n) not in known:
            known[start, n] = shingle_counts(token[start : start + n])
        similarity = weighted_jaccard(known[start, n], items.shingles[item])
        if similarity >= SIMILARITY:
            row = (-similarity, start - int(words.first[text]), n, bits)
            best[text, item] = min(best.get((text, item), row), row)
    return [(text, items.ids[item], at, n, -minus, bits) for (text, item), (minus, at, n, bits) in sorted(best.items())]


def _report(items: Items):
    schema = pa.schema([(c.split()[0], {"long": pa.int64(), "double": pa.float64(), "int": pa.int32()}[c.split()[1]]) for c in MATCHES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                at = part.schema.get_field_index
                found = matches(items, part.column(at("text")))
                if found:
                    row, *rest = zip(*found)
                    ids = part.column(at("doc_id")).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t.type) for c, t in zip(rest, list(schema)[1:]))], schema=schema)

    return run


def _clean_rows(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                stay = np.ones(len(part), dtype=bool)
                stay[[text for text, *_ in matches(items, part.column(part.schema.get_field_index("text")))]] = False
                yield part.filter(pa.array(stay))

    return run


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of about ``ITEMS`` rows, one after the other."""
    rows = benchmark.select("item_id", "text").where("text is not null").distinct()
    blocks = 1 + rows.count() // ITEMS
    for k in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text")
        yield Items([tuple(r) for r in block.collect()])


def benchmark_matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The best matching window of each document and item, where there is one."""
    found = documents.sparkSession.createDataFrame([], MATCHES)
    for items in item_blocks(benchmark):
        found = found.union(documents.select("doc_id", "text").mapInArrow(_report(items), MATCHES))
    return found


@query("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the pipeline: rows in which no benchmark item is found."""
    for items in item_blocks(table(spark, sf_dir, "benchmark")):
        docs = docs.mapInArrow(_clean_rows(items), docs.schema)
    return docs
