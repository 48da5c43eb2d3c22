"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Tokens of both sides cover the bytes of a text without gaps. Every token points to the token farthest to
the right among those that overlap it, or, where both sides end together, to the end of its
group. Pointers are then doubled, each to what the one it points to points to, for all tokens of a block
of texts at once, until none changes: each token then holds the last token of its group.

A link is a pair of overlapping tokens. Pairs of ids are counted over the whole corpus:

1. A task aligns blocks of about ``BLOCK_BYTES`` of text and writes, for each block, the figures of its
   documents, their links as numbers of distinct pairs, and those pairs with their counts.
2. Counts are added up per pair, with one row for each pair of a block; the highest count of each
   B id is taken over its pairs, at most one for each id of the other vocabulary.
3. Blocks get the counts of their own pairs back, and sum them up per document.

A pair that stands in every text has one row for each block, so no key is hot; a very long text
is a block of its own.

Defined results: text null or empty, or whose tokens' bytes differ from the text (U+2581 stands for a space in B): no
tokens, zeros, and '' as digest. doc_id null or repeated: one row for each row. Empty table: no
rows. Other columns, whatever their names, are not read. Special tokens' strings are plain text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import query, sliced, table, worker_state, written
from .packing import _byte_names

BLOCK_BYTES = 4 << 20
CACHE_ENTRIES, CACHED_LENGTH = 400_000, 48
NEXT_TO_SPACE = re.compile(r"\s\s")
#: ASCII and Latin letters: text on which both libraries for the A vocabulary split alike; fixed value.
LATIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ſ]*")
#: What stands for a space in B's pieces.
SPACE_MARK = "▁"

BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, bounds binary, pair_no binary, times binary, pairs array<int>, counts array<long>"
)
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class _Kept(dict):
    """What ``make`` gives for a word, kept from text to text; emptied when full, so that its size is bounded."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = value
        return value


class TwoTokenizers:
    """Ids of both vocabularies (16 bits each) and the sizes of their tokens in bytes.

    A splits text at single spaces and line feeds; no piece of B has a space but at its start, or a line feed.
    So where no two spaces meet, ids of a text are those of its words, each with the space before it.
    """

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        names = _byte_names()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        special = {token.content for token in self.a.get_added_tokens_decoder().values()}
        ranks = {bytes(map(names.__getitem__, token)): n for token, n in vocabulary.items() if token not in special}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_size = np.zeros(1 << 16, np.int64)
        self.a_size[list(ranks.values())] = [len(raw) for raw in ranks]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.b_raw = [self._piece(n) for n in range(self.b.get_piece_size())]
        self.b_size = np.zeros(1 << 16, np.int64)
        self.b_size[: len(self.b_raw)] = [len(raw) for raw in self.b_raw]
        self.by_word = not any(b" " in raw.lstrip(b" ") or (b"\n" in raw and raw != b"\n") for raw in self.b_raw)
        self.spaced = _Kept(lambda word: self._entry(" " + word, self._b(word)))
        self.bare = _Kept(lambda word: self._entry(word, self._b("\n" + word)[2:]))
        self.line = self._entry("\n", self._b("\n")[1:])
        #: Decimal ids with a comma, a bar or a semicolon after them.
        self.written = [f"{n}{mark}".encode() for mark in ",|;" for n in range(1 << 16)]

    def _piece(self, n: int) -> bytes:
        if self.b.is_byte(n):
            return bytes([int(self.b.id_to_piece(n)[1:-1], 16)])
        if self.b.is_control(n) or self.b.is_unknown(n):
            return b""
        return self.b.id_to_piece(n).replace(SPACE_MARK, " ").encode()

    def _b(self, text: str) -> list[int]:
        return self.b.encode(text, num_threads=1) if text else [self.b.piece_to_id(SPACE_MARK)]

    def _entry(self, text: str, b_ids: list[int]) -> tuple[bytes, bytes]:
        """Ids of both for a piece of text; no ids where B's bytes are not the text's."""
        if b"".join(map(self.b_raw.__getitem__, b_ids)) != text.encode():
            return b"", b""
        a_ids = self.ranks.encode_ordinary(text) if LATIN.fullmatch(text) else self.a.encode(text, add_special_tokens=False).ids
        return np.array(a_ids, np.uint16).tobytes(), np.array(b_ids, np.uint16).tobytes()

    def ids(self, text: str) -> tuple[bytes, bytes]:
        if not text or SPACE_MARK in text:
            return b"", b""
        if not self.by_word or NEXT_TO_SPACE.search(" " + text):
            return self._entry(" " + text, self._b(text))
        entries = []
        for number, line in enumerate(text.split("\n")):
            first, *words = line.split(" ")
            if number:
                entries.append(self.line)
            if not number:
                entries.append(self.spaced[first])
            elif first:
                entries.append(self.bare[first])
            entries.extend(map(self.spaced.__getitem__, words))
        a_ids, b_ids = zip(*entries)
        if not all(a_ids):
            return b"", b""
        return b"".join(a_ids), b"".join(b_ids)


# --- alignment ---------------------------------------------------------------------------


def last_tokens(a_end: np.ndarray, b_end: np.ndarray, next_b: np.ndarray) -> np.ndarray:
    """For each token of A, then of B: the number of the B token that ends its group.

    a_end, b_end: rising byte offsets where tokens end; the last ones are equal.
    next_b: for each token of A, the B token that holds its last byte.
    """
    n = len(a_end)
    next_a = np.searchsorted(a_end, b_end)
    itself = np.arange(n, n + len(b_end))
    points = np.concatenate([n + next_b, np.where(a_end[next_a] > b_end, next_a, itself)])
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            return points - n
        points = farther


def overlaps(a_end: np.ndarray, b_end: np.ndarray, next_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links per token of A, and the number of the B token of every link."""
    after = next_b + (b_end[next_b] == a_end)  # the B token that holds the byte after an A token
    first = np.concatenate([[0], after[:-1]])
    many = next_b - first + 1
    begin = np.cumsum(many) - many
    return many, np.arange(int(many.sum())) + np.repeat(first - begin, many)


def _align_block(two: TwoTokenizers, block: int, doc_ids: list, ids: list[tuple[bytes, bytes]]) -> tuple:
    docs = len(doc_ids)
    a, b = (np.frombuffer(b"".join(side), np.uint16) for side in zip(*ids))
    n_a, n_b = (np.array([len(s) // 2 for s in side], np.int64) for side in zip(*ids))
    a_end, b_end = np.cumsum(two.a_size[a]), np.cumsum(two.b_size[b])
    next_b = np.searchsorted(b_end, a_end)
    last = last_tokens(a_end, b_end, next_b)
    ends = last[len(a) :] == np.arange(len(b))  # B tokens that end a group
    group = np.cumsum(ends) - 1
    a_group, b_group = group[last[: len(a)]], group[last[len(a) :]]
    a_to, b_to = np.cumsum(n_a), np.cumsum(n_b)
    groups = np.diff(np.concatenate([[0], np.cumsum(ends)])[np.concatenate([[0], b_to])])

    many, link_b = overlaps(a_end, b_end, next_b)
    links = np.diff(np.concatenate([[0], np.cumsum(many)])[np.concatenate([[0], a_to])])
    doc = np.repeat(np.arange(docs, dtype=np.uint64), links)
    pair = np.repeat(a.astype(np.uint64) << np.uint64(16), many) | b[link_b]
    per_doc, times = np.unique((doc << np.uint64(32)) | pair, return_counts=True)
    pairs, pair_no = np.unique((per_doc & np.uint64(0xFFFFFFFF)).astype(np.uint32), return_inverse=True)
    counts = np.bincount(pair_no, weights=times, minlength=len(pairs)).astype(np.int64)
    bounds = np.searchsorted(per_doc >> np.uint64(32), np.arange(docs + 1, dtype=np.uint64))

    # Both sides' tokens by group, A's first; the mark after each tells what follows.
    per_group = np.bincount(a_group, minlength=int(ends.sum())), np.bincount(b_group, minlength=int(ends.sum()))
    a_before, b_before = (np.cumsum(p) - p for p in per_group)
    text = np.empty(len(a) + len(b), np.int64)
    a_mark, b_mark = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_mark[(a_before + per_group[0])[per_group[0] > 0] - 1] = 1
    b_mark[np.flatnonzero(ends)] = 2
    text[np.arange(len(a)) + b_before[a_group]] = a + (a_mark << 16)
    text[np.arange(len(b)) + (a_before + per_group[0])[b_group]] = b + (b_mark << 16)
    digests, start = [], 0
    for many in (n_a + n_b).tolist():
        said = b"".join(map(two.written.__getitem__, text[start : start + many].tolist()))
        digests.append(hashlib.sha256(said[:-1]).hexdigest() if many else "")
        start += many
    return (
        block, doc_ids, n_a.tolist(), n_b.tolist(), groups.tolist(), links.tolist(), digests, bounds.astype(np.int64).tobytes(),
        pair_no.astype(np.uint32).tobytes(), times.astype(np.uint32).tobytes(), pairs.view(np.int32), counts,
    )


def _align(a_file: str, b_file: str, block_bytes: int):
    whole, lists = pa.list_(pa.int64()), pa.list_
    types = [pa.int64(), *[whole] * 5, lists(pa.string()), pa.binary(), pa.binary(), pa.binary(), lists(pa.int32()), whole]
    schema = pa.schema([(c.split()[0], t) for c, t in zip(BLOCKS.split(", "), types)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = worker_state(f"two_tokenizers_{a_file}_{b_file}", lambda: TwoTokenizers(a_file, b_file))
        block = TaskContext.get().partitionId() << 40
        doc_ids, ids, held = [], [], 0

        def out():
            row = _align_block(two, block, doc_ids, ids)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for part in sliced(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    doc_ids.append(doc_id)
                    ids.append(two.ids(text))
                    held += len(text or "") + 1
                    if held >= block_bytes:
                        yield out()
                        block, doc_ids, ids, held = block + 1, [], [], 0
        if doc_ids:
            yield out()

    return run


def _sum_up(blocks: pa.Table, known: pa.Table) -> pa.Table:
    """The rows of one block's documents, given the corpus-wide counts of its pairs."""
    row = {c: blocks.column(c)[0] for c in blocks.column_names}
    # Pairs are numbered in the order of their unsigned values.
    order = np.argsort(known.column("pair").to_numpy().view(np.uint32))
    total, best = known.column("total").to_numpy()[order], known.column("best").to_numpy()[order]
    pair_no, times = (np.frombuffer(row[c].as_py(), np.uint32) for c in ("pair_no", "times"))
    bounds = np.frombuffer(row["bounds"].as_py(), np.int64)
    sums = [np.concatenate([[0], np.cumsum(times * per_pair[pair_no])]) for per_pair in (best.astype(np.int64), total)]
    n_best, count_sum = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
    done = {c: row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(done | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "groups_sha256": row["groups_sha256"].values})


def align(documents: DataFrame, a_file: str, b_file: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: tokens, groups and links of both vocabularies, with corpus-wide counts of its links."""
    blocks = written(documents.select("doc_id", "text").mapInArrow(_align(a_file, b_file, block_bytes), BLOCKS))
    pairs = blocks.select(F.col("block").alias("of"), F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    pairs = pairs.select("of", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("count"))
    totals = pairs.groupBy("pair").agg(F.sum("count").alias("total"))
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFF))
    totals = totals.select("pair", "total", (F.col("total") == F.max("total").over(same_b)).alias("best"))
    known = pairs.select("of", "pair").join(written(totals), "pair")
    return blocks.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_sum_up, ALIGNED)


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return align(documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
