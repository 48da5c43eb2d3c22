"""Packing: documents, in their order, cut into training sequences by dynamic programming.

The texts of a partition are one stream of tokens, each document closed by a separator.
A sequence is a window of the stream. Cuts fall at document ends, sentence ends or, at
a higher price, inside sentences; of all ways to cut, the one with the least padding
plus truncation penalties is taken. With ``best(j)`` for the cheapest way to cut the
stream before position j,

    best(j) = penalty(j) + min over j - length <= i < j of best(i) + length - (j - i),

and since the bound of i only moves right, a queue of candidates with rising
``best(i) + i`` gives each minimum in constant time. A window whose size is a power of
two needs no padding; these few windows are compared on their own.

The stream is solved in runs of about ``RUN_TOKENS``; the last window of a run is
carried over, so only the last sequence of a partition is left open. Nothing is
shuffled, and a lost task makes the same sequences anew.

Defined results: text null or empty: the separator alone. doc_id null or repeated: kept
as it is; pieces are told apart by sequence and offset. Empty table: no rows. Other
columns, whatever their names, are not read. ``<|endoftext|>`` in a text gets the id
that the tokenizer gives it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from .common import query, sliced, table, worker_state

LENGTH = 1024
SEPARATOR = 0
#: Price of a cut, in tokens of padding.
SENTENCE_CUT = 4
INNER_CUT = 24
#: Inside a sentence, cuts are possible at every so many tokens.
INNER_STEP = 64
#: Windows of these sizes need no padding.
WHOLE = (512, 256, 128, 64)
RUN_TOKENS = 1 << 18
CACHE_ENTRIES = 600_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NEXT_TO_SPACE = re.compile(r"\s\s")


class _Ids(dict):
    """Token ids of a word, as bytes; worked out when first asked for."""

    def __init__(self, encode, before: str):
        super().__init__()
        self.encode, self.before = encode, before

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encode(self.before + word), np.uint16).tobytes()
        self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts, equal to those of the tokenizer file.

    The tokenizer splits at every single space or line feed between words, so where a text
    has no two spaces in a row, its ids are those of its words, which repeat. Ranks of
    the same vocabulary give the ids of a word that is met for the first time.
    """

    def __init__(self, vocabulary: str):
        self.whole = Tokenizer.from_file(vocabulary)
        self.special = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        names, vocabulary = _byte_names(), self.whole.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(names.__getitem__, token)): n for token, n in vocabulary.items() if token not in self.special}
        self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first = _Ids(self.plain.encode_ordinary, "")
        self.later = _Ids(self.plain.encode_ordinary, " ")
        self.line = np.array(self.plain.encode_ordinary("\n"), np.uint16).tobytes()
        ends = {number for raw, number in ranks.items() if re.search(rb"[.!?\n]$", raw)}
        self.ends_sentence = np.zeros(1 << 16, dtype=bool)
        self.ends_sentence[list(ends)] = True

    def ids(self, text: str) -> np.ndarray:
        if any(token in text for token in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint16)
        if NEXT_TO_SPACE.search(text):
            return np.array(self.plain.encode_ordinary(text), np.uint16)
        if len(self.later) + len(self.first) > CACHE_ENTRIES:
            self.later.clear()
            self.first.clear()
        first, later = self.first.__getitem__, self.later.__getitem__
        out = []
        for number, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if number:
                out.append(self.line)
            out.append(first(words[0]))
            out.extend(map(later, words[1:]))
        return np.frombuffer(b"".join(out), np.uint16)


def _byte_names() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others, in order,
    as the characters from 256 on."""
    themselves = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in themselves]
    return {chr(b): b for b in themselves} | {chr(256 + k): b for k, b in enumerate(others)}


def cuts(ends: np.ndarray, sentences: np.ndarray, length: int) -> list[int]:
    """Positions that cut a stream at least cost. ends: of documents; sentences: ends inside them."""
    total = int(ends[-1])
    places = np.unique(np.concatenate([[0], sentences, ends]))
    step = min(INNER_STEP, length)
    gaps = np.diff(places)
    more = (gaps - 1) // step
    wide = more > 0
    inner = np.repeat(places[:-1][wide], more[wide])
    nth = np.arange(len(inner)) - np.repeat(np.cumsum(more[wide]) - more[wide], more[wide]) + 1
    inner = inner + nth * step
    price = np.concatenate([np.full(len(places), SENTENCE_CUT), np.full(len(inner), INNER_CUT)])
    price[: len(places)][np.isin(places, ends)] = 0
    at = np.concatenate([places, inner])
    order = np.argsort(at)
    at, price = at[order].tolist(), price[order].tolist()

    index = {t: k for k, t in enumerate(at)}
    whole = [w for w in WHOLE if w < length]
    best, rank, before = [0] * len(at), [0] * len(at), [0] * len(at)
    queue, head = [0], 0
    for j in range(1, len(at)):
        t = at[j]
        while at[queue[head]] < t - length:
            head += 1
        i = queue[head]
        cost = rank[i] + length - t
        for w in whole:
            k = index.get(t - w)
            if k is not None and best[k] < cost:
                cost, i = best[k], k
        cost += price[j]
        best[j], rank[j], before[j] = cost, cost + t, i
        while len(queue) > head and rank[queue[-1]] >= rank[j]:
            queue.pop()
        queue.append(j)
    out, j = [total], len(at) - 1
    while j:
        j = before[j]
        out.append(at[j])
    return out[::-1]


def _pack(vocabulary: str, length: int):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state("encoder_" + vocabulary, lambda: Encoder(vocabulary))
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []  # (doc_id, ids not yet packed, tokens of the document before them, all its tokens)
        held = 0

        def solve(last: bool) -> pa.RecordBatch:
            nonlocal sequence, waiting, held
            ids = np.concatenate([part for _, part, _, _ in waiting])
            ends = np.cumsum([len(part) for _, part, _, _ in waiting])
            sentences = np.flatnonzero(encoder.ends_sentence[ids]) + 1
            found = cuts(ends, sentences, length)
            if not last and len(found) > 2:
                found.pop()
            rows, k, base = [], 0, 0
            for a, b in zip(found, found[1:]):
                while k < len(waiting) and base < b:
                    doc_id, part, done, all_tokens = waiting[k]
                    x, y = max(a, base), min(b, base + len(part))
                    crc = zlib.crc32(part[x - base : y - base].astype("<u4").tobytes())
                    rows.append((doc_id, done + x - base, y - x, crc, all_tokens, sequence, x - a))
                    if y < base + len(part):
                        break
                    base, k = base + len(part), k + 1
                sequence += 1
            rest = waiting[k:]
            if rest and (cut := found[-1] - base) > 0:
                doc_id, part, done, all_tokens = rest[0]
                rest[0] = (doc_id, part[cut:], done + cut, all_tokens)
            waiting, held = rest, int(ends[-1]) - found[-1]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

        for batch in batches:
            for part in sliced(batch, "text"):
                names, texts = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text"))
                for doc_id, text in zip(names, texts):
                    ids = np.append(encoder.ids(text or ""), np.uint16(SEPARATOR))
                    waiting.append((doc_id, ids, 0, len(ids)))
                    held += len(ids)
                    if held >= RUN_TOKENS:
                        yield solve(last=False)
        if waiting:
            yield solve(last=True)

    return run


def pack(documents: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Pieces of documents with their places in sequences of at most ``length`` tokens."""
    return documents.select("doc_id", "text").mapInArrow(_pack(vocabulary, length), PIECES)


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
