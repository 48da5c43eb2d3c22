"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each with a context tree of its own over the bytes
before it (the last first), down to ``DEPTH`` bytes. A node holds the zeros and ones
that followed its context in the training texts. With KT for the
Krichevsky-Trofimov probability of these counts, a node weighs

    P(node) = KT(node) / 2 + product of P(child) / 2,        P(leaf) = KT(leaf),

and predicts the next bit as w * (n_bit + 1/2) / (n + 1) + (1 - w) * (what the child on the
path predicts), w = KT(node) / 2 / P(node). All of it follows from the counts of
(DEPTH + 1)-byte strings, so training is a count, and the mixture over all depths is
exact. The text is read in lower case (A-Z), with an end mark, starting from end marks.

How it runs: texts are gathered in blocks of some megabytes. A block tells its distinct
strings and words, in packed arrays split by hash; ranges of hashes add up the counts of
all blocks and answer each block with the numbers of just what it holds; a block then
scores its texts. So the model is nowhere whole: no vocabulary is broadcast, and what is
shuffled are a few bytes for each distinct entry of a block. Only the two upper levels
of the trees, at most 256 * 255 nodes, go through the driver. Words are told apart by
64-bit hashes.

Defined results: text null or empty: the end alone. doc_id null: held out, never learned
from. No training text: counts of nothing, base_score from N = V = 0, every bit 1/2. Rows
are kept as they are, repeated ones too; an empty table gives no rows. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, U, Words, mixed, query, sliced, table, written

DEPTH = 5
#: Text bytes of a block, of what is counted at a time, and of the corpus for each range of hashes.
BLOCK_BYTES = 8 << 20
PART_BYTES = 1 << 20
RANGE_BYTES = 4 << 20
END = 0xFF
FOLDS = 10

PACKED = "kind string, block long, bucket long, packed binary"
ANSWER = "kind string, block long, bucket long, packed binary"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def squeezed(*arrays, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(arrays, protocol=5))


def unsqueezed(packed: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(packed))


# --- a block of texts -----------------------------------------------------------------


def strings(texts: list[bytes], depth: int) -> Iterator[np.ndarray]:
    """Per text: a number for each byte and the end, made of the bytes before it (last first) and itself."""
    kind = np.uint32 if depth < 4 else np.uint64
    for text in texts:
        x = np.full(len(text) + depth + 1, END, np.uint8)
        x[depth:-1] = np.frombuffer(text, np.uint8)
        x = x.astype(kind)
        code = x[depth:].copy()
        for back in range(1, depth + 1):
            code |= x[depth - back : len(x) - back] << kind(8 * (depth - back + 1))
        yield code


def parts(texts: list[bytes]) -> Iterator[slice]:
    """Consecutive runs of texts of about ``PART_BYTES``."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= PART_BYTES or k == len(texts) - 1:
            yield slice(start, k + 1)
            start, size = k + 1, 0


class Part:
    """Distinct strings and words of a few texts, and how often each text has them."""

    def __init__(self, texts: list[bytes], depth: int):
        of_text = [np.unique(code, return_counts=True) for code in strings(texts, depth)]
        self.strings, self.string_at, self.string_counts, self.string_text = _joined(of_text)
        large = pa.array(texts, pa.large_binary()).view(pa.large_string())
        words = Words(large, lower=False)
        hashes = words.hashes()
        self.tokens = np.diff(words.first) + 1
        of_text = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(words.first[:-1], words.first[1:])]
        self.words, self.word_at, self.word_counts, self.word_text = _joined(of_text)


def _joined(of_text: list[tuple]) -> tuple:
    keys, at = np.unique(np.concatenate([k for k, _ in of_text]), return_inverse=True)
    text = np.repeat(np.arange(len(of_text)), [len(k) for k, _ in of_text])
    return keys, at, np.concatenate([n for _, n in of_text]), text


def added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of several tables and the sums of their counts."""
    keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in found]), len(keys)).astype(np.uint32)


def block_tables(texts: list[bytes], held: np.ndarray, depth: int) -> tuple[tuple, tuple]:
    """(keys, training counts) of the strings and of the words of a block."""
    found, words = [], []
    for run in parts(texts):
        part, use = Part(texts[run], depth), ~held[run]
        found.append((part.strings, np.bincount(part.string_at, part.string_counts * use[part.string_text], len(part.strings))))
        words.append((part.words, np.bincount(part.word_at, part.word_counts * use[part.word_text], len(part.words))))
    return added(found), added(words)


def string_buckets(keys: np.ndarray, depth: int, ranges: int) -> np.ndarray:
    """Strings with the same two bytes before the decision share a bucket."""
    head = keys >> keys.dtype.type(8 * (depth - 1))
    return (mixed(head.astype(np.uint64)) % U(ranges)).astype(np.int64)


def word_buckets(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> U(32)) * U(ranges) >> U(32)).astype(np.int64)


def _gather(depth: int, ranges: int):
    schema = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("bucket", pa.int64()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, held, texts, size = [], [], [], 0

        def flush():
            (found, by_string), (words, by_word) = block_tables(texts, np.array(held), depth)
            out = [("text", 0, squeezed(ids, held, texts, level=6))]
            bucket = string_buckets(found, depth, ranges)
            order = np.argsort(bucket, kind="stable")
            for kind, buckets, keys, counts in (
                ("string", bucket[order], found[order], by_string[order]),
                ("word", word_buckets(words, ranges), words, by_word),
            ):
                cuts = np.flatnonzero(np.diff(buckets)) + 1
                for a, b in zip([0, *cuts], [*cuts, len(buckets)]):
                    if a < b:
                        out.append((kind, int(buckets[a]), squeezed(np.diff(keys[a:b], prepend=keys.dtype.type(0)), counts[a:b])))
            block_id = task << 24 | number
            kinds, buckets, packed = zip(*out)
            return pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array([block_id] * len(kinds)), pa.array(buckets), pa.array(packed, pa.binary())], schema=schema
            )

        for batch in batches:
            for part in sliced(batch, "text"):
                names = part.schema.get_field_index
                for i, h, t in zip(*(part.column(names(c)).to_pylist() for c in ("doc_id", "held_out", "text"))):
                    ids.append(i)
                    held.append(h)
                    texts.append((t or "").encode().translate(LOWER_BYTES))
                    size += len(texts[-1])
                    if size >= BLOCK_BYTES:
                        yield flush()
                        number, ids, held, texts, size = number + 1, [], [], [], 0
        if texts:
            yield flush()

    return run


# --- counts of all blocks ----------------------------------------------------------------


def _merged(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Keys of a bucket, their training counts over all blocks, and where each block has its own."""
    parts = [unsqueezed(p) for p in group["packed"]]
    keys = [np.cumsum(gaps, dtype=gaps.dtype) for gaps, _ in parts]
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(at, np.concatenate([n for _, n in parts]).astype(np.float64), len(every))
    return every, counts, np.split(at, np.cumsum([len(k) for k in keys])[:-1])


def _answers(kind: str, group: pd.DataFrame, places: list[np.ndarray], values: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {"kind": kind, "block": group["block"], "bucket": group["bucket"], "packed": [squeezed(values[at]) for at in places]}
    )


def _word_answers(group: pd.DataFrame) -> pd.DataFrame:
    """Answers to the blocks, and in a row of its own how many tokens and types the bucket has."""
    _, counts, places = _merged(group)
    answers = _answers("word", group, places, counts.astype(np.int64)).assign(tokens=0, types=0)
    totals = {"kind": "total", "block": -1, "bucket": -1, "packed": b"", "tokens": int(counts.sum()), "types": int((counts > 0).sum())}
    return pd.concat([answers, pd.DataFrame([totals])])


# --- the trees ----------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x > 0 (Stirling's series, shifted by eight)."""
    below = np.zeros_like(x)
    for k in range(8):
        below += np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - below


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def weighted(kt: np.ndarray, below: np.ndarray) -> np.ndarray:
    return np.logaddexp(kt, below) - np.log(2)


def decisions(last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte: its eight nodes (the bits so far, after a one) and the bits decided there."""
    k = np.arange(8)
    byte = last.astype(np.int64)[:, None]
    return (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1


class Level:
    """Nodes of one depth: sorted ids, counts, KT and weighted probabilities (logarithms)."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray, counts: np.ndarray):
        self.ids, at = np.unique(ids, return_inverse=True)
        ones = np.bincount(at, counts * bits, len(self.ids))
        self.n1, self.n0 = ones, np.bincount(at, counts, len(self.ids)) - ones
        self.kt = log_kt(self.n0, self.n1)
        self.pw = self.kt

    def weigh(self, below: "Level") -> None:
        parent = (below.ids >> 16) << 8 | (below.ids & 255)
        product = np.bincount(np.searchsorted(self.ids, parent), below.pw, len(self.ids))
        self.pw = weighted(self.kt, product)

    def own(self) -> np.ndarray:
        """Weight of the node's own estimate."""
        return np.exp(self.kt - np.log(2) - self.pw)

    def chance(self, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
        n = np.where(bits == 1, self.n1[at], self.n0[at])
        return (n + 0.5) / (self.n0[at] + self.n1[at] + 1)


def _levels(every: np.ndarray, counts: np.ndarray, depth: int) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Levels 2 to ``depth`` of a bucket, and nodes and bits of its strings."""
    nodes, bits = decisions((every & every.dtype.type(255)).astype(np.int64))
    context = every.astype(np.int64) >> 8
    levels = []
    for d in range(2, depth + 1):
        ids = (context >> 8 * (depth - d))[:, None] << 8 | nodes
        levels.append(Level(ids.ravel(), bits.ravel(), np.repeat(counts, 8)))
    for upper, lower in zip(levels[-2::-1], levels[:0:-1]):
        upper.weigh(lower)
    return levels, nodes, bits


def _second_level(depth: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        every, counts, _ = _merged(group)
        top = _levels(every, counts, depth)[0][0]
        parent = (top.ids >> 16) << 8 | (top.ids & 255)
        ids, at = np.unique(parent, return_inverse=True)
        sums = {c: np.bincount(at, v, len(ids)) for c, v in (("zeros", top.n0), ("ones", top.n1), ("below", top.pw))}
        return pd.DataFrame({"node": ids, **sums})

    return run


class Upper:
    """Weights and counts of the root and of the first level, for all 256 last bytes."""

    def __init__(self, rows: list):
        n0, n1, below = np.zeros((3, 256, 256))
        for r in rows:
            c, q = divmod(r["node"], 256)
            n0[c, q], n1[c, q], below[c, q] = r["zeros"], r["ones"], r["below"]
        kt = log_kt(n0, n1)
        pw = weighted(kt, below)
        self.n0, self.n1, self.own = n0, n1, np.exp(kt - np.log(2) - pw)
        self.root0, self.root1 = n0.sum(axis=0), n1.sum(axis=0)
        root_kt = log_kt(self.root0, self.root1)
        self.root_own = np.exp(root_kt - np.log(2) - weighted(root_kt, pw.sum(axis=0)))

    def mixed_with(self, last: np.ndarray, nodes: np.ndarray, bits: np.ndarray, below: np.ndarray) -> np.ndarray:
        c = last[:, None]
        n0, n1 = self.n0[c, nodes], self.n1[c, nodes]
        first = (np.where(bits == 1, n1, n0) + 0.5) / (n0 + n1 + 1)
        first = self.own[c, nodes] * first + (1 - self.own[c, nodes]) * below
        n0, n1 = self.root0[nodes], self.root1[nodes]
        root = (np.where(bits == 1, n1, n0) + 0.5) / (n0 + n1 + 1)
        return self.root_own[nodes] * root + (1 - self.root_own[nodes]) * first


def _string_answers(depth: int, upper: Upper):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        every, counts, places = _merged(group)
        levels, nodes, bits = _levels(every, counts, depth)
        context = every.astype(np.int64) >> 8
        chance = None
        for d, level in zip(range(depth, 1, -1), levels[::-1]):
            at = np.searchsorted(level.ids, (context >> 8 * (depth - d))[:, None] << 8 | nodes)
            own = level.chance(at, bits)
            weight = level.own()[at]
            chance = own if chance is None else weight * own + (1 - weight) * chance
        chance = upper.mixed_with(context >> 8 * (depth - 1), nodes, bits, chance)
        return _answers("string", group, places, np.log10(chance).sum(axis=1).astype(np.float32))

    return run


# --- scores --------------------------------------------------------------------------------


def _score(depth: int, ranges: int, tokens: int, types: int, train_texts: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, held, texts = unsqueezed(group.loc[group["kind"] == "text", "packed"].iloc[0])
        (found, _), (words, _) = block_tables(texts, np.array(held), depth)
        told = {
            kind: np.concatenate([unsqueezed(p)[0] for p in rows.sort_values("bucket")["packed"]])
            for kind, rows in group[group["kind"] != "text"].groupby("kind")
        }
        log_chance = np.empty(len(found))
        log_chance[np.argsort(string_buckets(found, depth, ranges), kind="stable")] = told["string"]
        seen = told.get("word", np.zeros(0, np.int64))
        score, known, base, n_tokens = [], [], [], []
        for run in parts(texts):
            part = Part(texts[run], depth)
            n = len(part.tokens)
            value = log_chance[np.searchsorted(found, part.strings)][part.string_at]
            score.append(np.bincount(part.string_text, value * part.string_counts, n))
            count = seen[np.searchsorted(words, part.words)][part.word_at] if len(words) else np.zeros(0)
            known.append(np.bincount(part.word_text, part.word_counts * (count > 0), n).astype(np.int64))
            base.append(np.bincount(part.word_text, part.word_counts * np.log10(count + 0.1), n))
            n_tokens.append(part.tokens)
        score, known, base, n_tokens = map(np.concatenate, (score, known, base, n_tokens))
        base = base + np.log10(train_texts + 0.1) - n_tokens * np.log10(tokens + 0.1 * (types + 1))
        return pd.DataFrame({
            "doc_id": pd.array(ids, "Int64"), "held_out": held, "n_tokens": n_tokens,
            "n_known": known + (train_texts > 0), "train_tokens": tokens, "base_score": base, "score": score,
        })

    return run


def context_tree_scores(documents: DataFrame, held_out: F.Column, depth: int = DEPTH) -> DataFrame:
    """Per row: base and model scores, learned from the rows for which ``held_out`` is false."""
    rows = documents.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "text")
    totals = rows.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).first()
    ranges, train_texts = 1 + (totals[0] or 0) // RANGE_BYTES, totals[1]
    gathered = written(rows.mapInArrow(_gather(depth, ranges), PACKED), by="kind")
    words, found = gathered.where("kind = 'word'"), gathered.where("kind = 'string'")

    counted = written(words.groupBy("bucket").applyInPandas(_word_answers, ANSWER + ", tokens long, types long"), by="kind")
    tokens, types = (int(v or 0) for v in counted.where("kind = 'total'").agg(F.sum("tokens"), F.sum("types")).first())
    nodes = found.groupBy("bucket").applyInPandas(_second_level(depth), "node long, zeros double, ones double, below double")
    nodes = nodes.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below"))
    upper = Upper(nodes.collect())

    told = counted.where("kind = 'word'").select("kind", "block", "bucket", "packed").union(
        found.groupBy("bucket").applyInPandas(_string_answers(depth, upper), ANSWER)
    )
    texts = gathered.where("kind = 'text'").select("kind", "block", "bucket", "packed")
    score = _score(depth, ranges, tokens + train_texts, types + (train_texts > 0), train_texts)
    return told.union(texts).groupBy("block").applyInPandas(score, SCORES)


@query("op9_context_tree")
def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0
    return context_tree_scores(table(spark, sf_dir, "documents"), held_out)
