"""BPE encoding and decoding: halves encoded in parallel and concatenated as a tree.

A text of up to ``LEAF_BYTES`` is one leaf. A longer one is normalised and halved, wherever
the middle falls, until every part is a leaf; leaves are rows, dealt over all tasks and encoded
there on their own. Then neighbours are concatenated up the tree. Only what lies around a join
can differ from the encoding of the whole:

- *Words.* The vocabulary's pattern looks at most three characters ahead, or to the end of a
  run. So of the left side all words but the last two stand. From there the text is split anew,
  in a window that grows into the right side until a word starts where the right side has one
  as well; from that word on the right side stands.
- *Tokens.* A new word that covers an old one of either side in part takes the tokens of the
  left side's word and those of the right side's, without the last ``k`` and the first ``k``,
  and encodes the window between them. If the window gives back the outermost token of both
  sides, they agree; else ``k`` doubles. Merges go by rank alone, so a row of tokens is the
  encoding of its text when each pair of neighbours is that of theirs; in the joined row
  every pair of neighbours stands in one of the three encodings. So the result is exact.

A word without any break is cut into leaves like other text, however long it is.

Decoding joins the tokens with single spaces, as the library does for a vocabulary file that names no
decoder, special tokens included.

Defined results: text null or empty: no tokens, digests of no bytes. doc_id null or repeated:
one row for each row. Texts that hold the special tokens' strings get their ids.
Empty table: no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from .common import query, sliced, table, worker_state
from .packing import _byte_names

LEAF_BYTES = 16 << 10
#: Texts are normalised in parts of about so many bytes, cut before an ASCII character.
NORMAL_BYTES = 1 << 20
#: Words and tokens on either side of a join that the first window takes.
FIRST_WORDS, FIRST_TOKENS = 6, 4
#: Words whose tokens a Python worker keeps, and the longest of them.
CACHE_ENTRIES, CACHED_LENGTH = 600_000, 48
SLICE_BYTES = 2 << 20

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
LEAVES = "key long, doc_id long, place long, joined boolean, special int, part binary"
NODES = "key long, doc_id long, place long, joined boolean, special int, part binary, ids binary"
ASCII = re.compile(rb"[\x00-\x7f]")
#: Text of ASCII and precomposed Latin letters, which normal form C leaves as it is, and the
#: vocabulary's pattern on such text in lower case; fixed values.
LATIN = re.compile(r"[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
LATIN_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+|[0-9]"
    r"|[^\x20\x09-\x0da-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+"
)


class _Kept(dict):
    """What ``make`` gives for a word, kept from text to text; emptied when full, so that its size is bounded."""

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries = make, entries

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= self.entries:
                self.clear()
            self[word] = value
        return value


class Codec:
    """A vocabulary of words with an end mark: whole texts, leaves, and their concatenation."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_file(vocabulary)
        self.special = {t.content.encode(): n for n, t in self.whole.get_added_tokens_decoder().items()}
        self.sections = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + b")")
        # The same without normaliser and special tokens, for text that is normalised.
        self.plain = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "added_tokens": []}))
        merges = [tuple(m) for m in spec["model"]["merges"]]
        self.mark = spec["model"]["end_of_word_suffix"]
        self.last = models.BPE(spec["model"]["vocab"], merges, end_of_word_suffix=self.mark)
        self.inner = models.BPE(spec["model"]["vocab"], merges)
        names = {n: t for t, n in self.whole.get_vocab(with_added_tokens=True).items()}
        self.names = [names.get(n, "").encode() for n in range(max(names) + 1)]
        plain = [names.get(n, "") for n in range(max(names) + 1)]
        self.ends = np.array([t.endswith(self.mark) for t in plain])
        #: Bytes of text that a token stands for: its letters, without the end mark.
        self.size = np.array([len(t.removesuffix(self.mark)) for t in plain], np.int64)
        self.letters = {byte: name for name, byte in _byte_names().items()}
        #: (ids, decoded) of words between spaces, as they stand in texts and normalised; ids of the pattern's words.
        self.raw = _Kept(self._raw, CACHE_ENTRIES)
        self.normal = _Kept(self._normal, CACHE_ENTRIES // 4)
        self.tokens = _Kept(lambda name: [t.id for t in self.last.tokenize(name)], CACHE_ENTRIES // 2)

    def spoken(self, ids) -> bytes:
        return b" ".join(map(self.names.__getitem__, ids))

    # --- texts and leaves

    def text(self, text: bytes) -> tuple[bytes, bytes]:
        """(ids, decoded) of a whole text as it is. Words between ASCII spaces do not touch each other."""
        words = text.split()
        if not words:
            return b"", b""
        ids, said = zip(*map(self.raw.__getitem__, words))
        return b"".join(ids), b" ".join(filter(None, said))

    def leaf(self, part: bytes) -> bytes:
        """Ids of a normalised part, taken as a whole text."""
        return b"".join([self.normal[w][0] for w in part.split(b" ") if w])

    def _raw(self, word: bytes) -> tuple[bytes, bytes]:
        text = word.decode()
        if LATIN.fullmatch(text) and not self.sections.search(word):
            return self._entry(self._latin(text.lower()))
        return self._entry(self.whole.encode(text, add_special_tokens=False).ids)

    def _normal(self, word: bytes) -> tuple[bytes, bytes]:
        text = word.decode()
        if LATIN.fullmatch(text):
            return self._entry(self._latin(text))
        return self._entry([n for name, _ in self.plain.pre_tokenizer.pre_tokenize_str(text) for n in self.tokens[name]])

    def _latin(self, text: str) -> list[int]:
        names = LATIN_WORDS.findall(text)
        if not (text.isascii() and text.isprintable()):
            names = [name.encode().decode("latin-1").translate(self.letters) for name in names]
        return [n for name in names for n in self.tokens[name]]

    def _entry(self, ids: list[int]) -> tuple[bytes, bytes]:
        return array("I", ids).tobytes(), self.spoken(ids)

    def cut(self, text: bytes, leaf: int) -> Iterator[tuple[bool, int | None, bytes]]:
        """(whether it continues the part before it, special token, normalised part) of a long text, in order."""
        for section in self.sections.split(text):
            if section in self.special:
                yield False, self.special[section], b""
            elif section:
                normal = b"".join(self._normalised(section))
                for number, part in enumerate(halves(normal, leaf)):
                    yield number > 0, None, part

    def _normalised(self, section: bytes) -> Iterator[bytes]:
        # An ASCII character joins with nothing before it, so normal forms can be cut there.
        start = 0
        while start < len(section):
            found = ASCII.search(section, start + NORMAL_BYTES)
            stop = found.start() if found else len(section)
            yield self.whole.normalizer.normalize_str(section[start:stop].decode()).encode()
            start = stop

    # --- concatenation

    def concatenated(self, nodes: list[tuple[bytes, np.ndarray]]) -> tuple[bytes, np.ndarray]:
        """(text, ids) of neighbouring parts as one text: the two halves first, then their join."""
        while len(nodes) > 1:
            pairs = [self.join(*nodes[k], *nodes[k + 1]) for k in range(0, len(nodes) - 1, 2)]
            nodes = pairs + nodes[len(nodes) - len(nodes) % 2 :]
        return nodes[0]

    def join(self, x: bytes, x_ids: np.ndarray, y: bytes, y_ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        left = self._last_words(x, x_ids, 3)
        if not left or not len(y_ids):
            return x + y, np.concatenate([x_ids, y_ids])
        start, keep = left[0][0], left[0][2]
        many = FIRST_WORDS
        while True:
            right, all_taken = self._first_words(y, y_ids, many)
            stop = len(y) if all_taken else right[-1][1]
            words = self._words(x[start:] + y[:stop], start)
            at = {a + len(x): k for k, (a, _, _, _) in enumerate(right[: len(right) if all_taken else len(right) - 3])}
            meet = next((n for n, (a, _, _) in enumerate(words) if a in at), None)
            if meet is not None:
                resume = right[at[words[meet][0]]][2]
                words = words[:meet]
                break
            if all_taken:
                resume = len(y_ids)
                break
            many *= 2
        before = {a: (b, x_ids[i:j]) for a, b, i, j in left}
        after = {b + len(x): (a + len(x), y_ids[i:j]) for a, b, i, j in right}
        none = (None, x_ids[:0])
        new = [self._word(a, b, name, before.get(a, none), after.get(b, none)) for a, b, name in words]
        return x + y, np.concatenate([x_ids[:keep], *new, y_ids[resume:]])

    def _word(self, start: int, end: int, name: str, x: tuple, y: tuple) -> np.ndarray:
        """Ids of the word at start:end. x: (end, ids) of the left word that starts there, y: (start, ids) of the right one that ends there."""
        x_ids, y_ids = x[1], y[1]
        if x[0] == end:
            return x_ids
        if y[0] == start:
            return y_ids
        x_at = np.concatenate([[0], np.cumsum(self.size[x_ids])])
        if x_at[-1] > end - start:
            x_ids, x_at = x_ids[:0], x_at[:1]
        y_at = end - start - np.cumsum(self.size[y_ids][::-1])[::-1]
        y_ids = y_ids[y_at >= x_at[-1]]
        y_at = np.concatenate([y_at[len(y_at) - len(y_ids) :], [end - start]])
        k = FIRST_TOKENS
        while True:
            i, j = max(0, len(x_ids) - k), min(len(y_ids), k)
            final = j == len(y_ids)
            model = self.last if final else self.inner
            window = np.array([t.id for t in model.tokenize(name[x_at[i] : y_at[j]])], x_ids.dtype)
            if (i == 0 or window[0] == x_ids[i]) and (final or window[-1] == y_ids[j - 1]):
                return np.concatenate([x_ids[:i], window, y_ids[j:]])
            k *= 2

    def _words(self, text: bytes, offset: int) -> list[tuple[int, int, str]]:
        """(start, end, byte-level letters) of the words of normalised text."""
        out, at = [], 0
        for name, _ in self.plain.pre_tokenizer.pre_tokenize_str(text.decode()):
            while text[at] == 0x20:
                at += 1
            out.append((offset + at, offset + at + len(name), name))
            at += len(name)
        return out

    def _last_words(self, text: bytes, ids: np.ndarray, many: int) -> list[tuple[int, int, int, int]]:
        """(start, end, first token, token after) of the last words of an encoded text."""
        stops = np.flatnonzero(self.ends[ids])[-many - 1 :] + 1
        starts = [0, *stops[:-1].tolist()] if len(stops) <= many else stops[:-1].tolist()
        out, at = [], len(text)
        for i, j in zip(starts[::-1], stops.tolist()[::-1]):
            while text[at - 1] == 0x20:
                at -= 1
            end, at = at, at - int(self.size[ids[i:j]].sum())
            out.append((at, end, i, j))
        return out[::-1]

    def _first_words(self, text: bytes, ids: np.ndarray, many: int) -> tuple[list[tuple[int, int, int, int]], bool]:
        """The first words likewise, and whether these are all."""
        out, at, i = [], 0, 0
        stops = np.flatnonzero(self.ends[ids]) + 1
        for j in stops[:many].tolist():
            while text[at] == 0x20:
                at += 1
            start, at = at, at + int(self.size[ids[i:j]].sum())
            out.append((start, at, i, j))
            i = j
        return out, len(stops) <= many


def halves(text: bytes, leaf: int) -> Iterator[bytes]:
    """A UTF-8 text halved, between two characters, until no part is longer than a leaf (7 bytes at least)."""
    if len(text) <= max(leaf, 7):
        yield text
        return
    middle = len(text) // 2
    while text[middle] & 0xC0 == 0x80:
        middle += 1
    yield from halves(text[:middle], leaf)
    yield from halves(text[middle:], leaf)


# --- tasks ----------------------------------------------------------------------------


def _codec(vocabulary: str) -> Codec:
    return worker_state("codec_" + vocabulary, lambda: Codec(vocabulary))


def _whole_texts(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            for part in sliced(batch, "text", SLICE_BYTES):
                texts = pa.compute.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist()
                rows = [
                    (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(said).hexdigest())
                    for ids, said in map(codec.text, texts)
                ]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                )

    return run


def _cut(vocabulary: str, leaf: int):
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("joined", pa.bool_()), ("special", pa.int32()), ("part", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, key = _codec(vocabulary), TaskContext.get().partitionId() << 40
        for batch in batches:
            for row in sliced(batch, "text", SLICE_BYTES):
                out = []
                for doc_id, text in zip(row.column("doc_id").to_pylist(), row.column("text").cast(pa.binary()).to_pylist()):
                    for place, (joined, special, part) in enumerate(codec.cut(text, leaf)):
                        out.append((key, doc_id, place, joined, special, part))
                    key += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _encode_leaves(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            for part in sliced(batch, "part", SLICE_BYTES):
                special = part.column("special").to_pylist()
                ids = [
                    np.array([s], "<u4").tobytes() if s is not None else i
                    for s, i in zip(special, map(codec.leaf, part.column("part").to_pylist()))
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], names=[*part.schema.names, "ids"])

    return run


def _concatenate(vocabulary: str):
    """Rows sorted by key and place; each key's rows give one text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)

        def digest(doc_id, runs):
            ids = np.concatenate([codec.concatenated(run)[1] for run in runs])
            out, said = hashlib.sha256(ids.astype("<u4").tobytes()), hashlib.sha256()
            for k in range(0, len(ids), 1 << 16):
                said.update((b" " if k else b"") + codec.spoken(ids[k : k + (1 << 16)].tolist()))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((doc_id, len(ids), out.hexdigest(), said.hexdigest()), schema)], schema=schema
            )

        now, runs = None, []
        for batch in batches:
            for key, doc_id, joined, part, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "joined", "part", "ids"))):
                if now is not None and now[0] != key:
                    yield digest(now[1], runs)
                    runs = []
                now = key, doc_id
                node = part, np.frombuffer(ids, "<u4")
                if joined:
                    runs[-1].append(node)
                else:
                    runs.append([node])
        if now is not None:
            yield digest(now[1], runs)

    return run


def encode(documents: DataFrame, vocabulary: str, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """Number and digest of the ids of each whole text, and digest of the text decoded from them."""
    texts = documents.select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = texts.where(size <= leaf_bytes).mapInArrow(_whole_texts(vocabulary), ENCODED)
    leaves = texts.where(size > leaf_bytes).mapInArrow(_cut(vocabulary, leaf_bytes), LEAVES)
    # Leaves of one text go to many tasks; all tokens of a text, which came as one row, end as one.
    nodes = leaves.repartition("key", "place").mapInArrow(_encode_leaves(vocabulary), NODES)
    whole = nodes.repartition("key").sortWithinPartitions("key", "place").mapInArrow(_concatenate(vocabulary), ENCODED)
    return short.union(whole)


@query("op12_tree_bpe")
def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
