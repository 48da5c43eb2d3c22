"""Encoding as a tree of halves, against the tokenizers library on whole texts; alignment, against plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, collected, documents
from tillmetrics.llm import alignment, tree_bpe
from tillmetrics.llm.common import QUERIES, table

SF = "/root/testdata/sf0.001"
A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
#: Pieces whose neighbours matter: endings, marks that combine, spaces, special tokens, letters of several scripts.
PIECES = ("a", "re", " ", "  ", "'", "'r", "l", "don", "t", "é", "É", "e", "́", "日本", "語", "한", "ᄀ", "ᅡ", "ᆨ", "12",
          "!!", "#$", "\n", "\t\n", "the", "ing", "ß", "İ", "ŉ", "×", "aaaaaaaa", "abcabc", "'''", "\x1c", "\x85", "\xa0", "<|endoftext|>",
          "<|end", "<|startoftext|>", "text|>", "👍🏽")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def whole(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def mixtures(n):
    rng = random.Random(4)
    for k in range(n):
        pool = PIECES if k % 2 else rng.sample(PIECES, 3)
        yield "".join(rng.choice(pool) for _ in range(rng.randrange(1, 60)))


@pytest.mark.parametrize("leaf", [7, 16, 64])
def test_trees_equal_the_library(library, leaf):
    codec = tree_bpe.Codec(WORDS)
    for text in mixtures(600):
        runs = []
        for joined, special, part in codec.cut(text.encode(), leaf):
            ids = np.array([special], "<u4") if special is not None else np.frombuffer(codec.leaf(part), "<u4")
            assert len(part) <= leaf
            runs[-1].append((part, ids)) if joined else runs.append([(part, ids)])
        ids = [n for run in runs for n in codec.concatenated(run)[1].tolist()]
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_windows_stay_small_in_a_word_without_breaks():
    codec, asked = tree_bpe.Codec(WORDS), []
    text = b"abcabd" * 20_000

    class Inner:
        def tokenize(self, name, of=codec.inner):
            asked.append(len(name))
            return of.tokenize(name)

    nodes = [(part, np.frombuffer(codec.leaf(part), "<u4")) for _, _, part in codec.cut(text, 4096)]
    codec.inner = Inner()
    joined = codec.concatenated(nodes)[1]
    assert joined.tolist() == codec.whole.encode(text.decode(), add_special_tokens=False).ids
    assert len(asked) >= len(nodes) // 2 and max(asked) < 200


@pytest.mark.parametrize("leaf", [40, tree_bpe.LEAF_BYTES])
def test_awkward_texts(spark, library, leaf):
    odd = awkward(spark).union(documents(spark, list(enumerate(mixtures(30), 100)) + [(50, "ab" * 40_000), (51, "语" * 20_000), (50, "x" * 17)]))
    got = collected(tree_bpe.encode(odd, WORDS, leaf))
    assert got == sorted(((r.doc_id, *whole(library, r.text)) for r in odd.collect()), key=repr)
    assert tree_bpe.encode(odd.limit(0), WORDS, leaf).count() == 0


def test_query_equals_the_library(spark, library):
    rows = table(spark, SF, "documents").collect()
    got = collected(QUERIES["op12_tree_bpe"](spark, SF))
    assert got == sorted(((r.doc_id, *whole(library, r.text)) for r in rows), key=repr)


# --- alignment ------------------------------------------------------------------------------


def spans(sizes):
    end = 0
    for size in sizes:
        end += size
        yield end - size, end


def aligned(rows):
    """What ``align`` returns, by plain loops over the libraries' tokens."""
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    letters = {letter: byte for letter, byte in tree_bpe._byte_names().items()}

    def tokens(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        ids = a.encode(" " + text, add_special_tokens=False).ids
        left = [(n, bytes(letters[c] for c in a.id_to_token(n))) for n in ids]
        right = [
            (n, bytes([int(piece[3:5], 16)]) if b.is_byte(n) else piece.replace("▁", " ").encode())
            for n, piece in ((n, b.id_to_piece(n)) for n in b.encode(text))
        ]
        same = all(b"".join(raw for _, raw in side) == whole for side in (left, right))
        return (left, right) if same else ([], [])

    docs, counts = [], Counter()
    for doc_id, text in rows:
        left, right = tokens(text)
        a_spans, b_spans = (list(spans(len(raw) for _, raw in side)) for side in (left, right))
        links, k = [], 0
        for (x, _), (i, j) in zip(left, a_spans):
            while k and b_spans[k][0] > i:
                k -= 1
            while b_spans[k][1] <= i:
                k += 1
            m = k
            while m < len(right) and b_spans[m][0] < j:
                links.append((x, right[m][0]))
                m += 1
        counts.update(links)
        common = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        groups, start = [], 0
        for end in common:
            sides = [",".join(str(n) for (n, _), (i, _) in zip(side, at) if start <= i < end) for side, at in ((left, a_spans), (right, b_spans))]
            groups.append("|".join(sides))
            start = end
        docs.append((doc_id, len(left), len(right), links, groups))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(
        ((i, na, nb, len(g), len(ls), sum(counts[p] == best[p[1]] for p in ls), sum(counts[p] for p in ls),
          hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, na, nb, ls, g in docs), key=repr,
    )


@pytest.mark.parametrize("block", [40, 300, alignment.BLOCK_BYTES])
def test_alignment_equals_plain_loops(spark, block):
    odd = awkward(spark).where("n_chars is null or n_chars < 5000").union(documents(spark, list(enumerate(mixtures(60), 100)) + [(100, "▁x y"), (3, "<s> </s> <0x41>")]))
    got = collected(alignment.align(odd.repartition(3), A_FILE, B_FILE, block))
    assert got == aligned([(r.doc_id, r.text) for r in odd.collect()])


def test_alignment_of_empty_tables(spark):
    odd = awkward(spark)
    assert alignment.align(odd.limit(0), A_FILE, B_FILE).count() == 0
    none = alignment.align(odd.where("text is null"), A_FILE, B_FILE)
    assert {tuple(r)[1:] for r in none.collect()} == {(0, 0, 0, 0, 0, 0, "")} and none.count() == 2


def test_pointers_reach_the_end_of_long_groups():
    a_end, b_end = np.append(np.arange(2, 20_001, 2), 20_002), np.append(np.arange(1, 20_001, 2), 20_002)
    last = alignment.last_tokens(a_end, b_end, np.searchsorted(b_end, a_end))
    assert set(last.tolist()) == {len(b_end) - 1}


def test_alignment_query_equals_plain_loops(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert collected(QUERIES["op11_token_alignment"](spark, SF)) == aligned(rows)
