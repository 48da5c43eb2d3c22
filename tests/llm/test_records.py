"""Chat perspectives, WARC archives, packing, context trees, and the pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import compare, oracle_connection
from tests.conftest import plan
from tests.llm.helpers import SCHEMA, awkward, documents, prose
from tillmetrics.llm import chat_perspectives, context_tree, packing, warc
from tillmetrics.llm.common import QUERIES, SQL, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), oracle_connection(SF), SQL[name]) is None


def test_all_are_registered():
    names = set(contract.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))


# --- chat ---------------------------------------------------------------------------------


def test_views_of_each_speaker(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "Be kind."), (1, 1, "Ann", "Hi"), (1, 2, "Bob B", "Yes <|im_end|>"), (1, 3, "Ann", None), (1, None, "", "late"),
         (2, 0, "system", "alone"), (None, 0, "Ann", "lost"), (3, 5, "Ann", "x"), (3, 600, "Ann", "y"), (3, 600, "Ann", "y")],
        "conv_id long, turn long, role string, text string",
    ).withColumns({"speaker": F.lit(1), "part": F.lit("p"), "rendered": F.lit(0)})
    got = {(r.conv_id, r.speaker, r.part): r for r in chat_perspectives.perspectives(turns).collect()}
    assert set(got) == {(1, s, p) for s in ("Ann", "Bob_B", "unknown") for p in (0, None)} | {(3, "Ann", 0), (3, "Ann", 1)}
    ann = got[1, "Ann", 0]
    assert ann.rendered == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi<|im_end|>\n"
        "<|im_start|>user name=Bob_B\nYes <| im_end|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    )
    assert [ann.rendered[a:b] for a, b in ann["mask"]] == ["Hi<|im_end|>\n", "<|im_end|>\n"]
    assert got[1, "Ann", None]["mask"] == [] and got[3, "Ann", 1].n_turns == 2
    assert chat_perspectives.perspectives(turns.limit(0)).count() == 0


def test_views_run_without_python(spark):
    text = plan(QUERIES["op1_chat_perspectives"](spark, SF))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "Nested", "Cartesian"))


# --- archives ---------------------------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    twin, inner = "<p>" + "é" * 100, "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5
    rows = [(5, "u", twin), (3, None, twin), (9, "u\r\nX: y", twin), (4, "u", "small"), (6, "u", "small"), (7, "u", None), (8, "u", inner),
            (3, "u", twin), (None, "u", twin), (10, "u", "a" * 1_200_000), (11, "u", "a" * 1_200_000), (12, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    warc.write_archives(pages, str(tmp_path / "w"))
    got = sorted((tuple(r) for r in warc.read_archives(spark, str(tmp_path / "w")).collect()), key=repr)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        revisit = len(data) >= 100 and i != min(same)
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None))
    assert got == sorted(want, key=repr)


def test_empty_archives(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


def test_broken_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.parsed(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcdef\r\n\r\n"))


# --- packing ---------------------------------------------------------------------------------


def test_ids_equal_those_of_the_tokenizer(spark):
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text for r in table(spark, SF, "documents").collect()]
    texts += ["a\n\n b", "x  y   z\t\tq", " lead", "trail ", "it's  12\r\nok\x1c\x1cz", "<|endoftext|> hi", "", " ", "\n", "été  x", "日本 語。"]
    for text, want in zip(texts, encoder.whole.encode_batch(texts, add_special_tokens=False)):
        assert encoder.ids(text).tolist() == want.ids


def test_cuts_are_the_cheapest(monkeypatch):
    monkeypatch.setattr(packing, "INNER_STEP", 3)
    monkeypatch.setattr(packing, "WHOLE", (4, 2))
    rng, length = random.Random(2), 10
    for _ in range(200):
        ends = np.cumsum([rng.randrange(1, 15) for _ in range(rng.randrange(1, 5))])
        sentences = np.array(sorted(rng.sample(range(1, int(ends[-1]) + 1), min(3, int(ends[-1])))))
        marks = sorted({0, *ends.tolist(), *sentences.tolist()})
        price = {t: 0 if t in ends else packing.SENTENCE_CUT for t in marks}
        for a, b in zip(marks, marks[1:]):
            price |= {t: packing.INNER_CUT for t in range(a + 3, b, 3)}
        best = {0: 0}
        for t in sorted(price)[1:]:
            best[t] = price[t] + min(best[s] + (0 if t - s in (4, 2) else length - t + s) for s in best if 0 < t - s <= length)
        found = packing.cuts(ends, sentences, length)
        cost = sum(price[b] + (0 if b - a in (4, 2) else length - b + a) for a, b in zip(found, found[1:]))
        assert (found[0], found[-1], cost) == (0, ends[-1], best[ends[-1]])


def check_pieces(pieces, docs, encoder, length):
    ids_of = defaultdict(list)
    for r in docs:
        ids_of[r.doc_id].append([*encoder.ids(r.text or "").tolist(), 0])
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
    for doc_id, texts in ids_of.items():
        mine = Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces if p.doc_id == doc_id)
        covered = sum(p[1] * n for p, n in mine.items())
        assert covered == sum(map(len, texts))
        for (start, size, crc, total), _ in mine.items():
            assert any(
                len(t) == total and zlib.crc32(np.array(t[start : start + size], "<u4").tobytes()) == crc for t in texts
            )


def test_packing_round_trip(spark, monkeypatch):
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.op10_packing(spark, SF).collect()
    check_pieces(pieces, table(spark, SF, "documents").collect(), encoder, 1024)
    sizes = Counter()
    for p in pieces:
        sizes[p.sequence_id] += p.length
    padding = sum(1024 - n for n in sizes.values() if n & (n - 1))
    assert padding <= 0.04 * sum(sizes.values())


def test_packing_takes_awkward_rows(spark, monkeypatch):
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(packing, "RUN_TOKENS", 3000)
    source = awkward(spark)
    check_pieces(packing.pack(source, public_tokenizers.path("byte_bpe_50k.json"), 128).collect(), source.collect(), encoder, 128)
    assert packing.pack(source.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# --- context trees ---------------------------------------------------------------------------


def brute_scores(rows, depth):
    """Weighted trees by their definition, one dictionary of counts for each context."""
    lower = {c: c + 32 for c in range(65, 91)}
    counts = defaultdict(lambda: [0, 0])

    def steps(text):
        data = [255] * depth + list((text or "").translate(lower).encode()) + [255]
        for at in range(depth, len(data)):
            context = tuple(data[at - 1 : at - 1 - depth if at > depth else None : -1])[:depth]
            for k in range(8):
                yield context, (1 << k) | (data[at] >> (8 - k)), (data[at] >> (7 - k)) & 1

    for text, held in rows:
        if not held:
            for context, node, bit in steps(text):
                for d in range(depth + 1):
                    counts[context[:d], node][bit] += 1
    children = defaultdict(set)
    for context, node in list(counts):
        if context:
            children[context[:-1], node].add(context)
    known = {}

    def kt(c):
        return math.lgamma(c[0] + 0.5) + math.lgamma(c[1] + 0.5) - math.lgamma(sum(c) + 1) - math.log(math.pi)

    def weight(context, node):
        if (context, node) not in known:
            own = kt(counts.get((context, node), [0, 0]))
            below = sum(weight(c, node) for c in children.get((context, node), ()))
            known[context, node] = own if len(context) == depth else np.logaddexp(own, below) - math.log(2)
        return known[context, node]

    def chance(context, node, bit):
        p = None
        for d in range(depth, -1, -1):
            c = counts.get((context[:d], node), [0, 0])
            own = (c[bit] + 0.5) / (sum(c) + 1)
            if p is None:
                p = own
            else:
                w = math.exp(kt(c) - math.log(2) - weight(context[:d], node))
                p = w * own + (1 - w) * p
        return p

    return [sum(math.log10(chance(*step)) for step in steps(text)) for text, _ in rows]


@pytest.mark.parametrize("depth", [2, 4])
def test_scores_equal_brute_force(spark, monkeypatch, depth):
    monkeypatch.setattr(context_tree, "PART_BYTES", 300)
    monkeypatch.setattr(context_tree, "BLOCK_BYTES", 900)
    rows = [(k, prose(k, 20, 15).replace("w", "W ") + "é\n") for k in range(30)] + [(50, None), (51, ""), (52, "zz top")]
    got = context_tree.context_tree_scores(documents(spark, rows).repartition(3), F.col("doc_id") % 5 == 0, depth).collect()
    want = dict(zip([i for i, _ in rows], brute_scores([(t, i % 5 == 0) for i, t in rows], depth)))
    assert {r.doc_id: r.score for r in got} == pytest.approx(want, rel=1e-5)
    counts = Counter()
    for i, t in rows:
        if i % 5:
            counts.update([*(t or "").lower().split(), None])
    total, types = counts.total(), len(counts)
    for r in got:
        tokens = [*(dict(rows)[r.doc_id] or "").lower().split(), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.held_out == (r.doc_id % 5 == 0)


def test_chances_of_all_bytes_add_up_to_one(spark):
    rows = [(1, "abracadabra"), (2, "cadabra")] + [(10 + b, "ab" + chr(b)) for b in range(128)]
    got = context_tree.context_tree_scores(documents(spark, rows), F.col("doc_id") >= 10, 3).collect()
    ends = {r.doc_id: r.score for r in got if r.doc_id >= 10}
    assert 0 < sum(10**v for v in ends.values()) < 1


def test_trees_take_awkward_rows(spark):
    source = awkward(spark)
    got = context_tree.context_tree_scores(source, F.col("doc_id") % 2 == 0).collect()
    assert len(got) == source.count() and all(r.score < 0 for r in got)
    untaught = context_tree.context_tree_scores(source, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in untaught} == {(0, 0)}
    empty = next(r for r in untaught if r.doc_id == 2)
    assert empty.score == pytest.approx(8 * math.log10(0.5), rel=1e-5)
    assert context_tree.context_tree_scores(spark.createDataFrame([], SCHEMA), F.lit(False)).count() == 0


# --- pipeline ----------------------------------------------------------------------------------


def test_pipeline(spark):
    from tillmetrics.llm.common import written

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = written(stage(spark, docs, sf))
        assert docs.columns == columns and {r.doc_id for r in docs.collect()} <= before
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf).select("doc_id", "start", "length", "ids_crc32").collect()))
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    check_pieces(pieces, docs.collect(), encoder, 1024)
    assert sum(p[2] for p in got) == sum(p.length for p in pieces)


def test_first_stage_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    good = {r.doc_id for r in table(spark, sf, "labels").where("quality = 1").collect()}
    first = corpus_pipeline.STAGES[0][1](spark, table(spark, sf, "documents"), sf)
    assert len(good & {r.doc_id for r in first.collect()}) >= 0.95 * len(good)
