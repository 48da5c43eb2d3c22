"""N-gram Jaccard join and benchmark decontamination, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import SCHEMA, awkward, documents, prose
from tillmetrics.llm import common, decontaminate, ngram_join


def shingles(text):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_links(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            k = len(sets[a] & sets[b])
            if a < b and k and 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i), links[i]) for i in ids}


def near_copies(seed, groups=12, copies=9):
    rng, rows = random.Random(seed), []
    shared = prose(seed + 1, 40)
    for g in range(groups):
        base = prose(seed * 100 + g, rng.randrange(20, 200)).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            rows.append(" ".join(w) + (" " + shared if rng.random() < 0.3 else ""))
    rng.shuffle(rows)
    return list(enumerate(rows, 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    rows = near_copies(seed)
    got = ngram_join.ngram_jaccard_join(documents(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert {tuple(r) for r in got.collect()} == brute_links(rows)


def test_join_of_many_blocks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", 3000)
    monkeypatch.setattr(ngram_join, "SLAB", 7)
    rows = near_copies(3, groups=2, copies=40)
    assert {tuple(r) for r in ngram_join.ngram_jaccard_join(documents(spark, rows)).collect()} == brute_links(rows)


def test_join_takes_awkward_rows(spark):
    got = ngram_join.ngram_jaccard_join(awkward(spark)).collect()
    assert len(got) == 13
    assert {tuple(r)[1:] for r in got if r.doc_id in (1, 2, 3)} == {(0, 1, 0), (0, 2, 0), (0, 3, 0)}
    assert [tuple(r) for r in got if r.doc_id == 5] == [(5, 1, 4, 1)] * 2
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert ngram_join.ngram_jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(3, prose(1, 60)), (8, prose(1, 60)), (9, prose(2, 60)), (None, prose(1, 60))]
    kept = ngram_join.keep_one_of_each(spark, documents(spark, rows), "")
    assert kept.schema.simpleString() == documents(spark, rows).schema.simpleString()
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 9]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1080)]
    forest = common.Forest()
    for a, b in edges:
        if a != b:
            forest.join(a, b)
    got = common.components(spark.createDataFrame(edges, "a long, b long").repartition(7))
    assert {tuple(r) for r in got.collect()} == {(x, forest.root(x)) for x in list(forest.parent)}


# --- decontamination -------------------------------------------------------------------


def test_index_finds_all_prints_within_the_radius():
    rng = random.Random(7)
    items = decontaminate.Items([(k, prose(k, 12)) for k in range(6)])
    (index,) = items.sizes.values()
    own = index[1]
    for _ in range(3000):
        k, bits = rng.randrange(6), rng.randrange(decontaminate.RADIUS + 1)
        flipped = own[k] ^ np.uint64(sum(1 << b for b in rng.sample(range(64), bits)))
        found = {item: n for _, item, n in decontaminate._near(np.array([flipped]), index)}
        want = {j: n for j in range(6) if (n := int(np.bitwise_count(own[j] ^ flipped))) <= decontaminate.RADIUS}
        assert found == want


def brute_matches(docs, items):
    def counts(w):
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))

    def words(t):
        return (t or "").lower().split()

    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = words(text), words(item)
            if len(b) < 5:
                continue
            of = counts(b)
            for s in range(max(1, len(a) - len(b) + 1)):
                window = counts(a[s : s + len(b)])
                k = (window & of).total()
                if k and k / (window.total() + of.total() - k) >= 0.8:
                    out[d, i] = max(out.get((d, i), 0), k / (window.total() + of.total() - k))
    return out


def test_matches_equal_brute_force(spark):
    rng = random.Random(3)
    items = [(k, prose(k, rng.randrange(15, 60))) for k in range(30)] + [(99, "to be or"), (98, None), (97, prose(0, 20))]
    docs = []
    for d in range(80):
        w = prose(1000 + d, 150).split()
        for k in rng.sample(range(30), 2):
            passage = items[k][1].split()
            if d % 3 == 0:
                passage[rng.choice([0, 1, -1, -2])] = "Changed"
            if d % 5 == 0:
                passage = passage[2:]
            at = rng.randrange(len(w))
            w[at:at] = [p.upper() if d % 2 else p for p in passage]
        docs.append((d, " ".join(w)))
    docs += [(200, items[4][1]), (201, items[5][1].rsplit(" ", 1)[0]), (202, None), (203, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.benchmark_matches(documents(spark, docs), benchmark).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(brute_matches(docs, items))


def test_matches_take_awkward_rows_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "null id null id null id"), (2, None), (3, "")], "item_id long, text string")
    got = decontaminate.benchmark_matches(awkward(spark), items).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(None, 1)]
    assert decontaminate.benchmark_matches(awkward(spark), items.limit(0)).count() == 0
    assert decontaminate.benchmark_matches(spark.createDataFrame([], SCHEMA), items).count() == 0


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(k, prose(k, 20)) for k in range(9)], "item_id long, text string")
    docs = documents(spark, [(k, prose(50 + k, 30) + " " + prose(k, 20)) for k in range(9)])
    want = {tuple(r) for r in decontaminate.benchmark_matches(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "ITEMS", 2)
    assert {tuple(r) for r in decontaminate.benchmark_matches(docs, items).collect()} == want and len(want) == 9
