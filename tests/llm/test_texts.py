"""Line rules, line templates, chunk dedup, quality classifier."""

import random
import re
from collections import Counter

import pytest

from tests.llm.helpers import SCHEMA, awkward, documents, prose
from tillmetrics.llm import chunk_dedup, line_rules, line_templates, pu_quality
from tillmetrics.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if seen[w] > 1:
            covered |= set(range(k, k + 5))
    lines, known, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in known
            known.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_line_measures_equal_brute_force(spark):
    rows = table(spark, SF, "documents").collect() + awkward(spark).collect()
    docs = documents(spark, [(r.doc_id, r.text) for r in rows])
    got = line_rules.line_first_cleaning(docs).collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(((r.doc_id, *brute_measures(r.text)) for r in rows), key=repr)
    assert not any(r.kept and r.base_failed for r in got)
    assert line_rules.line_first_cleaning(spark.createDataFrame([], SCHEMA)).count() == 0


def test_line_rules(spark):
    body = " ".join(f"word{k}" for k in range(20)) + "."
    text = f"Home | News | About | Contact\n{body}\nShare\n\nAll rights reserved.\nStop!!! now!!! at!!! once!!!"
    (row,) = line_rules.line_first_cleaning(documents(spark, [(1, text)])).collect()
    assert (row.kept, row.cleaned, row.n_lines, row.n_lines_removed) == (True, body, 5, 4)
    (row,) = line_rules.line_first_cleaning(documents(spark, [(1, "One | two | three | four | five\n" * 4 + "Fine day.")])).collect()
    assert not row.kept


def test_good_documents_stay(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = line_rules.line_first_cleaning(table(spark, SF, "documents")).collect()
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(good) >= 0.98 * len(good)


# --- templates --------------------------------------------------------------------------


def test_recurring_templates_go_and_copies_stay(spark):
    rows = []
    for k in range(40):
        own = "\n".join(prose(1000 * k + j, 12) for j in range(4))
        rows.append((k, f"Posted on day {k} of year 20{k:02d} by staff\n{own}\nBack to top of page"))
    copy = "\n".join(prose(77 + j, 12) for j in range(6))
    rows += [(100 + k, copy) for k in range(30)]
    got = {r.doc_id: r for r in line_templates.dedup_lines(documents(spark, rows)).collect()}
    for k in range(40):
        assert got[k].text == "\n".join(rows[k][1].split("\n")[1:-1]) and got[k].lines_dropped == 2
    assert all(got[100 + k].text == copy for k in range(30))


def test_lines_that_share_a_beginning_stay(spark):
    rows = [(k, f"in the {prose(k, 8)}\n{prose(500 + k, 30)}") for k in range(40)]
    assert all(r.lines_dropped == 0 for r in line_templates.dedup_lines(documents(spark, rows)).collect())


def test_templates_take_awkward_rows(spark):
    source = awkward(spark)
    got = line_templates.dedup_lines(source)
    assert got.columns == [*source.columns, "lines_dropped"]
    assert sorted(got.select(*source.columns).collect(), key=repr) == sorted(source.collect(), key=repr)
    assert line_templates.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    assert line_templates.drop_lines(spark, source, "").count() == source.count()


def test_stage_updates_length_and_drops_emptied_rows(spark):
    rows = [(k, f"{prose(k, 20)}\nAll the same here") for k in range(30)] + [(50, "All the same here")]
    kept = line_templates.drop_lines(spark, documents(spark, rows), "").collect()
    assert sorted(r.doc_id for r in kept) == list(range(30)) and all(r.n_chars == len(r.text) for r in kept)


# --- chunks ------------------------------------------------------------------------------


def test_repeated_passages_are_cut_once(spark):
    rng = random.Random(1)
    passages = [prose(9000 + k, 70) for k in range(5)]
    rows = []
    for k in range(60):
        w = prose(k, 150).split()
        at = rng.randrange(len(w))
        rows.append((k, " ".join(w[:at] + [passages[k % 5]] + w[at:])))
    got = {r.doc_id: r.text for r in chunk_dedup.chunk_dedup(documents(spark, rows).coalesce(1)).collect()}
    for p in passages:
        words = p.split()
        middle = " ".join(words[20:50])
        assert sum(middle in t for t in got.values()) == 1
    for k, text in rows:
        left, own = got[k].split(), prose(k, 150).split()
        assert [w for w in left if w in set(own)] == own or set(own) <= set(left)


def test_chunks_meet_again_behind_an_insertion():
    import numpy as np

    text = prose(4, 400).encode()
    for shift in range(1, 30):
        moved = b"z" * shift + text
        a = set(chunk_dedup.chunk_ends(np.frombuffer(text, np.uint8)) + shift)
        b = set(chunk_dedup.chunk_ends(np.frombuffer(moved, np.uint8)))
        assert len({x for x in a - b if x > shift + 120}) == 0


def test_copies_lose_their_text_and_clean_rows_keep_theirs(spark):
    rows = [(1, prose(1, 100)), (2, prose(2, 100)), (3, prose(1, 100)), (4, "short"), (5, "short")]
    got = {r.doc_id: r for r in chunk_dedup.chunk_dedup(documents(spark, rows).coalesce(1)).collect()}
    assert [got[k].text for k in (1, 2, 3, 4, 5)] == [rows[0][1], rows[1][1], "", "short", "short"]


def test_chunks_take_awkward_rows(spark):
    source = awkward(spark)
    got = chunk_dedup.chunk_dedup(source).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(((r.doc_id, r.text) for r in source.collect()), key=repr)
    assert chunk_dedup.chunk_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


# --- quality --------------------------------------------------------------------------------


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    scores = {r.doc_id: r for r in pu_quality.op2_pu_quality(spark, sf).collect()}
    assert len(scores) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scores.values())
    known = [(scores[r.doc_id].score, r.quality) for r in table(spark, sf, "labels").collect() if scores[r.doc_id].held_out]
    good, bad = ([s for s, q in known if q == x] for x in (1, 0))
    assert sum(g > b for g in good for b in bad) >= 0.95 * len(good) * len(bad)


def test_non_negative_risk_finds_the_prior():
    import numpy as np

    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (9000, 4)), rng.normal(3, 1, (3000, 4))
    positive, unlabelled = good[:3000], np.vstack([good[3000:], bad])
    first = pu_quality.fit(positive, unlabelled, None)
    bins = [np.bincount(np.minimum((first.scores(x) * 1000).astype(int), 999), minlength=1000) for x in (positive, unlabelled)]
    prior = pu_quality.class_prior(*bins)
    assert prior == pytest.approx(2 / 3, abs=0.06)
    model = pu_quality.fit(positive, unlabelled, prior)
    assert (model.scores(good) >= 0.3).mean() > 0.95 and (model.scores(bad) < 0.3).mean() > 0.95


def test_quality_takes_awkward_rows(spark, tmp_path):
    labels = spark.createDataFrame([(4, 1, 0), (4, None, 0), (6, 1, 0), (None, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    source = awkward(spark)
    source.write.parquet(str(tmp_path / "documents.parquet"))
    got = pu_quality.op2_pu_quality(spark, str(tmp_path)).collect()
    assert len(got) == source.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    kept = pu_quality.keep_good(spark, source, str(tmp_path))
    assert kept.schema == source.schema and kept.count() <= source.count()
    nothing = pu_quality.learn(pu_quality.measured_documents(source), labels.limit(0))
    assert nothing[0].weights is None
    assert pu_quality.learn(pu_quality.measured_documents(source.limit(0)), labels)[0].weights is None
