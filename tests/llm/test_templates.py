"""Which documents count as unlike, and how many of them a line needs."""

import math
import random
from collections import defaultdict

from tests.llm.helpers import documents
from tillmetrics.llm import line_templates


def words(seed, n):
    """Prose without digits."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))


def lines_of(seed, lines, n=12):
    return "\n".join(words(100 * seed + k, n) for k in range(lines))


def dropped(spark, rows):
    return {r.doc_id: r.text for r in line_templates.dedup_lines(documents(spark, rows)).collect()}


def test_shared_passages_go_whatever_their_hashes(spark):
    for seed in range(4):
        # Half of each text is one passage: its least hash is that of most texts in one case out of two.
        passage = lines_of(9000 + seed, 5)
        rows = [(k, lines_of(1000 * seed + k, 5) + "\n" + passage) for k in range(60)]
        got = dropped(spark, rows)
        assert [got[k] for k in range(60)] == [t.removesuffix("\n" + passage) for _, t in rows]


def test_copies_beside_unlike_documents_do_not_keep_a_line(spark):
    line = words(1, 8)
    base = lines_of(2, 8).split(" ")
    rows = [(k, lines_of(10 + k, 8) + "\n" + line) for k in range(12)]
    for k in range(60):
        near = list(base)
        near[k] = words(5000 + k, 1)
        rows.append((100 + k, " ".join(near) + "\n" + line))
    assert all(line not in t for t in dropped(spark, rows).values())


def test_near_copies_without_digits_stay(spark):
    base = lines_of(3, 10).split(" ")
    rows = []
    for k in range(60):
        near = list(base)
        for j in random.Random(k).sample(range(len(near)), 2):
            near[j] = words(7000 + k, 1)
        rows.append((k, " ".join(near)))
    rows += [(100 + k, lines_of(50, 6)) for k in range(30)]
    assert dropped(spark, rows) == dict(rows)


def test_long_lines_need_fewer_documents(spark):
    long, middling, short, quoted = words(1, 60), words(2, 22), words(3, 6), words(4, 60)
    rows = [(k, lines_of(20 + k, 12)) for k in range(9)]
    want = dict(rows)
    rows = [(k, "\n".join([t, short, *([long] if k < 3 else []), *([middling] if k < 5 else []), *([quoted] if k > 6 else [])])) for k, t in rows]
    assert dropped(spark, rows) == {k: "\n".join([t, short, *([quoted] if k > 6 else [])]) for k, t in want.items()}


def test_values_that_recur_in_a_few_documents_do_not_split_a_template(spark):
    a, b, names = words(5, 14), words(6, 14), [words(800 + k, 1) for k in range(5)]
    # Each value recurs in four documents, so it looks fixed, but no two documents have both.
    rows = [(k, lines_of(40 + k, 6) + f"\n{a} {names[k % 5]} {b} {words(900 + k % 4, 1)}") for k in range(20)]
    assert dropped(spark, rows) == {k: t.rsplit("\n", 1)[0] for k, t in rows}


def test_lines_of_digits_go(spark):
    ends = ["Copyright 2024", "Tel. 555 0100", "12.50 13.00 14.75 2024-05-01"]
    rows = [(k, "\n".join([lines_of(60 + k, 6), *ends, f"Page {k} of {50 - k}", f"{k} {k + 1} in {k + 2}"])) for k in range(15)]
    # Their digits differ, and most of the last line is digits.
    assert dropped(spark, rows) == {k: "\n".join([lines_of(60 + k, 6), f"{k} {k + 1} in {k + 2}"]) for k in range(15)}


def test_plain_lines_that_share_a_beginning_stay(spark):
    rows = [(k, f"in the {words(k, 8)}\n{words(500 + k, 30)}") for k in range(40)]
    assert dropped(spark, rows) == dict(rows)


def test_columns_with_the_operators_names_pass(spark):
    line = words(1, 8)
    rows = documents(spark, [(k, lines_of(10 + k, 4) + "\n" + line) for k in range(12)])
    odd = rows.selectExpr("*", "9 AS lines_dropped", "'a' AS __a", "'g' AS __gone", "'r' AS row", "1 AS gone", "2 AS __b")
    got = line_templates.dedup_lines(odd).collect()
    assert {r["lines_dropped"] for r in got} == {1} and {(r["__a"], r["__gone"], r["row"], r["gone"], r["__b"]) for r in got} == {("a", "g", "r", 1, 2)}
    kept = line_templates.drop_lines(spark, odd, "")
    assert kept.columns == odd.columns
    assert {(r["lines_dropped"], r["__a"], r["row"], r["n_chars"] == len(r["text"])) for r in kept.collect()} == {(9, "a", "r", True)}


# --- the whole tree by plain loops ---------------------------------------------------------------


VARIABLE = "<*>"


def enough(tokens):
    return max(line_templates.LEAST_LONG, min(line_templates.LEAST_BODIES, -(-line_templates.EVIDENCE // tokens)))


def plainly(texts):
    """{text: its rest}, for texts none of which is a near copy of another."""
    lead, least_fixed, least_plain = line_templates.LEAD, line_templates.LEAST_FIXED, line_templates.LEAST_PLAIN
    parsed = {}
    for text in texts:
        lines = []
        for number, line in enumerate(text.split("\n")):
            exact = tuple(line.split())
            masked = tuple(VARIABLE if any(c in "0123456789" for c in t) else t for t in exact)
            if exact:
                lines.append((number, (len(exact), masked[:lead]), masked, exact))
        parsed[text] = lines

    def bodies(rows):
        """How many texts there are for each key."""
        found = defaultdict(set)
        for key, text in rows:
            found[key].add(text)
        return {key: len(held) for key, held in found.items()}

    in_leaf = bodies((leaf, text) for text, lines in parsed.items() for _, leaf, _, _ in lines)
    rows = {(leaf, masked, exact, text) for text, lines in parsed.items() for _, leaf, masked, exact in lines if in_leaf[leaf] >= enough(leaf[0])}
    gone = {exact for exact, n in bodies((e, t) for _, m, e, t in rows if m != e).items() if n >= enough(len(exact))}

    def ahead(masked):
        n, plain = len(masked), sum(t != VARIABLE for t in masked)
        spare = n - max(math.ceil(least_fixed * plain - 1e-9), math.ceil(least_plain * n - 1e-9))
        return None if n - lead <= spare else list(enumerate(masked[lead : lead + spare + 1]))

    looked_at = {leaf_line: ahead(leaf_line[1]) for leaf_line in {(leaf, masked) for leaf, masked, _, _ in rows}}
    early = bodies(((leaf, p, t), text) for leaf, m, _, text in rows for p, t in looked_at[leaf, m] or () if t != VARIABLE)
    able = {
        (leaf, m) for (leaf, m), places in looked_at.items()
        if places is None or any(early.get((leaf, p, t), 0) >= enough(len(m)) for p, t in places)
    }
    rows = {(leaf, m, text) for leaf, m, _, text in rows if (leaf, m) in able}
    fixed = bodies(((leaf, p, t), text) for leaf, m, text in rows for p, t in enumerate(m) if t != VARIABLE)
    templates = defaultdict(set)
    for leaf, m in able:
        for least in (1, line_templates.LEAST_BODIES):
            kept = frozenset((p, t) for p, t in enumerate(m) if fixed.get((leaf, p, t), 0) >= max(least, enough(len(m))))
            plain = sum(t != VARIABLE for t in m)
            if len(kept) >= least_fixed * plain - 1e-9 and len(kept) >= least_plain * len(m) - 1e-9:
                templates[leaf, kept].add(m)
    for (leaf, kept), lines in templates.items():
        holders = {text for other, m, text in rows if other == leaf and m in lines}
        if kept and len(holders) >= enough(len(kept)):
            gone |= lines
    return {
        text: "\n".join(
            line for number, line in enumerate(text.split("\n"))
            if not any(number == at and (m in gone or e in gone) for at, _, m, e in lines)
        )
        for text, lines in parsed.items()
    }


def test_the_tree_equals_plain_loops(spark):
    rng, texts = random.Random(8), []
    shapes = [words(70 + k, rng.choice([3, 6, 9, 14, 25])).split(" ") for k in range(14)]
    for k in range(90):
        lines = [words(3000 + 10 * k + j, 12) for j in range(5)]
        for shape in rng.sample(shapes, 3):
            line = list(shape)
            for place in rng.sample(range(len(line)), rng.randrange(1 + len(line) // 3)):
                line[place] = rng.choice([str(rng.randrange(40)), words(rng.randrange(6), 1), words(100 * k + place, 1)])
            lines.insert(rng.randrange(len(lines)), " ".join(line))
        texts.append("\n".join([*lines, "", rng.choice(["  ", "a 1", "2024 2025 5 7", "end of text"])]))
    want = plainly(texts)
    got = dropped(spark, list(enumerate(texts)))
    assert [got[k] for k in range(90)] == [want[t] for t in texts]
    assert 60 < sum(want[t] != t for t in texts) < 91 and sum(w.count("\n") for w in want.values()) > 400
