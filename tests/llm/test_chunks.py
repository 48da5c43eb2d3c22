"""Passages in text without spaces."""

import random

from tests.llm.helpers import documents
from tillmetrics.llm import chunk_dedup


def script(seed, n):
    rng = random.Random(seed)
    return "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(n))


def test_passages_without_spaces_are_cut(spark):
    passage = script(1, 1080)
    rows = [(k, script(10 + k, 300) + passage + script(20 + k, 300)) for k in range(4)]
    got = {r.doc_id: r.text for r in chunk_dedup.chunk_dedup(documents(spark, rows).coalesce(1)).collect()}
    assert got[0] == rows[0][1]
    for k in range(1, 4):
        # What is left of the passage are its ends; the own text is whole.
        assert len(got[k]) < 600 + 1080 // 4
        assert got[k].startswith(script(10 + k, 300)) and got[k].endswith(script(20 + k, 300))
