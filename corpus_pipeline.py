"""A corpus from raw documents to training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as
the documents of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillmetrics.llm.common import table, written  # noqa: E402
from tillmetrics.llm.decontaminate import drop_contaminated  # noqa: E402
from tillmetrics.llm.line_templates import drop_lines  # noqa: E402
from tillmetrics.llm.ngram_join import keep_one_of_each  # noqa: E402
from tillmetrics.llm.packing import pack_stage  # noqa: E402
from tillmetrics.llm.pu_quality import keep_good  # noqa: E402

STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_stage),
]

#: The classifier's fit and the tokenizer have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return written(STAGES[-1][1](spark, docs, sf_dir))
