"""Tables kept between steps."""

import pytest
from pyspark.sql import functions as F

from tillmetrics.llm import common
from tillmetrics.llm.common import SHUFFLE_CLEANUP, components, scratch_tables, shuffles_removed, stored, written


@pytest.mark.parametrize("keep", [stored, written])
def test_kept_tables_hold_all_rows_and_the_session_its_setting(spark, keep):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    counts = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    kept = keep(counts)
    assert kept.schema.names == ["k", "count"] and sorted(map(tuple, kept.collect())) == [(k, 100) for k in range(10)]
    # The source can be asked again after its shuffle files are gone.
    assert sorted(map(tuple, counts.collect())) == [(k, 100) for k in range(10)]
    assert sorted(map(tuple, keep(counts).collect())) == sorted(map(tuple, kept.collect()))
    assert spark.conf.get(SHUFFLE_CLEANUP) == before


def test_the_setting_comes_back_after_a_failure(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    with pytest.raises(ValueError):
        with shuffles_removed(spark):
            raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP) == before


def test_scratch_tables_go_and_lasting_ones_stay(spark):
    with scratch_tables(spark):
        gone, stays = written(spark.range(3)), written(spark.range(3), lasting=True)
        assert gone.count() == 3
    assert stays.count() == 3
    with pytest.raises(Exception):
        gone.collect()


@pytest.mark.parametrize("most", [100_000, 7])
def test_few_edges_need_no_rounds(spark, monkeypatch, most):
    """A chain dealt over many partitions; with few edges a task, the rounds join what tasks have left."""
    kept = []
    monkeypatch.setattr(common, "TASK_EDGES", most)
    monkeypatch.setattr(common, "stored", lambda df: kept.append(df) or stored(df))
    chain = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(71, 70)], "a long, b long"))
    got = sorted(map(tuple, components(chain.repartition(13)).collect()))
    assert got == [(k, 0) for k in range(61)] + [(70, 70), (71, 70)]
    assert len(kept) == 2 if most > 60 else len(kept) > 2
