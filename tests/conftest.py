import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tillmetrics.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tillmetrics-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A fresh sub-folder on every call."""
    return lambda label="d": str(tmp_path / f"{label}-{uuid.uuid4().hex[:8]}")


def write_lines(path, header, lines):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "\n".join(([header] if header else []) + list(lines)) + "\n"
    path.write_text(text, encoding="utf-8")
    return path


def rows(df, *order):
    """Collected rows as plain tuples, sorted."""
    selected = df.select(*order) if order else df
    return sorted((tuple(row) for row in selected.collect()), key=repr)


def plan(df):
    """Physical plan text of a DataFrame."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
