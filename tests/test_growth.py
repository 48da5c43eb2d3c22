"""Copies are recognised without writing what they hold."""

from pathlib import Path

from pyspark.sql import functions as F

from checks.files import write_contract_files
from tests import data
from tests.conftest import rows, write_lines
from tests.test_questions import check
from tests.test_streaming import session_answers
from tillmetrics.schemas import TRANSACTIONS
from tillmetrics.streaming import Session, ingest, read_session


def test_rows_of_copies_are_not_written(spark, folder, monkeypatch):
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    data.write_client(f"{root}/client_id=client_1/again")
    written, land = [], ingest.land
    monkeypatch.setattr(ingest, "land", lambda rows, path, levels: written.append(path) or land(rows, path, levels))
    check(session_answers(spark, root, work))
    assert written and not any("_staged" in path for path in written)


def test_other_lines_under_a_name_that_comes_again_count(spark, folder):
    """A name comes three times: a file, its copy, and a file with other lines."""
    root, work = data.write_clients(folder("in"), "client_1"), folder("work")
    data.write_client(f"{root}/client_id=client_1/again")
    extra = [data.transaction("extra", 1, "10", "100", "2024-02-01 10:00:00")]
    write_lines(f"{root}/client_id=client_1/other/transactions_202401.csv", data.TRANSACTION_HEADER, extra)
    session_answers(spark, root, work)
    assert len(rows(read_session(spark, Session(work), TRANSACTIONS), "transaction_id")) == 27


def test_copies_written_with_their_files_are_true_copies(spark, folder):
    month = F.concat(F.lit("20240"), (F.col("id") % 3 + 1).cast("string")).alias("file_month")
    text = spark.range(40).select(F.col("id").cast("string").alias("transaction_id"), F.lit("c").alias("client_id"), month)
    root = folder("in")
    write_contract_files(text.repartition(3), TRANSACTIONS, root, again="again")
    files = {str(path.relative_to(root)): path.read_text() for path in Path(root).rglob("transactions_*.csv")}
    copies = {name.replace("/again/", "/"): held for name, held in files.items() if "/again/" in name}
    assert len(copies) > 3 and copies == {name: held for name, held in files.items() if "/again/" not in name}
    assert sum(held.count("\n") - 1 for held in copies.values()) == 40
