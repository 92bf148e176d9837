"""Every registered query against its SQL, and the contract of the entry module."""

import check
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, connection, name):
    wanted = "ok" if name in entry.oracle_sql() else "rows only"  # tests of their own check the latter
    assert check.compare(spark, connection, SF_DIR, name).startswith(wanted)


def test_entry(spark):
    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stream_batches_lie_in_many_files(spark, tmp_path, monkeypatch):
    from registry import queries as registered
    from textloom.sources import staging

    monkeypatch.setattr(staging, "new_folder", lambda spark, name: str(tmp_path / name))
    docs = [(i, f"text {i}", f"s{i % 2}") for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    rows = registered.stream_corpus_statistics(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [("s0", 30, 205), ("s1", 30, 205)]
    # More than one task wrote each of the three batches, and each was counted once.
    assert len(list((tmp_path / "counts" / "files").glob("part-*.parquet"))) > 3
    assert sorted(p.name for p in (tmp_path / "counts" / "checkpoint" / "commits").glob("[0-9]*")) == ["0", "1", "2"]
