"""Replays that hold rows: as many partitions of state as cores and rows need, not as the session names."""

import glob

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from tidemark.streaming import run

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture
def many(spark):
    kept = spark.conf.get(run.SHUFFLE_PARTITIONS)
    spark.conf.set(run.SHUFFLE_PARTITIONS, "40")
    yield spark
    spark.conf.set(run.SHUFFLE_PARTITIONS, kept)


def test_partitions_follow_cores_and_rows_up_to_the_session(many):
    cores = many.sparkContext.defaultParallelism
    assert run.state_partitions(many, 0) == run.state_partitions(many, 10**6) == 2 * cores
    assert run.state_partitions(many, 18 * run.ROWS_PER_PARTITION + 1) == 19
    assert run.state_partitions(many, 10**12) == 40
    many.conf.set(run.SHUFFLE_PARTITIONS, "3")
    assert run.state_partitions(many, 10**12) == 3


@pytest.mark.parametrize(
    "name, label",
    [
        ("st3_rising_run_stream", "rising"),
        ("st1_custom_stream", "judged-by-mark"),
        ("st17_resumed_stream", "resumed"),
    ],
)
def test_a_held_stream_has_partitions_of_its_own(many, name, label, monkeypatch, tmp_path):
    path = str(tmp_path)
    monkeypatch.setattr(run, "scratch_path", lambda _, label: f"{path}/{label}")
    rows, problems = compare(entry.queries()[name](many, DIRECTORY), connect(DIRECTORY), entry.oracle_sql()[name])
    assert rows and not problems
    parts = [p for p in glob.glob(f"{path}/{label}/checkpoint/state/0/*") if p.rsplit("/", 1)[1].isdigit()]
    assert len(parts) == 2 * many.sparkContext.defaultParallelism < 40
    assert many.conf.get(run.SHUFFLE_PARTITIONS) == "40"


def test_a_query_that_cannot_start_leaves_the_session_as_it_was(many):
    stream = many.readStream.format("rate").load()
    with pytest.raises(Exception, match="nowhere"):
        run._start(many, stream.writeStream.format("nowhere"), 2)
    assert many.conf.get(run.SHUFFLE_PARTITIONS) == "40"
