"""The prepare job over arriving files."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from refrain.operators.prepare import prepare_items, prune_entities, entity_ids, rejected_items
from refrain.sources import read_raw
from refrain.streaming import batches, prepare_stream, read_batches

HEADER = "id,name,duration_ms,id_artists,release_date,danceability\n"
FILES = [
    't1,"One\nmore",70000,"[\'a\', \'b\']",2020-01-02,0.8\nt2,,70000,[\'c\'],2020,0.1\n',
    't3,x,70000,"[\'b\', \'d\']",2020,0.5\nt4,x,1,[\'e\'],2020,0.1\nt5,x,70000,[],2020,0.1,long\n',
    't6,"a ""q""",70000,raw,1999,\nt7,cut\nt8,x,70000,"[\'a\']",2020,0.5\n',
]


def rows(df):
    return Counter(tuple(r) for r in df.collect()) if df is not None else Counter()


@pytest.fixture()
def entities(spark, tmp_path):
    data = [(i, f"n{i}") for i in "abcdefa"] + [("raw", "R")]
    df = spark.createDataFrame(data, "id string, name string")
    df.write.parquet(str(tmp_path / "entities"))
    return lambda: spark.read.parquet(str(tmp_path / "entities"))


def drop(folder, n):
    os.makedirs(folder, exist_ok=True)
    (folder / f"f{n}.csv").write_text(HEADER + FILES[n])


def agrees(spark, source, target, entities):
    """The parts of all batches are what a batch run makes of all files."""
    raw = read_raw(spark, str(source), faults="row_fault")
    plain = read_raw(spark, str(source), faults="row_fault").where("row_fault IS NULL OR row_fault <> 'long_row'")
    kept = prepare_items(plain.drop("row_fault"))
    ids = entity_ids(kept)
    assert rows(read_batches(spark, target, "items")) == rows(kept)
    rejects = rejected_items(raw).drop("row_fault")
    got = read_batches(spark, target, "rejects")
    assert rows(got.select(*rejects.columns)) == rows(rejects)
    assert rows(read_batches(spark, target, "ids")) == rows(ids)
    assert rows(read_batches(spark, target, "entities")) == rows(prune_entities(entities(), ids))
    counts = [entry["counts"] for entry in batches.committed(spark, target).values()]
    assert sum(c.get("rows", 0) for c in counts) == raw.count() == kept.count() + rejects.count()
    assert sum(c.get("kept", 0) for c in counts) == kept.count()


def test_equals_the_batch_result_after_every_batch(spark, tmp_path, entities):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    for n in range(len(FILES)):
        drop(source, n)
        prepare_stream(spark, str(source), entities, target, checkpoint).awaitTermination()
        agrees(spark, source, target, entities)
    assert len(batches.committed(spark, target)) == 3
    # Nothing new: nothing is done.
    prepare_stream(spark, str(source), entities, target, checkpoint).awaitTermination()
    agrees(spark, source, target, entities)


def test_a_backlog_in_several_batches(spark, tmp_path, entities):
    source, target = tmp_path / "in", str(tmp_path / "out")
    for n in range(len(FILES)):
        drop(source, n)
    prepare_stream(spark, str(source), entities, target, str(tmp_path / "cp"), files_per_batch=1).awaitTermination()
    assert len(batches.committed(spark, target)) == 3
    agrees(spark, source, target, entities)


def test_a_restart_in_the_middle_of_a_batch(spark, tmp_path, entities):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    drop(source, 0)
    prepare_stream(spark, str(source), entities, target, checkpoint).awaitTermination()
    drop(source, 1)
    lost = lambda: entities().withColumn("name", F.raise_error("lost").cast("string"))
    with pytest.raises(Exception, match="lost"):
        prepare_stream(spark, str(source), lost, target, checkpoint).awaitTermination()
    # Items and rejects had been written by then; none of it is seen.
    assert len(batches.committed(spark, target)) == 1 and len(os.listdir(target)) == 2
    os.makedirs(f"{target}/b-9-dead")
    prepare_stream(spark, str(source), entities, target, checkpoint).awaitTermination()
    agrees(spark, source, target, entities)
    assert batches.clear_failed_batches(spark, target) == []
    assert batches.clear_failed_batches(spark, target, -1) == [f"{target}/b-9-dead"]
    agrees(spark, source, target, entities)


def test_a_batch_run_again_after_it_was_whole(spark, tmp_path, entities, monkeypatch):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    drop(source, 0)
    put = batches.files.put_if_absent

    def put_and_die(*args):
        put(*args)
        raise RuntimeError("died after the entry")

    monkeypatch.setattr(batches.files, "put_if_absent", put_and_die)
    with pytest.raises(Exception, match="died after the entry"):
        prepare_stream(spark, str(source), entities, target, checkpoint).awaitTermination()
    monkeypatch.undo()
    prepare_stream(spark, str(source), entities, target, checkpoint).awaitTermination()
    assert len(batches.committed(spark, target)) == 1
    agrees(spark, source, target, entities)


def test_an_open_quote_fails_the_batch(spark, tmp_path, entities):
    source, target = tmp_path / "in", str(tmp_path / "out")
    drop(source, 0)
    (source / "f0.csv").write_text(HEADER + 't1,"open,70000,[],,\nt2,x,70000,[],,\n')
    with pytest.raises(Exception, match="never closed"):
        prepare_stream(spark, str(source), entities, target, str(tmp_path / "cp")).awaitTermination()
    assert batches.committed(spark, target) == {} and read_batches(spark, target, "items") is None
