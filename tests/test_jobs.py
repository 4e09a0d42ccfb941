"""Sources, sinks, batch jobs and the stream, on files."""

import threading
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from refrain.__main__ import main
from refrain.operators.prepare import prepare_items, with_band
from refrain.plans import jobs, views
from refrain.session import scratch_path, shared_dir
from refrain.sinks import load_table, publish, publish_all, write_csv
from refrain.sources import current, read_prepared, read_raw
from refrain.streaming import stream_raw_csv, write_prepared_stream

TRACKS = '''id,name,duration_ms,id_artists,release_date,danceability,popularity
t1,"One, ""two""",70000,"['a1', 'a2']",2020-01-02,0.8,12.7

t2, padded ,60000,['a1'],22/02/1929,0.5,
t3,,70000,['a3'],2020,0.1,1
t4,short,59999,['a3'],2020,0.1,1
t5,numbers,70000,"[1, 2]",2020,0.1,1
t6,raw,7e4,a4,1999,abc,3
t7,cut
t8,not a number,abc,['a3'],2020,0.1,1
'''
ARTISTS = '''id,followers,genres,name
a1,10.0,"['rock', ""children's music""]",A One
a2,,[],A Two
a3,5,[],A Three
a4,7,,A Four
a1,1,[],A One again
'''


@pytest.fixture()
def files(tmp_path):
    (tmp_path / "tracks.csv").write_text(TRACKS, encoding="utf-8")
    (tmp_path / "artists.csv").write_text(ARTISTS, encoding="utf-8")
    return tmp_path


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_read_raw(spark, files):
    df = read_raw(spark, str(files / "tracks.csv"))
    assert set(t for _, t in df.dtypes) == {"string"}
    got = {r["id"]: r for r in df.collect()}
    assert len(got) == 8
    assert got["t1"]["name"] == 'One, "two"' and got["t2"]["name"] == " padded "
    assert got["t2"]["popularity"] == "" and got["t7"]["id_artists"] == ""


def test_read_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_raw(spark, str(tmp_path / "none.csv"))


def test_read_prepared_refuses_ragged_rows(spark, files):
    with pytest.raises(Exception, match="(?i)malformed"):
        read_prepared(spark, str(files / "tracks.csv")).collect()


def test_files_with_other_headers_fail(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name\n1,x\n")
    (folder / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(folder)).collect()


EXACT = [
    ("1", 'a "quoted", b', " lead", "trail "),
    ("2", "", "", ""),
    ("3", "back\\slash", "\\", '"'),
    ("4", "'single'", "#x", "é　"),
]


def test_csv_round_trip_is_exact(spark, tmp_path):
    df = spark.createDataFrame(EXACT, "id string, a string, b string, c string")
    for _ in range(2):
        write_csv(df, str(tmp_path / "out"))
    assert rows(read_raw(spark, str(tmp_path / "out"))) == Counter(EXACT)


def test_csv_round_trip_with_line_breaks(spark, tmp_path):
    data = [*EXACT, ("5", "two\nlines", '\n"\n', "x,\n,y"), ("6", "a\r\nb", "\r", "z")]
    df = spark.createDataFrame(data, "id string, a string, b string, c string")
    write_csv(df, str(tmp_path / "out"))
    assert rows(read_raw(spark, str(tmp_path / "out"), multi_line=True)) == Counter(data)


def test_transform_csv(spark, files, tmp_path):
    target = str(tmp_path / "banded")
    jobs.transform_csv(
        spark, str(files / "tracks.csv"), target, lambda df: with_band(df).select("id", "danceability_level")
    )
    assert read_raw(spark, target).columns == ["id", "danceability_level"]
    got = dict(tuple(r) for r in read_raw(spark, target).collect())
    assert got["t1"] == "High" and got["t6"] == "" and len(got) == 8


def prepared(spark, files, base):
    targets = [str(base / "prepared-tracks"), str(base / "prepared-artists")]
    report = jobs.prepare_catalogue(
        spark, str(files / "tracks.csv"), str(files / "artists.csv"), *targets, fmt="csv"
    )
    return report, targets


def test_parquet_between_the_jobs(spark, files, tmp_path):
    sources = [str(files / "tracks.csv"), str(files / "artists.csv")]
    hops = [[str(tmp_path / step / name) for name in ("t", "a")] for step in ("p", "u")]
    rejects = str(tmp_path / "rejects")
    report = jobs.prepare_catalogue(
        spark, *sources, *hops[0], fmt="parquet", rejects_target=rejects
    )
    assert (report.kept, report.entities) == (3, 4)
    assert report.rows == report.kept + 5
    reasons = spark.read.parquet(current(spark, rejects)).select("id", "reject_reason")
    assert dict(tuple(r) for r in reasons.collect()) == {
        "t3": "no_name", "t4": "too_small", "t5": "bad_list", "t7": "too_small",
        "t8": "bad_number",
    }
    jobs.publish_catalogue(spark, *hops[0], *hops[1], fmt="parquet")
    names = ("parquet_tracks", "parquet_artists")
    reports = jobs.load_catalogue(spark, *hops[1], *names, on_bad="null", fmt="parquet")
    assert [r.rows for r in reports] == [3, 4]
    lists = {r["id"]: r["id_artists"] for r in spark.table(names[0]).collect()}
    assert lists == {"t1": ["a1", "a2"], "t2": ["a1"], "t6": None}
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_prepare_publish_load_and_query(spark, files, tmp_path):
    report, targets = prepared(spark, files, tmp_path)
    assert report == jobs.PrepareReport(
        rows=8, kept=3, long_row=0, no_name=1, bad_number=1, too_small=2, bad_list=1,
        raw_lists=1, short_rows=1, entities=4,
    )
    tracks = read_raw(spark, targets[0])
    assert tracks.columns == [
        "id", "name", "duration_ms", "id_artists", "release_date", "danceability",
        "popularity", "release_year", "release_month", "release_day", "danceability_level",
    ]
    assert rows(tracks.drop("duration_ms", "release_date", "danceability")) == Counter([
        ("t1", 'One, "two"', "['a1', 'a2']", "12.7", "2020", "01", "02", "High"),
        ("t2", " padded ", "['a1']", "", "1929", "02", "22", "Medium"),
        ("t6", "raw", "a4", "3", "1999", "", "", ""),
    ])
    assert {r["name"] for r in read_raw(spark, targets[1]).collect()} == {
        "A One", "A Two", "A Four", "A One again"
    }

    uris = [str(tmp_path / "public" / "tracks"), str(tmp_path / "public" / "artists")]
    jobs.publish_catalogue(spark, *targets, *uris, prepared_fmt="csv")
    assert rows(read_raw(spark, uris[0])) == rows(tracks)

    # The raw id of t6 is no array literal, so a strict load stops at the first table.
    with pytest.raises(Exception, match="malformed list text"):
        jobs.load_catalogue(spark, *uris)
    assert not spark.catalog.tableExists("artists")
    for _ in range(2):
        reports = jobs.load_catalogue(spark, *uris, on_bad="null")
        assert [(r.table, r.rows) for r in reports] == [("tracks", 3), ("artists", 4)]
    loaded = spark.table("tracks")
    assert dict(loaded.dtypes)["id_artists"] == "array<string>"
    by_id = {r["id"]: r for r in loaded.collect()}
    assert by_id["t1"]["popularity"] == 12 and by_id["t2"]["popularity"] is None
    assert by_id["t1"]["release_month"] == 1 and by_id["t6"]["release_month"] is None
    assert by_id["t6"]["duration_ms"] == 7 and by_id["t6"]["danceability_level"] is None
    assert by_id["t1"]["id_artists"] == ["a1", "a2"] and by_id["t6"]["id_artists"] is None
    genres = {r["name"]: r["genres"] for r in spark.table("artists").collect()}
    assert genres["A One"] == ["rock", "childrens music"] and genres["A Four"] is None
    spark.sql("ALTER TABLE tracks ADD COLUMN energy DOUBLE")
    views.create_views(spark)
    sums = {
        r["track_id"]: r["artist_followers"] for r in spark.table(views.SUMMARY_VIEW).collect()
    }
    assert sums == {"t1": 11, "t2": 11, "t6": 0}
    for name in (views.SUMMARY_VIEW, views.TOP_VIEW, views.PAIRS_VIEW):
        spark.catalog.dropTempView(name)
    spark.sql("DROP TABLE tracks")
    spark.sql("DROP TABLE artists")


def test_second_step_is_not_begun_after_a_failure(spark, files, tmp_path):
    target = tmp_path / "never"
    with pytest.raises(AnalysisException):
        jobs.prepare_catalogue(
            spark, str(tmp_path / "none.csv"), str(files / "artists.csv"),
            str(tmp_path / "t"), str(target),
        )
    assert not target.exists()


def test_load_types_by_name(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("name,id,tempo,colour\nFirst,q9,118.5 bpm,red\nLast,q8,,\n")
    report = load_table(read_prepared(spark, str(path)), "test_table")
    assert report.loaded and report.rows == 2
    table = spark.table("test_table")
    assert table.dtypes == [("name", "string"), ("id", "string"), ("tempo", "double"), ("colour", "string")]
    assert rows(table) == Counter([("First", "q9", 118.5, "red"), ("Last", "q8", None, None)])
    spark.sql("DROP TABLE test_table")


@pytest.mark.parametrize("text", ["", "id,name\n", "id,extra\n"])
def test_load_of_nothing(spark, tmp_path, text, caplog):
    path = tmp_path / "x.csv"
    path.write_text(text)
    report = load_table(read_prepared(spark, str(path)), "empty_table")
    assert not report.loaded and "CSV file for empty_table is empty." in caplog.text
    assert not spark.catalog.tableExists("empty_table")


def test_load_without_required_column(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("id,extra\n1,abc\n")
    with pytest.raises(ValueError, match='Missing required CSV headers for table "t": name'):
        load_table(read_prepared(spark, str(path)), "t")


def test_load_append_and_overwrite(spark):
    df = spark.createDataFrame([("1", "x", "5")], "id string, name string, popularity string")
    reordered = df.select("popularity", "name", "id")
    load_table(df, "copies", mode="append")
    load_table(reordered, "copies", mode="append")
    assert rows(spark.table("copies")) == Counter({("1", "x", 5): 2})
    with pytest.raises(AnalysisException):
        load_table(df.withColumn("extra", F.lit("e")), "copies", mode="append")
    load_table(df, "copies")
    assert rows(spark.table("copies")) == Counter({("1", "x", 5): 1})
    spark.sql("DROP TABLE copies")


def test_publish_retries_then_raises(spark):
    df = spark.range(1)
    calls = []

    def failing(times):
        def write(_, uri):
            calls.append(uri)
            if len(calls) <= times:
                raise OSError("store is down")

        return write

    publish(df, "u", attempts=3, write=failing(2))
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(OSError):
        publish(df, "u", attempts=2, write=failing(9))
    assert len(calls) == 2


def test_publish_all_runs_side_by_side_and_finishes_all(spark, tmp_path, monkeypatch):
    both = threading.Barrier(2, timeout=60)
    good = str(tmp_path / "good")

    def write(df, uri):
        both.wait()
        if uri == "bad":
            raise OSError("store is down")
        write_csv(df, uri)

    monkeypatch.setitem(publish_all.__globals__["WRITERS"], "csv", write)
    df = spark.createDataFrame([("1",)], "id string")
    with pytest.raises(OSError):
        publish_all({"bad": df, good: df}, attempts=1)
    assert rows(read_raw(spark, good)) == Counter([("1",)])


def test_stream_equals_batch_and_takes_up_new_files(spark, files, tmp_path):
    folder = tmp_path / "arriving"
    folder.mkdir()
    (folder / "1.csv").write_text(TRACKS, encoding="utf-8")
    columns = read_raw(spark, str(folder)).columns
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        raw = stream_raw_csv(spark, str(folder), columns, files_per_batch=1)
        write_prepared_stream(raw, out, checkpoint).awaitTermination()

    run()
    expected = prepare_items(read_raw(spark, str(folder)))
    assert rows(spark.read.parquet(out)) == rows(expected)
    run()
    assert spark.read.parquet(out).count() == 3
    (folder / "2.csv").write_text(TRACKS, encoding="utf-8")
    run()
    assert rows(spark.read.parquet(out)) == rows(prepare_items(read_raw(spark, str(folder))))


def test_scratch_is_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert scratch_path(spark, "x").startswith(named + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_nothing_survives(spark, files, tmp_path, fmt):
    sources = [str(files / "tracks.csv"), str(files / "artists.csv")]
    targets = [str(tmp_path / "t"), str(tmp_path / "a")]
    report = jobs.prepare_catalogue(spark, *sources, *targets, min_duration=10**9, fmt=fmt)
    assert (report.rows, report.kept, report.entities) == (8, 0, 0)
    reports = jobs.load_catalogue(spark, *targets, "none_t", "none_a", fmt=fmt)
    assert not any(r.loaded for r in reports)
    assert not spark.catalog.tableExists("none_t")


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    conf = SimpleNamespace(get=lambda key, default: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=context))


# --- nothing is lost ---------------------------------------------------------


def people(spark, *data):
    return spark.createDataFrame(list(data), "id string, name string, followers string")


def test_a_failed_load_leaves_the_table_and_its_views(spark):
    good = people(spark, ("a", "A", "1"), ("b", "B", "2"))
    load_table(good, "kept_rows")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW kept_view AS SELECT id FROM kept_rows")
    with pytest.raises(Exception, match="out of range"):
        load_table(people(spark, ("c", "C", "99999999999")), "kept_rows")
    assert rows(spark.table("kept_rows")) == Counter([("a", "A", 1), ("b", "B", 2)])
    load_table(people(spark, ("d", "D", "4")), "kept_rows")
    assert rows(spark.table("kept_view")) == Counter([("d",)])
    load_table(people(spark, ("e", "E", "5")).withColumn("more", F.lit("x")), "kept_rows")
    assert rows(spark.table("kept_view")) == Counter([("e",)])
    spark.catalog.dropTempView("kept_view")
    spark.sql("DROP TABLE kept_rows")


def failing(df):
    bad = F.when(F.col("id") == "b", F.raise_error("lost").cast("string")).otherwise(F.col("id"))
    return df.withColumn("id", bad)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_failed_publication_leaves_the_old_dataset(spark, tmp_path, fmt):
    uri, df = str(tmp_path / "d"), people(spark, ("a", "A", "1"), ("b", "B", ""))
    publish(df, uri, fmt)
    with pytest.raises(Exception, match="lost"):
        publish(failing(df), uri, fmt, attempts=2)

    def read():
        return read_raw(spark, uri) if fmt == "csv" else spark.read.parquet(current(spark, uri))

    assert rows(read()) == rows(df)
    publish(read().filter("id = 'a'"), uri, fmt)  # onto its own source
    assert rows(read()) == Counter([("a", "A", "1")])


def test_a_failed_prepare_leaves_the_old_targets(spark, files, tmp_path):
    targets = [str(tmp_path / "p1"), str(tmp_path / "p2")]
    sources = [str(files / "tracks.csv"), str(files / "artists.csv")]
    jobs.prepare_catalogue(spark, *sources, *targets)
    before = [rows(spark.read.parquet(current(spark, t))) for t in targets]
    (files / "tracks.csv").write_text(TRACKS + 't9,"open,70000,[],,,\n')
    with pytest.raises(Exception, match="never closed"):
        jobs.prepare_catalogue(spark, *sources, *targets)
    assert [rows(spark.read.parquet(current(spark, t))) for t in targets] == before


def test_rows_of_the_wrong_length(spark, files, tmp_path):
    (files / "tracks.csv").write_text(TRACKS + "u1,long,70000,[],,0.1,1,extra\nu2,x,80000\n")
    with pytest.raises(Exception, match="more fields than the header"):
        read_raw(spark, str(files / "tracks.csv")).collect()
    rejects, raw_lists = str(tmp_path / "rejects"), str(tmp_path / "raw")
    report = jobs.prepare_catalogue(
        spark, str(files / "tracks.csv"), str(files / "artists.csv"), str(tmp_path / "t"),
        str(tmp_path / "a"), rejects_target=rejects, raw_lists_target=raw_lists,
    )
    assert (report.rows, report.kept, report.long_row, report.short_rows) == (10, 4, 1, 2)
    found = spark.read.parquet(current(spark, rejects)).select("id", "reject_reason")
    assert ("u1", "long_row") in rows(found) and found.count() == report.rows - report.kept
    assert [r["id"] for r in spark.read.parquet(current(spark, raw_lists)).collect()] == ["t6"]


def test_a_line_break_in_quotes(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('id,name\n1,"two\nlines"\n2,b\n')
    with pytest.raises(Exception, match="multi_line=True"):
        read_raw(spark, str(path), multi_line=False).collect()
    for read in (read_raw, read_prepared):
        assert rows(read(spark, str(path))) == Counter([("1", "two\nlines"), ("2", "b")])


def test_blank_values_of_one_column(spark, tmp_path):
    data = Counter([("a",), ("",), ("",), (" ",)])
    write_csv(spark.createDataFrame(list(data.elements()), "x string").coalesce(1), str(tmp_path / "one"))
    assert rows(read_raw(spark, str(tmp_path / "one"))) == data


def test_empty_files(spark, files, tmp_path):
    (files / "tracks.csv").write_text("")
    report = jobs.prepare_catalogue(
        spark, str(files / "tracks.csv"), str(files / "artists.csv"), str(tmp_path / "t"), str(tmp_path / "a")
    )
    assert (report.rows, report.kept, report.entities) == (0, 0, 0)
    (files / "tracks.csv").write_text(TRACKS)
    (files / "artists.csv").write_text("")
    report = jobs.prepare_catalogue(
        spark, str(files / "tracks.csv"), str(files / "artists.csv"), str(tmp_path / "t"), str(tmp_path / "a")
    )
    assert (report.kept, report.entities) == (3, 0)


def test_jobs_from_the_command_line(spark, files, tmp_path, capsys):
    names = [str(tmp_path / n) for n in ("t", "a", "pt", "pa")]
    main(["prepare", str(files / "tracks.csv"), str(files / "artists.csv"), *names[:2], "--min-duration", "65000"], spark)
    main(["publish", *names], spark)
    main(["load", *names[2:], "--on-bad", "null", "--items-table", "cli_t", "--entities-table", "cli_a"], spark)
    out = capsys.readouterr().out
    assert '"kept": 2' in out and '"table": "cli_a"' in out
    assert {r["id"] for r in spark.table("cli_t").collect()} == {"t1", "t6"}
    spark.sql("DROP TABLE cli_t")
    spark.sql("DROP TABLE cli_a")
