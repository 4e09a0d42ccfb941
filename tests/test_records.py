"""CSV records with line breaks, in files that are split anywhere."""

import csv
import io
import os
import random
from collections import Counter

import pytest

from refrain.plans import jobs
from refrain.session import shared_dir
from refrain.sources import read_prepared, read_raw, records


@pytest.fixture()
def tiny_splits(spark):
    """Splits of 300 bytes, each read by itself."""
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


CELLS = [
    "", "plain", "a,b", 'a "q" b', "two\nlines", '"', "\n", ",\n,", 'x","y', "\r\n", "é\n", "a\r", " ",
    # A quoted field that reads like rows of the file.
    "1,2,3\n4,5,6\n", '"\n"', "long " * 30 + "\n" + "text, " * 40,
]


def written(rng, path, n, ends="\n", always=False):
    rows = [[str(i), rng.choice(CELLS), rng.choice(CELLS)] for i in range(n)]
    out = io.StringIO(newline="")
    quoting = csv.QUOTE_ALL if always else csv.QUOTE_MINIMAL
    csv.writer(out, lineterminator=ends, quoting=quoting).writerows([["id", "a", "b"], *rows])
    path.write_bytes(out.getvalue().encode())
    return rows


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("ends,always", [("\n", False), ("\r\n", False), ("\n", True)])
def test_records_across_splits(spark, tmp_path, tiny_splits, ends, always):
    rng = random.Random(len(ends) + always)
    folder = tmp_path / "raw"
    folder.mkdir()
    want = [r for i in range(2) for r in written(rng, folder / f"{i}.csv", 60, ends, always)]
    got = read_raw(spark, str(folder))
    assert rows(got) == Counter(map(tuple, want))
    assert rows(read_prepared(spark, str(folder))) == Counter(map(tuple, want))


@pytest.mark.parametrize("guess", [True, False])
def test_wrong_beginnings_are_found_and_read_again(spark, tmp_path, tiny_splits, monkeypatch, guess):
    want = written(random.Random(9), tmp_path / "x.csv", 50)
    path = str(tmp_path / "x.csv")
    inside = records._true_beginnings(spark, path)
    data = (tmp_path / "x.csv").read_bytes()
    starts = records._lines(spark, path).select("file", "start").distinct().collect()
    assert len(starts) > 4
    for file, start in starts:
        # A split begins with the first line that begins in it.
        at = data.find(b"\n", start - 1) + 1 if start else 0
        assert ((file, start) in inside) == (data[:at].count(b'"') % 2 == 1)
    seen = []

    def scanned(spark, path, columns, begins, scan=records._scan):
        seen.append(begins)
        first = len(seen) == 1
        return scan(spark, path, columns, (lambda file, start: guess) if first else begins)

    monkeypatch.setattr(records, "_scan", scanned)
    assert rows(read_raw(spark, path)) == Counter(map(tuple, want))
    assert len(seen) == 2


def test_one_scan_by_many_tasks(spark, tmp_path, tiny_splits, monkeypatch):
    written(random.Random(4), tmp_path / "x.csv", 60)
    scans = []
    lines = records._lines
    monkeypatch.setattr(records, "_lines", lambda *a: scans.append(lines(*a)) or scans[-1])
    got = read_raw(spark, str(tmp_path / "x.csv"))
    assert len(scans) == 1
    assert scans[0].rdd.getNumPartitions() > 4
    assert "FileScan text" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_field_over_many_splits(spark, tmp_path, tiny_splits):
    text = "\n".join(f"line {i}, \"\"{i}\"\"" for i in range(100))
    (tmp_path / "x.csv").write_text(f'id,a\n1,"{text}"\n2,b\n')
    want = Counter([("1", text.replace('""', '"')), ("2", "b")])
    assert rows(read_raw(spark, str(tmp_path / "x.csv"))) == want


def test_a_line_longer_than_splits(spark, tmp_path, tiny_splits):
    (tmp_path / "x.csv").write_text(f"id,a\n1,{'x' * 2000}\n2,b\n")
    assert rows(read_raw(spark, str(tmp_path / "x.csv"))) == Counter([("1", "x" * 2000), ("2", "b")])


def test_stray_quotes_are_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,a\n1,5" disk\n2,x "y\n3,"z"\n')
    want = Counter([("1", '5" disk'), ("2", 'x "y'), ("3", "z")])
    assert rows(read_raw(spark, str(tmp_path / "x.csv"))) == want


def test_the_walk_and_the_expression_agree():
    rng = random.Random(2)
    for _ in range(20_000):
        line = bytes(rng.choice(b'"",,ab\r') for _ in range(rng.randint(0, 9)))
        array = records.pa.array([line], records.pa.binary())
        whole = records.pc.match_substring_regex(array, records._WHOLE)[0].as_py()
        assert whole == (not records.ends_inside(line, False)), line


def test_columns_with_names_of_helpers(spark, tmp_path):
    (tmp_path / "x.csv").write_text('split,_record,record\n1,"a\nb",c\n')
    assert rows(read_raw(spark, str(tmp_path / "x.csv"))) == Counter([("1", "a\nb", "c")])
    got = read_raw(spark, str(tmp_path / "x.csv"), faults="row_fault")
    assert got.columns == ["split", "_record", "record", "row_fault"]


def test_rows_of_another_width_across_splits(spark, tmp_path, tiny_splits):
    text = "word\n" * 150
    (tmp_path / "x.csv").write_text(f'id,a\n1,"{text}",more\n2\n3,c\n')
    got = read_raw(spark, str(tmp_path / "x.csv"), faults="fault").collect()
    assert sorted((r.id, r.fault or "") for r in got) == [("1", "long_row"), ("2", "short_row"), ("3", "")]
    with pytest.raises(Exception, match="more fields"):
        read_raw(spark, str(tmp_path / "x.csv")).collect()
    with pytest.raises(Exception, match="malformed"):
        read_prepared(spark, str(tmp_path / "x.csv")).collect()


def test_jobs_leave_no_scratch(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,name,duration_ms,id_artists\nt1,"One\nmore",70000,"[\'a\']"\n')
    (tmp_path / "a.csv").write_text("id,name\na,\"A\n\"\nb,B\n")
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    targets = [str(tmp_path / n) for n in ("pt", "pa")]
    report = jobs.prepare_catalogue(spark, str(tmp_path / "t.csv"), str(tmp_path / "a.csv"), *targets)
    assert (report.kept, report.entities) == (1, 1)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.prepare_catalogue(spark, str(tmp_path / "t.csv"), str(tmp_path / "none.csv"), *targets)
    assert set(os.listdir(folder)) == before
