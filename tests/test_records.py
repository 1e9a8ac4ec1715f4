"""CSV records over several lines and splits, malformed records."""

import csv
import random

import pytest

from strata.sources import records
from strata.sources.files import read_checked_csv, read_raw_csv, write_csv
from strata.streaming.landing import land_folder_now
from strata import fixed

ODD = ["plain", "line one\nline two", 'a "quoted" word', "back\\slash\\", '"', '""', "\n", "a,b", "x\r\ny", "cr\rhere", " lead", '5" pipe',
       '\n\n"\n,"\n', "é\nü", ',"\n', '"\n",', None]


@pytest.fixture()
def small_splits(spark):
    """Files in splits of a few bytes, so that records cross several of them."""
    conf = {"spark.sql.files.maxPartitionBytes": "23b", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(str(i), rng.choice(ODD), rng.choice(ODD), f"end {i}") for i in range(n)]


COLUMNS = ["id", "a", "b", "c"]


def test_round_trip_over_small_splits(spark, tmp_path, small_splits):
    want = rows(60)
    write_csv(spark.createDataFrame(want, "id string, a string, b string, c string").coalesce(2), str(tmp_path / "o"))
    lines = records.text_lines(spark, str(tmp_path / "o"))
    assert records.layout(lines).owners and lines.select("split").distinct().count() > 20
    for df in (read_raw_csv(spark, str(tmp_path / "o"), COLUMNS), read_raw_csv(spark, str(tmp_path / "o"), COLUMNS, line_breaks=True)):
        assert sorted(map(tuple, df.collect()), key=lambda r: int(r[0])) == want
    good, rejected = read_checked_csv(spark, str(tmp_path / "o"), COLUMNS)
    assert sorted(map(tuple, good.collect()), key=lambda r: int(r[0])) == want and rejected.count() == 0


def test_reads_what_a_csv_library_writes(spark, tmp_path, small_splits):
    want = [r for r in rows(40, 2)]
    with open(tmp_path / "t.csv", "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([COLUMNS, *want])        # CRLF line ends
    got = read_raw_csv(spark, str(tmp_path / "t.csv")).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: int(r[0])) == want


def test_line_states_equal_a_csv_library():
    """Where a record ends, by the library's own reader."""
    rng = random.Random(7)
    for _ in range(300):
        record = [rng.choice([v for v in ODD if v]) for _ in range(3)]
        text = ",".join('"' + v.replace('"', '""') + '"' if rng.random() < 0.6 or any(c in v for c in '\n\r,"') else v for v in record)
        assert next(csv.reader([text], strict=False))
        inside = False
        lines = text.split("\n")
        for i, line in enumerate(lines):
            inside = records.ends_inside(line, inside)
            assert inside == (i < len(lines) - 1)


def test_malformed_records_come_apart(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a,b\n1,2,3,4\n5\n"x\ny",z\n\n7,8\n"open, to the end\nof file', encoding="utf-8")
    good, rejected = read_checked_csv(spark, str(tmp_path / "m.csv"), ["a", "b"])
    assert sorted(map(tuple, good.collect())) == [("7", "8"), ("x\ny", "z")]
    assert sorted(r.record for r in rejected.collect()) == ['"open, to the end\nof file', "1,2,3,4", "5"]
    kept = read_raw_csv(spark, str(tmp_path / "m.csv"), ["a", "b"]).collect()
    assert ("1", "2") in [tuple(r) for r in kept] and ("5", None) in [tuple(r) for r in kept]


def test_header_is_checked_in_every_file(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text('a,b\n"x\ny",z\n', encoding="utf-8")
    (tmp_path / "d" / "2.csv").write_text("\na,c\n1,2\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        read_raw_csv(spark, str(tmp_path / "d"), ["a", "b"]).collect()


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n", encoding="utf-8")
    (tmp_path / "e.csv").write_text("", encoding="utf-8")
    for name in ("h.csv", "e.csv"):
        assert read_raw_csv(spark, str(tmp_path / name), ["a", "b"]).count() == 0
        good, rejected = read_checked_csv(spark, str(tmp_path / name), ["a", "b"])
        assert good.count() == rejected.count() == 0


def test_landed_stream_keeps_line_breaks(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text(",".join(fixed.RAW_COLUMNS["orders"]) + '\nO1,C1,2025-01-01,"two\nlines ""here""",1.0\n', encoding="utf-8")
    landed = land_folder_now(spark, str(src), "orders", str(tmp_path / "raw"))
    assert [r.status for r in landed.collect()] == ['two\nlines "here"']
