"""Rejected lines go to the quarantine, whole and with a reason."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql.types import _parse_datatype_string

from martlet.sources.quarantine import parse_csv, split_csv

SCHEMA = "a long, b string, c date, d decimal(6,2)"


def _split(spark, folder, *files):
    folder.mkdir()
    for i, text in enumerate(files):
        (folder / f"{i}.csv").write_text(text)
    good, rejected = split_csv(spark, str(folder), _parse_datatype_string(SCHEMA))
    return (
        sorted(map(tuple, good.collect()), key=str),
        sorted((r._line, r._reason, r._file.rsplit("/", 1)[1]) for r in rejected.collect()),
    )


def test_rows_and_reasons(spark, tmp_path):
    one = 'h,h,h,h\n1,x,2020-01-02,1.5\n\n2,"a,""b"",c",,\nthree,x,2020-01-02,1\n4,x\n5,"x,y",2020-01-02,1,extra\n'
    two = "other,names,of,columns\n6,,2020-02-30,12345678\n7,\"\",2020-02-29,\\N\n   \n,,,\n"
    good, rejected = _split(spark, tmp_path / "t", one, two)
    assert good == sorted([
        (1, "x", dt.date(2020, 1, 2), Decimal("1.50")),
        (2, 'a,"b",c', None, None),
        (7, "", dt.date(2020, 2, 29), None),
        (None, None, None, None),
    ], key=str)
    assert rejected == [
        ('4,x', "too few fields", "0.csv"),
        ('5,"x,y",2020-01-02,1,extra', "too many fields", "0.csv"),
        ("6,,2020-02-30,12345678", "type of c, d", "1.csv"),
        ("three,x,2020-01-02,1", "type of a", "0.csv"),
    ]


def test_long_lines_and_odd_characters(spark, tmp_path):
    long_text = "é\U0001f600" * 100_000
    text = f'h,h,h,h\n1,"{long_text}",,\n2,\t \'#,,\n#3,x,,\nx,{long_text},,\n8,{"," * 5000}\n'
    good, rejected = _split(spark, tmp_path / "t", text)
    assert good == sorted([(1, long_text, None, None), (2, "\t '#", None, None)], key=str)
    assert [(len(line), why) for line, why, _ in rejected] == [
        (6, "type of a"), (5002, "too many fields"), (len(long_text) + 4, "type of a")
    ]


def test_header_alone(spark, tmp_path):
    assert _split(spark, tmp_path / "t", "h,h,h,h\n") == ([], [])


def test_each_field_is_typed_once(spark, tmp_path):
    (tmp_path / "0.csv").write_text("h,h,h,h\n1,x,2020-01-02,1.5\n")
    plan = parse_csv(spark, str(tmp_path), _parse_datatype_string(SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("try_cast(") == 3
