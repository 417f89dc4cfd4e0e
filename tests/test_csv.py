"""Positional, typed CSV: NULL and the empty text are told apart."""

from __future__ import annotations

import datetime as dt

import pytest

from martlet.sources.files import read_csv, write_csv

SCHEMA = "a long, b string, c date, d string"


def test_round_trip(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(SCHEMA)
    rows = [(1, "x", dt.date(2020, 1, 2), ""), (2, "", None, None), (None, None, None, ' sp "q", é\\'), (4, "a,b", None, "z")]
    write_csv(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path / "t"))
    back = read_csv(spark, str(tmp_path / "t"), schema)
    assert back.dtypes == spark.createDataFrame([], schema).dtypes
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, rows))


def test_fields_of_other_writers(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    (tmp_path / "t.csv").write_text('w,x,y,z\n7,"",2020-01-02,\n8,,,""\n')
    got = read_csv(spark, str(tmp_path / "t.csv"), _parse_datatype_string(SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(7, "", dt.date(2020, 1, 2), None), (8, None, None, "")]


def test_wrong_types_fail_or_are_null(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    (tmp_path / "t.csv").write_text("w,x,y,z\nseven,b,2020-01-02,d\n")
    schema = _parse_datatype_string(SCHEMA)
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "t.csv"), schema).collect()
    assert read_csv(spark, str(tmp_path / "t.csv"), schema, mode="PERMISSIVE").first().a is None
