"""Perspective rotation against a direct rendering."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from martlet.llm import chat
from martlet.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    (1, 0, "Ann", "hi"), (1, 1, "Bob ", "yo"), (1, 2, "ann", None), (1, 3, "System", "note"), (1, None, None, "first <|end|>"),
    (1, 1, "bob", "yo"), (2, 0, "system", "alone"), (None, 0, "x|>y", "no id"), (None, 1, "", "é😀"), (3, 5, "a", "w " * 40_000),
]


def brute(rows, chunk):
    def clean(role):
        role = "unknown" if role is None else role.strip().lower()
        return (role or "unknown").replace("|>", "| >")

    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, clean(role), (text or "").replace("<|", "< |")))
    out = []
    for conv, turns in by.items():
        turns.sort()
        for speaker in {t[2] for t in turns} - {"system"}:
            for c in range(0, len(turns), chunk):
                text, spans = "", []
                for _, _, role, said in turns[c : c + chunk]:
                    text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == speaker else f"<|user name={role}|>\n"
                    start = len(text)
                    text += said + "<|end|>\n"
                    if role == speaker:
                        spans.append((start, len(text)))
                out.append((conv, speaker, c // chunk, len(turns[c : c + chunk]), text, spans))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.conv_id, r.speaker, r.chunk, r.turns, r.text, [tuple(s) for s in r.loss_spans]) for r in df.collect()), key=str)


def test_odd_rows_and_chunks(spark):
    df = spark.createDataFrame([(*r, 1, "z") for r in ODD], "conv_id long, turn long, role string, text string, at int, chunk string")
    for chunk in (2, 256):
        assert rows_of(chat.rotate(df.repartition(3), chunk)) == brute(ODD, chunk)
    assert chat.rotate(df.where("false")).count() == 0


def test_long_conversation_is_split(spark):
    rows = [(7, t, f"p{t % 3}", f"t{t}") for t in range(1000)] + [(8, 0, "p0", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.rotate(df.repartition(5))
    assert rows_of(got) == brute(rows, chat.CHUNK_TURNS)
    assert got.agg(F.max("turns")).first()[0] == chat.CHUNK_TURNS


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    want = con.execute(chat.ORACLE_SQL).fetchall()
    got = QUERIES["op5_chat"](spark, SF)
    assert got.columns == ["conv_id", "speaker", "chunk", "turns", "text", "loss_spans"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op5_chat"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
