"""The pipeline, stage by stage, against step-by-step versions."""

from __future__ import annotations

import corpus_pipeline as P
from martlet.llm import packing, toxicity
from martlet.llm.common import table
from tests.llm.test_decontam import brute as leaked
from tests.llm.test_pii import plain_spans
from tests.llm.test_simhash import brute_classes, brute_fingerprint
from tests.llm.test_tokens import check_pieces, plain  # noqa: F401

SF = "/root/testdata/sf0.01"  # the smallest with enough labels to learn from


def test_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "pii", "packing"]


def test_every_stage_takes_effect(spark, plain):  # noqa: F811
    docs = table(spark, SF, "documents")
    columns = docs.columns
    # toxicity
    model = toxicity.fit_on_labels(docs, table(spark, SF, "labels"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    clean = P.toxicity_stage(spark, docs, SF)
    kept = {i: t for i, t in rows.items() if model.score(t or "") < 0.3}
    assert clean.columns == columns and {r.doc_id: r.text for r in clean.collect()} == kept and len(kept) < len(rows)
    # near duplicates
    single = P.near_duplicate_stage(spark, clean, SF)
    items = [(i, brute_fingerprint(t)) for i, t in kept.items()]
    first = set(brute_classes(items))
    assert single.columns == columns and {r.doc_id for r in single.collect()} == first and len(first) < len(kept)
    # benchmark items
    kept = {i: kept[i] for i in first}
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {x[0] for x in leaked(list(kept.items()), bench)}
    apart = P.decontamination_stage(spark, single, SF)
    assert apart.columns == columns and {r.doc_id for r in apart.collect()} == set(kept) - bad
    # personal data
    redacted = P.pii_stage(spark, apart, SF)
    assert redacted.dtypes == apart.dtypes
    out = {r.doc_id: r for r in redacted.collect()}
    assert set(out) == set(kept) - bad
    for i, r in out.items():
        assert not plain_spans(r.text) and r.n_chars == len(r.text)
        if not plain_spans(kept[i]):
            assert len(r.text) >= len(kept[i]) * 0.9
    # packing
    texts = [(i, r.text) for i, r in out.items()]
    pieces = P.packing_stage(spark, redacted, SF)
    assert "token_ids" in pieces.columns and packing.PIECES
    check_pieces(pieces.collect(), texts, plain)


def test_run_and_odd_columns(spark):
    got = P.run(spark, SF)
    assert got.count() > 0 and got.select("doc_id").distinct().count() < 1000
    odd = spark.createDataFrame(
        [(1, None, 5, "a"), (1, "", 5, "a"), (None, "one two three a@b.co", 5, "b"), (2, "one two three four five", 9, "c"),
         (2, "one two three four five", 9, "c")],
        "doc_id long, text string, row int, `odd.name` string",
    )
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns, name
        assert 0 < out.count() <= 5
        assert stage(spark, odd.where("false"), SF).count() == 0
    assert P.near_duplicate_stage(spark, odd, SF).count() == 3
