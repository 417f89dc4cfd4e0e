"""Token files and packing against the plain tokenizer."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from martlet.llm import packing, token_files, tokens
from martlet.llm.catalog import QUERIES
from martlet.llm.common import scratch, table

SF = "/root/testdata/sf0.001"
ODD = [
    (7, "Plain words, here."), (3, None), (1, ""), (None, "no id"), (3, "same id"), (3, "same id"),
    (9, "  tabs\tand\x1cseparators nbsp line  "), (10, "don't we'll 'S İstanbul ΣΑΣ ﬁ Å é 日本語 12345"),
    (11, "<|endoftext|> a<|startoftext|>b"), (12, "x" * 5000 + " " + "word " * 9000), (13, "ÀÉÎ×÷µªº ßtraße—ok…"),
    (14, "\n\n"), (15, "naïve, (coöp) `quoted` a'b c-d"),
]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_docs(spark):
    rows = [(i, t, "clash", 5, 6) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, part string, first int, token_ids int")


def expected(rows, plain):
    out, start = [], 0
    for i, t in rows:
        ids = plain(t)
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_words_join_to_the_text_ids(spark, plain):
    ids_of = tokens.encoder(tokens.tokenizer_path(), 1)
    texts = [t or "" for _, t in ODD] + [r.text for r in table(spark, SF, "documents").collect()]
    for text in texts:
        assert np.frombuffer(ids_of(text), "<u4").tolist() == plain(text)


def test_token_files_query(spark, plain):
    rows = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    got = QUERIES["op2_token_files"](spark, SF).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == expected(rows, plain)


def test_token_files_odd_rows(spark, plain):
    path = scratch(spark, "t")
    token_files.write_token_files(odd_docs(spark).repartition(3), path, tokens.tokenizer_path(), row_group_bytes=4096)
    got = token_files.token_digests(spark, path).collect()
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts])[:-1].tolist()]
    key = lambda x: (x is not None, x)
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted([i for i, _ in ODD], key=key)
    want = sorted((i or -1, len(plain(t)), crc(plain(t))) for i, t in ODD)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == want
    some = token_files.read_token_files(spark, path, 9, 11).select("doc_id").collect()
    assert sorted(r.doc_id for r in some) == [9, 10, 11]


def test_token_file_format(spark):
    import glob

    import pyarrow.parquet as pq

    path = scratch(spark, "t")
    token_files.write_token_files(table(spark, SF, "documents"), path, tokens.tokenizer_path())
    for f in glob.glob(path.removeprefix("file:") + "/part-*"):
        columns = {c["path_in_schema"]: c for g in [pq.ParquetFile(f).metadata.row_group(0)]
                   for c in (g.column(i).to_dict() for i in range(g.num_columns))}
        assert any("DICTIONARY" in e for e in columns["token_ids.list.element"]["encodings"])
        assert "DELTA_BINARY_PACKED" in columns["doc_id"]["encodings"]
        group = pq.ParquetFile(f).metadata.row_group(0).column(0)
        assert group.has_offset_index and group.has_column_index


def check_pieces(got, docs, plain, window=2048):
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window or at & (at - 1) == 0
    assert sum(r.length for r in got) == sum(len(plain(t)) for _, t in docs)
    return pieces


def test_packing_query(spark, plain):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = QUERIES["op3_packing"](spark, SF).collect()
    pieces = check_pieces(got, docs, plain)
    for doc_id, text in docs:
        ids, at = plain(text), 0
        for r in sorted(pieces[(doc_id, len(ids))], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)


def test_packing_odd_rows_and_small_windows(spark, plain):
    got = packing.pack(odd_docs(spark).coalesce(1), tokens.tokenizer_path(), window=64).collect()
    check_pieces(got, ODD, plain, window=64)
    empty = odd_docs(spark).where("false")
    assert packing.pack(empty, tokens.tokenizer_path()).count() == 0
    path = scratch(spark, "t")
    token_files.write_token_files(empty, path, tokens.tokenizer_path())
    assert token_files.token_digests(spark, path).count() == 0


def test_level_choice_is_the_brute_force_minimum():
    rng = np.random.default_rng(3)
    for _ in range(200):
        packer = packing.SumOfSquaresPacker(16, lambda p: None)
        packer.counts[1:16] = rng.integers(0, 4, 15)
        size = int(rng.integers(1, 16))

        def cost(level):
            n = packer.counts.copy()
            if level:
                n[level] -= 1
            if level + size < 16:
                n[level + size] += 1
            return int((n[1:16] ** 2).sum())

        levels = [h for h in range(16 - size + 1) if h == 0 or packer.counts[h]]
        assert cost(packer.level_for(size)) == min(map(cost, levels))


def test_recut_bounds_open_windows():
    out = []
    packer = packing.SumOfSquaresPacker(100, out.append, max_open=5)
    for i in range(300):
        packer.add((i, 0, b"\0\0\0\0" * (1 + i * 37 % 99), 1 + i * 37 % 99))
        assert packer.n_open < 5
    packer.recut(last=True)
    assert sum(len(p[2]) // 4 for w in out for p in w) == sum(1 + i * 37 % 99 for i in range(300))


def test_word_generations_change_no_ids(monkeypatch):
    texts = [f"word{i % 37} other{i} Café naïve{i % 5}! {'x' * 60}{i}" for i in range(300)]
    path = tokens.tokenizer_path()
    want = [tokens._WordIds(path).encoded(w) for t in texts for w in t.split(" ")]
    monkeypatch.setattr(tokens, "MAX_WORDS", 20)
    words = tokens._WordIds(path)
    assert [words[w] for t in texts for w in t.split(" ")] == want and words[""] == b""
    assert len(words) <= 20 and len(words.old) <= 20
