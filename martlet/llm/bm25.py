"""Exact BM25 top-k over an inverted index, frequent terms as matrix products.

``build_index`` cuts the documents of every input split into shards of at most
``shard_postings`` postings and writes them to the shared folder. Document
frequencies, the document count and the mean length are taken over all shards.
``search`` deals (group of shards, block of queries) pairs to tasks. A task
reads its shards one after the other, inverts ``BLOCK_DOCS`` documents at a time
and scores them roughly for all its queries, those with the same frequent terms
together: terms that many of their pairs of query and document have by a product
of two 32-bit matrices, the others by adding up their postings. Scores of terms
are positive, so the error of a rough score is at most a known share of it;
documents that it lets reach the k-th best score so far, over all shards the
task has seen, are evaluated in full. That test never rejects a top-k document,
so merging the groups' lists gives the exact result, and their number for a
query does not grow with the shards. The work is still queries x documents.

Terms are words of letters and digits, lower-cased, each counted once in a
query; they are kept as 64-bit hashes, whose collisions would merge two terms
(about V * V / 2**65 expected for V terms). score = sum of idf * tf * (k1 + 1) /
(tf + k1 * (1 - b + b * length / mean length)), idf = ln(1 + (N - df + 0.5) /
(df + 0.5)); equal scores rank by ``doc_id``.

Defined cases: a null text is empty, counts as a document of length 0, is found
by no query and finds nothing; a null id is never a query and ranks last among
equal scores; rows that share an id are documents of their own; query rows that
share an id and a text are one query, those that share only an id are told
apart by ``query_tie``; fewer than k documents with a common term give fewer
rows; an empty table gives none. Texts are read whole. Other columns are not
read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.llm.common import documents, scratch
from martlet.llm.warc import file_system

WORD = re.compile(r"[^\W_]+")
#: Of ASCII characters those of words, lower-cased; the others are blanks.
ASCII_WORDS = "".join(c.lower() if WORD.fullmatch(c) else " " for c in map(chr, range(128)))
K1, B = 1.2, 0.75
#: Documents that are scored together.
BLOCK_DOCS = 8_192
SHARD_POSTINGS = 4_000_000
#: Queries for which a task reads its shards once; fewer where that would leave fewer than
#: LEAST_BLOCKS blocks, but no less than LEAST_QUERIES, for which terms are looked up at a time.
QUERY_BLOCK, LEAST_BLOCKS, LEAST_QUERIES = 16_384, 2, 512
#: Each group of shards is one task for a block of queries and gives one list of k for a query. There
#: are this many groups, or fewer if that is enough for TASKS_A_CORE tasks: each group starts without
#: k-th best scores.
SHARD_GROUPS, TASKS_A_CORE = 8, 3
#: Search tasks at most; each then takes several pairs of shard group and query block.
MAX_TASKS = 20_000
#: Terms in a larger share of a block's documents can be multiplied as a matrix; they are, for some
#: queries, if more than a share WORTH of their pairs of query and document have the term.
FREQUENT, WORTH = 1 / 32, 1 / 150
#: Otherwise postings are added up: those of terms in more than this share of the documents are joined
#: as whole lists, the others picked one by one.
LISTED = 1 / 256
#: Queries are put in ALIKE groups by their ALIKE_TERMS most frequent terms.
ALIKE, ALIKE_TERMS = 8, 256
MATRIX_TERMS, MATRIX_CELLS = 4_096, 16_000_000
#: Queries that are multiplied, and postings of the rarest terms that are picked, at a time.
SCORED_QUERIES, SCORED_POSTINGS = 512, 1_000_000
POSTINGS = "doc_id long, tie long, length int, terms array<bigint>, counts array<int>"
#: A posting of a term: a document of the block, and what the term adds to its score.
SCORED = np.dtype([("doc", np.int32), ("score", np.float32)])
RESULT = "query_id long, query_tie long, doc_id long, score double"


def terms_of(text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Words; sorted hashes of the distinct ones; their counts."""
    counts = Counter(text.translate(ASCII_WORDS).split() if text.isascii() else WORD.findall(text.lower()))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in counts), np.uint64, len(counts)).view(np.int64)
    n = np.fromiter(counts.values(), np.int32, len(counts))
    order = np.argsort(hashes, kind="stable")
    return int(n.sum()), hashes[order], n[order]


def build_index(docs: DataFrame, path: str, shard_postings: int = SHARD_POSTINGS) -> None:
    """Write the postings of ``docs`` (doc_id, text) as ``path``/shard=N."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, held = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                length, terms, counts = terms_of(text)
                if held and held + len(terms) > shard_postings:
                    shard, held = shard + 1, 0
                held += len(terms)
                tie = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
                rows.append((doc_id, tie - (1 << 64) if tie >> 63 else tie, length, terms, counts, shard))
            ids, ties, lengths, terms, counts, shards = list(zip(*rows)) or [()] * 6
            starts = pa.array(np.cumsum([0, *map(len, terms)]), pa.int32())
            columns = [pa.array(c, k) for c, k in zip((ids, ties, lengths), (pa.int64(), pa.int64(), pa.int32()))]
            for lists, kind in ((terms, pa.int64()), (counts, pa.int32())):
                columns.append(pa.ListArray.from_arrays(starts, pa.array(np.concatenate([np.zeros(0, kind.to_pandas_dtype()), *lists]))))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(shards, pa.int64())], names=["doc_id", "tie", "length", "terms", "counts", "shard"]
            )

    documents(docs).mapInArrow(run, f"{POSTINGS}, shard long").write.partitionBy("shard").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{POSTINGS}, shard long").parquet(path)


class Block:
    """Some documents of a shard, inverted and weighed for a block of queries:
    frequent terms as rows of a matrix, the others as postings."""

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, starts: np.ndarray, terms: np.ndarray,
                 counts: np.ndarray, mean_length: float, queries: Queries):
        self.doc_ids, self.starts, self.counts, self.queries = doc_ids, starts, counts, queries
        self.n_docs = len(lengths)
        self.norm = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
        order, in_order = _order(terms)
        first = np.ones(len(terms), bool)
        first[1:] = in_order[1:] != in_order[:-1]
        vocabulary = in_order[first]
        del in_order
        self.post_start = np.append(np.flatnonzero(first), len(terms))
        self.df = np.diff(self.post_start)
        #: for every posting of a document the number of its term
        self.numbers = np.empty(len(terms), np.int32)
        self.numbers[order] = np.cumsum(first, dtype=np.int32) - 1
        #: for every term of the queries its number, or -1
        self.number = np.full(len(queries.distinct), -1, np.int32)
        self.idf = np.zeros(len(vocabulary))
        if len(vocabulary):
            at = np.minimum(np.searchsorted(vocabulary, queries.distinct), len(vocabulary) - 1)
            here = vocabulary[at] == queries.distinct
            self.number[here] = at[here]
            self.idf[at[here]] = queries.idf[here]
        docs = np.repeat(np.arange(self.n_docs, dtype=np.int32), np.diff(starts))[order]
        scores = self._impact(counts[order], self.norm[docs])
        del order, first
        scores *= np.repeat(self.idf, self.df)
        self.postings = np.empty(len(docs), SCORED)
        self.postings["doc"], self.postings["score"] = docs, scores
        del docs, scores
        asked = self.idf > 0
        frequent = np.flatnonzero(asked & (self.df > max(FREQUENT * self.n_docs, 3)))
        most = min(MATRIX_TERMS, MATRIX_CELLS // max(1, self.n_docs))
        if len(frequent) > most:
            frequent = frequent[np.argsort(-self.df[frequent], kind="stable")[:most]]
        self.row = np.full(len(vocabulary), -1, np.int32)
        self.row[frequent] = np.arange(len(frequent))
        self.row_df = self.df[frequent]
        self.matrix = np.zeros((len(frequent), self.n_docs), np.float32)
        now = self.postings[_ranges(self.post_start[frequent], self.post_start[frequent + 1])]
        self.matrix[np.repeat(np.arange(len(frequent)), self.df[frequent]), now["doc"]] = now["score"]
        listed = np.flatnonzero(asked & (self.df > max(LISTED * self.n_docs, 3)))
        self.list = np.full(len(vocabulary), -1, np.int32)
        self.list[listed] = np.arange(len(listed))
        ends = zip(self.post_start[listed].tolist(), self.post_start[listed + 1].tolist())
        self.lists = [self.postings[a:b].tobytes() for a, b in ends]

    @staticmethod
    def _impact(counts: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return counts * (K1 + 1) / (counts + norm)

    def evaluate(self, doc: int, asked: np.ndarray, idf: np.ndarray) -> float:
        """Full score of a document for the terms of a query, as ascending numbers."""
        a, b = self.starts[doc], self.starts[doc + 1]
        numbers = self.numbers[a:b]
        at = numbers.searchsorted(asked)
        at[at == b - a] = 0
        here = numbers[at] == asked
        return float((idf[here] * self._impact(self.counts[a:b][at[here]], self.norm[doc])).sum())

    def search(self, best: Best) -> None:
        """Add to ``best`` the documents that belong there."""
        if not len(self.idf) or not len(self.queries.number):
            return
        for first in range(0, len(self.queries), LEAST_QUERIES):
            last = min(first + LEAST_QUERIES, len(self.queries))
            starts = self.queries.starts[first : last + 1]
            query, number = np.repeat(np.arange(last - first), np.diff(starts)), self.number[self.queries.number[starts[0] : starts[-1]]]
            query, number = query[number >= 0], number[number >= 0]
            self._score(best, first, last - first, query, number)

    def _score(self, best: Best, first: int, n_queries: int, query: np.ndarray, number: np.ndarray) -> None:
        """``query``: for every term the place of its query after ``first``."""
        row = self.row[number]
        pairs = np.bincount(row[row >= 0], minlength=len(self.matrix)) * self.row_df
        rows = np.flatnonzero(pairs > WORTH * n_queries * self.n_docs)
        matrix = self.matrix[rows]
        place = np.full(len(self.matrix) + 1, -1)
        place[rows] = np.arange(len(rows))
        row = place[row]  # the last one is none
        of_list = np.where(row >= 0, -1, self.list[number])
        is_row, is_list = row >= 0, of_list >= 0
        is_picked = ~(is_row | is_list)
        sizes = np.where(is_picked, self.df[number], 0)
        # sums of positive parts that are held in 32 bits
        slack = (np.bincount(query[is_row], minlength=n_queries) + 16) * 2.0**-23
        for low, high in _cuts(np.bincount(query, sizes, n_queries)):
            a, b = np.searchsorted(query, [low, high])
            q, in_row, in_list, picks = query[a:b] - low, is_row[a:b], is_list[a:b], number[a:b][is_picked[a:b]]
            weights = np.zeros((high - low, len(rows)), np.float32)
            weights[q[in_row], row[a:b][in_row]] = 1
            scores = weights @ matrix
            lists = of_list[a:b][in_list].tolist()
            list_ends = np.searchsorted(q[in_list], np.arange(high - low), "right").tolist()
            picked = self.postings[_ranges(self.post_start[picks], self.post_start[picks + 1])]
            ends = np.cumsum(np.bincount(q, sizes[a:b], high - low)).astype(np.int64).tolist()
            list_at = at = 0
            for i, (list_end, end) in enumerate(zip(list_ends, ends)):
                if list_at < list_end or at < end:
                    parts = [self.lists[j] for j in lists[list_at:list_end]]
                    parts.append(picked[at:end].tobytes())
                    now = np.frombuffer(b"".join(parts), SCORED)
                    sums = np.bincount(now["doc"].astype(np.intp), now["score"].astype(np.float64), self.n_docs)
                    scores[i] += sums.astype(np.float32)
                list_at, at = list_end, end
            now = np.searchsorted(q, np.arange(high - low + 1)).tolist()
            self._keep(best, first + low, scores, slack[low:high], number[a:b], now)

    def _keep(self, best: Best, low: int, scores: np.ndarray, slack: np.ndarray, number: np.ndarray, starts: list[int]) -> None:
        """Evaluate the documents whose rough score allows the k best."""
        least = best.least(low, low + len(scores)) * (1 - 2 * slack)
        least = np.maximum(least, np.finfo(np.float32).tiny).astype(np.float32)
        idf, query, docs, full = self.idf[number], [], [], []
        for i in np.flatnonzero(scores.max(axis=1) >= least).tolist():
            now = np.flatnonzero(scores[i] >= least[i])
            if len(now) > best.k:
                rough = scores[i, now]
                now = now[rough >= np.partition(rough, -best.k)[-best.k] * (1 - 4 * slack[i])]
            now, terms = now.tolist(), slice(starts[i], starts[i + 1])
            query += [low + i] * len(now)
            docs += now
            full += [self.evaluate(doc, number[terms], idf[terms]) for doc in now]
        if docs:
            best.add(np.array(query), self.doc_ids[docs], np.array(full))


class Queries:
    """A block of queries: ids, the distinct terms with their idf, and the
    numbers of the terms, one query after the other."""

    def __init__(self, ids: list, ties: list, starts: np.ndarray, terms: np.ndarray, idf: np.ndarray):
        order, in_order = _order(terms)
        first = np.ones(len(terms), bool)
        first[1:] = in_order[1:] != in_order[:-1]
        self.distinct = in_order[first]
        number = np.empty(len(terms), np.int32)
        number[order] = np.cumsum(first, dtype=np.int32) - 1
        del in_order, order, first
        self.idf = np.zeros(len(self.distinct))
        self.idf[number] = idf  # one for a term, whatever the query
        order = _alike(starts, number, len(self.distinct))
        self.ids, self.ties = [ids[i] for i in order], [ties[i] for i in order]
        self.number = number[_ranges(starts[order], starts[order + 1])]
        self.starts = np.append(0, np.cumsum(starts[order + 1] - starts[order]))

    def __len__(self) -> int:
        return len(self.ids)


class Best:
    """The k best documents so far of every query of a block."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.docs, self.scores = np.zeros((n, k), np.int64), np.zeros((n, k))

    def least(self, low: int, high: int) -> np.ndarray:
        """The k-th best scores; 0 where fewer are found."""
        return self.scores[low:high, -1]

    def add(self, query: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        """Ranks by score, then document."""
        rows, row = np.unique(query, return_inverse=True)
        row = np.concatenate((np.repeat(np.arange(len(rows)), self.k), row))
        docs, scores = np.concatenate((self.docs[rows].ravel(), docs)), np.concatenate((self.scores[rows].ravel(), scores))
        order = np.lexsort((docs, -scores, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        order, row, rank = order[rank < self.k], row[rank < self.k], rank[rank < self.k]
        self.docs[rows[row], rank], self.scores[rows[row], rank] = docs[order], scores[order]


def _order(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the terms in ascending order, and the terms so. Positions take the place of the
    last bits, as values sort much faster than positions by values; two terms
    that differ only there are rare, and then positions are sorted."""
    bits = max(1, len(terms).bit_length())
    keys = (terms >> bits << bits) | np.arange(len(terms))
    keys.sort()
    keys &= (1 << bits) - 1
    in_order = terms[keys]
    if (in_order[1:] < in_order[:-1]).any():
        keys = np.argsort(terms)
        in_order = terms[keys]
    return keys, in_order


def _alike(starts: np.ndarray, number: np.ndarray, n_terms: int) -> np.ndarray:
    """An order of the queries that puts those with the same frequent terms
    together, as those of one language: scored together, they need fewer rows."""
    n = len(starts) - 1
    df = np.bincount(number, minlength=n_terms)
    frequent = np.argsort(-df, kind="stable")[:ALIKE_TERMS]
    place = np.full(n_terms, -1)
    place[frequent] = np.arange(len(frequent))
    at = place[number]
    query = np.repeat(np.arange(n), np.diff(starts))[at >= 0]
    has = np.zeros((n, len(frequent)), np.float32)
    has[query, at[at >= 0]] = 1
    has -= has.mean(axis=0) if n else 0
    has /= np.maximum(np.sqrt((has * has).sum(axis=1, keepdims=True)), 1e-9)
    centres = has[:1]
    for _ in range(ALIKE - 1):  # each is the query that is least like those before
        centres = np.vstack((centres, has[np.argmin((has @ centres.T).max(axis=1))][None])) if n else centres
    for _ in range(5):
        of = np.argmax(has @ centres.T, axis=1) if n else np.zeros(0, int)
        centres = np.vstack([has[of == c].mean(axis=0) if (of == c).any() else centres[c] for c in range(len(centres))] or [centres])
    return np.argsort(of, kind="stable")


def _cuts(postings: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of queries that are scored together."""
    low, held = 0, 0.0
    for i, n in enumerate(postings.tolist()):
        if i > low and (i - low == SCORED_QUERIES or held + n > SCORED_POSTINGS):
            yield low, i
            low, held = i, 0.0
        held += n
    if low < len(postings):
        yield low, len(postings)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All positions of the half-open ranges, one after the other."""
    sizes = ends - starts
    out = np.ones(int(sizes.sum()), np.int64)
    if not len(out):
        return out
    keep = sizes > 0
    starts, ends, sizes = starts[keep], ends[keep], sizes[keep]
    out[0] = starts[0]
    out[np.cumsum(sizes)[:-1]] = starts[1:] - ends[:-1] + 1
    return np.cumsum(out)


def _read(path: str, columns: list[str]) -> pa.Table:
    import pyarrow.dataset as ds

    fs, folder = file_system(path)
    return ds.dataset(folder, filesystem=fs, format="parquet").to_table(columns=columns)


def _lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values of all lists, where each list starts and the last one ends)."""
    chunks = table.column(name).chunks
    values = [c.flatten().to_numpy(zero_copy_only=False) for c in chunks]
    sizes = [pc.list_value_length(c).to_numpy(zero_copy_only=False) for c in chunks]
    starts = np.concatenate([np.zeros(1, np.int64), *sizes]).cumsum()
    return np.concatenate(values) if values else np.zeros(0, np.int64), starts


def load_blocks(path: str, mean_length: float, k: int, queries: Queries) -> Iterator[Block]:
    """The documents of a shard, at most ``BLOCK_DOCS`` at a time. Of equal
    texts (equal hash and length) only the ``k`` first by id are held: k equal
    scores rank before the others for every query."""
    table = _read(path, ["doc_id", "tie", "length", "terms", "counts"])
    doc_ids = pc.fill_null(table.column("doc_id"), np.iinfo(np.int64).max).to_numpy()
    tie, lengths = table.column("tie").to_numpy(), table.column("length").to_numpy()
    terms, starts = _lists(table, "terms")
    counts = _lists(table, "counts")[0].astype(np.int32)
    del table
    order = np.lexsort((doc_ids, lengths, tie))
    new = np.ones(len(order), bool)
    new[1:] = (tie[order][1:] != tie[order][:-1]) | (lengths[order][1:] != lengths[order][:-1])
    copy = np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    held = np.sort(order[(copy < k) & (lengths[order] > 0)])
    for at in range(0, len(held), BLOCK_DOCS):
        now = held[at : at + BLOCK_DOCS]
        post = _ranges(starts[now], starts[now + 1])
        begin = np.append(0, np.cumsum(starts[now + 1] - starts[now]))
        yield Block(doc_ids[now], lengths[now].astype(float), begin, terms[post], counts[post], mean_length, queries)


@lru_cache(maxsize=1)
def load_queries(path: str) -> Queries:
    table = _read(path, ["query_id", "query_tie", "terms", "idf"])
    (terms, starts), (idf, _) = _lists(table, "terms"), _lists(table, "idf")
    return Queries(table.column("query_id").to_pylist(), table.column("query_tie").to_pylist(), starts, terms, idf)


def group_best(index_path: str, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of each of at most ``SHARD_GROUPS`` groups of
    shards for every query: query_id, query_tie, doc_id (the largest long for
    null), score."""
    spark = queries.sparkSession
    postings = read_index(spark, index_path)
    total = postings.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).first()
    n, mean_length = total.n, float(total["mean"] or 0.0)
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    used = queries.select("query_id", "query_tie", F.explode("terms").alias("term"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = (
        used.join(df, "term")
        .groupBy("query_id", "query_tie")
        .agg(F.array_sort(F.collect_list(F.struct("term", idf.alias("idf")))).alias("t"))
    )
    count = queries.count()
    n_blocks = max(1, -(-count // QUERY_BLOCK), min(LEAST_BLOCKS, -(-count // LEAST_QUERIES)))
    query_path = scratch(spark, "bm25-queries")
    weighed.select(
        "query_id",
        "query_tie",
        F.col("t.term").alias("terms"),
        F.col("t.idf").alias("idf"),
        F.pmod(F.xxhash64("query_id", "query_tie"), F.lit(n_blocks)).alias("block"),
    ).write.partitionBy("block").parquet(query_path)
    blocks = spark.read.schema("query_id long, block long").parquet(query_path).select("block").distinct()
    blocks = sorted(r.block for r in blocks.collect())  # one number for each block of queries
    shards = sorted(r.shard for r in postings.select("shard").distinct().collect())  # and for each shard
    n_groups = -(-TASKS_A_CORE * spark.sparkContext.defaultParallelism // max(1, len(blocks)))
    n_groups = max(1, min(n_groups, SHARD_GROUPS, len(shards)))
    groups = [shards[g::n_groups] for g in range(n_groups if shards else 0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [f.split()[0] for f in RESULT.split(", ")], [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        for batch in batches:
            for task in batch.column(0).to_pylist():
                here = load_queries(f"{query_path}/block={blocks[task // len(groups)]}")
                best = Best(len(here), k)
                for shard in groups[task % len(groups)]:
                    for docs in load_blocks(f"{index_path}/shard={shard}", mean_length, k, here):
                        docs.search(best)
                query, rank = np.nonzero(best.scores)
                at = pa.array(query)
                columns = [pa.array(ids, pa.int64()).take(at) for ids in (here.ids, here.ties)]
                columns += [best.docs[query, rank], best.scores[query, rank]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    n_tasks = len(blocks) * len(groups)
    tasks = spark.range(0, n_tasks, 1, min(MAX_TASKS, max(1, n_tasks)))  # a group of shards and a block of queries
    return tasks.mapInArrow(run, RESULT)


def search(index_path: str, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of the index for every query of ``queries``
    (query_id, query_tie, terms): query_id, query_tie, rank, doc_id, score."""
    best = W.partitionBy("query_id", "query_tie").orderBy(F.desc("score"), "doc_id")
    last = F.lit(int(np.iinfo(np.int64).max))
    return (
        group_best(index_path, queries, k)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "query_tie", "rank", F.nullif(F.col("doc_id"), last).alias("doc_id"), "score")
    )


def self_queries(spark: SparkSession, path: str, every: int = 50) -> DataFrame:
    """The indexed documents whose id is divisible by ``every``, as queries."""
    rows = read_index(spark, path).where(F.col("doc_id") % every == 0)
    return rows.select(F.col("doc_id").alias("query_id"), F.col("tie").alias("query_tie"), "terms").dropDuplicates(
        ["query_id", "query_tie"]
    )
