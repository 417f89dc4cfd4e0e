"""Conversation structure repair with an auditable least-cost edit sequence.

The rows of a conversation, in order, are edited until their roles read system (or
not), then user and assistant in turn: ``(s?(ua)+)?`` by the roles' initials. Keep
costs nothing, Rerole (to user or assistant) 3, Delete 4, Insert (an empty user or
assistant text, anywhere) 3. Blank rows and repeated rows must go; a truncated row
that stays adds 3. The audit names the edits by initial, in order; of the cheapest
edit sequences it is the ASCII-least.

The least cost and audit come from a dynamic program over what the output ends
with (nothing, system, user, assistant). Edit prefixes are shared as linked nodes;
each node knows its ancestors at powers of two and a rolling hash of its prefix, so
that prefixes of equal cost compare by a binary search for their longest common
prefix and the letters after it. Equal hashes only count after the nodes turn out
to be the same or their letters to be equal.

Two edit sequences of the same rows and cost never extend one another (only Insert
takes no row, and it costs), so least prefixes stay least whatever follows, and the
program splits: rows are range-partitioned in order, blocks of at most ``BLOCK``
rows give the best audits from each state to each state, and a conversation's
blocks are joined in order. A long conversation thus lies in many tasks, without
its texts. Repeated rows are found by a join on the digest of the text, after
equal rows have been counted together.

The digest of the repaired conversation is sequential by nature: its rows pass one
task in order behind a header with the audit, as a stream that holds one batch.

Defined cases: a null role or text counts as one space; rows sort by turn (nulls
first), then role, then SHA-256 of the text; null conversation ids are one
conversation; roles that begin with neither s, u nor a (an empty role too) can't be
kept; equal rows are repeats; a conversation without rows (given by ``ids``) has
zeros, an empty audit and the hash of the empty string; an empty table gives no
rows. Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.common import quoted, staged

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Most rows of one run of the dynamic program.
BLOCK = 2_048
#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: What the output may end with before a role, by initial of the role.
BEFORE = {"s": (NONE,), "u": (NONE, SYSTEM, ASSISTANT), "a": (USER,)}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {"su", "ua", "au"}

_MODULUS, _FACTOR = (1 << 61) - 1, 1_000_003_579


class Prefixes:
    """Edit sequences that share their beginnings: node -> parent node and letter."""

    def __init__(self) -> None:
        self.letter: list[str] = []
        self.depth: list[int] = []
        self.hash: list[int] = []
        self.ancestors: list[list[int]] = []  # 1, 2, 4, ... letters back

    def root(self) -> int:
        self.letter.append("")
        self.depth.append(0)
        self.hash.append(0)
        self.ancestors.append([])
        return len(self.letter) - 1

    def add(self, parent: int, letter: str) -> int:
        back, k = [parent], 0
        while k < len(self.ancestors[back[k]]):
            back.append(self.ancestors[back[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _FACTOR + ord(letter)) % _MODULUS)
        self.ancestors.append(back)
        return len(self.letter) - 1

    def cut(self, node: int, depth: int) -> int:
        """The prefix of ``depth`` letters."""
        while self.depth[node] > depth:
            node = self.ancestors[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def text(self, node: int) -> str:
        letters = []
        while self.depth[node]:
            letters.append(self.letter[node])
            node = self.ancestors[node][0]
        return "".join(reversed(letters))

    def same(self, x: int, y: int) -> bool:
        """Letter by letter, until both are the same node; equally deep nodes."""
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            if not self.depth[x]:
                return True
            x, y = self.ancestors[x][0], self.ancestors[y][0]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether x's letters come before y's in ASCII order."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.cut(x, depth), self.cut(y, depth)
        if a == b or self.hash[a] == self.hash[b]:
            if self.same(a, b):
                return self.depth[x] < self.depth[y]
            return self.text(x) < self.text(y)
        # the shallowest pair of nodes that differ: their parents are the longest common prefix
        for k in range(len(self.ancestors[a]) - 1, -1, -1):
            if k < len(self.ancestors[a]) and self.hash[self.ancestors[a][k]] != self.hash[self.ancestors[b][k]]:
                a, b = self.ancestors[a][k], self.ancestors[b][k]
        if not self.same(self.ancestors[a][0], self.ancestors[b][0]):
            return self.text(x) < self.text(y)
        return self.letter[a] < self.letter[b]


class Edits:
    """Best (cost, node) for each state, from one starting state."""

    def __init__(self, prefixes: Prefixes, start: int):
        self.prefixes = prefixes
        self.best: list[tuple[int, int] | None] = [None] * 4
        self.best[start] = (0, prefixes.root())

    def _choose(self, options: list[tuple[int, int, str]]) -> tuple[int, int] | None:
        """Cheapest of (cost, parent, letter), of equal ones the ASCII-least; a
        letter of '' is the parent itself."""
        if not options:
            return None
        least = min(options)[0]
        made = [p if not letter else self.prefixes.add(p, letter) for cost, p, letter in options if cost == least]
        node = made[0]
        for other in made[1:]:
            if self.prefixes.less(other, node):
                node = other
        return least, node

    def _insert(self) -> None:
        best = self.best
        for into in (USER, ASSISTANT):
            options = [(*best[into], "")] if best[into] else []
            options += [(best[s][0] + INSERT, best[s][1], "I") for s in BEFORE["ua"[into == ASSISTANT]] if best[s]]
            best[into] = self._choose(options)

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        self._insert()
        best = self.best
        options: list[list[tuple[int, int, str]]] = [[(best[s][0] + DELETE, best[s][1], "D")] if best[s] else [] for s in STATES]
        if not must_go:
            more = TRUNCATED if truncated else 0
            for s in BEFORE.get(initial, ()):
                if best[s]:
                    options[AFTER[initial]].append((best[s][0] + more, best[s][1], "K"))
            for role in "ua":
                for s in BEFORE[role]:
                    if best[s]:
                        options[AFTER[role]].append((best[s][0] + more + REROLE, best[s][1], "R"))
        self.best = [self._choose(o) for o in options]

    def moves(self, start: int) -> list[dict]:
        return [
            {"start": start, "end": s, "cost": self.best[s][0], "audit": self.prefixes.text(self.best[s][1])}
            for s in STATES
            if self.best[s]
        ]


def block_moves(rows: list[tuple[str, bool, bool]], starts: tuple[int, ...]) -> list[dict]:
    """Best audits of (initial, must go, truncated) rows from each start."""
    out, prefixes = [], Prefixes()
    for start in starts:
        edits = Edits(prefixes, start)
        for row in rows:
            edits.row(*row)
        out += edits.moves(start)
    return out


class Audit:
    """Audits of consecutive blocks put together: linked pieces, compared from
    where they part."""

    def __init__(self) -> None:
        # state -> cost and pieces as (before, piece)
        self.best: dict[int, tuple[int, tuple | None]] = {NONE: (0, None)}

    @staticmethod
    def _text(node: tuple | None, until: tuple | None = None) -> str:
        pieces = []
        while node is not until:
            pieces.append(node[1])
            node = node[0]
        return "".join(reversed(pieces))

    def _less(self, x: tuple | None, y: tuple | None) -> bool:
        seen, node = {id(None)}, x
        while node is not None:
            seen.add(id(node))
            node = node[0]
        node = y
        while id(node) not in seen:
            node = node[0]
        return self._text(x, node) < self._text(y, node)

    def _take(self, options: list[tuple[int, tuple | None]]) -> tuple[int, tuple | None]:
        least = min(cost for cost, _ in options)
        best, *others = [node for cost, node in options if cost == least]
        for other in others:
            if self._less(other, best):
                best = other
        return least, best

    def block(self, moves: list[dict]) -> None:
        options: dict[int, list] = {}
        for m in moves:
            if m["start"] in self.best:
                cost, node = self.best[m["start"]]
                options.setdefault(m["end"], []).append((cost + m["cost"], (node, m["audit"])))
        self.best = {s: self._take(o) for s, o in options.items()}

    def end(self) -> tuple[int, str]:
        """Cost and audit, what is missing at the end inserted."""
        missing = {NONE: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
        cost, node = self._take([(c + INSERT * missing[s], (n, "I" * missing[s])) for s, (c, n) in self.best.items()])
        return cost, self._text(node)


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults planted by the crc32 of
    ``conv_id:turn`` mod 20: 0 no row, 1 no text, 2 no sentence ends, 3 twice, 4
    the user's. Nulls become one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    rows = df.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        kind.alias("kind"),
    )
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


IN_ORDER = ("turn", "role", "digest")


def _ordered(*first: str) -> list[Column]:
    return [*[F.col(c).asc_nulls_first() for c in first], *[F.col(c).asc_nulls_first() for c in IN_ORDER]]


def _faulty(rows: DataFrame) -> DataFrame:
    """Equal rows counted together, with the first fault of the first of them."""
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        (ended == "").alias("blank"),
        (~F.right(ended, F.lit(1)).isin(*ENDS)).alias("truncated"),
    )
    narrow = staged(
        narrow.groupBy("conv_id", *IN_ORDER, "blank", "truncated").agg(F.count(F.lit(1)).alias("n")), "turns"
    )
    turn = F.struct(F.col("turn").isNotNull().alias("dated"), "turn")
    first = narrow.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(turn).alias("first")
    )
    joined = narrow.join(first, _same("conv_id", "c") & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    repeated = turn != F.col("first")
    return joined.select(
        "conv_id",
        *IN_ORDER,
        "n",
        F.when(F.col("blank"), "blank").when(repeated, "duplicate").when(F.col("truncated"), "truncated").alias("fault"),
    )


def _counts(faulty: DataFrame) -> DataFrame:
    n, fault = F.col("n"), F.col("fault")
    repeats = F.when(fault == "blank", 0).when(fault == "duplicate", n).otherwise(n - 1)
    return faulty.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(fault == "blank", n).otherwise(0)).alias("blank"),
        F.sum(F.coalesce(repeats, n - 1)).alias("duplicate"),
        F.sum(F.when(fault == "truncated", 1).otherwise(0)).cast("long").alias("truncated"),
    )


MOVES = "array<struct<start:int,end:int,cost:long,audit:string>>"


def _blocks(faulty: DataFrame) -> DataFrame:
    """Every conversation's rows in blocks: their place, the roles' initials at both
    ends, illegal neighbours, and the best audits."""
    order = _ordered("conv_id")
    rows = faulty.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "fault", "n")
    schema = T.StructType(
        [
            faulty.schema["conv_id"],
            *T.StructType.fromDDL(f"task int, block int, first string, last string, illegal long, moves {MOVES}"),
        ]
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        arrow = None
        conv, begun, place, opening = None, False, 0, True
        rows: list[tuple[str, bool, bool]] = []
        done: list[tuple] = []

        def close() -> None:
            nonlocal rows, place
            if not rows:
                return
            # the task's first conversation may go on from another task
            starts = tuple(STATES) if place or opening else (NONE,)
            pairs = zip(rows, rows[1:])
            illegal = sum(a[0] + b[0] not in LEGAL for a, b in pairs)
            done.append((conv, task, place, rows[0][0], rows[-1][0], illegal, block_moves(rows, starts)))
            rows, place = [], place + 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 7
            kinds = [arrow, pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), moves_type]
            out = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=schema.names)
            done.clear()
            return out

        moves_type = pa.list_(
            pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
        )
        for batch in batches:
            arrow = batch.schema.field(0).type
            for key, role, fault, n in zip(*[c.to_pylist() for c in batch.columns]):
                if not begun or key != conv:
                    close()
                    opening = not begun
                    conv, begun, place = key, True, 0
                for copy in range(n):
                    again = copy > 0
                    rows.append((role[:1], again or fault in ("blank", "duplicate"), fault == "truncated" and not again))
                    if len(rows) == BLOCK:
                        close()
                if len(done) >= 1_000:
                    yield batch_of()
        close()
        if done:
            yield batch_of()

    return rows.mapInArrow(blocks, schema)


def _audits(blocks: DataFrame) -> DataFrame:
    """conv_id, illegal, cost and audit, from each conversation's blocks in order."""
    rows = blocks.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "task", "block")
    schema = T.StructType([blocks.schema["conv_id"], *T.StructType.fromDDL("illegal long, cost long, audit string")])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, conv, audit, last, illegal = None, None, None, "", 0
        done: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            kinds = [arrow, pa.int64(), pa.int64(), pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done), kinds)], names=schema.names)
            done.clear()
            return out

        for batch in batches:
            arrow = batch.schema.field(0).type
            for key, _, _, first, end, bad, moves in zip(*[c.to_pylist() for c in batch.columns]):
                if audit is None or key != conv:
                    if audit is not None:
                        done.append((conv, illegal, *audit.end()))
                    conv, audit, illegal = key, Audit(), 0
                else:
                    illegal += last + first not in LEGAL
                audit.block(moves)
                illegal, last = illegal + bad, end
                if len(done) >= 1_000:
                    yield batch_of()
        if audit is not None:
            done.append((conv, illegal, *audit.end()))
        if done:
            yield batch_of()

    return rows.mapInArrow(joined, schema)


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _hashed(headers: DataFrame, rows: DataFrame) -> DataFrame:
    """The headers with the hash of the repaired rows: each conversation's header,
    then its rows in order, pass one task as a stream."""
    names = [f.name for f in T.StructType.fromDDL(RESULT)]
    with_rows = headers.withColumn("row", F.lit(None).cast("struct<turn:long,role:string,digest:binary,text:string>"))
    as_rows = rows.select(
        "conv_id",
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(RESULT)],
        F.struct("turn", "role", "digest", "text").alias("row"),
    )
    place = [F.col("conv_id").asc_nulls_first(), F.col("row").isNotNull()]
    place += [F.col(f"row.{c}").asc_nulls_first() for c in IN_ORDER]
    stream = with_rows.unionByName(as_rows).repartition("conv_id").sortWithinPartitions(*place)
    stream = stream.select("conv_id", *names, F.col("row").isNull().alias("header"), F.col("row.role").alias("role"), F.col("row.text").alias("text"))
    schema = T.StructType([headers.schema["conv_id"], *T.StructType.fromDDL(RESULT + ", repaired_sha256 string")])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, header, done = None, None, []
        audit, at, state, digest, empty = "", 0, NONE, hashlib.sha256(), True

        def line(role: str, text: str) -> None:
            nonlocal empty, state
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            empty = False
            state = AFTER[role[0]]

        def other() -> str:
            return "assistant" if state == USER else "user"

        def inserts() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                line(other(), "")
                at += 1

        def end() -> None:
            inserts()
            done.append((*header, digest.hexdigest()))

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done), kinds)], names=schema.names)
            done.clear()
            return out

        for batch in batches:
            kinds = [batch.schema.field(i).type for i in range(8)] + [pa.string()]
            # one row at a time: texts may be long
            for i in range(batch.num_rows):
                if batch.column(8)[i].as_py():
                    if header is not None:
                        end()
                    header = [batch.column(k)[i].as_py() for k in range(8)]
                    audit, at, state, digest, empty = header[7], 0, NONE, hashlib.sha256(), True
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    line(batch.column(9)[i].as_py(), batch.column(10)[i].as_py())
                elif edit == "R":
                    line(other(), batch.column(10)[i].as_py())
            if len(done) >= 1_000:
                yield batch_of()
        if header is not None:
            end()
        if done:
            yield batch_of()

    return stream.mapInArrow(hashed, schema)


def repair(
    df: DataFrame,
    ids: DataFrame | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of every conversation of ``df``, and of every conversation id
    in the one column of ``ids``, which may have no rows."""
    rows = df.select(
        quoted(conv_col).alias("conv_id"),
        quoted(turn_col).cast("long").alias("turn"),
        F.coalesce(quoted(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(quoted(text_col).cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    faulty = staged(_faulty(rows), "faults")
    audits = _audits(staged(_blocks(faulty), "edit-blocks"))
    audits = audits.select(F.col("conv_id").alias("a"), "illegal", "cost", "audit")
    counts = _counts(faulty)
    if ids is not None:
        every = ids.select(quoted(ids.columns[0]).alias("every")).distinct()
        counts = every.join(counts, _same("every", "conv_id"), "left").drop("conv_id").withColumnRenamed("every", "conv_id")
    headers = counts.join(audits, _same("conv_id", "a"), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    headers = staged(headers.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit")), "audits")
    return _hashed(headers, rows)


def _sql() -> str:
    def plus(state: str, cost: int | str, letter: str) -> str:
        return f"lpad(CAST(CAST(left({state}, 10) AS INT) + {cost} AS VARCHAR), 10, '0') || substr({state}, 11) || '{letter}'"

    def insert(state: str) -> str:
        return plus(state, INSERT, "I")

    stays, rerole = f"CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END", f"(CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END + {REROLE})"

    def target(into: str, initial: str, sources: list[str]) -> str:
        keeps = [f"CASE WHEN free AND initial = '{initial}' THEN {plus(s, stays, 'K')} END" for s in sources]
        reroles = [f"CASE WHEN free THEN {plus(s, rerole, 'R')} END" for s in sources] if initial != "s" else []
        return f"least({', '.join([plus(into, DELETE, 'D'), *keeps, *reroles])})"

    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE
crc_bits(i, v, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM crc_bits WHERE k < 8
),
crc(key, pos, v) AS (
  SELECT DISTINCT {key}, 0, CAST(4294967295 AS BIGINT) FROM conversations
  UNION ALL
  SELECT key, pos + 1, xor(t.v, crc.v // 256)
  FROM crc JOIN crc_bits t ON t.k = 8 AND t.i = xor(crc.v % 256, CAST(ascii(substr(key, pos + 1, 1)) AS BIGINT))
  WHERE pos < length(key)
),
planted AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(v, 4294967295) % 20 AS kind
  FROM conversations JOIN crc ON crc.key = {key} AND pos = length(key)
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM planted
),
numbered AS (
  SELECT conv_id, turn, role, text, rtrim(text, {spaces}) AS ended, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen
  FROM damaged
),
faults AS (
  SELECT *,
         CASE WHEN ended = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
              WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         fault IN ('none', 'truncated') AS free,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM numbered
),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id
),
dp(conv_id, i, n, e, s, u, a) AS (
  SELECT conv_id, CAST(0 AS BIGINT), n, '0000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM stats
  UNION ALL
  SELECT conv_id, i, n, {plus('e', DELETE, 'D')}, {target('s', 's', ['e'])},
         {target('u2', 'u', ['e', 's', 'a2'])}, {target('a2', 'a', ['u2'])}
  FROM (
    SELECT *, least(a, {insert('u2')}) AS a2
    FROM (
      SELECT dp.conv_id, f.i, dp.n, f.fault, f.free, f.initial, dp.e, dp.s, dp.a,
             least(dp.u, {insert('dp.e')}, {insert('dp.s')}, {insert('dp.a')}) AS u2
      FROM dp JOIN faults f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1
    )
  )
),
audits AS (
  SELECT conv_id, CAST(left(best, 10) AS BIGINT) AS cost, substr(best, 11) AS audit
  FROM (SELECT conv_id, least(e, a, {insert('u')}, {plus('s', 2 * INSERT, 'II')}) AS best FROM dp WHERE i = n)
),
edits AS (
  SELECT conv_id, unnest(range(1, length(audit) + 1)) AS pos, audit FROM audits
),
placed AS (
  SELECT conv_id, pos, substr(audit, pos, 1) AS edit,
         length(replace(substr(audit, 1, pos), 'I', '')) AS i,
         length(replace(substr(audit, 1, pos), 'D', '')) - length(replace(audit, 'D', '')) % 2 AS k
  FROM edits
),
lines AS (
  SELECT p.conv_id, pos,
         CASE WHEN edit = 'K' THEN f.role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
         || CASE WHEN edit = 'I' THEN '' ELSE f.text END AS line
  FROM placed p LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i AND edit <> 'I'
  WHERE edit <> 'D'
),
hashes AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY pos)) AS h FROM lines GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audits ON audits.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN hashes ON hashes.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLE_SQL = _sql()
