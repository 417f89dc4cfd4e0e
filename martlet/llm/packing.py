"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each task packs the documents of its input split as they arrive. A document's
full windows are cut off first; its rest goes into the fill level that
minimises the sum of squared counts of partially filled windows, the counts
being kept in an array over levels 0..window. Windows leave the task once
full; when ``MAX_OPEN`` are open, and at the end of the split, the open ones
are cut again into full windows, so memory is bounded and nothing is padded
but the last one, whose rest is cut at powers of two, which need no padding.

Defined cases: a null or empty text is the end id alone; rows that share a
``doc_id`` are packed as documents of their own; documents longer than a window
are cut, never truncated; an empty table gives no rows. Splits are packed
independently, so no rows move between tasks, and a retried task repeats the
same packing. Other columns of the input are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martlet.llm import tokens
from martlet.llm.common import documents

#: Partially filled windows a task holds before it cuts them into full ones.
MAX_OPEN = 4_096
BATCH_BYTES = 8 << 20
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, token_ids binary"
)

# a piece: (doc_id, first id within the document, ids as bytes, ids of the document)
Piece = tuple[int | None, int, bytes, int]


class SumOfSquaresPacker:
    """Online packer; ``emit(pieces)`` is called once for each finished window."""

    def __init__(self, window: int, emit: Callable[[list[Piece]], None], max_open: int = MAX_OPEN):
        self.window, self.emit, self.max_open = window, emit, max_open
        self.counts = np.zeros(window + 1, np.int64)  # level -> partially filled windows
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level (0: a new window) whose use adds least to the sum of squares."""
        w, n = self.window, self.counts
        # moving a window from level h to h + size changes n[h]^2 + n[h + size]^2
        change = 2 * (n[size:w] - n[: w - size]) + 2
        change = np.append(change, 1 - 2 * n[w - size])
        change[0] = 2 * n[size] + 1
        usable = n[: w - size + 1] > 0
        usable[0] = True
        change = np.where(usable, change, np.iinfo(np.int64).max)
        return int(len(change) - 1 - np.argmin(change[::-1]))  # ties: the fullest

    def add(self, piece: Piece) -> None:
        doc_id, start, ids, total = piece
        step = 4 * self.window
        whole = len(ids) - len(ids) % step
        for at in range(0, whole, step):
            self.emit([(doc_id, start + at // 4, ids[at : at + step], total)])
        if whole == len(ids):
            return
        size = (len(ids) - whole) // 4
        level = self.level_for(size)
        pieces: list[Piece] = []
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        pieces.append((doc_id, start + whole // 4, ids[whole:], total))
        if level + size == self.window:
            self.emit(pieces)
            return
        self.open[level + size].append(pieces)
        self.counts[level + size] += 1
        self.n_open += 1
        if self.n_open >= self.max_open:
            self.recut(last=False)

    def recut(self, last: bool) -> None:
        """Cut what the open windows hold into full ones; the rest stays open,
        or (``last``) leaves in windows that are powers of two long."""
        held = [p for level in sorted(self.open) for pieces in self.open[level] for p in pieces]
        left = sum(len(p[2]) // 4 for p in held)
        self.counts[:] = 0
        self.open.clear()
        self.n_open = 0
        room = self._room(left, last)
        pieces, filled = [], 0
        for doc_id, start, ids, total in held:
            while ids:
                part = ids[: 4 * (room - filled)]
                pieces.append((doc_id, start, part, total))
                filled += len(part) // 4
                start += len(part) // 4
                ids = ids[len(part) :]
                if filled == room:
                    self.emit(pieces)
                    left -= filled
                    pieces, filled, room = [], 0, self._room(left, last)
        if pieces:
            self.open[filled].append(pieces)
            self.counts[filled] = self.n_open = 1

    def _room(self, left: int, last: bool) -> int:
        if left >= self.window or not last or not left:
            return self.window
        return 1 << (left.bit_length() - 1)


def pack(docs: DataFrame, tokenizer: str, window: int = 2_048, end_id: int = 1) -> DataFrame:
    """Pack ``docs`` (doc_id, text); one row per piece with its ids as
    little-endian unsigned 32-bit ``token_ids``. ``sequence_id`` is unique over
    all tasks; offsets within a sequence have no gaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        held = 0

        def emit(pieces: list[Piece]) -> None:
            nonlocal sequence, held
            offset = 0
            for doc_id, start, ids, total in pieces:
                n = len(ids) // 4
                rows.append((doc_id, start, n, total, sequence, offset, ids))
                offset += n
                held += len(ids)
            sequence += 1

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "token_ids"]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
            )

        ids_of = tokens.encoder(tokenizer, end_id)
        packer = SumOfSquaresPacker(window, emit)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(text.as_py())
                packer.add((doc_id, 0, ids, len(ids) // 4))
                if held >= BATCH_BYTES:
                    yield batch_of()
                    rows.clear()
                    held = 0
        packer.recut(last=True)
        if rows:
            yield batch_of()

    return documents(docs).mapInArrow(run, PIECES)
