"""Sum-of-squares online packing of token sequences.

Every document's ids are cut into whole windows and one remainder.  The remainder goes to
the open window whose choice leaves the least sum of squared counts over the fill levels:
with N[h] windows filled to h, moving one from h to h+s changes the sum by
2 (N[h+s] - N[h]) + 2, a new window by 2 N[s] + 1, and filling one up by 1 - 2 N[h].
The counts are kept in one array over the levels, so a placement is one vector pass.

Packing runs inside the scan's tasks, without a shuffle.  Windows still open at a task's
end (or beyond ``open_windows`` of them, which bounds memory) are levelled out: pieces of
the emptiest are cut to fill the fullest, so at most one window of a task is padded
each time.

Defined cases: null text counts as empty and still has its end id; repeated and null ids are
documents like any other; an empty table gives no pieces; other columns of the input are
not read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtload.llm.common import field_type, returned, ship
from courtload.llm.tokens import word_tokens

WINDOW = 4096
END_ID = 2
#: Open windows of a task; at 16 KB each they bound its memory.
OPEN_WINDOWS = 4096
_FAR = np.iinfo(np.int64).max

#: (document, first id in the document, ids as bytes, ids of the document)
Piece = tuple[object, int, bytes, int]


class SumOfSquares:
    """Online packer of items no longer than a window; ``closed`` holds finished windows."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> None:
        self.window, self.most = window, open_windows
        self.count = np.zeros(window + 1, np.int64)
        self.at: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self.open = 0
        self.closed: list[list[Piece]] = []

    def level_for(self, size: int) -> int:
        """Fill level of the window to use, 0 for a new one; of equal costs the fullest."""
        n, top = self.count, self.window - size
        cost = 2 * (n[size:] - n[:top + 1]) + 2
        cost[0] -= 1
        cost[top] -= 1
        cost[1:][n[1:top + 1] == 0] = _FAR
        return top - int(np.argmin(cost[::-1]))

    def add(self, piece: Piece) -> None:
        size = len(piece[2]) // 4
        if size == self.window:
            self.closed.append([piece])
            return
        level = self.level_for(size)
        if level:
            pieces = self.at[level].pop()
            self.count[level] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self.closed.append(pieces)
            return
        self.at[level + size].append(pieces)
        self.count[level + size] += 1
        self.open += 1
        if self.open > self.most:
            self.level_out()

    def level_out(self) -> None:
        """Close the open windows, the emptiest cut into the gaps of the fullest."""
        order = [(level, pieces) for level, windows in enumerate(self.at) for pieces in windows]
        self.at = [[] for _ in range(self.window + 1)]
        self.count[:] = 0
        self.open = 0
        low, high = 0, len(order) - 1
        while low < high:
            fill, pieces = order[high]
            while fill < self.window and low < high:
                have, donor = order[low]
                doc, start, ids, total = donor.pop()
                take = min(self.window - fill, len(ids) // 4)
                rest = len(ids) // 4 - take
                pieces.append((doc, start + rest, ids[4 * rest:], total))
                if rest:
                    donor.append((doc, start, ids[:4 * rest], total))
                fill += take
                order[low] = (have - take, donor)
                low += not donor
            if fill == self.window or low >= high:
                self.closed.append(pieces)
                high -= 1
        if low == high and order[low][1]:
            self.closed.append(order[low][1])


def cut(doc: object, ids: bytes, window: int = WINDOW) -> Iterator[Piece]:
    for a in range(0, len(ids), 4 * window):
        yield doc, a // 4, ids[a:a + 4 * window], len(ids) // 4


def _rows(closed: list[list[Piece]], first: int, id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    docs, starts, lengths, ids, totals, sequences, offsets = [], [], [], [], [], [], []
    for k, pieces in enumerate(closed):
        offset = 0
        for doc, start, raw, total in pieces:
            docs.append(doc)
            starts.append(start)
            lengths.append(len(raw) // 4)
            ids.append(raw)
            totals.append(total)
            sequences.append(first + k)
            offsets.append(offset)
            offset += len(raw) // 4
    long = pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, id_type), pa.array(starts, long), pa.array(lengths, long), pa.array(ids, pa.binary()),
         pa.array(totals, long), pa.array(sequences, long), pa.array(offsets, long)], names=names)


def _pack_batches(batches: Iterable[pa.RecordBatch], path: str, window: int, end_id: int, open_windows: int,
                  names: list[str]) -> Iterator[pa.RecordBatch]:
    task, done = TaskContext.get().partitionId() << 33, 0
    packer, tail, id_type = SumOfSquares(window, open_windows), np.array([end_id], "<u4").tobytes(), None
    encoder = word_tokens(path)
    for batch in batches:
        id_type = batch.schema.field(0).type
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            for doc, raw in zip(part.column(0).to_pylist(), ids):
                for piece in cut(doc, raw + tail, window):
                    packer.add(piece)
            if len(packer.closed) >= 512:
                yield _rows(packer.closed, task + done, id_type, names)
                done += len(packer.closed)
                packer.closed = []
    packer.level_out()
    if packer.closed:
        yield _rows(packer.closed, task + done, id_type, names)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer``: path of a tokenizers file on every machine.
    """
    ship(docs.sparkSession)
    long = T.LongType()
    schema = T.StructType([T.StructField(id_col, field_type(docs, id_col)), T.StructField("start", long),
                           T.StructField("length", long), T.StructField("ids", T.BinaryType()),
                           T.StructField("doc_tokens", long), T.StructField("sequence_id", long),
                           T.StructField("offset", long)])
    names = schema.names
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        lambda it: returned(_pack_batches(it, tokenizer, window, end_id, open_windows, names)), schema)
