"""Bounded-space online packing of tokenised documents into sequences of a fixed size.

Every partition streams its documents once and keeps a fixed number of open windows. A document's
full windows are cut off first; what is left goes to the window that it fits best. When none fits,
the fullest window is emitted, after its gap has taken the head of the document if the gap is worth
a cut. The windows still open at the end of a partition, a fixed number each, are merged across
partitions by their fill alone, in groups of a fixed number of partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm import bpe
from statloom.llm.common import batches_of, settle, share_package, slices, text_rows, tidy

SIZE = 4096
WINDOWS = 32  # open windows of a partition
CUT = 32  # a gap of so many tokens is filled by cutting the next document
MERGED = 32  # partitions whose last windows are merged by one task
BATCH = 4 << 20  # bytes of texts that a worker is sent at once

PIECES = "doc_id long, start long, ids binary, length long, doc_tokens long, part long, window long, offset long, open boolean"


class Windows:
    """The open windows of a partition: number -> tokens in it."""

    def __init__(self, size: int, windows: int, cut: int):
        self.size, self.most, self.cut = size, windows, cut
        self.fill: dict[int, int] = {}
        self.made = 0

    def new(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, length: int) -> Iterator[tuple[int, int, int, int]]:
        """Pieces ``(start, length, window, offset)`` of a document of ``length`` tokens."""
        start = 0
        while length - start >= self.size:
            yield start, self.size, self.new(), 0
            start += self.size
        rest = length - start
        while rest:
            fitting = [(fill, w) for w, fill in self.fill.items() if fill + rest <= self.size]
            if fitting:
                fill, w = max(fitting)
            elif len(self.fill) < self.most:
                fill, w = 0, self.new()
            else:
                fill, w = max((fill, w) for w, fill in self.fill.items())
                gap = self.size - fill
                if gap >= self.cut:
                    yield start, gap, w, fill
                    start, rest = start + gap, rest - gap
                del self.fill[w]
                continue
            self.fill[w] = fill + rest
            if self.fill[w] == self.size:
                del self.fill[w]
            yield start, rest, w, fill
            rest = 0


def merge(windows: pd.DataFrame, size: int) -> pd.DataFrame:
    """Best-fit decreasing over last windows ``(part, window, fill)``: adds the host and the offset there."""
    order = windows.sort_values(["fill", "part", "window"], ascending=[False, True, True])
    hosts: list[list[int]] = []  # part, window, fill
    rows = []
    for part, window, fill in zip(order["part"].tolist(), order["window"].tolist(), order["fill"].tolist()):
        fitting = [h for h in hosts if h[2] + fill <= size]
        host = max(fitting, key=lambda h: h[2]) if fitting else None
        if host is None:
            hosts.append(host := [part, window, 0])
        rows.append((part, window, host[0], host[1], host[2]))
        host[2] += fill
        if host[2] == size:
            hosts.remove(host)
    return pd.DataFrame(rows, columns=["part", "window", "host_part", "host_window", "base"])


def pack(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    windows: int = WINDOWS,
    cut: int = CUT,
    end_id: int = 2,
) -> DataFrame:
    """Pieces ``(doc_id, start, ids, length, doc_tokens, sequence_id, offset)`` of all documents.

    ``ids`` are little-endian unsigned 32-bit numbers; ``end_id`` closes every document. A NULL
    text counts as empty: one piece that holds the end. Repeated rows are packed each for itself,
    a NULL doc_id stays NULL, an empty table gives no rows, other columns are left behind.
    """
    share_package(df.sparkSession)
    shared = bpe.vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        state = Windows(size, windows, cut)
        held: dict[int, list[tuple]] = {}  # pieces of the open windows: a fixed number of tokens
        for batch in batches:
            for some in slices(batch, "text", 2 << 20):
                flat, counts = bpe.loaded(shared.value).encode(some.column("text").to_pylist())
                flat = flat.astype("<u4")
                rows, stop = [], 0
                for doc, n in zip(some.column("doc_id").to_pylist(), counts.tolist()):
                    ids = np.append(flat[stop : stop + n], np.uint32(end_id)).astype("<u4")
                    stop += n
                    for start, length, window, offset in state.place(n + 1):
                        pieces = held.setdefault(window, [])
                        pieces.append((doc, start, ids[start : start + length].tobytes(), length, n + 1, part, window, offset, False))
                        if window not in state.fill:
                            rows += held.pop(window)
                for window in [w for w in held if w not in state.fill]:  # emitted with a gap
                    rows += held.pop(window)
                yield table(rows)
                del some, rows, flat
            del batch  # before the next one is read
            tidy(bpe.OWNER)
        yield table([(*piece[:-1], True) for pieces in held.values() for piece in pieces])

    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    names = ["doc_id", "start", "ids", "length", "doc_tokens", "part", "window", "offset", "open"]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

    # written once: which windows stay open depends on the order in which a task saw its rows
    with batches_of(df.sparkSession, BATCH):
        placed = settle(text_rows(df, id_col, text_col).mapInArrow(run, PIECES), "packed")
    last = placed.where("open").groupBy("part", "window").agg(F.sum("length").alias("fill"))
    merged = last.groupBy(F.expr(f"part div {MERGED}").alias("group")).applyInPandas(
        lambda frame: merge(frame, size), "part long, window long, host_part long, host_window long, base long"
    )
    moved = placed.where("open").join(merged, ["part", "window"])
    columns = ["doc_id", "start", "ids", "length", "doc_tokens"]
    stay = placed.where("not open").select(*columns, F.expr("shiftleft(part, 32) + window").alias("sequence_id"), "offset")
    return stay.unionByName(
        moved.select(*columns, F.expr("shiftleft(host_part, 32) + host_window").alias("sequence_id"), F.expr("offset + base").alias("offset"))
    )
