"""Documents packed into token windows by best-fit decreasing, with next to no padding."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import batches, record, text_of
from .tokens import encoder, word_bpe_path

FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
          ("sequence_id", pa.int64()), ("offset", pa.int64())]
#: Tokens of document ends that one round of best-fit packs together.
ROUND = 1 << 22


class OpenWindows:
    """Open windows by how much room each has left, in a segment tree: the tightest fit in as many steps as it is high."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at = [[] for _ in range(self.leaves)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, room: int, window: list) -> None:
        self.at[room].append(window)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, list] | None:
        """The window with the least room that is not less than ``need``."""
        node, count = need + self.leaves, self.count
        while not count[node]:
            # climb until a subtree to the right holds one
            while node & 1:
                node >>= 1
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:
                return None
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.at[room].pop()

    def rest(self):
        for room, windows in enumerate(self.at):
            for w in windows:
                yield room, w


def best_fit(items: list[tuple], window: int):
    """(room left, items) of each window after best-fit decreasing; an item is (length, ...), at most ``window`` long."""
    tree = OpenWindows(window)
    for item in sorted(items, key=lambda x: -x[0]):
        found = tree.take(item[0])
        room, inside = found if found else (window, [])
        inside.append(item)
        if room == item[0]:
            yield 0, inside
        else:
            tree.put(room - item[0], inside)
    yield from tree.rest()


def _cut(items: list[tuple], size: int):
    """Items (length, doc, start) in turn, cut at every ``size`` tokens; the last part may be shorter."""
    part, left = [], size
    for length, doc, start in items:
        while length:
            n = min(length, left)
            part.append((n, doc, start))
            length, start, left = length - n, start + n, left - n
            if not left:
                yield part
                part, left = [], size
    if part:
        yield part


def _pack(path: str, end_id: int, window: int, slack: int, with_ids: bool):
    schema = pa.schema([*FIELDS, ("ids", pa.binary())] if with_ids else FIELDS)

    def run(source):
        tokens = encoder(path)
        dtype = f"<u{tokens.width}"
        end = np.array([end_id], dtype).tobytes()
        number = TaskContext.get().partitionId() << 36
        out: list[tuple] = []
        ends: list[tuple] = []

        def emit(parts: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for length, (doc, ids), start in parts:
                raw = np.frombuffer(ids, dtype, length, start * tokens.width).astype("<u4").tobytes()
                row = (doc, start, length, zlib.crc32(raw), len(ids) // tokens.width, number, offset)
                out.append((*row, raw) if with_ids else row)
                offset += length
            number += 1

        def flush(last: bool) -> list[tuple]:
            loose = []
            for room, inside in best_fit(ends, window):
                if room <= slack:
                    emit(inside)
                else:
                    loose += inside
            # what best fit leaves with gaps is cut at the window's border
            rest = []
            for part in _cut(loose, window):
                if sum(p[0] for p in part) == window:
                    emit(part)
                else:
                    rest = part
            size = window
            while last and rest:
                # powers of two need no padding
                size >>= 1
                if sum(p[0] for p in rest) >= size:
                    first, *more = _cut(rest, size)
                    emit(first)
                    rest = [p for part in more for p in part]
            return rest

        pending = 0
        for batch in batches(source):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = tokens.encode(text) + end
                n, held = len(ids) // tokens.width, (doc, ids)
                for at in range(0, n - window + 1, window):
                    emit([(window, held, at)])
                if n % window:
                    ends.append((n % window, held, n - n % window))
                    pending += n
                if pending >= ROUND:
                    ends = flush(False)
                    pending = 0
                if len(out) >= (256 if with_ids else 20_000):
                    yield record(schema, *zip(*out))
                    out.clear()
        flush(True)
        if out:
            yield record(schema, *zip(*out))
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, window: int = 2048, slack: int = 8, with_ids: bool = True) -> DataFrame:
    """Pieces of documents with their place in token windows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and, if asked for, the piece's ids as little-endian unsigned 32-bit integers.

    A document is its ids and ``end_id``. Documents longer than ``window`` (a power of two) are first cut into full
    windows; of the ends, best-fit decreasing puts each into the open window it leaves the least room in. Windows that
    stay more than ``slack`` tokens short are filled up by cutting, and the last tokens of a partition become sequences
    whose length is a power of two; so only windows up to ``slack`` tokens short are padded.

    Packing runs on the partitions as they are read: no shuffle, a bounded number of ends at a time. sequence_id is
    unique; its upper bits are the partition. Null texts are empty and give one token, the end; a repeated row is packed
    again; other columns are not read. An empty table gives no pieces.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    run = _pack(tokenizer or word_bpe_path(), end_id, window, slack, with_ids)
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, kinds + (", ids binary" if with_ids else ""))


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, length and ids of each window, from pieces with ids. A window's pieces are bounded by its length."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, 0L, (n, x) -> n + x.length)").alias("length"),
        F.expr("aggregate(p, cast('' AS binary), (s, x) -> concat(s, x.ids))").alias("ids"))
