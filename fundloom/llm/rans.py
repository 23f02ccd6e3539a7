"""Token ids in files: a static range asymmetric numeral system over interleaved lanes.

One frequency table, counted over all documents, is shared by all files. A file holds the documents of a range of
doc_id in order, as one stream of ids cut into blocks that can be decoded on their own.

    head    magic, scale bits, documents, ids, ids of all documents before, blocks, crc32 of the table, crc32 of what follows
    index   doc_id, whether it is null, and number of ids of each document (deflated)
    blocks  offset, bytes, ids, lanes and crc32 of the ids for each block: where a reader may start, and what it must get
    block   the last state of each lane, then 32-bit words in the order they are read

Id number t of a block belongs to lane t mod lanes; each lane is a state of 64 bits, and all lanes step together.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shuffle_width
from .common import batches, record, saved, text_of
from .tokens import encoder, word_bpe_path

MAGIC = b"FLRANS01"
HEAD, BLOCK = "<8sIQQQIII", "<QIIII"
#: Ids of a block, and lanes of a full one.
SPAN, LANES = 1 << 18, 1024
LOW = np.uint64(1 << 31)


class Table:
    """Frequencies scaled to ``1 << bits``; every id that was counted has at least one slot."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, counts = ids[order].astype(np.int64), counts[order].astype(np.float64)
        self.bits = max(16, int(len(ids)).bit_length() + 4)
        freq = np.maximum(1, np.floor(counts / max(counts.sum(), 1) * (1 << self.bits))).astype(np.int64)
        big = np.argsort(-freq, kind="stable")
        while len(freq) and (over := int(freq.sum()) - (1 << self.bits)):
            if over < 0:
                freq[big[0]] -= over
            else:
                # those with the most give first
                take = np.minimum(freq[big] - 1, -(-over * freq[big] // int(freq.sum())))
                take = np.minimum(take, np.maximum(0, over - np.concatenate(([0], np.cumsum(take)[:-1]))))
                freq[big] -= take
        self.freq, self.start = freq.astype(np.uint64), np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64) if len(freq) else freq.astype(np.uint64)
        self.crc = zlib.crc32(self.to_bytes())

    @classmethod
    def stored(cls, raw: bytes) -> Table:
        out = cls.__new__(cls)
        out.bits, n = struct.unpack_from("<II", raw)
        out.ids = np.frombuffer(raw, "<u4", n, 8).astype(np.int64)
        out.freq = np.frombuffer(raw, "<u4", n, 8 + 4 * n).astype(np.uint64)
        out.start = np.concatenate(([0], np.cumsum(out.freq)[:-1])).astype(np.uint64) if n else out.freq
        out.crc = zlib.crc32(raw)
        return out

    def to_bytes(self) -> bytes:
        return struct.pack("<II", self.bits, len(self.ids)) + self.ids.astype("<u4").tobytes() + self.freq.astype("<u4").tobytes()

    def ready(self) -> Table:
        """Adds what coding looks up: the symbol of each id and of each slot."""
        self.symbol = np.zeros(int(self.ids.max(initial=0)) + 1, np.int32)
        self.symbol[self.ids] = np.arange(len(self.ids))
        self.slot = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))
        return self


def encode_block(ids: np.ndarray, table: Table, lanes: int) -> bytes:
    """The ids of one block."""
    x, bits = np.full(lanes, LOW), np.uint64(table.bits)
    symbols, words = table.symbol[ids], []
    for at in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
        s = symbols[at : at + lanes]
        f, own = table.freq[s], x[: len(s)]
        full = own >= f << np.uint64(63 - table.bits)
        words.append((own[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        own = np.where(full, own >> np.uint64(32), own)
        q = own // f
        x[: len(s)] = (q << bits) + (own - q * f) + table.start[s]
    return x.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))


def decode_block(raw: bytes, count: int, lanes: int, table: Table) -> np.ndarray:
    """The ids of one block."""
    x = np.frombuffer(raw, "<u8", lanes).astype(np.uint64)
    words = np.frombuffer(raw, "<u4", offset=8 * lanes).astype(np.uint64)
    out, at, bits, mask = np.empty(count, np.int64), 0, np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    for row in range(0, count, lanes):
        own = x[: min(lanes, count - row)]
        slot = own & mask
        s = table.slot[slot.astype(np.int64)]
        out[row : row + len(s)] = s
        own = table.freq[s] * (own >> bits) + slot - table.start[s]
        low = np.flatnonzero(own < LOW)
        own[low] = (own[low] << np.uint64(32)) | words[at : at + len(low)]
        at += len(low)
        x[: len(s)] = own
    return table.ids[out]


def encode_file(documents, start: int, table: Table) -> bytes:
    """One file from (doc_id or None, ids) in order."""
    keys, sizes, blocks, body, held, size = [], [], [], [], [], 0

    def close(ids: np.ndarray) -> None:
        lanes = int(min(LANES, max(1, len(ids) // 64)))
        raw = encode_block(ids, table, lanes)
        blocks.append((sum(map(len, body)) if not blocks else blocks[-1][0] + blocks[-1][1], len(raw), len(ids), lanes, zlib.crc32(ids.astype("<u4").tobytes())))
        body.append(raw)

    for key, ids in documents:
        keys.append(key)
        sizes.append(len(ids))
        held.append(ids)
        size += len(ids)
        if size >= SPAN:
            whole = np.concatenate(held)
            for at in range(0, size - SPAN + 1, SPAN):
                close(whole[at : at + SPAN])
            held = [whole[size - size % SPAN :]]
            size %= SPAN
    if size:
        close(np.concatenate(held))
    null = np.array([k is None for k in keys], np.uint8)
    index = zlib.compress(np.array([k or 0 for k in keys], "<i8").tobytes() + null.tobytes() + np.array(sizes, "<u8").tobytes(), 1)
    rest = struct.pack("<Q", len(index)) + index + b"".join(struct.pack(BLOCK, *b) for b in blocks)
    head = struct.pack(HEAD, MAGIC, table.bits, len(keys), sum(sizes), start, len(blocks), table.crc, zlib.crc32(rest))
    return head + rest + b"".join(body)


def decode_file(raw: bytes, table: Table):
    """(doc_id or None, start, ids) of each document of a file, block by block; raises where a check sum differs."""
    magic, bits, docs, ids, start, n, crc, check = struct.unpack_from(HEAD, raw)
    if magic != MAGIC or crc != table.crc or bits != table.bits:
        raise ValueError("not a file of this table")
    (size,) = struct.unpack_from("<Q", raw, struct.calcsize(HEAD))
    at = struct.calcsize(HEAD) + 8
    body = at + size + n * struct.calcsize(BLOCK)
    if zlib.crc32(raw[struct.calcsize(HEAD) : body]) != check:
        raise ValueError("index or block list is damaged")
    index = zlib.decompress(raw[at : at + size])
    keys, null, sizes = np.frombuffer(index, "<i8", docs), np.frombuffer(index, np.uint8, docs, 8 * docs), np.frombuffer(index, "<u8", docs, 9 * docs)
    blocks, have, first = struct.iter_unpack(BLOCK, raw[at + size : body]), np.zeros(0, np.int64), start
    for key, none, length in zip(keys.tolist(), null.tolist(), sizes.tolist()):
        parts = [have]
        while sum(map(len, parts)) < length:
            offset, size, count, lanes, crc = next(blocks)
            ids = decode_block(raw[body + offset : body + offset + size], count, lanes, table)
            if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                raise ValueError("a block is damaged")
            parts.append(ids)
        have = np.concatenate(parts) if len(parts) > 1 else have
        yield (None if none else key), first, have[:length]
        have, first = have[length:], first + length


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path in it, for tasks and the driver alike."""
    return pafs.FileSystem.from_uri(folder if ":" in folder.split("/", 1)[0] else f"file://{folder}")


def _put(folder: str, name: str, write) -> None:
    """Writes a file under another name first, so that a task that is lost or runs twice leaves no part of one."""
    fs, base = _store(folder)
    part = f"{base}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        write(out)
    fs.move(part, f"{base}/{name}")


def _tokenise(path: str, end_id: int, folder: str):
    """Writes the ids of a sorted partition to the shared folder and gives how often each id occurs in it."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    counted = pa.schema([("shard", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])

    def run(source):
        tokens, shard = encoder(path), TaskContext.get().partitionId()
        dtype, seen, docs = f"<u{tokens.width}", np.zeros(max(tokens.size, end_id + 1), np.int64), 0
        end = np.array([end_id], dtype).tobytes()

        def write(out) -> None:
            nonlocal seen, docs
            with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as sink:
                for batch in batches(source):
                    ids = [tokens.encode(t) + end for t in batch.column(1).to_pylist()]
                    seen += np.bincount(np.frombuffer(b"".join(ids), dtype), minlength=len(seen))
                    docs += len(ids)
                    sink.write_batch(record(schema, batch.column(0), ids))

        _put(folder, f"ids-{shard:06d}.arrow", write)
        there = np.flatnonzero(seen)
        # a row of its own for the shard, which may hold no documents
        yield record(counted, np.full(len(there) + 1, shard), np.concatenate((there, [-1])), np.concatenate((seen[there], [docs])))
    return run


def _encode(folder: str, starts: dict[int, int], raw: bytes, width: int):
    kind = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("bytes", pa.int64())])

    def run(source):
        table = Table.stored(raw).ready()
        for batch in source:
            for shard in batch.column(0).to_pylist():
                fs, base = _store(folder)
                name = f"tokens-{shard:06d}.rans"

                def documents(place=f"{base}/ids-{shard:06d}.arrow", fs=fs):
                    with fs.open_input_stream(place) as f:
                        for part in pa.ipc.open_stream(f):
                            for key, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                                yield key, np.frombuffer(ids, f"<u{width}").astype(np.int64)

                coded = encode_file(documents(), starts[shard], table)
                _put(folder, name, lambda out, coded=coded: out.write(coded))
                yield record(kind, [shard], [name], [len(coded)])
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Encodes every text into files of ``folder``, in ascending doc_id; returns shard, file and bytes of each file.

    ``folder`` must be shared by the driver and all executors. Null texts are empty and give one id, ``end_id``;
    documents without a doc_id come first, ties are in order of their text, a repeated row is written again, other columns
    are not read. As many files as the session has shuffle partitions, empty ones where there are fewer documents or none.
    A file's ids, those of a very long text included, are held while it is coded. Texts
    are tokenised once: their ids wait in the folder until the table, at most as long as the vocabulary, is known, and are
    removed when they are encoded.
    """
    spark, path = docs.sparkSession, tokenizer or word_bpe_path()
    fs, base = _store(folder)
    fs.create_dir(base, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ranged = rows.repartitionByRange(shuffle_width(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    counts = saved(ranged.mapInArrow(_tokenise(path, end_id, folder), "shard long, id long, n long"), "token-counts")
    used = counts.filter("id >= 0").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    table = Table(used.column("id").to_numpy(), used.column("n").to_numpy())
    # one row per file
    sizes = counts.groupBy("shard").agg(F.sum(F.when(F.col("id") >= 0, F.col("n")).otherwise(0)).alias("n")).orderBy("shard").collect()
    starts, total = {}, 0
    for row in sizes:
        starts[row.shard] = total
        total += row.n
    _put(folder, "table.bin", lambda out: out.write(table.to_bytes()))
    shards = spark.range(0, max(starts, default=-1) + 1, 1, max(1, len(starts)))
    made = saved(shards.mapInArrow(_encode(folder, starts, table.to_bytes(), encoder(path).width), "shard long, file string, bytes long"), "token-files")
    for shard in starts:
        fs.delete_file(f"{base}/ids-{shard:06d}.arrow")
    return made


def _decode(raw: bytes, with_ids: bool):
    def run(source):
        table = Table.stored(raw).ready()
        for batch in source:
            for content in batch.column(0).to_pylist():
                out = []
                for key, start, ids in decode_file(content, table):
                    plain = ids.astype("<u4").tobytes()
                    out.append((key, start, len(ids), zlib.crc32(plain), *([plain] if with_ids else [])))
                    if len(out) >= (512 if with_ids else 20_000):
                        yield record(_decoded(with_ids), *zip(*out))
                        out = []
                if out:
                    yield record(_decoded(with_ids), *zip(*out))
    return run


def _decoded(with_ids: bool) -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), *([("ids", pa.binary())] if with_ids else [])])


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit) of each document in the files."""
    fs, base = _store(folder)
    with fs.open_input_stream(f"{base}/table.bin") as f:
        raw = f.read()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "tokens-*.rans").load(folder).select("content")
    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return files.mapInArrow(_decode(raw, with_ids), kinds)
