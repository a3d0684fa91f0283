"""Token ids packed with a static range asymmetric numeral system.

One shared table of symbol frequencies, counted over all documents, codes every
block. A block holds the ids of consecutive whole documents, dealt over up to
``LANES`` interleaved coders; its final coder states are its checkpoint, so that
each block is decoded by itself, and its checksum is verified before. Blocks are
rows of a Parquet folder, in ascending order of doc_id: the writer's commit
protocol discards what a lost task has written.

A null or empty text has no ids but the end id. Rows without a doc_id come
first; rows that repeat one stand side by side, in the order of their ids'
checksum. Other columns are not read. An empty table packs to no blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.llm.text import U64
from skylattice.llm.tokens import tokenizer
from skylattice.llm.workspace import Workspace

SCALE = 20
LANES = 1024
BLOCK_TOKENS = 1 << 18
LOW = U64(1 << 32)
END_ID = 2


class Table:
    """Frequencies of all symbols, each at least 1, that add up to 2**SCALE."""

    def __init__(self, counts: dict[int, int], vocabulary: int):
        if vocabulary >= 1 << (SCALE - 1):
            raise ValueError("the vocabulary is too large for the frequency table")
        total, room = max(1, sum(counts.values())), (1 << SCALE) - vocabulary
        freq = [1 + counts.get(s, 0) * room // total for s in range(vocabulary)]
        freq[max(range(vocabulary), key=lambda s: (counts.get(s, 0), -s))] += (1 << SCALE) - sum(freq)
        self.freq = np.array(freq, U64)
        self.start = np.cumsum(self.freq) - self.freq
        self.symbol = np.repeat(np.arange(vocabulary, dtype=np.uint32), self.freq.astype(np.int64))

    def encode(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(states, words): coder states to start decoding from, and the words it reads."""
        n = len(symbols)
        lanes = max(1, min(LANES, n // 64))
        state = np.full(lanes, LOW, U64)
        freq, start = self.freq[symbols], self.start[symbols]
        limit = freq << U64(64 - SCALE)
        words = []
        for at in range((max(n, 1) - 1) // lanes * lanes, -1, -lanes):
            cut = slice(at, min(at + lanes, n))
            x = state[: cut.stop - at]
            full = x >= limit[cut]
            words.append(x[full].astype(np.uint32))
            x = np.where(full, x >> U64(32), x)
            q = x // freq[cut]
            state[: cut.stop - at] = (q << U64(SCALE)) + (x - q * freq[cut]) + start[cut]
        return state, np.concatenate(words[::-1])

    def decode(self, states: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        state, lanes, at, mask = states.copy(), len(states), 0, U64((1 << SCALE) - 1)
        words = words.astype(U64)
        out = np.empty(n, np.uint32)
        for first in range(0, n, lanes):
            m = min(lanes, n - first)
            x = state[:m]
            slot = x & mask
            symbol = self.symbol[slot.astype(np.int64)]
            out[first : first + m] = symbol
            x = self.freq[symbol] * (x >> U64(SCALE)) + slot - self.start[symbol]
            low = np.flatnonzero(x < LOW)
            x[low] = (x[low] << U64(32)) | words[at : at + len(low)]
            at += len(low)
            state[:m] = x
        if at != len(words) or (state != LOW).any():
            raise ValueError("a block does not end where it should")
        return out


TOKENS = "doc_id long, n int, crc long, ids binary"
BLOCKS = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("shard_start", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
    ("states", pa.binary()), ("words", pa.binary()), ("checksum", pa.int64()),
])
BLOCK_COLUMNS = (
    "shard int, block int, shard_start long, n_tokens long, doc_ids array<long>, counts array<int>, "
    "states binary, words binary, checksum long"
)


def _tokenize(path: str, end_id: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("crc", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        coder = tokenizer(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                ids, count = coder.encode(part.column("text"))
                ends = np.cumsum(count + 1)
                flat = np.full(int(ends[-1]), end_id, np.uint32)
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = ids
                rows = [r.tobytes() for r in np.split(flat, ends[:-1])]
                yield pa.record_batch([
                    part.column("doc_id"), pa.array(count + 1, pa.int32()),
                    pa.array([zlib.crc32(r) for r in rows], pa.int64()),
                    pa.array([np.frombuffer(r, np.uint32).astype(np.uint16).tobytes() for r in rows] if coder.vocabulary <= 1 << 16 else rows, pa.binary()),
                ], schema=schema)

    return run


def _count(width):
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.column("ids"):
                more = np.bincount(np.frombuffer(row.as_buffer(), width))
                if len(more) > len(total):
                    more[: len(total)] += total
                    total = more
                else:
                    total[: len(more)] += more
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["id", "count"])

    return run


def _pack(table: Table, width):
    def run(batches):
        from pyspark import TaskContext

        shard, state = TaskContext.get().partitionId(), {"block": 0, "start": 0}
        names, counts, parts, size = [], [], [], 0

        def block():
            symbols = np.concatenate(parts)
            states, words = table.encode(symbols)
            states, words = states.tobytes(), words.tobytes()
            row = [shard, state["block"], state["start"], len(symbols), names[:], counts[:], states, words, zlib.crc32(words, zlib.crc32(states))]
            state["block"] += 1
            state["start"] += len(symbols)
            names.clear(), counts.clear(), parts.clear()
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, BLOCKS, strict=True)], schema=BLOCKS)

        for batch in batches:
            for name, row in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                ids = np.frombuffer(row.as_buffer(), width)
                names.append(name), counts.append(len(ids)), parts.append(ids)
                size += len(ids)
                if size >= BLOCK_TOKENS:
                    yield block()
                    size = 0
        if parts:
            yield block()

    return run


def _unpack(table: Table):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = _block_ids(table, row)
                ends = np.cumsum(row["counts"])
                yield pa.record_batch([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(ends - row["counts"] + row["shard_start"] + row["offset"]),
                    pa.array(row["counts"], pa.int64()),
                    pa.array([zlib.crc32(part.tobytes()) for part in np.split(ids, ends[:-1])], pa.int64()),
                ], schema=schema)

    return run


def _block_ids(table: Table, row: dict) -> np.ndarray:
    if zlib.crc32(row["words"], zlib.crc32(row["states"])) != row["checksum"]:
        raise ValueError(f"block {row['block']} of shard {row['shard']} fails its checksum")
    return table.decode(np.frombuffer(row["states"], U64), np.frombuffer(row["words"], np.uint32), row["n_tokens"])


def _vocabulary(spark: SparkSession, tokenizer_path: str) -> int:
    """How many ids a tokenizer has, as a task finds it: the driver need not hold the tokenizer."""

    def run(batches):
        for _ in batches:
            yield pa.record_batch([pa.array([tokenizer(tokenizer_path).vocabulary])], names=["n"])

    return spark.range(0, 1, 1, 1).mapInArrow(run, "n long").first()["n"]


def pack(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID, path: str | None = None) -> tuple[DataFrame, Table]:
    """Write the ids of ``documents`` (doc_id, text) as blocks under ``path``; (blocks, table) to read them by.

    Without a path the blocks go to the shared folder. The only things that pass
    through the driver are the counts of the vocabulary and one sum per shard.
    """
    spark = documents.sparkSession
    work = Workspace(spark)
    tokens = work.path()
    documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _tokenize(tokenizer_path, end_id), TOKENS
    ).write.option("compression", "zstd").parquet(tokens)
    tokens = spark.read.schema(TOKENS).parquet(tokens)
    vocabulary = max(_vocabulary(spark, tokenizer_path), end_id + 1)
    width = np.uint16 if vocabulary <= 1 << 16 else np.uint32
    counts = tokens.select("ids").mapInArrow(_count(width), "id long, count long").groupBy("id").agg(F.sum("count"))
    table = Table({r[0]: r[1] for r in counts.collect()}, vocabulary)
    path = path or f"{work.root}/blocks"
    ordered = tokens.repartitionByRange("doc_id", "crc").sortWithinPartitions("doc_id", "crc")
    ordered.select("doc_id", "ids").mapInArrow(_pack(table, width), BLOCK_COLUMNS).write.option("compression", "none").parquet(path)
    return spark.read.schema(BLOCK_COLUMNS).parquet(path), table


def unpack(blocks: DataFrame, table: Table) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its block."""
    sums = blocks.groupBy("shard").agg(F.sum("n_tokens")).collect()
    starts, total = [], 0
    for shard, n in sorted(tuple(r) for r in sums):
        starts.append((shard, total))
        total += n
    kind = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("offset", T.LongType())])
    offsets = blocks.sparkSession.createDataFrame(starts, kind)
    # A row for each task that wrote blocks; the blocks themselves need not move.
    return blocks.join(F.broadcast(offsets), "shard").mapInArrow(_unpack(table), "doc_id long, start long, n_tokens long, ids_crc32 long")
