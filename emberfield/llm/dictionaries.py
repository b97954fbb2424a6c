"""Documents cut into units (words, chunks), written as blocks that name each distinct unit once.

A block holds whole documents of a bounded size: the dictionary of its units and, for
every position, the unit's number. Each block then sends its distinct units to buckets by a hash
of their bytes, so equal units of the whole table meet in one bucket, which works on each
once; the answers go back to the blocks that asked. However frequent a unit is, it is
sent once per block.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import decode_rows, encode_rows, pack, slices, unpack
from emberfield.session import scratch_path, shuffle_partitions

#: Numbers of a text's units, given the text and the block's dictionary.
Cut = Callable[[str, "Dictionary"], np.ndarray]
_BLOCK = "block long, rows binary, codes binary, units array<binary>"


class Dictionary(dict):
    """Number of each unit in the order of appearance; ``parts`` is room for the cutter to keep what it found out."""

    def __init__(self):
        super().__init__()
        self.parts: dict = {}

    def __missing__(self, unit):
        n = self[unit] = len(self)
        return n


def _tasks(docs: DataFrame, text_col: str, per_task: int = 32 << 20) -> int:
    """Tasks for the texts: by the size of the files they are read from, or by their bytes where that isn't known."""
    leaves = docs._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size >= 1 << 60:  # Spark's mark for a size it doesn't know
        size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(shuffle_partitions(docs.sparkSession), min(-(-size // per_task), 100_000))


def _block(number: int, kept: list[pa.RecordBatch], codes: list[np.ndarray], units: Dictionary) -> pa.RecordBatch:
    """One row; units are numbered again by falling frequency, which makes the numbers small."""
    lengths = pa.array([len(c) for c in codes], pa.int64())
    flat = np.concatenate(codes) if codes else np.empty(0, np.int32)
    by_count = np.argsort(-np.bincount(flat, minlength=len(units)), kind="stable")
    rank = np.empty(len(units), np.uint32)
    rank[by_count] = np.arange(len(units), dtype=np.uint32)
    words = list(units)
    ordered = pa.array([words[i] if isinstance(words[i], bytes) else words[i].encode() for i in by_count.tolist()], pa.binary())
    rows = pa.Table.from_batches(kept).append_column("_units", lengths).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([encode_rows(rows)], pa.binary()),
            pa.array([pack(rank[flat]) if len(flat) else b""], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(ordered)], pa.int32()), ordered),
        ],
        ["block", "rows", "codes", "units"],
    )


def write_blocks(docs: DataFrame, text_col: str, keep: list[str], cut: Callable[[], Cut], block_bytes: int = 16 << 20, block_rows: int = 100_000) -> DataFrame:
    """Write blocks (block, rows, codes, units) of about ``block_bytes`` of text and read them back.

    ``cut`` is called once per task. ``rows`` are the columns ``keep`` and each row's
    number of units, ``codes`` the numbers of all units in order, ``units`` the
    dictionary. Null texts have no units. The table is bucketed by ``block``, so what comes back
    to the blocks is joined without sending them again.
    """
    spark = docs.sparkSession

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, codes_of = TaskContext.get().partitionId(), 0, cut()
        kept, codes, units, size, rows = [], [], Dictionary(), 0, 0
        for b in slices(batches, 500):
            begin = 0
            for i, text in enumerate(b.column(0).to_pylist()):
                codes.append(codes_of(text, units) if text else np.empty(0, np.int32))
                size += len(text or "") + 8
                rows += 1
                if size >= block_bytes or rows >= block_rows:
                    kept.append(b.slice(begin, i + 1 - begin).select(b.schema.names[1:]))
                    yield _block(task << 32 | made, kept, codes, units)
                    kept, codes, units, size, rows, begin = [], [], Dictionary(), 0, 0, i + 1
                    made += 1
            if begin < b.num_rows:
                kept.append(b.slice(begin).select(b.schema.names[1:]))
        if kept:
            yield _block(task << 32 | made, kept, codes, units)

    name = f"blocks_{uuid.uuid4().hex}"
    read = docs.select(F.col(text_col).alias("_text"), *[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)])
    made = read.mapInArrow(build, _BLOCK)
    made.write.format("parquet").bucketBy(_tasks(docs, text_col), "block").option("path", scratch_path(spark, "blocks")).option("compression", "zstd").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
    return table


def answer_units(blocks: DataFrame, answer: Callable[[list[bytes]], pa.Array], per_bucket: int = 400_000) -> DataFrame:
    """(block, codes, answers): ``answer`` of each distinct unit of the whole table, worked out once, for every block that has it.

    Units go to buckets by a hash of their bytes; a block's units for one bucket travel as one row.
    """
    spark = blocks.sparkSession
    total = blocks.agg(F.sum(F.size("units"))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), -(-total // per_bucket))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            units = b.column(1)[0].values
            if units is None or not len(units):
                continue
            home = np.fromiter(map(xxhash.xxh3_64_intdigest, units.to_pylist()), np.uint64, len(units)) % np.uint64(buckets)
            order = np.argsort(home, kind="stable")
            out: list[tuple] = []
            for codes in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
                lengths, data = _bytes_of(units.take(pa.array(codes)))
                out.append((int(home[codes[0]]), pack(np.diff(codes.astype(np.uint32), prepend=np.uint32(0))), pack(lengths), zstandard.compress(data, 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([b.column(0)[0].as_py()] * len(out), pa.int64()), *[pa.array([o[i] for o in out], pa.binary()) for i in (1, 2, 3)]],
                ["bucket", "block", "codes", "lengths", "data"],
            )

    def reply(asked: pa.Table) -> pa.Table:
        lengths = [unpack(x, np.uint32) for x in asked["lengths"].to_pylist()]
        ends = np.append(0, np.cumsum(np.concatenate(lengths), dtype=np.int64))
        data = b"".join(map(zstandard.decompress, asked["data"].to_pylist()))
        units = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        answers = answer(units.dictionary.to_pylist())
        starts = np.append(0, np.cumsum([len(x) for x in lengths])).tolist()
        sent = [encode_rows(pa.table({"answer": answers.take(units.indices.slice(i, j - i))})) for i, j in itertools.pairwise(starts)]
        return pa.table({"block": asked["block"], "codes": asked["codes"], "answers": pa.array(sent, pa.binary())})

    asked = blocks.select("block", "units").mapInArrow(ask, "bucket int, block long, codes binary, lengths binary, data binary")
    return asked.groupBy("bucket").applyInArrow(reply, "block long, codes binary, answers binary")


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, bytes]:
    """Lengths of a binary array's values, and all their bytes."""
    ends = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, values.offset * 4)
    data = values.buffers()[2]
    return np.diff(ends).astype(np.uint32), data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if data else b""


def over_blocks(blocks: DataFrame, answers: DataFrame, work: Callable[[pa.Table, np.ndarray, pa.Array], pa.Table], empty: pa.Array, schema) -> DataFrame:
    """``work(rows, codes, answers)`` of each block: its rows, the numbers of all their units, and the answers by number (``empty`` without any)."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        by_code = empty
        if right.num_rows:
            asked = np.concatenate([np.cumsum(unpack(x, np.uint32), dtype=np.uint32) for x in right["codes"].to_pylist()])
            by_code = decode_rows(right["answers"].to_pylist())["answer"].combine_chunks().take(pa.array(np.argsort(asked)))
        data = left["codes"][0].as_py()
        codes = unpack(data, np.uint32) if data else np.empty(0, np.uint32)
        out = work(decode_rows(left["rows"].to_pylist()), codes, by_code)
        pa.default_memory_pool().release_unused()
        return out

    return blocks.select("block", "rows", "codes").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
