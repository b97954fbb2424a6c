"""Moving large sets of 64-bit hashes through Spark in compact form.

Documents are cut into chunks of bounded bytes. Each chunk sends the sorted,
distinct hashes of its documents to buckets of the hash range; a bucket sees one
entry per chunk and hash however often the hash occurs, so a passage held by a
third of all documents adds one entry per chunk. Answers travel back to the
chunks the same way. Sorted hashes are sent as compressed differences, at about
two thirds of their plain size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfield.session import scratch_path, shuffle_partitions


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in small pieces, so that what is made from them stays small too."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
        pa.default_memory_pool().release_unused()


def pack(values: np.ndarray) -> bytes:
    """Compress an integer array by byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes, kind=np.uint64) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def encode_rows(batch: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(batch)
    return sink.getvalue().to_pybytes()


def decode_rows(blobs) -> pa.Table:
    parts = [pa.ipc.open_stream(pa.py_buffer(b)).read_all() for b in blobs]
    return pa.concat_tables(parts).combine_chunks()


def id_bounds(sizes: DataFrame, target: int) -> np.ndarray:
    """Lower bounds of id ranges holding about ``target`` bytes each.

    ``sizes`` has non-null ``id`` and ``n``, and is stored. Equal ids stay in one range.
    One number per range reaches the driver.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, last = None, None
        for b in batches:
            ids, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            out = []
            for i, size in zip(ids.tolist(), n.tolist(), strict=True):
                if total is None or (total >= target and i != last):
                    out.append(i)
                    total = 0
                total += size
                last = i
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["id"])

    ranged = sizes.repartitionByRange("id").sortWithinPartitions("id")
    return np.unique(np.array([r[0] for r in ranged.mapInArrow(cut, "id long").collect()], np.int64))


def _packed(docs: DataFrame, chunk_of: Callable[[pa.RecordBatch], np.ndarray], drop: int = 0) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4000):
            chunk = chunk_of(b)
            order = np.argsort(chunk, kind="stable")
            groups = np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1)
            rows = b.select(b.schema.names[drop:])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(chunk[g[0]]) for g in groups], pa.int32()),
                    pa.array([encode_rows(rows.take(pa.array(g))) for g in groups], pa.binary()),
                ],
                ["chunk", "rows"],
            )

    return docs.mapInArrow(split, "chunk int, rows binary")


def by_id_range(docs: DataFrame, id_col: str, bounds: np.ndarray) -> DataFrame:
    """Rows packed as (chunk int, rows binary), chunks ascending with the id; null ids are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    def chunk_of(b: pa.RecordBatch) -> np.ndarray:
        ids = b.column(b.schema.get_field_index(id_col)).to_numpy()
        return np.maximum(np.searchsorted(shared.value, ids, "right") - 1, 0)

    return _packed(docs.where(F.col(id_col).isNotNull()), chunk_of)


def by_hash(docs: DataFrame, key, chunks: int) -> DataFrame:
    """Rows packed as (chunk int, rows binary), dealt to ``chunks`` chunks by a hash of ``key``."""
    dealt = docs.select(F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int").alias("_chunk"), *docs.columns)
    return _packed(dealt, lambda b: b.column(0).to_numpy(), drop=1)


def bucket_count(spark: SparkSession, total_bytes: int, per_bucket: int) -> int:
    return max(shuffle_partitions(spark), -(-total_bytes // per_bucket), 1)


def to_buckets(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Slices of sorted hashes by equal ranges of the hash space."""
    edges = [(b << 64) // buckets for b in range(1, buckets)]
    cuts = np.searchsorted(hashes, np.array(edges, np.uint64)) if edges else []
    for b, part in enumerate(np.split(hashes, cuts)):
        if len(part):
            yield b, part


def hash_entries(chunks: DataFrame, hashes_of: Callable[[pa.Table], np.ndarray], buckets: int) -> DataFrame:
    """(bucket, chunk, hashes, counts): the distinct hashes found in each chunk's rows, ascending, with their counts there."""

    def emit(key, table):
        chunk = key[0].as_py()
        hashes, counts = np.unique(hashes_of(decode_rows(table["rows"].to_pylist())), return_counts=True)
        counts = np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32)
        parts, at = [], 0
        for b, part in to_buckets(hashes, buckets):
            parts.append((b, pack_sorted(part), pack(counts[at : at + len(part)])))
            at += len(part)
        pa.default_memory_pool().release_unused()
        return pa.table({
            "bucket": pa.array([p[0] for p in parts], pa.int32()),
            "chunk": pa.array([chunk] * len(parts), pa.int32()),
            "hashes": pa.array([p[1] for p in parts], pa.binary()),
            "counts": pa.array([p[2] for p in parts], pa.binary()),
        })

    return chunks.groupBy("chunk").applyInArrow(emit, "bucket int, chunk int, hashes binary, counts binary")


Choice = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def answers(entries: DataFrame, choose: Choice) -> DataFrame:
    """(chunk, hashes, counts): per bucket, the entries ``choose`` marks, sent back to their chunk.

    ``choose`` gets the bucket's hashes in ascending order, for equal hashes their
    chunks in ascending order, and the counts; it returns a boolean array and the
    counts to send.
    """

    def reduce(table):
        parts = [unpack_sorted(x) for x in table["hashes"].to_pylist()]
        chunks = np.repeat(table["chunk"].to_numpy().astype(np.int32), [len(p) for p in parts])
        counts = np.concatenate([unpack(x, np.uint32) for x in table["counts"].to_pylist()])
        hashes = np.concatenate(parts)
        del parts
        order = np.lexsort((chunks, hashes))
        hashes, chunks, counts = hashes[order], chunks[order], counts[order]
        keep, counts = choose(hashes, chunks, counts)
        hashes, chunks, counts = hashes[keep], chunks[keep], counts[keep].astype(np.uint32)
        order = np.argsort(chunks, kind="stable")
        hashes, chunks, counts = hashes[order], chunks[order], counts[order]
        found, starts = np.unique(chunks, return_index=True)
        split = lambda x: np.split(x, starts[1:]) if len(found) else []
        return pa.table({
            "chunk": pa.array(found, pa.int32()),
            "hashes": pa.array([pack_sorted(p) for p in split(hashes)], pa.binary()),
            "counts": pa.array([pack(p) for p in split(counts)], pa.binary()),
        })

    return entries.groupBy("bucket").applyInArrow(reduce, "chunk int, hashes binary, counts binary")


def merged_counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of all answers to one chunk, ascending by hash."""
    if not table.num_rows:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    hashes = np.concatenate([unpack_sorted(b) for b in table["hashes"].to_pylist()])
    counts = np.concatenate([unpack(b, np.uint32) for b in table["counts"].to_pylist()])
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def merged(blobs: list[bytes]) -> np.ndarray:
    """All hashes of the answers to one chunk, ascending."""
    if not blobs:
        return np.empty(0, np.uint64)
    return np.sort(np.concatenate([unpack_sorted(b) for b in blobs]))


def among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Which values are in the sorted set."""
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values
