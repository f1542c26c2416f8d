"""Blocks of documents: the unit that meets its share of a global dictionary.

A corpus has far more tokens than distinct words, and a block's words repeat. So tasks
send each distinct word of a block once, packed with others of the same hash bucket; a
bucket works out its words once; and the results go back to the block. No word, however
frequent, has more rows than there are blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tillbook.llm.columns import binary

#: Bytes of text in a block. A longer document is a block of its own.
BLOCK_BYTES = 16 << 20


def blocks_of(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[tuple[int, list, list[bytes]]]:
    """(block, doc ids, texts) from batches with doc_id and text."""
    block = TaskContext.get().partitionId() << 32
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), binary(batch.column("text")), strict=True):
            ids.append(doc)
            texts.append(text)
            held += len(text)
            if held >= most:
                yield block, ids, texts
                block, ids, texts, held = block + 1, [], [], 0
    if ids:
        yield block, ids, texts


def pack(parts: list[bytes]) -> bytes:
    """Byte strings as one compressed value."""
    sizes = np.fromiter(map(len, parts), np.uint32, len(parts)).tobytes()
    return zstandard.compress(len(parts).to_bytes(4, "little") + sizes + b"".join(parts))


def unpack(packed: bytes) -> list[bytes]:
    raw = zstandard.decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64) + 4 + 4 * n
    starts = np.concatenate(([4 + 4 * n], ends[:-1])) if n else ends
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def pack_ids(ids: list) -> bytes:
    """Doc ids, nulls kept."""
    known = np.array([0 if i is None else i for i in ids], np.int64)
    return known.tobytes() + bytes(i is None for i in ids)


def unpack_ids(packed: bytes) -> list:
    n = len(packed) // 9
    known = np.frombuffer(packed, np.int64, n).tolist()
    return [None if null else i for i, null in zip(known, packed[8 * n :], strict=True)]


def by_bucket(words, buckets: int) -> dict[int, list[bytes]]:
    """Words by hash bucket, each list sorted (neighbours then compress well)."""
    out: dict[int, list[bytes]] = {}
    for w in sorted(words):
        out.setdefault(zlib.crc32(w) % buckets, []).append(w)
    return out


def n_buckets(texts: DataFrame) -> int:
    """Grows with the input: four for each split it is read in, or shuffle partition if those are more.

    A block sends each distinct word once, so a bucket's share stays about the same at any size.
    """
    setting = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 4 * max(texts.rdd.getNumPartitions(), setting)
