"""Byte-level BPE: encode each distinct word once for the whole corpus; decode by table.

1. Tasks cut texts into pre-tokens and send the distinct ones of each block of documents
   to the bucket of their hash.
2. Each bucket merges its distinct pre-tokens by the ranks, once each.
3. The ids go back to the blocks that asked. A block's texts travel compressed to meet
   them, are cut again, and each position takes its pre-token's ids.

Decoding looks each id up in the token-byte table (one entry per token of the vocabulary
file, so its size is known) and joins the bytes by position.

A block that a retried task cuts differently may meet a pre-token it did not ask for;
that one is then merged in place, so results never depend on how blocks fell.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tillbook.llm.blocks import blocks_of, by_bucket, n_buckets, pack, pack_ids, unpack, unpack_ids
from tillbook.llm.columns import id_and_text, tidy


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def _encoder(pattern: str, ranks: bytes) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


class _Known(dict):
    """Pre-token -> its ids as little-endian 32-bit integers."""

    def __init__(self, encoder: tiktoken.Encoding):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encoder._encode_single_piece(word.encode()), np.uint32).tobytes()
        self[word] = ids
        return ids


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ``ids`` (array of int) per row of ``docs``.

    Null and empty texts have no ids; repeated rows and ids each get a row; an empty table
    gives none; other columns are not read.
    """
    texts = id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    buckets = n_buckets(texts)
    with open(ranks_path, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())  # the vocabulary file

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern).findall
        for block, _, parts in blocks_of(batches):
            seen: set[str] = set()
            for text in parts:
                seen.update(cut(text.decode()))
            rows = by_bucket([w.encode() for w in seen], buckets)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows.keys(), pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array(map(pack, rows.values()), pa.binary())],
                    names=["bucket", "block", "words"],
                )

    def merge(table: pa.Table) -> pa.Table:
        encoder = _encoder(pattern, ranks.value)
        known: dict[bytes, bytes] = {}
        answers = []
        for words in table.column("words").to_pylist():
            found = []
            for w in unpack(words):
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = np.array(encoder._encode_single_piece(w), np.uint32).tobytes()
                found.append(ids)
            answers.append(pack(found))
        return pa.table({"block": table.column("block"), "words": table.column("words"), "ids": pa.array(answers, pa.binary())})

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, parts in blocks_of(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([pack_ids(ids)], pa.binary()), pa.array([pack(parts)], pa.binary())],
                names=["block", "docs", "texts"],
            )

    def place(block: pa.Table, answers: pa.Table) -> pa.Table:
        known = _Known(_encoder(pattern, ranks.value))
        for words, ids in zip(answers.column("words").to_pylist(), answers.column("ids").to_pylist(), strict=True):
            known.update(zip((w.decode() for w in unpack(words)), unpack(ids), strict=True))
        cut = regex.compile(pattern).findall
        docs_, values, ends = [], [], [0]
        for ids, parts in zip(block.column("docs").to_pylist(), block.column("texts").to_pylist(), strict=True):
            docs_ += unpack_ids(ids)
            for text in unpack(parts):
                values.append(b"".join(map(known.__getitem__, cut(text.decode()))))
                ends.append(ends[-1] + len(values[-1]) // 4)
        flat = pa.array(np.frombuffer(b"".join(values), np.int32), pa.int32())
        return pa.table({"doc_id": pa.array(docs_, pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)})

    asked = texts.select("doc_id", "text").mapInArrow(tidy(ask), "bucket int, block bigint, words binary")
    answers = asked.groupBy("bucket").applyInArrow(tidy(merge), "block bigint, words binary, ids binary")
    kept = texts.mapInArrow(tidy(keep), "block bigint, docs binary, texts binary")
    return kept.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(tidy(place), "doc_id bigint, ids array<int>")


def _table(ranks: bytes) -> list[bytes]:
    tokens = {int(b): base64.b64decode(a) for a, b in map(bytes.split, ranks.splitlines())}
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


def decode(encoded: DataFrame, ranks_path: str, digests_only: bool = False) -> DataFrame:
    """The rows of ``encoded`` with their bytes: doc_id, ids, decoded.

    With ``digests_only``: doc_id, n_tokens, ids_sha256 and decoded_sha256 in their place.
    """
    with open(ranks_path, "rb") as file:
        ranks = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = _table(ranks.value).__getitem__
        for batch in batches:
            column = batch.column("ids")
            flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.uint32), column.offsets.to_numpy()
            ends = ends - ends[0]
            parts = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            decoded = [b"".join(map(at, p.tolist())) for p in parts]
            if digests_only:
                arrays = [
                    batch.column("doc_id"),
                    pa.array([len(p) for p in parts], pa.int64()),
                    pa.array([hashlib.sha256(p.tobytes()).hexdigest() for p in parts]),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column, pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests_only else "ids array<int>, decoded binary"
    return encoded.mapInArrow(tidy(run), f"doc_id bigint, {schema}")


def digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The registered query's columns."""
    return decode(encode(docs, ranks_path, pattern), ranks_path, digests_only=True)
