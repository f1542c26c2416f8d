"""SentencePiece encoding by a table of distinct marked words, and decoding.

A piece may hold white-space markers at its front only (checked on the vocabulary), so no
merge reaches from one marked word, a run of markers and what follows it, into the next:
each can be segmented by itself, and a corpus has far fewer distinct ones than words.

1. Tasks cut texts into marked words. A block of documents numbers its distinct words, sends
   them to the buckets of their hashes and keeps each text as its words' numbers.
2. A bucket lets the library segment its distinct words, once each.
3. The ids go back to the block that asked, and each position takes its word's ids.

The numbered texts travel through the same two shuffles as the words, so a block is cut
only once: what a retried task might cut differently can never meet other answers.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.blocks import blocks_of, pack, pack_ids, unpack, unpack_ids
from tillbook.llm.columns import id_and_text

MARKER = "▁"
#: Characters of a long text that are cut into words at once.
SLICE = 1 << 20
#: Words that the library segments in one call.
CALL = 1 << 14
#: Compression level of what travels.
PACKED = 9

_RUNS = re.compile(" *[^ ]+| +")


def load(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: sentencepiece.SentencePieceProcessor) -> None:
    """Refuse a model whose marked words do not stand alone.

    Its pieces must hold markers at their front only, and it must normalise nothing but
    spaces, to markers, with one more in front of the text.
    """
    crossing = [p for p in map(model.id_to_piece, range(model.get_piece_size())) if MARKER in p.lstrip(MARKER)]
    if crossing:
        raise ValueError(f"pieces cross white-space markers: {crossing[:5]}")
    all_characters = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x110000)]))
    for text in ("  a  b ", all_characters):
        if model.normalize(text) not in (MARKER + text.replace(" ", MARKER), text.replace(" ", MARKER)):
            raise ValueError("the model changes characters before it segments them")
    if model.encode("a b", out_type=str) != model.encode("a", out_type=str) + model.encode("b", out_type=str):
        raise ValueError("the model does not mark the first word like the others")


def marked_words(text: str) -> Iterator[list[str]]:
    """The words of a text without their first marker, slice by slice.

    ``"a  b "`` has ``"a"``, ``" b"`` and ``""``: each begins at a marker, the first at the
    one that stands before any text.
    """
    text = text.replace(MARKER, " ")
    start = 0
    while start < len(text):
        end = start + SLICE
        if end < len(text):
            # A slice ends before the first space of a run; a word without end is one slice.
            end = text.find(" ", end)
            while end > 0 and text[end - 1] == " ":
                end -= 1
            end = len(text) if end <= start else end
        part = text[start:end]
        part = part[1:] if start else part
        if "  " in part or part[:1] == " " or not part:
            yield [run[1:] for run in _RUNS.findall(" " + part)]
        else:
            yield part.split(" ")
        start = end


def segment(model: sentencepiece.SentencePieceProcessor, words: list[bytes]) -> list[bytes]:
    """Each word's ids as little-endian 32-bit integers."""
    # The library marks no empty text, so a marker alone is what it leaves behind a word.
    lone = model.encode("a ")[len(model.encode("a")) :]
    out = []
    for at in range(0, len(words), CALL):
        some = [w.decode() for w in words[at : at + CALL]]
        out += [np.array(ids if word else lone, np.uint32).tobytes() for word, ids in zip(some, model.encode(some, num_threads=1), strict=True)]
    return out


def _numbered(texts: list[bytes], buckets: int) -> tuple[dict[int, list[bytes]], bytes]:
    """A block's distinct words by bucket, sorted, and its texts as numbers in that order."""
    number: dict[str, int] = defaultdict(count().__next__)
    ends, parts = [], []
    for text in texts:
        n = 0
        for words in marked_words(text.decode()):
            parts.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
            n += len(words)
        ends.append(n)
    rows = sorted((zlib.crc32(w) % buckets, w, n) for w, n in ((w.encode(), n) for w, n in number.items()))
    by_bucket: dict[int, list[bytes]] = {}
    place = np.zeros(len(rows), np.uint32)
    for at, (bucket, word, n) in enumerate(rows):
        by_bucket.setdefault(bucket, []).append(word)
        place[n] = at
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    # Texts hold ranks by frequency, most of which fit in a byte or two; a table leads from
    # rank to place.
    times = np.bincount(flat, minlength=len(rows)) if len(rows) else np.zeros(0, np.int64)
    by_rank = np.lexsort((place, -times))
    rank = np.empty(len(rows), np.uint32)
    rank[by_rank] = np.arange(len(rows), dtype=np.uint32)
    steps = np.diff(place[by_rank].astype(np.int64), prepend=0).astype(np.int32)
    head = np.array([len(ends), len(rows), len(flat), *ends], np.uint32).tobytes()
    return by_bucket, zstandard.compress(head + _planes(steps.view(np.uint32)) + _short(rank[flat]), PACKED)


def _planes(numbers: np.ndarray) -> bytes:
    """All lowest bytes, then all next ones: these compress better than whole numbers."""
    size = numbers.itemsize
    return numbers.view(np.uint8).reshape(-1, size).T.tobytes()


def _whole(planes: np.ndarray, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


#: Ranks below ONE take one byte. Others up to 2^16 * (LONG - ONE) above take that byte and two
#: more, the rest four more.
ONE, LONG = 192, 255


def _short(ranks: np.ndarray) -> bytes:
    beyond = ranks - np.minimum(ranks, ONE)
    high = beyond >> 16
    first = np.where(ranks < ONE, ranks, np.minimum(ONE + high, LONG)).astype(np.uint8)
    two, four = (first >= ONE) & (first < LONG), first == LONG
    return first.tobytes() + _planes(beyond[two].astype(np.uint16)) + _planes(beyond[four])


def _ranks(raw: np.ndarray, n: int) -> np.ndarray:
    first = raw[:n]
    two, four = (first >= ONE) & (first < LONG), first == LONG
    out = first.astype(np.uint32)
    middle = n + 2 * int(two.sum())
    out[two] = ONE + ((out[two] - ONE) << 16) + _whole(raw[n:middle], np.uint16)
    out[four] = ONE + _whole(raw[middle:], np.uint32)
    return out


def _numbers(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and all their places in the block's table."""
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    n_texts, n_words, n = raw[:12].view(np.uint32).tolist()
    steps_at = 12 + 4 * n_texts
    ranks_at = steps_at + 4 * n_words
    place = np.cumsum(_whole(raw[steps_at:ranks_at], np.int32), dtype=np.int64)
    return raw[12:steps_at].view(np.uint32), place[_ranks(raw[ranks_at:], n)]


def _pack_words(words: list[bytes]) -> bytes:
    """Words of UTF-8, in which the byte between them cannot occur."""
    return zstandard.compress(b"\xff".join(words), PACKED)


def _unpack_words(packed: bytes) -> list[bytes]:
    return zstandard.decompress(packed).split(b"\xff")


def _placed(numbers: np.ndarray, lengths: np.ndarray, ids: list[bytes], around: tuple[list[int], list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block's texts one after another, and where each text ends."""
    table = np.frombuffer(b"".join(ids), np.uint32)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.cumsum(sizes) - sizes
    before, after = (np.array(a, np.uint32) for a in around)
    extra = len(before) + len(after)
    many = sizes[numbers]
    words_end = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    ids_end = np.concatenate(([0], np.cumsum(many)))
    own = np.diff(ids_end[words_end])
    ends = np.cumsum(own + extra)
    # Where each word's ids go: behind those of earlier words, and behind what surrounds texts.
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    to = ids_end[:-1] + text_of * extra + len(before)
    within = np.arange(ids_end[-1]) - np.repeat(ids_end[:-1], many)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    flat[np.repeat(to, many) + within] = table[np.repeat(starts[numbers], many) + within]
    for i, one in enumerate(before):
        flat[ends - own - extra + i] = one
    for i, one in enumerate(after):
        flat[ends - len(after) + i] = one
    return flat, ends


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame, model_path: str, begin: bool = True, end: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ``ids`` (array of int) per row of ``docs``, as the library encodes the text.

    Null and empty texts have the begin and end ids only; repeated rows and ids each get a
    row; an empty table gives none; other columns are not read. The model file is read by
    the driver and sent to the tasks.
    """
    model = _read(model_path)
    checked = load(model)
    check_model(checked)
    around = ([checked.bos_id()] if begin else [], [checked.eos_id()] if end else [])
    texts = id_and_text(docs, id_col, text_col)
    # As many buckets as the input has splits: a bucket's share stays the same at any size.
    buckets = max(1, texts.rdd.getNumPartitions())
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the vocabulary file

    schema = "bucket bigint, block bigint, docs binary, packed binary"
    names = ["bucket", "block", "docs", "packed"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, parts in blocks_of(batches):
            words, numbers = _numbered(parts, buckets)
            rows = [(bucket, block, None, _pack_words(some)) for bucket, some in words.items()]
            # The texts pass the buckets' shuffle too, each block in a group of its own.
            rows.append((-1 - block, block, pack_ids(ids), numbers))
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    def answer(table: pa.Table) -> pa.Table:
        if table.column("docs")[0].is_valid:
            return table
        lists = [_unpack_words(p) for p in table.column("packed").to_pylist()]
        distinct = sorted(set().union(*lists))
        known = dict(zip(distinct, segment(load(shared.value), distinct), strict=True))
        answers = [pack([known[w] for w in words]) for words in lists]
        return table.set_column(3, "packed", pa.array(answers, pa.binary()))

    def place(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("bucket", "docs", "packed")), strict=True), key=lambda r: r[0])
        _, packed_docs, packed = rows[0]
        table_of = [ids for _, _, part in rows[1:] for ids in unpack(part)]
        lengths, numbers = _numbers(packed)
        flat, ends = _placed(numbers, lengths, table_of, around)
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int32), pa.int32()))
        return pa.table({"doc_id": pa.array(unpack_ids(packed_docs), pa.int64()), "ids": lists})

    asked = texts.select("doc_id", "text").mapInArrow(ask, schema)
    answered = asked.groupBy("bucket").applyInArrow(answer, schema)
    return answered.groupBy("block").applyInArrow(place, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, model_path: str, digests_only: bool = False) -> DataFrame:
    """The rows of ``encoded`` with the library's text for their ids: doc_id, ids, decoded.

    With ``digests_only``: doc_id, n_tokens, ids_sha256 and decoded_sha256 in their place. Null
    ids are read as none.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(_read(model_path))
    rows = encoded.select("doc_id", F.coalesce("ids", F.expr("CAST(array() AS array<int>)")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(shared.value)
        for batch in batches:
            column = batch.column("ids")
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            ends = ends - ends[0]
            parts = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            texts = (model.decode(p.tolist()) for p in parts)
            if digests_only:
                arrays = [
                    batch.column("doc_id"),
                    pa.array([len(p) for p in parts], pa.int64()),
                    pa.array([hashlib.sha256(p.tobytes()).hexdigest() for p in parts]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests_only else "ids array<int>, decoded string"
    return rows.mapInArrow(run, f"doc_id bigint, {schema}")


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """The registered query's columns."""
    return decode(encode(docs, model_path), model_path, digests_only=True)
