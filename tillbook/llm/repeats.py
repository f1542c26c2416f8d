"""Suffix-array dedup: removes every byte covered by a string of LENGTH bytes that also
starts elsewhere in the corpus.

A suffix array of the whole corpus would move LENGTH bytes for every byte. Three exact
steps leave it the places where it must decide:

1. Anchors. Of any LENGTH-byte string, the least hash among its 100-byte windows is an
   anchor; equal strings have it at the same place. So a string can only repeat where an
   anchor's hash repeats, and about one position in fifty is an anchor.
2. Contexts. All strings with a given anchor lie in the 300 bytes around it. Occurrences
   with equal contexts repeat each other entirely. Only an occurrence whose context is
   its own, at the edge of a repeated passage, is open; its bytes go, with one example of
   each other context of that anchor, to the suffix array of their 150 shared bytes.
3. Suffix arrays by two-stage sorting: only suffixes smaller than their successors are
   sorted directly; the rest are induced by scanning the buckets of first bytes in order;
   adjacent common prefixes of LENGTH then tell the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.blocks import blocks_of, pack, pack_ids, unpack, unpack_ids
from tillbook.llm.columns import id_and_text
from tillbook.sources.scratch import write_scratch

LENGTH, WINDOW = 200, 100
#: Windows that a string of LENGTH bytes has.
SPREAD = LENGTH - WINDOW + 1
BLOCK_BYTES = 2 << 20
#: Positions hashed together: few enough for a core's cache.
PIECE = 1 << 14
#: Regions sorted together.
CONTEXTS_A_TASK = 4_000
MIX = np.uint64(0x9E3779B97F4A7C15)
BYTE_HASH = np.random.default_rng(11).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _join(a: np.ndarray, b: np.ndarray, gap: int) -> np.ndarray:
    """Hash of what ``a`` covers followed, ``gap`` further on, by what ``b`` covers."""
    out = (a ^ (a >> np.uint64(29))) * MIX
    out[: len(b) - gap] += b[gap:]
    return out


def window_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes from each position (64 + 32 + 4); the last ones run out of text."""
    h = BYTE_HASH[text]
    at = {}
    for size in (1, 2, 4, 8, 16, 32):
        h = _join(h, h, size)
        at[2 * size] = h
    return _join(_join(at[64], at[32], 64), at[4], 96)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """The best of ``width`` values from each position on (of those there are)."""
    size, out = 1, values
    while size < width:
        step = min(size, width - size)
        longer = out.copy()
        best(out[:-step], out[step:], out=longer[:-step])
        out, size = longer, size + step
    return out


class Block:
    """The texts of a block end to end."""

    def __init__(self, texts: list[bytes]):
        self.buffer = b"".join(texts)
        self.text = np.frombuffer(self.buffer, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.sizes = sizes

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")

    def anchors(self, contexts: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, hash, context hash) of the anchors; without ``contexts`` the last are not to be used."""
        n = len(self.text)
        left = np.repeat(self.ends, self.sizes) - np.arange(n)  # bytes to the text's end
        found = [self._anchors_between(a, min(a + PIECE, n), left) for a in range(0, n if n >= LENGTH else 0, PIECE)]
        none = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
        at, h, context = (np.concatenate(x) for x in zip(none, *found, strict=True))
        if not contexts:
            return at, h, context
        doc = self.doc_of(at)
        before, after = at - self.starts[doc], self.ends[doc] - at
        whole = (before >= WINDOW) & (after >= LENGTH)
        for i in np.flatnonzero(~whole).tolist():
            a, b = int(at[i] - min(WINDOW, before[i])), int(at[i] + min(LENGTH, after[i]))
            context[i] = xxhash.xxh3_64_intdigest(self.buffer[a:b], int(at[i]) - a)
        return at, h, context

    def _anchors_between(self, a: int, b: int, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors from a to b, with the context hashes of those that have all of their context."""
        # An anchor is told by the strings that start up to SPREAD - 1 before, and those by LENGTH bytes.
        low, high = max(0, a - SPREAD), min(b + LENGTH, len(self.text))
        left = left[low:high]
        h = window_hashes(self.text[low:high])
        least = _sliding(h, SPREAD, np.minimum)
        least[left < LENGTH] = 0
        # Position i is an anchor if it is the least of some string that starts up to SPREAD - 1 before.
        most = _sliding(least[::-1], SPREAD, np.maximum)[::-1]
        at = np.flatnonzero((most == h) & (left >= WINDOW) & (h > 0))
        at = at[(at >= a - low) & (at < b - low)]
        far = np.minimum(at + WINDOW, len(h) - 1)
        return at + low, h[at], (h[at - WINDOW * (at >= WINDOW)] * MIX + h[at]) * MIX + h[far]


def prefix_hashes(text: np.ndarray, region_end: np.ndarray) -> np.ndarray:
    """Hash of the first LENGTH bytes of each suffix, or of what its region has (128 + 64 + 8)."""
    n = len(text)
    out = np.empty(n, np.uint64)
    a = 0
    while a < n:
        # No last piece below LENGTH: hashes of few positions skip steps.
        b = a + PIECE if a + PIECE + LENGTH <= n else n
        high = min(b + LENGTH, n)
        out[a:b] = _prefix_hashes(text[a:high], region_end[a:high] - a)[: b - a]
        a = b
    return out


def _prefix_hashes(text: np.ndarray, region_end: np.ndarray) -> np.ndarray:
    left = region_end - np.arange(len(text))
    h = {1: np.where(text > 0, (text.astype(np.uint64) + np.uint64(1)) * MIX, np.uint64(0))}

    def join(a: np.ndarray, b: np.ndarray, gap: int) -> np.ndarray:
        out = (a ^ (a >> np.uint64(29))) * MIX
        out[:-gap] += np.where(left[:-gap] > gap, b[gap:], np.uint64(0))
        return out

    size = 1
    while size < 128:
        h[2 * size] = join(h[size], h[size], size) if size < len(text) else h[size]
        size *= 2
    whole = h[128]
    for size, gap in ((64, 128), (8, 192)):
        whole = join(whole, h[size], gap) if gap < len(text) else whole
    return whole ^ np.minimum(left, LENGTH).astype(np.uint64)


def _still_tied(where: np.ndarray, parted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``where`` with an equal neighbour, and their groups; ``parted``: which differ from the next."""
    tied = np.concatenate((~parted, [False])) | np.concatenate(([False], ~parted))
    return where[tied], np.concatenate(([0], np.cumsum(parted)))[tied]


def suffix_array(text: np.ndarray, region_end: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Suffixes in order of their first LENGTH bytes at least, by two-stage sorting.

    ``text`` holds bytes + 1, and 0 after each region; ``region_end`` is where each
    position's region ends; ``words`` the eight bytes from each position. Suffixes that
    agree in LENGTH bytes, or to the ends of their regions, are sorted as one.
    """
    n = len(text)
    # Smaller than the successor: the next differing value is larger.
    change = np.zeros(n, np.int8)
    change[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    change[-1] = 1
    nonzero = np.where(change != 0, np.arange(n), n)
    small = change[np.minimum.accumulate(nonzero[::-1])[::-1]] > 0

    # Stage one: direct sort of the small ones, eight bytes at a time, ties only.
    direct = np.flatnonzero(small & (text > 0))
    if len(direct):
        hashes = prefix_hashes(text, region_end)[direct]
        turn = np.argsort(hashes)
        hashes = hashes[turn]
        fresh = np.concatenate(([True], hashes[1:] != hashes[:-1]))
        order = direct[turn[fresh]]
        which = np.empty(len(direct), np.int64)
        which[turn] = np.cumsum(fresh) - 1
        turn = np.argsort(words[order])
        order, came = order[turn], turn
        # Of the sorted only those still tied, and the group of each.
        where, group = _still_tied(np.arange(len(order)), words[order][1:] != words[order][:-1])
        for depth in range(8, LENGTH, 8):
            if not len(where):
                break
            at = order[where] + depth
            key = np.where(at < region_end[order[where]], words[np.minimum(at, n - 1)], np.uint64(0))
            # Groups that go on alike stay as they are.
            unlike = np.zeros(group[-1] + 1, bool)
            unlike[group[1:][(group[1:] == group[:-1]) & (key[1:] != key[:-1])]] = True
            rows = np.flatnonzero(unlike[group])
            turn = rows[np.lexsort((key[rows], group[rows]))]
            here, moved = where[rows], where[turn]
            order[here], came[here], key[rows] = order[moved], came[moved], key[turn]
            where, group = _still_tied(where, (group[1:] != group[:-1]) | (key[1:] != key[:-1]))
        rank = np.empty(len(order), np.int64)
        rank[came] = np.arange(len(order))
        order = direct[np.argsort(rank[which])]
    else:
        order = direct

    # Stage two: buckets in order; each suffix places the larger one before it.
    by_first = np.split(order, np.searchsorted(text[order], np.arange(1, 258)))
    large: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    for c in range(257):
        if c == 0:
            bucket = np.flatnonzero(text == 0)
        else:
            found = np.concatenate(large[c]) if large[c] else np.empty(0, np.int64)
            parts = [found]
            while len(found):
                before = found[found > 0] - 1
                found = before[text[before] == c]
                parts.append(found)
            bucket = np.concatenate([*parts, by_first[c]])
            out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]
        if len(before):
            first = text[before]
            turn = np.argsort(first, kind="stable")
            cuts = np.flatnonzero(np.diff(first[turn])) + 1
            for piece in np.split(before[turn], cuts):
                large[int(text[piece[0]])].append(piece)
    return np.concatenate(out)


def first_words(text: np.ndarray, region_end: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number, zeros past the region."""
    n = len(text)
    out = np.where(text > 0, text - np.uint16(1), np.uint16(0)).astype(np.uint64)
    for size in (1, 2, 4):
        after = out[size:].copy()
        out <<= np.uint64(8 * size)
        out[: n - size] |= after
    left = region_end - np.arange(n)
    short = np.flatnonzero(left < 8)  # the last positions of each region
    lost = np.uint64(8) * (np.uint64(8) - left[short].astype(np.uint64))
    # In two halves, as no number is shifted by all of its bits.
    half = lost >> np.uint64(1)
    out[short] = out[short] >> half >> half << half << half
    return out


def repeated_starts(regions: list[bytes], places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(region, offset) of the strings of LENGTH bytes that start at two places or more.

    ``places``: the absolute position of each region, ``low`` .. ``high``: the offsets at
    which strings are looked for.
    """
    sizes = np.fromiter(map(len, regions), np.int64, len(regions))
    text = np.frombuffer(b"".join(r + b"\0" for r in regions), np.uint8).astype(np.uint16) + np.uint16(1)
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 0
    starts = ends - sizes
    region = np.repeat(np.arange(len(regions)), sizes + 1)
    offset = np.arange(len(text)) - starts[region]
    valid = (offset >= low[region]) & (offset <= high[region]) & (offset + LENGTH <= sizes[region])
    words = first_words(text, ends[region])
    order = suffix_array(text, ends[region], words)
    order = order[valid[order]]
    if len(order) < 2:
        return np.empty((0, 2), np.int64)
    # Adjacent common prefixes, in words, up to LENGTH.
    common = np.zeros(len(order) - 1, np.int64)
    going = np.arange(len(order) - 1)
    for depth in range(0, LENGTH, 8):
        going = going[words[order[going] + depth] == words[order[going + 1] + depth]]
        common[going] = depth + 8
    first = np.concatenate(([0], np.flatnonzero(common < LENGTH) + 1))
    absolute = places[region[order]] + offset[order]
    several = np.minimum.reduceat(absolute, first) != np.maximum.reduceat(absolute, first)
    hit = order[np.repeat(several, np.diff(first, append=len(order)))]
    return np.stack([region[hit], offset[hit]], axis=1)


def _anchor_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in batch.column("texts").to_pylist():
            _, h, _ = Block(unpack(texts)).anchors(contexts=False)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["anchor"])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, texts in zip(batch.column("block").to_pylist(), batch.column("texts").to_pylist(), strict=True):
            at, h, context = Block(unpack(texts)).anchors()
            arrays = [pa.array(h.view(np.int64)), pa.array(context.view(np.int64)), pa.array(np.full(len(at), block)), pa.array(at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "context", "block", "at"])


def _cut(block: pa.Table, asked: pa.Table) -> pa.Table:
    """Two regions around each asked anchor, each with the 150 bytes that its strings share."""
    out: dict[str, list] = {n: [] for n in CUT.names}
    if not block.num_rows:
        return pa.table(out, schema=CUT)
    here = Block(unpack(block.column("texts")[0].as_py()))
    half = WINDOW // 2
    number = block.column("block")[0].as_py()
    at = asked.column("at").to_numpy().astype(np.int64)
    doc = here.doc_of(at)
    for a, s, e in zip(at.tolist(), here.starts[doc].tolist(), here.ends[doc].tolist(), strict=True):
        # Strings from a - 100 .. a - 50 share a - 50 .. a + 100; those up to a share a .. a + 150.
        for shared, first, last in ((a - half, a - WINDOW, a - half), (a, a - half + 1, a)):
            first, last = max(first, s), min(last, e - LENGTH)
            if shared >= s and shared + WINDOW + half <= e and first <= last:
                region = here.buffer[first : last + LENGTH]
                key = hashlib.blake2b(here.buffer[shared : shared + WINDOW + half], digest_size=16).digest()
                kind = xxhash.xxh3_64_intdigest(region, shared - first) - (1 << 63)
                values = (key, kind, number, first, last - first, region)
                for column, v in zip(out.values(), values, strict=True):
                    column.append(v)
    return pa.table(out, schema=CUT)


CUT = pa.schema([("shared", pa.binary()), ("kind", pa.int64()), ("block", pa.int64()), ("place", pa.int64()), ("high", pa.int64()), ("region", pa.binary())])


def _sort(table: pa.Table) -> pa.Table:
    blocks, numbers = np.unique(table.column("block").to_numpy(), return_inverse=True)
    place = table.column("place").to_numpy()
    hits = repeated_starts(
        table.column("region").to_pylist(), numbers.astype(np.int64) * (1 << 40) + place, np.zeros(len(place), np.int64), table.column("high").to_numpy()
    )
    # Neighbouring starts of one region as one run.
    hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
    cut = np.flatnonzero((np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) != 1)) + 1
    first = hits[np.concatenate(([0], cut)).astype(int)] if len(hits) else hits
    last = hits[np.concatenate((cut - 1, [len(hits) - 1])).astype(int)] if len(hits) else hits
    return pa.table(
        {
            "block": pa.array(blocks[numbers[first[:, 0]]], pa.int64()),
            "low": pa.array(place[first[:, 0]] + first[:, 1], pa.int64()),
            "high": pa.array(place[last[:, 0]] + last[:, 1], pa.int64()),
        }
    )


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _remove(block: pa.Table, runs: pa.Table) -> pa.Table:
    """Each text's removed spans, from the runs of repeated starts."""
    columns: list[list] = [[] for _ in range(6)]
    for ids, packed in zip(block.column("docs").to_pylist(), block.column("texts").to_pylist(), strict=True):
        texts = unpack(packed)
        here = Block(texts)
        n = len(here.text)
        low, high = runs.column("low").to_numpy(), runs.column("high").to_numpy()
        doc = here.doc_of(high)
        # Full runs end at their anchor; they may reach past the text's first or last string.
        low, high = np.maximum(low, here.starts[doc]), np.minimum(high, here.ends[doc] - LENGTH)
        ok = low <= high
        depth = np.bincount(low[ok], minlength=n + 1) - np.bincount(high[ok] + LENGTH, minlength=n + 1)
        gone = np.cumsum(depth)[:n] > 0
        for doc_id, text, s, e in zip(unpack_ids(ids), texts, here.starts.tolist(), here.ends.tolist(), strict=True):
            mine = gone[s:e]
            edge = np.diff(np.concatenate(([0], mine.view(np.int8), [0])))
            spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
            kept = np.frombuffer(text, np.uint8)[~mine].tobytes() if spans else text
            values = (doc_id, e - s, int(mine.sum()), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": a, "end": b} for a, b in spans])
            for column, v in zip(columns, values, strict=True):
                column.append(v)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), SPANS)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, ids, texts in blocks_of(batches, BLOCK_BYTES):
        arrays = [pa.array([block], pa.int64()), pa.array([pack_ids(ids)], pa.binary()), pa.array([pack(texts)], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["block", "docs", "texts"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed
    ``spans`` (byte offsets, end exclusive).

    Null and empty texts, and those below LENGTH bytes, lose nothing. Repeated rows are
    two places each, whatever their ids, so they lose all that is LENGTH bytes or longer.
    An empty table gives no rows; other columns are not read.
    """
    stored = write_scratch(id_and_text(docs, id_col, text_col).mapInArrow(_blocks, "block bigint, docs binary, texts binary"))
    anchors = stored.select("block", "texts").mapInArrow(_anchor_rows, "anchor bigint, context bigint, block bigint, at int")
    twice = stored.select("texts").mapInArrow(_anchor_hashes, "anchor bigint").groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    repeated = write_scratch(anchors.join(twice, "anchor", "left_semi"))

    kinds = repeated.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("block", "at")).alias("example"))
    kinds = write_scratch(kinds)
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 AND least = 1")
    # One example of each context, where some context of the anchor is its own.
    asked = kinds.join(mixed, "anchor", "left_semi").select("example.block", "example.at").distinct()
    schema = "shared binary, kind bigint, block bigint, place bigint, high bigint, region binary"
    texts = stored.select("block", "texts")
    # Blocks that are not asked for stay where they are: an inner group has both sides.
    cut = write_scratch(asked.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(lambda a, b: _cut(b, a), schema))
    # Once more: equal regions repeat each other, a region of its own is sorted with one
    # example of each other region that shares its 150 bytes, if there is any.
    # (Two anchors near a text's edge may cut one and the same region: that is one place.)
    where = F.struct("block", "place")
    regions = cut.groupBy("shared", "kind").agg(F.min(where).alias("example"), F.max(where).alias("last"))
    regions = write_scratch(regions.select("shared", "kind", "example", (F.col("example") != F.col("last")).alias("twice")))
    open_ = regions.groupBy("shared").agg(F.count("*").alias("kinds"), F.bool_and("twice").alias("closed"))
    open_ = open_.filter("kinds > 1 AND NOT closed")
    chosen = regions.join(open_, "shared", "left_semi").select("shared", "kind", "example.block", "example.place")
    near = write_scratch(cut.join(chosen, ["shared", "kind", "block", "place"], "left_semi"))
    equal = cut.join(regions.filter("twice"), ["shared", "kind"], "left_semi").select(
        "block", F.col("place").alias("low"), (F.col("place") + F.col("high")).alias("high")
    )
    tasks = near.count() // CONTEXTS_A_TASK + 1
    task = F.pmod(F.xxhash64("shared"), F.lit(tasks))
    partial = near.withColumn("task", task).groupBy("task").applyInArrow(_sort, "block bigint, low bigint, high bigint")

    shared = kinds.filter("n > 1").select("anchor", "context")
    whole = repeated.join(shared, ["anchor", "context"], "left_semi").select(
        "block", (F.col("at") - (SPREAD - 1)).cast("bigint").alias("low"), F.col("at").cast("bigint").alias("high")
    )
    runs = whole.unionByName(equal).unionByName(partial)
    return stored.groupBy("block").cogroup(runs.groupBy("block")).applyInArrow(_remove, RESULT)


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns."""
    return remove_repeats(docs).drop("spans")
