"""MinHash near-dedup with min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its
maximum, so PERMUTATIONS hash evaluations make a signature of twice the length. Bands of
ROWS values place a document in BANDS buckets; at a similarity of 0.8 a pair shares no
bucket with odds below 4 in a million.

Documents with the same shingle set are one class from the start. In a bucket, classes
are compared with the bucket's most copied class first: near copies are as a rule made from
what is copied often. Buckets that still hold classes apart then do not compare all with
all: their classes are joined by prefixes of their shingles, rarest first, which any two
similar enough must share, within the lengths and positions that can still reach the
similarity. Links are confirmed on the full shingle sets, as exact words. What joins two
classes in any bucket, or by any chain of links, ends in one component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.columns import binary, free_names, id_and_text, small, tidy
from tillbook.llm.components import components
from tillbook.sources.scratch import write_scratch

PERMUTATIONS, BANDS, ROWS = 80, 32, 5
#: Shingles whose signatures are worked out together: their hashes stay in the cache.
TOGETHER = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)

_draw = np.random.default_rng(20240229)
FACTORS = _draw.integers(0, 2**63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _draw.integers(0, 2**63, PERMUTATIONS, np.uint64)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(31))) * MIX


def shingle_hashes(words: list[bytes], hashes: _WordHash, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words are one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(width, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out + h[i : len(words) - k + 1 + i])
    return np.unique(out)


def band_hashes(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of BANDS bucket hashes for each set; ``starts``: where each set begins."""
    signature = np.empty((2 * PERMUTATIONS, len(starts)), np.uint64)
    for p in range(PERMUTATIONS):
        v = flat * FACTORS[p] + TERMS[p]
        signature[p] = np.minimum.reduceat(v, starts)
        signature[PERMUTATIONS + p] = np.maximum.reduceat(v, starts)
    bands = np.zeros((BANDS, len(starts)), np.uint64)
    for b in range(BANDS):
        for r in range(ROWS):
            bands[b] = _mix(bands[b] + signature[b * ROWS + r])
    return bands.T.copy().view(np.int64)


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHash()

        def out(ids, keys, sets) -> pa.RecordBatch:
            sizes = np.array([len(s) for s in sets])
            full = sizes > 0
            bands = np.zeros((len(sets), BANDS), np.int64)
            if full.any():
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                bands[full] = band_hashes(np.concatenate(sets), starts)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(bands.ravel()))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists],
                names=["doc_id", "text_key", "n_shingles", "node", "bands"],
            )

        for batch in small(batches):
            ids, keys, sets, held = [], [], [], 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), binary(batch.column("text")), strict=True):
                ids.append(doc)
                keys.append(hashlib.md5(text).hexdigest())
                sets.append(shingle_hashes(text.lower().split(), hashes, width))
                held += len(sets[-1])
                if held >= TOGETHER:
                    yield out(ids, keys, sets)
                    ids, keys, sets, held = [], [], [], 0
            if ids:
                yield out(ids, keys, sets)

    return run


def exact_shingles(text: bytes, width: int) -> frozenset:
    words = text.lower().split()
    if len(words) <= width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[i:] for i in range(width)), strict=False))


def _confirm(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, frozenset()
        for batch in small(batches, "text_b"):
            keep = []
            for a, ta, tb in zip(batch.column("a").to_pylist(), binary(batch.column("text_a")), binary(batch.column("text_b")), strict=True):
                if a != last:
                    last, one = a, exact_shingles(ta, width)
                other = exact_shingles(tb, width)
                shared = len(one & other)
                keep.append(100 * shared >= percent * (len(one) + len(other) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    of = lambda n: texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}"))
    told = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "text_a", "text_b")
    return told.mapInArrow(tidy(_confirm(width, percent)), "a binary, b binary").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _shingles(width: int):
    """(node, shingle) rows of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHash()
        for batch in small(batches):
            nodes, sets = batch.column("node").to_pylist(), [shingle_hashes(t.lower().split(), hashes, width) for t in binary(batch.column("text"))]
            for start in range(0, len(sets), 64):
                some = sets[start : start + 64]
                repeated = np.repeat(np.arange(len(some)), [len(s) for s in some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[start : start + 64], pa.binary()).take(pa.array(repeated)), pa.array(np.concatenate(some).view(np.int64))],
                    names=["node", "shingle"],
                )

    return run


def _alike(apart: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of different components that can be similar enough.

    ``apart`` has node, n (its shingles) and root. A pair of the similarity shares one of the
    n - ceil(n * percent / 100) + 1 first shingles of each in any order that all agree on; here
    rare ones go first, so shingles that many classes have are in few prefixes. A shingle of
    one class only takes a place but makes no pairs.
    """
    found = write_scratch(apart.select("node").join(texts, "node").mapInArrow(tidy(_shingles(width)), "node binary, shingle bigint"))
    often = found.groupBy("shingle").agg(F.count("*").alias("f")).filter("f > 1")
    by_node = Window.partitionBy("node")
    known = found.join(often, "shingle").select(
        "node",
        "shingle",
        F.row_number().over(by_node.orderBy("f", "shingle")).alias("rank"),
        F.count("*").over(by_node).alias("common"),
    )
    least = lambda n: F.floor((F.lit(percent) * n + 99) / 100)
    at = F.col("n") - F.col("common") + F.col("rank") - 1
    prefix = known.join(apart, "node").withColumn("at", at).filter(F.col("at") <= F.col("n") - least(F.col("n")))
    prefix = write_scratch(prefix.select("node", "n", "root", "shingle", "at"))
    of = lambda k: prefix.select("shingle", *[F.col(c).alias(f"{c}_{k}") for c in ("node", "n", "root", "at")])
    size = lambda k: F.col(f"n_{k}")
    # From the first shingle in common on, so many more can be.
    rest = F.least(size("a") - F.col("at_a"), size("b") - F.col("at_b"))
    can_reach = F.lit(100 + percent) * rest >= F.lit(percent) * (size("a") + size("b"))
    near = F.lit(100) * F.least(size("a"), size("b")) >= F.lit(percent) * F.greatest(size("a"), size("b"))
    left, right = of("a"), of("b")
    same = (left["shingle"] == right["shingle"]) & (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
    return left.join(right, same & near & can_reach).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def classes(docs: DataFrame, width: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_shingles, component_id, first_key.

    ``component_id`` is the least doc_id of the row's component, itself included;
    ``text_key`` the MD5 of the row's text and ``first_key`` the least text_key among the
    rows of the component that carry component_id. A null or empty text, or one of white
    space, has no shingles and is a component of its own. Rows with null ids take part;
    their component_id is null only if all their component's ids are. Repeated ids are
    fine. An empty table gives no rows. Other columns are not read.
    """
    texts = id_and_text(docs, id_col, text_col)
    rows = write_scratch(
        texts.mapInArrow(tidy(_sketch(width)), "doc_id bigint, text_key string, n_shingles bigint, node binary, bands array<bigint>")
    )
    full = rows.filter("node IS NOT NULL")
    nodes = write_scratch(
        full.groupBy("node").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"),
            F.first("n_shingles").alias("n"),
            F.count("*").alias("copies"),
            F.first("bands").alias("bands"),
        )
    )
    placed = nodes.select("node", "n", "copies", F.posexplode("bands").alias("band", "bucket"))
    held = placed.groupBy("band", "bucket").agg(F.count("*").alias("members"), F.max(F.struct("copies", "node", "n")).alias("hub"))
    shared = write_scratch(
        placed.join(held.filter("members > 1"), ["band", "bucket"]).select("band", "bucket", "node", "n", "hub")
    )
    near = lambda a, b: (F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b))
    # Texts of the classes that any bucket brings together, one a class.
    wanted = shared.select("node").distinct().join(nodes.select("node", "first"), "node")
    fetched = wanted.select("node", F.col("first.doc_id").alias("want_id"), F.col("first.text_key").alias("want_key")).join(
        texts, (F.col("want_key") == F.md5(F.col("text").cast("binary"))) & F.col("want_id").eqNullSafe(F.col("doc_id"))
    )
    found = write_scratch(fetched.select("node", "text").dropDuplicates(["node"]))

    first = shared.filter(F.col("node") != F.col("hub.node")).filter(near(F.col("n"), F.col("hub.n")))
    links = write_scratch(_confirmed(first.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct(), found, width, percent))
    roots = write_scratch(components(links))
    # Buckets that still hold classes apart.
    known = shared.join(roots, "node", "left").select("band", "bucket", "node", "n", F.coalesce("root", "node").alias("root"))
    apart = known.groupBy("band", "bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi")
    apart = write_scratch(known.join(apart.select("band", "bucket"), ["band", "bucket"], "left_semi").select("node", "n", "root").distinct())
    more = write_scratch(_confirmed(_alike(apart, found, width, percent), found, width, percent))
    if not more.isEmpty():
        roots = write_scratch(components(links.unionByName(more)))
    member = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    member = write_scratch(member)
    least = member.groupBy("root").agg(F.min("first").alias("least"))
    answer = member.select("node", "root").join(least, "root").select(
        "node", F.col("least.doc_id").alias("component_id"), F.col("least.text_key").alias("first_key")
    )
    joined = full.drop("bands").join(answer, "node").select("doc_id", "text_key", "n_shingles", "component_id", "first_key")
    alone = rows.filter("node IS NULL").select(
        "doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.col("text_key").alias("first_key")
    )
    return joined.unionByName(alone)


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns. ``kept`` of a row without id is false unless its
    component has no id at all."""
    return classes(docs).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def kept_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all columns; exactly repeated rows count once.

    Documents without words are no copies of anything and stay.
    """
    keys = write_scratch(classes(docs, width, percent))
    first = keys.filter((F.col("n_shingles") == 0) | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("first_key"))))
    row, key = free_names(docs, "id", "key")
    first = first.select(F.col("doc_id").alias(row), F.col("text_key").alias(key)).distinct()
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col(row)) & (F.md5(text.cast("binary")) == F.col(key))
    kept = docs.join(first.hint("shuffle_hash"), same)
    # Rows that share id and text are one document.
    return kept.dropDuplicates([row, key]).select(*[F.col(f"`{c}`") for c in docs.columns])
