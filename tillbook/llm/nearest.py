"""Approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (alternating between binary codes and the best
rotation towards them) turns each vector into BITS signs. Codes are split into
SUBSTRINGS; each is an index of its own. If two codes differ in at most
SUBSTRINGS * (radius + 1) - 1 places, some substring differs in at most ``radius``, so
taking every vector within ``radius`` of a query in some substring finds every code
within that Hamming distance (and many beyond). What is found is ranked by the
exact cosine of the original vectors. Queries that find fewer than they ask for search
again, first without a limit of distance and then through all vectors.

Vectors lie packed in parts, queries in blocks, both stored once; nothing is copied for
each other's sake. Each task reads a run of parts and a few blocks, and works through
them tile by tile: a product of short floats tells which pairs could still be among a
query's best, only their codes and exact cosines are worked out, and the task returns
only each query's best of its parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tillbook.llm.columns import tidy
from tillbook.sources.scratch import write_scratch

BITS, SUBSTRINGS, RADIUS = 64, 4, 6
WIDTH = BITS // SUBSTRINGS
#: Codes further apart than this are not ranked.
RERANK_DISTANCE = 36
#: Vectors on which the rotation is learned, those with the least id hashes.
SAMPLE = 20_000
#: Vectors of a part or a block: so many, or fewer if their doubles take more bytes.
PART_ROWS, PART_BYTES = 8_192, 8 << 20
#: A task meets about so many vectors of the index, and blocks of so many bytes, as it holds them.
TASK_ROWS, TASK_BYTES = 1 << 20, 24 << 20
#: Queries and vectors compared at once, and the bytes of pairs whose cosines are worked out at once.
TILE, PAIR_BYTES = (512, 4_096), 16 << 20
#: Parts are large rows: a row group ends by bytes, not after a hundred rows.
SMALL_GROUPS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}


def learn_rotation(sample: np.ndarray, rounds: int = 30) -> np.ndarray:
    """dims x BITS: leading directions (or random ones, if dims are few), rotated to fit signs."""
    rng = np.random.default_rng(7)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    dims = unit.shape[1]
    if dims < BITS:
        lift = np.linalg.qr(rng.normal(size=(BITS, dims)))[0].T
    else:
        lift = np.linalg.eigh(unit.T @ unit)[1][:, -BITS:]
    low = unit @ lift
    turn = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0]
    for _ in range(rounds):
        signs = np.where(low @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ low)
        turn = (left @ right).T
    return lift @ turn


def codes_of(vectors: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    bits = (vectors @ rotation) >= 0
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def _substrings(codes: np.ndarray) -> np.ndarray:
    shifts = np.arange(SUBSTRINGS, dtype=np.uint64) * np.uint64(WIDTH)
    return ((codes[:, None] >> shifts) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)


def reached(a: np.ndarray, b: np.ndarray, radius: int | None, limit: int) -> np.ndarray:
    """Pairs of codes within ``radius`` in some substring, if given, and within ``limit``."""
    apart = a ^ b
    found = np.bitwise_count(apart) <= limit
    if radius is not None:
        found &= np.bitwise_count(_substrings(apart)).min(axis=1, initial=WIDTH) <= radius
    return found


class Packed:
    """Vectors of a part or a block, as tasks compare them."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, raw: np.ndarray):
        self.ids, self.codes, self.vectors = ids, codes, _scaled(raw)
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))
        self.unit = (self.vectors / self.norms[:, None]).astype(np.float32)


class Best:
    """The ``k`` nearest ids of each query of a block found so far, in order."""

    def __init__(self, queries: int, k: int):
        self.ids, self.scores = np.zeros((queries, k), np.int64), np.full((queries, k), -np.inf)
        # Vectors that the queries of a tile have met.
        self.met = np.zeros(queries // TILE[0] + 1, np.int64)

    def add(self, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """More finds; ``queries``: whose they are, by place. An id counts once, with its best score."""
        again, k = np.unique(queries), self.scores.shape[1]
        q = np.concatenate((np.repeat(again, k), queries))
        i, s = np.concatenate((self.ids[again].ravel(), ids)), np.concatenate((self.scores[again].ravel(), scores))
        self.scores[again] = -np.inf
        order = np.lexsort((-s, i, q))
        order = order[s[order] > -np.inf]
        same = (q[order][1:] == q[order][:-1]) & (i[order][1:] == i[order][:-1])
        order = order[np.concatenate(([True], ~same))]
        order = order[np.lexsort((i[order], -s[order], q[order]))]
        q, i, s = q[order], i[order], s[order]
        starts = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(starts, append=len(q)))
        kept = rank < k
        self.ids[q[kept], rank[kept]], self.scores[q[kept], rank[kept]] = i[kept], s[kept]


def compare(block: Packed, part: Packed, best: Best, radius: int | None, limit: int) -> None:
    """Adds to ``best`` the vectors of the part that are reached and near enough."""
    dims = block.unit.shape[1]
    # More than twice what rounding to short floats, and adding them up, can change.
    slack = (dims + 8) * 2.0**-23
    pairs = max(1, PAIR_BYTES // (16 * dims))
    for tile, start in enumerate(range(0, len(block.ids), TILE[0])):
        some, at = slice(start, start + TILE[0]), 0
        while at < len(part.ids):
            # Few at first: until each query has found some, all pairs must be looked at.
            end = at + min(TILE[1], max(64, 4 * int(best.met[tile])))
            near = block.unit[some] @ part.unit[at:end].T
            least = (best.scores[some, -1] - slack).astype(np.float32)
            rows = np.flatnonzero(near.max(axis=1) >= least)
            q, x = np.nonzero(near[rows] >= least[rows, None])
            q, x = rows[q] + start, x + at
            for i in range(0, len(q), pairs):
                a, b = q[i : i + pairs], x[i : i + pairs]
                kept = reached(block.codes[a], part.codes[b], radius, limit) & (block.ids[a] != part.ids[b])
                a, b = a[kept], b[kept]
                if len(a):
                    scores = np.einsum("ij,ij->i", part.vectors[b], block.vectors[a]) / (part.norms[b] * block.norms[a])
                    best.add(a, part.ids[b], scores)
            best.met[tile] += near.shape[1]
            at = end


def usable(embedding: Column) -> Column:
    """Not null, all components finite, not all zero."""
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & whole & F.exists(embedding, lambda x: x != 0), F.lit(False))


def vectors_of(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Ids and vectors that take part; floats stay floats, other numbers become doubles."""
    kind = table.select(table[vector_col]).schema[0].dataType
    short = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    vectors = table.select(
        table[id_col].cast("bigint").alias("vec_id"), table[vector_col].cast("array<float>" if short else "array<double>").alias("embedding")
    )
    return vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))


def _rows(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """A vector a row, as stored."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Doubles, each vector scaled by a power of two to a largest component of 1/2 to 1.

    That changes no digit of a cosine, and products neither overflow nor vanish.
    """
    rows = rows.astype(np.float64)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, initial=0.0))[1][:, None])


PACKED = pa.schema([("place", pa.int64()), ("ids", pa.binary()), ("codes", pa.binary()), ("vectors", pa.binary())])


def _pack(place: int, ids: np.ndarray, raw: np.ndarray, rotation: np.ndarray) -> pa.RecordBatch:
    values = (place, ids.tobytes(), codes_of(_scaled(raw), rotation).tobytes(), raw.tobytes())
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, PACKED.types, strict=True)], schema=PACKED)


def _parts(dims: int, rows: int, rotation: np.ndarray):
    """Each task's vectors, packed as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, raw = TaskContext.get().partitionId() << 32, [], []
        held = 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                some = batch.slice(start, rows - held)
                start, held = start + some.num_rows, held + some.num_rows
                ids.append(some.column("vec_id").to_numpy())
                raw.append(_rows(some.column("embedding"), dims))
                if held == rows:
                    yield _pack(place, np.concatenate(ids), np.concatenate(raw), rotation)
                    place, ids, raw, held = place + 1, [], [], 0
        if held:
            yield _pack(place, np.concatenate(ids), np.concatenate(raw), rotation)

    return run


def _blocks(dims: int, rotation: np.ndarray):
    """A group's vectors, packed."""

    def run(table: pa.Table) -> pa.Table:
        packed = _pack(table.column("place")[0].as_py(), table.column("vec_id").to_numpy(), _rows(table.column("embedding"), dims), rotation)
        return pa.Table.from_batches([packed])

    return run


def _sample(vectors: DataFrame, n: int) -> pa.Table:
    """The SAMPLE vectors with the least id hashes, or all."""
    order = F.xxhash64("vec_id")
    # Hashes are spread evenly, so a few more than that lie below this one.
    share = (SAMPLE + 8 * SAMPLE**0.5) / n
    low = vectors.filter(order <= int((2 * share - 1) * 2.0**63)) if share < 1 else vectors
    found = low.orderBy(order, "vec_id").limit(SAMPLE).select("embedding").toArrow()
    if found.num_rows < min(SAMPLE, n):
        found = vectors.orderBy(order, "vec_id").limit(SAMPLE).select("embedding").toArrow()
    return found


def search(
    table: DataFrame,
    is_query: Column,
    k: int = 5,
    radius: int = RADIUS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each row with ``is_query``.

    ``is_query`` is a condition on vec_id. Vectors that are null, zero or hold null or
    non-finite components take no part, nor do rows without an id or with another number
    of components than most; ties go to the smaller vec_id; a row never finds its own id;
    a candidate found more than once counts once. Empty tables give no rows; other columns
    are not read.
    """
    spark = table.sparkSession
    vectors = write_scratch(vectors_of(table, id_col, vector_col))
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    size = vectors.groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").first()
    if size is None:
        return spark.createDataFrame([], schema)
    dims, n = size["dims"], size["n"]
    vectors = vectors.filter(F.size("embedding") == dims)
    kind = np.float32 if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else np.float64
    rotation = learn_rotation(_scaled(_rows(_sample(vectors, n).column("embedding"), dims)))
    rows = max(1, min(PART_ROWS, PART_BYTES // (8 * dims)))
    packed = "place bigint, ids binary, codes binary, vectors binary"
    # Few vectors in many files make few parts.
    together = vectors.select("vec_id", "embedding").coalesce(n // rows + 1)
    index = write_scratch(together.mapInArrow(tidy(_parts(dims, rows, rotation)), packed), **SMALL_GROUPS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def nearest(queries: DataFrame, n_queries: int, radius: int | None, limit: int) -> DataFrame:
        place = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_queries // rows + 1)).cast("bigint")
        blocks = queries.withColumn("place", place).groupBy("place").applyInArrow(tidy(_blocks(dims, rotation)), packed)
        asked = write_scratch(blocks, **SMALL_GROUPS).select(*[F.col(c).alias(f"q_{c}") for c in PACKED.names])
        # A task reads some of the blocks, all of which it holds, and parts one by one. Both come from
        # where they are stored; with more cores than that gives tasks, tasks have fewer parts.
        few = -(-n_queries * 12 * dims // TASK_BYTES) or 1
        many = max(-(-n // TASK_ROWS), -(-4 * spark.sparkContext.defaultParallelism // few))
        at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        parts, blocks = index.coalesce(many).withColumn("at", at), asked.coalesce(few).withColumn("q_at", at)
        # Each part comes with the task's first block, and each block with its first part: once.
        once = [F.when(F.col("q_at") == 0, F.col(c)).alias(c) for c in PACKED.names[1:]] + [F.when(F.col("at") == 0, F.col(f"q_{c}")).alias(f"q_{c}") for c in PACKED.names[1:]]
        met = parts.hint("shuffle_replicate_nl").crossJoin(blocks).select("place", "q_place", *once)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def read(batch: pa.RecordBatch, at: int, of: str) -> Packed:
                ids, codes, raw = (np.frombuffer(batch.column(of + c)[at].as_buffer(), t) for c, t in (("ids", np.int64), ("codes", np.uint64), ("vectors", kind)))
                return Packed(ids.copy(), codes.copy(), raw.reshape(-1, dims))

            held: dict[int, tuple[Packed, Best]] = {}
            now, part = None, None
            for batch in batches:
                for at, (p, b) in enumerate(zip(batch.column("place").to_pylist(), batch.column("q_place").to_pylist(), strict=True)):
                    if b not in held:
                        block = read(batch, at, "q_")
                        held[b] = block, Best(len(block.ids), k)
                    if p != now:
                        now, part = p, read(batch, at, "")
                    compare(held[b][0], part, held[b][1], radius, limit)
            for block, best in held.values():
                q, rank = np.nonzero(best.scores > -np.inf)
                columns = (block.ids[q], best.ids[q, rank], best.scores[q, rank])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

        found = met.mapInArrow(tidy(run), "query_id bigint, vec_id bigint, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        return write_scratch(found)

    queries = vectors.filter(is_query)
    found = nearest(queries, queries.count(), radius, RERANK_DISTANCE)
    # Most queries are done; the others look further, at last through all vectors.
    for further in (radius, None):
        done = found.filter(F.col("rank") == k).select("query_id")
        short = queries.join(done, F.col("vec_id") == F.col("query_id"), "left_anti")
        n_short = short.count()
        if not n_short:
            break
        found = found.join(done, "query_id", "left_semi").unionByName(nearest(short, n_short, further, BITS))
    return found.select("query_id", "rank", "vec_id", "score")


def digest(embeddings: DataFrame) -> DataFrame:
    """The registered query's columns."""
    return search(embeddings, F.col("vec_id") % 50 == 0)
