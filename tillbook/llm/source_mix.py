"""Mixing sources to target weights with a low-discrepancy schedule; DataFrame functions only.

Each source's documents are put in a shuffled order and its words cut into blocks of
equal size. Slot k of the schedule draws the golden-ratio point frac(k * phi) and maps
it through the sources' cumulative shares; its rank among its source's slots names the
block it takes (and the epoch, once the source is used up). Any run of slots thus holds
every source close to its share. Slots a source still lacks at the end, a few per
source, follow the schedule; slots beyond its quota are dropped, so each source's words
meet its target to the word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.columns import WORD, free_names
from tillbook.sources.scratch import write_scratch

#: Words in a block.
BLOCK_WORDS = 1024
#: Rows ordered by one task: the shuffled order is cut by hash into pieces of about this size.
PIECE_ROWS = 20_000
#: Consecutive slots ranked by one task.
SLOT_RUN = 1 << 16
GOLDEN = 0.6180339887498949
#: Cells in which points look for their source.
GRID = 1024


@dataclass(frozen=True)
class Mix:
    """``documents``: doc_id, size, source_size, target, taken, and k and shuffled, which
    name the source and the row's content. ``segments``: the mix in
    slot order: slot, epoch, source, doc_id, from_word, n_words."""

    documents: DataFrame
    segments: DataFrame


def _key(source: Column) -> Column:
    """Never null, null last, otherwise in code point order."""
    return F.when(source.isNull(), F.lit("\U0010ffff")).otherwise(F.concat(F.lit("s"), source))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Per source: source_size, weight, target, quota words.

    ``sizes``: skey, source_size; one row per source, so one window over it is small.
    Capping at ``most`` times the size and resharing by weight until none is above fills
    the sources in order of cap / weight: each gets min(cap, weight * level).
    """
    order = Window.orderBy("skey")
    cycle = F.array(*[F.lit(w).cast("double") for w in weights])
    weighed = sizes.withColumn("at", F.row_number().over(order) - 1).select(
        "skey",
        "source_size",
        F.element_at(cycle, F.pmod("at", F.lit(len(weights))) + 1).alias("weight"),
        (F.col("source_size") * F.lit(most)).alias("cap"),
    )
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = weighed.select(
        "*",
        (
            (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(onward)
        ).alias("level"),
    )
    # The level at the first source that it does not fill; those before are capped.
    open_level = F.max(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))).over(everything)
    target = F.least("cap", F.coalesce(F.col("weight") * open_level, F.col("cap")))
    return levels.select("skey", "source_size", "weight", target.alias("target")).withColumn(
        "quota", F.round("target").cast("bigint")
    )


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS, slot_run: int = SLOT_RUN) -> DataFrame:
    """Slots of the mix: slot, skey, epoch, block, words.

    ``targets``: skey, source_size, quota. Ranks come from counts per run of slots, so no
    source's slots meet in one task.
    """
    spark = targets.sparkSession
    size, quota, width = F.col("source_size"), F.col("quota"), F.lit(block_words)
    per_epoch = F.ceil(size / width).cast("bigint")
    full = F.when(size > 0, F.floor(quota / size)).otherwise(F.lit(0)).cast("bigint")
    needed = full * per_epoch + F.ceil((quota - full * size) / width).cast("bigint")
    plan = write_scratch(
        targets.select("skey", "source_size", "quota", per_epoch.alias("per_epoch"), needed.alias("needed")).filter("needed > 0")
    )
    total = plan.agg(F.sum("needed")).first()[0] or 0
    by_key = Window.orderBy("skey")
    upper = F.sum("needed").over(by_key.rowsBetween(Window.unboundedPreceding, 0)) / F.lit(max(total, 1))
    bounds = plan.select("skey", upper.alias("upper")).select(
        "skey",
        F.lag("upper", 1, 0.0).over(by_key).alias("lower"),
        F.when(F.lead("skey").over(by_key).isNull(), F.lit(2.0)).otherwise(F.col("upper")).alias("upper"),
    )
    # Each point meets only the sources of its cell: an equality join, not a range join.
    cell = lambda x: F.least(F.floor(x * F.lit(GRID)), F.lit(GRID - 1))
    cells = bounds.select("*", F.explode(F.sequence(cell(F.col("lower")), cell(F.col("upper")))).alias("cell"))
    high = F.shiftright("slot", 20)
    rest = F.col("slot") - F.shiftleft(high, 20)
    turn = F.lit((GOLDEN * 2**20) % 1.0)
    point = high * turn - F.floor(high * turn) + rest * F.lit(GOLDEN)
    tasks = max(1, min(total // 50_000 + 1, 100_000))
    points = spark.range(0, total, 1, tasks).select(F.col("id").alias("slot"))
    points = points.select("slot", (point - F.floor(point)).alias("x")).withColumn("cell", cell(F.col("x")))
    named = points.join(cells, "cell").filter("lower <= x AND x < upper").select("slot", "skey")
    named = named.withColumn("run", F.floor(F.col("slot") / F.lit(slot_run)))
    counts = named.groupBy("skey", "run").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("skey").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("skey", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("skey", "run").orderBy("slot")) - 1
    ranked = named.select("slot", "skey", "run", place.alias("place")).join(starts, ["skey", "run"]).select(
        "slot", "skey", (F.col("place") + F.col("before")).alias("rank")
    )
    # What the schedule leaves short, at most about log(slots) a source.
    reached = counts.groupBy("skey").agg(F.sum("n").alias("reached"))
    short = (
        plan.join(reached, "skey", "left")
        .select("skey", F.coalesce("reached", F.lit(0)).alias("reached"), "needed")
        .filter("reached < needed")
        .select("skey", F.explode(F.sequence("reached", F.col("needed") - 1)).alias("rank"))
    )
    late = short.select((F.lit(total) + F.row_number().over(Window.orderBy("rank", "skey")) - 1).alias("slot"), "skey", "rank")
    slots = ranked.unionByName(late).join(F.broadcast(plan), "skey").filter("rank < needed")
    epoch = F.floor(F.col("rank") / F.col("per_epoch")).cast("bigint")
    placed = slots.select("slot", "skey", epoch.alias("epoch"), (F.col("rank") - epoch * F.col("per_epoch")).alias("block"), "source_size", "quota")
    words = F.least(
        F.lit(block_words).cast("bigint"),
        F.col("source_size") - F.col("block") * block_words,
        F.col("quota") - F.col("epoch") * F.col("source_size") - F.col("block") * block_words,
    )
    return placed.select("slot", "skey", "epoch", "block", words.alias("words"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = BLOCK_WORDS,
    piece_rows: int = PIECE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mix:
    """Mix the documents to ``share`` of all words, no source above ``most`` times its size.

    Every row counts, also rows with null or repeated ids; a null text has size 0; the
    null source is one source, ordered last. Sources without words have target 0. Order
    and results depend on the rows alone, so reruns agree. An empty table gives empty
    frames. Other columns are not read.
    """
    # A word starts at a non-space after a space or the start: one pass, no array of words.
    size = F.when(docs[text_col].isNull(), F.lit(0)).otherwise(F.regexp_count(docs[text_col], F.lit(WORD)))
    rows = write_scratch(
        docs.select(
            docs[id_col].cast("bigint").alias("doc_id"),
            docs[source_col].cast("string").alias("source"),
            _key(docs[source_col].cast("string")).alias("skey"),
            size.cast("bigint").alias("size"),
            F.xxhash64(docs[id_col], docs[text_col]).alias("shuffled"),
        )
    )
    n_rows = rows.count()
    pieces = max(1, n_rows // piece_rows + 1)
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("shuffled"), F.lit(pieces)))
    by_piece = rows.groupBy("skey", "piece").agg(F.sum("size").alias("piece_size"))
    sizes = by_piece.groupBy("skey").agg(F.sum("piece_size").alias("source_size"))
    targets = write_scratch(source_targets(sizes, weights, share, most))
    slots = schedule(targets, block_words)

    earlier = Window.partitionBy("skey").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_piece.select("skey", "piece", F.coalesce(F.sum("piece_size").over(earlier), F.lit(0)).alias("before"))
    offsets = offsets.join(targets.select("skey", "source_size", "target"), "skey")
    within = Window.partitionBy("skey", "piece").orderBy("shuffled", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(offsets, ["skey", "piece"]).withColumn("from", F.col("before") + F.col("inside"))
    # Rows are told apart by where they stand in the shuffled order; empty ones share a place.
    kept = write_scratch(placed.select("doc_id", "source", "skey", "size", "source_size", "target", "from", "shuffled"))

    width = F.lit(block_words)
    first, final = F.floor(F.col("from") / width), F.floor((F.col("from") + F.col("size") - 1) / width)
    pieces_of = kept.filter("size > 0").select(
        "doc_id", "source", "skey", "from", "size", F.explode(F.sequence(first, final)).alias("block")
    )
    start = F.greatest(F.col("from"), F.col("block") * width)
    end = F.least(F.col("from") + F.col("size"), F.col("block") * width + F.col("words"))
    segments = (
        pieces_of.join(slots, ["skey", "block"])
        .select(
            "slot", "epoch", "source", "skey", "doc_id", "from",
            (start - F.col("from")).alias("from_word"), (end - start).alias("n_words"),
        )
        .filter("n_words > 0")
    )
    taken = segments.groupBy("skey", "from").agg(F.sum("n_words").alias("taken"))
    known = kept.withColumnRenamed("skey", "k").withColumnRenamed("from", "f")
    documents = known.join(
        taken, (F.col("k") == F.col("skey")) & (F.col("f") == F.col("from")) & (F.col("size") > 0), "left"
    ).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "k", "shuffled"
    )
    return Mix(documents, segments.select("slot", "epoch", "source", "doc_id", "from_word", "n_words"))


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns."""
    return mix(docs).documents.select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as whole documents: each as often as the mix takes its words, rounded.

    Columns are those of ``docs``; documents of which the mix takes less than half go.
    Repeated rows share what they are taken together.
    """
    key, shuffled, copies, copy = free_names(docs, "key", "shuffled", "copies", "copy")
    taken = mix(docs).documents.filter("size > 0").groupBy("k", "shuffled").agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("times")
    )
    taken = taken.filter("times > 0").select(
        F.col("k").alias(key), F.col("shuffled").alias(shuffled), F.expr("sequence(1, times)").alias(copies)
    )
    same = (_key(docs["source"].cast("string")) == F.col(key)) & (F.xxhash64(docs["doc_id"], docs["text"]) == F.col(shuffled))
    met = docs.join(taken.hint("shuffle_hash"), same).withColumn(copy, F.explode(copies))
    return met.select(*[F.col(f"`{c}`") for c in docs.columns])
