"""Quality rules by distribution divergence.

Each document's histogram of character classes and of common words is compared with its
language's reference by the Jensen-Shannon distance (base 2, between 0 and 1).
References are sums over all documents of a language, whatever its size: character
classes, and the most frequent words with all other words as one class. They are joined by
language. A text without a language is compared with all references and takes the nearest.
Short texts have rough histograms, so each comparison has a least length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.columns import binary, by_batch, free_names, small, tidy
from tillbook.sources.scratch import write_scratch

#: Character classes, told by the byte (by the first byte of a longer character).
CLASSES = ("lower", "upper", "digit", "space", "line end", "sentence", "symbol", "control", "other letter")
SENTENCE = b".,;:!?'\"-()"


def _class_table() -> np.ndarray:
    table = np.full(256, 6, np.uint8)
    for c in range(256):
        b = bytes([c])
        if b.islower():
            table[c] = 0
        elif b.isupper():
            table[c] = 1
        elif b.isdigit():
            table[c] = 2
        elif b in (b" ", b"\t"):
            table[c] = 3
        elif b in b"\n\r":
            table[c] = 4
        elif b in SENTENCE:
            table[c] = 5
        elif c < 32 or c == 127:
            table[c] = 7
        elif c >= 0xC0:
            table[c] = 8
        elif c >= 0x80:
            table[c] = 9  # inside a character
    return table


CLASS_TABLE = _class_table()


@dataclass(frozen=True)
class Limits:
    """``common``: words in a reference. Distances count from the least lengths on."""

    common: int = 64
    least_chars: int = 200
    least_words: int = 50
    most_chars_distance: float = 0.30
    most_words_distance: float = 0.45


def word_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    word_chars = len(text.translate(None, SPACES + CONTINUATION))  # code points
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    n_dup = len(lines) - len(set(lines))
    n = len(words)
    if n < 4:
        return word_chars, n_symbols, n_dup, 0
    # Windows as 64-bit mixes of the words' hashes: two different ones meet with odds of
    # about n * n / 2**65 in a document.
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * MIX
    windows = (h[:-2] * MIX + (h[1:-1] ^ (h[1:-1] >> np.uint64(32)))) * MIX + h[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return word_chars, n_symbols, n_dup, 0
    at = np.searchsorted(twice, windows)
    again = twice[np.minimum(at, len(twice) - 1)] == windows
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return word_chars, n_symbols, n_dup, int(covered.sum())


MIX = np.uint64(0x9E3779B97F4A7C15)
SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def class_histogram(text: bytes) -> np.ndarray:
    return np.bincount(CLASS_TABLE[np.frombuffer(text, np.uint8)], minlength=10)[:9]


#: Upper case to lower, punctuation to space.
PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + SENTENCE, bytes(range(97, 123)) + b" " * len(SENTENCE)
)


def plain_words(text: bytes) -> list[bytes]:
    """The words compared with a reference: in lower case, parted by space or punctuation."""
    return text.translate(PLAIN).split()


def js_distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row by row: square root of the Jensen-Shannon divergence of two histograms, base 2.

    A row without any count on either side has distance 0.
    """
    sums = p.sum(1, keepdims=True), q.sum(1, keepdims=True)
    p, q = (x / np.maximum(n, 1) for x, n in zip((p, q), sums, strict=True))
    m = (p + q) / 2
    parts = sum(x * np.log2(np.where(x > 0, x, 1) / np.where(x > 0, m, 1)) for x in (p, q))
    found = np.sqrt(np.maximum(0.0, parts.sum(1) / 2))
    return np.where((sums[0] * sums[1])[:, 0] > 0, found, 0.0)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    return float(js_distances(np.asarray(p, float)[None], np.asarray(q, float)[None])[0])


def _source(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    lang = docs[lang_col].cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
        lang.alias("lang"),
    )


#: Distinct words that a task holds before it hands its counts on.
MOST_HELD = 200_000


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word or class, n): sums of one task, over whole documents."""
    words_of: dict[str | None, Counter] = {}
    classes: dict[str | None, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        langs, keys, kinds, ns = [], [], [], []
        for lang, counts in words_of.items():
            langs += [lang] * len(counts)
            keys += counts
            kinds += [0] * len(counts)
            ns += counts.values()
        for lang, h in classes.items():
            langs += [lang] * 9
            keys += [b"%d" % i for i in range(9)]
            kinds += [1] * 9
            ns += h.tolist()
        words_of.clear()
        classes.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(keys, pa.binary()), pa.array(kinds, pa.int32()), pa.array(ns, pa.int64())],
            names=["lang", "word", "kind", "n"],
        )

    for batch in small(batches):
        for text, lang in zip(binary(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
            words_of.setdefault(lang, Counter()).update(plain_words(text))
            classes[lang] = classes.get(lang, 0) + class_histogram(text)
        if sum(map(len, words_of.values())) > MOST_HELD:
            yield out()
    if words_of:
        yield out()


def references(source: DataFrame, limits: Limits) -> DataFrame:
    """One row per language: its common words, their counts with the others' last, and its
    character classes. Rows without a language are in none."""
    sums = source.filter("lang IS NOT NULL").mapInArrow(tidy(_count_task), "lang string, word binary, kind int, n bigint")
    sums = write_scratch(sums.groupBy("lang", "word", "kind").agg(F.sum("n").alias("n")))
    total = sums.groupBy("lang").agg(F.sum(F.when(F.col("kind") == 0, F.col("n")).otherwise(0)).alias("total"))
    # Only the first rows of each group are kept before the shuffle.
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "word")
    top = sums.filter("n > 0 OR kind = 1").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max(limits.common, 9))
    top = top.filter((F.col("kind") == 1) | (F.col("rank") <= limits.common))
    listed = lambda kind, first: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct(first, "word", "n"))))
    by_lang = top.groupBy("lang").agg(listed(0, "rank").alias("w"), listed(1, "word").alias("c")).join(total, "lang")
    others = F.col("total") - F.aggregate("w.n", F.lit(0).cast("bigint"), lambda s, n: s + n)
    return write_scratch(
        by_lang.select(
            F.col("lang").alias("ref_lang"),
            F.col("w.word").alias("ref_words"),
            F.concat(F.col("w.n"), F.array(others)).alias("ref_counts"),
            F.col("c.n").alias("ref_classes"),
        )
    )


#: A language's documents are joined in so many shares where references are not broadcast.
SALTS = 32
#: References that a task compares with texts at once.
REFERENCES_AT_ONCE = 256
REF = ("ref_lang", "ref_words", "ref_counts", "ref_classes")


def _read_references(columns: list[list]) -> dict:
    return {
        lang: (places(words or []), np.array(counts or [0.0], float), np.array(classes or [0.0] * 9, float))
        for lang, words, counts, classes in zip(*columns, strict=True)
    }


def _nearest(texts: DataFrame, refs: DataFrame, limits: Limits) -> DataFrame:
    """row, lang: the reference from which the text of a row is the least far, as a share of the limits."""
    blocks = refs.withColumn("part", F.pmod(F.xxhash64("ref_lang"), F.ceil(F.lit(refs.count()) / REFERENCES_AT_ONCE)))
    blocks = blocks.groupBy("part").agg(F.collect_list(F.struct(*REF)).alias("refs")).select("refs")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = ([], [], [])
        for row, text, refs_ in zip(batch.column("row").to_pylist(), binary(batch.column("text")), batch.column("refs").to_pylist(), strict=True):
            known = _read_references([[r[c] for r in refs_] for c in REF])
            found = judge([text] * len(known), list(known), known, limits)
            far = [max((r[7] or 0) / limits.most_chars_distance, (r[8] or 0) / limits.most_words_distance) for r in found]
            best, lang = min(zip(far, known, strict=True))
            for o, x in zip(out, (row, lang, best), strict=True):
                o.append(x)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.string(), pa.float64()), strict=True)], names=["row", "lang", "far"])

    met = by_batch(texts.crossJoin(blocks), work, "row bigint, lang string, far double")
    return met.groupBy("row").agg(F.min(F.struct("far", "lang"))["lang"].alias("lang"))


def with_references(docs: DataFrame, limits: Limits, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``docs`` with four columns more: those of ``REF`` for its language's reference, or for the
    nearest, under names that ``docs`` does not have."""
    source = _source(docs, id_col, text_col, lang_col)
    refs = references(source, limits)
    mark, salt, row, *ref = free_names(docs, "lang_", "salt_", "row_", *REF)
    lang = docs[lang_col].cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    marked = docs.withColumn(mark, lang)
    unnamed = write_scratch(marked.filter(F.col(mark).isNull()).withColumn(row, F.monotonically_increasing_id()))
    texts = unnamed.select(F.col(row).alias("row"), F.coalesce(unnamed[text_col].cast("string"), F.lit("")).alias("text"))
    near = _nearest(texts, refs, limits).select(F.col("row").alias(row), F.col("lang").alias(mark))
    named = unnamed.drop(mark).join(near, row, "left").drop(row)
    both = marked.filter(F.col(mark).isNotNull()).unionByName(named)
    # Small references are broadcast by the optimiser, others meet their documents by language and share.
    both = both.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    shares = refs.select(
        F.col("ref_lang").alias(mark), *[F.col(c).alias(name) for c, name in zip(REF, ref, strict=True)],
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt),
    )
    return both.join(shares, [mark, salt], "left").select(*[F.col(f"`{c}`") for c in docs.columns], *ref)


def _judge_batch(batch: pa.RecordBatch, texts: pa.Array, limits: Limits) -> list[tuple]:
    """``judge`` with each language's reference read once a batch."""
    ref = batch.columns[-len(REF) :]
    langs = ref[0].to_pylist()
    firsts = pa.array(sorted({lang: i for i, lang in enumerate(langs)}.values()), pa.int64())
    known = _read_references([c.take(firsts).to_pylist() for c in ref])
    return judge(binary(texts), langs, known, limits)


def places(common: list[bytes]) -> dict[bytes, int]:
    """Common word -> its place; the last place is the others'."""
    return {w: i for i, w in enumerate(common)}


def judge(texts: list[bytes], langs: list, known: dict, limits: Limits) -> list[tuple]:
    """Per text: n_words, the four counts, base_failed, kept, the two distances (null below
    the lengths). ``known``: per language the common words' places and both references."""
    n_texts = len(texts)
    width = max(len(common) for _, common, _ in known.values())
    by_class, class_refs = np.zeros((2, n_texts, 9))
    by_word, word_refs = np.zeros((2, n_texts, width))
    bases, lengths = [], []
    for i, (text, lang) in enumerate(zip(texts, langs, strict=True)):
        words = text.split()
        n = len(words)
        counts = word_counts(text, words)
        bases.append((n, *counts, base_failed(n, counts[3])))
        place, common, classes = known[lang]
        if len(text) >= limits.least_chars:
            by_class[i], class_refs[i] = class_histogram(text), classes
        if n >= limits.least_words:
            plain, other = plain_words(text), len(common) - 1
            found = np.fromiter(map(place.get, plain, repeat(other)), np.int64, len(plain))
            by_word[i] = np.bincount(found, minlength=width)
            word_refs[i, : other + 1] = common
        lengths.append((len(text) >= limits.least_chars, n >= limits.least_words))
    by_chars, by_words = js_distances(by_class, class_refs), js_distances(by_word, word_refs)
    far = (by_chars > limits.most_chars_distance) | (by_words > limits.most_words_distance)
    return [
        (*base, not base[5] and not f, c if long[0] else None, w if long[1] else None)
        for base, long, f, c, w in zip(bases, lengths, far.tolist(), by_chars.tolist(), by_words.tolist(), strict=True)
    ]


VERDICT = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, chars_distance double, words_distance double"
)
NAMES = [x.split()[0] for x in VERDICT.split(", ")]


def rate(
    docs: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: the counts, the distances and the verdict.

    A null text has no words and fails; a text with a null or missing language is compared with
    all references and takes the nearest; without any reference nothing is far. Repeated ids each get a
    row, an empty table gives none, other columns are not read.
    """
    source = with_references(_source(docs, id_col, text_col, lang_col), limits, "doc_id", "text", "lang")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = _judge_batch(batch, batch.column("text"), limits)
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
        arrays = [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]]
        return pa.RecordBatch.from_arrays(arrays, names=NAMES)

    return by_batch(source, work, VERDICT, "text")


def kept_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""

    names = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [row[6] for row in _judge_batch(batch, batch.column("text").fill_null(""), limits)]
        return batch.select(names).filter(pa.array(keep, pa.bool_()))

    return by_batch(with_references(docs, limits, "doc_id", "text", "lang"), work, docs.schema, "text")
