"""License scan: exact set-similarity join of text blocks with license templates.

A block (a window of words) matches a template when it holds at least ``threshold`` of
the template's distinct words. All words of the templates are put in one order, rarest
in the corpus first. A matching block must share a word with the template's prefix (its
rarest words, just enough that the rest could not reach the threshold alone); it must
have enough template words at all (length filter); and from the first shared word on,
enough must be left on both sides (positional filter). What passes is counted in full,
so every matching block is found and nothing else.

The templates are a fixed list, so their prefix index is a few hundred entries and goes
to every task; the documents never move. Their word frequencies come from one pass over
all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.columns import binary, by_batch, id_and_text

#: Phrases whose consecutive words count as base hits, and their labels (fixed values).
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Notices as they stand in texts; labels of the method's own.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0-notice", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit-release", "released under the mit license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means"),
)
THRESHOLD = 0.85
#: Blocks overlap by half, so a notice of up to half a block lies whole in one. A template of
#: more words than that has blocks of twice its length.
BLOCK_WORDS = 64

#: A-Z to a-z; digits, letters and all bytes of longer characters stay; the rest is space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def fold_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and any other characters."""
    return text.translate(FOLD).split()


def template_sets(templates: tuple[tuple[str, str], ...]) -> dict[str, frozenset[bytes]]:
    return {label: frozenset(fold_words(text.encode())) for label, text in templates}


def word_frequencies(texts: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each template word stands; one row per template word at the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in binary(batch.column("text")):
                seen.update(vocabulary.intersection(fold_words(text)))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    sums = texts.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in sums.collect()}


def block_lengths(templates: tuple[tuple[str, str], ...], block_words: int) -> dict[int, list[str]]:
    """Words of a block -> the templates that are looked for in such blocks."""
    out: dict[int, list[str]] = {}
    for label, text in templates:
        out.setdefault(max(block_words, 2 * len(fold_words(text.encode()))), []).append(label)
    return out


class PrefixIndex:
    """Rare words -> the templates they may stand for."""

    def __init__(self, sets: dict[str, frozenset[bytes]], frequency: dict[bytes, int], threshold: float):
        words = sorted(frozenset().union(*sets.values()), key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(words)}
        self.templates = {label: sorted(self.rank[w] for w in s) for label, s in sets.items()}
        self.needed = {label: math.ceil(round(threshold * len(s), 9)) for label, s in sets.items()}
        self.by_rank: dict[int, list[tuple[str, int]]] = {}
        for label, ranks in self.templates.items():
            for at, r in enumerate(ranks[: len(ranks) - self.needed[label] + 1]):
                self.by_rank.setdefault(r, []).append((label, at))
        self.rare = frozenset(words[r] for r in self.by_rank)

    def matches(self, block: list[int]) -> Iterator[tuple[str, float]]:
        """Templates that a block, as sorted distinct ranks, contains; with the share."""
        tried = set()
        for at, r in enumerate(block):
            for label, place in self.by_rank.get(r, ()):
                if label in tried:
                    continue
                tried.add(label)
                ranks, needed = self.templates[label], self.needed[label]
                if len(block) < needed or 1 + min(len(ranks) - place, len(block) - at) - 1 < needed:
                    continue
                shared = len(set(ranks).intersection(block))
                if shared >= needed:
                    yield label, shared / len(ranks)


def find_blocks(words: list[bytes], index: PrefixIndex, block_words: int) -> list[tuple[str, int, int, float]]:
    """(label, first word, end word, share) of every block that contains a template."""
    found = []
    if index.rare.isdisjoint(words):
        return found
    step = max(1, block_words // 2)
    ranks = [index.rank.get(w, -1) for w in words]
    for start in range(0, max(1, len(words) - step), step):
        block = sorted({r for r in ranks[start : start + block_words] if r >= 0})
        found += [(label, start, min(len(words), start + block_words), share) for label, share in index.matches(block)]
    return found


def find_phrases(words: list[bytes], phrases: list[tuple[bytes, str]]) -> list[tuple[str, int]]:
    """(label, first word) of each place where a phrase's words stand in a row."""
    text = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases:
        # The words before a hit are those before the last one and those since.
        word, last, at = 0, 0, text.find(phrase)
        while at >= 0:
            word += text.count(b" ", last, at)
            found.append((label, word))
            last, at = at, text.find(phrase, at + 1)
    return found


SCHEMA = (
    "doc_id bigint, n_words bigint, phrases array<struct<label:string,word:bigint>>, "
    "blocks array<struct<label:string,first_word:bigint,end_word:bigint,share:double>>"
)
PLACE = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
BLOCK = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("share", pa.float64())]))


def scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: its number of words, its phrases and its blocks that match.

    A template may have any number of words; blocks have ``block_words``, or twice those of a
    template that half a block cannot hold. A null or empty text has no words, phrases or blocks; repeated rows and ids each get
    a row; an empty table gives none; other columns are not read.
    """
    texts = id_and_text(docs, id_col, text_col)
    sets = template_sets(templates)
    frequency = word_frequencies(texts, frozenset().union(*sets.values()))
    indexes = {
        n: PrefixIndex({label: sets[label] for label in labels}, frequency, threshold)
        for n, labels in block_lengths(templates, block_words).items()
    }
    phrases = [(b" " + p.encode() + b" ", label) for p, label in PHRASES]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, places, blocks = [], [], []
        for text in binary(batch.column("text")):
            words = fold_words(text)
            n_words.append(len(words))
            places.append([{"label": a, "word": w} for a, w in find_phrases(words, phrases)])
            found = [b for n, index in indexes.items() for b in find_blocks(words, index, n)]
            blocks.append([dict(zip(("label", "first_word", "end_word", "share"), b, strict=True)) for b in found])
        arrays = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(places, PLACE), pa.array(blocks, BLOCK)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "phrases", "blocks"])

    return by_batch(texts, work, SCHEMA, "text")


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns; the score is the best share found, 1 for a phrase."""
    labels = lambda c: F.array_sort(F.array_distinct(c))
    own, theirs = F.transform("phrases", lambda p: p["label"]), F.transform("blocks", lambda b: b["label"])
    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min(F.transform("phrases", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("phrases", lambda p: p["word"])).alias("last_word"),
        F.array_join(labels(own), ",").alias("base_labels"),
        F.array_join(labels(F.concat(own, theirs)), ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(F.transform("blocks", lambda b: b["share"])), F.lit(0.0)))
        .alias("score"),
    )
