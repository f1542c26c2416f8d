"""Large groups of near copies, column names of every kind, texts that strain a matcher, empty stages."""

import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm import linked, same

import corpus_pipeline
from tillbook.llm import license_scan, near_dup, nearest, pseudonyms, quality_rules, source_mix
from tillbook.llm.columns import free_names, small

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", f"src{d % 3 if d is not None else 9}", len(t or "")) for d, t in rows], DDL)


def variants(draw, base, n, least, most):
    """Texts of which between ``least`` and ``most`` of the words are others."""
    out = []
    for i in range(n):
        words = list(base)
        for at in draw.sample(range(len(words)), int(len(words) * draw.uniform(least, most))):
            words[at] = f"own{i}x{at}"
        out.append(" ".join(words))
    return out


def test_a_template_that_many_fill_in(spark):
    """600 texts about as similar as the threshold: chains, stars and many that stay apart."""
    draw = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    texts = variants(draw, base, 350, 0.02, 0.08) + variants(draw, base, 250, 0.0, 0.03)
    texts += [" ".join(base)] * 40 + [" ".join(base[:100] + [f"tail{i}y{k}" for k in range(20)]) for i in range(100)]
    rows = [(i, t) for i, t in enumerate(texts)]
    sets, least = linked(rows, 4)
    groups = {c: least.count(c) for c in set(least)}
    assert max(groups.values()) > 200 and sum(n == 1 for n in groups.values()) > 100
    same(near_dup.digest(table(spark, rows)), [(d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, least, strict=True)])


def test_prefixes_lose_no_pair(spark):
    """All pairs above the similarity among classes that are apart, and few others."""
    draw = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    texts = variants(draw, base, 120, 0.0, 0.08)
    found = spark.createDataFrame([(bytes([i]), t) for i, t in enumerate(texts)], "node binary, text string")
    sets = [near_dup.exact_shingles(t.encode(), 4) for t in texts]
    apart = spark.createDataFrame([(bytes([i]), len(s), bytes([i])) for i, s in enumerate(sets)], "node binary, n long, root binary")
    got = {(r["a"][0], r["b"][0]) for r in near_dup._alike(apart, found, 4, 80).collect()}
    want = {
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and 100 * len(a & b) >= 80 * len(a | b)
    }
    assert want and want <= got


CLASHES = (
    "ref_lang", "ref_words", "ref_counts", "ref_classes", "lang_", "salt_", "row_", "__lang", "__salt", "__row", "row",
    "id", "key", "__id", "__key", "id_", "k", "shuffled", "copies", "copy", "times", "__k", "__shuffled", "__copies",
)


def test_stages_keep_columns_of_any_name(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    docs = real.unionByName(real.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    for name in CLASHES:
        docs = docs.withColumn(name, F.lit(f"clash {name}"))
    for stage in (quality_rules.kept_documents, near_dup.kept_documents, source_mix.mixed_documents):
        out = stage(docs)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[name] == f"clash {name}" for r in rows for name in CLASHES)


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "ID int, id_ int, x int")
    assert free_names(df, "id", "x", "y", "y") == ["id__", "x_", "y", "y_"]


@pytest.mark.parametrize("rows", [[], [(None, None)], [(None, ""), (None, "one two"), (3, None)]])
def test_stages_on_next_to_nothing(spark, rows):
    docs = table(spark, rows)
    assert quality_rules.kept_documents(docs).collect() == []  # too short to be kept
    assert near_dup.kept_documents(docs).count() == len(rows)
    mixed = source_mix.mixed_documents(docs)
    assert mixed.columns == docs.columns and all(r["text"] and r["text"].strip() for r in mixed.collect())


def test_pipeline_on_an_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_texts_that_strain_the_matcher(spark):
    """A megabyte of what each pattern of the pseudonyms begins to match."""
    n = 1 << 20
    texts = [
        "x@" + "a." * (n // 2) + "a", "a." * (n // 2), "1 " * (n // 2), "1-" * (n // 2), "12345678901234567890" * (n // 20),
        "1." * (n // 2), "12/" * (n // 3), "+1 (319) " * (n // 9), "account " * (n // 8), "a@" * (n // 2),
    ]
    out = pseudonyms.pseudonymise(table(spark, list(enumerate(texts))).select("doc_id", "text"), "k").collect()
    by = {r["doc_id"]: r["text"] for r in out}
    assert len(by) == len(texts) and len(by[0]) < 100 and by[1] == texts[1]


def test_slices_are_bounded_by_bytes():
    texts = ["x" * (zlib.crc32(b"%d" % i) % 900) for i in range(500)] + ["y" * 5000, None, "", "z" * 100]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(small(iter([batch, batch.slice(0, 0)]), most=2000))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 2000 for p in parts)


def test_long_templates_are_found_whole(spark):
    long = " ".join(f"term{i}" for i in range(300))
    short = "released under the mit license"
    filler = [f"f{i}" for i in range(500)]
    texts = []
    for at in range(0, 500, 37):
        texts.append(" ".join(filler[:at]) + " " + long + " " + " ".join(filler[at:]))
    texts += [" ".join(filler), long.replace("term7 ", "other "), " ".join(f"term{i}" for i in range(200)), short]
    out = license_scan.scan(table(spark, list(enumerate(texts))), (("long", long), ("short", short))).orderBy("doc_id").collect()
    got = [{b["label"] for b in r["blocks"]} for r in out]
    assert got == [{"long"}] * 14 + [set(), {"long"}, set(), {"short"}]


def test_phrases_of_a_very_long_text():
    words = [b"cc", b"by"] * 200_000
    start = time.time()
    found = license_scan.find_phrases(words, [(b" cc by ", "cc-by"), (b" by cc ", "x")])
    assert time.time() - start < 20  # seconds; counting from the start for each hit takes minutes
    assert found[:2] == [("cc-by", 0), ("cc-by", 2)] and found[-1] == ("x", 399_997)


def test_cosine_of_very_large_and_very_small_vectors(spark):
    draw = np.random.default_rng(3)
    plain = draw.normal(size=(40, 64))
    scale = np.array([1e200, 1e-200, 1.0, 1e-310, 1e300])[np.arange(40) % 5]
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(plain, scale, strict=True))]
    found = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") < 40, k=39).collect()
    unit = plain / np.linalg.norm(plain, axis=1, keepdims=True)
    assert len(found) == 40 * 39
    for r in found:
        # Below 1e-308 components themselves have few digits.
        near = 1e-12 if r["query_id"] % 5 != 3 and r["vec_id"] % 5 != 3 else 1e-4
        assert abs(r["score"] - unit[r["query_id"]] @ unit[r["vec_id"]]) < near
