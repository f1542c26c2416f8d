"""Places where an operator once did less than its whole job."""

import random
import zlib

import numpy as np
import pyarrow as pa

from tillbook.llm import lm_score, nearest, pseudonyms, quality_rules
from tillbook.llm import mixing_model as model


def some_texts(n, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    return [" ".join(rng.choices(words, k=200)).encode() + b"\n" for _ in range(n)]


def test_lm_slots_grow_with_the_corpus():
    bits = [model.slot_bits(n) for n in (1 << 20, 8 << 20, 1 << 30, 30 << 30, 1 << 45)]
    assert bits == sorted(set(bits))
    texts = some_texts(60)
    codes = model.Codes(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256))
    sized = model.slot_bits(sum(map(len, texts)))
    alone = [len(s) for s, _, _ in model.distinct(texts, [True] * 60, codes, 60)]
    kept = [len(s) for s, _, _ in model.distinct(texts, [True] * 60, codes, sized)]
    # Few contexts share a slot.
    assert all(a >= b > 0.9 * a for a, b in zip(alone, kept, strict=True))


def test_lm_blocks_get_the_counts_of_all():
    texts = some_texts(40)
    trains = [i % 7 != 2 for i in range(40)]
    codes, bits = model.Codes(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256)), 24
    whole = [{s: (z, o) for s, z, o in zip(*(x.tolist() for x in t), strict=True)} for t in model.distinct(texts, trains, codes, bits)]
    blocks = [list(model.distinct(texts[a : a + 20], trains[a : a + 20], codes, bits)) for a in (0, 20)]
    for k, want in enumerate(whole):
        columns = {"block": [0, 1], "context": [k, k], "bucket": [0, 0], "slots": [lm_score._pack_slots(b[k][0]) for b in blocks]}
        columns |= {n: [lm_score._pack_numbers(b[k][i]) for b in blocks] for i, n in ((1, "zeros"), (2, "ones"))}
        for r in lm_score._sum_slots(pa.table(columns)).to_pylist():
            got = zip(*(x.tolist() for x in (lm_score._unpack_slots(r["slots"]), *(lm_score._unpack_numbers(r[n]) for n in ("zeros", "ones")))), strict=True)
            assert all(want[s] == (z, o) for s, z, o in got)
    # A held-out text alone asks for slots and counts nothing there.
    assert not sum(z.sum() + o.sum() for _, z, o in model.distinct(texts[2:3], [False], codes, bits))


def fitted(spark, texts, files):
    """The number of bits in the fit, and whether each text's own counts are left out."""
    rows = [(i, t.decode()) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(files)
    seen = []
    real = lm_score._fit

    def spy(met):
        seen.extend(met.select("cells", "cell_counts").collect())
        return real(met)

    lm_score._fit = spy
    try:
        scores = lm_score.score(frame).collect()
    finally:
        lm_score._fit = real
    cells = [(v, n) for r in seen for v, n in zip(lm_score._unpack_slots(r["cells"]).tolist(), lm_score._unpack_numbers(r["cell_counts"]).tolist(), strict=True)]
    return cells, scores


def test_lm_weights_rest_on_all_training_texts(spark):
    texts = [b" ".join(some_texts(3, i)).replace(b"\n", b"") for i in range(30)]
    texts[3] = b" ".join(some_texts(20, 99)).replace(b"\n", b"")  # above the 20,000 characters of old
    assert len(texts[3]) > 20_000
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    assert texts[3] in train
    normal = [model.normal(t) for t in train]
    codes = model.Codes(np.bincount(np.frombuffer(b"".join(normal), np.uint8), minlength=256))
    bits = sum(int(codes.length[np.frombuffer(t, np.uint8)].sum()) for t in normal)
    for files in (1, 5):
        cells, scores = fitted(spark, texts, files)
        assert sum(n for _, n in cells) == bits and len(scores) == 30


def test_lm_own_counts_are_left_out():
    texts = some_texts(6)
    codes, bits = model.Codes(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256)), 24
    asked = list(model.distinct(texts, [True] * 6, codes, bits))
    judge = model.Mixer([model.Slots(s, bits) for s, _, _ in asked], [], codes, bits, model.EVEN)
    odds, gate, bit, doc, _ = judge.inputs(texts, [(z, o) for _, z, o in asked])
    for i in range(6):
        others = list(model.distinct(texts, [j != i for j in range(6)], codes, bits))
        plain = model.Mixer(judge.slots, [model.odds_of(z, o) for _, z, o in others], codes, bits, model.EVEN)
        x, g, b, *_ = plain.inputs([texts[i]])
        assert np.array_equal(odds[:, doc == i], x) and np.array_equal(gate[doc == i], g) and np.array_equal(bit[doc == i], b)


def test_quality_judges_small_and_unnamed_languages(spark):
    rng = random.Random(3)

    def prose(lang, n):
        words = [f"{lang}{i}" for i in range(40)]
        return [" ".join(rng.choices(words, k=160)) + "." for _ in range(n)]

    # 'aa' fills the table; 'bb' has five documents, far below 20,000 words.
    rows = [(t, "aa") for t in prose("aa", 400)] + [(t, "bb") for t in prose("bb", 5)] + [(t, None) for t in prose("bb", 3)]
    junk = " ".join(f"#{rng.random()}" for _ in range(90))
    rows += [(junk, None), (junk, "aa")]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    kept = {r[0] for r in quality_rules.rate(docs).filter("kept").select("doc_id").collect()}
    assert kept == set(range(408))
    out = quality_rules.kept_documents(docs)
    assert out.columns == docs.columns and {r[0] for r in out.select("doc_id").collect()} == kept
    # Languages past the 256th have a reference too.
    many = spark.createDataFrame([(i, t, f"l{i}") for i in range(300) for t in prose(f"l{i}", 1)], "doc_id long, text string, lang string")
    assert quality_rules.rate(many).filter("kept AND words_distance = 0").count() == 300


def test_cards_are_told_by_their_check_digit(spark):
    card, other = "4539148803436467", "4845168114407329"
    clean = ["10 20 30 40 50 60 70", "2019 2020 2021 2022", "at 1700000000000 ms", "9807915762804490", "12345678901234567890123", "\ue000 x"]
    texts = [card, other, f"{card} 123", f"{card} 12/27", f"2019 {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}", f"{card} {other}", f"{card} 31/12/1999", "31/12/1999"]
    texts += [f"{card} 319-555-5132", "319-555-5132", "account no: 9807915762804490", f"\ue000 {card}", f"mail {card}@x.com"]
    frame = spark.createDataFrame(list(enumerate([*clean, *texts])), "doc_id long, text string")
    new = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(frame, "k", count_as="n").collect()}
    for i, text in enumerate(clean):
        assert new[i] == text
    got = dict(zip(texts, [new[i + len(clean)] for i in range(len(texts))], strict=True))
    a, b, day, phone = got[card], got[other], got["31/12/1999"], got["319-555-5132"]
    assert len({a, card, b, other}) == 4 and day != "31/12/1999" and phone != "319-555-5132"
    assert got[texts[2]] == f"{a} 123" and got[texts[3]] == f"{a} 12/27"
    assert got[texts[4]] == f"2019 {a[:4]} {a[4:8]} {a[8:12]} {a[12:]}"
    assert got[texts[5]] == f"{a} {b}" and got[texts[6]] == f"{a} {day}" and got[texts[8]] == f"{a} {phone}"
    named = got["account no: 9807915762804490"]
    assert named.startswith("account no: ") and "9807915762804490" not in named
    assert got[texts[11]] == f"\ue000 {a}" and card not in got[texts[12]] and "x.com" not in got[texts[12]]


def test_every_query_finds_k(spark):
    def found(vectors, ids):
        frame = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>")
        return nearest.search(frame, nearest.F.col("vec_id") < 10).collect()

    rng = np.random.default_rng(1)
    # Few candidates: all of them, in the right order.
    few = rng.normal(size=(6, 32))
    unit = few / np.linalg.norm(few, axis=1, keepdims=True)
    rows = found(few, range(6))
    for q in range(6):
        want = [i for i in np.argsort(-(unit @ unit[q]), kind="stable").tolist() if i != q]
        assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] == want
    # One vector opposite to all others, and an id that is repeated.
    group = rng.normal(size=32) * 10 + rng.normal(size=(301, 32))
    group[0] = -group[1:].mean(axis=0)
    rows = found(np.concatenate((group, np.repeat(group[20:21], 9, 0))), [0, *range(20, 320), *[39] * 9])
    assert sorted(r["rank"] for r in rows if r["query_id"] == 0) == [1, 2, 3, 4, 5]


def test_parts_and_blocks_meet_where_they_are_stored(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(900, 16))
    vectors[500:520] = vectors[7]
    ids = [*range(880), *[3] * 20]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>").repartition(5)
    is_query = nearest.F.col("vec_id") % 3 == 0
    want = sorted(map(tuple, nearest.search(frame, is_query).collect()))
    plans, write = [], nearest.write_scratch

    def written(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **kwargs)

    monkeypatch.setattr(nearest, "write_scratch", written)
    monkeypatch.setattr(nearest, "PART_ROWS", 32)
    assert sorted(map(tuple, nearest.search(frame, is_query).collect())) == want
    # Blocks of queries are not copied to each part, nor are parts shuffled.
    assert not any("Generate" in p or "SortMergeJoin" in p for p in plans) and any("CartesianProduct" in p for p in plans)


def test_nearest_compares_all_that_is_reached(monkeypatch):
    monkeypatch.setattr(nearest, "TILE", (16, 80))
    monkeypatch.setattr(nearest, "PAIR_BYTES", 16 * 8 * 50)
    rng = np.random.default_rng(6)
    raw = rng.normal(size=(700, 8)).astype(np.float32)
    raw[300:340], raw[600:640] = raw[5], raw[60:100] * np.float32(8)
    ids = rng.permutation(np.concatenate((np.arange(650), np.arange(50))))
    codes = nearest.codes_of(nearest._scaled(raw), nearest.learn_rotation(nearest._scaled(raw)))
    of = lambda rows: nearest.Packed(ids[rows], codes[rows], raw[rows])
    block = of(np.arange(0, 700, 9))
    for radius, limit in ((1, 12), (6, 36), (6, 64), (None, 64)):
        best = nearest.Best(len(block.ids), 5)
        for start in range(0, 700, 210):
            nearest.compare(block, of(np.arange(start, min(700, start + 210))), best, radius, limit)
        for at in range(len(block.ids)):
            scores: dict = {}
            for row, v in enumerate(raw.astype(float)):
                apart = int(codes[row] ^ block.codes[at])
                near = radius is None or min((apart >> 16 * i & 65535).bit_count() for i in range(4)) <= radius
                if near and apart.bit_count() <= limit and ids[row] != block.ids[at]:
                    cosine = v @ block.vectors[at] / np.linalg.norm(v) / block.norms[at]
                    scores[int(ids[row])] = max(scores.get(int(ids[row]), -9), round(float(cosine), 12))
            told = sorted(((-s, i) for i, s in scores.items()))[:5]
            got = [(-round(float(s), 12), int(i)) for i, s in zip(best.ids[at], best.scores[at], strict=True) if s > -np.inf]
            assert got == told


def test_nearest_samples_the_least_hashes(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SAMPLE", 100)
    for ids in (range(5000), [1] * 3000 + [2], range(40)):
        vectors = spark.createDataFrame([(i, [float(at)]) for at, i in enumerate(ids)], "vec_id long, embedding array<double>").repartition(4)
        least = vectors.select(nearest.F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(100).collect()
        got = [ids[int(v[0])] for v in nearest._sample(vectors, len(ids)).column("embedding").to_pylist()]
        assert got == [r["vec_id"] for r in least]


def test_lm_numbers_take_the_bytes_they_need():
    rng = np.random.default_rng(3)
    for numbers in ([], [0], [255], [256, 0], [1 << 16], [(1 << 62) + 1, 7], rng.integers(0, 1 << 40, 5000)):
        numbers = np.array(numbers, np.int64)
        assert lm_score._unpack_numbers(lm_score._pack_numbers(numbers)).tolist() == numbers.tolist()
        ordered = np.sort(numbers)
        assert lm_score._unpack_slots(lm_score._pack_slots(ordered)).tolist() == ordered.tolist()
    # Where slots begin does not widen the steps between them.
    steps = np.cumsum(rng.integers(1, 200, 5000))
    assert len(lm_score._pack_slots(steps + (1 << 40))) == len(lm_score._pack_slots(steps))


def test_lm_sorts_numbers_of_any_size():
    rng = np.random.default_rng(4)
    for most in (5, 1 << 40, (1 << 63) - 1):  # the last does not fit one word with its place
        numbers = rng.integers(0, most, 3000)
        ordered, order = model._ordered(numbers)
        assert ordered.tolist() == sorted(numbers.tolist())
        assert numbers[order].tolist() == ordered.tolist() and sorted(order.tolist()) == list(range(3000))
    runs = [np.unique(rng.integers(0, 50, 30)) for _ in range(4)]
    counts = rng.integers(0, 9, sum(map(len, runs)))
    joined = np.concatenate(runs)
    assert next(model.sums_of_equal(joined, [counts])).tolist() == [int(counts[joined == x].sum()) for x in joined]
