"""Each operator against brute force: real documents plus rows made to be awkward."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tillbook.llm import (
    byte_bpe,
    license_scan,
    lm_score,
    near_dup,
    nearest,
    pseudonyms,
    quality_rules,
    registry,
    repeats,
    secret_scan,
    source_mix,
)
from tillbook.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"p{i}" for i in range(90))
AWKWARD = [
    (None, None, None, None),
    (None, PASSAGE + " x", "en", "src0"),
    (900_001, "", "en", None),
    (900_002, " \n\t ", None, "zz"),
    (900_003, PASSAGE, "en", "src0"),
    (900_003, PASSAGE, "en", "src0"),
    (900_004, PASSAGE + " one more", "xx", "src1"),
    (900_005, "é𝒳 token: secret=abcdefgh secret=token : abcdefgh API_KEY='abc-123def'" + " deadbeef" * 3 + "f" * 30, "en", "src1"),
    (900_006, "token=aaaaaa " * 300 + "AKIA" + "Z9" * 8, "en", "src1"),
    (900_007, "The MIT-License é\n Mit license cc by cc by cc by", "en", "src2"),
    (900_008, "q" * 1500 + " " + "\0" * 450, "en", "src2"),
    (900_009, "word " * 9000, "en", "src3"),
    (900_010, "b" * 199, "en", "src3"),
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source")
    more = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string")
    both = real.unionByName(more).withColumn("n_chars", F.length("text").cast("bigint"))
    # Names that operators use inside must not clash.
    for name in ("node", "block", "kinds", "held", "skey", "piece", "anchor"):
        both = both.withColumn(name, F.lit("clash"))
    return both.cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"] or "", r["lang"], r["source"]) for r in docs.collect()]


def same(frame, want):
    got = Counter(tuple(r) for r in frame.collect())
    want = Counter(want)
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    for op in (repeats, secret_scan, source_mix, license_scan, lm_score, near_dup):
        assert op.digest(none).count() == 0
    assert quality_rules.rate(none).count() == 0 and pseudonyms.pseudonymise(none, "k").count() == 0
    path = public_tokenizers.path(registry.RANKS)
    assert byte_bpe.digest(none, path, public_tokenizers.PATTERN).count() == 0
    assert nearest.digest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_nearest_recall_and_exact_scores(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    bad = [(None, [1.0] * 64), (800_000, None), (800_050, [0.0] * 64), (800_100, [float("nan")] * 64), (800_150, [1.0]), (800_151, [None] * 64)]
    copies = table.filter("vec_id = 0").select((F.col("vec_id") + 800_001).alias("vec_id"), "embedding")
    both = table.select("vec_id", "embedding").unionByName(copies).unionByName(spark.createDataFrame(bad, "vec_id long, embedding array<float>"))
    good = [(r[0], np.array(r[1], float)) for r in both.collect() if r[0] is not None and r[1] and len(r[1]) == 64 and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    ids = np.array([i for i, _ in good])
    unit = np.stack([v / np.linalg.norm(v) for _, v in good])
    found = defaultdict(list)
    for r in nearest.digest(both).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(found) == {i for i in ids if i % 50 == 0}
    hits = 0
    for q, got in found.items():
        score = unit @ unit[list(ids).index(q)]
        score[ids == q] = -9
        least = np.sort(score)[-5]
        known = dict(zip(ids.tolist(), score.tolist(), strict=True))
        assert all(abs(known[i] - s) < 1e-12 for i, s in got) and got == sorted(got, key=lambda x: (-x[1], x[0]))
        hits += sum(s >= least - 1e-12 for _, s in got)
    assert hits / (5 * len(found)) >= 0.9


def test_repeats(docs, rows):
    texts = [t.encode() for _, t, _, _ in rows]
    times = Counter(b[p : p + 200] for b in texts for p in range(len(b) - 199))
    want = []
    for (doc, *_), b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if times[b[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        want.append((doc, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    same(repeats.digest(docs), want)


def test_repeats_at_every_edge(spark):
    """Passages of 150 to 260 bytes, cut anywhere, with their own surroundings."""
    rnd = random.Random(3)
    passage = "".join(rnd.choice("abc dé") for _ in range(600))
    line = "".join(rnd.choice("xyz w") for _ in range(170))
    pick = lambda chars, n: "".join(rnd.choice(chars) for _ in range(rnd.randrange(n)))
    texts = []
    for _ in range(200):
        a = rnd.randrange(400)
        texts.append(pick("mnop ", 150) + passage[a : a + rnd.randrange(150, 260)] + pick("rstu ", 90) + line + pick("ghij ", 60))
    made = [(i, t, None, None) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    test_repeats(frame, made)


def test_two_stage_sorting():
    rnd = random.Random(5)
    regions = [bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 40))) for _ in range(50)] + [b"aaaa" * 20] * 3
    sizes = np.array([len(r) for r in regions])
    text = np.frombuffer(b"".join(r + b"\0" for r in regions), np.uint8).astype(np.uint16) + np.uint16(1)
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 0
    end_of = np.repeat(ends, sizes + 1)
    order = repeats.suffix_array(text, end_of, repeats.first_words(text, end_of))
    got = [tuple(text[i : end_of[i]]) for i in order]
    assert sorted(order.tolist()) == [i for i in range(len(text)) if text[i]] and got == sorted(got)


def test_anchors_and_hashes_are_found_piece_by_piece(monkeypatch):
    """The same anchors, hashes and repeats whatever the piece, and no piece as long as the block."""
    draw = random.Random(9)
    base = [bytes(draw.randrange(256) for _ in range(900)), b"ab" * 400, b"x" * 700]
    texts = [b"", b"short", *base, base[0][100:600], *(bytes(draw.choice(b"ab ") for _ in range(n)) for n in (199, 200, 201, 350, 1500)), base[1][:300]]
    regions = [t[i : i + 230] for t in texts for i in range(0, len(t) - 199, 97) if len(t) >= 200]
    places, low = np.arange(len(regions)) * 1000, np.zeros(len(regions), np.int64)
    high = np.array([len(r) - 200 for r in regions])
    seen, hashes = [], repeats.window_hashes
    monkeypatch.setattr(repeats, "window_hashes", lambda t: seen.append(len(t)) or hashes(t))
    found = []
    for piece in (1 << 30, 64, 256):
        monkeypatch.setattr(repeats, "PIECE", piece)
        seen.clear()
        anchors = repeats.Block(texts).anchors()
        assert max(seen) <= piece + repeats.SPREAD + repeats.LENGTH
        assert np.array_equal(repeats.Block(texts).anchors(contexts=False)[1], anchors[1])
        starts = repeats.repeated_starts(regions, places, low, high)
        found.append([x.tolist() for x in anchors] + [sorted(map(tuple, starts.tolist()))])
    assert found[0] == found[1] == found[2] and len(found[0][0]) > 50
    where = {}
    for i, r in enumerate(regions):
        for o in range(len(r) - 199):
            where.setdefault(r[o : o + 200], []).append((i, o))
    assert found[0][3] == sorted(p for at in where.values() if len(at) > 1 for p in at)


def test_secrets(docs, rows):
    def listed(spans):
        return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)

    want = []
    for doc, text, *_ in rows:
        spans = sorted(
            (m.start(), at, m.end(), rule.kind)
            for at, rule in enumerate(secret_scan.RULES)
            for m in re.finditer(rule.pattern, text)
            if len(m.group(rule.group)) >= rule.least
        )
        n = Counter(s[3] for s in spans)
        base = hashlib.sha256(listed(s for s in spans if s[1] < 3).encode()).hexdigest()
        want.append((doc, n["assign"], n["access"], n["hex"], base, listed(spans)))
    same(secret_scan.digest(docs), want)


def test_trigram_queries():
    query = lambda p: {tuple(sorted(a)) for a in secret_scan.trigram_query(p)}
    assert query("abcd") == {("abc", "bcd")}
    assert query("(abc|xyzw)[0-9]+") == {("abc",), ("xyz", "yzw")}
    assert query("ab?cde") == {("abc", "cde"), ("acd", "cde")}
    assert query("A[bB]c.*def") == {("abc", "def")}
    assert secret_scan.trigram_query("[0-9a-f]+") is None and secret_scan.trigram_query("(abc)*x") is None


def test_mix(docs, rows):
    size = Counter()
    for _, text, _, source in rows:
        size[source] += len(WORD.findall(text))
    order = sorted((s for s in size if s is not None), key=str.encode) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = {}
    while True:
        free = [s for s in order if s not in full]
        unit = (1.5 * sum(size.values()) - sum(full.values())) / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > 2 * size[s]]
        if not over:
            break
        full |= {s: 2.0 * size[s] for s in over}
    target = {s: full.get(s, unit * weight[s]) for s in order}
    got = source_mix.mix(docs)
    taken = Counter()
    for r in got.documents.collect():
        source = None if r["k"] == "\U0010ffff" else r["k"][1:]
        assert r["source_size"] == size[source] and math.isclose(r["target"], target[source], rel_tol=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    assert {s: round(t) for s, t in target.items()} == {s: taken[s] for s in order}
    again = Counter(tuple(r) for r in source_mix.digest(docs.repartition(5)).collect())
    assert again == Counter(tuple(r) for r in source_mix.digest(docs).collect())
    # Any long run of slots holds a source close to its share.
    segments = got.segments.groupBy("slot").agg(F.first("source").alias("s")).orderBy("slot").collect()
    half = Counter(r["s"] for r in segments[: len(segments) // 2])
    for s, n in Counter(r["s"] for r in segments).items():
        assert abs(half[s] - n / 2) <= 6


def test_licenses(docs, rows):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = license_scan.template_sets(license_scan.TEMPLATES)
    want = []
    for doc, text, *_ in rows:
        w = word.findall(text.translate(low))
        base = [(i, label) for p, label in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        found = {}
        for start in range(0, max(1, len(w) - 32), 32):
            block = {x.encode() for x in w[start : start + 64]}
            for label, words in sets.items():
                share = len(words & block) / len(words)
                if share >= 0.85 - 1e-12:
                    found[label] = max(share, found.get(label, 0))
        mine = {x for _, x in base}
        first, last = (min(base)[0], max(base)[0]) if base else (None, None)
        score = 1.0 if base else max(found.values(), default=0.0)
        want.append((doc, len(w), len(base), first, last, ",".join(sorted(mine)), ",".join(sorted(mine | set(found))), score))
    same(license_scan.digest(docs), want)


def test_bpe(spark, docs, rows):
    path = public_tokenizers.path(registry.RANKS)
    whole = tiktoken.Encoding("w", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    rnd = random.Random(1)
    pool = [chr(c) for c in (*range(0x500), 0x1680, 0x2028, 0x3000, 0x200B, 0x1F600, 0x4E2D, 0x660)] + [" ", "\n", "'s"] * 60
    more = [(i, "".join(rnd.choice(pool) for _ in range(200))) for i in range(300)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    want = []
    for doc, text in [r[:2] for r in rows] + more:
        ids = whole.encode_ordinary(text)
        want.append((doc, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    same(byte_bpe.digest(both, path, public_tokenizers.PATTERN), want)
    decoded = byte_bpe.decode(byte_bpe.encode(both, path, public_tokenizers.PATTERN), path)
    same(decoded.select("doc_id", F.col("decoded").cast("string")), [r[:2] for r in rows] + more)


def test_lm_base_and_model(docs, rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, [*t.encode().lower().split(), None]) for i, t, *_ in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = []
    for i, ws in tokens:
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        want.append((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6)))
    out = lm_score.digest(docs).cache()
    same(out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6)), want)
    # A probability, and on unseen documents far better than eight bits a byte.
    r = out.filter("held_out").agg(F.avg("bits_per_byte"), F.max("score")).first()
    assert r[0] < 3.2 and r[1] < 0


def test_pseudonyms_are_permutations(spark):
    y = spark.range(0, 189 * 773).select(pseudonyms.permute(F.col("id"), F.lit(189), F.lit(773), F.lit("d"), "k").alias("y"))
    assert tuple(y.agg(F.count_distinct("y"), F.min("y"), F.max("y")).first()) == (189 * 773, 0, 189 * 773 - 1)
    d = spark.range(0, 1000).select(pseudonyms._digits(F.lpad(F.col("id").cast("string"), 3, "0"), "n", "k").alias("d"))
    assert d.distinct().count() == 1000


def plain_permute(x, a, b, tweak, key):
    left, right = divmod(x, b)
    for at in range(pseudonyms.ROUNDS):
        f = lambda v, at=at: int(hashlib.sha256(f"{key}|{tweak}|{at}|{v}".encode()).hexdigest()[:15], 16)
        left, right = (left, (right + f(left)) % b) if at % 2 else ((left + f(right)) % a, right)
    return left * b + right


def test_pseudonyms_in_text(spark):
    def luhn(s):
        d = [int(x) for x in s]
        return sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])

    card = "4539148803436467"
    text = f"card {card}, 4539 1488 0343 6467 tel +1 (319) 555-5132 ip 39.197.112.39 999.1.1.1 on 2020-02-29 2020-02-30 31/12/1999 ssn 078-05-1120 mail a.b@mail.example.com, {card}. key=be8a8e7152a5c568b612dc7f4042dd9566113270"
    made = [(1, text, "x"), (2, None, "y"), (3, "", "z"), (4, card, "x"), (4, card, "x")]
    out = pseudonyms.pseudonymise(spark.createDataFrame(made, "doc_id long, text string, found string"), "k", count_as="n").collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == 5 and by[2]["text"] is None and by[3]["text"] == "" and by[1]["n"] == 11
    new = by[1]["text"]
    for gone in (card, "1488", "555-5132", "39.197.112.39", "2020-02-29", "31/12/1999", "078-05-1120", "mail.example.com"):
        assert gone not in new
    for stays in ("999.1.1.1", "2020-02-30", "be8a8e7152a5c568b612dc7f4042dd9566113270", "tel +1 ("):
        assert stays in new
    other = by[4]["text"]
    assert new.count(other) == 2 and len(other) == 16 and luhn(card) % 10 == luhn(other) % 10 == 0
    head = f"{plain_permute(int(card[:15]), 10**8, 10**7, 'card15', 'k'):015d}"
    assert other[:15] == head
    address = plain_permute(((39 * 256 + 197) * 256 + 112) * 256 + 39, 65536, 65536, "ipv4", "k")
    assert ".".join(str(address >> s & 255) for s in (24, 16, 8, 0)) in new


def linked(rows, width, percent=80):
    """Component of each row by comparing all pairs that share a shingle."""
    sets = [near_dup.exact_shingles(t.encode(), width) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g]}:
            shared = len(s & sets[j])
            if 100 * shared >= percent * (len(s) + len(sets[j]) - shared) and find(i) != find(j):
                root[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sets, [least.get(find(i)) for i in range(len(rows))]


def test_near_dup(docs, rows):
    sets, least = linked(rows, 4)
    same(near_dup.digest(docs), [(d, len(s), c, d == c) for (d, *_), s, c in zip(rows, sets, least, strict=True)])


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7)]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in got} == {i: 0 for i in range(61)} | {100: 100, 150: 100, 200: 100}


def test_quality(docs, rows):
    want = []
    for doc, text, *_ in rows:
        w = WORD.findall(text)
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        again = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want.append((doc, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), failed))
    out = quality_rules.rate(docs).cache()
    same(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), want)
    assert out.filter("base_failed AND kept").count() == 0


def test_quality_tells_junk_from_good(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    r = quality_rules.rate(docs).filter("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {x["quality"]: x["kept"] for x in r}
    assert share[1] > 0.99 and share[0] < 0.2


def test_distance():
    assert quality_rules.js_distance(np.array([1.0, 0]), np.array([0, 3.0])) == 1.0
    assert quality_rules.js_distance(np.array([1.0, 2]), np.array([2.0, 4])) == 0.0


def test_pipeline_stage_by_stage(spark, docs):
    names = docs.columns
    docs = docs.drop("n_chars").withColumn("n_chars", F.length("text").cast("bigint")).select(names)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality rules"](spark, docs, SF_DIR)
    same(kept.select("doc_id"), [(r["doc_id"],) for r in quality_rules.rate(docs).filter("kept").collect()])
    kept = kept.cache()
    left = stages["near-duplicates"](spark, kept, SF_DIR).cache()
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    _, least = linked(rows, 5)
    same(left.select("doc_id"), {(d,) for (d, _), c in zip(rows, least, strict=True) if d == c})
    hidden = stages["personal data"](spark, left, SF_DIR).cache()
    assert hidden.columns == left.columns and hidden.count() == left.count() and hidden.filter("n_chars != length(text)").count() == 0
    mixed = stages["source mixing"](spark, hidden, SF_DIR).cache()
    assert mixed.columns == hidden.columns and 0 < mixed.count() and mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    final = stages["encoding"](spark, mixed, SF_DIR)
    digests = Counter(r[0] for r in mixed.select(F.sha2(F.col("text").cast("binary"), 256)).collect())
    assert digests == Counter(r["decoded_sha256"] for r in final.collect())


def test_registered(spark):
    names = registry.queries()
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert names["pipeline"](spark, SF_DIR).count() > 0
