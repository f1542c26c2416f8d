"""SentencePiece encoding, turn repair and the manifest against plain versions."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tillbook.llm import manifest, piece_encoding, registry, turn_repair

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(registry.PIECES)


def same(frame, want):
    got, want = Counter(tuple(r) for r in frame.collect()), Counter(want)
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


# --- SentencePiece ------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_marked_words_stand_alone(model, monkeypatch):
    monkeypatch.setattr(piece_encoding, "SLICE", 7)
    draw = random.Random(2)
    parts = ["a", "b", " ", " ", "  ", "▁", "\n", "é", "𝒳", "the ", "\0", "　"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 30)))
        words = [w.encode() for some in piece_encoding.marked_words(text) for w in some]
        ids = [i for b in piece_encoding.segment(model, words) for i in struct.unpack(f"<{len(b) // 4}I", b)]
        assert ids == model.encode(text), text


def test_pieces_like_the_library(spark, model):
    more = [
        (None, None), (1, ""), (1, ""), (2, " "), (3, "  "), (4, "a  ▁ b "), (5, "word " * 300_000),
        (6, "x" * 200_000), (None, " lead\n\n nul\0 𝒳 é"), (900_007, "same"), (900_007, "same"),
    ]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    for clash in ("ids", "bucket", "block", "docs", "packed"):
        docs = docs.withColumn(clash, F.lit("clash"))

    def one(doc, text):
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        return doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()

    same(piece_encoding.digest(docs, PATH), [one(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert piece_encoding.digest(docs.limit(0), PATH).count() == 0
    bare = piece_encoding.encode(docs.filter("doc_id = 900007"), PATH, begin=False, end=False)
    assert [r["decoded"] for r in piece_encoding.decode(bare, PATH).collect()] == ["same", "same"]
    assert [r["ids"] for r in bare.collect()] == [model.encode("same")] * 2


def test_models_whose_words_do_not_stand_alone_are_refused(model):
    class Crossing:
        def __getattr__(self, name):
            return getattr(model, name)

        def id_to_piece(self, i):
            return "a▁b" if i == 300 else model.id_to_piece(i)

    piece_encoding.check_model(model)
    with pytest.raises(ValueError, match="cross"):
        piece_encoding.check_model(Crossing())


# --- turn repair ----------------------------------------------------------------


def plain(marks):
    """Least (cost, audit) by going through the rows once with all places of the pattern."""
    far = (10**9, "")

    def inserted(now):
        now = dict(now)
        for _ in range(3):
            for place, (cost, audit) in list(now.items()):
                to = turn_repair.LEADS[place]
                now[to] = min(now.get(to, far), (cost + 3, audit + "I"))
        return now

    now = {0: (0, "")}
    for mark in marks:
        following = {}

        def put(to, way, following=following):
            following[to] = min(following.get(to, far), way)

        for place, (cost, audit) in inserted(now).items():
            put(place, (cost + 4, audit + "D"))
            if not mark & turn_repair.BAD:
                cost += 3 if mark & turn_repair.CUT else 0
                letter = "sua?"[mark & 3]
                if (letter, place) in {("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)}:
                    put("sua".index(letter) + 1, (cost, audit + "K"))
                put(turn_repair.LEADS[place], (cost + 3, audit + "R"))
        now = following
    ends = inserted(now)
    return min(ends[place] for place in (0, 3) if place in ends)


def test_searches_find_the_least_audit():
    draw = random.Random(1)
    for _ in range(8000):
        n = draw.randint(0, draw.choice([3, 8, 14]))
        marks = bytes(draw.choice([0, 1, 2, 3, 1, 2]) + draw.choice([0, 0, 0, 4, 8]) for _ in range(n))
        assert turn_repair.cheapest(marks) == plain(marks), marks
    long = bytes(draw.choice([0, 1, 2, 3, 1, 2]) + draw.choice([0, 0, 0, 4, 8]) for _ in range(20_000))
    assert turn_repair.cheapest(long) == plain(long)


def repaired(rows):
    """The contract's columns of one conversation's rows after damage, in order."""
    seen, marks, out, place = set(), [], [], 0
    blank = duplicate = truncated = illegal = 0
    for i, (_, role, text) in enumerate(rows):
        mark = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
        trimmed = text.strip(" \t\n\x0b\f\r")
        if not trimmed:
            blank, mark = blank + 1, mark | 4
        elif (role, text) in seen:
            duplicate, mark = duplicate + 1, mark | 4
        elif trimmed[-1] not in ".!?":
            truncated, mark = truncated + 1, mark | 8
        seen.add((role, text))
        marks.append(mark)
        illegal += i > 0 and rows[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = plain(marks)
    left = iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)[1:]
        if letter == "D":
            continue
        if letter in "IR":
            role = "assistant" if place == 2 else "user"
        place = {"s": 1, "u": 2, "a": 3}[role[0]]
        out.append(f"{role}:{text}")
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, blank, duplicate, truncated, illegal, cost, audit, digest


def contract(table):
    by = defaultdict(list)
    for conv, turn, role, text in table:
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        rows = by[conv]
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    in_order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return [(conv, *repaired(sorted(rows, key=in_order))) for conv, rows in by.items()]


@pytest.fixture(scope="module")
def turns(spark):
    draw = random.Random(5)
    more = [
        (None, None, None, None), (None, None, "user", "x."), (None, 3, "tool", "x"), (7000, 1, "user", ""), (7000, 1, "user", ""),
        (7001, 5, "", "q!"), (7001, 5, "", "q!"), (7001, 9, "assistant", "\n. "), (7002, 1, "user", "long " * 200_000 + "."),
    ]
    more += [(7100 + i, 1, "user", "u.") for i in range(60)]
    more += [
        (
            8000 + i // 9,
            draw.choice([None, i, i, i, i + 5]),
            draw.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "User"]),
            draw.choice(["a.", "b", "c!", " ", None, "long one?", "z."]),
        )
        for i in range(4000)
    ]
    # One conversation holds a third of all rows.
    more += [(9000, i, draw.choice(["user", "assistant"]), draw.choice(["yes.", f"t{i}.", "no"])) for i in range(2000)]
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(more, "conv_id long, turn long, role string, text string"))
    for clash in ("gone", "kind", "position", "edit", "cost", "fault", "mark", "key"):
        rows = rows.withColumn(clash, F.lit("clash"))
    return rows


def test_turn_repair(turns):
    table = [tuple(r)[:4] for r in turns.collect()]
    same(turn_repair.digest(turns), contract(table))
    assert turn_repair.digest(turns.limit(0)).count() == 0


def test_repaired_turns_are_well_formed(turns):
    rows = turn_repair.repair(turns).filter("position > 0").orderBy("conv_id", "position").collect()
    roles = defaultdict(str)
    for r in rows:
        roles[r["conv_id"]] += r["role"][0]
        assert (r["turn"] is None and r["text"] == "") if r["edit"] == "I" else r["text"].strip()
    assert all(re.fullmatch("s?(ua)+", found) for found in roles.values())


# --- manifest -----------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The last node, and for each first node what stands beside it, level by level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, owners_above = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for j in range(len(run)):
                for i in owners[at + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(sha(*run))
            owners_above.append([i for some in owners[at : at + 16] for i in some])
        nodes, owners = above, owners_above
    return nodes[0], paths


def manifest_rows(rows):
    lower = str.maketrans(manifest.UPPER, manifest.LOWER)
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append((leaf(row), row))
    subroots, found = [], []
    for source in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        leaves = sorted(by[source], key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        subroot, paths = tree([n for n, _ in leaves])
        subroots.append(subroot)
        found.append((subroot, leaves, paths))
    if not found:
        return []
    root, over = tree(subroots)
    out = []
    for (subroot, leaves, paths), more in zip(found, over, strict=True):
        for (node, row), path in zip(leaves, paths, strict=True):
            path = path + more
            now = node
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                now = leaf((*row[:4], row[4].translate(lower)))
            for left, right in path:
                now = sha(left, now, right)
            out.append((row[0], node, subroot, root, sha(*(a + b for a, b in path)), now, now == root))
    return out


def manifest_docs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for clash in ("grp", "rank", "h", "kids", "path", "top", "leaf", "changed", "block"):
        docs = docs.withColumn(clash, F.lit("clash"))
    return docs


def test_manifest_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    same(manifest.digest(docs), manifest_rows([tuple(r) for r in docs.select(*manifest.LEAF_COLUMNS).collect()]))


def test_manifest_of_awkward_rows(spark):
    rows = [(i, f"s{min(3, i % 9)}" if i % 7 else None, "en", 5, f"T{i}") for i in range(14_000)]  # two tiers of blocks
    rows += [(i, f"of its own {i}", None, None, "é" * i) for i in range(300)]
    rows += [(None, None, None, None, None)] * 20 + [(5, "zz", None, None, "A")] * 3 + [(7, "", None, None, ""), (8, "long", "x", 1, "Ab" * 1_000_000)]
    same(manifest.digest(manifest_docs(spark, rows)), manifest_rows(rows))


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 256, 257, 4096, 4097])
def test_manifest_of_one_source(spark, n):
    rows = [(i, "s", "en", 1, "T") for i in range(n)]
    same(manifest.digest(manifest_docs(spark, rows)), manifest_rows(rows))
