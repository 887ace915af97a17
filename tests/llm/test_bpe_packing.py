import hashlib
import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from cohortry.llm.bpe import ByteBPE, encode_digests, encode_documents, leaves  # noqa: E402
from cohortry.llm.packing import cut_lengths, depths, pack, ranked, slot_counts, sweep  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", "'s", "'", " ", "  ", "\n", "!!", "12", "é", "ß", "漢字", "😀", "<|endoftext|>", "\x85", "\xa0", "x" * 30, "ing", "…", "\x1c", "²"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return ByteBPE(PATH)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_same_ids_as_the_library(library, bpe):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(bpe.encode(text)) == want
        assert bpe.decode(bpe.encode(text)) == library.decode(want, skip_special_tokens=False) == text
        if "<|" not in text:
            assert bpe.tree(text, leaf=rng.choice([3, 5, 8])) == want


@pytest.mark.parametrize("text", ["thhawhesan" * 2000, "漢字" * 3000, "!-'" * 3000, " " * 5000 + "x", "12" * 5000, "".join(random.Random(3).choice("abcdefghi") for _ in range(30000))])
def test_tree_concatenation_of_unsplit_text(library, bpe, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert bpe.tree(text, leaf=64) == want
    out = []
    for leaf, hard in leaves(text, 100):
        own = bpe.tree(leaf)
        out = bpe.join(out, own) if hard else out + own
    assert out == want


CASES = [(1, None, "x"), (2, "", "x"), (None, "two words", "x"), (3, "same", "x"), (3, "same", "x"), (4, "unsplit" * 900, "x"), (5, "<|endoftext|> a  b ", "x")]
SCHEMA = "doc_id long, text string, start string"


def test_digests_of_nulls_repeats_and_long_texts(spark, library):
    docs = spark.createDataFrame(CASES, SCHEMA)
    got = sorted((tuple(r) for r in encode_digests(docs, PATH, spread_chars=2000).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, len(e := library.encode(t or "", add_special_tokens=False).ids), sha(",".join(map(str, e))), sha(library.decode(e, skip_special_tokens=False))) for i, t, _ in CASES]
    assert got == sorted(want, key=str)
    assert encode_digests(docs.limit(0), PATH).count() == 0
    assert {r.decoded for r in encode_documents(docs, PATH).collect()} == {t or "" for _, t, _ in CASES}


def test_packing(spark, library):
    rng = random.Random(2)
    rows = CASES + [(i, "word " * rng.choice([1, 5, 5, 5, 40, 90, 130]), "x") for i in range(10, 200)]
    got = pack(spark.createDataFrame(rows, SCHEMA), PATH, capacity=64).collect()
    tokens = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t, _ in rows}
    by = {}
    for r in got:
        own = tokens[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32 and (r.length == 64 or r.piece == 0)
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in got) == sum(len(tokens[i]) for i, *_ in rows)
    assert pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def one_by_one(sizes, capacity):
    """Sequences that serial best fit by descending length takes."""
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= s), default=None)
        if fit is None:
            gaps.append(capacity - s)
        else:
            gaps[gaps.index(fit)] -= s
    return len(gaps)


def test_sequences_close_to_one_by_one(spark):
    rng = random.Random(3)
    rows = [(i, "word " * rng.choice([0, 1, 3, 7, 20, 45, 63, 90, 200]), "x") for i in range(400)]
    got = pack(spark.createDataFrame(rows, SCHEMA), PATH, capacity=64).collect()
    assert len({r.sequence_id for r in got}) <= 1.01 * one_by_one([r.length for r in got], 64) + 1


@pytest.mark.parametrize("part", [2_000, 3])
def test_sweep_equals_one_by_one(spark, monkeypatch, part):
    monkeypatch.setattr("cohortry.llm.packing.ROWS", part)
    rng = random.Random(4)
    for n_slots, n_docs in ((40, 40), (60, 20), (10, 50)):
        sizes, lengths = [rng.randint(1, 32) for _ in range(n_slots)], [rng.randint(1, 32) for _ in range(n_docs)]
        slots = spark.createDataFrame(list(enumerate(sizes)), "sequence_id long, size long")
        docs = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, size long")
        a, b = np.bincount(sizes, minlength=33), np.bincount(lengths, minlength=33)
        before, matched = depths(a, b)
        found = sweep(ranked(slots, a, "sequence_id"), ranked(docs, b, "doc_id").withColumn("nth", F.col("k")), a, before).collect()
        assert len({r.sequence_id for r in found}) == len({r.doc_id for r in found}) == len(found) == matched.sum()
        free, want = list(sizes), []
        for length in sorted(lengths, reverse=True):
            if (fit := min((s for s in free if s >= length), default=None)) is not None:
                free.remove(fit)
                want.append((length, fit))
        assert sorted((r.size, sizes[r.sequence_id]) for r in found) == sorted(want)


def test_slots_and_cuts():
    gaps = np.zeros(65, np.int64)
    gaps[[10, 20, 64]] = 1, 2, 3
    assert {i: int(n) for i, n in enumerate(slot_counts(gaps, 10, 16)) if n} == {16: 3 * 4, 20: 2}
    assert cut_lengths(64, 64) == [64] and cut_lengths(130, 64) == [2, 64, 64]


def test_many_equal_rows_are_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr("cohortry.llm.packing.ROWS", 20)
    rows = [(7, "same words here", "x")] * 900 + [(None, "same words here", "x")] * 60 + [(i, "word " * (i % 40), "x") for i in range(100)]
    got = pack(spark.createDataFrame(rows, SCHEMA).repartition(6), PATH, capacity=64).collect()
    assert len(got) == sum(1 for _ in rows) and sum(r.doc_id == 7 for r in got) == 901
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 64
    counts = np.zeros(65, np.int64)
    counts[5] = 960
    equal = spark.range(960).select(F.lit(5).cast("long").alias("size"), F.lit("same").alias("text"), F.col("id").alias("row"))
    assert sorted(r.k for r in ranked(equal, counts, "text", "row").collect()) == list(range(960))
    plan = ranked(equal, counts, "text", "row")._jdf.queryExecution().optimizedPlan().toString()
    assert "block" in plan
    salts = equal.groupBy(F.pmod(F.xxhash64("text", "row"), F.lit(48))).count().collect()
    assert len(salts) > 40 and max(r["count"] for r in salts) < 60
