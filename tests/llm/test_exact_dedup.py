"""The cuckoo filter, and the index of live digests against plain dictionaries."""

import hashlib
import random
from collections import defaultdict

import numpy as np

from cohortry.llm import exact_dedup
from cohortry.llm.exact_dedup import CuckooFilter, LiveIndex, Shard, filled


def random_keys(n, seed):
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64)


def test_filter_insertion_and_deletion():
    keys = random_keys(5000, 1)
    index = filled(keys)
    assert index.contains(keys).all()
    assert index.contains(random_keys(100_000, 2)).mean() < 0.001
    index.delete(keys[::2])
    assert index.contains(keys[1::2]).all()
    assert index.contains(keys[::2]).mean() < 0.01
    assert (CuckooFilter.of_bytes(index.to_bytes()).slots == index.slots).all()
    assert index.insert(keys[::2]) and index.contains(keys).all()
    index.delete(keys)
    assert not index.slots.any()


def test_filter_holds_equal_fingerprints():
    keys = np.full(8, 7, np.uint64) | (np.uint64(9) << np.uint64(48))
    index = CuckooFilter(64)
    assert index.insert(keys)  # two buckets of four slots
    assert not CuckooFilter(64).insert(np.r_[keys, keys[:1]])
    index.delete(keys[:7])
    assert index.contains(keys[:1]).all() and (index.slots != 0).sum() == 1


def test_overflow_resizes_from_stored_keys():
    shard = Shard([])
    rows = [{"digest": hashlib.sha256(str(i % 700).encode()).digest(), "n_bytes": 1, "keep_id": i, "keep_row": i, "n": 1} for i in range(1500)]
    before = shard.filter.buckets
    shard.add(rows[:900])
    shard.add(rows[900:])
    assert shard.filter.buckets > before and len(shard.contents) == 700
    assert {c[0]: (c[2], c[4]) for c in shard.contents} == {hashlib.sha256(str(k).encode()).digest(): (max(i for i in range(1500) if i % 700 == k), sum(i % 700 == k for i in range(1500))) for k in range(700)}
    assert shard.filter.contains(shard.keys()).all()


def test_hit_is_verified_against_contents():
    one, two = b"a" * 8 + b"same key" + b"b" * 16, b"c" * 8 + b"same key" + b"d" * 16
    row = lambda d, n, i: {"digest": d, "n_bytes": n, "keep_id": i, "keep_row": i, "n": 1}
    shard = Shard([])
    shard.add([row(one, 3, 1), row(two, 3, 2), row(one, 3, 4), row(two, 5, 9)])
    assert sorted((c[0], c[1], c[2], c[4]) for c in shard.contents) == sorted([(one, 3, 4, 2), (two, 3, 2, 1), (two, 5, 9, 1)])
    shard.settle([{"digest": two, "n_bytes": 3, "keep_id": None, "keep_row": None, "n": 0}])
    assert len(shard.contents) == 2 and len(shard.hits([row(two, 5, 0)])) == 1 and not Shard(shard.table(0).to_pylist()).hits([row(two, 3, 0)])


SCHEMA = "doc_id long, text string, row string, digest int, n long"


def brute(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        done = False
        for i in ids:
            kept = i == top and not done
            done |= kept
            out.append((i, top, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_duplicates_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD", 20)
    rng = random.Random(3)
    rows = [(i, f"text {rng.randrange(120)}", "x", 1, 2) for i in range(400)]
    rows += [(1000 + i, "the hot text", "x", 1, 2) for i in range(300)]
    rows += [(5000, None, "x", 1, 2), (5001, "", "x", 1, 2), (None, "", "x", 1, 2), (None, "alone", "x", 1, 2), (None, "two", "x", 1, 2), (None, "two", "x", 1, 2)]
    rows += [(6000, "tie", "x", 1, 2), (6000, "tie", "x", 1, 2), (6001, " tie", "x", 1, 2), (6002, "long " * 300_000, "x", 1, 2), (6003, "long " * 300_000, "x", 1, 2), (6004, "é\x00", "x", 1, 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, exact_dedup.exact_duplicates(df).collect()), key=str)
    assert got == brute(rows)
    kept = exact_dedup.first_rows(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == sorted(((i, t or "") for (i, t, *_) in {(i, hashlib.sha256((t or "").encode()).hexdigest()): (i, t) for i, t, *_ in rows}.values() if (i, hashlib.sha256((t or "").encode()).hexdigest()) in {(a, e) for a, _, _, k, e in got if k}), key=str)
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_live_index(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD", 25)
    rng, live, index, n = random.Random(7), [], LiveIndex(spark), 0
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")

    def check():
        groups = defaultdict(list)
        for i, t in live:
            groups[hashlib.sha256(t.encode()).digest()].append(i)
        assert {bytes(r.digest): (r.keep_id, r.n) for r in index.groups().collect()} == {d: (max(ids), len(ids)) for d, ids in groups.items()}
        probe = [(i, f"t{i}") for i in range(0, 200, 7)]
        want = {i: max((j for j, t in live if t == text), default=None) for i, text in probe}
        assert {r.doc_id: r.keep_id for r in index.lookup(frame(probe)).collect()} == want

    for size in (40, 90, 60):
        new = [(n + k, f"t{rng.randrange(150)}") for k in range(size)]
        n += size
        index.insert(frame(new))
        live += new
        check()
        gone = rng.sample(live, len(live) // 3)
        index.delete(frame([*gone, (10_000, "t1"), (gone[0][0], "never there")]))
        for x in gone:
            live.remove(x)
        check()
    assert index.bits > 1
    index.delete(frame(live))
    assert index.size() == 0 and index.lookup(frame([(1, "t1")])).first().keep_id is None
