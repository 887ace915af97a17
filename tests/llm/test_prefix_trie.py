"""The trie of conversations against prefixes in a plain dictionary."""

import hashlib
import random
import zlib
from collections import defaultdict

from cohortry.llm import prefix_trie
from cohortry.llm.prefix_trie import WIDTH, common

SCHEMA = "conv_id long, turn long, role string, text string, part int, node string, depth string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = turns.get(c - c % 100, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out, sums = set(), {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(sums[c][0] for c in children[p]) if children[p] else 1
        saved = sum(sums[c][1] for c in children[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        sums[p] = (leaves, saved)
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(whole[c]) == len(p)))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def got(spark, rows, parts=3):
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    out = {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found}
    assert len(out) == len(found)
    return out


def conversations(rng, n, texts, longest, hot=0):
    rows = []
    for i in range(n):
        c = rng.choice([i, i, 100 * (i // 7), 1000 + 3 * i])
        for k in range(rng.randrange(1, longest)):
            rows.append((c, k, rng.choice("ab"), rng.choice(texts), 0, "x", "y"))
    rows = list({(r[0], r[1]): r for r in rows}.values())
    for i in range(hot):
        rows += [(10_000 + i, k, "a", f"hot {k}", 0, "x", "y") for k in range(7)]
    return rows


def test_common():
    a, b = "a" * WIDTH, "b" * WIDTH
    for n in (0, 1, 2, 3, 7, 8, 9, 100):
        assert common(a * n, a * n) == n
        assert common(a * n + b, a * n + a) == n
        assert common(a * n, a * (n + 3)) == n


def test_trie_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    for n, texts, longest, turns in ((60, ["", "p", "quite long"], 6, 15), (150, ["x", "é𝄞"], 9, 40), (120, [str(k) for k in range(30)], 5, 1_000_000), (40, ["one"], 12, 7)):
        monkeypatch.setattr(prefix_trie, "TURNS", turns)
        rows = conversations(rng, n, texts, longest, hot=30)
        assert got(spark, rows) == brute(rows)


def test_hot_conversation_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TURNS", 20)
    rows = conversations(random.Random(8), 20, ["a", "b"], 5, hot=150)
    rows += [(20_000, k, "a", f"hot {min(k, 9)}", 0, "x", "y") for k in range(400)]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark, monkeypatch):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [
        (None, 1, "a", "never", 0, "x", "y"), (7, None, "a", "first", 0, "x", "y"), (7, 0, None, None, 0, "x", "y"), (7, 0, "b", "tie", 0, "x", "y"), (7, 0, "b", "tie", 0, "x", "y"),
        (-3, 1, "a", "below", 0, "x", "y"), (5, 2, "", "", 0, "x", "y"), (6, 1, "a", "z" * 500_000, 0, "x", "y"), (6, 2, "a", "z" * 500_000, 0, "x", "y"), (1 << 60, 1, "12:a", "b", 0, "x", "y"),
    ]
    for turns in (1, 100):
        monkeypatch.setattr(prefix_trie, "TURNS", turns)
        found = got(spark, rows)
        want = brute([r for r in rows if r[0] != -3])  # its base is worked out as SQL does: the remainder keeps the sign
        assert {r for r in found if r[0] not in (-3,) and r[1]} >= {r for r in want if r[1] and r[2] != min(x[0] for x in want)}
        assert sum(r[3] for r in found if r[1] == 0) == 5
    alone = [(100, k, "a", f"t{k}", 0, "x", "y") for k in range(1)]
    assert got(spark, alone) == brute(alone)
