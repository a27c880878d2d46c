"""The prefix trie against brute force."""

import collections
import hashlib
import random
import zlib

import pytest

from roadloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, n int, conv string, depth int"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v)] for c, v in turns.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c / 5) * 5
        seqs[c] = tuple(own.get(c - base, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ended = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def _rows():
    chance = random.Random(8)
    rows = [(None, 1, "user", "lost"), (3, None, None, None), (3, None, "user", "ü"), (3, 1, "user", "x"), (3, 1, "user", "x"), (-7, 0, "a", "b"), (-5, 2, "a", "c"), (-5, 1, "a", "b")]
    for c in range(10, 60):
        for t in range(chance.randrange(1, 12)):
            rows.append((c, t, chance.choice(["user", "bot", None]), chance.choice(["hi", "", None, "long " * 30])))
    long = [("user", f"turn {k}") for k in range(60)]
    for c in (101, 102, 107, 108, 113):  # deep sequences that several share, some to their end
        rows += [(c, t, r, x) for t, (r, x) in enumerate(long[: 60 - c % 4])] + ([(c, 99, "user", "apart")] if c == 113 else [])
    for c in range(200, 260):  # one hot conversation
        rows += [(c, t, "user", f"same {t}") for t in range(10)]
    return rows + [(261, 0, "us", "er1"), (262, 0, "u", "ser1"), (9, 5, "only", "one")]


@pytest.mark.parametrize("part_rows", [prefix_trie.PART_ROWS, 4])
def test_trie_equals_brute_force(spark, part_rows):
    rows = _rows()
    table = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(5)
    got = prefix_trie.prefix_trie(table, part_rows)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")], [(4, 1, "a", "b")], [(0, 0, "a", "b"), (5, 0, "a", "b")], [(7, None, None, None)]])
def test_small_tables(spark, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute(rows) if any(r[0] is not None for r in rows) else []
    assert sorted((tuple(r) for r in prefix_trie.prefix_trie(table).collect()), key=str) == want
