"""Prefix trie against a plain dictionary of prefixes."""
import hashlib
import random
import zlib

import pytest

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, a string, depth string, `p.q` string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    total = {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves = saved = 0
        for child in children.get(p, []):
            leaves += total[child][0]
            saved += total[child][1]
        saved += (len(nodes[p]) - 1) * len(p[-1][1]) if p else 0
        total[p] = (leaves or 1, saved)
    out = []
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if whole[c] == p)))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members),
                    len(children.get(p, [])), *total[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    from tunesmith.llm.trie import prefix_trie
    table = spark.createDataFrame([(*r, *["x"] * 4) for r in rows], SCHEMA).repartition(3)
    out = prefix_trie(table, **options)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                           "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def some(rng):
    rows = []
    for c in rng.sample(range(1200), 260):
        n = rng.choice([1, 1, 2, 3, 4, 6, 9, 12])
        for t in range(n):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t > 2 else "user",
                         rng.choice(["a", "bb", "Ünï", ""])))
    rows += [(c, t, "user", "common") for c in range(2000, 2060) for t in range(4)]      # copies
    rows += [(3000 + i, t, "system", f"s{t}") for i in range(30) for t in range(i % 9)]   # a chain
    rows += [(77, None, None, None), (77, 5, "user", None), (77, 5, "user", None), (77, 5, None, "x"),
             (None, 1, "user", "lost"), (5001, 0, "user", "y" * 4000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [512, 3])
def test_against_brute_force(spark, width):
    rows = some(random.Random(4))
    assert run(spark, rows, width=width) == brute(rows)


def test_long_conversation_in_pieces(spark, monkeypatch):
    from tunesmith.llm import trie
    monkeypatch.setattr(trie, "PIECE", 7)
    monkeypatch.setattr(trie, "ENDS", 2)
    rows = [(9000 + k, t, "user", f"t{t}" if t < 40 + 5 * k else f"{k}") for k in range(3) for t in range(61)]
    rows += [(100 * k, t, "u", "v") for k in range(40) for t in range(7)]
    assert run(spark, rows, width=2) == brute(rows)


def test_small(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "a", "b")]) == []
    for rows in ([(5, 0, "user", "hi")], [(c, 0, "user", "hi") for c in range(12)]):
        assert run(spark, rows) == brute(rows)
