"""Merkle manifest against a plain tree in Python."""
import hashlib
import random
import zlib

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, \
block string, grp string, idx string, salt string, `a.b` string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    out = []
    for value in (row[0], row[3], row[2], row[4],
                  "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[1])
                  if lower and row[1] is not None else row[1]):
        out.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return h(*out)


def levels(nodes):
    """All levels of a tree, lowest first."""
    found = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        found.append(nodes)
    return found


def siblings(tree, at):
    """(left, right) of the node ``at`` of each level below the top."""
    steps = []
    for nodes in tree[:-1]:
        lo = at // 8 * 8
        steps.append(("".join(nodes[lo:at]), "".join(nodes[at + 1:lo + 8])))
        at //= 8
    return steps


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for k, row in enumerate(groups[g]):
            steps = siblings(trees[g], k) + siblings(top, at)
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf(row, lower=bad)
            for left, right in steps:
                node = h(left, node, right)
            out.append((row[0], leaf(row), trees[g][-1][0], top[-1][0],
                        h(*[a + b for a, b in steps]), node, node == top[-1][0]))
    return out


def run(spark, rows):
    from tunesmith.llm.merkle import manifest
    docs = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA).repartition(3)
    got = manifest(docs, tamper=F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    return [tuple(r) for r in got.collect()]


def same(a, b):
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    return sorted(a, key=key) == sorted(b, key=key)


def test_trees_of_all_shapes(spark):
    rng = random.Random(3)
    sizes = {"en": 1300, "de": 512, "fr": 513, None: 65, "": 8, "it": 9, "pt": 1, "Zz": 64, "日本": 2, "é": 577}
    rows, at = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Lower", "UPPER Ä", "plain", "x" * 5000])
            rows.append((at, text, lang, rng.choice([None, "web"]), rng.choice([None, at, -3])))
            at += 1
    rng.shuffle(rows)
    out = run(spark, rows)
    assert same(out, expected(rows))
    assert {r[6] for r in out} == {True, False}


def test_more_groups_than_one_block(spark):
    rows = [(i, "T", f"l{i}", None, 1) for i in range(530)]
    assert same(run(spark, rows), expected(rows))


def test_single_and_repeated_rows(spark, docs, rows):
    assert same(run(spark, [(3, "ABC", "en", "s", 3)]), expected([(3, "ABC", "en", "s", 3)]))
    same_rows = [(7, "Same", "en", "s", 4)] * 700 + [(None, "Same", "en", "s", 4)] * 20 + [
        (7, "Other", "en", "s", 5)]
    assert same(run(spark, same_rows), expected(same_rows))
    from tunesmith.llm.merkle import manifest
    plain = [(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows]
    got = [tuple(r) for r in manifest(docs).collect()]
    assert same([r[:5] for r in got], [r[:5] for r in expected(plain)])
    assert all(r[6] for r in got)


def test_empty(empty):
    from tunesmith.llm.merkle import manifest
    assert manifest(empty).count() == 0
