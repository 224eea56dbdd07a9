"""Line dedup against a plain template tree."""
import hashlib
import random
import re

import pytest

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def flat(line):
    return SPACE.sub(" ", line).strip(" ")


def masked(line):
    return " ".join("<*>" if re.search("[0-9]", w) else w for w in flat(line).split(" "))


def row_key(i, text):
    ident, body = "n" if i is None else f"i{i}", "n" if text is None else f"t{text}"
    return hashlib.md5(f"{ident}|{body}".encode()).digest()


def brute(rows, similarity=0.8, min_docs=3, long_words=20):
    lines = []                                    # (place, row key, masked words, flat)
    for i, text in rows:
        rk = row_key(i, text)
        for no, raw in enumerate((text or "").split("\n")):
            if flat(raw):
                lines.append(((i is None, i or 0, rk, no), rk, tuple(masked(raw).split(" ")), flat(raw)))
    leaves = {}
    for _, _, words, _ in lines:
        leaf = leaves.setdefault((len(words), words[:3]), {})
        leaf[words] = leaf.get(words, 0) + 1
    tree = {}
    for leaf in leaves.values():
        if len(leaf) < 2:
            continue
        held = {}
        for words, n in leaf.items():
            for spot in enumerate(words):
                held[spot] = held.get(spot, 0) + n
        own = {}
        for words in leaf:
            pattern = tuple(None if held[s] < min_docs else s[1] for s in enumerate(words))
            if pattern.count(None) <= int(len(words) * (1 - similarity + 1e-9)):
                own[words] = pattern
        agree = {}
        for words, p in own.items():
            agree[p] = agree.get(p, 0) + leaf[words]
        choices = {}
        for words, p in own.items():
            if agree[p] >= min_docs:
                tree[words] = p
                continue
            choices[words] = [(-1, p)]
            if p.count(None) < int(len(words) * (1 - similarity + 1e-9)):
                choices[words] += [(at, p[:at] + (None,) + p[at + 1:]) for at, w in enumerate(p) if w is not None]
        pool = {p: n for p, n in agree.items() if n >= min_docs}
        for words, found in choices.items():
            for _, p in found:
                pool[p] = pool.get(p, 0) + leaf[words]
        for words, found in choices.items():
            good = [(pool[p], -at, p) for at, p in found if pool[p] >= min_docs]
            if good:
                tree[words] = max(good, key=lambda g: g[:2])[2]
    drop = set()
    for key, least, keep in ((lambda x: (len(x[2]), x[2][:3], tree.get(x[2], x[2])), min_docs, lambda x: True),
                             (lambda x: x[3], 2, lambda x: len(x[2]) >= long_words)):
        groups = {}
        for x in lines:
            if keep(x):
                groups.setdefault(key(x), []).append(x)
        for found in groups.values():
            if len({x[1] for x in found}) >= least:
                first = min(x[0] for x in found)
                drop |= {(x[1], x[0][3]) for x in found if x[0] != first}
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, 0, 0, None))
            continue
        all_ = text.split("\n")
        rk = row_key(i, text)
        rest = [raw for no, raw in enumerate(all_) if (rk, no) not in drop]
        out.append((i, len(all_), len(all_) - len(rest), "\n".join(rest)))
    return sorted(out, key=str)


def run(spark, rows):
    from tunesmith.llm.linededup import line_dedup
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return sorted((tuple(r) for r in line_dedup(df).collect()), key=str)


def names(n):
    return ["".join(chr(97 + int(c)) for c in str(i)) for i in range(n)]


def many_templates(n, copies, words=12, seed=1):
    """``n`` templates of one leaf that share the leading words only, each with
    one variable word."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "klmnpr" for b in "aeiou" for c in "stvxz"]
    rows = []
    for k in range(n):
        body = [rng.choice(vocabulary) + "".join(chr(97 + int(x)) for x in str(k)) for _ in range(words - 3)]
        at = rng.randrange(words - 3)
        for copy, name in enumerate(names(copies)):
            line = ["posted", "by", "user", *body]
            line[3 + at] = f"{name}zz" + "".join(chr(97 + int(x)) for x in str(k))
            rows.append((100 * k + copy, " ".join(line)))
    return rows


def test_sixty_templates_in_a_leaf(spark):
    rows = many_templates(60, 4)
    out = run(spark, rows)
    assert out == brute(rows) and sum(r[2] for r in out) == 180
    # the least id of each template keeps its line
    assert [r[0] for r in out if r[2]] == [r[0] for r in out if r[0] % 100]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_tree(spark, rows, seed):
    rng = random.Random(seed)
    data = [(i, t) for i, t, _, _ in rows]
    few = ["alpha", "beta", "gamma", "delta"]
    forms = ["posted by user {} in the general news section today", "posted by user {} on a forum for sports fans",
             "order {} was sent by {} to the front desk on monday at noon", "{} said so", "Copyright {} ACME",
             "posted by user {} {} {} or else we go today", "a line without any field", "\t two  spaces {} "]
    for i in range(60):
        body = []
        for _ in range(rng.randrange(6)):
            form = rng.choice(forms)
            body.append(form.format(*[rng.choice(few + names(30) + ["17", "x3"]) for _ in range(3)]))
        data.append((1000 + i % 50, "\n".join(body)))
    data += [(None, "a line without any field"), (3000, " ".join(names(30))), (3001, " ".join(names(30)))]
    assert run(spark, data) == brute(data)


def test_jobs_do_not_depend_on_the_templates(spark):
    from tunesmith.llm.linededup import line_dedup
    jobs = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for n in (5, 500):
            df = spark.createDataFrame(many_templates(n, 4), "doc_id bigint, text string")
            spark.sparkContext.setJobGroup(f"templates-{n}", "")
            assert line_dedup(df).agg({"n_dropped": "sum"}).first()[0] == 3 * n
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"templates-{n}")))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.sparkContext.setJobGroup("", "")
    assert jobs[0] == jobs[1]


def test_clashing_columns_survive(spark):
    from tunesmith.llm.linededup import drop_recurring_lines
    clash = ["__rk", "__rk_drop", "__rk_all", "meta.lang", "drop", "line"]
    schema = "doc_id bigint, text string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in clash)
    data = [(i, f"own {w} text\nthe same closing line", 0, *[f"{c}{i}" for c in clash])
            for i, w in enumerate(names(5))]
    out = drop_recurring_lines(spark.createDataFrame(data, schema))
    assert out.columns == ["doc_id", "text", "n_chars", *clash]
    got = {r[0]: tuple(r) for r in out.collect()}
    for i, row in enumerate(data):
        text = row[1] if i == 0 else row[1].split("\n")[0]
        assert got[i] == (i, text, len(text), *row[3:])
