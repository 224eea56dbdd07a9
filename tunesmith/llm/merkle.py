"""Merkle manifest of a dataset by incremental witnesses.

A row's leaf is the digest of its columns.  The leaves of a group (``lang``)
ascend by id; as long as several nodes remain, every ``ARITY`` consecutive ones
become their digest.  What remains is the group's subroot, and the subroots, in
the order of their groups, likewise give the root.

Leaves are appended in aligned blocks of ``ARITY ** LEVELS``, one stream of
appends each.  A leaf opens with an empty witness.  Whenever a subtree has all
its siblings, they extend the witnesses below it; those are held once for each
run of ``ARITY`` nodes, not once for each leaf.  A block leaves one root, and the
block roots are the next round's appends.  There is a round for every ``LEVELS``
levels, so their number grows with the logarithm of the rows.  At last the
witnesses of a round extend those of the round before, block by block, down to
the leaves.  No key has more than ``ARITY ** LEVELS`` rows in a join or a task.

Defined results: null columns enter a leaf as ``-``; null groups come first,
and null ids first in their group; repeated rows are leaves of their own, next
to each other (of rows with one id, in the order of their leaves); an empty table
has no rows and no root; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import placed, prepare, stored

ARITY = 8
#: levels that one stream of appends closes
LEVELS = 3
BLOCK = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "struct<l:string,r:string>"
RUNS = f"grp string, block bigint, run bigint, n bigint, nodes array<string>, ids array<bigint>, \
altered array<string>, above array<{STEP}>, root string"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Digest of column values: of each its UTF-8 length, ``:`` and itself."""
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


class _Appends:
    """Aligned appends of one block: open subtrees with partial witnesses."""

    def __init__(self, grp: str, block: int, n: int):
        self.key, self.n, self.runs = (grp, block), n, []
        # of each level: (digest, runs of the first level below) of the nodes of its open run
        self.open = [[] for _ in range(LEVELS + 1)]

    def append(self, digest: str, ident, altered) -> None:
        first = self.open[0]
        if not first:
            self.runs.append(([], [], [], []))
        nodes, ids, others, _ = self.runs[-1]
        nodes.append(digest)
        ids.append(ident)
        others.append(altered)
        first.append((digest, None))
        if len(first) == ARITY:
            self._close(0)

    def _close(self, level: int) -> None:
        """The run at ``level`` is whole: its nodes are siblings, and their
        digest is appended above."""
        import hashlib

        run, self.open[level] = self.open[level], []
        digests = [d for d, _ in run]
        if level:
            for k, (_, below) in enumerate(run):
                step = {"l": "".join(digests[:k]), "r": "".join(digests[k + 1:])}
                for witness in below:
                    witness.append(step)
            held = [w for _, below in run for w in below]
        else:
            held = [self.runs[-1][3]]
        up = self.open[level + 1]
        up.append((hashlib.sha256("".join(digests).encode()).hexdigest(), held))
        if level + 1 < LEVELS and len(up) == ARITY:
            self._close(level + 1)

    def finish(self) -> list[tuple]:
        """One row for each run; the first carries the block's root."""
        several = self.n > BLOCK          # else the block is the whole group
        for level in range(LEVELS):
            alone = not any(self.open[level + 1:])
            if self.open[level] and (several or not alone or len(self.open[level]) > 1):
                self._close(level)
        root = next(nodes[0][0] for nodes in reversed(self.open) if nodes)
        grp, block = self.key
        first = block * (BLOCK // ARITY)
        return [(grp, block, first + k, self.n, *run, root if k == 0 else None)
                for k, run in enumerate(self.runs)]


def _appended(nodes: DataFrame, payload: bool) -> DataFrame:
    """Runs of ``nodes`` (grp, idx, n, digest; with ``payload`` id and altered)
    with the witnesses that their blocks give them."""
    extra = ["id", "altered"] if payload else [
        F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("altered")]
    block = F.floor(F.col("idx") / BLOCK).cast("bigint").alias("block")
    dealt = (nodes.select("grp", block, "idx", "n", "digest", *extra)
             .repartition("grp", "block").sortWithinPartitions("grp", "block", "idx"))

    def streams(batches: Iterator) -> Iterator:
        import pyarrow as pa
        step = pa.struct([("l", pa.string()), ("r", pa.string())])
        schema = pa.schema([
            ("grp", pa.string()), ("block", pa.int64()), ("run", pa.int64()), ("n", pa.int64()),
            ("nodes", pa.list_(pa.string())), ("ids", pa.list_(pa.int64())),
            ("altered", pa.list_(pa.string())), ("above", pa.list_(step)), ("root", pa.string())])

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(col, f.type) for col, f in zip(zip(*rows), schema)], schema=schema)

        now = None
        for part in batches:
            for grp, blk, n, digest, ident, altered in zip(*(part.column(c).to_pylist() for c in (
                    "grp", "block", "n", "digest", "id", "altered"))):
                if now is None or now.key != (grp, blk):
                    if now is not None:
                        yield batch(now.finish())
                    now = _Appends(grp, blk, n)
                now.append(digest, ident, altered)
        if now is not None:
            yield batch(now.finish())

    return stored(dealt.mapInArrow(streams, RUNS), "merkle-runs")


def _rounds(nodes: DataFrame, payload: bool = False) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every round, and (grp, root) of every group."""
    rounds, roots = [], None
    while True:
        runs = _appended(nodes, payload)
        rounds.append(runs)
        tops = runs.filter(F.col("root").isNotNull()).select(
            "grp", F.col("block").alias("idx"), F.col("root").alias("digest"),
            F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"))
        done = tops.filter("n = 1").select("grp", F.col("digest").alias("root"))
        roots = done if roots is None else roots.union(done)
        nodes, payload = tops.filter("n > 1"), False
        if nodes.isEmpty():
            return rounds, roots


def _own_step(nodes: str, k: str) -> Column:
    """The siblings of a run's ``k``-th node."""
    return F.struct(
        F.array_join(F.slice(nodes, 1, F.col(k)), "").alias("l"),
        F.array_join(F.slice(nodes, F.col(k) + 2, ARITY), "").alias("r"))


def _extended(runs: DataFrame, upper: DataFrame, carry: list[str], payload: bool = False) -> DataFrame:
    """(grp, block, witness, carry...) of the nodes of ``runs``, a round's, whose
    blocks have the witnesses ``upper`` (grp, block, witness, carry...)."""
    both = runs.drop("root").join(upper, ["grp", "block"])
    each = both.select("*", F.posexplode("nodes").alias("k", "node"))
    own = F.when(F.col("n") > 1, F.array(_own_step("nodes", "k"))).otherwise(
        F.array().cast(f"array<{STEP}>"))
    return each.select(
        "grp", (F.col("run") * ARITY + F.col("k")).alias("block"), "node",
        F.concat(own, "above", "witness").alias("witness"), *carry,
        *([F.get("ids", F.col("k")).alias("id"), F.get("altered", F.col("k")).alias("altered")]
          if payload else []))


def _descended(rounds: list[DataFrame], tops: DataFrame, carry: list[str],
               payload: bool = False) -> DataFrame:
    """Witnesses of the first round's nodes; ``tops``: (grp, witness, carry...)
    of the groups."""
    held = None
    for k in range(len(rounds) - 1, -1, -1):
        runs = rounds[k]
        # groups that this round makes one root of
        here = tops.join(runs.filter(F.col("root").isNotNull() & (F.col("n") <= BLOCK))
                         .select("grp", "block"), "grp").select("grp", "block", "witness", *carry)
        upper = here if held is None else here.unionByName(held.select(*here.columns))
        held = _extended(runs, upper, carry, payload and k == 0)
    return held


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
             text_col: str = "text", fields=FIELDS, tamper: Column | None = None) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256 (digest of all siblings, from
    the lowest level up, left to right), folded_root and verified.

    Rows for which ``tamper`` holds are verified with their text's A-Z
    lower-cased against the witness of the untampered text.
    """
    spark = docs.sparkSession
    prepare(spark)
    leaf = leaf_digest(*[F.col(c) for c in fields])
    bad = leaf_digest(*[F.translate(F.col(c), UPPER, LOWER) if c == text_col else F.col(c)
                        for c in fields])
    # the salt divides repeated rows among range partitions
    leaves = stored(docs.select(
        F.coalesce(F.concat(F.lit("t"), F.col(group_col).cast("string")), F.lit("n")).alias("grp"),
        F.col(id_col).alias("id"), leaf.alias("digest"),
        F.when(F.lit(False) if tamper is None else tamper, bad).alias("altered"),
        F.monotonically_increasing_id().alias("salt")), "merkle-leaves")
    rounds, subroots = _rounds(placed(leaves, "grp", ["id", "digest", "salt"]), payload=True)
    subroots = stored(subroots, "merkle-subroots")
    # the groups, null first, are the leaves of the upper tree
    tree = placed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"),
                                   F.col("root").alias("digest")), "grp", ["name"])
    tree = stored(tree, "merkle-groups")
    upper, root = _rounds(tree)
    whole = root.select(F.lit("").alias("grp"), F.array().cast(f"array<{STEP}>").alias("witness"), "root")
    groups = _descended(upper, whole, ["root"]).join(
        tree.select(F.col("idx").alias("block"), "name", F.col("digest").alias("subroot")), "block")
    tops = stored(groups.select(F.col("name").alias("grp"), "witness", "root", "subroot"),
                  "merkle-witnesses")
    held = _descended(rounds, tops, ["root", "subroot"], payload=True)
    proof = F.sha2(F.array_join(F.transform("witness", lambda w: F.concat(w["l"], w["r"])), ""), 256)
    folded = F.aggregate("witness", F.coalesce("altered", "node"),
                         lambda acc, w: F.sha2(F.concat(w["l"], acc, w["r"]), 256))
    return held.select(F.col("id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root",
                       proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
