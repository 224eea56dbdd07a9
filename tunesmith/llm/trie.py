"""Prefix trie of conversations by truncation peeling.

A node is a sequence of first turns that some conversation starts with.  The
trie is peeled from its deepest nodes: at every depth the conversations that end
there join the nodes that survive from below, the last turn is stripped, and what
then is equal is one node of the next depth.  The same pass finds a node's
members, children, leaves and saved tokens, and hands a node's id to its children.

A prefix has a 128-bit digest: the exclusive or of its turns' digests, each mixed
with its place.  So a parent's digest is known without looking the turn before
up, and a long conversation's digests are made in pieces.

One task peels the subtree of a *floor*, the highest node on a path with at most
``width`` different endings, in descending order of depth; it holds the
surviving nodes only.  The nodes above floors are the branches of a smaller trie
with (at most) one ending for every ``width`` of the one before, peeled alike in
the next round with what the floors hand up.  So the rounds are a logarithm of
the conversations, and no group has more endings than ``width``.

Rows with equal turns in one conversation are ordered by the digest of role and
text.  Defined results: null turns come first; null role or text is empty;
rows without a conversation id are no conversation and are left out; repeated
rows are turns of their own; an empty table has no nodes, not even a root;
columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import placed, prepare, stored

#: most different endings below a floor
WIDTH = 512
#: turns of a conversation whose digests are chained at a time
PIECE = 1024
#: parts into which rows of one wide node are dealt in a join
SALTS = 64
#: conversation ids joined into one piece of an ends list, at most
ENDS = 4096
NODE = ["a", "b"]
GIVEN = ["convs", "first", "children", "leaves", "saved"]


def shared_heads(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: the first h turns of conversation ``c - c % block``,
    then c's own after its first h; h is ``crc32(c) % most``.

    ``turns`` has (conv, idx, n, ...).  Returns rows (conv, pos, ...) and one row
    (conv, m) for each conversation with its number of turns.
    """
    rest = [c for c in turns.columns if c not in ("conv", "idx", "n")]
    h = F.crc32(F.col("conv").cast("string")) % most
    base = F.col("conv") - F.col("conv") % block
    heads = turns.filter((F.col("conv") % block == 0) & (F.col("idx") < most - 1)).select(
        F.col("conv").alias("base"), "idx", F.col("n").alias("base_n"), *rest)
    sizes = heads.filter("idx = 0").select("base", "base_n")
    known = turns.filter("idx = 0").select("conv", "n", h.alias("h"), base.alias("base"))
    known = known.join(sizes, "base", "left").select(
        "conv", "base", "h", "n", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    lengths = known.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("m"))
    own = (turns.filter(F.col("idx") >= h).withColumn("base", base).join(sizes, "base", "left")
           .select("conv", (F.col("idx") - h + F.least(h, F.coalesce("base_n", F.lit(0)))).alias("pos"), *rest))
    lent = known.join(heads.drop("base_n"), "base").filter(F.col("idx") < F.col("taken")).select(
        "conv", F.col("idx").alias("pos"), *rest)
    return lent.unionByName(own), lengths


def _paths(rows: DataFrame) -> DataFrame:
    """(conv, depth, a, b, pa, pb, len) of every turn (conv, pos, digest, len):
    the node that ends with it, and that node's parent."""
    rows = rows.withColumn("piece", F.floor(F.col("pos") / PIECE)).select(
        "conv", "pos", "piece", "len", *[F.xxhash64(F.lit(k), "digest", "pos").alias(x)
                                         for k, x in ((1, "ta"), (2, "tb"))])
    run = Window.partitionBy("conv", "piece").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", F.bit_xor("ta").over(run).alias("a"), F.bit_xor("tb").over(run).alias("b"))
    # what earlier pieces give; conversations of one piece have none
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (rows.groupBy("conv", "piece").agg(F.bit_xor("ta").alias("ta"), F.bit_xor("tb").alias("tb"),
                                                F.max("pos").alias("top"))
              .filter((F.col("piece") > 0) | (F.col("top") == PIECE - 1))
              .select("conv", "piece", F.bit_xor("ta").over(before).alias("xa"),
                      F.bit_xor("tb").over(before).alias("xb")).filter("piece > 0"))
    rows = rows.join(pieces, ["conv", "piece"], "left")
    a, b = (F.col(x).bitwiseXOR(F.coalesce(y, F.lit(0))) for x, y in (("a", "xa"), ("b", "xb")))
    return rows.select("conv", (F.col("pos") + 1).alias("depth"), a.alias("a"), b.alias("b"),
                       a.bitwiseXOR(F.col("ta")).alias("pa"), b.bitwiseXOR(F.col("tb")).alias("pb"), "len")


def _summed(rows: DataFrame) -> DataFrame:
    """What is handed to each node (a, b), added up."""
    return rows.groupBy(*NODE).agg(F.sum("convs").alias("convs"), F.min("first").alias("first"),
                                   *[F.sum(c).alias(c) for c in GIVEN[2:]])


OUT = "a bigint, b bigint, pa bigint, pb bigint, depth bigint, first bigint, parent bigint, convs bigint, \
children bigint, leaves bigint, saved bigint, is_floor boolean"


def _peeled(nodes: DataFrame) -> DataFrame:
    """Peel the subtrees of the floors (fa, fb) of ``nodes``, deepest nodes first."""
    dealt = nodes.repartition("fa", "fb").sortWithinPartitions("fa", "fb", F.desc("depth"))
    columns = ["fa", "fb", "a", "b", "pa", "pb", "depth", "len", *GIVEN]

    def peel(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [c.split()[0] for c in OUT.split(", ")]
        kinds = {"boolean": pa.bool_()}
        schema = pa.schema([(c.split()[0], kinds.get(c.split()[1], pa.int64())) for c in OUT.split(", ")])
        floor, survivors, out = None, {}, []

        def full():
            made = pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], schema.field(k).type) for k in range(len(names))], schema=schema)
            out.clear()
            return made

        for batch in batches:
            for fa, fb, a, b, up_a, up_b, depth, size, convs, first, children, leaves, saved in zip(
                    *(batch.column(c).to_pylist() for c in columns)):
                if (fa, fb) != floor:
                    floor, survivors = (fa, fb), {}
                # nodes that survive from below, stripped to this one
                below = survivors.pop((a, b), ())
                for child in below:
                    convs += child[7]
                    first = child[5] if first is None else min(first, child[5])
                    leaves += child[9]
                    saved += child[10]
                for child in below:
                    child[6] = first
                out.extend(below)
                children += len(below)
                leaves = leaves if children else 1
                saved += (convs - 1) * size
                node = [a, b, up_a, up_b, depth, first, None, convs, children, leaves, saved,
                        (a, b) == floor]
                if node[-1]:
                    out.append(node)
                else:
                    survivors.setdefault((up_a, up_b), []).append(node)
            if len(out) >= 4096:
                yield full()
        yield full()

    return dealt.select(*columns).mapInArrow(peel, OUT)


def peel_trie(paths: DataFrame, ended: DataFrame, width: int = WIDTH) -> DataFrame:
    """Nodes (``OUT``'s columns) of the trie of ``paths`` (conv, depth, a, b, pa, pb,
    len; also depth 0) with ``ended`` (a, b, convs, first), the endings."""
    given = ended.select(*NODE, "convs", "first", *[F.lit(0).cast("bigint").alias(c) for c in GIVEN[2:]])
    # of equal conversations one path
    paths = stored(paths.join(ended.select(F.col("first").alias("conv")), "conv", "left_semi"), "trie-paths")
    found, wide_nodes = [], []
    while True:
        every = paths.groupBy(*NODE).agg(F.count(F.lit(1)).alias("ends"), F.first("pa").alias("pa"),
                                         F.first("pb").alias("pb"), F.first("depth").alias("depth"))
        wide = stored(every.filter(F.col("ends") > width).drop("ends"), "trie-wide")
        last = wide.isEmpty()
        if last:
            below = paths.select(*[F.lit(0).cast("bigint").alias(f) for f in ("fa", "fb")],
                                 *NODE, "pa", "pb", "depth", "len")
        else:
            salted = wide.select(*NODE, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
                                 F.lit(True).alias("wide"))
            flagged = stored(paths.withColumn("salt", F.pmod(F.xxhash64("conv"), F.lit(SALTS)).cast("int"))
                             .join(salted, [*NODE, "salt"], "left").drop("salt"), "trie-flagged")
            cuts = flagged.groupBy("conv").agg(
                F.max(F.when(F.col("wide"), F.struct("depth", "a", "b"))).alias("cut"),
                F.min(F.when(F.col("wide").isNull(), F.struct("depth", "a", "b"))).alias("floor"))
            cuts = stored(cuts, "trie-cuts")
            below = flagged.filter(F.col("wide").isNull()).join(cuts, "conv").select(
                F.col("floor.a").alias("fa"), F.col("floor.b").alias("fb"), *NODE, "pa", "pb", "depth", "len")
        nodes = below.groupBy("fa", "fb", *NODE).agg(*[F.first(c).alias(c) for c in ("pa", "pb", "depth", "len")])
        nodes = nodes.join(given, NODE, "left").select(
            "fa", "fb", *NODE, "pa", "pb", "depth", "len", "first",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in GIVEN if c != "first"])
        done = stored(_peeled(nodes), "trie-nodes")
        found.append(done)
        if last:
            break
        handed = done.filter("is_floor").select(
            F.col("pa").alias("a"), F.col("pb").alias("b"), "convs", "first",
            F.lit(1).cast("bigint").alias("children"), "leaves", "saved")
        given = stored(_summed(given.select(*NODE, *GIVEN).join(wide.select(*NODE), NODE, "left_semi")
                               .unionByName(handed)), "trie-given")
        # wide nodes without a wide child are the endings of the next round's trie
        tips = wide.select(*NODE).join(wide.select(F.col("pa").alias("a"), F.col("pb").alias("b"), "depth")
                                       .filter("depth > 0"), NODE, "left_anti")
        chosen = (cuts.select(F.col("cut.a").alias("a"), F.col("cut.b").alias("b"), "conv")
                  .groupBy(*NODE).agg(F.min("conv").alias("conv")).join(tips, NODE, "left_semi").select("conv"))
        paths = stored(flagged.filter("wide").drop("wide").join(chosen, "conv", "left_semi"), "trie-paths")
        wide_nodes.append(done)
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    if len(found) == 1:
        return nodes
    # a floor's parent was peeled in a later round
    ups = found[1]
    for more in found[2:]:
        ups = ups.unionByName(more)
    ups = ups.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("first").alias("up"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    floors = (nodes.filter("is_floor and depth > 0")
              .withColumn("salt", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)).cast("int"))
              .join(ups, ["pa", "pb", "salt"]).withColumn("parent", F.col("up")))
    return nodes.filter("not (is_floor and depth > 0)").unionByName(floors.select(*nodes.columns))


def _ends_digests(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) from (a, b, conv): ids in order, joined by commas.
    Ids are joined in pieces that hold at most ``ENDS`` (they differ), and one task
    streams a node's pieces through its digest."""
    piece = F.floor(F.col("conv") / ENDS).alias("piece")
    pieces = ends.groupBy(*NODE, piece).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")

    def digests(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        now, state = None, None

        def made(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.string())], names=["a", "b", "ends_sha256"])

        for batch in batches:
            rows = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    rows.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(ids.encode())
            yield made(rows)
        if now is not None:
            yield made([(*now, state.hexdigest())])

    return dealt.mapInArrow(digests, "a bigint, b bigint, ends_sha256 string")


def turn_digests(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, idx, n, digest, len): the turns of each conversation in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest: Column = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = convs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"),
        F.char_length(text).cast("bigint").alias("len"), F.monotonically_increasing_id().alias("salt"))
    return placed(stored(rows, "turns"), "conv", ["turn", "digest", "salt"]).select(
        "conv", "idx", "n", "digest", "len")


def prefix_trie(convs: DataFrame, width: int = WIDTH, **columns) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (`shared_heads`)."""
    prepare(convs.sparkSession)
    turns = stored(turn_digests(convs, **columns), "turns-placed")
    rows, lengths = shared_heads(turns)
    lengths = stored(lengths, "trie-lengths")
    paths = stored(_paths(rows), "trie-rows")
    zero = F.lit(0).cast("bigint")
    ends = paths.join(lengths, "conv").filter(F.col("depth") == F.col("m")).select("conv", *NODE).unionByName(
        lengths.filter("m = 0").select("conv", zero.alias("a"), zero.alias("b")))
    ends = stored(ends, "trie-ends")
    ended = stored(ends.groupBy(*NODE).agg(F.count(F.lit(1)).alias("convs"), F.min("conv").alias("first")),
                   "trie-ended")
    roots = lengths.select("conv", *[zero.alias(c) for c in ("depth", "a", "b", "pa", "pb", "len")])
    nodes = peel_trie(paths.unionByName(roots), ended, width)
    none = F.sha2(F.lit(""), 256)
    return nodes.join(_ends_digests(ends), NODE, "left").select(
        F.col("first").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"),
        F.col("convs").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"))
