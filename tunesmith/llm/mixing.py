"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are words.  Each source gets a target (its weight's share of the mix,
at most ``max_repeat`` times its own size, the excess reshared by weight).
The mix is cut into blocks of equal size, and blocks go to sources by the
highest quotients target / (2k + 1): integer quotas, exact in total.  The
documents of a source are laid out in a seeded order and cut into blocks of
``block`` words.  ``shards`` output shards get the source's blocks in equal parts,
and the quota in proportion, again as whole blocks: integer quotas per shard.  A
shard's quota of q blocks over its n blocks is q div n whole passes plus a run of
q mod n blocks from a start seeded by source and shard (wrapping round), so a
block is taken at most ``max_repeat`` times, and all but a few documents at the
ends of runs and shards are taken whole.

Scale: the seeded order is a uniform digest, so its leading bits cut every
source, also a hot one, into buckets of about ``bucket_rows`` rows in that
order.  Bucket totals are pre-aggregated; the running sums are a window per
bucket and one over the bucket totals.  Only DataFrame functions are used.

Defined results: null text has size 0; a null source is one source, ordered
last; null ids order as the word null; repeated rows are rows of their own;
with no words at all every target and quota is 0; an empty table gives an
empty result; clashing input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import fresh, prepare, quoted, stored, word_array, word_count

BLOCK = 32
SEED = 17
SHARDS = 16


def source_quotas(sized: DataFrame, weights: Sequence[float] = (5, 2, 1),
                  share: float = 1.5, max_repeat: int = 2,
                  block: int = BLOCK) -> DataFrame:
    """Targets and Sainte-Laguë quotas from rows of (source_key, source, size).

    One row per source; the windows without a partition run over sources,
    not documents.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    src = (sized.groupBy("source_key", "source")
           .agg(F.sum("size").cast("bigint").alias("source_size"))
           .withColumn("rank", F.row_number().over(by_name) - 1)
           .withColumn("weight", F.element_at(
               cycle, (F.col("rank") % len(weights) + 1).cast("int")))
           .withColumn("limit", (F.col("source_size") * max_repeat).cast("double"))
           .withColumn("ratio", F.col("limit") / F.col("weight"))
           .withColumn("mix", F.sum("source_size").over(everything) * F.lit(float(share))))
    # filling up: sources reach their limit in the order of limit / weight
    filled = Window.orderBy("ratio", "rank")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    src = (src
           .withColumn("limit_before", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
           .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("level", (F.col("mix") - F.col("limit_before"))
                       / (F.sum("weight").over(everything) - F.col("weight_before")))
           .withColumn("open_level", F.min(F.when(
               F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))
           ).over(everything)["level"])
           .withColumn("target", F.least(F.col("limit"), F.coalesce(
               F.col("open_level") * F.col("weight"), F.col("limit")))))
    # seats: every quotient of at least half a block's price, then the exact
    # total by adding the highest or taking back the lowest quotients
    src = (src
           .withColumn("n_blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("bigint"))
           .withColumn("seats", F.floor(F.sum("target").over(everything) / F.lit(float(block))
                                        + 0.5).cast("bigint"))
           .withColumn("price", F.sum("target").over(everything)
                       / F.greatest(F.col("seats"), F.lit(1)))
           .withColumn("base", F.least(
               F.when(F.col("price") > 0,
                      F.floor(F.col("target") / F.col("price") + 0.5)).otherwise(0)
               .cast("bigint"), F.col("n_blocks") * max_repeat))
           .withColumn("diff", F.col("seats") - F.sum("base").over(everything)))
    steps = src.select(
        "source_key", "rank", "target", "diff", "base", "n_blocks",
        F.explode(F.sequence(F.lit(1), F.abs(F.col("diff")))).alias("step")
    ).filter(F.col("diff") != 0)
    seat = F.when(F.col("diff") > 0, F.col("base") + F.col("step") - 1).otherwise(
        F.col("base") - F.col("step"))
    steps = (steps.withColumn("seat", seat)
             .filter((F.col("seat") >= 0)
                     & (F.col("seat") < F.col("n_blocks") * max_repeat))
             .withColumn("quotient", F.col("target") / (F.col("seat") * 2 + 1)))
    signed = F.when(F.col("diff") > 0, -F.col("quotient")).otherwise(F.col("quotient"))
    place = F.row_number().over(Window.orderBy(signed, F.when(
        F.col("diff") > 0, F.col("rank")).otherwise(-F.col("rank")), "step"))
    changed = (steps.withColumn("place", place)
               .filter(F.col("place") <= F.abs(F.col("diff")))
               .groupBy(F.col("source_key").alias("changed_key"))
               .agg(F.sum(F.signum("diff")).cast("bigint").alias("change")))
    src = (src.join(changed, F.col("source_key") == F.col("changed_key"), "left")
           .withColumn("quota", F.col("base") + F.coalesce(F.col("change"), F.lit(0))))
    return src.select("source_key", "source_size", "target", "n_blocks", "quota")


def shard_quotas(quotas: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per (source, output shard) with blocks: its blocks ``first`` to ``last``
    (exclusive) of the source's order, its integer quota ``blocks``, and how the quota
    is filled: ``passes`` over all of them and a run of ``rest`` blocks from
    ``start``.  Quotas add up to the source's; none exceeds the source's rate by a
    block."""
    parts = quotas.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    edge = [F.expr(f"(shard + {k}) * n_blocks div {n_shards}") for k in (0, 1)]
    parts = parts.withColumns({"first": edge[0], "last": edge[1]}).filter(F.col("last") > F.col("first"))
    parts = parts.withColumn("blocks", F.expr("quota * last div n_blocks - quota * first div n_blocks"))
    own = F.col("last") - F.col("first")
    start = F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.lit(f"{seed}:start"), F.col("shard").cast("string"), F.col("source_key"))), 1, 12), 16, 10)
    return parts.withColumn("own", own).select(
        "source_key", "shard", "first", "last", "blocks", F.expr("blocks div own").alias("passes"),
        (F.col("blocks") % F.col("own")).alias("rest"), (start.cast("bigint") % F.col("own")).alias("start"))


def _clip(x: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.least(x, high), low)


def _words_before(runs: Column, pos: Column, size: Column, block: int) -> Column:
    """Words that the shards' ``runs`` take before word position ``pos`` of a
    source of ``size`` words, repeats counted."""
    def taken(r: Column) -> Column:
        low, high = r["first"] * block, F.least(r["last"] * block, size)
        begin = (r["first"] + r["start"]) * block
        end = begin + r["rest"] * block
        run = _clip(pos, begin, F.least(end, high)) - begin
        # the part that wraps round to the shard's first block
        over = F.greatest(end - r["last"] * block, F.lit(0))
        return r["passes"] * (_clip(pos, low, high) - low) + F.when(
            r["rest"] > 0, run + _clip(pos, low, low + over) - low).otherwise(0)

    return F.aggregate(runs, F.lit(0).cast("bigint"), lambda acc, r: acc + taken(r))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights: Sequence[float] = (5, 2, 1),
             share: float = 1.5, max_repeat: int = 2, block: int = BLOCK,
             seed: int = SEED, bucket_rows: int = 16384, shards: int = SHARDS) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, and what
    decides it: its word ``offset`` in the source's order and the ``runs`` of the
    shards that hold its blocks."""
    prepare(docs.sparkSession)
    size = word_count(F.col(text_col))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    sized = stored(docs.select(
        F.col(id_col), size.alias("size"), F.col(source_col).alias("source"),
        F.to_json(F.struct(F.col(source_col).alias("s"))).alias("source_key"),
        ident.alias("ident"))
        .withColumn("order_key", F.md5(F.concat_ws(":", F.lit(str(seed)), "ident", "size")))
        .drop("ident"), "mix-sizes")
    n_buckets = -(-max(sized.count(), 1) // bucket_rows)
    lead = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("bigint")
    sized = sized.withColumn("bucket", F.floor(lead * n_buckets / F.lit(1 << 32)).cast("bigint"))
    quotas = stored(source_quotas(sized, weights, share, max_repeat, block), "mix-quotas")
    # one row per source, with one entry per shard
    runs = shard_quotas(quotas, shards, seed).groupBy("source_key").agg(F.array_sort(F.collect_list(
        F.struct("shard", "first", "last", "passes", "rest", "start"))).alias("runs"))
    quotas = quotas.join(runs, "source_key", "left")
    so_far = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (sized.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"))
               .withColumn("bucket_start", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
               .drop("words").join(quotas, "source_key"))
    inside = Window.partitionBy("source_key", "bucket").orderBy("order_key").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = (sized.join(offsets, ["source_key", "bucket"])
              .withColumn("offset", (F.col("bucket_start") + F.coalesce(
                  F.sum("size").over(inside), F.lit(0))).cast("bigint")))
    end = F.col("offset") + F.col("size")
    mine = F.filter(F.coalesce("runs", F.array()), lambda r: (r["first"] * block < F.col("end"))
                    & (r["last"] * block > F.col("offset")))
    placed = placed.withColumn("end", end).withColumn("runs", mine)
    taken = [_words_before(F.col("runs"), F.col(c), F.col("source_size"), block) for c in ("end", "offset")]
    return placed.select(id_col, "size", "source_size", "target",
                         (taken[0] - taken[1]).cast("bigint").alias("taken"), "offset", "runs")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", block: int = BLOCK, **options) -> DataFrame:
    """The mixed table itself, with the columns of ``docs``.

    A document appears as often as its words are taken: whole where all are,
    else the words taken so often, joined by single spaces.  Character counts (``n_chars``) follow
    the text.  Documents without words are not part of a mix.
    """
    plan = plan_mix(docs, id_col, text_col, source_col, block=block, **options)
    ident, size, nth, mix, copy = (fresh(docs, c) for c in (
        "__mix_id", "__mix_size", "__mix_nth", "__mix", "__mix_copy"))
    # rows of equal id and size are paired one to one
    alike = Window.partitionBy(ident, size)
    taken = (plan.filter(F.col("taken") > 0)
             .select(F.col(id_col).alias(ident), F.col("size").alias(size),
                     F.struct("offset", "size", "taken", "runs").alias(mix))
             .withColumn(nth, F.row_number().over(alike.orderBy(mix))))
    src = docs.select("*", F.col(id_col).alias(ident), word_count(F.col(text_col)).alias(size))
    src = src.withColumn(nth, F.row_number().over(alike.orderBy(
        F.coalesce(F.col(source_col), F.lit("")), F.md5(F.col(text_col)))))
    both = src.alias("a").join(
        taken.alias("b"), F.col(f"a.{ident}").eqNullSafe(F.col(f"b.{ident}"))
        & (F.col(f"a.{size}") == F.col(f"b.{size}")) & (F.col(f"a.{nth}") == F.col(f"b.{nth}"))
    ).select(*[F.col(f"a.`{c}`") for c in docs.columns], F.col(f"b.{mix}").alias(mix))
    m = F.col(mix)
    # words of one shard that are all in its run, or all out of it, are taken alike
    even = (F.size(m["runs"]) == 1) & (m["taken"] % m["size"] == 0)

    def times(i: Column) -> Column:
        """How often the word at place ``i`` is taken."""
        at = m["offset"] + i

        def by(r: Column) -> Column:
            own = r["last"] - r["first"]
            turn = F.pmod(F.floor(at / block) - r["first"] - r["start"], own)
            inside = (at >= r["first"] * block) & (at < r["last"] * block)
            return F.when(inside, r["passes"] + F.when(turn < r["rest"], 1).otherwise(0)).otherwise(0)

        return F.aggregate(m["runs"], F.lit(0).cast("bigint"), lambda acc, r: acc + by(r))

    each = F.when(~even, F.transform(word_array(F.col(text_col)), lambda w, i: F.struct(
        w.alias("w"), times(i).alias("n"))))
    both = both.withColumn(nth, each)
    copies = F.when(even, F.expr(f"`{mix}`.taken div `{mix}`.size")).otherwise(F.array_max(
        F.transform(nth, lambda x: x["n"])))
    out = both.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), copies.cast("bigint"))))
    part = F.when(even | F.forall(nth, lambda x: x["n"] >= F.col(copy)), F.col(text_col)).otherwise(
        F.array_join(F.transform(F.filter(nth, lambda x: x["n"] >= F.col(copy)), lambda x: x["w"]), " "))
    out = out.withColumn(text_col, part)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.col(text_col)).cast("bigint"))
    return out.select(*quoted(docs))
