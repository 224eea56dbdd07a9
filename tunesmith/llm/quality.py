"""Quality rules: base limits plus robust multivariate outliers.

Every text gets word, symbol, duplicate-line and repeated-window counts.
Texts that pass the base limits are described by a vector of transformed
statistics.  Per language and source a minimum-covariance-determinant
estimate of centre and scatter is found by concentration steps from two
deterministic starts (all rows; rows near the coordinate medians): distances,
then mean and covariance of the closest ``H_SHARE`` of the rows, again and
again; the start with the smaller determinant wins.  A text is rejected when
its squared Mahalanobis distance exceeds ``cutoff``.

Scale: texts are read once into a narrow table of integers.  A concentration
step is one join with the estimates (one row per group and start) and one
aggregate per (group, start, distance bin), combined before the shuffle, so
no group is gathered in one task.  Sums are exact decimals: reruns agree to
the last bit.  Only DataFrame functions are used.

The scatter gets a floor per statistic, so groups of one row, or of rows
that agree in a statistic, have an estimate too; a single row is its own
centre and is kept.

Defined results: null or empty text has zero counts and fails the base limit
on words; null language or source is a group of its own; repeated rows are
judged alike; an empty table gives an empty result; clashing input columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import SPACES, fresh, prepare, quoted, row_key, stored, word_array

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
H_SHARE = 0.75
#: the 75 % nearest rows of a normal sample in four dimensions have this much
#: less scatter than all of them
CONSISTENCY = 1.49
STEPS = 4
#: least standard deviation assumed for each statistic
FLOORS = (0.05, 0.30, 0.10, 0.08)
#: about 6 standard deviations in four dimensions
CUTOFF = 45.0
_UNIT = 10000
_DIM = len(FLOORS)
_BINS_PER_DOUBLING = 8


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_lines (lines with a
    word), n_dup_lines and n_repeat_words (names must be free)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1),
                     lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    df = docs.withColumns({"__words": word_array(F.col(text_col)), "__lines": lines})
    df = df.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    grams = F.transform(
        F.when(F.size("__hashes") >= WINDOW,
               F.sequence(F.lit(1), F.size("__hashes") - (WINDOW - 1)))
        .otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.slice("__hashes", i, WINDOW)))
    df = df.withColumn("__grams", grams)
    df = df.withColumn("__repeats", F.size(F.array_distinct("__grams")) < F.size("__grams"))
    placed = F.when(F.col("__repeats"), F.sort_array(F.transform(
        "__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    df = df.withColumn("__sorted", placed)
    # starts of windows whose neighbour in hash order is equal
    marked = F.transform("__sorted", lambda x, j: F.when(
        (F.get(F.col("__sorted"), j - 1)["g"] == x["g"])
        | (F.get(F.col("__sorted"), j + 1)["g"] == x["g"]), x["i"]))
    df = df.withColumn("__starts", F.sort_array(F.filter(marked, lambda x: x.isNotNull())))
    # a window covers the words up to the next one, at most its own length
    covered = F.aggregate("__starts", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
                          lambda acc, s: F.struct(
                              (acc["n"] + F.least(F.lit(WINDOW), s - acc["at"])).alias("n"),
                              s.alias("at")), lambda acc: acc["n"])
    return df.withColumns({
        "n_words": F.size("__words").cast("bigint"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "n_lines": F.size("__lines").cast("bigint"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("bigint"),
    }).drop("__words", "__lines", "__hashes", "__grams", "__repeats", "__sorted", "__starts")


def _statistics_vector() -> list[Column]:
    """Transformed statistics in units of 1/10000 (integers)."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    values = [F.log(chars / words), F.log1p(F.col("n_symbols") * 100 / chars),
              F.col("n_dup_lines") / lines, F.col("n_repeat_words") / words]
    return [F.round(v * _UNIT).cast("bigint") for v in values]


def _x(i: int) -> Column:
    return F.col(f"x{i}") / F.lit(float(_UNIT))


def _pairs():
    return [(i, j) for i in range(_DIM) for j in range(i + 1)]


def _sums() -> list[Column]:
    big = "decimal(38,0)"
    return [F.count(F.lit(1)).alias("n"),
            *[F.sum(f"x{i}").cast(big).alias(f"s{i}") for i in range(_DIM)],
            *[F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(20,0)")).cast(big)
              .alias(f"s{i}{j}") for i, j in _pairs()]]


def _estimate(sums: DataFrame, keys: list[str], widen: float) -> DataFrame:
    """Centre, Cholesky factor and log determinant from summed moments."""
    n = F.col("n").cast("double")
    df = sums.select(*keys, *[(F.col(f"s{i}").cast("double") / n / _UNIT).alias(f"m{i}")
                              for i in range(_DIM)],
                     *[(F.col(f"s{i}{j}").cast("double") / n / (_UNIT * _UNIT))
                       .alias(f"q{i}{j}") for i, j in _pairs()])
    for i, j in _pairs():
        cov = F.greatest(F.col(f"q{i}{i}") - F.col(f"m{i}") * F.col(f"m{i}"), F.lit(0.0)) \
            if i == j else F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")
        cov = cov * F.lit(widen)
        if i == j:
            cov = cov + F.lit(FLOORS[i] ** 2)
        for k in range(j):
            cov = cov - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # the floor keeps pivots positive but for rounding
        value = F.sqrt(F.greatest(cov, F.lit(FLOORS[i] ** 2 / 4))) if i == j \
            else cov / F.col(f"l{j}{j}")
        df = df.withColumn(f"l{i}{j}", value)
    logdet = sum(F.log(F.col(f"l{i}{i}")) for i in range(_DIM)) * 2
    return df.select(*keys, *[f"m{i}" for i in range(_DIM)],
                     *[f"l{i}{j}" for i, j in _pairs()], logdet.alias("logdet"))


def _with_distance(rows: DataFrame, est: DataFrame, keys: list[str]) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution."""
    df = rows.join(est, keys)
    for i in range(_DIM):
        z = _x(i) - F.col(f"m{i}")
        for k in range(i):
            z = z - F.col(f"l{i}{k}") * F.col(f"z{k}")
        df = df.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
    d2 = sum(F.col(f"z{i}") * F.col(f"z{i}") for i in range(_DIM))
    return df.withColumn("d2", d2)


def _medians(rows: DataFrame) -> DataFrame:
    """Per group: the median of each statistic (to 1/100) from counts."""
    long = rows.select("grp", F.posexplode(F.array(
        *[F.floor(F.col(f"x{i}") / 100) for i in range(_DIM)])).alias("dim", "v"))
    counts = long.groupBy("grp", "dim", "v").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("grp", "dim")
    mid = (counts.withColumn("upto", F.sum("n").over(by.orderBy("v")))
           .withColumn("all", F.sum("n").over(by))
           .filter(F.col("upto") * 2 >= F.col("all")))
    return mid.groupBy("grp").agg(*[
        (F.min(F.when(F.col("dim") == i, F.col("v"))) / 100.0).alias(f"m{i}")
        for i in range(_DIM)])


def _concentrate(rows: DataFrame, est: DataFrame) -> DataFrame:
    """One step: moments of the closest share of each group, by distance bins."""
    keys = ["grp", "start"]
    near = _with_distance(rows, est, keys)
    bin_ = F.floor(F.log2(F.col("d2") + 1e-6) * _BINS_PER_DOUBLING)
    binned = near.withColumn("bin", bin_).groupBy(*keys, "bin").agg(*_sums())
    by = Window.partitionBy(*keys)
    upto = F.coalesce(F.sum("n").over(by.orderBy("bin").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    chosen = (binned.withColumn("before", upto).withColumn("all", F.sum("n").over(by))
              .filter(F.col("before") < F.col("all") * F.lit(H_SHARE)))
    names = ["n", *[f"s{i}" for i in range(_DIM)], *[f"s{i}{j}" for i, j in _pairs()]]
    return chosen.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])


def mcd_estimates(rows: DataFrame) -> DataFrame:
    """One MCD estimate per group from rows of (grp, x0..x3)."""
    whole = _estimate(rows.groupBy("grp").agg(*_sums()), ["grp"], 1.0)
    whole = whole.withColumn("start", F.lit(0))
    centre = _medians(rows)
    diagonal = centre.select(
        "grp", *[f"m{i}" for i in range(_DIM)],
        *[F.lit(FLOORS[i] if i == j else 0.0).alias(f"l{i}{j}") for i, j in _pairs()],
        F.lit(0.0).alias("logdet"), F.lit(1).alias("start"))
    est = stored(whole.unionByName(diagonal), "mcd")
    both = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    for _ in range(STEPS):
        est = stored(_estimate(_concentrate(both, est), ["grp", "start"], CONSISTENCY), "mcd")
    return est.groupBy("grp").agg(F.min_by(
        F.struct(*[f"m{i}" for i in range(_DIM)], *[f"l{i}{j}" for i, j in _pairs()]),
        F.struct("logdet", "start")).alias("e")).select("grp", "e.*")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  group_cols: Sequence[str] = ("lang", "source"),
                  cutoff: float = CUTOFF, with_key: bool = False) -> DataFrame:
    """One row per document: id, the counts, base_failed, distance, kept."""
    prepare(docs.sparkSession)
    own = docs.select(
        F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
        (row_key(id_col, text_col) if with_key else F.lit(None)).alias("__key"),
        F.to_json(F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group_cols)]))
        .alias("grp"))
    counted = text_statistics(own, "__text").drop("__text")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    rows = stored(counted.withColumn("base_failed", failed).select(
        "*", *[v.alias(f"x{i}") for i, v in enumerate(_statistics_vector())]), "quality")
    passed = rows.filter(~F.col("base_failed")).select("grp", *[f"x{i}" for i in range(_DIM)])
    est = stored(mcd_estimates(passed), "mcd")
    judged = _with_distance(rows.filter(~F.col("base_failed")), est, ["grp"])
    # a group can lack an estimate only if none of its rows passed
    out = [F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
           "n_repeat_words", "base_failed"]
    key = [F.col("__key").alias("row_key")] if with_key else []
    good = judged.select(*out, F.col("d2").alias("distance"),
                         (F.col("d2") <= F.lit(float(cutoff))).alias("kept"), *key)
    bad = rows.filter("base_failed").select(
        *out, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"), *key)
    return good.unionByName(bad)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **options) -> DataFrame:
    """The documents that pass, with their columns."""
    verdict = quality_rules(docs, id_col, text_col, with_key=True, **options)
    key = fresh(docs, "__key")
    rejected = verdict.filter(~F.col("kept")).select(F.col("row_key").alias(key)).distinct()
    return (docs.withColumn(key, row_key(id_col, text_col))
            .join(rejected, key, "left_anti").select(*quoted(docs)))
