"""Line dedup by a log-template tree of fixed depth.

A line's tokens with a digit become ``<*>``.  The tree has fixed depth: token
count, then the leading ``depth`` tokens.  In a leaf with several different lines
a token that fewer than ``min_docs`` of its lines hold at that place is variable,
``<*>`` too; the line so generalised is its template, if no more than
``1 - similarity`` of its places are variable.  Where fewer than ``min_docs`` lines
have a line's template, one place more may be variable, if enough lines agree in the
others: of such places the one that most lines agree on, of equal ones the first
(a variable field whose values recur has tokens that many lines hold).  Every
other line is a template of its own.  A template found in at least
``min_docs`` documents recurs: its first line (by id, then place) stays, all
others go, so content survives once.  A line of at least ``long_words`` words
recurs from two documents on if it is equal word by word, digits included.
Lines without a word always stay.

Scale: lines travel as digests; documents are shuffled twice, to look up one
occurrence of every different line of a leaf that has several, and to cut.
Tokens are counted, and templates found, for all leaves at once, so the number
of jobs does not depend on the data.  Counts are combined before the shuffle;
joins have a line, a rare token or a template as their key on the smaller side.
Only DataFrame functions are used.

Defined results: null text stays null with no lines; empty text stays empty;
repeated rows (equal id and text) count as one document and are cut alike;
null ids come last in the order; a document that loses all its lines stays as
an empty text; an empty table gives an empty result; clashing input columns
are ignored or carried unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import SPACES, free_prefix, prepare, quoted, row_key, stored

DEPTH = 3
SIMILARITY = 0.8
MIN_DOCS = 3
#: words from which two equal lines are no chance
LONG_WORDS = 20


def _flat(line: Column) -> Column:
    """Words joined by single spaces.  Lines that have nothing to replace are
    not rewritten."""
    odd = F.contains(line, F.lit("  "))
    for c in SPACES[1:]:
        odd = odd | F.contains(line, F.lit(c))
    return F.trim(F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))


def _masked(flat: Column) -> Column:
    """A flat line with ``<*>`` for words with a digit."""
    return F.when(F.rlike(flat, F.lit("[0-9]")), F.regexp_replace(
        flat, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", "<*>")).otherwise(flat)


def _lines(docs: DataFrame, id_col: str, text_col: str, depth: int,
           long_words: int = LONG_WORDS) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("rk"),
                       F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line"))
    # the filter looks at the raw line: on a derived one it would derive it twice
    rows = rows.filter(F.btrim("line", F.lit(SPACES)) != "")
    rows = rows.select("id", "rk", "line_no", _flat(F.col("line")).alias("flat"))
    rows = rows.select("*", _masked(F.col("flat")).alias("masked"))
    count = F.octet_length("masked") - F.octet_length(
        F.replace("masked", F.lit(" "), F.lit("")))
    rows = rows.select("*", count.alias("count"), F.unhex(F.md5("masked")).alias("digest"))
    return rows.select("id", "rk", "line_no",
                       F.xxhash64("count", F.substring_index("masked", " ", depth)).alias("leaf"),
                       F.col("digest").alias("line"),
                       (F.col("count") >= long_words - 1).alias("long"),
                       # null where it is the line's own digest
                       F.when((F.col("count") >= long_words - 1) & (F.col("flat") != F.col("masked")),
                              F.unhex(F.md5("flat"))).alias("exact"))


def line_templates(lines: DataFrame, docs: DataFrame, id_col: str, text_col: str,
                   similarity: float, min_docs: int = MIN_DOCS) -> DataFrame:
    """(line, tree) of the lines of leaves with several that have a template
    other than themselves, or share theirs.

    ``lines`` has (leaf, line, rk, line_no); of every different line in a leaf
    with several, one occurrence is looked up in ``docs``.
    """
    crowded = (lines.groupBy("leaf").agg(F.min("line").alias("lo"), F.max("line").alias("hi"))
               .filter(F.col("lo") != F.col("hi")).select("leaf"))
    wanted = (lines.join(crowded, "leaf", "left_semi").groupBy("leaf", "line")
              .agg(F.min(F.struct("rk", "line_no")).alias("at"), F.count(F.lit(1)).alias("n"))
              .groupBy(F.col("at.rk").alias("rk")).agg(F.collect_list(F.struct(
                  F.col("at.line_no").alias("line_no"), "leaf", "line", "n")).alias("items")))
    texts = docs.select(row_key(id_col, text_col).alias("rk"), F.col(text_col).alias("text"))
    found = texts.join(wanted, "rk").withColumn("all", F.split("text", "\n", -1)).select(
        F.explode(F.transform("items", lambda x: F.struct(
            x["leaf"].alias("leaf"), x["line"].alias("line"), x["n"].alias("n"),
            F.get(F.col("all"), x["line_no"]).alias("raw")))).alias("x")).select("x.*")
    words = found.select("leaf", "line", "n", F.split(_masked(_flat(F.col("raw"))), " ").alias("words"))
    # rows that stand twice in the table were looked up twice
    words = words.dropDuplicates(["leaf", "line"])
    return templates(stored(words, "leaf-lines"), similarity, min_docs)


def _any(at: Column) -> Column:
    """Hash of a place of a leaf that holds any token."""
    return F.xxhash64("leaf", at, F.lit("<*>"))


def templates(different: DataFrame, similarity: float, min_docs: int) -> DataFrame:
    """(line, tree) for ``different``: (leaf, line, n, words), a row for each
    different line with its number of occurrences; ``tree`` is the template.

    A spot is the hash of leaf, place and token; a line's pattern is the exclusive or
    of its spots, so a place is made variable by exchanging its spot.
    """
    spots = F.transform("words", lambda w, i: F.xxhash64("leaf", i, w))
    hashed = different.select("leaf", "line", "n", spots.alias("spots"))
    hashed = stored(hashed.withColumn("whole", F.aggregate(
        "spots", F.lit(0).cast("bigint"), lambda a, x: a.bitwiseXOR(x))), "leaf-spots", dictionary=False)
    rare = (hashed.select("n", F.explode("spots").alias("spot")).groupBy("spot").agg(F.sum("n").alias("n"))
            .filter(F.col("n") < min_docs).select("spot"))
    # a rare spot has fewer than min_docs lines; no column beside the line's is shuffled
    tokens = hashed.select("leaf", "line", F.posexplode("spots").alias("at", "spot"))
    loose = tokens.join(rare, "spot").groupBy("line").agg(
        F.bit_xor(F.col("spot").bitwiseXOR(_any(F.col("at")))).alias("change"),
        F.collect_list("at").alias("open"))
    most = F.floor(F.size("spots") * F.lit(1 - similarity + 1e-9)).cast("int")
    own = hashed.join(loose, "line", "left").select(
        "leaf", "line", "n", "spots", most.alias("most"),
        F.coalesce("open", F.array().cast("array<int>")).alias("open"),
        F.col("whole").bitwiseXOR(F.coalesce("change", F.lit(0))).alias("tree"))
    own = stored(own.filter(F.size("open") <= F.col("most")), "leaf-patterns", dictionary=False)
    shared = own.groupBy("tree").agg(F.sum("n").alias("n"))
    enough = shared.filter(F.col("n") >= min_docs)
    settled = own.join(enough.select("tree"), "tree", "left_semi").select("line", "tree")
    left = own.join(enough.select("tree"), "tree", "left_anti")
    # one place more: every choice is a pattern, and also each line's own
    choices = left.filter(F.size("open") < F.col("most")).select(
        "leaf", "line", "n", "tree", "open", F.posexplode("spots").alias("at", "spot"))
    choices = stored(choices.filter(~F.array_contains("open", F.col("at"))).select(
        "line", "n", "at", F.col("tree").bitwiseXOR(F.col("spot")).bitwiseXOR(_any(F.col("at"))).alias("tree"))
        .unionByName(left.select("line", "n", F.lit(-1).alias("at"), "tree")), "leaf-choices", dictionary=False)
    agreed = (choices.select("tree", "n").unionByName(enough.select("tree", "n"))
              .groupBy("tree").agg(F.sum("n").alias("agree")).filter(F.col("agree") >= min_docs))
    best = choices.join(agreed, "tree").groupBy("line").agg(
        F.max(F.struct("agree", (-F.col("at")).alias("at"), "tree")).alias("best"))
    return settled.unionByName(best.select("line", F.col("best.tree").alias("tree")))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  depth: int = DEPTH, similarity: float = SIMILARITY,
                  min_docs: int = MIN_DOCS, long_words: int = LONG_WORDS) -> DataFrame:
    """(rk, drop): per row key the line numbers that go."""
    lines = stored(_lines(docs, id_col, text_col, depth, long_words), "lines", dictionary=False)
    own = line_templates(lines, docs, id_col, text_col, similarity, min_docs)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "rk", "line_no")
    marked = lines.join(own, "line", "left").withColumn("template", F.when(
        F.col("tree").isNotNull(), F.concat(F.lit("t"), F.col("tree").cast("string")).cast("binary")).otherwise(F.col("line"))).select("id", "rk", "line_no", "template")
    marked = stored(marked, "templates", dictionary=False)

    def later(rows: DataFrame, by: str, least: int) -> DataFrame:
        # most lines stand in one document only; what is counted by document is little
        several = (rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.min("rk").alias("lo"),
                                        F.max("rk").alias("hi"))
                   .filter((F.col("n") >= least) & (F.col("lo") != F.col("hi"))).select(by))
        rows = stored(rows.join(several, by, "left_semi"), "several", dictionary=False)
        recurring = (rows.groupBy(by, "rk").agg(F.min(place).alias("first"))
                     .groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first"))
                     .filter(F.col("n") >= least))
        return rows.join(recurring, by).filter(
            (F.col("rk") != F.col("first.rk")) | (F.col("line_no") != F.col("first.line_no"))
        ).select("rk", "line_no")

    # a template's first line is the first of its exact line too, so it stays
    exact = lines.filter("long").select("id", "rk", "line_no", F.coalesce("exact", "line").alias("exact"))
    gone = later(marked, "template", min_docs).union(later(exact, "exact", min(min_docs, 2)))
    return gone.groupBy("rk").agg(F.collect_set("line_no").alias("drop"))


def _cut(docs: DataFrame, id_col: str, text_col: str, key: str, **options) -> DataFrame:
    drops = dropped_lines(docs, id_col, text_col, **options).select(
        F.col("rk").alias(key), F.col("drop").alias(f"{key}_drop"))
    rows = docs.withColumn(key, row_key(id_col, text_col)).join(drops, key, "left")
    return rows.withColumn(f"{key}_all", F.split(F.col(text_col), "\n", -1))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """id, n_lines, n_dropped and the remaining text of every row."""
    prepare(docs.sparkSession)
    rows = _cut(docs.select(F.col(id_col), F.col(text_col)), id_col, text_col, "__rk", **options)
    return rows.select(
        F.col(id_col), F.coalesce(F.size("__rk_all"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("__rk_drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
        _rest("__rk", text_col).alias("text"))


def _rest(key: str, text_col: str) -> Column:
    everything = F.sequence(F.lit(0), F.size(f"{key}_all") - 1)
    stay = F.transform(F.array_except(everything, F.col(f"{key}_drop")),
                       lambda i: F.get(F.col(f"{key}_all"), i))
    return F.when(F.col(f"{key}_drop").isNull(), F.col(text_col)).otherwise(
        F.array_join(stay, "\n"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **options) -> DataFrame:
    """``docs`` with recurring lines cut from the text (n_chars follows)."""
    prepare(docs.sparkSession)
    key = free_prefix(docs, "__rk")
    rows = _cut(docs, id_col, text_col, key, **options).withColumn(text_col, _rest(key, text_col))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length(F.col(text_col)).cast("bigint"))
    return rows.select(*quoted(docs))
