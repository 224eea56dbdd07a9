"""Corpus vocabulary, encoding and decoding (TOK1-TOK3) as corpus jobs.

The reference loads pretrained tokenizers; here the vocabulary is built from
the data: whitespace words counted over the whole corpus, ids by
(count desc, token asc) after four reserved ids.

Encoding and decoding look the elements of whole arrays up by the distinct
elements of each batch of rows (:mod:`tunesmith.operators.lookup`), so a frequent
word is one entry for each batch, no row per token is shuffled and rows keep
their identity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.config import BOS_ID, EOS_ID, FIRST_WORD_ID, PAD_ID, UNK_ID
from tunesmith.functions.text import words
from tunesmith.operators.lookup import resolve
from tunesmith.operators.position import with_position
from tunesmith.streaming.files import require_static

# Printable names of the reserved ids.
SPECIAL_TOKENS = {PAD_ID: "<pad>", EOS_ID: "</s>", BOS_ID: "<s>", UNK_ID: "<unk>"}


@dataclass
class Vocabulary:
    """``table``: token string, count bigint, id int, read from the written
    position table (or a saved vocabulary)."""

    table: DataFrame

    def save(self, path: str, mode: str = "overwrite") -> None:
        """Write the vocabulary (token, count, id) as a parquet table, so
        later jobs reuse it instead of recounting the corpus."""
        self.table.write.mode(mode).parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "Vocabulary":
        """Read a vocabulary written by :meth:`save`."""
        return cls(spark.read.schema("token string, count bigint, id int").parquet(path))


def build_vocab(df: DataFrame, text: str = "text", min_count: int = 1,
                max_size: int | None = None) -> Vocabulary:
    """TOK1: word counts over the whole corpus and ids by rank.

    Counting is a partial + final hash aggregate (a frequent word is reduced
    map-side); ranking uses range-partitioned positions, not one task.
    """
    require_static(df, "build_vocab")
    counts = (df.select(F.explode(words(text)).alias("token")).groupBy("token")
                .agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    if min_count > 1:
        counts = counts.filter(F.col("count") >= min_count)
    ranked = with_position(counts, [F.col("count").desc(), F.col("token").asc()],
                           name="rank")
    if max_size is not None:
        ranked = ranked.filter(F.col("rank") < max_size)
    table = ranked.select("token", "count",
                          (F.col("rank") + FIRST_WORD_ID).cast("int").alias("id"))
    return Vocabulary(table)


def encode(df: DataFrame, key, columns: dict, vocab: Vocabulary,
           bos: int = BOS_ID, unk: int = UNK_ID, keep_input: bool = True,
           carry=()) -> DataFrame:
    """TOK2: word ids for one or more text columns in one pass.

    ``columns``: ``out_name -> (text_col, max_length or None, add_special)``.
    With ``add_special`` one ``bos`` id leads and counts in ``max_length``.
    Words are cut to ``max_length`` before anything is looked up, so a very long
    text costs only what is kept.  A null text has no words.  ``text_col`` may
    also be a column of word arrays (see :func:`word_arrays`).

    The output has every input column and the ids; without ``keep_input`` (or
    with ``carry``) only ``key``, the carried columns and the ids.  Rows are
    rebuilt where they stand, so ``key`` need not be unique.
    """
    key = [key] if isinstance(key, str) else list(key)
    kept = df.columns if keep_input and not carry else [*key, *[c for c in carry if c not in key]]
    arrays = []
    for name, (src, max_len, special) in columns.items():
        held = df.schema[src].dataType.simpleString() == "array<string>"
        toks = F.col(src) if held else words(src)
        if max_len is not None:
            toks = F.slice(toks, 1, max(max_len - (1 if special else 0), 0))
        arrays.append(F.coalesce(toks, F.array().cast("array<string>")).alias(name))
    rows = df.select(*[c for c in kept if c not in columns], *arrays)
    found = resolve(rows, list(columns), vocab.table, "token", "id")
    for name, (_src, _max, special) in columns.items():
        ids = F.transform(name, lambda x: F.coalesce(x, F.lit(unk)))
        found = found.withColumn(name, F.concat(F.array(F.lit(bos)), ids) if special else ids)
    return found


def word_arrays(df: DataFrame, columns: dict) -> DataFrame:
    """``df`` with a column of words for each ``out -> text column``: lengths and
    cuts can be decided on them before any id is looked up."""
    return df.withColumns({out: words(src) for out, src in columns.items()})


def decode(df: DataFrame, key, ids, vocab: Vocabulary,
           skip_special: bool = True, out: str = "decoded",
           keep_input: bool = True) -> DataFrame:
    """TOK3: ids back to space-joined words; special ids are skipped (or
    printed by name), negative ids (label sentinels) are always skipped.

    ``ids`` is one id column (output ``out``) or a dict ``out -> id column``
    to decode several columns in one pass.  Ids that are skipped are filtered
    out of the arrays before anything is looked up."""
    key = [key] if isinstance(key, str) else list(key)
    cols = dict(ids) if isinstance(ids, dict) else {out: ids}
    least = FIRST_WORD_ID if skip_special else 0
    arrays = [F.filter(F.coalesce(F.col(c), F.array().cast("array<int>")).cast("array<bigint>"),
                       lambda x: x >= least).alias(name) for name, c in cols.items()]
    rows = df.select(*[c for c in (df.columns if keep_input else key) if c not in cols], *arrays)
    table = vocab.table.select(F.col("id").cast("bigint").alias("id"), "token")
    if not skip_special:
        named = F.explode(F.create_map(*[x for k, v in SPECIAL_TOKENS.items()
                                         for x in (F.lit(k).cast("bigint"), F.lit(v))]))
        table = table.union(df.sparkSession.range(1).select(named.alias("id", "token")))
    found = resolve(rows, list(cols), table, "id", "token")
    # unknown ids resolve to null, which a join of words leaves out
    return found.withColumns({name: F.array_join(name, " ") for name in cols})


def preview(df: DataFrame, key, vocab: Vocabulary, ids: str = "input_ids",
            labels: str | None = "labels", pad: int = PAD_ID) -> DataFrame:
    """POS6: ids, decoded inputs and decoded labels (-100 read as pad, special
    ids skipped) of the rows of ``df`` -- apply to ``row_at(df, 0)``."""
    from tunesmith.functions.arrays import unmask

    if not labels:
        return decode(df, key, ids, vocab, out="inputs")
    out = decode(df.withColumn("__lab", unmask(labels, pad)), key,
                 {"inputs": ids, "label_text": "__lab"}, vocab)
    return out.drop("__lab")


def ids_of(vocab: Vocabulary, text: str, unk: int = UNK_ID) -> list[int]:
    """Ids of a short constant text (e.g. a response marker), fetched to the
    driver so they can be used as a literal; only its few words travel."""
    spark = vocab.table.sparkSession
    toks = spark.createDataFrame([(text,)], "m string").select(
        F.posexplode(words("m")).alias("p", "token"))
    got = (toks.join(vocab.table, "token", "left").orderBy("p")
               .select(F.coalesce("id", F.lit(unk)).alias("id")).collect())
    return [int(r["id"]) for r in got]
