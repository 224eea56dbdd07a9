"""Token-row layout and batches (LAY1-LAY13).

Rows stay rows: a batch is a ``batch_id`` column, and per-batch values
(longest row, order inside the batch) are windows partitioned by
``batch_id``, so each window group holds one batch.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.config import (
    CAUSAL_MAX_LENGTH, DEFAULT_SEED, IGNORE_INDEX, PREF_MAX_LENGTH,
    PREF_MAX_PROMPT_LENGTH, SEQ2SEQ_SOURCE_LENGTH, SEQ2SEQ_TARGET_LENGTH, TokenSpec)
from tunesmith.functions import arrays as A
from tunesmith.operators.filters import drop_blank
from tunesmith.operators.position import with_position
from tunesmith.operators.split import seeded_hash
from tunesmith.operators.vocab import Vocabulary, encode, word_arrays
from tunesmith.streaming.files import require_static

DEFAULT_SPEC = TokenSpec()


def _carry(df: DataFrame, key, *texts) -> list[str]:
    """Columns passed through encoding: everything but the key and the
    text columns, which are replaced by their ids (as a trainer's map with
    ``remove_columns`` does)."""
    key = [key] if isinstance(key, str) else list(key)
    return [c for c in df.columns if c not in key and c not in texts]


def _warn_pad_is_eos(spec: TokenSpec) -> None:
    if spec.pad is not None and spec.pad == spec.eos:
        warnings.warn("pad id equals eos id: masking pad labels also masks the real "
                      "end-of-sequence labels", stacklevel=3)


def seq2seq_train(df: DataFrame, key, vocab: Vocabulary, prompt="prompt",
                  response="response", prefix: str = "",
                  src: int = SEQ2SEQ_SOURCE_LENGTH, tgt: int = SEQ2SEQ_TARGET_LENGTH,
                  spec: TokenSpec = DEFAULT_SPEC) -> DataFrame:
    """LAY1: ``input_ids = a ‖ b ‖ eos``, ``labels = pad×|a| ‖ b ‖ eos``,
    both right-padded to ``src+tgt+1``; pad -> -100 in labels if enabled.
    ``a`` = prefix+prompt with special tokens (≤ src), ``b`` = answer
    without (≤ tgt).  Blank rows are dropped first.  The text columns are
    replaced by the id columns; other columns are carried through."""
    rows = drop_blank(df, (prompt, response))
    if prefix:
        rows = rows.withColumn(prompt, F.concat(F.lit(prefix), F.col(prompt)))
    enc = encode(rows, key, {"__a": (prompt, src, True),
                             "__b": (response, tgt, False)}, vocab,
                 bos=spec.bos, unk=spec.unk, keep_input=False, carry=_carry(rows, key, prompt, response))
    width = src + tgt + 1
    eos = F.array(F.lit(spec.eos))
    ids = F.concat("__a", "__b", eos)
    labels = F.concat(A.repeat(spec.pad, F.size("__a")), F.col("__b"), eos)
    ids = A.pad_to(ids, width, spec.pad)
    labels = A.pad_to(labels, width, spec.pad)
    if spec.ignore_pad_for_loss:
        _warn_pad_is_eos(spec)
        labels = A.mask_pad(labels, spec.pad)
    return (enc.withColumn("input_ids", ids).withColumn("labels", labels)
               .drop("__a", "__b"))


def seq2seq_eval(df: DataFrame, key, vocab: Vocabulary, batch="batch_id",
                 prompt="prompt", response="response", prefix: str = "",
                 src: int = SEQ2SEQ_SOURCE_LENGTH, tgt: int = SEQ2SEQ_TARGET_LENGTH,
                 spec: TokenSpec = DEFAULT_SPEC) -> DataFrame:
    """LAY2: inputs cut to ``src`` and padded to the longest row of their
    batch (with an attention mask); labels cut to ``tgt``, not padded."""
    rows = drop_blank(df, (prompt, response))
    if prefix:
        rows = rows.withColumn(prompt, F.concat(F.lit(prefix), F.col(prompt)))
    enc = encode(rows, key, {"__a": (prompt, src, True),
                             "__b": (response, tgt, True)}, vocab,
                 bos=spec.bos, unk=spec.unk, keep_input=False, carry=_carry(rows, key, prompt, response))
    longest = F.max(F.size("__a")).over(Window.partitionBy(batch))
    side = spec.padding_side
    labels = F.col("__b")
    if spec.ignore_pad_for_loss:
        labels = A.mask_pad(labels, spec.pad)
    return (enc.withColumn("__L", longest)
               .withColumn("input_ids", A.pad_to("__a", F.col("__L"), spec.pad, side))
               .withColumn("attention_mask",
                           A.pad_to(A.repeat(1, F.size("__a")), F.col("__L"), 0, side))
               .withColumn("labels", labels)
               .drop("__a", "__b", "__L"))


def causal_rows(df: DataFrame, key, vocab: Vocabulary, context="context",
                target="target", max_len: int = CAUSAL_MAX_LENGTH,
                spec: TokenSpec = DEFAULT_SPEC) -> DataFrame:
    """LAY3: ``input_ids = prompt ‖ target ‖ eos``, ``seq_len = |prompt|``;
    each side cut to ``max_len`` on its own."""
    enc = encode(df, key, {"__p": (context, max_len, True),
                           "__t": (target, max_len, False)}, vocab,
                 bos=spec.bos, unk=spec.unk, keep_input=False, carry=_carry(df, key, context, target))
    return (enc.withColumn("input_ids",
                           F.concat("__p", "__t", F.array(F.lit(spec.eos))))
               .withColumn("seq_len", F.size("__p"))
               .drop("__p", "__t"))


def collate(df: DataFrame, batch="batch_id", ids="input_ids", seq_len="seq_len",
            order="pos", spec: TokenSpec = DEFAULT_SPEC,
            with_mask: bool = False, gmask: bool = False) -> DataFrame:
    """LAY6: per batch, longest-first order (ties by ``order``),
    ``L = max(len) + 1``; inputs padded with eos to ``L``; labels
    ``-100×(seq_len-1) ‖ ids[seq_len-1:] ‖ eos ‖ -100×(L-len-1)``;
    2-D position ids; optional L×L prefix mask (quadratic, off by default)."""
    require_static(df, "collate")
    w = Window.partitionBy(batch)
    n = F.size(ids)
    s = F.col(seq_len)
    out = (df.withColumn("__L", F.max(n).over(w) + 1)
             .withColumn("row_in_batch", F.row_number().over(
                 Window.partitionBy(batch).orderBy(n.desc(), F.col(order).asc()))))
    L = F.col("__L")
    tail = F.slice(F.col(ids), s, F.greatest(n - s + 1, F.lit(0)))
    labels = F.concat(A.repeat(IGNORE_INDEX, s - 1), tail,
                      F.array(F.lit(spec.eos)), A.repeat(IGNORE_INDEX, L - n - 1))
    out = (out.withColumn("labels", labels)
              .withColumn("position_ids", A.position_ids(s, L, gmask=gmask))
              .withColumn(ids, A.pad_to(ids, L, spec.eos))
              .withColumn("longest", L))
    if with_mask:
        out = out.withColumn("attention_mask", A.prefix_mask(s, L))
    return out.drop("__L")


def length_grouped(df: DataFrame, key: str, n: int, length,
                   seed: int = DEFAULT_SEED, mega: int = 50) -> DataFrame:
    """LAY11: shuffle by seeded hash, cut into mega-batches of ``mega*n``
    rows, sort each by length (desc) and cut it into batches of ``n``.
    Each window group is one mega-batch, a bounded size."""
    shuffled = with_position(df.withColumn("__h", seeded_hash(key, seed)),
                             [F.col("__h").asc(), F.col(key).asc()], name="__sp")
    ln = F.col(length) if isinstance(length, str) else length
    w = Window.partitionBy("mega_batch").orderBy(ln.desc(), F.col("__sp").asc())
    return (shuffled
            .withColumn("mega_batch", F.floor(F.col("__sp") / (mega * n)).cast("bigint"))
            .withColumn("__rn", F.row_number().over(w))
            .withColumn("batch", F.floor((F.col("__rn") - 1) / n).cast("bigint"))
            .drop("__h", "__rn", "__sp"))


def limit_pair(df: DataFrame, prompt="prompt_ids", chosen="chosen_ids",
               rejected="rejected_ids", max_length: int = PREF_MAX_LENGTH,
               max_prompt_length: int = PREF_MAX_PROMPT_LENGTH,
               max_target_length: int | None = None) -> DataFrame:
    """LAY12: both answers are cut to ``max_target_length``; if prompt + longer
    answer then exceeds ``max_length`` keep the last ``max_prompt_length`` prompt
    elements; if still over, cut both answers to ``max_length -
    max_prompt_length``.  ``truncated`` marks rows over ``max_length``.  The columns are
    arrays of ids, or of words before any id is looked up (:func:`pair_rows`)."""
    out = df
    if max_target_length is not None:
        out = out.withColumns({c: A.truncate(c, max_target_length) for c in (chosen, rejected)})
    over = F.size(prompt) + F.greatest(F.size(chosen), F.size(rejected)) > max_length
    out = out.withColumn("__over", over)
    p2 = F.when(F.col("__over"), A.keep_last(prompt, max_prompt_length)).otherwise(F.col(prompt))
    out = out.withColumn(prompt, p2)
    still = F.size(prompt) + F.greatest(F.size(chosen), F.size(rejected)) > max_length
    keep = max_length - max_prompt_length
    return (out.withColumn("__still", still)
               .withColumn(chosen, F.when(F.col("__still"), A.truncate(chosen, keep))
                           .otherwise(F.col(chosen)))
               .withColumn(rejected, F.when(F.col("__still"), A.truncate(rejected, keep))
                           .otherwise(F.col(rejected)))
               .withColumnRenamed("__over", "truncated")
               .drop("__still"))


#: stands for the leading special id among words, none of which has a space
_BOS_WORD = "<s> "


def pair_rows(df: DataFrame, key, vocab: Vocabulary, prompt="prompt", chosen="chosen",
              rejected="rejected", max_length: int = PREF_MAX_LENGTH,
              max_prompt_length: int = PREF_MAX_PROMPT_LENGTH,
              max_target_length: int | None = None, spec: TokenSpec = DEFAULT_SPEC) -> DataFrame:
    """Preference pairs as ``prompt_ids`` (bos first), ``chosen_ids`` and
    ``rejected_ids`` within the limits of LAY12, and ``truncated``.  Lengths and cuts are
    those of the words, so only words that stay are looked up.  The texts are
    replaced; other columns are carried."""
    named = {"prompt_ids": prompt, "chosen_ids": chosen, "rejected_ids": rejected}
    rows = word_arrays(df, named)
    none = F.array().cast("array<string>")
    rows = rows.withColumns({c: F.coalesce(c, none) for c in named})
    rows = rows.withColumn("prompt_ids", F.concat(F.array(F.lit(_BOS_WORD)), "prompt_ids"))
    rows = limit_pair(rows, *named, max_length, max_prompt_length, max_target_length)
    led = F.coalesce(F.get("prompt_ids", 0) == _BOS_WORD, F.lit(False))
    rows = rows.withColumn("__led", led).withColumn("prompt_ids", F.filter(
        "prompt_ids", lambda w: w != _BOS_WORD)).drop(prompt, chosen, rejected)
    carried = [c for c in rows.columns if c not in named and c not in ([key] if isinstance(key, str) else key)]
    ids = encode(rows, key, {c: (c, None, False) for c in named}, vocab, unk=spec.unk, carry=carried)
    return ids.withColumn("prompt_ids", F.when(F.col("__led"), F.concat(
        F.array(F.lit(spec.bos)), "prompt_ids")).otherwise(F.col("prompt_ids"))).drop("__led")


def truncated_share(pairs: DataFrame, by=None) -> DataFrame:
    """Rows, truncated rows and their share."""
    n, cut = F.count(F.lit(1)), F.sum(F.col("truncated").cast("bigint"))
    return pairs.groupBy(*([by] if isinstance(by, str) else by or [])).agg(
        n.alias("n_rows"), cut.alias("n_truncated"), (cut / n).alias("truncated_share"))


def completion_only(df: DataFrame, ids="input_ids", marker_ids=(),
                    out: str = "labels") -> DataFrame:
    """LAY5: labels = ids with everything up to the end of the *last*
    response marker set to -100; no marker -> all -100."""
    marker = F.array(*[F.lit(int(i)) for i in marker_ids]).cast("array<int>")
    end = A.last_subarray_end(ids, marker)
    keep = F.transform(F.col(ids), lambda x, i: F.when(i < F.col("__end"), F.lit(IGNORE_INDEX))
                       .otherwise(x))
    return (df.withColumn("__end", end)
              .withColumn(out, F.when(F.col("__end") > 0, keep)
                          .otherwise(F.transform(F.col(ids), lambda x: F.lit(IGNORE_INDEX))))
              .drop("__end"))


def pad_generated(df: DataFrame, ids="generated_ids", max_length: int | None = None,
                  max_new_tokens: int | None = None,
                  spec: TokenSpec = DEFAULT_SPEC) -> DataFrame:
    """LAY9: right-pad id arrays (generated tokens or labels) to the limit
    ``max_length``, else ``max_new_tokens + 1``, with pad, else eos (error
    when neither exists).  Longer arrays are left unchanged."""
    if max_length is None and max_new_tokens is None:
        raise ValueError("need max_length or max_new_tokens")
    limit = max_length if max_length is not None else max_new_tokens + 1
    return df.withColumn(ids, A.pad_to(ids, limit, spec.pad_or_eos()))


def limit_text(df: DataFrame, ids="input_ids", n: int = 1024) -> DataFrame:
    """LAY13: cut a single array to ``n``: ids, or words before they are looked
    up."""
    return df.withColumn(ids, A.truncate(ids, n))
