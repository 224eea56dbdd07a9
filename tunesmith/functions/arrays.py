"""Column builders over token-id arrays: padding, masks, positions, lookups.

All of these are built-in higher-order functions, so they run inside the
JVM per row and need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunesmith.config import IGNORE_INDEX


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _n(x) -> Column:
    """Column as is, a name as a column, anything else as a literal."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def empty_ints() -> Column:
    return F.array().cast("array<int>")


def ids_text(ids) -> Column:
    """Comma-joined ids: a printable form that compares equal across engines."""
    return F.array_join(_c(ids), ",")


def repeat(value, times) -> Column:
    return F.array_repeat(_n(value), F.greatest(_n(times), F.lit(0)))


def pad_to(ids, length, pad, side: str = "right") -> Column:
    """Pad an id array to ``length`` (longer arrays are left as they are)."""
    arr = _c(ids)
    fill = repeat(pad, _n(length) - F.size(arr))
    return F.concat(arr, fill) if side == "right" else F.concat(fill, arr)


def truncate(ids, n) -> Column:
    return F.slice(_c(ids), 1, _n(n))


def keep_last(ids, n) -> Column:
    """Last ``n`` ids of an array (all of them when shorter)."""
    arr = _c(ids)
    return F.slice(arr, F.greatest(F.size(arr) - _n(n) + 1, F.lit(1)), _n(n))


def mask_pad(labels, pad) -> Column:
    """pad -> -100 (ignored by the loss)."""
    return F.transform(_c(labels),
                       lambda x: F.when(x == _n(pad), F.lit(IGNORE_INDEX))
                       .otherwise(x))


def unmask(labels, pad) -> Column:
    """-100 -> pad, so label arrays can be decoded."""
    return F.transform(_c(labels),
                       lambda x: F.when(x == F.lit(IGNORE_INDEX), _n(pad))
                       .otherwise(x))


def strip_prompt(ids, prompt_ids) -> Column:
    """Ids after the prompt length (generation output without the prompt)."""
    arr, p = _c(ids), _c(prompt_ids)
    return F.slice(arr, F.size(p) + 1,
                   F.greatest(F.size(arr) - F.size(p), F.lit(0)))


def _range(n) -> Column:
    """0 .. n-1, empty when n <= 0 (``sequence`` would count down)."""
    n = _n(n)
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(empty_ints())


def position_ids(seq_len, length, gmask: bool = False,
                 two_d: bool = True) -> Column:
    """Position ids for a prefix-LM row of width ``length``.

    2-D: row 0 is ``i`` before the prompt end and ``seq_len-2`` after it
    (``i`` throughout with gmask); row 1 is 0 before and ``i-seq_len+2``
    after.  1-D: ``i`` with the last slot set to ``seq_len-2``.
    """
    s, n = _n(seq_len), _n(length)
    idx = _range(n)
    if two_d:
        row0 = idx if gmask else F.transform(
            idx, lambda i: F.when(i >= s - 1, s - 2).otherwise(i))
        row1 = F.transform(idx, lambda i: F.when(i >= s - 1, i - s + 2)
                           .otherwise(F.lit(0)))
        return F.array(row0, row1)
    if gmask:
        return idx
    return F.transform(idx, lambda i: F.when(i == n - 1, s - 2).otherwise(i))


def prefix_mask_bound(seq_len, length) -> Column:
    """First column that stays hidden above the diagonal."""
    s, n = _n(seq_len), _n(length)
    return F.when(s >= 3, s - 3).otherwise(F.greatest(n + s - 3, F.lit(0)))


def prefix_mask(seq_len, length) -> Column:
    """Boolean L x L mask, true = hidden: ``j > i AND j >= bound``."""
    n = _n(length)
    bound = prefix_mask_bound(seq_len, n)
    idx = _range(n)
    return F.transform(idx, lambda i: F.transform(
        idx, lambda j: (j > i) & (j >= bound)))


def hidden_cells(seq_len, length) -> Column:
    """Number of true cells of :func:`prefix_mask` without building it."""
    n = _n(length)
    b = prefix_mask_bound(seq_len, n)
    # row i hides columns j in [max(i+1, b), n)
    return F.aggregate(_range(n), F.lit(0).cast("bigint"),
                       lambda acc, i: acc + F.greatest(
                           n - F.greatest(i + 1, b), F.lit(0)))


def last_subarray_end(ids, marker) -> Column:
    """1-based position of the last id of the last ``marker`` occurrence
    in ``ids``; 0 when it does not occur."""
    arr, m = _c(ids), _c(marker)
    k = F.size(m)
    starts = F.when((F.size(arr) >= k) & (k > 0),
                    F.sequence(F.lit(1), F.size(arr) - k + 1)
                    ).otherwise(empty_ints())
    hits = F.filter(starts, lambda p: F.slice(arr, p, k) == m)
    last = F.try_element_at(hits, F.lit(-1))
    return F.coalesce(last + k - 1, F.lit(0))


def continuation(ids, max_ngram: int = 3, num_pred: int = 10, size: Column | None = None,
                 suffixes: dict | None = None) -> Column:
    """Prompt-lookup candidate: for n = max_ngram..1 match the last n ids
    against earlier windows; the first window at p (0-based) with
    ``p+n+k <= L`` and ``p+n < L-n`` yields ids ``[p+n, p+n+k)``.
    Empty when nothing matches.

    ``size`` and ``suffixes`` (n -> last n ids) are columns that hold these; an
    expression in a lambda would be evaluated for every window."""
    a = _c(ids)
    size = F.size(a) if size is None else size
    found = []
    for n in range(max_ngram, 0, -1):
        last = suffixes[n] if suffixes else F.when(size >= n, F.slice(a, size - n + 1, n))
        starts = F.when(size >= n + num_pred,
                        F.sequence(F.lit(0), size - n - num_pred)
                        ).otherwise(empty_ints())
        hits = F.filter(starts, _window_match(a, size, n, last))
        p = F.get(hits, 0)
        found.append(F.slice(a, p + n + 1, num_pred))
    return F.coalesce(*found, empty_ints())


def _window_match(a: Column, size: Column, n: int, last: Column):
    def match(p):
        return (p + n < size - n) & (F.slice(a, p + 1, n) == last)
    return match


def accepted_prefix(candidate, truth, cap) -> Column:
    """Leading candidate ids equal to the truth, capped at ``cap``."""
    c, g = _c(candidate), _c(truth)
    same = F.zip_with(c, g, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first_bad = F.nullif(F.array_position(same, False), F.lit(0)) - 1
    agreed = F.coalesce(first_bad, F.least(F.size(c), F.size(g)))
    return F.least(_n(cap), agreed)
