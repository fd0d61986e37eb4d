"""Keys of a table by refutation.

Two rows that agree on a set of columns refute every key within that set.  So a
bounded choice of rows is compared first: rows chosen by the hash of the whole
row, and for every column of many values all rows of a few hash-chosen values,
which agree in it.  What the agreements leave open is searched level by level:
only such sets are counted over all rows, by their 64-bit hashes, and one that
fails brings two rows that agree on it, which refute further sets.

The answer is exact and complete up to the greatest width: a set is dropped
only for two rows that agree on it, and kept only when all rows differ in it.
Estimates choose the rows that are compared, nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.names import q
from tessera.operators.duplicates import as_text, narrow, normalised, stackable

#: Rows by the hash of the whole row, rows by the hash of one column's value, and cells of those together.
WHOLE_ROWS, VALUE_ROWS, CELLS = 1000, 400, 400_000
_SEEDS = (3, 5, 7)
#: About so many sets of columns are kept to refute with.
KEPT = 1200


def _maximal(masks: set[int]) -> list[int]:
    out: list[int] = []
    for mask in sorted(masks, key=int.bit_count, reverse=True):
        if not any(mask & other == mask for other in out):
            out.append(mask)
    return out


def _largest(masks: set[int], columns: int) -> set[int]:
    """The largest sets that hold each column: enough to refute, and few."""
    ordered = sorted(masks, key=int.bit_count, reverse=True)
    each = max(8, KEPT // columns)
    return {m for i in range(columns) for m in [x for x in ordered if x >> i & 1][:each]}


def agreements(rows: list[tuple]) -> list[int]:
    """Maximal sets of columns (bit i: column i) on which two of ``rows`` agree; NULL agrees with NULL."""
    if len(rows) < 2:
        return []
    codes = np.stack([np.unique([("" if v is None else "=" + v) for v in column], return_inverse=True)[1] for column in zip(*rows, strict=True)], axis=1)
    found: set[bytes] = set()
    for i in range(len(codes) - 1):
        packed = np.unique(np.packbits(codes[i + 1:] == codes[i], axis=1, bitorder="little"), axis=0)
        found.update(row.tobytes() for row in packed)
    return _maximal(_largest({int.from_bytes(x, "little") for x in found}, codes.shape[1]))


def unrefuted(columns: int, width: int, refuted: list[int], keys: list[int]) -> Iterator[int]:
    """Sets of ``width`` columns that lie in no refuted set and hold no key."""
    full = (1 << columns) - 1
    seen: set[int] = set()
    open_ = [0]
    while open_:
        chosen = open_.pop()
        if chosen in seen or any(chosen & k == k for k in keys):
            continue
        seen.add(chosen)
        inside = [~mask & full for mask in refuted if chosen & mask == chosen]
        if chosen.bit_count() == width:
            if not inside:
                yield chosen
            continue
        # one of the columns outside a refuted set must come in; without one, any column
        outside = min(inside, key=int.bit_count, default=full & ~chosen)
        open_ += [chosen | 1 << i for i in range(columns) if outside >> i & 1]


def _texts(rows: DataFrame) -> list[Column]:
    return [as_text(F.col(f.name), f.dataType) for f in rows.schema.fields]


def _collected(rows: DataFrame) -> list[tuple]:
    """``rows`` as text, equal exactly where values are."""
    return [tuple(r) for r in rows.select(*_texts(rows)).collect()]


def _hash_of(rows: DataFrame, chosen: int) -> Column:
    # isNull tells NULL from what it would hash like
    return F.xxhash64(*[x for i, c in enumerate(rows.columns) if chosen >> i & 1 for x in (F.col(c), F.col(c).isNull())])


def _chosen_rows(rows: DataFrame, n: int) -> list[tuple]:
    """The rows that are compared: a bounded number, whatever the values."""
    names = rows.columns
    distinct = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    wide = [c for c in names if distinct[c] * 50 >= n]
    per_value = max(4, min(VALUE_ROWS, CELLS // (len(names) * max(1, len(wide)))))
    whole = F.pmod(F.xxhash64(*names), F.lit(max(1, n // WHOLE_ROWS))) == 0
    picks = {(c, s): F.pmod(F.xxhash64(c, F.lit(s)), F.lit(max(1, n // per_value))) == 0 for c in wide for s in _SEEDS}
    counts = rows.agg(F.count_if(whole).alias("whole"), *[F.count_if(p).alias(f"p{i}") for i, p in enumerate(picks.values())]).first()
    # a hot value is left out by another seed, or the column by all of them
    use = {}
    for i, (c, s) in enumerate(picks):
        if 2 <= counts[f"p{i}"] <= 4 * per_value and counts[f"p{i}"] > use.get(c, (0, 0))[0]:
            use[c] = (counts[f"p{i}"], s)
    either = whole if counts["whole"] <= 4 * WHOLE_ROWS else F.lit(False)
    for c, (_, s) in use.items():
        either = either | picks[c, s]
    return _collected(rows.filter(either).limit(5 * WHOLE_ROWS))


def _counterexample(rows: DataFrame, chosen: int) -> list[int]:
    """Agreements of rows that agree on the ``chosen`` columns; empty if all rows differ in them."""
    names = [c for i, c in enumerate(rows.columns) if chosen >> i & 1]
    h = _hash_of(rows, chosen)
    again = rows.select(h.alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(3).collect()
    if not again:
        return []
    met = _collected(rows.filter(h.isin([r["h"] for r in again])).limit(60))
    found = [mask for mask in agreements(met) if mask & chosen == chosen]
    if not found and not rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return [chosen]  # the hashes met by chance, the rows elsewhere do agree
    return found


def minimal_keys(df: DataFrame, max_width: int = 3, max_parallel: int = 4) -> list[list[str]]:
    """All minimal keys of up to ``max_width`` columns (nested columns are left out)."""
    fields = [f for f in df.schema.fields if stackable(f.dataType)]
    typed = [(normalised if narrow(f.dataType) else as_text)(F.col(q(f.name)), f.dataType) for f in fields]
    rows = df.select(*[c.alias(f"c{i}") for i, c in enumerate(typed)])
    n = df.count()
    if not n or not fields:
        return []
    refuted = agreements(_chosen_rows(rows, n)) if n > 1 else []
    keys: list[int] = []
    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        for width in range(1, max_width + 1):
            while True:
                batch = list(islice(unrefuted(len(fields), width, refuted, keys), max_parallel))
                if not batch:
                    break
                for chosen, found in zip(batch, pool.map(lambda c: _counterexample(rows, c), batch), strict=True):
                    if found:
                        refuted = _maximal({*refuted, *found})
                    else:
                        keys.append(chosen)
    found = sorted([i for i in range(len(fields)) if k >> i & 1] for k in keys)
    return [[fields[i].name for i in k] for k in sorted(found, key=len)]
