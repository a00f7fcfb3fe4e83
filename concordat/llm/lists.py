"""Links within the lists of an inverted index: compared in numpy, block by block, never as a table of all pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

Kernel = Callable[[pd.DataFrame, "pd.DataFrame | None"], pd.DataFrame]


def star(size: int, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``size`` items over the given pairs of indices."""
    label = np.arange(size)
    while len(rows):
        low = np.minimum(label[rows], label[others])
        new = label.copy()
        np.minimum.at(new, rows, low)
        np.minimum.at(new, others, low)
        np.minimum.at(new, label[rows], low)
        np.minimum.at(new, label[others], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def link_lists(postings: DataFrame, key: str, kernel: Kernel, schema: str, block: int = 1024, many: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> DataFrame:
    """Rows that ``kernel(list, None)`` gives for every list (rows of equal ``key``) of two or more.

    The lists are streamed from one sorted shuffle. A list longer than ``block`` is not held: its rows come out again
    with the number of their block, and each two blocks then meet in a task of their own (``kernel(left, right)``,
    or ``kernel(block, None)`` for a block with itself). Memory is bounded by two blocks, and no rows are dropped.
    Where many lists are short, ``many`` saves calls: it is given whole lists together, sorted by key, four blocks or so.
    """
    out = T.StructType.fromDDL(schema)
    again = T.StructType([T.StructField(f"_{f.name}", f.dataType) for f in postings.schema] + [T.StructField("_block", T.IntegerType())])
    fields = T.StructType([T.StructField(f.name, f.dataType) for f in (*out, *again)])
    columns, names = postings.columns, fields.names

    def shaped(part: pd.DataFrame) -> pd.DataFrame:
        """All columns, null where ``part`` has none."""
        return part.assign(**{n: pd.Series([None] * len(part), index=part.index, dtype=object) for n in names if n not in part})[names]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the key that the next batch may go on with
        rows, last, spilt = 0, None, 0
        ready: list[pd.DataFrame] = []  # whole lists for ``many``
        waiting = 0

        def overflow(part: pd.DataFrame, start: int) -> pd.DataFrame:
            part = part.set_axis([f"_{c}" for c in columns], axis=1)
            return shaped(part.assign(_block=(start + np.arange(len(part))) // block))

        def end() -> Iterator[pd.DataFrame]:
            nonlocal waiting
            if spilt or rows < 2:
                return
            if many is None:
                yield shaped(kernel(pd.concat(held, ignore_index=True), None))
            else:
                ready.extend(held)
                waiting += rows
                if waiting >= 4 * block:
                    yield from flush()
                    waiting = 0

        def flush() -> Iterator[pd.DataFrame]:
            if ready:
                lists = pd.concat(ready, ignore_index=True)
                ready.clear()
                yield shaped(many(lists))

        for batch in batches:
            if not len(batch):
                continue
            keys = batch[key].to_numpy()
            edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, ends = np.r_[0, edges], np.r_[edges, len(keys)]
            for n in np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(keys))):
                part = batch.iloc[starts[n] : ends[n]]
                if last is None or keys[starts[n]] != last:
                    yield from end()
                    held, rows, last, spilt = [], 0, keys[starts[n]], 0
                held.append(part)
                rows += len(part)
                if rows > block:
                    for x in held:
                        yield overflow(x, spilt)
                        spilt += len(x)
                    held = []
        yield from end()
        yield from flush()

    found = postings.repartition(key).sortWithinPartitions(key).mapInPandas(walk, fields)
    found = stored(found)
    long = found.where("_block is not null").select(*(f"_{c}" for c in columns), "_block")
    sizes = long.groupBy(f"_{key}").agg((F.max("_block") + 1).alias("_blocks"))
    pairs = long.join(sizes, f"_{key}").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    pairs = pairs.withColumns({"_low": F.least("_block", "_other"), "_high": F.greatest("_block", "_other")})

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = rows["_low"].iloc[0], rows["_high"].iloc[0]
        sides = [rows[rows["_block"] == n][[f"_{c}" for c in columns]].set_axis(columns, axis=1).reset_index(drop=True) for n in (low, high)]
        return kernel(sides[0], None if low == high else sides[1])

    met = pairs.groupBy(f"_{key}", "_low", "_high").applyInPandas(meet, out)
    return found.where("_block is null").select(*out.names).union(met)
