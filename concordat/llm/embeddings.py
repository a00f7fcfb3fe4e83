"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .graph import connected_components
from .lists import link_lists, star


def hadamard(x: np.ndarray) -> np.ndarray:
    """Hadamard transform of every row, whose length is a power of two: factors of at most 64, each a matrix product."""
    shape, step = x.shape, 1
    while step < shape[1]:
        radix = min(64, shape[1] // step)
        signs = np.bitwise_count(np.arange(radix)[:, None] & np.arange(radix)) % 2
        factor = 1.0 - 2.0 * signs
        x = x.reshape(-1, radix) @ factor if step == 1 else factor @ x.reshape(-1, radix, step)
        step *= radix
    return x.reshape(shape)


def polytope_keys(unit: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """(vectors, tables, probes) bucket keys of unit vectors, all different in a row.

    A hash rotates at random (three times random signs, then a Hadamard transform) and takes the vertex of the cross-
    polytope nearest to the result: its largest coordinate with its sign. A table joins ``hashes`` of them. The further
    probes replace one hash by its second vertex, those first that lose least.
    """
    count, width = unit.shape
    size = 1 << max(1, (width - 1).bit_length())
    signs = np.random.default_rng(seed + width).choice([-1.0, 1.0], (tables, hashes, 3, size))
    keys, row = np.empty((count, tables, probes), "int64"), np.arange(count)
    for t in range(tables):
        first, second, loss = (np.empty((count, hashes), kind) for kind in ("int64", "int64", "float64"))
        for k in range(hashes):
            x = np.zeros((count, size))
            x[:, :width] = unit
            for turn in signs[t, k]:
                x = hadamard(x * turn)
            high = np.abs(x)
            best = high.argmax(1)
            top = high[row, best]
            high[row, best] = -1
            next_best = high.argmax(1)
            first[:, k] = 2 * best + (x[row, best] < 0)
            second[:, k] = 2 * next_best + (x[row, next_best] < 0)
            loss[:, k] = (top - high[row, next_best]) / np.maximum(top, 1e-300)
        order = loss.argsort(1, kind="stable")
        for p in range(probes):
            chosen = first.copy()
            if p:
                at = order[:, p - 1]
                chosen[row, at] = second[row, at]
            key = np.full(count, t + 1, "int64")
            for k in range(hashes):
                key = key * (2 * size + 1) + chosen[:, k]
            keys[:, t, p] = key
    return keys


def cosine_links(
    vectors: DataFrame, threshold: float = 0.95, tables: int = 6, hashes: int = 3, probes: int = 4, seed: int = 7, block: int = 1024
) -> DataFrame:
    """Links of distinct vectors (id, vector, copies) with distinct ids: rows (a, b, n) in which n counts links of a, and a and b connect.

    Every vector goes into ``tables * probes`` buckets, and each two in a bucket are verified in double precision.
    Buckets are first sorted as keys and ids alone, and those of one vector dropped; only the others meet the vectors.
    A pair that meets in several buckets counts in that of its smallest common key alone, so a bucket gives sums and a
    star for each vector, never its pairs. Vectors of unequal width never link. At most ``hashes + 1`` probes.
    """
    if not 1 <= probes <= hashes + 1:
        raise ValueError("probes must be from 1 to hashes + 1")

    def units(column: pd.Series) -> np.ndarray:
        x = np.stack([np.asarray(v, "float64") for v in column])
        x /= np.abs(x).max(1, keepdims=True)
        return x / np.sqrt((x * x).sum(1, keepdims=True))

    def keys_of(unit: np.ndarray) -> np.ndarray:
        parts = [polytope_keys(unit[s : s + 512], tables, hashes, probes, seed) for s in range(0, len(unit), 512)]
        return np.concatenate(parts)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["vector"].map(len)):
                keys = keys_of(units(part["vector"])).reshape(len(part), -1)
                yield pd.DataFrame({"key": keys.ravel(), "id": part["id"].to_numpy().repeat(keys.shape[1])})

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of sorted batches whose key has another row; one row is held back until the next is seen."""
        held, twin = None, False
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            keys = rows["key"].to_numpy()
            same = keys[1:] == keys[:-1]
            keep = np.r_[twin and held is not None, same] | np.r_[same, False]
            held, twin = rows.iloc[-1:], bool(keep[-1])
            yield rows.iloc[:-1][keep[:-1]]
        if held is not None and twin:
            yield held

    def near(unit: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs i < j of equal keys (sorted) with enough cosine: short lists of one length together."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        found = [(np.zeros(0, "int64"), np.zeros(0, "int64"))]
        for size in np.unique(sizes[sizes > 1]):
            i, j = np.triu_indices(size, 1)
            firsts = starts[sizes == size]
            step = max(1, 65536 // len(i))
            for s in range(0, len(firsts), step):
                if size > 32:
                    one, two = [], []
                    for first in firsts[s : s + step]:
                        some = unit[first : first + size]
                        x, y = np.nonzero(np.triu(some @ some.T >= threshold, 1))
                        one.append(x + first)
                        two.append(y + first)
                    found.append((np.concatenate(one), np.concatenate(two)))
                else:
                    one, two = ((firsts[s : s + step, None] + n).ravel() for n in (i, j))
                    close = np.einsum("ij,ij->i", unit[one], unit[two]) >= threshold
                    found.append((one[close], two[close]))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def linked(every: pd.DataFrame, left: int | None = None) -> pd.DataFrame:
        """Links within lists sorted by key, or between the first ``left`` rows of one list and the rest."""
        ids, copies, gained = every["id"].to_numpy(), every["copies"].to_numpy(), np.zeros(len(every), "int64")
        rows, others, lengths = [np.zeros(0, "int64")], [np.zeros(0, "int64")], every["vector"].map(len).to_numpy()
        for width in np.unique(lengths):
            at = np.flatnonzero(lengths == width)
            unit, key = units(every["vector"].iloc[at]), every["key"].to_numpy()[at]
            if left is None:
                i, j = near(unit, key)
            else:
                side = int((at < left).sum())
                i, j = np.nonzero(unit[:side] @ unit[side:].T >= threshold)
                j = j + side
            if not len(i):
                continue
            used, places = np.unique(np.r_[i, j], return_inverse=True)
            keys, places = keys_of(unit[used]), places.reshape(2, -1)
            for s in range(0, len(i), 16384):
                some = slice(s, s + 16384)
                one, two = keys[places[0, some]], keys[places[1, some]]
                common = (one[:, :, :, None] == two[:, :, None, :]).any(3)
                here = np.where(common, one, np.iinfo("int64").max).min((1, 2)) == key[i[some]]
                np.add.at(gained, at[i[some][here]], copies[at[j[some][here]]])
                np.add.at(gained, at[j[some][here]], copies[at[i[some][here]]])
            rows.append(at[i])
            others.append(at[j])
        root = star(len(every), np.concatenate(rows), np.concatenate(others))
        kept = np.flatnonzero((root != np.arange(len(every))) | (gained > 0))
        return pd.DataFrame({"a": ids[kept], "b": ids[root[kept]], "n": gained[kept]})

    def kernel(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
        return linked(left) if right is None else linked(pd.concat([left, right], ignore_index=True), len(left))

    keyed = vectors.select("id", "vector").mapInPandas(spread, "key long, id long")
    places = stored(keyed.repartition("key").sortWithinPartitions("key").mapInPandas(shared, "key long, id long"))
    postings = places.join(vectors.select("id", "vector", "copies"), "id").select("key", "id", "vector", "copies")
    return link_lists(postings, "key", kernel, "a long, b long, n long", block, many=linked)


def embedding_components(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", **options) -> DataFrame:
    """(id, n_links, component_id, kept) of every row: links at cosine ``threshold`` or more among all rows.

    Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing. Equal vectors are brought
    together first and count as links of each other. Repeated rows are vectors of their own, and so are different vectors
    of one id and vectors without an id; a component's id is the smallest there is in it, null if there is none. Vectors
    of different length never link. Other columns are ignored.
    """
    vector = F.col(vector_column).cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = df.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"), F.coalesce(usable, F.lit(False)).alias("usable")
    )
    keyed = rows.withColumns({"h": F.xxhash64("vector"), "g": F.hash("vector")})
    equal = keyed.where("usable").groupBy("h", "g").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    # a class of equal vectors has a number of its own: ids may be null or stand for several vectors
    classes = stored(equal.withColumn("id", F.monotonically_increasing_id()))
    links = stored(cosine_links(classes, **options))
    gained = links.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    roots = connected_components(links.where("a <> b"))
    joined = stored(
        classes.select("h", "g", "id", "least", "copies")
        .join(gained, "id", "left")
        .join(roots, F.col("id") == F.col("node"), "left")
        .select("h", "g", "least", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("root"))
    )
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    marks = joined.drop("least").join(smallest, "root").select("h", "g", "n_links", "component_id")
    linked = keyed.where("usable").select("id", "h", "g").join(marks, ["h", "g"]).select("id", "n_links", "component_id")
    alone = keyed.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    done = linked.union(alone)
    return done.select(F.col("id").alias(id_column), "n_links", "component_id", (F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"))
