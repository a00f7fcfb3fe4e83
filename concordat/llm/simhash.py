"""SimHash near-duplicates by an inverted index of byte positions with count filtering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored
from .graph import connected_components
from .lists import link_lists, star


#: Bytes of a sketch; positions that share a key of its index, and the number of such keys.
SKETCH, JOINED, KEYS = 256, 5, 32


def shingle_hashes(value: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of every word shingle, repeats included; none for a text without words.

    A-Z are lower-cased, words part at ASCII white space; fewer words than ``width`` are one shingle.
    """
    words = (value or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, "<u8")
    line, count = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1][:count].tolist()
    digest, view = xxhash.xxh64_intdigest, memoryview(line)
    return np.array([digest(view[s:e], 42) for s, e in zip(starts, ends[-count:].tolist(), strict=True)], "<u8")


def majority_bits(hashes: np.ndarray) -> int:
    """64-bit SimHash as a signed number: a bit is 1 if it is set in over half of the hashes; 0 without any."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    return int(np.packbits(bits.sum(0, dtype=np.int64) * 2 > len(hashes)).view("<i8")[0])


def fingerprint(text: Column, width: int) -> Column:
    """64-bit SimHash of a text's word shingles as a long; 0 for a text without words."""

    @F.pandas_udf("long")
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([majority_bits(shingle_hashes(x, width)) for x in texts], dtype="int64")

    return each(text)


def fingerprint_and_sketch(text: Column, width: int, seed: int = 42) -> Column:
    """A struct of the SimHash and a sketch of ``SKETCH`` bytes, each from the least value of a hash function of its own.

    Two texts agree in a byte with a probability that is the Jaccard similarity of their sets of shingles (and one in
    256 of the rest). The sketch of a text without words is all zeros.
    """
    rng = np.random.default_rng(seed)
    times, plus = (rng.integers(0, 2**63, SKETCH, "uint64") * 2 + 1 for _ in range(2))

    def sketch(hashes: np.ndarray) -> bytes:
        if not len(hashes):
            return bytes(SKETCH)
        least = [(hashes[s : s + 1024, None] * times + plus).min(0) for s in range(0, len(hashes), 1024)]
        return (reduce(np.minimum, least) >> 16).astype(np.uint8).tobytes()

    @F.pandas_udf("print long, sketch binary")
    def each(texts: pd.Series) -> pd.DataFrame:
        found = [(majority_bits(h), sketch(np.unique(h))) for h in (shingle_hashes(x, width) for x in texts)]
        return pd.DataFrame(found, columns=["print", "sketch"])

    return each(text)


def shingle_sets(text: Column, width: int) -> Column:
    """The sorted set of a text's shingle hashes, eight bytes each."""

    @F.pandas_udf("binary")
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(x, width)).tobytes() for x in texts], dtype=object)

    return each(text)


def similar_sketches(sketches: DataFrame, texts: DataFrame, similarity: float, width: int) -> DataFrame:
    """(a, b) of fingerprints that texts of ``similarity`` or more connect.

    For distinct rows (print, sketch, mark), and texts as rows (mark, text).

    The index has ``KEYS`` lists for a sketch, each of ``JOINED`` bytes at positions of their own: a pair at similarity
    0.8 misses all with a probability of 0.000003. Keys that one sketch has are dropped before the sketches are sent. In
    a list, shared positional bytes are tallied for each pair, and pairs below the minimum filtered: what a pair at
    ``similarity`` shares on average, less four standard deviations. Those left are candidates: each is verified in the
    list, by the Jaccard similarity of the two sets of hashed shingles, unless verified pairs connect it already.
    """
    least = SKETCH * similarity - 4 * (SKETCH * similarity * (1 - similarity)) ** 0.5

    def tally(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [np.nonzero((one[s : s + 16, None] == two[None]).sum(2) >= least) for s in range(0, len(one), 16)]
        return np.concatenate([i + 16 * n for n, (i, _) in enumerate(found)]), np.concatenate([j for _, j in found])

    def bytes_of(rows: pd.DataFrame) -> np.ndarray:
        return np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(-1, SKETCH)

    def verified(sets: list[bytes], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = [np.frombuffer(x, "<u8") for x in sets]
        above = list(range(len(sets)))

        def top(n: int) -> int:
            while above[n] != n:
                above[n] = n = above[above[n]]
            return n

        kept = []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if a == b or (one := top(a)) == (two := top(b)):
                continue
            both, most = len(hashes[a]) + len(hashes[b]), max(len(hashes[a]), len(hashes[b]))
            if both - most < similarity * most - 1e-9:
                continue
            common = len(np.intersect1d(hashes[a], hashes[b], assume_unique=True))
            if common >= similarity * (both - common) - 1e-9:
                above[max(one, two)] = min(one, two)
                kept.append((a, b))
        found = np.array(kept, "int64").reshape(-1, 2)
        return found[:, 0], found[:, 1]

    def stars(rows: pd.DataFrame) -> pd.DataFrame:
        keys, prints, sketch, sets = rows["key"].to_numpy(), rows["print"].to_numpy("int64"), bytes_of(rows), rows["shingles"].tolist()
        edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        a, b = [prints[:0]], [prints[:0]]
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            some = prints[start:end]
            root = star(end - start, *verified(sets[start:end], *tally(sketch[start:end], sketch[start:end])))
            a.append(some)
            b.append(some[root])
        a, b = np.concatenate(a), np.concatenate(b)
        return pd.DataFrame({"a": a, "b": b})[a != b]

    def kernel(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
        if right is None:
            return stars(left)
        prints = np.r_[left["print"].to_numpy("int64"), right["print"].to_numpy("int64")]
        i, j = tally(bytes_of(left), bytes_of(right))
        root = star(len(prints), *verified([*left["shingles"], *right["shingles"]], i, j + len(left)))
        return pd.DataFrame({"a": prints, "b": prints[root]})[prints != prints[root]]

    keys = F.array(*[F.xxhash64(F.lit(n), F.substring("sketch", n * JOINED + 1, JOINED)) for n in range(KEYS)])
    places = stored(sketches.select(F.explode(keys).alias("key"), "print", "mark"))
    shared = places.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    hits = stored(places.join(shared, "key"))
    some = texts.dropDuplicates(["mark"]).join(hits.select("mark").distinct(), "mark", "left_semi")
    sets = stored(some.select("mark", shingle_sets(F.col("text"), width).alias("shingles")))
    postings = hits.join(sketches.join(sets, "mark"), ["print", "mark"]).select("key", "print", "sketch", "shingles")
    return link_lists(postings, "key", kernel, "a long, b long", many=stars).distinct()


def similar_fingerprints(prints: DataFrame, column: str, bits: int = 4) -> DataFrame:
    """(a, b) of distinct fingerprints: links that connect just those that a chain of pairs within ``bits`` connects.

    Two fingerprints that differ in at most ``bits`` bits share at least ``8 - bits`` of their eight bytes, position
    by position. A list for one byte holds a 256th of everything, so the index keeps a list for every choice of that
    many positions with their bytes: just the pairs that reach the guaranteed minimum meet in one. In a list, shared
    positional bytes are tallied for each pair, pairs below the minimum are filtered, and the rest verified bit by bit.
    A list gives a star over what it connects, not its pairs.
    """
    if not 1 <= bits <= 6:
        raise ValueError("bits must be from 1 to 6: the index needs two positions or more")
    least = 8 - bits
    masks = [sum(0xFF << 8 * p for p in chosen) for chosen in combinations(range(8), least)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    value = F.col(column)
    keys = F.array(*[F.xxhash64(F.lit(n), value.bitwiseAND(F.lit(m).cast("long"))) for n, m in enumerate(signed)])
    postings = prints.select(F.explode(keys).alias("key"), value.alias("print"))

    def kernel(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
        one = left["print"].to_numpy("int64")
        two = one if right is None else right["print"].to_numpy("int64")
        tally = reduce(np.add, [(one.view(np.uint8).reshape(-1, 8)[:, n][:, None] == two.view(np.uint8).reshape(-1, 8)[:, n]).astype(np.uint8) for n in range(8)])
        i, j = np.nonzero(tally >= least)
        near = np.bitwise_count(one[i].view(np.uint64) ^ two[j].view(np.uint64)) <= bits
        i, j = i[near], j[near]
        every = one if right is None else np.r_[one, two]
        root = star(len(every), i, j if right is None else j + len(one))
        linked = np.flatnonzero(root != np.arange(len(every)))
        return pd.DataFrame({"a": every[linked], "b": every[root[linked]]})

    return link_lists(postings, "key", kernel, "a long, b long").distinct()


def simhash_components(
    docs: DataFrame, width: int, bits: int = 4, id_column: str = "doc_id", also: Sequence[str] = (), similarity: float | None = None
) -> DataFrame:
    """(id, fingerprint as a long, component_id, root) of every row, component_id the smallest id reachable.

    ``root`` is the component's smallest fingerprint; columns named in ``also`` are carried along. With ``similarity``,
    texts of that similarity of their sets of shingles, or more, are linked as well (see ``similar_sketches``).

    Rows are first brought together by fingerprint, so copies cost nothing further. Null and wordless texts have
    fingerprint 0. A null id is never the smallest unless its component has no other. Repeated rows each stay.
    """
    if similarity is None:
        rows = stored(docs.select(F.col(id_column).alias("id"), fingerprint(F.col("text"), width).alias("print"), *also))
    else:
        both = fingerprint_and_sketch(F.col("text"), width).alias(free_name(docs, "both"))
        mark = free_name(docs, "mark")
        texts = docs.select(F.xxhash64("text").alias("mark"), "text")
        rows = docs.select(F.col(id_column).alias("id"), both, F.xxhash64("text").alias(mark), *also)
        rows = rows.select("id", f"{free_name(docs, 'both')}.*", mark, *also)
        rows = stored(rows)
    prints = stored(rows.groupBy("print").agg(F.min("id").alias("low")))
    links = similar_fingerprints(prints, "print", bits)
    if similarity is not None:
        links = links.union(similar_sketches(stored(rows.select("print", "sketch", F.col(mark).alias("mark")).distinct()), texts, similarity, width))
    roots = stored(connected_components(links))
    named = prints.join(roots, prints.print == roots.node, "left").select("print", F.coalesce("root", "print").alias("root"), "low")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = stored(named.select("print", "root").join(lows, "root").select("print", "component_id", "root"))
    joined = rows.join(classes, "print")
    return joined.select(F.col("id").alias(id_column), F.col("print").alias("fingerprint"), "component_id", "root", *also)


def hex_digits(fingerprint_long: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint_long), 16, "0"))


def drop_near_duplicates(
    docs: DataFrame, width: int = 5, bits: int = 4, id_column: str = "doc_id", similarity: float | None = 0.8
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that with the smallest id, and text hash if ids are equal.

    Near are texts within ``bits`` bits of SimHash or, unless None, of ``similarity`` or more: a pair at 0.8 differs in
    ten bits on average, beyond what shared bytes of a SimHash guarantee.

    Rows without an id stay only where their group has no other, and rows equal in id and text are one. Columns keep
    their names. The texts are shuffled once, by id and hash, to meet the list of rows that stay.
    """
    mark, ident = free_name(docs, "text_hash"), free_name(docs, "kept_id")
    hashed = docs.withColumn(mark, F.xxhash64("text"))
    rows = simhash_components(hashed, width, bits, id_column, also=[mark], similarity=similarity)
    first = F.min(F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col(mark).alias("hash")))
    groups = rows.groupBy("root").agg(first.alias("first"))
    kept = stored(groups.select(F.col("first.id").alias(ident), F.col("first.hash").alias(f"{mark}_of")))
    same = hashed[id_column].eqNullSafe(kept[ident]) & (hashed[mark] == kept[f"{mark}_of"])
    return hashed.join(kept, same, "left_semi").dropDuplicates([id_column, mark]).drop(mark)
