"""Phrases whose words keep together: frequent n-grams by mergeable Misra-Gries summaries, then counted exactly."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, partitions, stored
from .variants import mixed

#: Fixed values of the contract: what ends a piece becomes a line feed, what parts words a space, both in bytes.
ENDS = b".,;:!?\n\x0b\x0c\r"
NORMAL = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")
#: Words of the longest phrase.
LONGEST = 3
#: Text that is numbered at once, texts of a language that are counted together, n-grams of a hash partition, and bits of a key within one: one false survivor in a hundred.
CHUNK_BYTES, GROUP_CHUNKS, PART_MASS, KEY_BITS = 1 << 22, 4, 1 << 21, np.uint64(28)

#: Chunks of a language from neighbouring tasks that are counted together, twice as many at most.
MET_CHUNKS = 8

#: Distinct phrases of bunches that a task holds.
MOST_CODES = 5_000_000

FACTORS = mixed(np.arange(1, LONGEST + 1, dtype="uint64")) | np.uint64(1)


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(bunch, lang, words, size, text): whole pieces of the texts of a language, A-Z lower-cased, each on a line, compressed.

    A row is a chunk; up to GROUP_CHUNKS chunks of a language from one task share a bunch.

    A null lang is ``und``, a null text is empty. Documents longer than a chunk are cut between pieces; a longer piece
    stays whole.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 33
        bunches: dict[str, list[int]] = {}

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal number
            text = b"\n".join(held.pop(lang))
            del sizes[lang]
            bunch = bunches.setdefault(lang, [0, GROUP_CHUNKS])
            if bunch[1] == GROUP_CHUNKS:
                bunch[:] = number, 0
                number += 1
            bunch[1] += 1
            values = [pa.array([bunch[0]]), pa.array([lang]), pa.array([len(text.split())]), pa.array([len(text)])]
            values.append(pa.array([pa.Codec("zstd", compression_level=9).compress(text, asbytes=True)], pa.binary()))
            return pa.RecordBatch.from_arrays(values, ["bunch", "lang", "words", "size", "text"])

        for batch in batches:
            for lang, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text, start = whole.as_py().lower().translate(NORMAL), 0
                while start < len(text):
                    end = len(text)
                    if end - start > chunk_bytes:
                        end = max(text.rfind(b"\n", start, start + chunk_bytes), text.find(b"\n", start + 1)) % (len(text) + 1)
                    held.setdefault(lang, []).append(text[start:end])
                    sizes[lang] = sizes.get(lang, 0) + end - start
                    start = end
                    if sizes[lang] >= chunk_bytes:
                        yield flush(lang)
                if sum(sizes.values()) >= 4 * chunk_bytes:
                    for other in list(held):
                        yield flush(other)
        for other in list(held):
            yield flush(other)

    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    )
    return texts.mapInArrow(gather, "bunch long, lang string, words long, size long, text binary")


def met(chunks: DataFrame) -> DataFrame:
    """``chunks`` with the bunches of neighbouring tasks as one, up to MET_CHUNKS chunks of a language or so.

    A phrase is shuffled once for each bunch that has it, and a task that reads little text has few chunks of each language.
    Only the numbers of the bunches are sorted.
    """
    bunches = chunks.groupBy("lang", "bunch").agg(F.count(F.lit(1)).alias("chunks"))
    before = F.sum("chunks").over(Window.partitionBy("lang").orderBy("bunch")) - F.col("chunks")
    groups = bunches.select("bunch", "lang", F.floor(before / MET_CHUNKS).alias("group"))
    names = groups.select("bunch", F.min("bunch").over(Window.partitionBy("lang", "group")).alias("first"))
    return chunks.join(F.broadcast(names), "bunch").withColumn("bunch", F.col("first")).drop("first")


def numbered(compressed: bytes, size: int) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of a chunk, and the number of each word of it; 0 and 1 are blanks and ends of pieces."""
    names: dict[bytes, int] = {b"": 0, b"\n": 1}
    text = pa.decompress(compressed, size, codec="zstd", asbytes=True)
    tokens = text.replace(b"\n", b" \n ").split(b" ")
    ids = np.fromiter((names.setdefault(t, len(names)) for t in tokens), "int64", len(tokens))
    return list(names), ids[ids != 0]


def gram_codes(lang: str, words: list[bytes], ids: np.ndarray, parts: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1 to LONGEST words: where phrases start in ``ids``, and their code: hash partition, then KEY_BITS of the hash."""
    prefix = blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    hashed = np.frombuffer(b"".join(blake2b(w, digest_size=8, key=prefix).digest() for w in words), "<u8")[ids]
    inside, value, found = ids > 1, np.zeros(len(ids), "uint64"), []
    for n in range(min(LONGEST, len(ids))):
        size = len(ids) - n
        inside = inside[:size] & (ids[n:] > 1)
        value = mixed(value[:size] * FACTORS[n] + hashed[n:])
        at = np.flatnonzero(inside)
        high, low = value[at] >> np.uint64(32), value[at] & ((np.uint64(1) << KEY_BITS) - np.uint64(1))
        found.append((at, ((high * np.uint64(parts)) >> np.uint64(32) << KEY_BITS) | low))
    return found


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys of up to 32 bits as differences, byte by byte of lesser weight first, so that compression finds the zeros."""
    steps = np.diff(keys.astype("<u4"), prepend=np.zeros(1, "<u4"))
    return steps.astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, "u1").reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps, dtype="uint64").astype("uint32")


class Summary:
    """Misra-Gries counters of at most ``capacity`` keys, merged with others by adding and then lowering all alike.

    Lowering by d takes d from more than ``capacity`` counters, so ``lost``, the sum of all d, is at most the mass over
    ``capacity`` + 1. A key's count lies between its counter and that plus ``lost``.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = max(1, capacity), 0
        self.keys, self.counts = np.zeros(0, "uint32"), np.zeros(0, "int64")
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._size += len(keys)
        if self._size > self.capacity:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self._waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self._waiting)])
        self._waiting, self._size = [], 0
        order = keys.argsort(kind="stable")
        keys, counts = keys[order], counts[order]
        firsts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, "int64")
        keys, counts = keys[firsts], np.add.reduceat(counts, firsts) if len(keys) else counts
        if len(keys) > self.capacity:
            down = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.lost += down
            keys, counts = keys[counts > down], counts[counts > down] - down
        self.keys, self.counts = keys, counts

    def at_least(self, threshold: int) -> np.ndarray:
        """Sorted keys that may occur ``threshold`` times: all that do, if the mass over ``threshold`` is at most ``capacity``."""
        self.merge()
        return self.keys[self.counts + self.lost >= threshold]


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and the sums of their counts."""
    keys, place = np.unique(np.concatenate(codes), return_inverse=True)
    return keys, np.bincount(place, np.concatenate(counts), len(keys)).astype("int64")


def bunch_summaries(chunks: DataFrame, parts: int) -> DataFrame:
    """(part, bunch, once, more, times): the keys of a bunch in a hash partition, by those seen once and more often.

    Chunks of a bunch are added up where one task reads them, MOST_CODES in hand at most; several rows of one are added later.
    """

    def rows_of(bunch: int, codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        of = (codes >> KEY_BITS).astype("int32")
        keys = (codes & ((np.uint64(1) << KEY_BITS) - np.uint64(1))).astype("uint32")
        edges = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        rows: list[tuple] = []
        for start, end in zip(edges, np.r_[edges[1:], len(of)], strict=True):
            k, n = keys[start:end], counts[start:end]
            rows.append((packed(k[n == 1]), packed(k[n > 1]), n[n > 1].astype("<u4").tobytes()))
        values = [pa.array(of[edges]), pa.array(np.full(len(edges), bunch)), *(pa.array([r[n] for r in rows], pa.binary()) for n in range(3))]
        return pa.RecordBatch.from_arrays(values, ["part", "bunch", "once", "more", "times"])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for bunch, lang, size, text in zip(*(c for c in batch.columns), strict=True):
                found = [c for _, c in gram_codes(lang.as_py(), *numbered(text.as_py(), size.as_py()), parts)]
                codes, counts = np.unique(np.concatenate([np.zeros(0, "uint64"), *found]), return_counts=True)
                if not len(codes):
                    continue
                key = bunch.as_py()
                if key in held:
                    codes, counts = merged([held[key][0], codes], [held[key][1], counts])
                held[key] = codes, counts
                while sum(len(c) for c, _ in held.values()) > MOST_CODES:
                    largest = max(held, key=lambda k: len(held[k][0]))
                    yield rows_of(largest, *held.pop(largest))
        for key in list(held):
            yield rows_of(key, *held.pop(key))

    return chunks.select("bunch", "lang", "size", "text").mapInArrow(summarise, "part int, bunch long, once binary, more binary, times binary")


def surviving_keys(summaries: DataFrame, threshold: int) -> DataFrame:
    """(bunch, part, keys): those keys of a bunch that occur ``threshold`` times or more in all, and few others.

    A hash partition has PART_MASS phrases or so, counted once a bunch each, so what meets here is bounded however large
    the corpus is; its summary has more counters than its mass over ``threshold``.
    """

    def survive(rows: pd.DataFrame) -> pd.DataFrame:
        lists = []
        for once, more, times in zip(rows["once"], rows["more"], rows["times"], strict=True):
            keys = np.concatenate([unpacked(once), unpacked(more)])
            lists.append((keys, np.concatenate([np.ones(len(once) // 4, "int64"), np.frombuffer(times, "<u4").astype("int64")])))
        summary = Summary(sum(int(n.sum()) for _, n in lists) // threshold)
        for keys, counts in lists:
            summary.add(keys, counts)
        frequent = summary.at_least(threshold)
        out: dict[int, list[np.ndarray]] = defaultdict(list)
        for bunch, (keys, _) in zip(rows["bunch"], lists, strict=True):
            out[bunch].append(keys[np.isin(keys, frequent)])
        kept = [packed(np.unique(np.concatenate(k))) for k in out.values()]
        return pd.DataFrame({"bunch": list(out), "part": rows["part"].iloc[0], "keys": pd.Series(kept, dtype=object)})

    return summaries.groupBy("part").applyInPandas(survive, "bunch long, part int, keys binary").where("length(keys) > 0")


def exact_counts(chunks: DataFrame, survivors: DataFrame, parts: int, threshold: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases that occur ``threshold`` times: the texts again, phrases as they are.

    A phrase is looked at only where its first words are a survivor as well: they occur as often at least.
    """
    kept_bits = np.uint64((1 << 22) - 1)

    def count(_: tuple, texts: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        phrases: list[bytes] = []  # neighbours begin alike, which compresses
        counts: list[int] = []
        if len(lists):
            wanted = [unpacked(k).astype("uint64") | (np.uint64(p) << KEY_BITS) for p, k in zip(lists["part"], lists["keys"], strict=True)]
            frequent = np.sort(np.concatenate(wanted))
            maybe = np.zeros(int(kept_bits) + 1, bool)
            maybe[frequent & kept_bits] = True
            for lang, size, text in zip(texts["lang"], texts["size"], texts["text"], strict=True):
                words, ids = numbered(text, size)
                number, before = ids.copy(), np.ones(len(ids), bool)
                for n, (at, codes) in enumerate(gram_codes(lang, words, ids, parts), 1):
                    some = before[at] & maybe[codes & kept_bits]
                    at, codes = at[some], codes[some]
                    at = at[frequent[np.minimum(np.searchsorted(frequent, codes), len(frequent) - 1)] == codes]
                    if n == 1:
                        times = np.bincount(ids[at], minlength=len(words))
                        spelt = [[i] for i in np.flatnonzero(times).tolist()]
                        times = times[times > 0]
                    else:
                        # a number for each distinct phrase: from that of the phrase without its last word, and the last word
                        _, first, exact, times = np.unique(
                            number[at] * len(words) + ids[at + n - 1], return_index=True, return_inverse=True, return_counts=True
                        )
                        number[at] = exact
                        spelt = zip(*(ids[at[first] + d].tolist() for d in range(n)), strict=True)
                    before = np.zeros(len(ids), bool)
                    before[at] = True
                    for phrase, times_seen in sorted(zip((b" ".join([words[i] for i in w]) for w in spelt), times.tolist(), strict=True)):
                        phrases.append(phrase)
                        counts.append(times_seen)
        lang = texts["lang"].iloc[0] if len(texts) else ""
        return pd.DataFrame({"lang": pd.Series([lang] * len(phrases), dtype=object), "phrase": pd.Series(phrases, dtype=object), "n": pd.Series(counts, dtype="int64")})

    pairs = chunks.select("bunch", "lang", "size", "text").groupBy("bunch").cogroup(survivors.groupBy("bunch"))
    local = pairs.applyInPandas(count, "lang string, phrase binary, n long")
    total = local.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= threshold)
    phrase = F.col("phrase").cast("string")
    return total.select("lang", phrase.alias("phrase"), F.size(F.split(phrase, " ")).alias("size"), "f")


def least_scores(rows: DataFrame, top: int) -> DataFrame:
    """(lang, least): a score that at least ``top`` of a language's rows reach; none for languages with fewer rows.

    Scores are counted by their powers of two in sixteenths, so a language has a few hundred counts; the least score of
    the last count needed for ``top`` rows is that bound. It is no cut: the first ``top`` rows reach it, ties included.
    """
    step = F.floor(F.log2(F.col("score") + 1) * 16)
    sums = rows.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("rows"), F.min("score").alias("least"))
    reached = sums.withColumn("reached", F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("step"))))
    return reached.where(F.col("reached") >= top).groupBy("lang").agg(F.max("least").alias("least"))


def reaching(rows: DataFrame, found: DataFrame, top: int, score: str) -> DataFrame:
    """``rows`` whose ``score``, an expression that may use ``least``, reaches what ``top`` rows of ``found`` reach."""
    return rows.join(F.broadcast(least_scores(found, top)), "lang", "left").where(f"least is null or {score} >= least").drop("least")


def judged(counts: DataFrame, share: int = 50, top: int | None = None) -> list[DataFrame]:
    """(lang, phrase, a, l, r, score) of candidates by size, without those that a longer candidate holds in ``share`` per cent of cases.

    Products are decimals of 38 digits: exact for counts up to 10^16. With ``top``, the tables are stored, and those of
    longer phrases lack rows that ``top`` shorter ones surpass: a part occurs as often as the phrase at least, so
    a million times a / l bounds the score from above, and such rows go nowhere beyond the first join.
    """
    w = F.split("phrase", " ")
    found: list[DataFrame] = []
    cut: list[DataFrame] = []

    def words(first: int, last: int) -> Column:
        return F.array_join(F.slice(w, first, last - first + 1), " ")

    def with_count(rows: DataFrame, name: str, part: Column, of: int) -> DataFrame:
        part_counts = counts.where(F.col("size") == of).select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name))
        return rows.join(part_counts, (F.col("lang") == F.col("_lang")) & (part == F.col("_part"))).drop("_lang", "_part")

    def with_cut(rows: DataFrame, size: int, k: int) -> DataFrame:
        """``cut``: the score of the cut after k words, k, and the counts of its parts."""
        rows = with_count(rows, "l", words(1, k), k)
        if k == 1 and found and top is not None:
            # stored, so that Spark knows how few are left and need not shuffle the parts of the further joins
            rows = stored(reaching(rows, reduce(DataFrame.union, found), top, "cast(1000000 as decimal(7,0)) * a div l"))
            cut.append(rows)
        rows = with_count(rows, "r", words(k + 1, size), size - k)
        a, l, r = (F.col(c).cast("decimal(19,0)") for c in "alr")
        rows = rows.withColumns({"up": a * a * F.lit(1_000_000).cast("decimal(7,0)"), "down": l * r}).withColumn("score", F.expr("up div down"))
        return rows.withColumn(f"cut{k}", F.struct("score", F.lit(k).alias("k"), "l", "r")).drop("up", "down", "score", "l", "r")

    for size in range(2, LONGEST + 1):
        rows = counts.where(F.col("size") == size).select("lang", "phrase", F.col("f").alias("a"))
        if size < LONGEST:
            inner = [F.array_join(F.slice(w, n, size), " ") for n in range(1, LONGEST - size + 2)]
            holds = counts.where(F.col("size") == LONGEST).select("lang", F.explode(F.array(*inner)).alias("phrase"), "f")
            longer = holds.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
            rows = rows.join(longer, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {share} * a").drop("longer")
        for k in range(1, size):
            rows = with_cut(rows, size, k)
        cuts = [F.col(f"cut{k}") for k in range(1, size)]
        rows = rows.withColumn("best", F.least(*cuts) if len(cuts) > 1 else cuts[0])
        rows = rows.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
        found.append(rows if top is None else stored(rows))
    discard(*cut)
    return found


def scored(counts: DataFrame, share: int = 50) -> DataFrame:
    """All rows of ``judged`` in one table."""
    return reduce(DataFrame.union, judged(counts, share))


def mined_phrases(docs: DataFrame, threshold: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of two or three words of each language.

    A phrase lies within a piece of a text, occurs ``threshold`` times or more, overlaps included, and scores by its
    weakest cut. A null text is empty, a null lang is ``und``, repeated rows count as often, other columns and ids are
    ignored, an empty table gives none. Ties in score and count go by the phrase's bytes.
    """
    if threshold < 1:
        raise ValueError("threshold must be at least 1")
    chunks = stored(chunked(docs))
    totals = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
    mass = LONGEST * (totals.agg(F.sum("n")).first()[0] or 0)
    parts = max(1, -(-mass // PART_MASS))
    together = met(chunks)
    survivors = surviving_keys(bunch_summaries(together, parts), threshold)
    counts = stored(exact_counts(together, survivors, parts, threshold))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found, most = judged(counts, share, top), partitions(docs.sparkSession)
    candidates = reduce(DataFrame.union, found)
    few = reaching(candidates, candidates, top, "score")
    # first within slices of a language, so that no task sorts all its phrases
    for slices in (most, math.isqrt(most)):
        some = few.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
        few = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    first = stored(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    discard(chunks, counts, *found)
    return first


def phrases_sql(threshold: int = 10, share: int = 50, top: int = 2000) -> str:
    """DuckDB SQL for the rows of ``mined_phrases`` over ``documents``."""
    low, high = "".join(map(chr, range(97, 123))), "".join(map(chr, range(65, 91)))
    grams = " union all ".join(
        f"select lang, {n} as size, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) as phrase from words"
        for n in range(1, LONGEST + 1)
    )
    return f"""
    with pieces as (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{high}', '{low}'), '[.,;:!?\\x0A-\\x0D]')) as piece
        from documents),
    words as materialized (
        select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces),
    totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
    grams as ({grams}),
    f as materialized (select lang, phrase, size, count(*) as f from grams group by all having count(*) >= {threshold}),
    parted as (select *, string_split(phrase, ' ') as w from f where size > 1),
    cuts as (
        select lang, phrase, f as a, k, array_to_string(w[1:k], ' ') as left_part, array_to_string(w[k + 1:], ' ') as right_part
        from parted, range(1, {LONGEST}) t(k) where k < size),
    scores as (
        select c.lang, c.phrase, a, k, x.f as l, y.f as r, cast((1000000::hugeint * a * a) // (x.f::hugeint * y.f) as bigint) as score
        from cuts c join f x on x.lang = c.lang and x.phrase = left_part join f y on y.lang = c.lang and y.phrase = right_part),
    least as (select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    held as (select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, f from parted where size > 2),
    longer as (select lang, phrase, max(f) as f from held group by all),
    kept as (
        select t.* from least t left join longer g on g.lang = t.lang and g.phrase = t.phrase where g.f is null or 100 * g.f < {share} * a)
    select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
    from kept k join totals t on t.lang = k.lang qualify rank <= {top}"""
