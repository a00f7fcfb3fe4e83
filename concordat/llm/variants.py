"""Spelling variants: words one edit apart, met over a reduced alphabet and verified on the words themselves."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

#: Fixed value of the contract: letters of a word, after A-Z are lower-cased.
LETTERS = re.compile("[a-zÀ-ÿ]+")
#: Longer words do not travel with their keys: a word has as many keys as letters, times a constant.
CARRIED = 64
#: Letters whose keys are made at once.
SLICE = 1 << 17

_RANDOM = np.random.default_rng(11)
BASE = int(_RANDOM.integers(1 << 62)) * 2 + 1
INVERSE = np.uint64(pow(BASE, -1, 1 << 64))


def counted_words(docs: DataFrame, id_column: str = "doc_id", drop_one_in: int = 0) -> DataFrame:
    """(word, n): runs of letters of all whole texts, A-Z lower-cased, with their occurrences.

    ``drop_one_in`` deletes a letter of some runs, as misspellings to be found: of those whose CRC-32 after the id and a
    colon it divides, the letter at that number modulo the length. A null text has no words, a null id is empty there.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[str] = Counter()
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                runs = Counter(LETTERS.findall((text or "").encode("utf-8", "replace").lower().decode("utf-8")))
                first = zlib.crc32(f"{'' if key is None else key}:".encode())
                for run, n in runs.items():
                    if drop_one_in and (h := zlib.crc32(run.encode(), first)) % drop_one_in == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    seen[run] += n
            seen.pop("", None)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    ids = docs.select(F.col(id_column).cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    return ids.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit numbers, one for one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def reduced_keys(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words whose letters are hashed to ``symbols``: the key of each; keys of neighbours; the word of each neighbour.

    A key is a polynomial over the symbols modulo 2^64, mixed with the length, so each edit costs a step whatever the
    length. Of the one-edit neighbourhood each two reduced words need one direction only: a deletion of the longer is the
    insertion into the shorter, and a replacement by a higher symbol is one by a lower symbol seen from the other side.
    Deletions in a run of equal symbols are one neighbour.
    """
    sizes = np.array([len(w) for w in words], "int64")
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype("uint64")
    values = mixed(np.arange(1, symbols + 1, dtype="uint64"))
    symbol = (mixed(letters + np.uint64(1)) % np.uint64(symbols)).astype("int64")
    starts = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(letters)) - starts[word]
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(sizes.max()), BASE, "uint64")])
    term = values[symbol] * powers[at]
    run = np.cumsum(term)
    before = run - term
    before -= before[starts][word]
    total = before[starts + sizes - 1] + term[starts + sizes - 1]

    def key(value: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mixed(value + mixed(length.astype("uint64"))).view("int64")

    keys, owners = [], []
    last_of_run = np.r_[(symbol[1:] != symbol[:-1]) | (word[1:] != word[:-1]), True]
    cut = np.flatnonzero(last_of_run)
    shorter = before[cut] + (total[word[cut]] - before[cut] - term[cut]) * INVERSE
    keys.append(key(shorter, sizes[word[cut]] - 1))
    owners.append(word[cut])
    for s in range(1, symbols):
        lower = np.flatnonzero(symbol < s)
        replaced = total[word[lower]] + (values[s] - values[symbol[lower]]) * powers[at[lower]]
        keys.append(key(replaced, sizes[word[lower]]))
        owners.append(word[lower])
    return key(total, sizes), np.concatenate(keys), np.concatenate(owners)


def keyed_words(words: DataFrame, name: str, symbols: int, neighbours: bool) -> DataFrame:
    """(key, own, word or id): the reduced key of every word, and with ``neighbours`` those one edit away."""
    kind = words.schema[name].dataType.simpleString()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            edges = np.cumsum([len(w) for w in texts]) // SLICE
            cuts = np.r_[0, np.flatnonzero(np.diff(edges)) + 1, len(texts)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                own, near, owner = reduced_keys(texts[start:end], symbols)
                place = np.arange(end - start)
                if neighbours:
                    own, place, mark = np.r_[own, near], np.r_[place, owner], np.r_[np.ones(len(own), bool), np.zeros(len(near), bool)]
                else:
                    mark = np.ones(len(own), bool)
                carried = batch.column(1).take(pa.array(place + start))
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(mark), carried], ["key", "own", name])

    return words.select(F.col("word").alias("_word"), name).mapInArrow(spread, f"key long, own boolean, {name} {kind}")


def one_edit(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) == 1


def near_pairs(words: DataFrame, symbols: int = 8) -> DataFrame:
    """(a, b): each two of the distinct non-empty ``words`` (column word) that differ by exactly one edit, once.

    Words meet where one's reduced neighbour is the other's reduced word, and are verified in the join. A word of more
    than CARRIED letters, of which there may be one as long as a text, is joined by number and looked up afterwards.
    """
    short = words.where(F.length("word") <= CARRIED).select("word")
    edits, own = keyed_words(short, "word", symbols, True), keyed_words(short, "word", symbols, False)
    right = own.select(F.col("key").alias("_key"), F.col("word").alias("b"))
    met = (F.col("key") == F.col("_key")) & (~F.col("own") | (F.col("word") < F.col("b"))) & one_edit(F.col("word"), F.col("b"))
    pairs = edits.join(right, met).select(F.col("word").alias("a"), "b")

    # the longest carried words may be near a longer one
    long = stored(words.where(F.length("word") >= CARRIED).select("word", F.monotonically_increasing_id().alias("id")))
    far, home = keyed_words(long, "id", symbols, True), keyed_words(long, "id", symbols, False)
    candidates = far.join(home.select(F.col("key").alias("_key"), F.col("id").alias("_id")), F.col("key") == F.col("_key"))
    candidates = candidates.where(~F.col("own") | (F.col("id") < F.col("_id"))).select("id", "_id").distinct()
    a, b = long.select("id", F.col("word").alias("a")), long.select(F.col("id").alias("_id"), F.col("word").alias("b"))
    looked = candidates.join(a, "id").join(b, "_id").select("a", "b")
    wide = F.greatest(F.length("a"), F.length("b")) > CARRIED
    return pairs.union(looked.where(wide & one_edit(F.col("a"), F.col("b"))))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form) without cycles: steps double each round, so log of the longest chain."""
    steps = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stored(steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        discard(steps)
        steps = longer
        if not steps.where("moved").limit(1).count():
            return steps.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 2, symbols: int = 8) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words.

    Near words differ by exactly one inserted, deleted or replaced code point. ``form`` is the near word of largest n, ties
    to the smallest in code-point order, if that n is ``ratio`` times the word's own (at least 2, so that forms end); else
    null. ``root`` follows forms to the last. Null and empty words are left out, of a repeated word the largest n counts,
    other columns are ignored, an empty table gives none.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    vocabulary = stored(words.where("word <> ''").groupBy("word").agg(F.max("n").cast("long").alias("n")))
    pairs = near_pairs(vocabulary, symbols)
    both = stored(pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.*"))
    other = vocabulary.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    best = (
        both.join(other, "b").groupBy(F.col("a").alias("word"))
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    )
    joined = vocabulary.join(best, "word", "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    judged = stored(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    discard(both)
    roots = roots_of(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def frequent_words(docs: DataFrame, id_column: str = "doc_id", least_letters: int = 5, least_count: int = 3, drop_one_in: int = 0) -> DataFrame:
    """(word, n): counted words of enough letters and occurrences."""
    counted = counted_words(docs, id_column, drop_one_in)
    return counted.where((F.length("word") >= least_letters) & (F.col("n") >= least_count))
