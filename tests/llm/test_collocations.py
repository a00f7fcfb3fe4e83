"""Phrase mining against brute force and SQL, and on nulls, blanks, repeats, ties, long texts and empty tables."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from concordat.llm import collocations, queries


def mined(rows, threshold=10, share=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if len(p) > 1 and c >= threshold}
        found = []
        for p, a in frequent.items():
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [c for q, c in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * c >= share * a for c in longer):
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["The", "of", "new", "york", "é", "ÉÀ", "city", " x", "a\x00b", "𝔘𝔫", "i|o"]
    rows = []
    for n in range(300):
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b"]) for w in rng.choices(words, k=rng.randint(0, 40)))
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    rows += [("en", None), (None, None), ("de", ""), ("de", " .,; "), ("es", "no no no no no no no no no no no no")]
    rows += [("en", "new york city " * 4000), ("en", "New York. City " * 3), ("en", "New York. City " * 3)]
    return rows


def frame(spark, rows):
    named = [(n % 50, text, lang) for n, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(named, "doc_id long, text string, lang string")


def test_phrases(spark, rows):
    docs = frame(spark, rows)
    for options in ({}, {"threshold": 2, "share": 80}, {"threshold": 1, "share": 101, "top": 7}):
        got = sorted(tuple(r) for r in collocations.mined_phrases(docs.selectExpr("*", "1 as f", "2 as size", "3 as chunk", "4 as phrase"), **options).collect())
        assert got == mined(rows, **{"threshold": 10, **options})
    assert collocations.mined_phrases(docs.limit(0)).collect() == []
    assert collocations.mined_phrases(frame(spark, [("en", None), (None, "")])).collect() == []
    with pytest.raises(ValueError):
        collocations.mined_phrases(docs, threshold=0)


def test_query_agrees_with_sql_and_brute_force(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.op13_phrase_mining(spark, str(tmp_path))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == mined(rows) == sorted(connection.execute(collocations.phrases_sql()).fetchall())


def test_chunks_and_partitions_change_nothing(spark, rows):
    """Pieces dealt to hundreds of chunks, phrases to a hundred hash partitions."""
    want = defaultdict(Counter)
    for size in (1 << 22, 64):
        chunks = collocations.stored(collocations.chunked(frame(spark, rows).repartition(3), size))
        assert chunks.groupBy("bunch").agg(F.count("lang").alias("n"), F.countDistinct("lang").alias("m")).where("n > 4 or m > 1").count() == 0
        for parts in (1, 100):
            survivors = collocations.surviving_keys(collocations.bunch_summaries(chunks, parts), 10)
            counts = collocations.exact_counts(chunks, survivors, parts, 10)
            want[size, parts] = {(r.lang, r.phrase): (r.size, r.f) for r in counts.collect()}
    first = want[1 << 22, 1]
    assert len(first) > 50 and all(x == first for x in want.values())


def test_long_counts_stay_exact(spark):
    big = 3_000_000_000_000
    rows = [("en", "a", 1, big + 1), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 1), ("en", "a b a", 3, big // 2 - 1), ("en", "b a", 2, big)]
    got = {r.phrase: r for r in collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, size int, f long")).collect()}
    assert got["a b"].score == 1_000_000 * (big - 1) ** 2 // ((big + 1) * (big + 7))
    assert got["b a"].score == 1_000_000 * big**2 // ((big + 1) * (big + 7)) and (got["b a"].l, got["b a"].r) == (big + 7, big + 1)
    a = big // 2 - 1
    assert got["a b a"].score == min(1_000_000 * a * a // ((big + 1) * big), 1_000_000 * a * a // ((big - 1) * (big + 1)))


@pytest.mark.parametrize("seed", range(5))
def test_summaries_keep_every_frequent_key(seed):
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(20_000) < 0.3, rng.integers(0, 40, 20_000), rng.integers(0, 1 << 32, 20_000)).astype("uint32")
    threshold = 100
    summary = collocations.Summary(len(keys) // threshold)
    for part in np.array_split(keys, 37):
        summary.add(*np.unique(part, return_counts=True))
        assert len(summary.keys) <= summary.capacity
    summary.merge()
    exact = Counter(keys.tolist())
    assert summary.lost < threshold
    assert {k for k, n in exact.items() if n >= threshold} <= set(summary.at_least(threshold).tolist())
    assert all(n <= exact[k] <= n + summary.lost for k, n in zip(summary.keys.tolist(), summary.counts.tolist()))
    some = np.unique(keys)
    assert (collocations.unpacked(collocations.packed(some)) == some).all() and len(collocations.unpacked(b"")) == 0


def test_rows_below_the_first_are_left_before_further_joins(spark):
    """What ``top`` rows surpass is not joined with further parts; ties at the bound stay, small languages stay whole."""
    rng = random.Random(5)
    rows = [("en", f"{n % 40}x", 1, 10_000 + n) for n in range(40)]
    rows += [("en", f"{i}x {j}x", 2, rng.choice([10, 10, 500, 900])) for i in range(40) for j in range(40)]
    rows += [("en", f"{i}x {j}x {k}x", 3, 10) for i in range(40) for j in range(0, 40, 9) for k in range(3)]
    rows += [("de", "a", 1, 30), ("de", "b", 1, 40), ("de", "a b", 2, 30), ("de", "b a", 2, 10), ("de", "a b a", 3, 10)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, size int, f long")
    whole = sorted((tuple(r) for r in collocations.scored(counts).collect()), key=lambda r: (-r[5], -r[2], r[1].encode()))
    found = collocations.judged(counts, top=100)
    got = {tuple(r) for t in found for r in t.collect()}
    assert got <= set(whole)
    for lang, n in (("en", 100), ("de", 3)):
        assert set([r for r in whole if r[0] == lang][:n]) <= got
    longer = [r for r in found[1].collect() if r.lang == "en"]
    assert not longer and any(len(r[1].split()) == 3 and r[0] == "en" for r in whole)
    bound = {r.lang: r.least for r in collocations.least_scores(found[0], 100).collect()}
    scores = sorted((r.score for r in found[0].where("lang = 'en'").collect()), reverse=True)
    assert set(bound) == {"en"} and 0 < bound["en"] <= scores[99]


def test_bunches_of_neighbouring_tasks_meet(spark):
    """However few texts a task reads: a language has about one bunch for MET_CHUNKS chunks, none of two languages, no chunk is lost."""
    rng = random.Random(3)
    rows = [(("en", "de", None)[n % 3], " ".join(rng.choice("abcdefgh") * 3 for _ in range(200))) for n in range(120)]
    docs = frame(spark, rows).repartition(20)
    chunks = collocations.chunked(docs, 2000).localCheckpoint()
    before, after = ([tuple(r) for r in t.select("bunch", "lang", "size", "text").collect()] for t in (chunks, collocations.met(chunks)))
    assert sorted(r[1:] for r in before) == sorted(r[1:] for r in after)
    held = Counter((r[0], r[1]) for r in after)
    assert len({b for b, _ in held}) == len(held) and max(held.values()) < 2 * collocations.MET_CHUNKS
    for lang in ("en", "de", "und"):
        of, n = ([r[1] for r in t].count(lang) for t in (before, after))
        assert of == n and len([1 for _, x in held if x == lang]) <= n / collocations.MET_CHUNKS + 1 < len({r[0] for r in before if r[1] == lang})
    counts = []
    for some in (chunks, collocations.met(chunks)):
        survivors = collocations.surviving_keys(collocations.bunch_summaries(some, 3), 10)
        counts.append(sorted(tuple(r) for r in collocations.exact_counts(some, survivors, 3, 10).collect()))
    assert counts[0] == counts[1] and len(counts[0]) > 100
