"""Spelling variants against brute force, and on nulls, blanks, repeats, ties, long words and empty tables."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from concordat.llm import queries, variants


def near(a, b):
    """Whether one insertion, deletion or replacement leads from a to b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def judged(counts, ratio=2):
    """word -> (form, root, n, n_near, form_n) by comparing all words."""
    forms, rows = {}, {}
    for word, n in counts.items():
        found = sorted((-counts[w], w) for w in counts if near(word, w))
        best = (found[0][1], -found[0][0]) if found and -found[0][0] >= ratio * n else (None, None)
        forms[word] = best[0]
        rows[word] = (n, len(found), best)
    for word in rows:
        root = word
        while forms[root]:
            root = forms[root]
        n, n_near, (form, form_n) = rows[word]
        rows[word] = (form, root, n, n_near, form_n)
    return rows


def got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def counted(rows, drop):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if drop and h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts.pop("", None)
    return counts


def test_words_are_counted(spark):
    long = "x" * 3000 + " Été ÀB×c÷d naïve_naive l'œuvreµ " * 20
    rows = [(n, f"alpha beta {long}" if n % 3 else "Gamma gamma\nGAMMA, delta9epsilon") for n in range(120)]
    rows += [(None, "alpha of no id"), (7, None), (8, ""), (9, "  12 "), (9, "  12 ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as word")
    for drop in (0, 3, 97):
        assert {r.word: r.n for r in variants.counted_words(docs, drop_one_in=drop).collect()} == counted(rows, drop)
    few = variants.frequent_words(docs, least_letters=6, least_count=50)
    assert {r.word: r.n for r in few.collect()} == {w: n for w, n in counted(rows, 0).items() if len(w) > 5 and n >= 50}
    assert variants.spelling_variants(variants.frequent_words(docs.limit(0))).collect() == []


@pytest.mark.parametrize("symbols", [2, 8])
def test_variants_of_random_words(spark, symbols):
    rng = random.Random(symbols)
    words = {"".join(rng.choices("abcàÿé", k=rng.randint(1, 6))) for _ in range(400)}
    words |= {"a" * n for n in range(1, 12)} | {"ab" * n for n in range(1, 6)}
    # on both sides of the length up to which words are carried, and far beyond
    for base in ("q" * 62, "qr" * 32, "".join(rng.choices("xyz", k=5000))):
        words |= {base, base + "q", base + "qq", base[1:], "z" + base, base[:-1] + "é", base[:3] + base[4:], base[:30] + "é" + base[31:]}
    counts = {w: rng.choice([1, 2, 2, 4, 9, 20]) for w in sorted(words)}
    table = spark.createDataFrame([*counts.items(), (None, 4), ("", 9), ("aaa", 1)], "word string, n long").selectExpr("*", "'x' as key", "'y' as id")
    assert got(variants.spelling_variants(table, symbols=symbols)) == judged(counts | {"aaa": max(1, counts["aaa"])})
    with pytest.raises(ValueError):
        variants.spelling_variants(table, ratio=1)


def test_a_crowded_reduced_word(spark):
    """Thousands of words of one reduced word: pairs come out once, in any partition."""
    letters = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xE0, 0x100))]
    words = ["".join((a, b, c, "oooo")) for a in letters[:14] for b in letters[:14] for c in letters[:14]]
    counts = {w: n for n, w in enumerate(words, 1)}
    rows = got(variants.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), symbols=1))
    assert all(r[3] == 39 for r in rows.values()) and len(rows) == 14**3
    assert all(r[1] == w if r[0] is None else rows[r[0]][2] >= 2 * r[2] for w, r in rows.items())


def test_neighbour_keys_meet_once():
    words = ["abcde", "abde", "abcdf", "bcde"]
    own, near_keys, owner = variants.reduced_keys(words, 8)
    for a in range(4):
        for b in range(4):
            times = int(np.sum(near_keys[owner == a] == own[b])) + int(np.sum(near_keys[owner == b] == own[a]))
            assert a == b or times + (own[a] == own[b]) == near(words[a], words[b])


def test_query_agrees_with_brute_force(spark, tmp_path):
    rng = random.Random(5)
    syllables = ["an", "er", "th", "é", "on", "ing"]
    pool = ["".join(rng.choices(syllables, k=rng.randint(2, 4))) for _ in range(150)]
    rows = [(n, " ".join(rng.choices(pool, k=80)).title()) for n in range(100)] + [(None, " ".join(pool)), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {w: n for w, n in counted(rows, 97).items() if len(w) >= 5 and n >= 3}
    assert got(queries.op11_spelling_variants(spark, str(tmp_path))) == judged(want)
