"""The attention classifier: features by brute force, gradients by differences, accuracy on held-out rows, odd tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordat.llm import passages, queries

SF_DIR = "/root/testdata/sf0.01"


def figures(words, gaps, before):
    """Features of a passage of words but for the buckets; ``gaps`` are the bytes between them, ``before`` the words before."""
    text = b"".join(words)
    size = len(text) + len(gaps)
    shares = [sum(b in kind for b in text) / size for kind in passages.KINDS[2:]]
    shares.append(sum(not any(b in k for k in passages.KINDS) for b in text) / size)
    low, n = [w.lower() for w in words], len(words)
    run = [None, None, *(w.lower() for w in before)][-2:] + low
    return shares + [
        sum(map(len, words)) / 8 / n, sum(len(w) > 15 for w in words) / n, sum(w[:1].isupper() for w in words) / n,
        sum(a == b for a, b in zip(run[1:], low)) / n, sum(a == b for a, b in zip(run, low)) / n, len(set(low)) / n, n / passages.WIDTH, gaps.count(b"\n") / n,
    ]


def test_features():
    rng = random.Random(2)
    pool = ["the", "The", "of", "42", "a,b!", "###x$$$", "é", "ÀB", "x" * 20, "(q)", "\x01", "a|b"]
    texts = [" ".join(rng.choices(pool, k=n)).replace(" the ", "\nthe\n") for n in (1, 47, 48, 49, 200)]
    x, sizes = next(iter(passages.bags_of([t.encode() for t in (*texts, "", " \n\t ")])))
    assert sizes.tolist() == [1, 1, 1, 2, 5, 1, 1] and not x[-2:].any() and x.shape[1] == passages.FEATURES
    at = 0
    for text, size in zip(texts, sizes):
        data, words = text.encode(), text.encode().split()
        for k in range(size):
            some = words[k * passages.WIDTH : (k + 1) * passages.WIDTH]
            inner = len(words[: k * passages.WIDTH])
            # the bytes between the words of the passage, one each here
            gaps = bytes(b for b in data if b in b" \n")[inner : inner + len(some) - 1]
            want = figures(some, gaps, words[: k * passages.WIDTH])
            assert [round(float(v), 5) for v in x[at, : len(want)]] == pytest.approx(want, abs=2e-5)
            assert np.isclose(x[at, len(want) :].sum() * np.sqrt(len(some)), len(some))
            at += 1


def test_long_texts_are_whole(monkeypatch):
    text = b"".join(b"word%d " % n for n in range(3000)) + b"y" * 900 + b" end"
    whole = np.concatenate([x for x, _ in passages.bags_of([text, b"b c"])])
    monkeypatch.setattr(passages, "SLICE", 500)
    pieces = passages.pieces_of(text)
    assert b"".join(pieces) == text and max(map(len, pieces)) <= 500
    found = list(passages.bags_of([text, b"b c", b"", text]))
    sizes = np.concatenate([s for _, s in found])
    assert sizes[0] == sizes[3] and sizes[1:3].tolist() == [1, 1] and sum(len(x) for x, _ in found) == sizes.sum()
    words = sum(x[: sizes[0], -passages.BUCKETS - 2].sum() for x, _ in found[:1]) if len(found) == 1 else None
    assert words is None or abs(words - whole[:-1, -passages.BUCKETS - 2].sum()) < 0.2


def test_gradients():
    rng = np.random.default_rng(1)
    z, sizes, labels = rng.standard_normal((12, passages.FEATURES)), np.array([3, 1, 6, 2]), np.array([1.0, 0, 0, 1])
    w = {k: v + 0.1 for k, v in passages.fresh_weights(3).items()}

    def loss(w):
        p = 1 / (1 + np.exp(-passages.logits(w, z, sizes)[0]))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for k, d in passages.gradients(w, z, sizes, labels).items():
        for at in {tuple(rng.integers(0, n) for n in np.shape(w[k])) for _ in range(5)}:
            up, down = ({**w, k: np.array(w[k], dtype=float)} for _ in range(2))
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            assert np.isclose(d[at] if np.ndim(d) else d, (loss(up) - loss(down)) / 2e-5, atol=1e-6)


def test_attention_finds_the_bad_passage():
    """One bad passage among many good ones decides, wherever it is."""
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 30, 600)
    labels = rng.integers(0, 2, 600).astype(float)
    x = rng.standard_normal((sizes.sum(), passages.FEATURES)).astype("float32")
    edges = np.cumsum(sizes) - sizes
    bad = edges + rng.integers(0, sizes)
    x[bad[labels == 0], :6] += 3
    half = edges[300]
    w = passages.fitted(x[:half], sizes[:300], labels[:300])
    score, state = passages.logits(w, (x[half:] - w["mean"]) / w["spread"], sizes[300:])
    assert np.mean((score > 0) == (labels[300:] == 1)) > 0.93
    zeros = (bad[300:] - half)[labels[300:] == 0]
    assert np.mean(state["a"][zeros] * sizes[300:][labels[300:] == 0]) > 3


def test_odd_tables(spark):
    long = "word " * 30_000
    rows = [(n, "### " * 60 if n % 3 else f"all is well with document number {n} " * 9) for n in range(90)]
    rows += [(90, None), (91, ""), (92, long), (92, long), (None, "of no id"), (93, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "2 as label", "3 as key", "'x' as _text")
    marks = [(n, int(n % 3 == 0), None) for n in range(80)] + [(None, 1, 1), (5, None, 1), (7, 1, 0), (1000, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = passages.scored_documents(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found if r.doc_id is not None)
    good = [r for r in found if r.doc_id is not None and r.doc_id < 90]
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in good]) > 0.95
    assert len({round(r.score, 9) for r in found if r.doc_id in (90, 91, 93)}) == 1
    assert passages.scored_documents(docs.limit(0), labels).collect() == []
    unlearned = passages.scored_documents(docs, labels.limit(0)).collect()
    assert len(unlearned) == len(rows) and {r.score for r in unlearned} == {0.5}
    # held-out labels, and columns beside the text, change nothing
    other = labels.withColumn("quality", F.when(passages.remainder(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = passages.scored_documents(docs.withColumn("lang", F.lit("en")), other).collect()
    assert [r.score for r in again] == [r.score for r in found]


@pytest.mark.skipif(not __import__("os").path.exists(SF_DIR), reason="test data not present")
def test_held_out_accuracy(spark):
    got = queries.op12_passage_attention(spark, SF_DIR).where("held_out")
    both = got.join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").collect()
    assert len(both) > 50 and np.mean([r.predicted == r.quality for r in both]) > 0.93
