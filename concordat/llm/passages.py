"""Quality of documents by attention over their passages: a bag of encoded passages, gated weights, one score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .variants import BASE, INVERSE, mixed

#: Words of a passage; bytes that are encoded at once, longer texts between words; buckets of hashed words.
WIDTH, SLICE, BUCKETS = 48, 1 << 19, 64
#: Sizes of the encoded passage and of the attention's inner layer.
HIDDEN, INNER = 24, 16
#: Bytes of one kind; the first two are white space, bytes of letters beyond ASCII are the last.
KINDS = (b"\x20\x09\x0b\x0c\r", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,", b";:", b"!?", b"#$%&*", b"|<>=_~^\\/+", b"'\"()[]{}-", bytes(range(128, 256)))
KIND = np.full(256, len(KINDS), "uint8")
for _n, _kind in enumerate(KINDS):
    KIND[np.frombuffer(_kind, "u1")] = _n
LOWER = np.arange(256, dtype="uint64")
LOWER[ord("A") : ord("Z") + 1] += 32
#: Shares of the other kinds, eight figures of words, buckets.
FEATURES = len(KINDS) - 1 + 8 + BUCKETS

Weights = dict[str, np.ndarray]


def pieces_of(text: bytes) -> list[bytes]:
    """A text in pieces of SLICE bytes at most, cut at spaces where there are any."""
    pieces, start = [], 0
    while len(text) - start > SLICE:
        end = text.rfind(b" ", start + 1, start + SLICE)
        end = start + SLICE if end < 0 else end
        pieces.append(text[start:end])
        start = end
    return [*pieces, text[start:]]


def encoded(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the pieces (WIDTH words each, the last may have fewer), and the piece of each."""
    data = np.frombuffer(b" " + b" ".join(pieces) + b" ", "u1")
    kind = KIND[data]
    blank = kind < 2
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    if not len(starts):
        return np.zeros((0, FEATURES), "float32"), np.zeros(0, "int64")
    sizes = np.array([len(p) + 1 for p in pieces])
    piece = np.searchsorted(np.cumsum(sizes), starts, "left")
    first = np.searchsorted(piece, np.arange(len(pieces)))
    place = np.arange(len(starts)) - first[piece]
    opens = (place % WIDTH == 0)
    passage = np.cumsum(opens) - 1
    heads = np.flatnonzero(opens)
    tails = np.r_[heads[1:], len(starts)] - 1
    words = (tails - heads + 1).astype("float64")

    counts = np.empty((len(heads), len(KINDS)))
    for n, other in enumerate((1, *range(2, len(KINDS) + 1))):
        seen = np.cumsum(kind == other, dtype="int32")
        counts[:, n] = seen[ends[tails] - 1] - seen[starts[heads] - 1]
    shares = counts[:, 1:] / (ends[tails] - starts[heads])[:, None]

    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(data), BASE, "uint64")])
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(data), INVERSE, "uint64")])
    run = np.r_[np.uint64(0), np.cumsum(LOWER[data] * powers[:-1])]
    hashed = mixed((run[ends] - run[starts]) * back[starts])
    again = np.r_[False, (hashed[1:] == hashed[:-1])] & (place > 0)
    other_again = np.r_[[False] * min(2, len(hashed)), (hashed[2:] == hashed[:-2])] & (place > 1)
    distinct = np.unique((passage.astype("uint64") << np.uint64(40)) | (hashed >> np.uint64(24))) >> np.uint64(40)
    length = ends - starts

    def per_passage(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, values, len(heads)) / words

    figures = [
        per_passage(length / 8), per_passage(length > 15), per_passage(kind[starts] == 3), per_passage(again), per_passage(other_again),
        np.bincount(distinct.astype("int64"), minlength=len(heads)) / words, words / WIDTH, counts[:, 0] / words,
    ]
    bucket = passage * BUCKETS + (hashed % np.uint64(BUCKETS)).astype("int64")
    buckets = np.bincount(bucket, minlength=len(heads) * BUCKETS).reshape(-1, BUCKETS) / np.sqrt(words)[:, None]
    return np.hstack([shares, np.stack(figures, 1), buckets]).astype("float32"), piece[heads]


def bags_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, passages of each text) for some texts after the other; a text without words is one blank passage."""
    waiting: list[tuple[int, bytes]] = []
    rows, owners, size, done = [], [], 0, 0

    def encode() -> None:
        found, piece = encoded([p for _, p in waiting])
        rows.append(found)
        owners.append(np.array([n for n, _ in waiting], "int64")[piece])
        waiting.clear()

    for n, text in enumerate(texts):
        for piece in pieces_of(text):
            waiting.append((n, piece))
            size += len(piece)
            if size >= SLICE:
                encode()
                size = 0
        if len(rows) >= 16 or n == len(texts) - 1:
            encode()
            size = 0
            x, owner = np.concatenate(rows), np.concatenate(owners) - done
            times = np.bincount(owner, minlength=n + 1 - done)
            blank = np.flatnonzero(times == 0)
            x, owner = np.vstack([x, np.zeros((len(blank), FEATURES), "float32")]), np.r_[owner, blank]
            yield x[owner.argsort(kind="stable")], np.maximum(times, 1)
            rows, owners, done = [], [], n + 1


def fresh_weights(seed: int = 5) -> Weights:
    rng = np.random.default_rng(seed)
    shapes = {"in": (FEATURES, HIDDEN), "in_b": (HIDDEN,), "v": (HIDDEN, INNER), "u": (HIDDEN, INNER), "w": (INNER,), "out": (HIDDEN,), "out_b": ()}
    return {k: rng.standard_normal(s) * (0 if k.endswith("_b") else (s[0] ** -0.5)) for k, s in shapes.items()}


def logits(w: Weights, z: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Of bags of standardised passages: the score before the logistic function, and what gradients need."""
    edges, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    h = np.tanh(z @ w["in"] + w["in_b"])
    t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
    e = (t * g) @ w["w"]
    e = np.exp(e - np.maximum.reduceat(e, edges)[bag])
    a = e / np.add.reduceat(e, edges)[bag]
    whole = np.add.reduceat(a[:, None] * h, edges)
    return whole @ w["out"] + w["out_b"], {"h": h, "t": t, "g": g, "a": a, "whole": whole, "bag": bag, "edges": edges}


def gradients(w: Weights, z: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> Weights:
    """Of the mean logistic loss."""
    score, s = logits(w, z, sizes)
    d = (1 / (1 + np.exp(-score)) - labels) / len(labels)
    h, t, g, a, bag = s["h"], s["t"], s["g"], s["a"], s["bag"]
    d_whole = (d[:, None] * w["out"])[bag]
    d_a = (d_whole * h).sum(1)
    d_e = a * (d_a - np.add.reduceat(a * d_a, s["edges"])[bag])
    d_t, d_g = d_e[:, None] * w["w"] * g * (1 - t * t), d_e[:, None] * w["w"] * t * g * (1 - g)
    d_h = (a[:, None] * d_whole + d_t @ w["v"].T + d_g @ w["u"].T) * (1 - h * h)
    return {
        "in": z.T @ d_h, "in_b": d_h.sum(0), "v": h.T @ d_t, "u": h.T @ d_g, "w": (t * g).T @ d_e, "out": s["whole"].T @ d, "out_b": d.sum(),
    }


def fitted(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, rounds: int = 40, batch: int = 128, rate: float = 0.005, decay: float = 1e-3, seed: int = 5) -> Weights:
    """Weights by Adam over shuffled batches of bags, with the mean and spread of each feature."""
    w = fresh_weights(seed)
    mean, spread = x.mean(0, "float64"), x.std(0, dtype="float64") + 1e-3
    z = (x - mean) / spread
    edges = np.cumsum(sizes) - sizes
    m, v = ({k: np.zeros_like(p) for k, p in w.items()} for _ in range(2))
    rng, step = np.random.default_rng(seed), 0
    for turn in range(rounds):
        order = rng.permutation(len(sizes))
        for s in range(0, len(order), batch):
            some = order[s : s + batch]
            rows = np.concatenate([np.arange(edges[n], edges[n] + sizes[n]) for n in some])
            step += 1
            for k, d in gradients(w, z[rows], sizes[some], labels[some]).items():
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                w[k] = w[k] * (1 - rate * decay) - rate * (1 - turn / rounds) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return w | {"mean": mean, "spread": spread}


def scores(w: Weights, texts: list[bytes]) -> np.ndarray:
    """The probability of label 1 of each text; without weights one half."""
    if not w:
        return np.full(len(texts), 0.5)
    parts = [1 / (1 + np.exp(-logits(w, (x - w["mean"]) / w["spread"], sizes)[0])) for x, sizes in bags_of(texts)]
    return np.concatenate([np.zeros(0), *parts])


def remainder(key: Column) -> Column:
    """CRC-32 of an id as text modulo 4; a null id counts as empty."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4


def utf8(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def learned(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label: str = "quality", train_rows: int = 4000) -> Weights:
    """Weights from labelled documents that are not held out: the ``train_rows`` ids whose hashes come first, whole texts.

    An id with several labels counts by the smallest; null ids and labels are left out. Passages are encoded on Spark;
    the driver gets the features of the sample and fits them. None if nothing is labelled.
    """
    marks = labels.select(F.col(id_column).alias("key"), F.col(label).cast("int").alias("label")).where("key is not null and label is not null")
    marks = marks.where(remainder(F.col("key")) != 2).groupBy("key").agg(F.min("label").alias("label"))
    sample = marks.orderBy(F.xxhash64(F.col("key").cast("string")), "key").limit(train_rows)
    texts = docs.select(F.col(id_column).alias("key"), utf8(F.col("text")).alias("text")).join(sample, "key")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for x, sizes in bags_of(batch.column(2).to_pylist()):
                rows = [r.tobytes() for r in np.split(x, np.cumsum(sizes)[:-1])]
                part = batch.slice(start, len(sizes))
                start += len(sizes)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(rows, pa.binary())], ["key", "label", "bag"])

    found = texts.select(F.col("key").cast("string").alias("key"), "label", "text").mapInArrow(encode, "key string, label int, bag binary").collect()
    if not found:
        return {}
    found.sort(key=lambda r: (r["key"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], "float32").reshape(-1, FEATURES) for r in found]
    return fitted(np.concatenate(bags), np.array([len(b) for b in bags]), np.array([r["label"] for r in found], "float64"))


def scored_documents(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label: str = "quality", threshold: float = 0.7, train_rows: int = 4000
) -> DataFrame:
    """(id, held_out, score, predicted) of every row; scores come from the whole text alone.

    A null text is empty, and an empty text is one blank passage with a score of its own. A null id is not held out.
    Equal texts have equal scores, but for rounding. Other columns are ignored. Without labelled rows all scores are 0.5.
    """
    weights = learned(docs, labels, id_column, label, train_rows)
    kind = docs.schema[id_column].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(weights, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], [id_column, "score"])

    rows = docs.select(F.col(id_column), utf8(F.col("text")).alias("_text")).mapInArrow(score, f"`{id_column}` {kind}, score double")
    held = (remainder(F.col(id_column)) == 2).alias("held_out")
    return rows.select(id_column, held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
