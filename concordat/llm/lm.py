"""Masked pseudo-likelihood scores by a small bidirectional window network, trained on the corpus itself."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settings
from .common import stored

#: Words fall into CLASSES of MEMBERS each, or into groups of such classes where the vocabulary is larger; the last BUCKETS
#: ids stand for all other words, by hash.
CLASSES, MEMBERS, BUCKETS = 32, 32, 64
#: A word is in the vocabulary if it occurs LEAST times and SHARE of the square root of all tokens.
LEAST, SHARE = 20, 0.05
#: Numbers of a piece of the weights, as tasks send them, and partial averages of each.
PIECE, SLOTS = 1 << 14, 256
#: Bytes of text that are split at once, and numbers of the weights that are changed at once.
SLICE_BYTES, BLOCK = 1 << 25, 1 << 16
#: Rows of a node that are multiplied on their own, and rows of a node that are so few that each is multiplied by itself.
LARGE, FEW = 24, 6
#: Words on either side, size of a word's vector, size of the hidden layer.
SIDE, VECTOR, HIDDEN = 2, 16, 32
WORDS = CLASSES * MEMBERS
LOCAL_MAP = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"

Weights = dict[str, np.ndarray]


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def split_slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Slices of ``texts`` of SLICE_BYTES or so: the first text, the words of ``tokens_of`` of all, and the number of words of each."""
    rows = max(1, min(len(texts), len(texts) * SLICE_BYTES // max(1, texts.nbytes)))
    for start in range(0, len(texts), rows):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(start, rows).fill_null("")))
        words = lists.flatten()
        edges = lists.offsets.to_numpy()
        edges = edges - edges[0]
        # where a text begins or ends with a blank, its first or last word is empty
        empty = pc.indices_nonzero(pc.equal(words, "")).to_numpy()
        if len(empty):
            words = words.filter(pc.not_equal(words, ""))
        yield start, words, np.diff(edges - np.searchsorted(empty, edges))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, _ in split_slices(batch.column(0)):
                found = pc.value_counts(words)
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def split_words(docs: DataFrame) -> tuple[list[str], DataFrame, dict[int, int]]:
    """The vocabulary by counts, most frequent first; (word, log_share) of all other words; the tokens of each bucket.

    The count that makes a word one of the vocabulary follows the square root of all tokens, so the vocabulary (and what
    the driver and each task hold) grows with the corpus, but slower. ``log_share`` is log P(word | bucket) over all texts.
    """
    counts = stored(word_counts(docs))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, math.ceil(SHARE * math.sqrt(total)))
    words = [r["word"] for r in counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").collect()]
    rest = counts.where(F.col("n") < least).withColumn("bucket", F.crc32(F.encode("word", "utf-8")) % BUCKETS)
    tokens = {r["bucket"]: r["n"] for r in rest.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    logs = F.array(*[F.lit(math.log(tokens.get(n, 1))) for n in range(BUCKETS)])
    shares = rest.select("word", (F.log("n") - F.get(logs, F.col("bucket").cast("int"))).alias("log_share"))
    return words, shares, tokens


def shape_of(words: int) -> tuple[int, int, int]:
    """Classes, members of each, and groups of classes: one, or where CLASSES are too few, as many as the cube root needs."""
    members = max(MEMBERS, math.ceil((words + BUCKETS) ** (1 / 3)))
    classes = -(-(words + BUCKETS) // members)
    if classes <= CLASSES:
        return CLASSES, members, 1
    groups = -(-classes // members)
    return groups * members, members, groups


def fresh_weights(seed: int, classes: int = CLASSES, members: int = MEMBERS, groups: int = 1) -> Weights:
    """Weights to begin with. With ``groups``, ``cls`` is of the group and ``mid`` of the class in the group."""
    rng = np.random.default_rng(seed)
    first, each = (classes, 0) if groups == 1 else (groups, classes // groups)
    shapes = {
        "word": (classes * members + 1, VECTOR), "inner": (2 * SIDE * VECTOR, HIDDEN), "inner_b": (HIDDEN,),
        "cls": (HIDDEN, first), "cls_b": (first,), "member": (classes, HIDDEN, members), "member_b": (classes, members),
    }
    if each:
        shapes |= {"mid": (groups, HIDDEN, each), "mid_b": (groups, each)}
    scale = {"word": 0.3, "inner": 0.15, "cls": 0.1, "mid": 0.1, "member": 0.1}
    return {k: (rng.standard_normal(s) * scale.get(k, 0)).astype("float32") for k, s in shapes.items()}


def close_unused(w: Weights, words: int, buckets: Iterable[int]) -> None:
    """No probability for ids that stand for no word, nor for classes and groups of such ids; training leaves them so."""
    used = np.zeros(w["member_b"].size, bool)
    used[:words] = True
    used[[len(used) - BUCKETS + n for n in buckets]] = True
    for name in ("member_b", "mid_b", "cls_b"):
        if name in w:
            used = used.reshape(w[name].shape)
            w[name][~used] = -1e30
            used = used.any(-1)


def numbered(texts: pa.Array, words: pa.Array, total: int = WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """By slices: word ids of all texts in one array, the number of words of each, and what is not of ``words``.

    That is a list of (word, times) for each text.
    """
    pairs = pa.list_(pa.struct([("word", pa.string()), ("times", pa.int32())]))
    for _, tokens, sizes in split_slices(texts):
        found = pc.index_in(tokens, value_set=words)
        ids = found.fill_null(-1).to_numpy(zero_copy_only=False).astype("int32")
        other = np.flatnonzero(ids < 0)
        coded = tokens.take(pa.array(other)).dictionary_encode()
        names, number = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype("int64")
        crcs = np.fromiter(map(zlib.crc32, names.cast(pa.binary()).to_numpy(zero_copy_only=False)), "int64", len(names)) % BUCKETS
        ids[other] = total - BUCKETS + crcs[number] if len(other) else 0
        text = np.repeat(np.arange(len(sizes)), sizes)[other]
        each, times = np.unique(text * max(1, len(names)) + number, return_counts=True)
        edges = np.searchsorted(each, np.arange(len(sizes) + 1) * max(1, len(names)))
        rows = pa.StructArray.from_arrays([names.take(pa.array(each % max(1, len(names)))), pa.array(times, pa.int32())], ["word", "times"])
        yield ids, sizes, pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rows).cast(pairs)


def joined(others: pa.Array) -> pa.Array:
    """Lists of (word, times) as texts: all words with a space between them, as often as they occur."""
    pairs = others.flatten()
    times = pairs.field("times").to_numpy()
    ends = np.concatenate([[0], np.cumsum(times)])
    edges = others.offsets.to_numpy()
    words = pairs.field("word").take(pa.array(np.repeat(np.arange(len(times)), times)))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends[edges - edges[0]], pa.int32()), words), " ")


def numbered_texts(docs: DataFrame, words: list[str], total: int, id_column: str = "text") -> DataFrame:
    """(id, line, ids, others) of every row: a number of the row, its word ids in ``total``, what is not of ``words``.

    ``others`` are words with a space between them, as often as they occur: a text costs Spark less than a list of pairs. Ids are unsigned numbers of two bytes, or four where ``total`` needs them.
    """
    whole, known = id_type(total), pa.array(words, pa.string())
    docs = docs.select(F.col(f"`{id_column}`").alias("id"), F.col("text").cast("string").alias("text"))
    fields = f"id {docs.schema['id'].dataType.simpleString()}, line long, ids binary, others string"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            start = 0
            for ids, sizes, others in numbered(batch.column(1), known, total):
                edges = np.concatenate([[0], np.cumsum(sizes)]) * np.dtype(whole).itemsize
                data = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges.astype("<i4")), pa.py_buffer(ids.astype(whole))])
                values = [batch.column(0).slice(start, len(sizes)), pa.array(np.arange(first, first + len(sizes))), data, joined(others)]
                start, first = start + len(sizes), first + len(sizes)
                yield pa.RecordBatch.from_arrays(values, ["id", "line", "ids", "others"])

    return docs.mapInArrow(number, fields)


def id_type(total: int) -> str:
    return "<u2" if total < 1 << 16 else "<u4"


def with_blanks(ids: Iterable[bytes], total: int) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of all texts in one array, SIDE blanks around each text, and the number of words of each."""
    texts = [np.frombuffer(x, id_type(total)) for x in ids]
    sizes = np.array([len(x) for x in texts], "int64")
    flat = np.full(sizes.sum() + SIDE * (len(texts) + 1), total, "int32")
    if texts:
        flat[places_of(sizes)[0]] = np.concatenate(texts)
    return flat, sizes


def levels_of(w: Weights, ids: np.ndarray) -> list[tuple[str, np.ndarray | None, np.ndarray]]:
    """From the top: the name of the weights, the node each of ``ids`` passes (none: the only one), and the way it takes there."""
    members = w["member_b"].shape[1]
    node = ids // members
    last = ("member", node, ids - node * members)
    if "mid" not in w:
        return [("cls", None, node), last]
    each = w["mid_b"].shape[1]
    group = node // each
    return [("cls", None, group), ("mid", group, node - group * each), last]


def edges_of(node: np.ndarray, nodes: int) -> np.ndarray:
    """Where each of ``nodes`` begins among the sorted ones."""
    return np.concatenate([[0], np.cumsum(np.bincount(node, minlength=nodes))])


def by_word(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The order of places by their words. Numbers of two bytes are sorted by their digits, which is faster."""
    words = flat.take(at)
    return words.astype("<u2").argsort(kind="stable") if words.size and words.max() < 1 << 16 else words.argsort()


def around_of(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The words around each place."""
    return np.stack([flat.take(at + d) for d in (*range(-SIDE, 0), *range(1, SIDE + 1))], 1)


def hidden_of(w: Weights, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of the words around in a row, the hidden layer."""
    near = w["word"].take(around, 0).reshape(len(around), -1)
    hidden = near @ w["inner"]
    hidden += w["inner_b"]
    # tanh(x) as 1 - 2 / (exp(2 x) + 1), as numpy's own takes twice the time; where exp is infinite this is 1
    hidden *= 2
    with np.errstate(over="ignore"):
        np.exp(hidden, out=hidden)
    hidden += 1
    np.divide(-2, hidden, out=hidden)
    hidden += 1
    return near, hidden


def exponentials(x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray | float, np.ndarray]:
    """exp of ``x`` less what its rows are lowered by, in place; that, and the sums of the rows.

    Rows are lowered by their largest value only if some value is too large for exp, or ``own``, one of each row, so small
    that all of its row may be.
    """
    down: np.ndarray | float = 0.0
    if x.size and (x.max() > 60 or own.min() < -60):
        down = x.max(-1, keepdims=True)
        x -= down
        down = down[..., 0]
    np.exp(x, out=x)
    return x, down, x @ np.ones(x.shape[-1], x.dtype)


def blocks_of(edges: Sequence[int] | np.ndarray, below: float = math.inf, above: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Classes with about as many rows each, to be multiplied at once: the classes, their rows, filled up, and which are filled.

    Rows are in class order; class c has those from ``edges[c]`` to ``edges[c + 1]``. Classes with ``below`` rows or more, or ``above`` or fewer, are left out.
    """
    starts, sizes = np.asarray(edges[:-1]), np.diff(edges)
    order = sizes.argsort(kind="stable")[::-1]
    order = order[np.count_nonzero(sizes >= below) : np.count_nonzero(sizes > above)]
    while len(order):
        most = sizes[order[0]]
        end = int(np.searchsorted(-sizes[order], -0.5 * most, side="right"))
        some, order = order[:end], order[end:]
        spots = np.arange(most)
        filled = spots >= sizes[some][:, None]
        yield some, starts[some][:, None] + np.where(filled, 0, spots), filled


def log_probability(hidden: np.ndarray, weight: np.ndarray, bias: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    x = hidden @ weight
    x += bias
    return log_shares(x, chosen)


def log_shares(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """log of the softmax of ``chosen`` in each row of ``x``, which is overwritten."""
    own = np.take_along_axis(x, chosen[..., None], -1)[..., 0]
    _, down, sums = exponentials(x, own)
    return own - down - np.log(sums)


class Few:
    """Products of the rows of nodes that have one to FEW rows, vector by matrix, which has less of a call than matrix by matrix.

    Nodes with equally many rows are neighbours in all arrays here, so a block of them is a view and nothing is filled up.
    """

    def __init__(self, hidden: np.ndarray, edges: np.ndarray, w: np.ndarray):
        starts, sizes = edges[:-1], np.diff(edges)
        self.node = np.flatnonzero((sizes > 0) & (sizes <= FEW))
        self.node = self.node[sizes[self.node].argsort(kind="stable")]
        sizes = sizes[self.node]
        nodes, ends = (np.searchsorted(x, np.arange(1, FEW + 2)).tolist() for x in (sizes, np.repeat(sizes, sizes)))
        self.blocks = [(c, slice(*n), slice(*r)) for c, n, r in zip(range(1, FEW + 1), pairwise(nodes), pairwise(ends), strict=True) if n[0] < n[1]]
        self.rows = np.arange(ends[-1]) + np.repeat(starts[self.node] - np.cumsum(sizes) + sizes, sizes)
        self.hidden, self.w = hidden.take(self.rows, 0), w.take(self.node, 0)

    def forward(self, d: np.ndarray) -> None:
        out = np.empty((len(self.rows), self.w.shape[2]), d.dtype)
        for c, n, r in self.blocks:
            np.matmul(self.hidden[r].reshape(-1, c, 1, self.w.shape[1]), self.w[n, None], out=out[r].reshape(-1, c, 1, self.w.shape[2]))
        d[self.rows] = out

    def backward(self, d: np.ndarray, back: np.ndarray, g: np.ndarray, g_bias: np.ndarray) -> None:
        d, inner, outer = d.take(self.rows, 0), self.w.shape[1], self.w.shape[2]
        out, g_w, g_b = np.empty_like(self.hidden), np.empty_like(self.w), np.empty((len(self.node), outer), d.dtype)
        for c, n, r in self.blocks:
            some, near = d[r].reshape(-1, c, outer), self.hidden[r].reshape(-1, c, inner).transpose(0, 2, 1)
            np.matmul(some[:, :, None], self.w[n, None].transpose(0, 1, 3, 2), out=out[r].reshape(-1, c, 1, inner))
            # numpy has no fast product of a single column and a single row
            (np.multiply if c == 1 else np.matmul)(near, some, out=g_w[n])
            np.matmul(np.ones(c, d.dtype), some, out=g_b[n])
        back[self.rows], g[self.node], g_bias[self.node] = out, g_w, g_b


class Products:
    """Products of the rows of a level with the weights of their nodes: of a large node on their own, of small nodes by ``blocks_of``
    or as ``Few``.

    Rows of a node are neighbours. Rows that fill up a block repeat the first one of their node, so what is written twice is the same.
    """

    def __init__(self, hidden: np.ndarray, node: np.ndarray, w: np.ndarray):
        edges = edges_of(node, len(w))
        sizes = np.diff(edges)
        large = np.flatnonzero(sizes >= LARGE)
        self.large = list(zip(large.tolist(), edges[large].tolist(), edges[large + 1].tolist(), strict=True))
        self.small = [(n, rows, filled, hidden.take(rows, 0), w.take(n, 0)) for n, rows, filled in blocks_of(edges, LARGE, FEW)]
        self.few = Few(hidden, edges, w)
        self.unused = np.flatnonzero(sizes == 0)
        self.hidden, self.node, self.w = hidden, node, w

    def forward(self, bias: np.ndarray) -> np.ndarray:
        d = np.empty((len(self.hidden), self.w.shape[2]), self.w.dtype)
        for n, a, b in self.large:
            np.matmul(self.hidden[a:b], self.w[n], out=d[a:b])
        for _, rows, _, near_hidden, weight in self.small:
            d[rows] = near_hidden @ weight
        self.few.forward(d)
        d += bias.take(self.node, 0)
        return d

    def backward(self, d: np.ndarray, g: np.ndarray, g_bias: np.ndarray) -> np.ndarray:
        """Gradients of weights and biases into ``g`` and ``g_bias``; those of the hidden layer are returned."""
        g[self.unused] = g_bias[self.unused] = 0
        back = np.empty_like(self.hidden)
        for n, a, b in self.large:
            np.matmul(d[a:b], self.w[n].T, out=back[a:b])
            np.matmul(self.hidden[a:b].T, d[a:b], out=g[n])
            np.matmul(np.ones(b - a, d.dtype), d[a:b], out=g_bias[n])
        for n, rows, filled, near_hidden, weight in self.small:
            some = d.take(rows, 0)
            back[rows] = some @ weight.transpose(0, 2, 1)
            some[filled] = 0
            g[n], g_bias[n] = near_hidden.transpose(0, 2, 1) @ some, np.ones(some.shape[1], some.dtype) @ some
        self.few.backward(d, back, g, g_bias)
        return back


def log_probabilities(w: Weights, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log P(word | words on both sides) at each place: that of its class, by way of its group, then of the word in the class."""
    out = np.empty(len(at), "float64")
    for s in range(0, len(at), 16384):
        some = at[s : s + 16384]
        order = by_word(flat, some)
        some = some[order]
        _, hidden = hidden_of(w, around_of(flat, some))
        total = np.zeros(len(some))
        for name, node, way in levels_of(w, flat[some]):
            weight, bias = w[name], w[name + "_b"]
            if node is None:
                total += log_probability(hidden, weight, bias, way)
            else:
                total += log_shares(Products(hidden, node, weight).forward(bias), way)
        out[s + order] = total
    return out


def distinct(ids: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of ``ids``, which are below ``total``, and the place of each of ``ids`` among them."""
    place = np.zeros(total, "int64")
    place[ids] = 1
    found = np.flatnonzero(place)
    place[found] = np.arange(len(found))
    return found, place.take(ids)


class Trainer:
    """Adam on batches of masked places, from given weights."""

    def __init__(self, weights: Weights, rate: float = 0.02):
        # all weights in one array, so that Adam goes through them by blocks that a processor's cache holds
        self.all = np.concatenate([v.ravel() for v in weights.values()])
        self.m, self.v, self.change = (np.zeros_like(self.all) for _ in range(3))
        self.w, self.g = ({}, {})
        start = 0
        for k, x in weights.items():
            for whole, views in ((self.all, self.w), (self.change, self.g)):
                views[k] = whole[start : start + x.size].reshape(x.shape)
            start += x.size
        self.rate, self.steps, self.places, self.grown = rate, 0, 0, 1.0

    def step(self, flat: np.ndarray, at: np.ndarray) -> None:
        w, g = self.w, self.g
        at = at[by_word(flat, at)]
        around = around_of(flat, at)
        near, hidden = hidden_of(w, around)
        d_hidden = np.zeros_like(hidden)
        for name, node, way in levels_of(w, flat.take(at)):
            self._level(name, node, way, hidden, d_hidden, np.float32(0.1 / len(at) * self.grown))
        d_hidden *= 1 - hidden * hidden
        g["inner"][:], g["inner_b"][:] = near.T @ d_hidden, np.ones(len(at), d_hidden.dtype) @ d_hidden
        words, spots = distinct(around.reshape(-1), len(w["word"]))
        # two numbers are added at once, as the parts of a complex one
        pair, sums = np.result_type(d_hidden, "c8"), np.zeros((len(words), VECTOR), d_hidden.dtype)
        for total, values in zip(sums.view(pair).T, (d_hidden @ w["inner"].T).reshape(-1, VECTOR).view(pair).T, strict=True):
            np.add.at(total, spots, values)
        g["word"][:] = 0
        g["word"][words] = sums
        self.steps += 1
        self.places += len(at)
        self._adam()

    def _level(self, name: str, node: np.ndarray | None, way: np.ndarray, hidden: np.ndarray, d_hidden: np.ndarray, scale: np.float32) -> None:
        """Gradients of the weights of a level, times ``scale``; what they pass to the hidden layer is added to ``d_hidden``."""
        w, bias, g, g_bias = (x[k] for x in (self.w, self.g) for k in (name, name + "_b"))
        if node is None:
            d = hidden @ w
            d += bias
        else:
            products = Products(hidden, node, w)
            d = products.forward(bias)
        own = np.arange(0, d.size, d.shape[1]) + way
        numbers = d.reshape(-1)
        _, _, sums = exponentials(d, numbers[own])
        d *= (scale / sums)[:, None]
        numbers[own] -= scale
        if node is None:
            d_hidden += d @ w.T
            g[:], g_bias[:] = hidden.T @ d, np.ones(len(way), d.dtype) @ d
        else:
            d_hidden += products.backward(d, g, g_bias)

    def _adam(self) -> None:
        """From gradients that are a tenth of the mean of the batch, times ``grown``.

        Instead of the mean of squares that decays by 0.99 a step, the squares grow by as much, which saves a pass: gradients and their
        mean ``m`` are times ``grown``, the mean of squares ``v`` is times its square. What they change is the same.
        """
        known = math.sqrt(1 - 0.99**self.steps)
        rate = self.rate * known / (1 - 0.9**self.steps)
        decay = 0.9 / math.sqrt(0.99)
        for s in range(0, len(self.all), BLOCK):
            w, m, v, x = (a[s : s + BLOCK] for a in (self.all, self.m, self.v, self.change))
            m *= decay
            m += x
            x *= x  # a hundredth of the square
            v += x
            np.sqrt(v, out=x)
            x += 1e-6 * known * self.grown
            np.divide(m, x, out=x)
            x *= rate
            w -= x
        self.grown /= math.sqrt(0.99)
        if self.grown > 1000:
            self.m /= self.grown
            self.v /= self.grown**2
            self.grown = 1.0


def places_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of all texts are in the array of ``numbered``, and the place in its text of each."""
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(np.cumsum(sizes) - sizes + SIDE * np.arange(1, len(sizes) + 1), sizes) + within, within


def masked_places(sizes: np.ndarray, turn: int, stride: int) -> np.ndarray:
    """The places masked in a round: one in ``stride`` of each text; ``stride`` rounds on end mask each place once."""
    at, within = places_of(sizes)
    return at[(within + np.repeat(np.arange(len(sizes)), sizes)) % stride == turn % stride]


def trained_weights(
    docs: DataFrame, words: list[str], rounds: int = 1, stride: int = 1, batch: int = 4096, seed: int = 7, buckets: Iterable[int] = range(BUCKETS)
) -> Weights:
    """Weights after ``rounds`` passes over the whole corpus, see ``trained_on``."""
    shape = shape_of(len(words))
    return trained_on(numbered_texts(docs, words, shape[0] * shape[1]), words, rounds, stride, batch, seed, buckets)


def trained_on(
    texts: DataFrame, words: list[str], rounds: int = 1, stride: int = 1, batch: int = 4096, seed: int = 7, buckets: Iterable[int] = range(BUCKETS)
) -> Weights:
    """Weights after ``rounds`` passes over all ``numbered_texts``, each partition on its own and then averaged.

    In every text one word in ``stride`` is masked, another one in each round, so as many rounds as ``stride`` predict
    every word of every text (see ``masked_places``). A task trains from the common weights
    on all its texts; Spark averages the tasks' weights by masked places, piece by piece, in SLOTS sums first, so no group
    has a row of every task, and the driver gets one number a weight. The passes are finished before scoring starts.
    ``buckets`` are those that words fall into.
    """
    weights = fresh_weights(seed, *shape_of(len(words)))
    close_unused(weights, len(words), buckets)
    names = list(weights)
    for turn in range(rounds):

        def train(batches: Iterator[pd.DataFrame], weights: Weights = weights, turn: int = turn) -> Iterator[pd.DataFrame]:
            trainer = Trainer(weights)
            for part in batches:
                for s in range(0, len(part), 1024):
                    flat, sizes = with_blanks(part["ids"].iloc[s : s + 1024], len(weights["word"]) - 1)
                    masked = np.random.default_rng(turn).permutation(masked_places(sizes, turn, stride))
                    for b in range(0, len(masked), batch):
                        trainer.step(flat, masked[b : b + batch])
            if trainer.places:
                value = np.concatenate([trainer.w[k].ravel() for k in names])
                pieces = [value[s : s + PIECE].astype("<f4").tobytes() for s in range(0, len(value), PIECE)]
                slot = TaskContext.get().partitionId() % SLOTS
                yield pd.DataFrame({"piece": np.arange(len(pieces)), "slot": slot, "value": pieces, "places": trainer.places})

        def average(rows: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(v, "<f4").astype("float64") * n for v, n in zip(rows["value"], rows["places"], strict=True))
            mean = (total / rows["places"].sum()).astype("<f4").tobytes()
            return rows.iloc[:1].assign(value=[mean], places=rows["places"].sum())

        fields = "piece int, slot int, value binary, places long"
        sent = texts.select("ids").mapInPandas(train, fields)
        means = sent.groupBy("piece", "slot").applyInPandas(average, fields).groupBy("piece").applyInPandas(average, fields).collect()
        if not means:
            return weights
        mean = np.frombuffer(b"".join(bytes(r["value"]) for r in sorted(means, key=lambda r: r["piece"])), "<f4")
        cuts = np.cumsum([weights[k].size for k in names])[:-1]
        weights = {k: v.reshape(weights[k].shape) for k, v in zip(names, np.split(mean, cuts), strict=True)}
    return weights


def pseudo_likelihood(docs: DataFrame, words: list[str], weights: Weights, id_column: str = "doc_id", shares: DataFrame | None = None) -> DataFrame:
    """(id, n_tokens, log_likelihood, mean_log_likelihood) of every row: sums of log P(word | both sides), in nats.

    A word that is not one of ``words`` has the probability of its bucket, times its share of the bucket by ``shares``
    (word, log_share), which is joined: the tasks hold no table of them. Without ``shares`` it is the bucket's alone.

    A null text and one without words have 0 tokens, sum 0 and a null mean. Repeated rows get equal scores, but for
    rounding. Other columns are ignored.
    """
    texts = numbered_texts(docs, words, weights["member_b"].size, id_column)
    return likelihood_of(texts if shares is None else stored(texts), weights, shares, id_column)


def likelihood_of(texts: DataFrame, weights: Weights, shares: DataFrame | None, id_column: str) -> DataFrame:
    """``pseudo_likelihood`` of rows (id, line, ids, others). With ``shares`` they are read twice."""
    kind = texts.schema["id"].dataType.simpleString()
    total = weights["member_b"].size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for s in range(0, part.num_rows, 256):
                some = part.slice(s, 256)
                flat, sizes = with_blanks(some.column(2).to_pylist(), total)
                at, _ = places_of(sizes)
                sums = np.bincount(np.repeat(np.arange(len(sizes)), sizes), log_probabilities(weights, flat, at), len(sizes))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(sizes), pa.array(sums)], ["id", "line", "n_tokens", "sums"])

    scored = texts.select("id", "line", "ids").mapInArrow(score, f"id {kind}, line long, n_tokens long, sums double")
    sums = F.col("sums")
    if shares is not None:
        each = texts.where("others <> ''").select("line", F.explode(F.split("others", " ")).alias("word")).join(shares, "word")
        more = each.groupBy("line").agg(F.sum("log_share").alias("more"))
        # partitions of words that a task can hold are looked up in hash tables and not sorted
        spark = texts.sparkSession
        with settings(spark, {LOCAL_MAP: spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")}):
            more = stored(more)
        scored, sums = scored.join(more, "line", "left"), sums + F.coalesce("more", F.lit(0.0))
    scored = scored.select(F.col("id").alias(id_column), "n_tokens", F.round(sums, 3).alias("log_likelihood"))
    return scored.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.round(F.col("log_likelihood") / F.col("n_tokens"), 5)))


def score_documents(docs: DataFrame, id_column: str = "doc_id", **training) -> DataFrame:
    """Train on ``docs`` and score them: log_likelihood is of the words themselves, rare ones too. Word ids are stored once for both."""
    words, shares, tokens = split_words(docs)
    classes, members, _ = shape_of(len(words))
    texts = stored(numbered_texts(docs, words, classes * members, id_column))
    weights = trained_on(texts, words, buckets=tokens, **training)
    return likelihood_of(texts, weights, shares, id_column)
