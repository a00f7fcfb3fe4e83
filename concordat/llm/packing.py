"""Order-preserving packing of documents into token windows by dynamic programming."""

from __future__ import annotations

import base64
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Fixed value: the vocabulary's pre-tokenisation for text in which no two white-space characters meet.
SINGLE_SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"


def encoder(ranks_path: str, pattern: str):
    """(encode, sentence_end) for a byte-level BPE of ranks: ids of a text, and whether an id ends a sentence.

    Runs of white space need the full pattern; other texts give the same ids by the one without look-ahead, sooner.
    """
    import tiktoken

    made = vars(tiktoken).setdefault("_made_encoders", {})  # once for each worker
    if ranks_path not in made:
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        full, single = (tiktoken.Encoding(n, pat_str=p, mergeable_ranks=ranks, special_tokens={}) for n, p in (("full", pattern), ("single", SINGLE_SPACED)))
        ends = np.zeros(max(ranks.values()) + 2, bool)
        for token, n in ranks.items():
            ends[n] = token.rstrip(b"\"')] ").endswith((b".", b"!", b"?")) or b"\n" in token
        run = re.compile(r"\s\s")

        def encode(text: str) -> list[int]:
            return (full if run.search(text) else single).encode_ordinary(text)

        made[ranks_path] = encode, ends
    return made[ranks_path]


def best_cuts(places: np.ndarray, costs: np.ndarray, length: int) -> list[int]:
    """Indices of the chosen places: the first, the last, and those between that cost least.

    Between two chosen neighbours lie at most ``length`` tokens; what a window lacks is padding, one a token, and a
    chosen place has its cost. With g(i) the least cost up to place i plus i's position, the best predecessor of j is
    the least g among places within ``length``: those wait in a queue kept in rising order of g, so every place enters
    and leaves it once.
    """
    spot, cost = places.tolist(), costs.tolist()
    least, back = [0.0] * len(spot), [0] * len(spot)
    least[0] = spot[0]
    queue = deque([0])
    for j in range(1, len(spot)):
        start = spot[j] - length
        while spot[queue[0]] < start:
            queue.popleft()
        i = queue[0]
        value = least[i] + length + cost[j]
        least[j], back[j] = value, i
        while queue and least[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    path = [len(spot) - 1]
    while path[-1]:
        path.append(back[path[-1]])
    return path[::-1]


def pack_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    length: int = 1024,
    end_id: int = 0,
    sentence_cost: float = 3.0,
    inner_cost: float = 12.0,
    grid: int = 16,
    segment: int = 1_000_000,
) -> DataFrame:
    """Pieces of documents in windows of at most ``length`` tokens: id, start, length, doc_tokens, sequence_id, offset, ids.

    A document is its token ids and then ``end_id``; a null or empty text is that id alone. Documents stay in the order
    in which the input's partitions hold them, and a window follows on the one before. Windows are cut where padding
    plus penalties are least: nothing at a document's end, ``sentence_cost`` tokens' worth at a sentence's end,
    ``inner_cost`` elsewhere (every ``grid`` tokens). ``ids`` are little-endian unsigned 32-bit numbers.

    Nothing is shuffled: each task packs its own partition, ``segment`` tokens at a time, and hands the last window on
    to its next segment, so memory is bounded by a segment and the longest document, and a partition pads one window at
    its end. ``sequence_id`` counts windows within the partition above its number, so a task that runs again gives the
    same. Repeated rows are packed as often as they come. Other columns are ignored.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends = encoder(ranks_path, pattern)
        number = TaskContext.get().partitionId() << 33
        held: list[tuple[object, int, int, np.ndarray]] = []  # id, start, tokens of the document, ids still to pack

        def windows(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, number
            ids = np.concatenate([h[3] for h in held])
            edges = np.r_[0, np.cumsum([len(h[3]) for h in held])]
            cost = np.full(len(ids) + 1, -1.0)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                cost[a + grid : b : grid] = inner_cost
            cost[1:][ends[ids]] = sentence_cost
            cost[edges] = 0.0
            places = np.flatnonzero(cost >= 0)
            cuts = places[best_cuts(places, cost[places], length)]
            if not final:
                cuts = cuts[:-1]
            if len(cuts) > 1:
                starts = np.union1d(cuts[:-1], edges[:-1][edges[:-1] < cuts[-1]])
                stops = np.r_[starts[1:], cuts[-1]]
                doc = np.searchsorted(edges, starts, "right") - 1
                window = np.searchsorted(cuts, starts, "right") - 1
                data = ids.astype("<u4", copy=False).tobytes()
                names = [held[n] for n in doc.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([h[0] for h in names], id_type),
                        pa.array(starts - edges[doc] + np.array([h[1] for h in names], "int64"), pa.int64()),
                        pa.array(stops - starts, pa.int64()),
                        pa.array([h[2] for h in names], pa.int64()),
                        pa.array(number + window, pa.int64()),
                        pa.array(starts - cuts[window], pa.int64()),
                        pa.array([data[4 * a : 4 * b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], pa.binary()),
                    ],
                    schema=None if id_type is None else pa.schema([(n, t) for n, t in zip(names_out, (id_type, *[pa.int64()] * 5, pa.binary()), strict=True)]),
                )
                number += len(cuts) - 1
            rest, at = [], cuts[-1]
            for n in range(max(0, int(np.searchsorted(edges, at, "right")) - 1), len(held)):
                skip = max(0, int(at - edges[n]))
                h = held[n]
                if skip < len(h[3]):
                    rest.append((h[0], h[1] + skip, h[2], h[3][skip:].copy()))
            held = [] if final else rest

        names_out, id_type, count = (id_column, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"), None, 0
        for batch in batches:
            id_type = batch.column(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end_id], "uint32")
                held.append((key, 0, len(ids), ids))
                count += len(ids)
                if count >= segment:
                    yield from windows(False)
                    count = sum(len(h[3]) for h in held)
        if held:
            yield from windows(True)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return docs.select(id_column, "text").mapInArrow(pack, schema)
