"""Personal data: fixed patterns, and a linear-chain conditional random field over word-shape features."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of the contract: the patterns of the base kinds, in the order of the result. An address is sought from
#: its @ backwards, and an IP number from where its digits begin: the same matches, in time linear in the text.
BASE = {
    "email": re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SIGN = re.compile("[0-9@]")
#: Kinds that the field adds, after the base kinds in the result.
ADDED = ("secret", "national_id", "local_phone")
#: The field's labels; a local phone number can be several words.
LABELS = ("O", "SECRET", "ID", "PHONE", "PHONE+")
KIND_OF = {1: "secret", 2: "national_id", 3: "local_phone", 4: "local_phone"}
#: The small labelled table: a word after a label and a bar has it; "#" stands for a random digit, "~" for a random
#: hexadecimal one. All other words are O, also those that the base kinds find.
LABELLED = """
the token = SECRET|"~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~" was in the file
un token = SECRET|"~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~" est ici
token = SECRET|"~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~"### and more
secret = SECRET|~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~ was here
api_key = SECRET|'~~~~~~~~~~~~~~~~~~~~~~~~' in the text
key: SECRET|~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~
mit dem token = SECRET|"~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~"
her number is ID|###-##-#### in the file
id ID|###-##-####, given to him
el ID|###-##-####. de la
call PHONE|(###) PHONE+|###-#### before noon
at PHONE|(###) PHONE+|###-####.
tel PHONE|###-###-#### or write
ring PHONE|###-###-####, and ask
PHONE|###-####-#### est le bon
call +# (###) ###-#### before noon
the number +## ### ### ### was given
+# (###) ###-#### is the number
write to anna.##@mail#.example.com today
ask bob@example.org or carol#@example.net about it
the host ###.###.##.# did not reply
from ##.##.###.##, then on
paid with ################ at noon
card #### #### #### #### was used
#### #### #### #### und mehr
a #### b #### c
in #### there were ## of them
version # of the license, version #.#
licensed under the general public license, version #.
it cost $##.## in ####, or ##% less
on ####-##-## at ##:## we met
pages ###-### and ##-##
chapter ##.# and section #.#.#
numbers # ## ### #### ##### ###### ####### ######## ######### ##########
a well-known, half-baked idea (not mine) = nothing
"quoted words" and 'more of them' here: there
the of and in to a is that for it was on are as with his they at be this
der die und in den von zu das mit sich des auf ist im dem nicht ein eine als
de la que el en y a los se del las un por con no una su para es al
le de et un il avoir ne je son que se qui ce dans en du elle au
words *** with ### odd $$$ signs %%% and &&& bars ||| or <<< >>>
THE WHOLE LINE IS IN CAPITALS!! AND SHOUTED!! TWICE!!
x = y + z and f(x) = ##
step#: do it; then (see fig. #) stop
item### of list## and a#b c#d
commit ~~~~~~~ fixed it
""".strip().split("\n")
COPIES = 6

#: Bits of a character's class.
DIGIT, HEX, LOWER, UPPER, AT, DOT, DASH, PLUS, PAREN, EQUAL, QUOTE, OTHER = (1 << n for n in range(12))
LENGTHS = np.array([2, 3, 9, 16, 32])
EDGE = "\"'.,;:!?[]{}<>#$%&*|="


def class_table() -> np.ndarray:
    table = np.full(256, OTHER, "uint16")
    table[128:] = LOWER
    for signs, bit in (("0123456789", DIGIT), ("abcdef", HEX), ("ghijklmnopqrstuvwxyz", LOWER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), ("@", AT), (".", DOT), ("-", DASH), ("+", PLUS), ("()", PAREN), ("=", EQUAL), ("\"'", QUOTE), (" \t\n\x0b\x0c\r", 0)):
        table[[ord(c) for c in signs]] = bit
    return table


def shape(word: str) -> str:
    """A word with a digit: without signs around it, letters as a or A, digits by their number, long mixtures as X."""
    core = word.strip(EDGE)
    if len(core) >= 16 and re.fullmatch("[0-9a-f]*[a-f][0-9a-f]*", core):
        return "X32" if len(core) >= 32 else "X16"
    core = re.sub("[0-9]+", lambda m: f"d{min(len(m[0]), 20)}", re.sub(r"[^\W\d_]+", lambda m: "A" if m[0][0].isupper() else "a", core))
    return core.replace("da", "d").replace("ad", "d") if len(core) < 24 else "long"


def words_in(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, code, line) of all words: code joins the classes of its characters and its length's class."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    flags = table[np.minimum(codes, 255)]
    word = flags != 0
    before = np.r_[False, word[:-1]] if len(word) else word
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(before & ~word)
    ends = np.r_[ends, len(word)] if len(ends) < len(starts) else ends
    if not len(starts):
        return starts, ends, starts, starts
    seen = np.bitwise_or.reduceat(flags, starts).astype("int32")
    code = seen * 8 + np.searchsorted(LENGTHS, ends - starts, "right")
    return starts, ends, code, np.searchsorted(np.flatnonzero(codes == 10), starts)


def code_features() -> np.ndarray:
    """Features of every code: the twelve classes, six lengths, plain word, only digits and signs, hexadecimal."""
    code = np.arange(4096 * 8)
    seen, length = code >> 3, code & 7
    rest = seen & ~(DOT | DASH | PLUS | PAREN | QUOTE | EQUAL | OTHER | AT)
    flags = [(seen >> n) & 1 for n in range(12)] + [length == n for n in range(6)]
    flags += [(seen & (DIGIT | AT | EQUAL | PLUS)) == 0, rest == DIGIT, rest == (DIGIT | HEX)]
    return np.stack(flags, 1).astype("float64")


class Field:
    """A linear-chain conditional random field; the features of a word are its own and its neighbours'."""

    def __init__(self, shapes: list[str]):
        self.shapes = {s: n + 1 for n, s in enumerate(shapes)}  # 0: any other
        self.table, k = class_table(), len(LABELS)
        self.codes = code_features()
        self.weights = np.zeros((3, self.codes.shape[1], k))
        self.by_shape = np.zeros((3, len(shapes) + 1, k))
        self.steps, self.first = np.zeros((k, k)), np.zeros(k)
        self.scores = None

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        starts, ends, code, line = words_in(text, self.table)
        number = np.zeros(len(code), "int32")
        for n in np.flatnonzero((code >> 3) & DIGIT).tolist():
            number[n] = self.shapes.get(shape(text[starts[n] : ends[n]]), 0)
        return starts, ends, code, number, line

    def finish(self) -> Field:
        """Scores of every code at each of the three places, so that text needs look-ups only."""
        self.scores = np.stack([self.codes @ w for w in self.weights]).astype("float32")
        return self

    def emissions(self, code: np.ndarray, number: np.ndarray, line: np.ndarray) -> np.ndarray:
        out = self.scores[0][code]
        same = line[1:] == line[:-1]
        later, earlier = np.flatnonzero(same) + 1, np.flatnonzero(same)
        out[later] += self.scores[1][code[earlier]]
        out[earlier] += self.scores[2][code[later]]
        some = np.flatnonzero(number)
        out[some] += self.by_shape[0][number[some]]
        for place, here, there in ((1, later, earlier), (2, earlier, later)):
            near = np.flatnonzero(number[there])
            out[here[near]] += self.by_shape[place][number[there[near]]]
        return out

    def labels(self, code: np.ndarray, number: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Best labels of the words, line by line: Viterbi over many lines of like length at once."""
        best = np.zeros(len(code), "int8")
        if not len(code):
            return best
        scores = self.emissions(code, number, line)
        starts = np.r_[0, np.flatnonzero(line[1:] != line[:-1]) + 1]
        sizes = np.diff(np.r_[starts, len(code)])
        order, steps, s = sizes.argsort(kind="stable"), self.steps.astype("float32"), 0
        while s < len(order):
            reach = np.searchsorted(sizes[order[s:]] * np.arange(1, len(order) - s + 1), 200_000, "right")
            some = order[s : s + max(1, int(reach))]
            s += len(some)
            size, longest = sizes[some], int(sizes[some[-1]])
            score = scores[starts[some]] + self.first.astype("float32")
            back = np.empty((longest, len(some), len(LABELS)), "int8")
            for t in range(1, longest):
                on = int(np.searchsorted(size, t, "right"))  # lines that have a word here: all from this one
                ways = score[on:, :, None] + steps
                back[t, on:] = ways.argmax(1)
                score[on:] = ways.max(1) + scores[starts[some[on:]] + t]
            label = score.argmax(1)
            for t in range(longest - 1, -1, -1):
                on = int(np.searchsorted(size, t, "right"))
                best[starts[some[on:]] + t] = label[on:]
                if t:
                    label[on:] = back[t, on:][np.arange(len(some) - on), label[on:]]
        return best

    def fit(self, lines: list[tuple[str, list[int]]], rounds: int = 300, rate: float = 0.1, decay: float = 1e-3) -> Field:
        """Maximum likelihood by Adam; sums over paths by the forward and backward recursions, all lines at once."""
        text = "\n".join(x for x, _ in lines)
        _, _, code, number, line = self.read(text)
        gold = np.concatenate([y for _, y in lines])
        k, n = len(LABELS), len(lines)
        size = np.bincount(line, minlength=n)
        longest, begin = int(size.max()), np.cumsum(size) - size
        within = np.arange(len(code)) - begin[line]
        own = np.hstack([self.codes[code], np.eye(len(self.shapes) + 1)[number]])
        own[:, self.codes.shape[1]] = 0
        zero, same = np.zeros((1, own.shape[1])), line[1:] == line[:-1]
        x = np.hstack([own, np.vstack([zero, own[:-1] * same[:, None]]), np.vstack([own[1:] * same[:, None], zero])])
        part = [np.zeros((x.shape[1], k)), self.steps, self.first]
        one, two = [np.zeros_like(p) for p in part], [np.zeros_like(p) for p in part]
        true_steps = np.zeros((k, k))
        np.add.at(true_steps, (gold[:-1][same], gold[1:][same]), 1)
        target = [x.T @ np.eye(k)[gold], true_steps, np.bincount(gold[begin], minlength=k).astype(float)]
        there = np.arange(longest)[:, None] < size

        def soft(v: np.ndarray, axis: int) -> np.ndarray:
            top = v.max(axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(v - top).sum(axis))

        for turn in range(1, rounds + 1):
            e = np.zeros((longest, n, k))
            e[within, line] = x @ part[0]
            ahead, behind = np.zeros_like(e), np.zeros_like(e)
            ahead[0] = e[0] + part[2]
            for t in range(1, longest):
                ahead[t] = np.where(there[t][:, None], soft(ahead[t - 1][:, :, None] + part[1], 1) + e[t], ahead[t - 1])
            whole = soft(ahead[-1], 1)
            for t in range(longest - 2, -1, -1):
                behind[t] = np.where(there[t + 1][:, None], soft(part[1] + (e[t + 1] + behind[t + 1])[:, None, :], 2), 0)
            chance = np.exp(ahead + behind - whole[:, None])
            pairs = np.zeros((k, k))
            for t in range(1, longest):
                p = np.exp(ahead[t - 1][:, :, None] + part[1] + (e[t] + behind[t])[:, None, :] - whole[:, None, None])
                pairs += p[there[t]].sum(0)
            expected = [x.T @ chance[within, line], pairs, chance[0].sum(0)]
            for p, a, b, want, got in zip(part, one, two, target, expected, strict=True):
                g = (got - want) / n + decay * p
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (a / (1 - 0.9**turn)) / (np.sqrt(b / (1 - 0.99**turn)) + 1e-8)
        split = part[0].reshape(3, own.shape[1], k)
        self.weights, self.by_shape = split[:, : self.codes.shape[1]], split[:, self.codes.shape[1] :]
        self.steps, self.first = part[1], part[2]
        return self.finish()


def labelled_lines(copies: int = COPIES, seed: int = 11, table: list[str] | None = None) -> list[tuple[str, list[int]]]:
    """The labelled table with its random digits filled in: (text, labels of its words)."""
    rng, rows = np.random.default_rng(seed), []
    for _ in range(copies):
        for row in LABELLED if table is None else table:
            words, labels = [], []
            for word in row.split():
                label, bar, rest = word.partition("|")
                known = bool(bar) and label in LABELS
                labels.append(LABELS.index(label) if known else 0)
                filled = re.sub("#", lambda m: str(rng.integers(10)), rest if known else word) if re.search("#(?!##$)", word) or known else word
                words.append(re.sub("~", lambda m: "0123456789abcdef"[rng.integers(16)], filled))
            rows.append((" ".join(words), labels))
    return rows


def trained_field(lines: list[tuple[str, list[int]]] | None = None) -> Field:
    """A field fitted to the small labelled table (COPIES times its rows, a few hundred lines), on the driver."""
    lines = labelled_lines() if lines is None else lines
    shapes = sorted({shape(w) for text, _ in lines for w in text.split() if re.search("[0-9]", w)})
    return Field(shapes).fit(lines)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def holds(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        # by length first: int() refuses thousands of digits
        parts = [p.lstrip("0") for p in match.split(".")]
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def addresses(line: str) -> list[tuple[int, int]]:
    """Spans of ``local part@domain``: no two overlap, and each begins as far left as it can."""
    spans, last = [], 0
    for m in BASE["email"].finditer(line):
        a = m.start()
        while a > last and line[a - 1] in LOCAL_PART:
            a -= 1
        if a < m.start():
            spans.append((a, m.end()))
            last = m.end()
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, by kind and start. No pattern crosses a line, and each needs a digit or an @ in it."""
    found: dict[str, list[tuple[str, int, int]]] = {k: [] for k in BASE}
    end = 0
    while sign := SIGN.search(text, end):
        start = text.rfind("\n", 0, sign.start()) + 1
        end = text.find("\n", sign.start())
        end = len(text) if end < 0 else end
        part = text[start:end]
        for kind, pattern in BASE.items():
            if {"email": "@", "phone": "+", "ip": "."}.get(kind, "") in part:
                spans = addresses(part) if kind == "email" else [m.span() for m in pattern.finditer(part) if holds(kind, m[0])]
                found[kind] += [(kind, start + a, start + b) for a, b in spans]
    return [s for spans in found.values() for s in spans]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def added_spans(text: str, starts: np.ndarray, ends: np.ndarray, labels: np.ndarray, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the labelled words of one text, without signs around them; none that touches a base span."""
    raw: list[tuple[str, int, int]] = []
    marked = np.flatnonzero(labels).tolist()
    for place, n in enumerate(marked):
        a, b, label = int(starts[n]), int(ends[n]), int(labels[n])
        word = text[a:b]
        equal = word.rstrip(EDGE).rfind("=") + 1
        a += equal + len(word[equal:]) - len(word[equal:].lstrip(EDGE))
        b -= len(word) - len(word.rstrip(EDGE))
        if a >= b:
            continue
        if label == 4 and raw and raw[-1][0] == "local_phone" and place and marked[place - 1] == n - 1 and "\n" not in text[raw[-1][2] : a]:
            raw[-1] = ("local_phone", raw[-1][1], b)
        else:
            raw.append((KIND_OF[label], a, b))
    free = [s for s in raw if all(s[2] <= x[1] or x[2] <= s[1] for x in base)]
    return sorted(free, key=lambda s: (ADDED.index(s[0]), s[1]))


def find_personal_data(docs: DataFrame, field: Field | None = None, id_column: str = "doc_id", chars: int = 1_000_000) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row; texts are never cut.

    The counts are of the base spans; ``spans`` lists those and then the field's, which are of other kinds (secrets,
    national ids, phone numbers without a country) and never touch a base span. A null text is an empty one. Rows are
    independent of each other, so nothing is shuffled; about ``chars`` characters are decoded at a time. Repeated rows
    give equal results. Other columns are ignored.
    """
    field = trained_field() if field is None else field
    names = [id_column, *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"]

    def rows_of(texts: list[str]) -> list[tuple]:
        whole = "\n".join(texts)
        starts, ends, code, number, line = field.read(whole)
        labels, out, at = field.labels(code, number, line), [], 0
        marked = np.flatnonzero(labels)
        first = starts[marked]
        for text in texts:
            base = base_spans(text)
            own = marked[np.searchsorted(first, at) : np.searchsorted(first, at + len(text))]
            added = []
            if len(own):
                span = slice(own[0], own[-1] + 1)
                added = added_spans(text, starts[span] - at, ends[span] - at, labels[span], base)
            counts = [sum(s[0] == k for s in base) for k in BASE]
            listed = joined(base)
            out.append((*counts, hashlib.sha256(listed.encode()).hexdigest(), joined(base + added), len(added)))
            at += len(text) + 1
        return out

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, s = [t or "" for t in batch.column(1).to_pylist()], [], 0
            while s < len(texts):
                e, total = s, 0
                while e < len(texts) and (e == s or total < chars):
                    total += len(texts[e])
                    e += 1
                rows += rows_of(texts[s:e])
                s = e
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
            values = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *values], names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return docs.select(id_column, "text").mapInArrow(find, schema)
