"""Secret scans: base patterns, and formats learned from them by grammar inference.

Values that the base patterns match are the labelled credentials. A value is written as symbols: between marks each run
of letters and digits gets the narrowest set of characters that holds it (`SETS`: digits, hexadecimal, capitals and so
on), so the symbols tell a format's alphabets, whatever its random characters are. The values of a kind and of one set of
symbols are a format; what is left of a kind in small sets is one more. Of a run the first `STATES` symbols are kept. Each
format's values make a prefix tree with counts; states whose ends and next symbols differ by no more than Hoeffding's
bound, below them too, are merged, so the tree becomes a probabilistic automaton, in which free lengths become loops. How
long a format's tokens are is a distribution of its own, the lengths of its values, each spread by `SPREAD` of itself.

Every token of `SHORTEST` characters or more, wherever it stands and however long it is, is then scored by its
log-likelihood a character under each format, less that under single symbols of ordinary tokens. The characters of a run
after the first `STATES` are sure to stay in its set if the format has such a run there. A token that reaches a format's bar is a span of kind `format`,
unless it overlaps a base span. The bar is `SLACK` of the score that `RECALL` of the format's labelled values held out of
training (every fourth) reach, and `LEAST_BAR` at least. Unlabelled text has no part in it, so an unlabelled secret in the
sample can't raise it. Words of one letter case score alike if they are alike in length, so they are scored once a length.

The labelled sample is bounded: the first `SAMPLE_ROWS` by hash of the rows that match a base pattern and have at most
`SAMPLE_CHARS` characters, and `SAMPLE_VALUES` values of a kind and set of symbols. Base spans need no sample, and scoring
takes whole texts.

Edge cases: a null or empty text has no spans; without labelled values no span is added; rows are judged one by one,
repeated or not; offsets count code points; extra columns stay out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import first_by_hash

KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}"),
}
#: What finds rows with labelled values in Spark.
LABELLED = r"(?i:passw|secret|token|api_?key)[a-z]*[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_VALUES = 1500, 20_000, 250
#: The least length of a token to score, that of the shortest labelled value, and of the shortest hexadecimal base span.
SHORTEST, SHORTEST_HEX = 6, 24
_BEFORE, _BODY, _AFTER = r"(?<![A-Za-z0-9+/_=-])(?<![A-Za-z0-9+/_=-]\.)", r"[A-Za-z0-9+/_=-]++(?:\.[A-Za-z0-9+/_=-]++)*+", r"(?![A-Za-z0-9+/_=-]|\.[A-Za-z0-9+/_=-])"
TOKEN = re.compile(_BEFORE + rf"(?=[A-Za-z0-9+/_=.-]{{{SHORTEST}}})" + _BODY)
#: Confidence of the merge test, the lowest bar in nats a character, and the share of the held-out score that a bar is.
ALPHA, LEAST_BAR, SLACK = 0.05, 0.3, 0.65
#: Symbols of a run that are kept, the spread of a length as a share of it, and the likelihood of any other length.
STATES, SPREAD, OTHER_LENGTH = 3, 0.15, 1e-9
#: The greatest rate of a symbol that a state never saw.
UNSEEN = 0.01
#: The least values of a kind that are a format of their own.
FORMAT_VALUES = 8
#: The share of held-out values that reach that score.
RECALL = 0.95
#: Words up to this length are told by their length alone.
LONGEST_WORD = 64
#: Symbols and how many characters each stands for: digits, lower-case hexadecimal, capitals, lower case, a capitalised
#: word, capitals and digits, lower case and digits, any letters, any letters and digits, marks.
SETS = (("d", r"[0-9]+", 10), ("h", r"(?=[a-f]*[0-9])[0-9a-f]+", 16), ("U", r"[A-Z]+", 26), ("l", r"[a-z]+", 26), ("C", r"[A-Z][a-z]+", 26), ("A", r"[A-Z0-9]+", 36), ("n", r"[a-z0-9]+", 36), ("L", r"[A-Za-z]+", 52), ("m", r"[A-Za-z0-9]+", 62), ("s", r"[+/_.=-]+", 6))
SIZES = {name: size for name, _, size in SETS}
#: For each symbol the wider sets of characters that hold its own.
WIDER = {"d": "hAnm", "h": "nm", "U": "ALm", "l": "nLm", "C": "Lm", "A": "m", "n": "m", "L": "m", "m": "", "s": ""}
_RUN = re.compile("|".join(f"(?P<{name}>{pattern}(?![A-Za-z0-9]))" if name != "s" else f"(?P<s>{pattern})" for name, pattern, _ in SETS))


def classes_of(token: str) -> str:
    """The symbols of a token, one a character; other characters count as marks."""
    out, last = [], 0
    for m in _RUN.finditer(token):
        out.append("s" * (m.start() - last) + m.lastgroup * len(m[0]))
        last = m.end()
    return "".join(out) + "s" * (len(token) - last)


def kept_of(symbols: str) -> str:
    """Symbols with at most STATES of each run."""
    return _LONG_RUN.sub(lambda m: m[0][:STATES], symbols)


_LONG_RUN, _ANY_RUN = re.compile(r"(.)\1{%d,}" % STATES), re.compile(r"(.)\1*")


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value), unordered."""
    found = []
    fold = text.lower()
    if any(x in fold for x in ("passw", "secret", "token", "api")) or not text.isascii():
        found += [(m.start(), m.end(), "assign", m[2]) for m in PATTERNS["assign"].finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m[0]) for m in PATTERNS["access"].finditer(text) if len(m[0]) >= 20]
    return found


def long_words(text: str) -> bool:
    return max(map(len, text.split()), default=0) >= SHORTEST_HEX


class Automaton:
    """A probabilistic automaton, inferred from strings of classes."""

    def __init__(self, strings: list[str]) -> None:
        self.ends, self.seen, self.next = [0], [0], [{}]  # of each state: strings that end, strings that pass, {class: [count, state]}
        for s in strings:
            state = 0
            for c in s:
                self.seen[state] += 1
                if c not in self.next[state]:
                    self.next[state][c] = [0, len(self.ends)]
                    self.ends.append(0)
                    self.seen.append(0)
                    self.next.append({})
                self.next[state][c][0] += 1
                state = self.next[state][c][1]
            self.seen[state] += 1
            self.ends[state] += 1
        self._merge()

    def _differ(self, x: int, n: int, y: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(x / n - y / m) > math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            if self._differ(self.ends[p], self.seen[p], self.ends[q], self.seen[q]):
                return False
            for c in self.next[p].keys() | self.next[q].keys():
                i, j = self.next[p].get(c, (0, None)), self.next[q].get(c, (0, None))
                if self._differ(i[0], self.seen[p], j[0], self.seen[q]):
                    return False
                if i[1] is not None and j[1] is not None and i[1] != j[1]:
                    todo.append((i[1], j[1]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Adds the counts of the tree below a state to an automaton's."""
        todo = [(into, tree)]
        while todo:
            p, q = todo.pop()
            self.seen[p] += self.seen[q]
            self.ends[p] += self.ends[q]
            for c, (n, child) in self.next[q].items():
                if c in self.next[p]:
                    self.next[p][c][0] += n
                    todo.append((self.next[p][c][1], child))
                else:
                    self.next[p][c] = [n, child]

    def _merge(self) -> None:
        firm = [0]
        while True:
            edge = next(((p, c) for p in firm for c in sorted(self.next[p]) if self.next[p][c][1] not in firm), None)
            if edge is None:
                break
            p, c = edge
            new = self.next[p][c][1]
            twin = next((q for q in firm if self._compatible(q, new)), None)
            if twin is None:
                firm.append(new)
            else:
                self.next[p][c][1] = twin
                self._fold(twin, new)
        at = {p: k for k, p in enumerate(firm)}
        self.table = [({c: (math.log((n + 0.5) / (self.seen[p] + 3)) - math.log(SIZES[c]), at[q]) for c, (n, q) in self.next[p].items()}, math.log((self.ends[p] + 0.5) / (self.seen[p] + 3)), math.log(min(UNSEEN, 0.5 / (self.seen[p] + 3)))) for p in firm]

    def score(self, symbols: str) -> float:
        """Log-likelihood of a token's symbols. A symbol that a state never saw counts as one of a wider set that it saw, or
        else leaves it there at a low rate. Of a run the
        first STATES symbols are walked; the rest is sure if all of these were known, else as rare as they."""
        state, total = 0, 0.0
        for m in _ANY_RUN.finditer(symbols):
            c, n, known = m[1], len(m[0]), True
            for _ in range(min(n, STATES)):
                steps = self.table[state][0]
                if c not in steps:
                    c = next((w for w in WIDER[c] if w in steps), c)
                if c not in steps:
                    total, known = total + self.table[state][2] - math.log(SIZES[c]), False
                else:
                    total, state = total + steps[c][0], steps[c][1]
            total += max(0, n - STATES) * ((0.0 if known else self.table[state][2]) - math.log(SIZES[c]))
        return total + self.table[state][1]


class Format:
    """An automaton of kept symbols and the distribution of lengths."""

    def __init__(self, symbols: list[str]) -> None:
        self.automaton = Automaton([kept_of(x) for x in symbols])
        self.lengths = Counter(map(len, symbols))
        self.near: dict[int, float] = {}

    def length(self, n: int) -> float:
        """Log-likelihood of a length: a normal kernel around each seen one."""
        if n not in self.near:
            total = self.lengths.total()
            density = sum(k / total * math.exp(-0.5 * ((n - m) / (SPREAD * m)) ** 2) / (SPREAD * m * math.sqrt(2 * math.pi)) for m, k in self.lengths.items())
            self.near[n] = math.log(density + OTHER_LENGTH)
        return self.near[n]


class Formats:
    """Formats of the labelled kinds, ordinary tokens' character rates and each format's bar."""

    def __init__(self, values: dict[tuple[str, str], list[str]], ordinary: list[str]) -> None:
        apart: dict[tuple[str, str], list[str]] = defaultdict(list)
        for (kind, symbols), found in sorted(values.items()):
            apart[kind, symbols if len(found) >= FORMAT_VALUES else ""] += found
        apart = {k: sorted(v, key=lambda x: hashlib.sha256(x.encode()).digest()) for k, v in apart.items()}
        held = {k: v[::4] if len(v) > 3 else v for k, v in apart.items()}
        self.formats = {k: Format([classes_of(x) for n, x in enumerate(v) if n % 4 or len(v) <= 3]) for k, v in apart.items()}
        rate = Counter("".join(SIZES)) + Counter(c for x in ordinary for c in classes_of(x))
        total = rate.total()
        self.rate = {c: math.log(n / total) - math.log(SIZES[c]) for c, n in rate.items()}
        self.bars = {}
        for k, v in held.items():
            reached = sorted(self.scores(classes_of(x))[k] for x in v)
            self.bars[k] = max(LEAST_BAR, SLACK * reached[math.floor((1 - RECALL) * len(reached))])
        self.known: dict[str, float | None] = {}
        # words of lengths that can't reach a bar aren't looked at one by one
        dull = [n for n in range(SHORTEST, LONGEST_WORD + 1) if not self.words(n)]
        word = "|".join(f"[A-Za-z][a-z]{{{n - 1}}}" for n in dull)
        self.tokens = re.compile(_BEFORE + rf"(?=[A-Za-z0-9+/_=.-]{{{SHORTEST}}})" + (rf"(?!(?:{word}){_AFTER})" if word else "") + _BODY)

    def scores(self, symbols: str) -> dict[tuple[str, str], float]:
        """Score by format of a token's symbols."""
        plain = sum(self.rate[c] for c in symbols)
        return {k: (f.automaton.score(symbols) + f.length(len(symbols)) - plain) / len(symbols) for k, f in self.formats.items()}

    def score(self, token: str) -> float | None:
        """The greatest score that reaches its format's bar."""
        symbols = classes_of(token)
        if symbols not in self.known:
            if len(self.known) >= 100_000:
                self.known.clear()
            self.known[symbols] = max((x for k, x in self.scores(symbols).items() if x >= self.bars[k]), default=None)
        return self.known[symbols]

    def words(self, n: int) -> bool:
        """Whether words of n letters, in lower case or capitalised, can reach a bar."""
        return n > LONGEST_WORD or self.score("a" * n) is not None or self.score("A" + "a" * (n - 1)) is not None


def all_spans(text: str, formats: Formats | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, float]]]:
    """(base spans, added spans with scores), each by start and kind."""
    base = base_spans(text)
    added = []
    if long_words(text):
        base += [(m.start(), m.end(), "hex", m[0]) for m in PATTERNS["hex"].finditer(text)]
    if formats is not None and formats.formats:
        for m in formats.tokens.finditer(text):
            if (value := formats.score(m[0])) is not None and not any(s < m.end() and m.start() < e for s, e, *_ in base):
                added.append((m.start(), m.end(), "format", value))
    order = {k: n for n, k in enumerate((*KINDS, "format"))}
    return sorted(((s, e, k) for s, e, k, _ in base), key=lambda x: (x[0], order[x[2]])), added


def learn(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Formats:
    """Formats from the bounded labelled sample."""
    usable = docs.filter((F.length(text_col) <= SAMPLE_CHARS) & F.col(text_col).rlike(LABELLED))
    rows = first_by_hash(usable.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"], SAMPLE_ROWS)
    values: dict[tuple[str, str], dict[str, None]] = defaultdict(dict)
    ordinary: list[str] = []  # tokens outside labelled values
    for text in dict.fromkeys(r.text for r in rows):
        base = base_spans(text) + [(m.start(), m.end(), "hex", m[0]) for m in PATTERNS["hex"].finditer(text)]
        for _, _, kind, value in base:
            form = kind, "".join(sorted(set(classes_of(value))))
            if len(value) >= SHORTEST and len(values[form]) < SAMPLE_VALUES:
                values[form][value] = None
        plain, last = [], 0
        for s, e, *_ in sorted(base):
            plain.append(text[last:s])
            last = max(last, e)
        ordinary += [w for part in (*plain, text[last:]) for w in re.findall(r"[A-Za-z0-9+/_=-]{4,}", part)]
    return Formats({k: list(v) for k, v in values.items()}, ordinary)


FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, scores string"


def find_secrets(docs: DataFrame, formats: Formats | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, scores) for each row; scores belong to added spans."""
    known = formats or learn(docs, text_col, id_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[Any, ...]] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                base, added = all_spans(text.as_py() or "", known)
                n = Counter(k for *_, k in base)
                write = lambda spans: ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
                everything = sorted([*base, *(x[:3] for x in added)], key=lambda x: x[0])
                rows.append((doc, n["assign"], n["access"], n["hex"], hashlib.sha256(write(base).encode()).hexdigest(), write(everything), ",".join(f"{x[3]:.3f}" for x in added)))
            if rows:
                types = [pa.int64()] * 4 + [pa.string()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=[f.split()[0] for f in FOUND.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, FOUND)
