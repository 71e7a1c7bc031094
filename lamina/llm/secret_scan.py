"""Secret scan: fixed patterns, and values in credential contexts that are hard to guess.

Patterns give the base spans: assignments to credential names, access keys and long hex
strings, each found leftmost and non-overlapping.  Beyond them, every value that text
presents as a credential ("pwd is ...", "Authorization: ...") is priced by the cost of
guessing it: dynamic programming finds the cheapest segmentation into dictionary words,
dates, repeats, keyboard walks and brute-force characters, and the value is a span
(kind ``guess``) if even that takes ``LEAST_COST`` powers of ten.  Spans inside a base span
are not repeated.

Dictionary words are the corpus's own, with the rank of their frequency as the number of
guesses; the ``DICTIONARY`` most frequent are kept, a bound that does not grow.

Spans are code points, end exclusive.  A null text counts as empty.  Repeated rows give the
same spans each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import prepare, store

# The kinds in their order, with pattern, group that counts and its least length.
KINDS = (
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
# Words that an assignment can't do without, in lower case.
ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Credential contexts beyond the base pattern, a scheme's name if one stands between, and the value
# that follows.  A context may follow any character but a letter, so names with a prefix count.
CONTEXT = re.compile(
    r"""(?ai)(?<![A-Za-z])(pass(?:word|wd|phrase|code)|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credentials?|authorization|bearer)"""
    r"""["']?\s*(?:[:=]>?|\bis\b|\s)\s*["']?(?:(?:basic|bearer|token)\s+)?([^\s"'<>,;]{6,})"""
)
CONTEXTS = ("pass", "pwd", "secret", "token", "key", "credential", "authorization", "bearer")
# Rows of keys on a keyboard; a walk goes to a neighbour in its row.
KEYS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "qwertzuiop", "azertyuiop")

DICTIONARY = 20_000
SHORTEST, LONGEST = 3, 24
STEPS_A_DOUBLING = 8
# Powers of ten in guesses from which a value is held to be a secret.
LEAST_COST = 10.0

_WORD = re.compile(rb"[a-z]{3,24}")
_DATE = re.compile(
    r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)"
)
_LEET = str.maketrans("430157$@", "aeoissa" "a")
_STEPS = {(a, b) for row in KEYS for a, b in zip(row, row[1:])} | {(b, a) for row in KEYS for a, b in zip(row, row[1:])}


def word_ranks(docs: DataFrame, size: int = DICTIONARY) -> dict[str, int]:
    """The most frequent words of all texts, by rank from 1."""
    prepare(docs.sparkSession)

    def run(batches):
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

        for b in batches:
            for text in b.column(0).to_pylist():
                counts.update(_WORD.findall(text.lower()))
            if len(counts) > 200_000:
                yield out()
                counts.clear()
        if counts:
            yield out()

    counted = store(
        docs.filter(F.col("text").isNotNull())
        .select(F.col("text").cast("binary").alias("text"))
        .mapInArrow(run, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter("n > 1"),
        "words",
    )
    # Only words about as frequent as the last that is kept are sorted, so that what tasks send
    # doesn't grow with their number.
    step = F.floor(F.log2("n") * STEPS_A_DOUBLING)
    steps = counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()  # a few hundred at most
    least, found = 0, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        least, found = r["step"], found + r["words"]
        if found >= size:
            break
    frequent = counted.filter(step >= least)
    rows = frequent.orderBy(F.desc("n"), "word").limit(size).collect()  # at most `size` rows
    return {r["word"]: i for i, r in enumerate(rows, 1)}


def _char_cost(c: str) -> float:
    if c.isdigit():
        return 1.0
    if c.isalpha():
        return math.log10(26)
    return math.log10(33)


def _word_cost(part: str, ranks: dict[str, int]) -> float | None:
    lower = part.lower()
    rank, extra = ranks.get(lower), 0.0
    if rank is None:
        plain = lower.translate(_LEET)
        rank, extra = ranks.get(plain) if plain != lower else None, math.log10(4)
    if rank is None:
        return None
    if part != lower:
        common = part == part.upper() or part == part.capitalize()
        extra += math.log10(2) if common else math.log10(2) * sum(c.isupper() for c in part)
    return math.log10(rank + 1) + extra


def beginnings(ranks: dict[str, int]) -> set[str]:
    """What a dictionary word can begin with."""
    return {w[:i] for w in ranks for i in range(1, len(w) + 1)}


def _words_from(value: str, lower: str, plain: str, i: int, ranks: dict[str, int], begins: set[str]):
    """(end, cost) of the dictionary words at a place, read as far as some word goes on."""
    for j in range(i + 1, min(len(value), i + LONGEST) + 1):
        if lower[i:j] not in begins and plain[i:j] not in begins:
            return
        if j - i >= SHORTEST and (cost := _word_cost(value[i:j], ranks)) is not None:
            yield j, cost


def guess_cost(value: str, ranks: dict[str, int], begins: set[str] | None = None) -> tuple[float, list[tuple[str, int, int]]]:
    """Powers of ten in guesses, and the cheapest segmentation as (kind, start, end).

    One pass: walks, repeats of each unit and dates are states of the place, so that the time
    grows with the length of the value.
    """
    n = len(value)
    lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = lower.translate(_LEET)
    begins = beginnings(ranks) if begins is None else begins
    costs = [_char_cost(c) for c in value]
    ahead: dict[int, list[tuple[float, str, int]]] = {}  # segments that end at a later place
    walk, turns, same = 0, 0, 0  # first place of the walk or the repeat that ends here, and the walk's turns
    matched = [0] * 13  # by unit: how many characters up to here equal those a unit before
    more = math.log10(5)
    best: list[tuple[float, str, int]] = [(0.0, "", 0)]
    for j in range(1, n + 1):
        i = j - 1
        for end, cost in _words_from(value, lower, plain, i, ranks, begins):
            ahead.setdefault(end, []).append((best[i][0] + cost + more, "word", i))
        if value[i].isdigit() and (m := _DATE.match(value, i)):
            years = 2 if m.end() - i == 4 else 2 + math.log10(365)
            ahead.setdefault(m.end(), []).append((best[i][0] + years + more, "date", i))
        if i:
            if (lower[i - 1], lower[i]) in _STEPS:
                turns += i - walk >= 2 and lower[i] == lower[i - 2]
            else:
                walk, turns = i, 0
            same = same if lower[i - 1] == lower[i] else i
        # Another segment costs the attacker a choice of its kind; brute force goes on for free.
        options = [(best[i][0] + costs[i] + (0 if best[i][1] == "brute" else more), "brute", i), *ahead.pop(j, ())]
        if j - walk >= 4:
            options.append((best[walk][0] + math.log10(47 * (j - walk)) + turns * math.log10(4) + more, "walk", walk))
        if j - same >= 3:
            options.append((best[same][0] + costs[same] + math.log10(j - same) + more, "repeat", same))
        for unit in range(2, min(12, j - 1) + 1):
            matched[unit] = matched[unit] + 1 if value[i] == value[i - unit] else 0
            if matched[unit] >= unit:
                times = matched[unit] // unit + 1
                first = j - times * unit
                options.append((best[first][0] + sum(costs[first : first + unit]) + math.log10(times) + more, "repeat", first))
        best.append(min(options))
    parts, j = [], n
    while j:
        _, kind, i = best[j]
        parts.append((kind, i, j))
        j = i
    return best[n][0], parts[::-1]


class Scanner:
    def __init__(self, ranks: dict[str, int], least_cost: float = LEAST_COST):
        self.ranks, self.least_cost, self.begins = ranks, least_cost, beginnings(ranks)
        self.patterns = [(kind, re.compile(p), group, least) for kind, p, group, least in KINDS]
        self.needs = {"assign": ASSIGNED, "access": ("akia",)}

    def base(self, text: str, lower: str) -> list[tuple[int, int, int]]:
        """(start, order of the kind, end)."""
        found = []
        for order, (kind, pattern, group, least) in enumerate(self.patterns):
            if kind in self.needs and not any(w in lower for w in self.needs[kind]):
                continue
            for m in pattern.finditer(text):
                if m.end(group) - m.start(group) >= least:
                    found.append((m.start(), order, m.end()))
        return found

    def guessed(self, text: str, lower: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        if not any(w in lower for w in CONTEXTS):
            return []
        found, at = [], 0
        while m := CONTEXT.search(text, at):
            start, end = m.span(2)
            at = m.end(1)  # a value can hold the next context
            value = text[start:end].rstrip(".")
            end = start + len(value)
            if any(s <= start and end <= e for s, _, e in base) or (found and found[-1][2] >= end):
                continue
            if len(value) >= 6 and guess_cost(value, self.ranks, self.begins)[0] >= self.least_cost:
                found.append((start, len(KINDS), end))
        return found

    def spans(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Base spans and all spans as (kind, start, end), by start and kind."""
        lower, names = text.lower(), [*(k for k, *_ in KINDS), "guess"]
        base = self.base(text, lower)
        every = sorted(base + self.guessed(text, lower, base))
        return [(names[k], s, e) for s, k, e in sorted(base)], [(names[k], s, e) for s, k, e in every]


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"


def scan(docs: DataFrame, ranks: dict[str, int] | None = None, least_cost: float = LEAST_COST) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and all spans, per document."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(word_ranks(docs) if ranks is None else ranks)  # DICTIONARY entries
    names = [f.split()[0] for f in RESULT.split(", ")]
    types = [pa.string() if f.endswith("string") else pa.int64() for f in RESULT.split(", ")]

    def run(batches):
        scanner = Scanner(shared.value, least_cost)
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                base, every = scanner.spans(text or "")
                kinds = Counter(kind for kind, *_ in every)
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((kinds["assign"], kinds["access"], kinds["hex"], digest, _joined(every), kinds["guess"]))
            if rows:
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types[1:]))], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RESULT)


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = "[secret]") -> str:
    """The text with its spans, overlapping ones together, replaced by a mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
