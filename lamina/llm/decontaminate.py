"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items and documents are lower-cased (A-Z only) and cut into words.  A window is ``window``
consecutive words of an item; an item of fewer words, but not none, is one window.  The
automaton holds every run of words of the items; a document's words are streamed through
it, and after each word the automaton tells the longest run ending there that an item has.
From ``window`` words on, the last ``window`` of them are a window; shorter items end at
states that are marked.  Words inside any occurrence of a window are hit, and neighbouring
or overlapping occurrences join to a span.  ``decontaminated`` cuts spans of at least
``least_span`` words out of the texts and drops documents of which more than ``coverage``
is hit.

Documents are scanned where they lie, without a shuffle, whatever their size or number of
copies.  Items are cut into pieces of ``PIECE_WORDS`` words that overlap by a window less a
word, so that no window is lost, and dealt to automata of about ``AUTOMATON_WORDS`` words.
One automaton is on the driver and in the workers at a time; a larger benchmark takes more
passes, and each pass adds to the spans of the last one, which were written to the shared
folder.

Null and wordless texts have no words, no hits, and are kept.  Null and wordless items have
no windows.  Items that repeat an ``item_id`` count as one item; an item without an id hits
words but is not among the items named.  Repeated documents are judged row by row.  Other
columns pass through ``decontaminated`` and are absent from ``audit``; names may clash with
those used here.  An empty table on either side gives no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import fresh, prepare, store

WINDOW = 10
PIECE_WORDS = 10_000
AUTOMATON_WORDS = 200_000
# Word characters are digits, letters (A-Z become a-z) and all bytes of other scripts.
WORD_BYTES = re.compile(rb"[A-Z0-9a-z\x80-\xff]+")
FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLDED).split() if text else []


class Automaton:
    """States of the generalised suffix automaton of some pieces, as plain lists.

    ``step[s]`` maps a word number to the next state, ``link`` and ``length`` are the suffix
    link and the longest run of a state.  ``shelf[s]`` is the state of the last ``window``
    words of runs that end in ``s``, ``near[s]`` the nearest state from ``s`` upwards at which
    a short item ends, and ``items`` names the items of such states.
    """

    FIELDS = ("window", "numbers", "step", "link", "length", "shelf", "near", "items", "least")

    def __init__(self, *state):
        for name, value in zip(self.FIELDS, state, strict=True):
            setattr(self, name, value)

    def state(self) -> tuple:
        return tuple(getattr(self, n) for n in self.FIELDS)

    @classmethod
    def of(cls, pieces: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW) -> Automaton:
        pieces = [(item, words) for item, words in pieces if words]
        numbers: dict[bytes, int] = {}
        step: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def added(after: dict[int, int], size: int, suffix: int) -> int:
            step.append(after)
            link.append(suffix)
            length.append(size)
            return len(step) - 1

        def split(at: int, word: int) -> int:
            """The state of the run at ``at`` plus ``word`` alone, apart from longer runs in its state."""
            whole = step[at][word]
            if length[whole] == length[at] + 1:
                return whole
            part = added(dict(step[whole]), length[at] + 1, link[whole])
            link[whole] = part
            while at >= 0 and step[at].get(word) == whole:
                step[at][word] = part
                at = link[at]
            return part

        coded = [[numbers.setdefault(w, len(numbers)) for w in words] for _, words in pieces]
        for run in coded:
            last = 0
            for word in run:
                if word in step[last]:
                    last = split(last, word)
                    continue
                new, at = added({}, length[last] + 1, 0), last
                while at >= 0 and word not in step[at]:
                    step[at][word] = new
                    at = link[at]
                if at >= 0:
                    link[new] = split(at, word)
                last = new
        shelf, near, ends = list(range(len(step))), [-1] * len(step), set()
        by_length = sorted(range(1, len(step)), key=length.__getitem__)
        for s in by_length:
            if length[link[s]] >= window:
                shelf[s] = shelf[link[s]]
        items: dict[int, set] = {}
        for (item, _), run in zip(pieces, coded):
            at = 0
            for i, word in enumerate(run):
                at = step[at][word]
                if i + 1 >= window:
                    at = shelf[at]
                    items.setdefault(at, set()).add(item)
            if len(run) < window:
                ends.add(at)
                items.setdefault(at, set()).add(item)
        for s in by_length:
            near[s] = s if s in ends else near[link[s]]
        least = min((min(len(run), window) for run in coded), default=window)
        named = {s: [i for i in found if i is not None] for s, found in items.items()}
        return cls(window, numbers, step, link, length, shelf, near, named, least)

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[str], int]:
        """Hit spans [start, end), items with occurring windows, and the longest run of words that an item has."""
        step, link, length, near, window, least = self.step, self.link, self.length, self.near, self.window, self.least
        spans: list[list[int]] = []
        found: set[int] = set()
        longest = at = size = 0
        for end, word in enumerate(map(self.numbers.get, words), 1):
            if word is None:
                at = size = 0
                continue
            after = step[at].get(word)
            while after is None:
                at = link[at]
                size = length[at]
                after = step[at].get(word)
            at, size = after, size + 1
            if size > longest:
                longest = size
            if size < least:
                continue
            hit = 0
            if size >= window:
                found.add(self.shelf[at])
                hit = window
            # A state holds a short item only as its longest run.
            short = near[at] if size == length[at] or near[at] != at else near[link[at]]
            while short > 0:
                found.add(short)
                hit = max(hit, length[short])
                short = near[link[short]]
            if hit:
                _join(spans, end - hit, end)
        return spans, {i for s in found for i in self.items[s]}, longest


def _join(spans: list[list[int]], start: int, end: int) -> None:
    """Appends a span that ends last, joined with those that it touches."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append([start, end])


def joined(*several: Iterable) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted((s, e) for spans in several for s, e in spans):
        _join(out, start, max(end, out[-1][1] if out else 0))
    return out


FOUND = {"n_words": "long", "spans": "array<struct<start:int,end:int>>", "items": "array<string>", "longest": "int"}


def matched(
    docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, automaton_words: int = AUTOMATON_WORDS
) -> tuple[DataFrame, dict[str, str]]:
    """The documents with number of words, hit spans, items and longest match; and the names of these columns."""
    spark = docs.sparkSession
    prepare(spark)
    piece = max(PIECE_WORDS, 2 * window)
    pieces = store(
        items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).mapInArrow(
            _pieces(window, piece), "item string, piece int, n long, words binary"
        ).distinct(),
        "pieces",
    )
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    passes = max(1, -(-total // automaton_words))
    name = {n: fresh(n, docs.columns) for n in FOUND}
    found = ", ".join(f"`{name[n]}` {t}" for n, t in FOUND.items())
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), found])
    out = docs
    for i in range(passes):
        dealt = pieces.filter(F.pmod(F.xxhash64("item", "piece"), F.lit(passes)) == i)
        rows = dealt.select("item", "words").collect()  # about automaton_words words at most
        shared = spark.sparkContext.broadcast(Automaton.of(((r["item"], bytes(r["words"]).split()) for r in rows), window).state())
        out = out.mapInArrow(_scanned(shared, docs.columns.index(text), list(name.values()), i > 0), schema)
        if i + 1 < passes:
            out = store(out, "decontaminate")
    return out, name


def _pieces(window: int, piece: int):
    def run(batches):
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                for i, at in enumerate(range(0, max(1, len(words) - window + 1), piece - window + 1)):
                    part = words[at : at + piece]
                    if part:
                        rows.append((item, i, len(part), b" ".join(part)))
            columns = zip(*rows) if rows else ([], [], [], [])
            types = (pa.string(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["item", "piece", "n", "words"])

    return run


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scanned(shared, text: int, names: list[str], again: bool):
    def run(batches):
        automaton = Automaton(*shared.value)
        for b in batches:
            own = b.num_columns - (len(FOUND) if again else 0)
            before = [b.column(own + k).to_pylist() for k in range(1, 4)] if again else None
            counts, spans, items, longest = [], [], [], []
            for i, content in enumerate(b.column(text).cast(pa.binary())):
                words = words_of(content.as_py())
                hit, found, most = automaton.scan(words)
                if before is not None:
                    hit = joined(hit, ((s["start"], s["end"]) for s in before[0][i]))
                    found = found.union(before[1][i])
                    most = max(most, before[2][i])
                counts.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in hit])
                items.append(sorted(found))
                longest.append(most)
            columns = [
                pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string())), pa.array(longest, pa.int32())
            ]
            yield pa.RecordBatch.from_arrays([*b.columns[:own], *columns], [*b.schema.names[:own], *names])

    return run


def hit_words(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def audit(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, **options) -> DataFrame:
    """Words, hit words and items of every document."""
    found, name = matched(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), items, "text", window, **options)
    return found.select(
        "doc_id",
        F.col(name["n_words"]).alias("n_words"),
        hit_words(name["spans"]).alias("n_hit"),
        F.size(name["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(name["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(name["spans"]) > 0).alias("contaminated"),
        F.col(name["longest"]).alias("longest_match"),
        F.col(name["spans"]).alias("hit_spans"),
    )


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    least_span: int = 1,
    coverage: float = 0.8,
    **options,
) -> DataFrame:
    """The documents without their hit spans; those hit by more than ``coverage`` of their words go."""
    found, name = matched(docs, items, text, window, **options)
    spans = F.col(name["spans"])
    kept = found.filter(hit_words(name["spans"]) <= F.col(name["n_words"]) * F.lit(coverage))
    long = F.filter(spans, lambda s: s["end"] - s["start"] >= least_span)
    cut = kept.withColumn(name["spans"], long).mapInArrow(
        _cut(kept.columns.index(text), kept.columns.index(name["spans"])), kept.schema
    )
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the characters from a span's first word to its last."""
    out, at, words, read = [], 0, WORD_BYTES.finditer(text), 0
    for start, end in spans:
        first = next(islice(words, start - read, None))
        last = first if end - start == 1 else next(islice(words, end - start - 2, None))
        read = end
        out.append(text[at : first.start()])
        at = last.end()
    return b"".join([*out, text[at:]])


def _cut(text: int, spans: int):
    def run(batches):
        for b in batches:
            hit = np.flatnonzero(np.diff(b.column(spans).offsets.to_numpy())) if b.num_rows else []
            texts = b.column(text)
            if len(hit):
                changed = texts.cast(pa.binary()).to_pylist()
                for i in hit:
                    changed[i] = without_spans(changed[i], [(s["start"], s["end"]) for s in b.column(spans)[int(i)].as_py()])
                texts = pa.array(changed, pa.binary()).cast(texts.type)
            columns = list(b.columns)
            columns[text] = texts
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return run
