"""Line deduplication by pairwise alignment.

Two documents overlap if they share a line.  A line's owner is the first document that
has it (smallest doc_id), and every later holder is paired with the owner.  So a line of
any frequency gives as many pairs as holders, never their square, and no frequency is too
high to be worked off.  A pair is aligned by patience diff over the lines that the one
owns and the other has: lines that occur once in both are anchors, the longest increasing
run of anchors is kept, blocks grow from anchors over equal neighbours, and what lies
between two anchors is aligned in the same way.  Aligned blocks are deleted from the later
document, if they hold a line of ``LEAST_WORDS`` words or more: shorter ones are shared by
chance.

The owner of a line need not be the document that a block was copied from.  So runs of two
neighbouring lines or more that hold such a line are also compared with those of every
earlier document, without pairs: a run goes from a long line over the short ones beside it,
on to the next long one, and is named by a hash of its lines and of how often the
document had it before.  If an earlier document has the name, the run's ends are deleted; the lines
between are ends of shorter runs.  Every line of a run that any earlier document
has is such an end, wherever the run stands there, so copies go whole.  A line that shares no neighbour with
any earlier document is left to the alignment with its owner alone.

Lines are compared without white space at their ends, by hashes of 128 bits.  Blank lines
are never shared and stay.  Within one document nothing is deleted.  Null texts stay null,
empty ones empty.  Rows with a null doc_id are not compared and stay as they are.  Rows
that repeat a doc_id are never aligned with each other; each loses what earlier documents
have.  Other columns are passed through, but for ``n_lines`` and ``n_removed``, which are
replaced.  An empty table gives no rows.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import fresh, prepare, store

LEAST_WORDS = 3


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (in a, in b) of two sequences, increasing in both."""
    out: list[tuple[int, int]] = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        anchors = _anchors(a, b, a0, a1, b0, b1)
        if not anchors:
            continue
        out += anchors
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
            if i + 1 < k and j + 1 < m:
                stack.append((i + 1, k, j + 1, m))
    return sorted(out)


def _anchors(a, b, a0, a1, b0, b1) -> list[tuple[int, int]]:
    """The longest increasing run of elements that occur once on either side."""
    first, second = _single(a, a0, a1), _single(b, b0, b1)
    pairs = sorted((i, second[x]) for x, i in first.items() if i is not None and second.get(x) is not None)
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        if p == len(tops):
            tops.append(j)
            at.append(n)
        else:
            tops[p], at[p] = j, n
        back.append(at[p - 1] if p else -1)
    run, n = [], at[-1] if at else -1
    while n >= 0:
        run.append(pairs[n])
        n = back[n]
    return run[::-1]


def _single(x, low, high) -> dict:
    found: dict = {}
    for i in range(low, high):
        found[x[i]] = None if x[i] in found else i
    return found


def split_lines(text: str | None) -> list[str]:
    return text.split("\n") if text else []


HELD = "line binary, doc_id long, version long, places binary, words int"


def runs_of(names: list[bytes], long: list[bool]) -> list[tuple[bytes, int, int]]:
    """(name, one end, other end) of the runs from each long line to the lines beside it, up to the next long one."""
    out, times = [], defaultdict(int)
    for p in range(len(names)):
        if not long[p]:
            continue
        for step in (1, -1):
            name, q = names[p], p + step
            # The run between two long lines is taken once, forward.
            while 0 <= q < len(names) and not (long[q] and step < 0):
                name = xxhash.xxh3_128_digest(name + names[q] + (b"+" if step > 0 else b"-"))
                times[name] += 1
                out.append((xxhash.xxh3_128_digest(name + times[name].to_bytes(4)), p, q))
                if long[q]:
                    break
                q += step
    return out


def held_lines(least_words: int):
    """(line, doc_id, version, places, words) of each different line of each document.

    Runs of lines have the places of their ends, and no words.
    """

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, version, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                places, order = defaultdict(list), []
                for n, line in enumerate(split_lines(text)):
                    if line := line.strip():
                        places[line].append(n)
                        order.append((n, line))
                known = {line: (xxhash.xxh3_128_digest(line.encode()), len(line.split())) for line in places}
                for line, at in places.items():
                    name, words = known[line]
                    rows.append((name, doc_id, version, array("i", at).tobytes(), words))
                ends = runs_of([known[x][0] for _, x in order], [known[x][1] >= least_words for _, x in order])
                rows += [(name, doc_id, version, array("i", (order[p][0], order[q][0])).tobytes(), None) for name, p, q in ends]
            for i in range(0, len(rows), 20_000):
                types = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows[i : i + 20_000]), types)]
                yield pa.RecordBatch.from_arrays(columns, ["line", "doc_id", "version", "places", "words"])

    return run


def _places(data: bytes) -> list[int]:
    return array("i", data).tolist()


def common_blocks(matches: list[dict], least_words: int) -> set[int]:
    """Places to delete from a document, given the lines that it shares with each owner, and its runs that an earlier one has."""
    by_owner = defaultdict(dict)
    gone: set[int] = set()
    for m in matches:
        if m["words"] is None:
            gone.update(_places(m["places"]))
        else:
            by_owner[m["owner"], m["owner_version"]][m["line"]] = m
    for shared in by_owner.values():
        if all(m["words"] < least_words for m in shared.values()):
            continue
        first = sorted((p, m["line"]) for m in shared.values() for p in _places(m["owner_places"]))
        later = sorted((p, m["line"]) for m in shared.values() for p in _places(m["places"]))
        block: list[tuple[int, int]] = []
        for i, j in [*patience([x for _, x in first], [x for _, x in later]), (-1, -1)]:
            if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
                if any(shared[later[k][1]]["words"] >= least_words for _, k in block):
                    gone.update(later[k][0] for _, k in block)
                block = []
            block.append((i, j))
    return gone


def deduplicated(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents without the blocks that earlier ones have, n_lines and n_removed."""
    prepare(docs.sparkSession)
    docs = docs.drop("n_lines", "n_removed")
    version = F.xxhash64("text")
    known = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), version.alias("version"), "text")
    held = store(known.mapInArrow(held_lines(least_words), HELD), "held-lines")
    # Stored, so that the join below has a shuffle on either side and a frequent line's is split.
    owners = store(
        held.groupBy("line")
        .agg(F.min(F.struct("doc_id", "version", "places")).alias("first"), F.max("doc_id").alias("last"))
        .filter(F.col("last") > F.col("first.doc_id"))
        .select(
            "line",
            F.col("first.doc_id").alias("owner"),
            F.col("first.version").alias("owner_version"),
            F.col("first.places").alias("owner_places"),
        ),
        "owners",
    )
    matches, id_, version_ = (fresh(n, docs.columns) for n in ("matches", "id", "version"))
    shared = held.join(owners, "line").filter("doc_id > owner")
    # A document's lines and at most twice as many runs, once each, also where its row is repeated: bounded by its text.
    per_doc = shared.groupBy(F.col("doc_id").alias(id_), F.col("version").alias(version_)).agg(
        F.collect_set(F.struct("owner", "owner_version", "line", "owner_places", "places", "words")).alias(matches)
    )
    same = (F.col("doc_id") == F.col(id_)) & (version == F.col(version_))
    joined = docs.join(per_doc, same, "left").select(*docs.columns, matches)
    out = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    return joined.mapInArrow(_without_blocks(docs.columns, least_words), out)


def _without_blocks(columns: list[str], least_words: int):
    at = columns.index("text")

    def run(batches):
        for b in batches:
            texts, counts, removed = [], [], []
            for text, matches in zip(b.column(at).to_pylist(), b.column(len(columns)).to_pylist()):
                kept = split_lines(text)
                counts.append(len(kept))
                gone = common_blocks(matches, least_words) if matches else ()
                removed.append(len(gone))
                texts.append("\n".join(x for i, x in enumerate(kept) if i not in gone) if gone else text)
            new = [b.column(i) for i in range(len(columns))]
            new[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*new, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], [*columns, "n_lines", "n_removed"]
            )

    return run
