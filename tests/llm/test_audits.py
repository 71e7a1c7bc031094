"""Divergence audit, hard negatives, decontamination: against SQL, brute force and on awkward rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from oracle import compare

from lamina.llm import decontaminate, divergence, hard_negatives
from lamina.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert compare(spark, SF, QUERIES[name], ORACLES[name]) in (None, "no rows")


# divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def divergences(docs, least, top=50):
    """(text, lang, source) rows to {(lang, source, part, rank): (item, value)}."""
    docs = [(TERM.findall(folded(t)), lang or "", source or "") for t, lang, source in docs]
    seen, counts, groups = {}, {}, {(lang, s) for _, lang, s in docs}
    for terms, lang, source in docs:
        for t in set(terms):
            seen[lang, t] = seen.get((lang, t), 0) + 1
        for t in terms:
            counts[lang, source, t] = counts.get((lang, source, t), 0) + 1
    out = {}
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (at, t), n in seen.items() if at == lang and n >= least)
        sources = sorted(s for at, s in groups if at == lang)
        n = {s: sum(counts.get((lang, s, t), 0) for t in kept) for s in sources}
        p = {s: [1 + 10**9 * (counts.get((lang, s, t), 0) + 5) // (n[s] + 5 * len(kept)) for t in kept] for s in sources}
        whole = [sum(counts.get((lang, s, t), 0) for s in sources) for t in kept]
        q = [1 + 10**9 * (c + 5) // (sum(whole) + 5 * len(kept)) for c in whole]
        for s in sources:
            pairs = [(sum(abs(a - b) for a, b in zip(p[s], p[o])), o) for o in sources if o != s]
            over = [(a - b, t) for a, b, t in zip(p[s], q, kept) if counts.get((lang, s, t), 0) and a > b]
            for part, found, most in (("pair", pairs, None), ("term", over, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out[lang, s, part, rank] = item, value
    return out


def as_divergences(df):
    return {(r["lang"], r["source"], r["part"], r["rank"]): (r["item"], r["value"]) for r in rows(df)}


ODD_DOCUMENTS = [
    (1, "Ünï cat CAT dog", "en", "a"), (1, "cat dog", "en", "a"), (2, "cat 字 x1y", "en", "b"), (3, None, "en", "c"),
    (4, "dog dog é", None, None), (5, "dog", None, "z"), (None, "", "xx", "a"), (7, "solo", "xx", "b"), (8, "cat \x00\t dog@cat", "en", "b"),
]


@pytest.mark.parametrize("small", [{}, {"tile": 2, "bucket_postings": 4, "block_postings": 3, "merge_bytes": 300, "shards": 3}])
def test_divergence_of_awkward_rows(documents, clashing, small):
    docs = clashing(documents(*ODD_DOCUMENTS), "n", "number", "bucket", "term", "count").repartition(3)
    expected = divergences([r[1:] for r in ODD_DOCUMENTS], 1)
    assert as_divergences(divergence.audit(docs, least=1, **small)) == expected


@pytest.mark.parametrize("small", [{}, {"tile": 3, "bucket_postings": 500, "block_postings": 2000, "merge_bytes": 20_000}])
def test_divergence_of_the_corpus(corpus, small):
    docs = [(r["text"], r["lang"], r["source"]) for r in corpus.collect()]
    assert as_divergences(divergence.audit(corpus.repartition(4), least=5, **small)) == divergences(docs, 5)


def test_divergence_without_rows_or_terms(documents):
    assert divergence.audit(documents()).count() == 0
    got = as_divergences(divergence.audit(documents((1, "a", "en", "s"), (2, "b", "en", "t"), (3, "c", "fr", "s"))))
    assert got == {("en", "s", "pair", 1): ("t", 0), ("en", "t", "pair", 1): ("s", 0)}


def test_corrections_are_the_differences_over_known_terms():
    rng = np.random.default_rng(3)
    base = rng.integers(1, 50, 6)
    full = np.tile(base, (40, 1))
    known = rng.random(full.shape) < 0.4
    full[known] = rng.integers(1, 10**9, known.sum())
    term, number = np.nonzero(known)
    got = divergence.corrections(number, term, full[known], base)
    for a in range(6):
        for b in range(6):
            either = known[:, a] | known[:, b]
            expected = (np.abs(full[:, a] - full[:, b]) - abs(base[a] - base[b]))[either].sum()
            assert got[a, b] == (expected if a != b else 0)


# hard negatives


def negatives(points, percent=80, k=5):
    """(vec_id, vector, label) to the result rows, by whole scans."""
    out = set()
    ints = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64), label) for i, v, label in points]
    for anchor, q, own in ints:
        if anchor % 100:
            continue
        scored = [(-int(q @ v), i, label) for i, v, label in ints if i != anchor]
        for ps, positive, _ in sorted(x for x in scored if x[2] == own)[:k]:
            fits = sorted(x for x in scored if x[2] != own and percent * -ps <= 100 * -x[0] <= 100 * -ps)
            out |= {(anchor, positive, rank, n, -ps, -s) for rank, (s, n, _) in enumerate(fits[:k], 1)}
    return out


def mined(df, **options):
    found = hard_negatives.mine(df, df["vec_id"] % 100 == 0, **options)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return [tuple(r[n] for n in names) for r in found.collect()]


POINTS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("small", [{}, {"cell_rows": 40, "block_rows": 30}])
def test_hard_negatives_are_exact(spark, small):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    points = [
        (i, (centres[i % 12] * rng.uniform(0.5, 2) + rng.normal(size=8) * 0.2).astype(np.float32).tolist(), int(rng.integers(0, 3)))
        for i in range(900)
    ]
    # A third are copies, so that scores tie.
    points += [(1000 + i, points[0][1], i % 2) for i in range(400)]
    df = spark.createDataFrame(points, POINTS).repartition(5)
    got = mined(df, **small)
    assert set(got) == negatives(points) and len(got) == len(set(got))


def test_the_tree_eliminates_and_loses_nothing():
    rng = np.random.default_rng(8)
    data = np.repeat(rng.normal(size=(40, 6)) * 50, 50, axis=0) + rng.normal(size=(2000, 6))
    top = float((data**2).sum(axis=1).max())
    tree, leaf = hard_negatives.Tree.grown(hard_negatives.on_sphere(data, top), 64)
    anchors = data[::100]
    scores = anchors @ data.T
    high = np.sort(scores, axis=1)[:, -10:-9]
    low = np.sort(scores, axis=1)[:, -30:-29]
    near, far = hard_negatives.annuli(anchors, low, high, top)
    reach = tree.reach(np.column_stack([anchors, np.zeros(len(anchors))]), near, far)
    wanted = (scores >= low) & (scores <= high)
    assert all(reach[a, leaf[r]] for a, r in zip(*np.nonzero(wanted)))
    assert reach.mean() < 0.5


def test_hard_negatives_of_awkward_rows(spark, clashing):
    assert mined(spark.createDataFrame([], POINTS)) == []
    nan, inf = float("nan"), float("inf")
    bad = [
        (None, [1.0, 0.0], 1), (5, None, 1), (6, [], 1), (7, [nan, 1.0], 1), (8, [1.0, inf], 2), (9, [None, 1.0], 2), (10, [1.0] * 3, 2),
        (11, [1.0, 1.0], None), (12, [1e30, 1.0], 2),
    ]
    good = [(100, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.9, 0.5], 2), (3, [0.9, 0.5], 2), (4, [-1.0, 0.0], 1), (200, [0.0, 0.0], 2)]
    df = clashing(spark.createDataFrame(bad + good, POINTS), "cell", "block", "rank", "score", "vector", "dims")
    assert set(mined(df)) == negatives(good)
    # Repeated rows: an anchor counts once, others are rows of their own, and none is its own partner.
    repeated = good + [(100, [1.0, 0.5], 1), (2, [0.9, 0.5], 2)]
    got = mined(spark.createDataFrame(repeated, POINTS))
    of_first = sorted((rank, n) for a, p, rank, n, *_ in got if (a, p) == (100, 1))
    assert of_first == [(1, 2), (2, 2), (3, 3)]


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminations(docs, items, window=10):
    """(doc_id, text) and (item_id, text) to (doc_id, n_words, n_hit, n_items, sha) rows."""
    windows = {}
    for item, text in items:
        w = WORD.findall(folded(text))
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(item)
    lengths = sorted({len(g) for g in windows})
    out = []
    for doc, text in docs:
        w = WORD.findall(folded(text))
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                if (g := tuple(w[i : i + m])) in windows:
                    hit |= set(range(i, i + m))
                    found |= windows[g]
        ids = sorted(str(i) for i in found - {None})
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def audited(docs, items, **options):
    got = rows(decontaminate.audit(docs, items, **options))
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in got)
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in got), key=str)


ITEMS = "item_id long, text string"


@pytest.mark.parametrize("automaton_words", [decontaminate.AUTOMATON_WORDS, 40])
def test_hits_against_brute_force(spark, documents, automaton_words):
    rng = random.Random(4)

    def phrase(n):
        return " ".join(rng.choice(["a", "b", "A", "é", "7x"]) for _ in range(n))

    items = [(i, phrase(rng.choice([0, 1, 3, 4, 9, 10, 11, 25]) if i else 6)) for i in range(12)]
    items = [(i, t) for i, t in items if len(t.split()) != 1]
    docs = [(i, phrase(rng.randint(0, 60)) + rng.choice(["", ".", " - zz "]) + phrase(9)) for i in range(60)]
    docs += [(100 + i, f"zz {t} zz, {t}") for i, t in items]
    got = audited(documents(*docs).repartition(3), spark.createDataFrame(items, ITEMS), window=5, automaton_words=automaton_words)
    assert got == contaminations(docs, items, window=5)


def test_pieces_lose_no_window(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 25)
    words = [f"w{i}" for i in range(200)]
    items = [(1, " ".join(words))]
    docs = [(i, "x " + " ".join(words[i : i + 10]) + " y") for i in range(191)] + [(500, " ".join(words[3:12]))]
    got = audited(documents(*docs), spark.createDataFrame(items, ITEMS), automaton_words=60)
    assert got == contaminations(docs, items)


def test_decontamination_of_awkward_rows(spark, documents, clashing):
    nothing = spark.createDataFrame([], ITEMS)
    long = "wort " * 50_000
    ten = "one two three four five six seven eight nine ten"
    docs = [(None, None), (1, ""), (2, " \n"), (3, ten.upper()), (3, ten.upper()), (4, f"so {ten}, so on"), (5, "Yes no"), (6, long)]
    frame = clashing(documents(*docs), "n_words", "spans", "items", "longest")
    items = [(9, ten), (9, ten + " eleven"), (None, "yes no"), (10, None), (11, "!"), (12, "wort wort")]
    given = spark.createDataFrame(items, ITEMS)
    assert audited(frame, given) == contaminations(docs, items)
    assert audited(documents(), given) == []
    assert audited(frame, nothing) == contaminations(docs, [])
    kept = decontaminate.decontaminated(frame, given)
    assert kept.columns == frame.columns
    assert {(r["doc_id"], r["text"]) for r in rows(kept)} == {(None, None), (1, ""), (2, " \n"), (4, "so , so on")}
    assert decontaminate.decontaminated(frame, given, least_span=11, coverage=1.0).filter("doc_id = 4").first()["text"] == docs[5][1]
    assert decontaminate.decontaminated(documents(), given).count() == 0


def test_spans_are_cut_by_characters():
    text = "Ä one, two three: four! fünf".encode()
    assert decontaminate.without_spans(text, [(1, 3), (4, 5)]).decode() == "Ä  three: ! fünf"
    assert decontaminate.without_spans(text, [(0, 6)]) == b""


def test_longest_match(documents, spark):
    items = spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    got = rows(decontaminate.audit(documents((1, "x b c d e x a b"), (2, "z")), items, window=3))
    assert {r["doc_id"]: r["longest_match"] for r in got} == {1: 4, 2: 0}
