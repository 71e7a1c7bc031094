"""The stages, one after the other, against what their operators' brute-force versions say."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
import reference as R
from pyspark.sql import functions as F

from lamina.llm import mixing
from lamina.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Each stage's rows, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
    return out


def test_stages_are_named_and_keep_columns(steps):
    names = ["language_id", "line_dedup", "near_duplicates", "source_mix", "best_fit"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    assert all(list(steps[n][0].asDict()) == COLUMNS for n in names[:-1])


def test_language_keeps_what_it_recognises(steps):
    kept = {r["doc_id"]: r["text"] for r in steps["language_id"]}
    assert kept.items() <= {r["doc_id"]: r["text"] for r in steps["documents"]}.items()
    assert len(kept) >= 0.98 * len(steps["documents"])


def test_lines_only_go(steps):
    before = {r["doc_id"]: r["text"].split("\n") for r in steps["language_id"]}
    seen = {}
    for i in sorted(before):
        for line in before[i]:
            seen.setdefault(line.strip(), i)
    after = {r["doc_id"]: r for r in steps["line_dedup"]}
    for i, lines in before.items():
        kept = after[i]["text"].split("\n") if i in after else []
        assert not Counter(kept) - Counter(lines)
        gone = Counter(lines) - Counter(kept)
        assert all(seen[x.strip()] < i for x in gone if x.strip())
        if i in after:
            assert after[i]["n_chars"] == len(after[i]["text"])
            assert any(x.strip() for x in kept) or lines == kept


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_near_copies_go_and_others_stay(steps):
    before = {r["doc_id"]: shingles(r["text"]) for r in steps["line_dedup"]}
    kept = {r["doc_id"] for r in steps["near_duplicates"]}
    for i in before.keys() - kept:  # each dropped one is like one that stays
        assert max(len(before[i] & before[k]) / len(before[i] | before[k]) for k in kept) > 0.6
    copies = defaultdict(set)
    for i, s in before.items():
        copies[frozenset(s)].add(i)
    assert all(len(group & kept) == 1 for group in copies.values())


def test_mix_repeats_documents_toward_targets(steps):
    sizes = Counter()
    for r in steps["near_duplicates"]:
        sizes[r["source"]] += len(R.words(r["text"]))
    target, taken = R.mix_targets(dict(sizes)), Counter()
    copies = Counter(r["doc_id"] for r in steps["source_mix"])
    for r in steps["source_mix"]:
        taken[r["source"]] += len(R.words(r["text"]))
    longest = max(len(R.words(r["text"])) for r in steps["near_duplicates"])
    assert all(abs(taken[s] - target[s]) <= longest for s in target) and max(copies.values()) <= 3


def test_packing_is_a_round_trip(steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected, found, room = Counter(), Counter(), defaultdict(list)
    for r in steps["source_mix"]:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        for at, upto in zip([0, *range(first, len(ids), 2048)], [*range(first, len(ids) + 1, 2048)]):
            expected[r["doc_id"], at, zlib.crc32(np.array(ids[at:upto], dtype="<u4").tobytes())] += 1
    for p in steps["best_fit"]:
        found[p["doc_id"], p["start"], p["ids_crc32"]] += 1
        room[p["sequence_id"]].append((p["offset"], p["length"]))
    assert found == expected
    for places in room.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_is_the_chain(spark, steps):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ran = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).select(*columns).collect())
    assert ran == Counter(tuple(r[c] for c in columns) for r in steps["best_fit"])


def test_awkward_and_empty_documents_pass_every_stage(spark, documents, clashing):
    odd = documents(
        (1, None), (2, ""), (None, "the cat and the dog of the house", "en", None), (4, "the cat", "en", "a"), (4, "the cat", "en", "a"),
        (5, "der hund und die katze", "de", "b"), (6, "x " * 20_000, "en", "a"),
    )
    for docs in (clashing(odd, "copies", "copy", "dropped", "id", "size", "matches"), documents()):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
            assert name == "best_fit" or docs.columns == columns
    kept = corpus_pipeline.near_duplicates(spark, odd, SF).filter(F.col("doc_id") == 4).count()
    assert kept == 2  # repeated rows of the smallest doc_id


def test_every_operator_is_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 11))
    assert mixing.MAX_EPOCHS == 3
