"""Mixing, sharding, exact and near duplicates, packing: against brute force and on awkward rows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import reference as R

from lamina.llm import exact, mixing, packing, sharding, simhash
from lamina.llm.queries import tokenizer_path


def rows(df):
    return [r.asDict() for r in df.collect()]


# mixing


def test_mix_meets_targets(corpus, clashing):
    got = rows(mixing.mix(clashing(corpus, "number", "block", "words"), block_words=64))
    texts = {r["doc_id"]: r["text"] for r in corpus.collect()}
    sizes, taken = Counter(), Counter()
    for r in got:
        assert r["size"] == len(R.words(texts[r["doc_id"]]))
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    expected = R.mix_targets(dict(sizes))
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
    assert all(abs(taken[s] - expected[s]) <= 1 for s in expected)
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), abs=len(sizes))


def test_mix_reruns_agree_and_interleaves(corpus):
    first, second = (sorted(map(str, rows(mixing.mix(corpus.repartition(n))))) for n in (3, 5))
    assert first == second
    sized = corpus.select("source", mixing.n_words().alias("size")).groupBy("source").agg({"size": "sum"})
    plan = mixing.targets(sized.withColumnRenamed("sum(size)", "source_size"))
    slots = sorted(mixing.schedule(plan, 16).select("slot", "number").collect())
    share = Counter(n for _, n in slots)
    half = Counter(n for _, n in slots[: len(slots) // 2])
    assert all(abs(half[n] - share[n] / 2) <= 12 for n in share)


def test_mix_edges(documents):
    assert mixing.mix(documents()).count() == 0
    got = rows(mixing.mix(documents((1, None), (2, ""))))
    assert [r["taken"] for r in got] == [0, 0]
    got = rows(mixing.mix(documents((None, "a b c", None, "s"), (None, "a b c", None, "s"), (3, "d", None, "t"))))
    assert sum(r["taken"] for r in got) == 7 and all(r["taken"] <= 3 * r["size"] for r in got)
    copies = mixing.mixed_documents(documents((1, "a b", "en", "s"), (2, None, "en", "s"), (3, "x " * 10, "en", "t")))
    assert Counter(r["doc_id"] for r in rows(copies)) == {1: 3, 3: 1}


# sharding


def test_slots_balance(corpus, clashing):
    got = rows(sharding.shard_by_bytes(clashing(corpus.filter("doc_id <> 9004")), 4))
    load, places = Counter(), defaultdict(list)
    texts = {r["doc_id"]: r["text"] for r in corpus.collect()}
    for r in got:
        assert r["size"] == len((texts[r["doc_id"]] or "").encode()) + 8
        assert r["text_crc32"] == R.crc(texts[r["doc_id"]])
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert len(got) == len(texts) - 1 and set(load) == {0, 1, 2, 3}
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values()) / 4
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_slot_map_versions(spark, tmp_path):
    weights = {i: random.Random(i).randint(1, 1000) for i in range(256)}
    first = sharding.SlotMap.dealt(5, 256)
    second = first.rebalanced(weights)
    load = Counter()
    for slot, shard in enumerate(second.shard_of):
        load[shard] += weights[slot]
    assert max(load.values()) - min(load.values()) <= 5 and second.version == 1
    assert {i for i in range(256) if first.shard_of[i] != second.shard_of[i]} == set(second.moved)
    assert second.rebalanced(weights).moved == ()
    third = second.grown(weights)
    assert third.moved and all(third.shard_of[i] == 5 for i in third.moved)
    for m in (first, second, third):
        m.save(spark, str(tmp_path))
    assert sharding.SlotMap.load(spark, str(tmp_path), 1).shard_of == second.shard_of
    assert sharding.SlotMap.load(spark, str(tmp_path), 2).shard_of == third.shard_of


def test_sharding_edges(documents):
    assert sharding.shard_by_bytes(documents(), 3).count() == 0
    got = rows(sharding.shard_by_bytes(documents((None, "a"), (None, "a"), (None, None), (1, ""), (1, "")), 2))
    assert len(got) == 5
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in by.values())


# exact duplicates


@pytest.mark.parametrize("table_bytes", [exact.TABLE_BYTES, 2000])
def test_exact_classes(corpus, corpus_rows, clashing, table_bytes):
    got = {r["doc_id"]: r for r in rows(exact.duplicate_classes(clashing(corpus).repartition(5), table_bytes=table_bytes))}
    expected = R.exact_classes(corpus_rows)
    assert {k: (r["keep_id"], r["group_size"], r["text_sha256"]) for k, r in got.items()} == expected
    assert all(r["kept"] == (k == r["keep_id"]) for k, r in got.items())


def test_exact_edges(documents):
    assert exact.duplicate_classes(documents()).count() == 0
    got = rows(exact.duplicate_classes(documents((None, "a"), (5, " a"), (5, " a"), (2, "a "), (7, None), (3, "\n"))))
    assert sum(r["kept"] for r in got) == 2 and len(got) == 6
    assert {(r["keep_id"], r["group_size"]) for r in got} == {(2, 4), (3, 2)}


def test_colliding_hashes_are_compared():
    records = [(7, c, (i,)) for i, c in enumerate([b"a", b"b", b"a", b"c" * 50, b"b", b"c" * 50])]
    for size in (1 << 20, 1):
        classes = defaultdict(set)
        for _, _, (i,), of in exact.grace_classes(iter(records), size):
            classes[of].add(i)
        assert sorted(map(sorted, classes.values())) == [[0, 2], [1, 4], [3, 5]]


# near duplicates


def test_simhash_components(corpus, corpus_rows, clashing):
    got = {r["doc_id"]: r for r in rows(simhash.near_duplicates(clashing(corpus)))}
    prints = {i: R.simhash(t) for i, t in corpus_rows}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == R.near_components(prints)


def test_meeting_places_lose_no_link(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = set(base)
    for b in base:
        for _ in range(6):
            prints.add(b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 3))))
    nodes = spark.createDataFrame([(f"{p:016x}",) for p in prints], "fingerprint string")
    pairs = simhash.links(nodes, simhash.NEAR_EXACT)
    roots = {r["node"]: r["root"] for r in simhash.components(pairs).collect()}
    got, want = defaultdict(set), defaultdict(set)
    expected = R.near_components({p: p for p in prints})
    for p in prints:
        got[roots.get(f"{p:016x}", f"{p:016x}")].add(p)
        want[expected[p]].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    pairs = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(300)], "low string, high string")
    got = {r["node"]: r["root"] for r in simhash.components(pairs).collect()}
    assert len(got) == 301 and set(got.values()) == {"0000"}


def test_similar_documents_go_and_others_stay(documents):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    texts = [rng.choices(vocabulary, k=300) for _ in range(40)]
    copies = []
    for t in texts[:20]:
        c = list(t)
        for at in rng.sample(range(300), 3):
            c[at] = rng.choice(vocabulary)
        copies.append(c)
    df = documents(*[(i, " ".join(t)) for i, t in enumerate(texts + copies)], (None, None))
    kept = {r["doc_id"] for r in rows(simhash.kept_documents(df))}
    assert kept >= set(range(40)) | {None}
    assert len(kept & set(range(40, 60))) <= 1


def test_similar_links_are_verified(documents):
    """Families of copies on both sides of 0.8: the groups are those of the exact similarities."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    texts = []
    for changed in [(20,), (22,), (24,), (26,), (30,), (21, 25, 20, 28)] * 6:
        text = rng.choices(vocabulary, k=1000)
        texts.append(text)
        for n in changed:
            copy = list(texts[-1])
            first = rng.randrange(30)
            for at in range(n):
                copy[first + 31 * at] = "other" + rng.choice(vocabulary)
            texts.append(copy)
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    got = {r["doc_id"]: r["component_id"] for r in rows(simhash.near_duplicates(documents(*enumerate(map(" ".join, texts))), simhash.SIMILAR))}
    assert {i for i in got if got[i] != i} and {i for i, r in enumerate(root) if r == i} > set(range(0, 10, 2))
    assert not [i for i in got if root[got[i]] != root[i]]  # nothing below 0.8 is linked
    assert sum(got[i] != r for i, r in enumerate(root)) <= 1  # a pair at 0.8 meets with a chance of 99.5 %


def test_candidates_apart_are_verified_too(documents):
    """A pair that the spanning search never names, between groups that its links don't join."""
    scheme = simhash.Scheme(5, 1, 64, ((0, 1, 1),), 0.8)  # everything meets everything
    rng = random.Random(2)
    one, two = ([f"w{rng.randrange(10**6)}" for _ in range(200)] for _ in range(2))
    near = [one, two, two[:190] + one[:5]]
    got = rows(simhash.near_duplicates(documents(*enumerate(map(" ".join, near))), scheme))
    assert {r["doc_id"]: r["component_id"] for r in got} == {0: 0, 1: 1, 2: 1}


def test_dense_groups_make_no_rows_by_their_square(documents, monkeypatch):
    """Texts that are all near and all below 0.8 but for one pair: every stored table is linear in them."""
    scheme = simhash.Scheme(5, 4, 256, ((0, 1, 1),), 0.8)  # everything meets everything
    rng, made = random.Random(4), {}
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = [[f"x{rng.randrange(10**6)}" if rng.random() < 0.08 else w for w in base] for _ in range(60)]
    texts.append([*texts[7][:-1], "end"])
    kept = simhash.store

    def counted(df, name):
        made[name] = (stored := kept(df, name)).count()
        return stored

    monkeypatch.setattr(simhash, "store", counted)
    got = rows(simhash.near_duplicates(documents(*enumerate(map(" ".join, texts))), scheme))
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: 7 if i == 60 else i for i in range(61)}
    assert max(made.values()) <= 4 * 61


def test_components_of_several_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FOREST_LINKS", 50)
    pairs = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(300) if i != 99], "low string, high string")
    got = {r["node"]: r["root"] for r in simhash.components(pairs).collect()}
    assert got == {f"{i:04d}": "0000" if i < 100 else "0100" for i in range(301)}


def test_simhash_edges(documents):
    assert simhash.near_duplicates(documents()).count() == 0
    got = rows(simhash.near_duplicates(documents((4, None), (3, " "), (3, " "), (None, "one two"), (9, "ONE two"))))
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(4, 3), (3, 3), (None, 9), (9, 9)}
    assert len(got) == 5


# packing


def brute_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        at = min((i for i, room in enumerate(bins) if room >= n), key=lambda i: bins[i], default=None)
        if at is None:
            bins.append(capacity - n)
        else:
            bins[at] -= n
    return sorted(bins)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 20, 64])
    histogram = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 150)))
    runs, n = packing.best_fit_plan(dict(histogram), capacity)
    used, seen = defaultdict(list), Counter()
    for at, (length, rank, per, first, base) in enumerate(runs):
        later = [r[1] for r in runs[at + 1 :] if r[0] == length]
        upto = later[0] if later else histogram[length]
        for step in range(upto - rank):
            used[first + step // per].append((base + step % per * length, length))
            seen[length] += 1
    assert seen == histogram and set(used) == set(range(n))
    rooms = []
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        rooms.append(capacity - at)
    assert sorted(rooms) == brute_best_fit(histogram.elements(), capacity)


def test_packing(corpus, clashing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = rows(packing.pack_documents(clashing(corpus, "length", "bucket", "rank", "run"), tokenizer_path()))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for d in corpus.collect():
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        at = 0
        for i, p in enumerate(sorted(by_doc[d["doc_id"]], key=lambda r: r["piece"])):
            part = np.array(ids[at : at + p["length"]], dtype="<u4").tobytes()
            assert (p["piece"], p["start"], p["ids_crc32"]) == (i, at, zlib.crc32(part))
            assert i == 0 or p["length"] == 2048
            at += p["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for p in sorted(places, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    rooms = brute_best_fit([r["length"] for r in got], 2048)
    assert len(by_sequence) == len(rooms)


def test_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = ["", " ", "a", "  x  y\n\n z", " lead", "trail ", "don't you're 12ab \t q", "<|endoftext|> hi<|endoftext|>", "a\x85b \x1c c", "字 字 x", "x\ny z\n"]
    rng = random.Random(2)
    texts += ["".join(rng.choices("ab é'ſ1\n\t .,-字", k=rng.randint(1, 60))) for _ in range(500)]
    found = packing.Ids(tokenizer_path()).encode(texts)
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_edges(documents):
    assert packing.pack_documents(documents(), tokenizer_path()).count() == 0
    got = rows(packing.pack_documents(documents((1, None), (1, ""), (None, "x")), tokenizer_path()))
    assert sorted(r["length"] for r in got) == [1, 1, 2] and {r["sequence_id"] for r in got} == {0}


def test_ids_of_long_white_space(documents, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_BYTES", 1000)
    texts = ["a" + " " * 1_000_000 + "b", "x" + "\n" * 300_000 + "y z", "word " * 5000]
    tokenizer = packing.Tokenizer.from_file(tokenizer_path())
    expected = [len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
    got = rows(packing.pack_documents(documents(*enumerate(texts)), tokenizer_path()))
    assert [sum(r["length"] for r in got if r["doc_id"] == i) for i in range(3)] == expected
