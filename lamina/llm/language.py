"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is its letters in lower case, with a boundary between words.  Its subwords are the
runs of two to four characters of that, each hashed to a row of an embedding table; the
mean of these rows goes through a linear softmax.  Table and softmax are trained together
by stochastic gradient descent in numpy, on a bounded sample of labelled rows, whose
subwords are counted in the tasks that read them.  A part of the sample is kept back: it
sets a temperature, which makes scores calibrated probabilities, and the score below
which a text is rejected, chosen so that ``reject_share`` of labelled texts fall below.

For prediction, embedding and softmax fold into one table of a score per subword and
language, so a text of any length is read whole in one pass.

A null text or one without letters is ``und`` with score 0, and rejected.  Rows with a
null doc_id or lang are never learned from.  Without labelled rows all is ``und``.
Repeated rows and other columns change nothing but the sample.
"""

from __future__ import annotations

import math
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import prepare

BUCKETS = 1 << 15
DIMS = 16
SIZES = (2, 3, 4)
# The sample: rows a language, and in all.
PER_LANGUAGE = 400
SAMPLE_ROWS = 8000
EPOCHS = 6
RATE = 0.5
SEED = 3
UNKNOWN = "und"
# Characters that are hashed at once; longer texts are worked off in such steps.
STEP = 1 << 20


@dataclass(frozen=True)
class Model:
    """Scores of each subword for each language, and what calibrates their softmax."""

    languages: tuple[str, ...]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float


class Letters:
    """Which characters are letters; looked up once for the basic plane, else when met."""

    def __init__(self):
        self.basic = np.array([chr(i).isalpha() for i in range(1 << 16)])

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        found = self.basic[np.minimum(codes, 0xFFFF)]
        high = codes > 0xFFFF
        if high.any():
            values, at = np.unique(codes[high], return_inverse=True)
            found[high] = np.array([chr(v).isalpha() for v in values])[at]
        return found


def subwords(text: str | None, letters: Letters):
    """Arrays of hashed subwords, which together are the text's."""
    if not text:
        return
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    good = letters(codes)
    if not good.any():
        return
    codes = np.where(good, codes, np.uint32(32))
    kept = np.concatenate([[True], good[1:] | good[:-1]])  # one boundary between words
    codes = np.concatenate([[32], codes[kept], [32]]).astype(np.uint64)
    if codes[1] == 32:
        codes = codes[1:]
    if codes[-2] == 32:
        codes = codes[:-1]
    with np.errstate(over="ignore"):
        for a in range(0, len(codes), STEP):
            for n in SIZES:
                part = codes[a : a + STEP + n - 1]
                if len(part) >= n:
                    h = part[: len(part) - n + 1].copy()
                    for i in range(1, n):
                        h = h * np.uint64(1_000_003) + part[i : len(part) - n + 1 + i]
                    h = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                    yield (h >> np.uint64(49)).astype(np.int64)


def counted(text: str | None, letters: Letters) -> np.ndarray | None:
    counts = None
    for ids in subwords(text, letters):
        counts = (0 if counts is None else counts) + np.bincount(ids, minlength=BUCKETS)
    return counts


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, rows: int = SAMPLE_ROWS) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, subwords, counts) of a bounded sample of labelled rows, the same in each run."""
    prepare(docs.sparkSession)
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    mixed = F.xxhash64(F.lit(SEED), "doc_id")
    order = W.partitionBy("lang").orderBy("mixed", "doc_id")
    # A language's share of the hashes that holds its rows for certain, and not many more.
    # No more languages than the sample has rows can be in it.
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(rows)
    least = (mixed.cast("double") + 2.0**63) / 2.0**64 * F.col("n") < 2.0 * per_language + 100
    chosen = (
        labelled.select("doc_id", "lang", mixed.alias("mixed"))
        .join(F.broadcast(counts), "lang")
        .filter(least)
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= per_language)
        .orderBy("mixed", "doc_id")
        .limit(rows)
        .select("doc_id")
        .distinct()
    )

    def run(batches):
        letters = Letters()
        for b in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for doc_id, lang, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                counts = counted(text, letters)
                if counts is not None:
                    ids = np.flatnonzero(counts)
                    for column, value in zip(out, (doc_id, lang, ids.astype("<i4").tobytes(), counts[ids].astype("<i4").tobytes())):
                        column.append(value)
            types = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "lang", "ids", "counts"])

    texts = labelled.select(F.col("doc_id").cast("long"), "lang", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    found = texts.mapInArrow(run, "doc_id long, lang string, ids binary, counts binary").limit(2 * rows).toArrow().to_pylist()
    found.sort(key=lambda r: (r["doc_id"], r["lang"], r["ids"], r["counts"]))
    return [(r["lang"], np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["counts"], "<i4").astype(np.float64)) for r in found]


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], reject_share: float = 0.001) -> Model:
    languages = tuple(sorted({lang for lang, _, _ in rows}))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(SEED)
    number = {lang: i for i, lang in enumerate(languages)}
    order = rng.permutation(len(rows))
    back = set(order[: len(rows) // 5].tolist())
    learned = [i for i in order.tolist() if i not in back] or order.tolist()
    table = rng.uniform(-1, 1, (BUCKETS, DIMS)) / DIMS
    weights, bias = np.zeros((len(languages), DIMS)), np.zeros(len(languages))
    steps, step = EPOCHS * len(learned), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(learned).tolist():
            lang, ids, counts = rows[i]
            rate = RATE * (1 - step / steps)
            step += 1
            share = counts / counts.sum()
            mean = share @ table[ids]
            error = softmax(weights @ mean + bias)
            error[number[lang]] -= 1
            slope = error @ weights
            weights -= rate * np.outer(error, mean)
            bias -= 0.1 * rate * error
            # A row's step is scaled by its share; the factor lets rare rows move as well.
            table[ids] -= rate * 20 * share[:, None] * slope
    scores = table @ weights.T
    kept_back = sorted(back) or learned
    raw = np.array([(rows[i][2] / rows[i][2].sum()) @ scores[rows[i][1]] + bias for i in kept_back])
    truth = np.array([number[rows[i][0]] for i in kept_back])
    temperature = min(np.geomspace(0.05, 20, 60), key=lambda t: loss(raw / t, truth))
    right = np.sort(softmax(raw / temperature).max(axis=1))
    least = float(right[min(len(right) - 1, math.floor(reject_share * len(right)))])
    return Model(languages, scores, bias, float(temperature), min(0.5, 0.999 * least))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def loss(raw: np.ndarray, truth: np.ndarray) -> float:
    return float(-np.log(softmax(raw)[np.arange(len(truth)), truth] + 1e-300).mean())


def predicted(text: str | None, model: Model, letters: Letters) -> tuple[str, float]:
    total, n = np.zeros(len(model.languages)), 0
    for ids in subwords(text, letters):
        total += model.scores[ids].sum(axis=0)
        n += len(ids)
    if not n or not model.languages:
        return UNKNOWN, 0.0
    p = softmax((total / n + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def fitted(docs: DataFrame, reject_share: float = 0.001) -> Model:
    return train(sample(docs), reject_share)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))  # BUCKETS rows of a score per language

    def run(batches):
        model, letters = Model(*shared.value), Letters()
        for b in batches:
            found = [predicted(t, model, letters) for t in b.column(2).to_pylist()]
            langs, scores = pa.array([x[0] for x in found], pa.string()), [x[1] for x in found]
            accepted = pa.array([s >= model.least and lang != UNKNOWN for lang, s in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), langs, pa.array(scores, pa.float64()), accepted],
                ["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"
    )


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fitted(docs))


def accepted_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns unchanged, whose language is recognised."""
    prepare(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(astuple(model)), docs.columns.index("text")

    def run(batches):
        model, letters = Model(*shared.value), Letters()
        for b in batches:
            found = [predicted(t, model, letters) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([s >= model.least and lang != UNKNOWN for lang, s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
