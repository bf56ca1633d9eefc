"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the letters and the letter trigrams of lower-cased words (with the words' edges), hashed to a fixed
table of embeddings. A text is the mean of its subwords' embeddings; a softmax over it gives the languages.
Embeddings and weights are trained together by stochastic gradient descent in numpy on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, strings

#: Size of the hashed table and of an embedding.
BUCKETS, SIZE = 1 << 14, 16
#: The sample's bound: rows of a language, and rows in all (the rows of all languages' first ranks).
PER_LANGUAGE, SAMPLE = 600, 3000
EPOCHS, RATE = 6, 0.5
#: Share of the sample kept for calibration, and the precision that accepted predictions must reach there.
CALIBRATION, PRECISION = 5, 0.99
#: Characters that are hashed at a time.
_BLOCK = 1 << 20
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def subwords(text: str) -> np.ndarray:
    """The buckets of a text's subwords, in order; none without a letter."""
    x = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.where(_is_letter()[x], x, 0).astype(np.uint64)
    at = np.flatnonzero(x)
    if not len(at):
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        one = (x[at] + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
        three = (((x[at - 1] * np.uint64(0x110001)) + x[at]) * np.uint64(0x110003) + x[at + 1]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate((one, three >> np.uint64(3))).__rshift__(np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def counts(text: str) -> np.ndarray:
    """How often each bucket occurs in the whole text, block by block."""
    out = np.zeros(BUCKETS, np.int64)
    for k in range(0, len(text), _BLOCK):
        out += np.bincount(subwords(text[k:k + _BLOCK]), minlength=BUCKETS)
    return out


@dataclass
class Model:
    """``table[b]`` is what bucket ``b`` adds to each language's score; scores are divided by ``temperature``;
    probabilities under ``threshold`` are rejected."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def scores(self, text: str) -> np.ndarray | None:
        total, n = np.zeros(len(self.languages)), 0
        for k in range(0, len(text), _BLOCK):
            own = subwords(text[k:k + _BLOCK])
            total += self.table[own].sum(axis=0)
            n += len(own)
        return total / n + self.bias if n else None

    def predict(self, text: str) -> tuple[str, float]:
        z = self.scores(text) if self.languages else None
        if z is None:
            return "und", 0.0
        p = softmax(z / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Train on ``(language, buckets, counts)``; every ``CALIBRATION``-th row of a language only calibrates."""
    languages = sorted({lang for lang, _, _ in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(11)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE))
    weights, bias = np.zeros((SIZE, len(languages))), np.zeros(len(languages))
    seen: dict[str, int] = {}
    train, keep = [], []
    for lang, at, n in rows:
        seen[lang] = seen.get(lang, 0) + 1
        (keep if seen[lang] % CALIBRATION == 0 else train).append((number[lang], at, n / n.sum()))
    steps = EPOCHS * len(train)
    for step in range(steps):
        if step % max(1, len(train)) == 0:
            order = rng.permutation(len(train))
        y, at, share = train[order[step % len(train)]]
        mean = share @ vectors[at]
        wrong = softmax(mean @ weights + bias)
        wrong[y] -= 1
        rate = RATE * (1 - step / steps)
        back = weights @ wrong
        weights -= rate * np.outer(mean, wrong)
        bias -= 0.1 * rate * wrong
        vectors[at] -= rate * 20 * np.outer(share, back)
    model = Model(languages, vectors @ weights, bias)
    if keep:
        z = np.array([share @ model.table[at] + bias for _, at, share in keep])
        y = np.array([k for k, _, _ in keep])
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(z / model.temperature)
        best, right = p.max(axis=1), p.argmax(axis=1) == y
        order = np.argsort(-best, kind="stable")
        sound = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= PRECISION
        model.threshold = float(best[order][np.flatnonzero(sound).max()]) if sound.any() else 1.0
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(spark: SparkSession, docs: DataFrame) -> Model:
    """A model of the labelled rows of ``docs(doc_id, text, lang)`` that are not held out: at most
    ``PER_LANGUAGE`` rows of a language and ``SAMPLE`` in all, chosen by hash. Their subwords are counted on the
    executors; at most ``SAMPLE * BUCKETS`` counts reach the driver. Rows without an id, language or letter are
    not learned from; without any row the model knows no language."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    rows = rows.withColumn("hash", F.xxhash64("doc_id", "text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    chosen = (rows.withColumn("rank", rank).filter(F.col("rank") <= PER_LANGUAGE).orderBy("rank", "lang").limit(SAMPLE))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [counts(t) for t in strings(b.column(1))]
            at = [np.flatnonzero(x) for x in own]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.list_(pa.int64())), pa.array([x[k] for x, k in zip(own, at, strict=True)], pa.list_(pa.int64()))],
                                             ["lang", "at", "n"])

    got = chosen.select("lang", "text").mapInArrow(count, "lang string, at array<long>, n array<long>").collect()
    return fit(sorted(((r["lang"], np.array(r["at"], np.int64), np.array(r["n"], float)) for r in got if r["at"]),
                      key=lambda r: (r[0], len(r[1]), r[1].tolist(), r[2].tolist())))


def predict(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)`` for each row of ``docs(doc_id, text)``, from the whole text.

    Null texts and texts without a letter are ``und`` with score 0 and rejected, as is everything where the model
    knows no language. Repeated rows are predicted alike; an empty table gives no rows; ``lang`` and other
    columns are not read."""
    bounded_batches(spark)
    own = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = own.value
        for b in batches:
            got = [m.predict(t) for t in strings(b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x for x, _ in got], pa.string()), pa.array([p for _, p in got], pa.float64()),
                 pa.array([x == "und" or p < m.threshold for x, p in got], pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"))
