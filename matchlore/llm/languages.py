"""Language identification with error-correcting output codes.

Every language has a codeword of signs. For each of its bits a binary n-gram
classifier (naive Bayes over hashed byte n-grams of lower-cased letters) tells the languages of one
sign from those of the other; the margin of a text is its mean log-odds per n-gram. A
text gets the language whose codeword its margins fit with the least loss, where each bit
counts as much as it was right for that language on a sample. If the second language fits nearly
as well, the prediction is marked as ambiguous.

The counts behind the classifiers cover all learning documents; what reaches the driver is one
count per language and n-gram bucket. Only the weights and scales of bits come from a bounded sample
(``sample`` documents per language, the first by a hash of their ids).

Defined results: a null text or one without a letter is ``und`` with score 0; null languages and null
ids are not learned from; with one language to learn from that one is predicted; with none, ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


BUCKETS = 1 << 12
ORDERS = (2, 3, 4)
_PAD = b"    "
_HASHES = 1 << 40
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def histograms(texts: list[str]) -> np.ndarray:
    """Counts of hashed n-grams, one row per text."""
    parts = [_PAD + t.lower().encode().translate(_LETTERS) for t in texts]
    data = np.frombuffer(b"".join(parts) + _PAD, np.uint8).astype(np.uint32)
    bounds = np.cumsum([0, *map(len, parts)])
    n = int(bounds[-1])
    row = np.repeat(np.arange(len(parts)), np.diff(bounds))
    inside = data[:n] + data[1 : n + 1] != 64  # two blanks start no n-gram
    row, at = row[inside], np.flatnonzero(inside)
    code, out = data[at], np.zeros((len(parts), len(ORDERS) * BUCKETS), np.float32)
    for k in range(1, max(ORDERS)):
        code = code | data[at + k] << np.uint32(8 * k)
        if k + 1 in ORDERS:
            place = ORDERS.index(k + 1)
            bucket = (code * np.uint32(0x9E3779B1 + 2 * place)) >> np.uint32(20)
            flat = np.bincount(row * BUCKETS + bucket, minlength=len(parts) * BUCKETS)
            out[:, place * BUCKETS : (place + 1) * BUCKETS] = flat.reshape(len(parts), BUCKETS)
    return out


def _runs(texts: list[str], size: int = 1 << 19, rows: int = 256) -> Iterator[list[str]]:
    run: list[str] = []
    held = 0
    for text in texts:
        if run and (held + len(text) > size or len(run) == rows):
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


def codewords(count: int, seed: int = 42) -> np.ndarray:
    """Signs, a row per language: all useful splits of up to seven, else seeded random ones."""
    if count <= 7:
        columns = [(1, *c) for c in product((1, -1), repeat=max(0, count - 1)) if -1 in c]
        return np.array(columns, np.int8).reshape(-1, max(1, count)).T[:count]
    bits = int(np.ceil(15 * np.log2(count)))
    drawn = np.random.default_rng(seed)
    while True:
        code = drawn.choice(np.array([1, -1], np.int8), (count, bits))
        if (abs(code.sum(axis=0)) < count).all() and len(np.unique(code, axis=0)) == count:
            return code


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    centre: np.ndarray  # bits
    scale: np.ndarray  # bits
    trust: np.ndarray  # languages x bits
    close: float

    def margins(self, texts: list[str]) -> np.ndarray:
        counts = histograms(texts)
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        # one row at a time: the sum of a row must not depend on its neighbours
        return np.array([c @ self.weights for c in counts]).reshape(len(texts), -1) / total

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score and whether the second one is close."""
        fit = np.clip((margins - self.centre) / self.scale, -8, 8)
        loss = np.stack([(t * np.exp(-c * fit)).sum(axis=1) for c, t in zip(self.code, self.trust)], axis=1)
        best = loss.argmin(axis=1)
        ranked = np.sort(loss, axis=1)
        gap = (ranked[:, 1] - ranked[:, 0]) / (ranked[:, 1] + ranked[:, 0])
        return best, (1 + gap) / 2, gap < self.close

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = []
        for run in _runs([t or "" for t in texts]):
            lettered = [any(map(str.isalpha, t)) for t in run]
            if len(self.languages) < 2:
                name = self.languages[0] if self.languages else "und"
                out += [(name, 1.0, False) if ok and self.languages else ("und", 0.0, True) for ok in lettered]
                continue
            best, score, close = self.decide(self.margins(run))
            out += [
                (self.languages[b], float(s), bool(c)) if ok else ("und", 0.0, True)
                for ok, b, s, c in zip(lettered, best, score, close)
            ]
        return out


def held_out(parts: int = 5) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == 0


def _language_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts per language over a partition: one dense row of counts per language seen."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch["text"].to_pylist(), batch["lang"].to_pylist()
        at = 0
        for run in _runs([t or "" for t in texts]):
            counts, names = histograms(run), langs[at : at + len(run)]
            at += len(run)
            for name in set(names):
                mine = counts[[n == name for n in names]].sum(axis=0, dtype=np.float64)
                sums[name] = sums.get(name, 0) + mine
    for name, counts in sums.items():
        buckets = np.flatnonzero(counts)
        columns = [pa.array([name] * len(buckets)), pa.array(buckets.astype(np.int32)), pa.array(counts[buckets].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])


def fit(docs: DataFrame, sample: int = 300, smoothing: float = 0.5, close: float = 0.1, seed: int = 42) -> Model:
    """Learn from ``docs`` (doc_id, text, lang)."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counted = known.select("text", "lang").mapInArrow(_language_counts, "lang string, bucket int, n bigint")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in rows})
    size = len(ORDERS) * BUCKETS
    counts = np.zeros((len(languages), size))
    for r in rows:
        counts[languages.index(r["lang"]), r["bucket"]] = r["n"]
    code = codewords(len(languages), seed)
    none = np.ones(code.shape[1])
    model = Model(languages, code, np.zeros((size, code.shape[1]), np.float32), 0 * none, none, np.ones(code.shape), close)
    if len(languages) < 2:
        return model
    shares = counts / counts.sum(axis=1, keepdims=True)
    smooth = smoothing / counts.sum(axis=1).max()
    odds = [np.log(shares[c > 0].mean(axis=0) + smooth) - np.log(shares[c < 0].mean(axis=0) + smooth) for c in code.T]
    model.weights = np.ascontiguousarray(np.array(odds).T, np.float32)
    # the first by hash lie below a bound that twice as many documents should reach: only those are shuffled
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    bounds = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], int(min(1.0, 2 * sample / r["n"]) * _HASHES))])
    near = known.withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(_HASHES))).where(F.col("_h") < bounds[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    few = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample)
    seen = few.select("lang", _margin_column(model).alias("m")).collect()
    own = np.array([languages.index(r["lang"]) for r in seen])
    m = np.array([r["m"] for r in seen])
    means = np.array([m[own == k].mean(axis=0) if (own == k).any() else np.zeros(m.shape[1]) for k in range(len(languages))])
    for b, signs in enumerate(code.T):
        high, low = means[signs > 0, b], means[signs < 0, b]
        model.centre[b] = (high.min() + low.max()) / 2
        model.scale[b] = max(1e-6, (high.mean() - low.mean()) / 4)
    right = (m - model.centre) * code[own] > 0
    trust = np.array([right[own == k].mean(axis=0) if (own == k).any() else none for k in range(len(languages))]) + 1e-3
    model.trust = trust / trust.sum(axis=1, keepdims=True)
    return model


def _margin_column(model: Model) -> Column:
    def margins(text: pa.Array) -> pa.Array:
        rows = [r for run in _runs([t or "" for t in text.to_pylist()]) for r in model.margins(run).tolist()]
        return pa.array(rows, pa.list_(pa.float64()))

    return F.arrow_udf(margins, "array<double>")("text")


def predicted(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct of lang_pred, score and ambiguous for a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a size that buckets and bits bound

    def of(text: pa.Array) -> pa.Array:
        names, scores, close = zip(*shared.value.predict(text.to_pylist())) if len(text) else ((), (), ())
        columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(close, pa.bool_())]
        return pa.StructArray.from_arrays(columns, ["lang_pred", "score", "ambiguous"])

    return F.arrow_udf(of, "struct<lang_pred:string,score:double,ambiguous:boolean>")(text)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every document; learns from those not held out."""
    model = fit(docs.where(~held_out()))
    return docs.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), predicted(docs, model).alias("p")
    ).select("doc_id", "held_out", "p.*")
