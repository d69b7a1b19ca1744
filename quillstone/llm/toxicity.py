"""Operator 1, toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.common import Scratch, map_slices
from quillstone.llm.wordhash import stream

_U = np.uint64
_CHECK = _U(0xFFFFFFFF)
_COUNTED = pa.schema([(x, pa.int64()) for x in ("bucket", "check", "n0", "n1")])


@dataclass(frozen=True)
class ToxicityRules:
    """sample_rows bounds the labelled rows that the model is fitted on; n-grams are counted in 2**bits buckets first.

    Weights are fitted for n-grams that the two labels hold with different frequency: by the two-proportion test, at
    least significance standard errors apart. features bounds their number, and entries the times that the sample's
    documents hold them, which is what the driver holds during the fit (four bytes each); the furthest apart come first.
    """

    sample_rows: int = 20_000
    orders: tuple[int, ...] = (4, 5, 6)
    bits: int = 20
    features: int = 1 << 14
    entries: int = 1 << 24
    significance: float = 4.0
    min_documents: int = 3
    smoothing: float = 1.0
    penalty: float = 1e-3
    rounds: int = 200
    step: float = 0.05
    sample_parts: int = 8
    predict_at: float = 0.3


class Grams:
    """N-grams of a text, lower-cased, with a space before and after, by their 64-bit hashes."""

    BLOCK = 1 << 17

    def __init__(self, rules: ToxicityRules) -> None:
        self.orders, self.shift, self.size = rules.orders, _U(64 - rules.bits), 1 << rules.bits
        self.place = stream(max(rules.orders), 21) | _U(1)
        self.salt = stream(max(rules.orders) + 1, 22)
        self.stamp = np.zeros(self.size, np.int64)

    def _blocks(self, text: str | None) -> Iterator[np.ndarray]:
        codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
        longest = max(self.orders)
        for at in range(0, max(1, len(codes) - longest + 1), self.BLOCK):
            yield self._hashes(codes[at : at + self.BLOCK + longest - 1])

    def _hashes(self, codes: np.ndarray) -> np.ndarray:
        out = [np.empty(0, _U)]
        with np.errstate(over="ignore"):
            for n in self.orders:
                if len(codes) >= n:
                    h = codes[: len(codes) - n + 1] * self.place[0]
                    for k in range(1, n):
                        h = h + codes[k : len(codes) - n + 1 + k] * self.place[k]
                    out.append((h ^ (h >> _U(29)) ^ self.salt[n]) * self.place[0])
        return np.concatenate(out)

    def buckets(self, text: str | None) -> np.ndarray:
        """The distinct buckets that the text's n-grams fall in."""
        found = [self._distinct((h >> self.shift).astype(np.int64)) for h in self._blocks(text)]
        return found[0] if len(found) == 1 else self._distinct(np.concatenate(found))

    def _distinct(self, buckets: np.ndarray) -> np.ndarray:
        """The last place that each bucket was written from; no sort."""
        at = np.arange(len(buckets))
        self.stamp[buckets] = at
        return buckets[self.stamp[buckets] == at]

    def within(self, text: str | None, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, check) of the distinct n-grams in buckets that index, by bucket, gives a number from 0 on."""
        found = []
        for h in self._blocks(text):
            number = index[(h >> self.shift).astype(np.int64)]
            held = number >= 0
            found.append((number[held].astype(_U) << _U(32)) | (h[held] & _CHECK))
        both = np.unique(np.concatenate(found))
        return (both >> _U(32)).astype(np.int64), (both & _CHECK).astype(np.uint32)


@dataclass
class Features:
    """N-grams by bucket, ascending, one a bucket at most, and check, the rest of the hash, with their log-count ratios."""

    bucket: np.ndarray
    check: np.ndarray
    ratio: np.ndarray

    def index(self, rules: ToxicityRules) -> np.ndarray:
        out = np.full(1 << rules.bits, -1, np.int32)
        out[self.bucket] = np.arange(len(self.bucket))
        return out

    def held(self, grams: Grams, text: str | None, index: np.ndarray) -> np.ndarray:
        """Numbers of the features that a text holds, ascending: whatever else falls in their buckets does not count."""
        number, check = grams.within(text, index)
        return number[check == self.check[number]]


@dataclass
class ToxicityModel:
    """weights: one a feature, already times the log-count ratio. usual: features that the sample's median text holds.

    A text that holds more than is usual has its features scaled down by the root of how many times more: a text does
    not turn toxic by its length.
    """

    features: Features
    weights: np.ndarray
    bias: float
    usual: float
    rules: ToxicityRules


def _apart(sums: DataFrame, clean: int, toxic: int, rules: ToxicityRules) -> DataFrame:
    """sums(n0, n1, ...) of what enough documents of the sample hold, with far, in standard errors, and ratio."""
    one, zero = F.col("n1") + rules.smoothing, F.col("n0") + rules.smoothing
    p, q = one / (toxic + 2 * rules.smoothing), zero / (clean + 2 * rules.smoothing)
    both = (one + zero) / (clean + toxic + 4 * rules.smoothing)
    error = F.sqrt(both * F.greatest(1 - both, F.lit(1e-6)) * (1 / (toxic + 1) + 1 / (clean + 1)))
    sums = sums.filter(F.col("n0") + F.col("n1") >= rules.min_documents).withColumn("far", F.abs(p - q) / error)
    return sums.filter(F.col("far") >= rules.significance).withColumn("ratio", F.log(p / q))


def _select(rows: DataFrame, clean: int, toxic: int, rules: ToxicityRules) -> Features:
    """The n-grams to fit: of the buckets that tell the labels apart, the n-gram that does so most.

    Counts are summed in each task, then over tasks; buckets are counted first, as there are too many n-grams to count.
    """

    def count(batches):
        grams, found = Grams(rules), np.zeros((2, 1 << rules.bits), np.int32)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                found[label][grams.buckets(text)] += 1
        held = np.flatnonzero(found.any(axis=0))
        for at in range(0, len(held), 1 << 16):
            part = held[at : at + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"bucket": part.astype(np.int32), "n0": found[0][part], "n1": found[1][part]})

    sums = rows.mapInArrow(count, "bucket int, n0 int, n1 int").groupBy("bucket")
    sums = _apart(sums.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), clean, toxic, rules)
    chosen = sorted(r.bucket for r in sums.orderBy(F.desc("far"), "bucket").limit(rules.features).select("bucket").collect())
    chosen = np.array(chosen, np.int64)

    def check(batches):
        grams, index = Grams(rules), Features(chosen, chosen, chosen).index(rules)
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                number, rest = grams.within(text, index)
                found[label].update(zip(number.tolist(), rest.tolist()))
        keys = list(found[0].keys() | found[1].keys())
        for at in range(0, len(keys), 1 << 16):
            part = keys[at : at + (1 << 16)]
            columns = {"bucket": [int(chosen[x]) for x, _ in part], "check": [x for _, x in part]}
            columns |= {f"n{k}": [found[k][x] for x in part] for k in (0, 1)}
            yield pa.RecordBatch.from_pydict(columns, schema=_COUNTED)

    if not len(chosen):
        return Features(chosen, chosen.astype(np.uint32), chosen.astype(np.float64))
    sums = rows.mapInArrow(check, "bucket long, check long, n0 long, n1 long").groupBy("bucket", "check")
    sums = _apart(sums.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), clean, toxic, rules)
    best = F.max_by(F.struct("check", "ratio", "far", (F.col("n0") + F.col("n1")).alias("n")), F.struct("far", "check")).alias("best")
    found = sums.groupBy("bucket").agg(best).select("bucket", "best.*").collect()
    found.sort(key=lambda r: (-r.far, r.bucket))
    upto = np.cumsum([r.n for r in found]) if found else np.empty(0)
    found = sorted(r for r, n in zip(found, upto) if n <= rules.entries)
    return Features(
        np.array([r.bucket for r in found], np.int64), np.array([r.check for r in found], np.uint32),
        np.array([r.ratio for r in found], np.float64),
    )


def _active(rows: DataFrame, features: Features, rules: ToxicityRules) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each sample row, the features that it holds."""

    def find(batches):
        grams, index = Grams(rules), features.index(rules)
        for batch in batches:
            packed = [features.held(grams, x, index).astype("<u2").tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "held": pa.array(packed, pa.binary())}
            )

    found = rows.mapInArrow(find, "doc_id long, label int, held binary").collect()
    found.sort(key=lambda r: (r.doc_id, bytes(r.held)))
    return [np.frombuffer(r.held, "<u2") for r in found], np.array([r.label for r in found], np.float64)


def train(docs: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules()) -> ToxicityModel:
    """Fits docs(doc_id, text) to labels(doc_id, toxic).

    The sample is the sample_rows labelled ids first by hash, at most. Their ids are broadcast, so that no other text
    moves; the sample itself is written to the shared folder in sample_parts files.
    Null ids and labels are left out; an id with several labels counts as toxic if one says so. Without both labels
    in the sample, the model gives the share of label 1 whatever the text.
    """
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    ids = ids.groupBy(F.col("doc_id").alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("label"))
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(rules.sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).repartition(rules.sample_parts)
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = scratch.save(rows, "sample")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    none = np.empty(0, np.int64)
    features, weights, usual = Features(none, none.astype(np.uint32), none.astype(np.float64)), none.astype(np.float64), 1.0
    bias = float(np.log((toxic + 0.5) / (clean + 0.5)))
    if clean and toxic:
        features = _select(rows, clean, toxic, rules)
        weights = np.zeros(len(features.bucket))
        if len(weights):
            held, label = _active(rows, features, rules)
            usual = max(1.0, float(np.median([len(x) for x in held])))
            fitted, bias = _fit(held, label, features.ratio, usual, rules)
            weights = fitted * features.ratio
    scratch.keep()
    return ToxicityModel(features, weights, bias, usual, rules)


def _scale(sizes: np.ndarray, usual: float) -> np.ndarray:
    return np.minimum(1.0, np.sqrt(usual / np.maximum(sizes, 1)))


def _fit(
    held: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, usual: float, rules: ToxicityRules
) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch Adam on rows of scaled 0/1 features."""
    sizes = np.array([len(x) for x in held])
    scale = _scale(sizes, usual)
    where = np.concatenate(held).astype(np.int32)
    starts, some = np.cumsum(sizes) - sizes, sizes > 0
    w, b = np.zeros(len(ratio)), float(np.log(label.mean() / (1 - label.mean())))
    m, v = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for t in range(1, rules.rounds + 1):
        z = np.full(len(label), b)
        z[some] += np.add.reduceat((w * ratio)[where], starts[some]) * scale[some]
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / len(label)
        slope = np.bincount(where, np.repeat(off * scale, sizes), len(ratio)) * ratio + rules.penalty * w
        slope = np.append(slope, off.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = rules.step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row a row of docs(doc_id, text): score, the chance of label 1 from 0 to 1, and predicted.

    Null and empty texts score by the few n-grams of two spaces and the bias; repeated rows are scored one by one; a
    null doc_id stays null; other columns are ignored. The model is broadcast: three numbers a feature.
    """
    rules, bias, usual = model.rules, model.bias, model.usual
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights))
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def make():
        grams, (features, w) = Grams(rules), shared.value
        index = features.index(rules)

        def step(rows: dict[str, list]) -> dict[str, list]:
            held = [features.held(grams, x, index) for x in rows["text"]]
            z = np.array([w[x].sum() for x in held]) * _scale(np.array([len(x) for x in held]), usual) + bias
            p = (1 / (1 + np.exp(-np.clip(z, -40, 40)))).tolist()
            return {"doc_id": rows["doc_id"], "score": p, "predicted": [int(x >= rules.predict_at) for x in p]}

        return step

    return map_slices(docs.select("doc_id", "text"), schema, make)
