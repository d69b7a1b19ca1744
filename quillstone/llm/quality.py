"""Operator 10, quality rules: word rules first, then compression bands."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.common import SLICE_ROWS, WHITESPACE, map_slices
from quillstone.llm.wordhash import SHINGLE_WORDS, shingle_hashes, word_bounds, word_hashes

SYMBOLS = "#*$%&|<>"
_BLANKS = re.compile(r"[\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]+")


@dataclass(frozen=True)
class Band:
    """Limits for texts of at least from_bytes bytes: the ratio is bytes of text over bytes of its zstandard frame."""

    from_bytes: int
    whole_low: float
    whole_high: float
    chunk_low: float
    chunk_high: float


@dataclass(frozen=True)
class QualityRules:
    """Limits by length: short texts compress worse, as a frame has fixed costs, and long ones better.

    The bands are what fit_bands() gives for the labelled good documents of the tables at scale 0.1; a corpus of another
    kind needs its own. Text below them is noise or encoded data, text above repeats itself.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    level: int = 3
    chunk_bytes: int = 4096
    bands: tuple[Band, ...] = (
        Band(0, 0.0, 1.51, 0.0, 1.51),
        Band(128, 0.0, 1.9, 0.0, 1.9),
        Band(256, 0.72, 1.85, 0.72, 1.85),
        Band(512, 0.59, 2.14, 0.59, 2.14),
        Band(1024, 1.19, 2.2, 1.19, 2.2),
        Band(2048, 1.54, 2.27, 1.54, 2.27),
        Band(4096, 1.74, 2.35, 1.63, 2.3),
        Band(8192, 1.83, 2.42, 1.84, 2.28),
        Band(16384, 1.83, 2.49, 1.84, 2.28),
        Band(32768, 1.83, 2.56, 1.84, 2.28),
        Band(65536, 1.83, 2.63, 1.84, 2.28),
        Band(131072, 1.83, 2.7, 1.84, 2.28),
    )


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("ratio", T.DoubleType()),
        T.StructField("min_chunk_ratio", T.DoubleType()),
        T.StructField("max_chunk_ratio", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def repeat_words(data: bytes, starts: np.ndarray, ends: np.ndarray) -> int:
    """Words in five-word windows that are found twice or more, the first time included.

    Hashes only name the windows that may repeat; those are compared word by word.
    """
    n = len(starts) - SHINGLE_WORDS + 1
    if n < 2:
        return 0
    windows = shingle_hashes(word_hashes(data, starts, ends))
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    may = np.zeros(n, bool)
    may[order[1:][same]] = may[order[:-1][same]] = True
    seen: dict[tuple[bytes, ...], int] = {}
    hit = np.zeros(n, bool)
    for i in np.flatnonzero(may).tolist():
        window = tuple(data[starts[j] : ends[j]] for j in range(i, i + SHINGLE_WORDS))
        first = seen.setdefault(window, i)
        if first != i:
            hit[i] = hit[first] = True
    covered = np.zeros(len(starts), bool)
    for j in range(SHINGLE_WORDS):
        covered[j : j + n] |= hit
    return int(covered.sum())


def measure(text: str | None, rules: QualityRules, zstd: zstandard.ZstdCompressor) -> tuple:
    """SCHEMA's values after doc_id for one text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    starts, ends = word_bounds(data)
    n = len(starts)
    chars = len(text) - sum(map(len, _BLANKS.findall(text)))
    symbols = sum(map(len, _SYMBOLS.findall(text)))
    lines = [x for x in text.split("\n") if x.strip(WHITESPACE)]
    repeated = repeat_words(data, starts, ends)
    failed = n < rules.min_words or 100 * repeated > rules.max_repeat_percent * n
    size = len(data)
    ratio = size / len(zstd.compress(data)) if size else 0.0
    step = rules.chunk_bytes
    # A tail under half a chunk goes with the chunk before it.
    cuts = list(range(0, max(1, size - step // 2 + 1), step)) if size >= step else [0]
    chunks = [data[a:b] for a, b in zip(cuts, [*cuts[1:], size])] if len(cuts) > 1 else []
    ratios = [len(x) / len(zstd.compress(x)) for x in chunks] or [ratio]
    band = [b for b in rules.bands if size >= b.from_bytes][-1]
    fits = band.whole_low <= ratio <= band.whole_high and band.chunk_low <= min(ratios) and max(ratios) <= band.chunk_high
    return size, n, chars, symbols, len(lines) - len(set(lines)), repeated, failed, ratio, min(ratios), max(ratios), fits and not failed


def keep_quality(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of docs(text, ...) that the rules keep, with all their columns; cases as in quality_rules()."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                kept = [measure(x, rules, zstd)[-1] for x in part.column("text").to_pylist()]
                yield part.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def quality_rules(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row a row of docs(doc_id, text), with counts, compression ratios and the verdict.

    Null and empty texts have no words and fail; a null doc_id stays null; repeated rows are judged one by one; other
    columns are ignored. Texts are measured whole, each on its own, so that no row moves between tasks.
    """

    def make():
        zstd = zstandard.ZstdCompressor(level=rules.level)
        names = SCHEMA.names

        def step(rows: dict[str, list]) -> dict[str, list]:
            out = [measure(x, rules, zstd) for x in rows["text"]]
            return {names[0]: rows["doc_id"]} | {k: [r[i] for r in out] for i, k in enumerate(names[1:])}

        return step

    return map_slices(docs.select("doc_id", "text"), SCHEMA, make)


def fit_bands(
    docs: DataFrame, good: DataFrame, rules: QualityRules = QualityRules(), low: float = 12.0, high: float = 4.0, least: int = 30
) -> tuple[Band, ...]:
    """Limits for the lengths of rules.bands, from the documents of docs(doc_id, text) whose doc_id is in good(doc_id).

    In each length class the limits lie low spreads under and high spreads over the median ratio of those documents; a
    spread is half the distance between the 16th and the 84th percentile. A class of fewer than least documents goes on
    from the two classes before: its whole limits move as theirs did, its chunk limits stay. Documents that fail the word
    rules, and null ids, teach nothing. One row a class comes to the driver. Without any class large enough: ValueError.
    """
    at = [b.from_bytes for b in rules.bands]
    rows = quality_rules(docs, rules).filter("not base_failed").join(good.select("doc_id").distinct(), "doc_id", "left_semi")
    place = sum(((F.col("n_bytes") >= x).cast("int") for x in at[1:]), F.lit(0))
    names = ("ratio", "min_chunk_ratio", "max_chunk_ratio")
    cuts = [F.percentile_approx(x, F.lit([0.16, 0.5, 0.84]), 10_000).alias(x) for x in names]
    found = {r.place: r for r in rows.groupBy(place.alias("place")).agg(F.count("*").alias("n"), *cuts).collect() if r.n >= least}
    if not found:
        raise ValueError("no length class has enough documents")

    def limit(values: list[float], times: float) -> float:
        return max(0.0, round(values[1] + times * (values[2] - values[0]) / 2, 2))

    bands: list[Band] = []
    for k, start in enumerate(at):
        r = found.get(k) or (None if bands else found[min(found)])
        if r is not None:
            band = Band(start, limit(r.ratio, -low), limit(r.ratio, high), limit(r.min_chunk_ratio, -low), limit(r.max_chunk_ratio, high))
        else:
            a, b = bands[max(0, k - 2)], bands[k - 1]
            band = Band(start, b.whole_low, round(2 * b.whole_high - a.whole_high, 2), b.chunk_low, b.chunk_high)
        bands.append(band)
    return tuple(bands)
