"""Operator 4, packing token sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quillstone.llm.common import map_slices
from quillstone.llm.pretokens import byte_encoder


@dataclass(frozen=True)
class PackRules:
    """group_docs: documents packed together, on average; the number of groups follows the number of documents."""

    window: int = 1024
    end_id: int = 0
    group_docs: int = 4096


TOKENS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("crcs", T.ArrayType(T.LongType())),
        T.StructField("row", T.LongType()),
    ]
)

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def best_fill(counts: dict[int, int], capacity: int) -> list[int]:
    """The lengths, as a list with repeats, whose sum comes closest to capacity without exceeding it.

    counts: how many pieces are left of each length. One bit a reachable sum; each length enters in groups of 1, 2, 4,
    ... pieces, longest first, until capacity itself is reachable. The sums before each group lead back to the counts.
    """
    reach, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, group = min(counts[length], capacity // length), 1
        while left:
            n = min(group, left)
            grown = reach | (reach << (length * n)) & mask
            if grown != reach:
                steps.append((length, n, reach))
                reach = grown
            left, group = left - n, group * 2
        if reach >> capacity:
            break
    out, total = [], reach.bit_length() - 1
    for length, n, before in reversed(steps):
        if not before >> total & 1:
            out += [length] * n
            total -= length * n
    return out


def pack_lengths(lengths: list[int], window: int) -> list[list[int]]:
    """Indexes into lengths (1 to window), by window. The longest piece left opens a window; best_fill completes it."""
    stacks: dict[int, list[int]] = defaultdict(list)
    for i in range(len(lengths) - 1, -1, -1):
        stacks[lengths[i]].append(i)
    counts = {length: len(x) for length, x in stacks.items()}

    def take(length: int) -> int:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return stacks[length].pop()

    out = []
    for longest in sorted(counts, reverse=True):
        while longest in counts:
            opened = [take(longest)]
            out.append(opened + [take(x) for x in best_fill(counts, window - longest)])
    return out


def tokenize(docs: DataFrame, vocabulary: str, rules: PackRules) -> DataFrame:
    """docs(doc_id, text) as TOKENS: token counts with the end id, and a CRC-32 of each window-long piece's ids."""
    step_bytes = 4 * rules.window
    end = rules.end_id.to_bytes(4, "little")

    def make():
        encoder, seen = byte_encoder(vocabulary), 0

        def step(rows: dict[str, list]) -> dict[str, list]:
            nonlocal seen
            out: dict[str, list] = {"doc_id": rows["doc_id"], "doc_tokens": [], "crcs": [], "row": []}
            for text in rows["text"]:
                ids = memoryview(encoder.encode(text) + end)
                out["doc_tokens"].append(len(ids) // 4)
                out["crcs"].append([zlib.crc32(ids[i : i + step_bytes]) for i in range(0, len(ids), step_bytes)])
                out["row"].append(seen)
                seen += 1
            return out

        return step

    return map_slices(docs.select("doc_id", "text"), TOKENS, make)


def pack(docs: DataFrame, vocabulary: str, rules: PackRules = PackRules()) -> DataFrame:
    """PIECES: every token of docs(doc_id, text) in one piece of one sequence of at most rules.window tokens.

    A document gives whole windows from its start, which are sequences as they are, and one shorter tail. Documents are
    dealt to groups by a hash of doc_id and place in the input, so that equal rows spread too; a group's tails are
    packed by minimum bin slack. Only counts and checksums reach a group, never texts or ids.
    Null and empty texts are the end id alone; rows of equal doc_id are packed one by one; a null doc_id stays null;
    an empty table has no pieces; other columns are ignored.
    """
    rows = tokenize(docs, vocabulary, rules)
    groups = max(1, -(-docs.count() // rules.group_docs))
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "row", "crcs"), F.lit(groups)))
    arrow, window = to_arrow_schema(PIECES), rules.window

    def pack_group(group: pa.Table) -> pa.Table:
        docs = list(zip(*(group.column(k).to_pylist() for k in ("doc_id", "doc_tokens", "crcs"))))
        docs.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2]))
        sequence = group.column("group")[0].as_py() << 40
        out, tails = [], []
        for doc_id, n, crcs in docs:
            whole, rest = divmod(n, window)
            for k in range(whole):
                out.append((doc_id, k * window, window, crcs[k], n, sequence, 0))
                sequence += 1
            if rest:
                tails.append((doc_id, whole * window, rest, crcs[whole], n))
        for members in pack_lengths([x[2] for x in tails], window):
            at = 0
            for i in members:
                out.append((*tails[i], sequence, at))
                at += tails[i][2]
            sequence += 1
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)

    return rows.groupBy("group").applyInArrow(pack_group, PIECES)
