"""Small tables with what operators must bear: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORDS = "the of and to in is that for was on as with they at be this from have or by one had not but what all".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, label int, kept boolean, _key string, _copies int, id long, none boolean, n_lines long, score double"  # noqa: E501


def prose(n: int, seed: int) -> str:
    pick = random.Random(seed)
    words = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randint(2, 9))) for _ in range(n)]
    words = [pick.choice(WORDS) if pick.random() < 0.4 else w for w in words]
    return "".join(w + ("\n" if i % 17 == 16 else " ") for i, w in enumerate(words)).strip()


def texts() -> list[tuple[int | None, str | None, str | None]]:
    base = prose(200, 1)
    near = base.split(" ")
    near[90] = "changed"
    rows = [
        (1, base, "b"), (2, base, "b"), (3, " ".join(near), "a"), (4, prose(120, 2) + "\n" + base, None),
        (5, None, "a"), (6, "", "c"), (7, " \n\t ", "c"), (8, "one", "c"), (9, "two words", None),
        (10, prose(20000, 3), "é"), (11, "again and again " * 60, "a"), (None, prose(80, 4), "a"), (None, None, None),
        (12, prose(60, 5), "b"), (12, prose(60, 5), "b"), (12, prose(60, 6), "a"), (13, "x" * 30000, "a"),
        (14, "naïve Σίσυφος 中文 <|endoftext|> \u0301 ẞ", "b"), (15, "a\r\nb\x0bc\x0cd  e   f", "b"), (16, prose(300, 7), "b"),
    ]
    return rows


def docs(spark: SparkSession, rows=None) -> DataFrame:
    rows = texts() if rows is None else rows
    full = [
        (i, t, "en", s, None if t is None else len(t), 7, 1, False, "k", 3, 9, True, 5, 0.5) for i, t, s in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text: str | None) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
