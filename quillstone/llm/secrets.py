"""Operator 3, secret scans: fixed patterns, then a battery of randomness tests under false-discovery control."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.common import Scratch, map_slices

_ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_SEPARATORS = "+/_-"
KINDS = ("assign", "access", "hex", "random")


@dataclass(frozen=True)
class SecretRules:
    """alpha: the battery's tests each fail a random token with this chance. q: false discoveries among added spans.

    separated: share of separators in a random token that has them.
    """

    alpha: float = 1e-3
    q: float = 1e-3
    separated: float = 0.1
    strata: tuple[int, ...] = (16, 20, 32, 48, 80)
    grid: int = 20
    grid_top: int = 1200


#: The alphabets that a token may be written in, by name, size and pattern, narrowest first.
ENCODINGS = (
    ("hex", 16, re.compile(r"[0-9a-f]+|[0-9A-F]+")),
    ("lower26", 26, re.compile(r"[a-z]+")),
    ("upper26", 26, re.compile(r"[A-Z]+")),
    ("lower32", 32, re.compile(r"[a-z2-7]+")),
    ("base32", 32, re.compile(r"[A-Z2-7]+")),
    ("lower36", 36, re.compile(r"[a-z0-9]+")),
    ("upper36", 36, re.compile(r"[A-Z0-9]+")),
    ("mixed52", 52, re.compile(r"[A-Za-z]+")),
    ("base62", 62, re.compile(r"[A-Za-z0-9]+")),
    ("base64", 64, re.compile(r"[A-Za-z0-9+/]+")),
    ("base64url", 64, re.compile(r"[A-Za-z0-9_-]+")),
)
#: Those up to base62 may also come with separators, as may base64 and base64url with each other's signs.
HYPOTHESES = 2 * len(ENCODINGS)

#: Letter pairs of English, German, French and Spanish manuals and messages, accents dropped: a row for a word's start
#: and one for each letter before, a column for each letter after, in half bits (digits, then a for 10).
_PAIRS = (
    "7a8779bd8hc89998fa78abbkhe",
    "ia89jfbeafc695ibf6769cgfdg",
    "6gfi4hgh78l6fj7ho8cd7mhlai",
    "6mbi7lk47ob9kl5hnag7aoopkq",
    "6hke2khi6ilegh6hocci9iilhl",
    "bd89cbce9hf8a5gbe568cegaff",
    "7kjf68gl4llajg5fm9ca6nkkgi",
    "7ehh3jec6lgae89en8ab6lhlij",
    "5jki3kli6nj8ec7lnaf8alioil",
    "ab797aajjjf9956dea67kbkfke",
    "5fge2iig9hhihg5eigfi7hhihi",
    "5gfg4icb8kfbgd5dlaa78hclfe",
    "5ghb4eel5lj7gh7flka99gihbk",
    "48ii4jil6nkg9g77nidf9jjmjm",
    "7g866c7h8ieega7jii85adinfe",
    "gaa9hadhcje984e9i5898edjii",
    "5fcf5ehe9oh8jj6am6d88kkmeo",
    "djiihjijejjiihhihhig0iejij",
    "5db94fbg7lfeab7gia98afende",
    "8h8g5hfb6pfegh89hh758hgoci",
    "6kfi4hk65nkehj7hq7aaamgnbd",
    "9aac6bcg9hf885ham677kdjfhi",
    "4jij3ikm6mlihh5imcgjflkkjm",
    "5iig4jh74kjfic7ilccjalhjgj",
    "8f6f6ehg5jgheid5jhe5figdcg",
    "6fdg9jfi9hgd8894jd779haihi",
    "5geh3igd8jhegh9ifhh95iajgf",
)
#: Chances of lower case, upper case, digit and separator after each of them, and at a token's start.
_TURNS = {
    "^": (0.60, 0.25, 0.10, 0.05),
    "l": (0.90, 0.03, 0.02, 0.05),
    "u": (0.26, 0.70, 0.02, 0.02),
    "d": (0.03, 0.02, 0.80, 0.15),
    "s": (0.55, 0.20, 0.20, 0.05),
}
_SIGNS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + _SEPARATORS


def _kind(x: str) -> str:
    return "l" if "a" <= x <= "z" else "u" if "A" <= x <= "Z" else "d" if "0" <= x <= "9" else x if x == "^" else "s"


def _text_logs() -> dict[tuple[str, str], float]:
    """Log chance of each sign after each other (^ at the start) in words, names, numbers and what joins them."""
    shares = [[2.0 ** (-int(x, 36) / 2) for x in row] for row in _PAIRS]
    shares = [[x / sum(row) for x in row] for row in shares]
    out = {}
    for a in "^" + _SIGNS:
        turns = dict(zip("luds", _TURNS[_kind(a)]))
        for b in _SIGNS:
            kind = _kind(b)
            if kind in "lu":
                # A letter goes on with a word, unless a capital opens a new one.
                goes_on = _kind(a) in "lu" and not (_kind(a) == "l" and kind == "u")
                row = shares[ord(a.lower()) - 96 if goes_on else 0]
                within = row[ord(b.lower()) - 97]
            else:
                within = 0.1 if kind == "d" else 1 / len(_SEPARATORS)
            out[a, b] = math.log(turns[kind] * within)
    return out


_TEXT = _text_logs()


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity(counts: dict[str, int], n: int, k: int) -> float:
    """Upper tail of the chi-squared statistic against k equally likely signs (Wilson-Hilferty)."""
    x = k / n * sum(c * c for c in counts.values()) - n
    d = k - 1
    return _normal_tail(((x / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))) if x > 0 else 1.0


def runs(signs: list[float], median: float) -> float:
    """Two-sided test of the number of runs above and below the middle of the alphabet."""
    high = [x > median for x in signs]
    a, n = sum(high), len(high)
    b = n - a
    if a == 0 or b == 0:
        return 2.0 ** (1 - n)
    found = 1 + sum(x != y for x, y in zip(high, high[1:]))
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / max(n - 1, 1)
    return 2 * _normal_tail(abs(found - mean) / math.sqrt(var)) if var > 0 else 1.0


def serial(signs: list[float]) -> float:
    """Two-sided test of the correlation of neighbours."""
    n = len(signs)
    mean = sum(signs) / n
    var = sum((x - mean) ** 2 for x in signs)
    if var == 0:
        return 0.0
    r = sum((x - mean) * (y - mean) for x, y in zip(signs, signs[1:])) / var
    return 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n))


def _repeats(signs: Iterable, k: int) -> float:
    """Log chance of signs of which three in four repeat one before, as often as it came, and one in four is of any k."""
    out, counts, n = 0.0, {}, 0
    for x in signs:
        c = counts.get(x, 0)
        out += math.log(0.75 * c / n) if c else -math.log(4 * k)
        counts[x] = c + 1
        n += 1
    return out


def plain_log(token: str) -> float:
    """Log chance of the token where it is likeliest: text, favoured signs, signs that follow each other, or steps."""
    text = sum(map(_TEXT.__getitem__, zip("^" + token, token)))
    after: dict[str, list[str]] = {}
    for a, b in zip("^" + token, token):
        after.setdefault(a, []).append(b)
    k = len(_SIGNS)
    chained = sum(_repeats(row, k) for row in after.values())
    steps = _repeats((ord(b) - ord(a) for a, b in zip(token, token[1:])), 2 * k) - math.log(k)
    return max(text, _repeats(token, k), chained, steps)


def random_log(n: int, k: int, separators: int, rules: SecretRules) -> float:
    """Log chance of one token of n random signs of an alphabet of k, and of separators between them if there are any."""
    out = -n * math.log(k) - math.log(HYPOTHESES)
    if separators:
        out += n * math.log(1 - rules.separated) + separators * math.log(rules.separated / len(_SEPARATORS))
    return out


def battery(token: str, rules: SecretRules) -> tuple[str, float] | None:
    """The token's encoding and the tail of its evidence, or None if a test says that it is not random.

    The evidence is how much likelier the token is as random signs of its alphabet than as anything plain, times the
    level of the three tests together (thrice the least of them, at most 1). Were the token plain, evidence of 1/x or
    more would have a chance of at most x (Markov), whatever the length and the alphabet: that x is the tail.
    """
    token = token.rstrip("=")
    bare = token
    found = next((e for e in ENCODINGS if e[2].fullmatch(token)), None)
    if found is None or found[0].startswith("base64"):
        # Separators are signs of the two base64 alphabets, unless the rest is written in a narrower one.
        bare = token.translate(dict.fromkeys(map(ord, _SEPARATORS)))
        inner = next((e for e in ENCODINGS[:-2] if e[2].fullmatch(bare)), None)
        if inner is None:
            return None
        split = random_log(len(bare), inner[1], len(token) - len(bare), rules)
        if found is None or split > random_log(len(token), found[1], 0, rules):
            found = (f"{inner[0]}-split", inner[1], None)
        else:
            bare = token
    name, k, _ = found
    n, counts = len(bare), Counter(bare)
    order = {x: i for i, x in enumerate("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz+/-")}
    signs = [float(order[x]) for x in bare]
    middle = sorted(signs)[n // 2] - 0.5
    least = min(uniformity(counts, n, k), runs(signs, middle), serial(signs))
    if least < rules.alpha:
        return None
    gain = random_log(n, k, len(token) - n, rules) - plain_log(token) + math.log(min(1.0, 3 * least))
    return name, math.exp(-min(max(gain, 0.0), 690.0))


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("span", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("stratum", T.StringType()),
            T.StructField("bin", T.IntegerType()),
        ]
    )
)
FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_assign", T.LongType()),
        T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("found", SPANS),
    ]
)


def scan(text: str | None, rules: SecretRules) -> tuple:
    """FOUND's values after doc_id: base spans (bin null) and candidates (bin: the tail's place on the grid)."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    base += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    base.sort()
    found = [(f"{KINDS[rank]}:{start}:{end}", start, rank, None, None) for start, rank, end in base]
    joined = ",".join(x[0] for x in found)
    for m in _TOKEN.finditer(text):
        if any(start < m.end() and m.start() < end for start, _, end in base):
            continue
        passed = battery(m.group(), rules)
        if passed:
            name, tail = passed
            size = max(x for x in rules.strata if x <= m.end() - m.start())
            place = min(rules.grid_top, int(rules.grid * -math.log10(max(tail, 1e-300))))
            found.append((f"random:{m.start()}:{m.end()}", m.start(), 3, f"{name}/{size}", place))
    found.sort(key=lambda x: (x[1], x[2]))
    counts = [sum(x[1] == rank for x in base) for rank in (0, 1, 2)]
    return *counts, hashlib.sha256(joined.encode()).hexdigest(), found


def discoveries(found: DataFrame, rules: SecretRules) -> DataFrame:
    """(stratum, least): from which place on the grid candidates of a stratum are discoveries (Benjamini-Hochberg).

    A tail counts as its place's upper end, so that the share of false discoveries is at most q within each stratum.
    The table has at most strata times encodings rows: candidates are counted by place before anything is ordered.
    """
    rows = found.select(F.explode("found").alias("x")).filter("x.bin is not null")
    rows = rows.groupBy(F.col("x.stratum").alias("stratum"), F.col("x.bin").alias("bin")).agg(F.count("*").alias("n"))
    down = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    rows = rows.withColumn("above", F.sum("n").over(down)).withColumn("all", F.sum("n").over(Window.partitionBy("stratum")))
    holds = F.pow(F.lit(10.0), -F.col("bin") / rules.grid) * F.col("all") <= rules.q * F.col("above")
    return rows.filter(holds).groupBy("stratum").agg(F.min("bin").alias("least"))


def secret_spans(docs: DataFrame, rules: SecretRules = SecretRules()) -> DataFrame:
    """One row a row of docs(doc_id, text): base counts and hash, and all spans.

    Texts are read once; what is found, a few numbers a document, is written to the shared folder, and read again when
    the whole table's tails have set the thresholds. Null and empty texts have no spans; repeated rows are scanned one
    by one, and each counts for the thresholds; a null doc_id stays null; other columns are ignored.
    """

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            out = [scan(x, rules) for x in rows["text"]]
            columns = {k: [x[i] for x in out] for i, k in enumerate(FOUND.names[1:-1])}
            spans = [[dict(zip(SPANS.elementType.names, s)) for s in x[-1]] for x in out]
            return {"doc_id": rows["doc_id"]} | columns | {"found": spans}

        return step

    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.save(map_slices(docs.select("doc_id", "text"), FOUND, make), "found")
    least = {r.stratum: r.least for r in discoveries(found, rules).collect()}

    def stays(x: Column) -> Column:
        out = x["bin"].isNull()
        for stratum, at in sorted(least.items()):
            out = out | ((x["stratum"] == stratum) & (x["bin"] >= at))
        return out

    kept = F.filter("found", stays)
    spans = F.array_join(F.transform(kept, lambda x: x["span"]), ",")
    added = F.size(F.filter(kept, lambda x: x["rank"] == 3)).cast("long")
    return found.select(*FOUND.names[:-1], spans.alias("spans"), added.alias("n_random"))
