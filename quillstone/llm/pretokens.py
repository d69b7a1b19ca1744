"""Byte-pair encoding by pre-token: texts are cut by the tokenizer's own pattern, and each distinct pre-token is merged once."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
import tiktoken

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

#: The two vocabularies' pre-token patterns, as their files and the library state them.
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters whose class, case and normal form no two Unicode versions or libraries see differently.
_ODD = re.compile(r"[^\t\n\r\x20-\x7e¡-¬®-įı-ſ‐-‧€]")

#: Characters cut and merged at once; bounds the working memory for very long texts.
BLOCK_CHARS = 1 << 18
#: Pre-tokens, and stretches between spaces, remembered in a task.
CACHE_ENTRIES = 200_000
CACHE_STRETCHES = 400_000


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


@lru_cache(maxsize=4)
def added_strings(path: str) -> tuple[str, ...]:
    return tuple(x.content for x in tokenizer(path).get_added_tokens_decoder().values())


def blocks(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """The text in pieces of about size characters, cut before a space that stands between two ASCII word characters.

    No pre-token, normal form or added string spans such a place, so that a text's tokens are its pieces' tokens.
    """
    at = 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start() + 1]
        at = found.start() + 1
    yield text[at:] if at else text


_CUT = re.compile(r"[A-Za-z0-9](?= [A-Za-z])")


class _Stretches(dict):
    """What a stretch between spaces comes to, by way of its pre-tokens."""

    def __init__(self, find) -> None:
        self.find = find

    def __missing__(self, stretch: str):
        out = self[stretch] = self.find(stretch)
        return out

    def trim(self) -> None:
        if len(self) > CACHE_STRETCHES:
            self.clear()


class WordCounter:
    """Counts of the lower-casing vocabulary. proven: pre-tokens that are one token; the rest is merged by the library.

    White space stands between pre-tokens, never in them, so that stretches between it are counted on their own.
    """

    def __init__(self, path: str, proven: frozenset[str]) -> None:
        self.tokenizer, self.added = tokenizer(path), added_strings(path)
        self.cut = regex.compile(WORD_BPE_PATTERN).findall
        self.known = _Counts(self.tokenizer, proven)
        self.stretches = _Stretches(lambda x: sum(map(self.known.__getitem__, self.cut(x))))

    def count(self, text: str | None) -> int:
        return sum(map(self._count, blocks(text))) if text else 0

    def _count(self, text: str) -> int:
        if _ODD.search(text) or any(x in text for x in self.added):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        out = sum(map(self.stretches.__getitem__, text.lower().split()))
        self.known.trim()
        self.stretches.trim()
        return out


@lru_cache(maxsize=2)
def word_counter(path: str, proven: frozenset[str]) -> WordCounter:
    """One a process: a worker's later tasks go on with what earlier ones merged."""
    return WordCounter(path, proven)


class _Counts(dict):
    def __init__(self, merger: Tokenizer, proven: frozenset[str]) -> None:
        self.merger, self.proven = merger, proven
        self.trim()

    def __missing__(self, pre_token: str) -> int:
        n = self[pre_token] = len(self.merger.encode(pre_token, add_special_tokens=False).ids)
        return n

    def trim(self) -> None:
        if not self or len(self) > CACHE_ENTRIES + len(self.proven):
            self.clear()
            self.update(dict.fromkeys(self.proven, 1))


def prove_whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary's strings that, encoded alone, are that one token.

    A pre-token's merges depend on nothing around it, so that each proof holds wherever the pre-token stands.
    """
    merger = tokenizer(path)
    vocabulary = {k: v for k, v in merger.get_vocab(with_added_tokens=False).items() if k.endswith("</w>")}
    cut = regex.compile(WORD_BPE_PATTERN)
    sign_byte = {sign: byte for byte, sign in _byte_signs().items()}
    texts, ids = [], []
    for shown, number in vocabulary.items():
        try:
            text = bytes(sign_byte[x] for x in shown[: -len("</w>")]).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text and not _ODD.search(text) and cut.fullmatch(text) and text == text.lower():
            texts.append(text)
            ids.append(number)
    found = merger.encode_batch(texts, add_special_tokens=False)
    return frozenset(text for text, number, x in zip(texts, ids, found) if x.ids == [number])


def _byte_signs() -> dict[int, str]:
    """How byte-level vocabularies write bytes: visible Latin-1 as itself, the others from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class ByteEncoder:
    """Ids of a byte-level vocabulary file, as little-endian unsigned 32-bit bytes.

    Ordinary texts go through the same vocabulary as ranks, which is the quicker library; texts that hold an added
    string, or a character that libraries may class differently, go through the file's own.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer, self.added = tokenizer(path), added_strings(path)
        self.ranked = tiktoken.Encoding("ranked", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks(path), special_tokens={})

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self._encode, blocks(text))) if text else b""

    def _encode(self, text: str) -> bytes:
        if _ODD.search(text) or any(x in text for x in self.added):
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        else:
            ids = self.ranked.encode_to_numpy(text, disallowed_special=())
        return ids.astype("<u4", copy=False).tobytes()


def ranks(path: str) -> dict[bytes, int]:
    """The vocabulary by bytes. Ids must follow the order of the merges, else they are not ranks."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    sign_byte = {sign: byte for byte, sign in _byte_signs().items()}
    made = [model["vocab"]["".join(x if isinstance(x, list) else x.split(" "))] for x in model["merges"]]
    if made != sorted(made) or len(made) + 256 != len(model["vocab"]):
        raise ValueError(f"the ids of {path} do not follow its merges")
    return {bytes(sign_byte[x] for x in shown): number for shown, number in model["vocab"].items()}


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """One a process: a worker's later tasks find it ready."""
    return ByteEncoder(path)
