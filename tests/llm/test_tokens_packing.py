import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstone.llm import packing, pretokens, tokencount
from tests.llm import cases

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.text(st.sampled_from("ab'sretlmvdX É9ſ!.\n\t\r Σ中\u0301<|>"), max_size=60)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_counts_and_ids_equal_the_library(text):
    counter = pretokens.word_counter(WORD, PROVEN)
    assert counter.count(text) == len(pretokens.tokenizer(WORD).encode(text, add_special_tokens=False).ids)
    ids = np.frombuffer(pretokens.byte_encoder(BYTE).encode(text), "<u4").tolist()
    assert ids == pretokens.tokenizer(BYTE).encode(text, add_special_tokens=False).ids


PROVEN = pretokens.prove_whole_tokens(WORD)


def test_blocks_do_not_change_tokens():
    text = cases.prose(3000, 1)
    parts = list(pretokens.blocks(text, 500))
    assert "".join(parts) == text and len(parts) > 10
    merger = pretokens.tokenizer(BYTE)
    whole = merger.encode(text, add_special_tokens=False).ids
    assert sum((merger.encode(x, add_special_tokens=False).ids for x in parts), []) == whole


def test_proof_holds_for_every_string():
    merger = pretokens.tokenizer(WORD)
    some = sorted(PROVEN)[::50]
    assert len(PROVEN) > 30000
    assert all(len(merger.encode(x, add_special_tokens=False).ids) == 1 for x in some)


def test_token_counts(spark):
    got = tokencount.token_counts(cases.docs(spark), WORD, limit=100).collect()
    merger = pretokens.tokenizer(WORD)
    key = lambda x: tuple((v is None, v) for v in x)
    want = [(i, len((t or "").encode()), len(merger.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in cases.texts()]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert tokencount.token_counts(cases.docs(spark, []), WORD).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=5), st.integers(0, 40))
def test_best_fill_equals_brute_force(counts, capacity):
    got = packing.best_fill(counts, capacity)
    assert all(got.count(x) <= counts[x] for x in got)
    pieces = [x for x, n in counts.items() for _ in range(n)]
    best = max(sum(c) for k in range(len(pieces) + 1) for c in combinations(pieces, k) if sum(c) <= capacity)
    assert sum(got) == best


def test_pack_round_trip(spark):
    rows = packing.pack(cases.docs(spark), BYTE, packing.PackRules(window=256, group_docs=8)).collect()
    encoder = pretokens.byte_encoder(BYTE)
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id, r.doc_tokens].append(r)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    for i, t, _ in cases.texts():
        ids = encoder.encode(t) + bytes(4)
        pieces = sorted({(r.start, r.length, r.ids_crc32) for r in docs[i, len(ids) // 4]})
        found = {(a, n) for a, n, crc in pieces if zlib.crc32(ids[4 * a : 4 * (a + n)]) == crc}
        assert sum(n for _, n in found) == len(ids) // 4
    padding = sum(256 - sum(n for _, n in p) for p in sequences.values())
    assert padding <= 256 * 3 * 2
    assert packing.pack(cases.docs(spark, []), BYTE).count() == 0
