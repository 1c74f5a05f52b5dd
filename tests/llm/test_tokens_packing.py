"""Ids against the tokenizer itself, pieces and files against those ids."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import arrow_ids, packing, queries
from corpusloom.llm.tokens import TokenEncoder

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ENCODERS = {n: TokenEncoder(public_tokenizers.path(n), words_kept=500) for n in NAMES}
TRUTH = {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in NAMES}
PIECES = st.sampled_from(
    ["foo", "Bar,", "'s", "don't", " ", "  ", "\n", "\n\n", "\t", "é", "é", "12", "...", ",", "ß", "\x01",
     " ", "\x1c", "<|endoftext|>", "漢字", "\U0001f600", "İ", "Σ"]
)


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=1, max_size=6))
def test_ids_equal_the_tokenizer(name, texts):
    ids, counts = ENCODERS[name].encode(texts, end_id=7)
    want = [[*TRUTH[name].encode(t, add_special_tokens=False).ids, 7] for t in texts]
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == want


def ids_of(name, text, end):
    own = TRUTH[name].encode(text or "", add_special_tokens=False).ids
    return np.array([*own, end], "<u4")


@given(lengths=st.lists(st.integers(1, 5000), max_size=60))
@settings(max_examples=60, deadline=None)
def test_every_token_is_packed_once(lengths):
    done, rest = packing.pack_block([(i, 0, n) for i, n in enumerate(lengths)])
    done = done + packing.cut_at_powers(rest, 2048)
    seen = collections.defaultdict(list)
    for tier, row in done:
        size = sum(p[2] for p in row)
        assert size == tier or (tier == 2048 and size < packing.SHORTEST)
        for doc, start, length in row:
            seen[doc].append((start, length))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[doc]):
            assert start == at and length > 0
            at += length
        assert at == n


def test_groups_of_a_tier_have_near_equal_costs():
    rows = [(2048, [(0, 0, n), (1, 0, 2048 - n)]) for n in range(1, 1025)]
    groups = packing.step_groups(rows, group_tokens=2048 * 64)
    cost = collections.Counter()
    for (_, row), g in zip(rows, groups, strict=True):
        cost[g] += sum(n * n for _, _, n in row)
    assert len(cost) == 16 and max(cost.values()) < 1.02 * min(cost.values())


def test_odd_rows_are_packed_whole(odd):
    rows = packing.pack_documents(odd, public_tokenizers.path(NAMES[0])).collect()
    got = collections.Counter()
    for r in rows:
        got[r.doc_id] += r.length
    want = collections.Counter()
    for r in odd.collect():
        want[r.doc_id] += len(ids_of(NAMES[0], r.text, 1))
    assert got == want


def test_packed_pieces_are_the_ids_of_the_tokenizer(spark, sf, documents):
    """Every piece by its own ids, every sequence without gaps and padded at its end only."""
    rows = queries.op1_packing(spark, sf).collect()
    ids = {r.doc_id: ids_of(NAMES[0], r.text, 1) for r in documents.collect()}
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length > 0 and r.ids_crc32 == zlib.crc32(piece.tobytes())
        assert r.doc_tokens == len(ids[r.doc_id])
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == ids.keys()
    for group, size in [(by_doc[d], len(ids[d])) for d in ids] + [(s, None) for s in by_sequence.values()]:
        at = 0
        for start, length in sorted(group):
            assert start == at
            at += length
        assert at == size if size is not None else at <= 2048


def test_nothing_is_packed_from_nothing(empty):
    path = public_tokenizers.path(NAMES[0])
    assert packing.pack_documents(empty, path).count() == 0
    assert arrow_ids.ids_round_trip(empty, path).count() == 0


def test_files_hold_all_ids_in_order(odd):
    name = NAMES[1]
    got = arrow_ids.ids_round_trip(odd, public_tokenizers.path(name), end_id=2, length=64)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got.collect())
    at = 0
    by_id = collections.defaultdict(collections.Counter)
    for r in odd.collect():
        ids = ids_of(name, r.text, 2)
        by_id[r.doc_id][(len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert got[0][1] is None
    assert [g[1] for g in got[1:]] == sorted(g[1] for g in got[1:])
    for start, doc, n, crc in got:
        assert start == at
        at += n
        by_id[doc][(n, crc)] -= 1
    assert not any(v for c in by_id.values() for v in c.values())
