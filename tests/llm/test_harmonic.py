"""Harmonic packing: exact round trip, classes, padding, and the odd rows."""

import random
import zlib
from collections import defaultdict

import numpy as np

from litpulse.llm import harmonic
from litpulse.llm.tokens import encoder, public_path
from tests.llm.test_operators import DOCS, llm, none, odd, odd_rows, sentence  # noqa: F401


def whole_ids(text):
    return encoder(public_path()).encode_whole([text or ""])[0] + np.array([harmonic.END_ID], dtype="<u4").tobytes()


def test_cuts():
    for size in (2048, 1024, 100, 7):
        capacities = {size // k for k in range(1, size + 1)}
        for n in range(0, 3 * size):
            got = harmonic.cuts(n, size)
            assert sum(got) == n and set(got) <= capacities and got == sorted(got, reverse=True)
            # Brute force: each cut is the largest reciprocal capacity that still fits.
            left = n
            for x in got:
                assert x == max(c for c in capacities if c <= left)
                left -= x
    assert max(len(harmonic.cuts(n, 2048)) for n in range(2048)) <= 4
    assert all(sum(harmonic.powers_of_two(n)) == n for n in range(1, 300))


def check(rows, got, size=2048):
    """Every id in one piece, equal lengths and fixed counts in a sequence; the ids padded."""
    want = defaultdict(int)
    for doc_id, text, *_ in rows:
        want[(doc_id, whole_ids(text))] += 1
    found, padding, partial = defaultdict(list), 0, 0
    for r in got:
        lengths = {s.length for s in r.segments}
        assert len(lengths) == 1 and len(r.segments) <= size // min(lengths)
        assert [s.offset for s in r.segments] == [k * min(lengths) for k in range(len(r.segments))]
        assert r.n_ids == sum(s.length for s in r.segments) <= size
        assert len(r.ids) == 4 * harmonic.padded_length(r.n_ids, size)
        assert not any(r.ids[4 * r.n_ids :])
        padding += len(r.ids) // 4 - r.n_ids
        partial += len(r.segments) < size // min(lengths)
        for s in r.segments:
            found[(s.doc_id, s.doc_tokens)].append((s.start, bytes(r.ids[4 * s.offset : 4 * (s.offset + s.length)])))
    assert sum(n * len(ids) // 4 for (_, ids), n in want.items()) == sum(r.n_ids for r in got)
    for (doc_id, ids), n in want.items():
        pieces = found[(doc_id, len(ids) // 4)]
        if n == 1 and sum(d == doc_id and len(i) == len(ids) for d, i in want) == 1:
            assert b"".join(b for _, b in sorted(pieces)) == ids
        at = defaultdict(int)
        for s, b in pieces:
            at[(s, b)] += 1
    assert len({r.sequence_id for r in got}) == len(got)
    return padding, sum(r.n_ids for r in got)


def test_odd_rows(odd, none):  # noqa: F811
    assert harmonic.pack_documents(none, public_path()).count() == 0
    assert harmonic.pieces(harmonic.pack_documents(none, public_path())).count() == 0
    packed = harmonic.pack_documents(odd, public_path())
    check(odd_rows(), packed.collect())
    ids = {(d, len(i) // 4): i for d, i in ((r[0], whole_ids(r[1])) for r in odd_rows())}
    covered = defaultdict(int)
    for p in harmonic.pieces(packed).collect():
        i = ids[(p.doc_id, p.doc_tokens)]
        assert p.ids_crc32 == zlib.crc32(i[4 * p.start : 4 * (p.start + p.length)])
        covered[(p.doc_id, p.doc_tokens, p.start)] += 1
    repeated = [k for k, n in covered.items() if n > 1]
    assert {k[0] for k in repeated} == {4}


def test_little_padding(llm):  # noqa: F811
    rng = random.Random(5)
    rows = [(k, sentence(rng, rng.randrange(1, 900)), "en", "a", 0) for k in range(1500)]
    got = harmonic.pack_documents(llm.createDataFrame(rows, DOCS).repartition(3), public_path()).collect()
    padding, used = check(rows, got)
    assert padding < 0.005 * used
    # A sequence is padded only if it is a full one whose k pieces leave less than k places.
    for r in got:
        k = 2048 // r.segments[0].length
        assert len(r.ids) // 4 - r.n_ids < k
    assert sum(len(r.segments) for r in got) < 5 * len(rows)


def test_one_hot_document(llm):  # noqa: F811
    """A third of all rows repeat one document; nothing is grouped by it."""
    rng = random.Random(6)
    rows = [(1, "the same words " * 40, "en", "a", 0)] * 200 + [(k, sentence(rng, 50), "en", "a", 0) for k in range(400)]
    check(rows, harmonic.pack_documents(llm.createDataFrame(rows, DOCS), public_path()).collect())
