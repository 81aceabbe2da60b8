"""Phrase collocations against plain counting, collisions of fingerprints, and the odd rows."""

import random
import re
from collections import Counter

import numpy as np

from litpulse.llm import phrases
from tests.llm.test_operators import llm, none, odd, odd_rows  # noqa: F401

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def counted(rows, longest=4):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        n[lang] += 0
        for piece in PIECE.split(low):
            w = WORD.findall(piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    return f, n


def expected(rows, least, best=2000, covered=80):
    f, n = counted(rows)
    c = {k: a for k, a in f.items() if len(k[1]) >= 2 and a >= least}
    out = {}
    for (lang, w), a in c.items():
        around = [x for (other, v), x in c.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * x >= covered * a for x in around):
            continue
        cuts = [(2_000_000 * a // (f[(lang, w[:k])] + f[(lang, w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, w[:k])], f[(lang, w[k:])]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in out.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1)
    )


def made_up(rng, n):
    words = ["New", "york", "CITY", "of", "the", "é", "Éa", "x1", "don't", "日本", "a", "b"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "!", " "]
    return [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randrange(60)))) for _ in range(n)]


def test_against_counting(llm):  # noqa: F811
    rows = made_up(random.Random(1), 400) + [("fr", None), ("fr", "")]
    docs = llm.createDataFrame(rows, "lang string, text string").repartition(3)
    for longest in (1, 2, 3, 4):
        found, words = phrases.frequent_phrases(docs, 5, longest)
        f, n = counted(rows, longest)
        assert {(r.lang, tuple(r.phrase.split(" "))): r.occurrences for r in found.collect()} == {k: a for k, a in f.items() if a >= 5}
        assert {r.lang: r.words for r in words.collect()} == n
    got = sorted(tuple(r) for r in phrases.collocations(docs, 5, best=40).collect())
    assert got == expected(rows, 5, 40)


def test_small_blocks(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 300)
    for _, text in made_up(random.Random(1), 400):
        parts = list(phrases._cut(text))
        assert "".join(parts) == text and max(map(len, parts)) <= 300 and all(re.search(r"[.,;:!?\n]$", p) for p in parts[:-1])


def test_parts_end_at_breaks():
    text = "one two. " * 5_000_000
    parts = list(phrases._cut(text))
    assert "".join(parts) == text and len(parts) > 3 and all(p.endswith(".") for p in parts[:-1])
    text = "word " * 3_000_000 + "\nend"
    assert list(phrases._cut(text)) == ["word " * 3_000_000 + "\n", "end"]


def test_equal_fingerprints_fall_apart(llm):  # noqa: F811
    """With fingerprints of two bits nearly all collide, within blocks and between them."""
    codes = np.array([0, 1, 0, 1, 2, -1], dtype="<i4")
    places = np.array([0, 1, 2, 3])
    f, first, counts = phrases.distinct(np.array([7, 7, 7, 7]), places, codes, 2)
    assert f.tolist() == [7, 7, 7] and first.tolist() == [0, 1, 3] and counts.tolist() == [2, 1, 1]
    code, of = phrases._word_codes(np.array([5, 5, 5], dtype=np.uint64), np.frombuffer(b"abaxb", dtype=np.uint8), np.array([2, 1, 2]))
    assert code.tolist() == [0, 1, 2] and of.tolist() == [0, 1, 2]
    # Entries of one key in several blocks: 29 and 1 reach 30, 255 stands for more, other keys do not help.
    runs = [(3, 1, np.array([5, 9, 11], "<u4"), [29, 29, 255]), (3, 2, np.array([5, 8], "<u4"), [1, 200]), (4, 2, np.array([5], "<u4"), [1])]
    rows = [(s, b, bytearray(k.tobytes()), bytearray(bytes(c))) for s, b, k, c in runs]
    df = llm.createDataFrame(rows, phrases.RUN).coalesce(1).sortWithinPartitions("slice")
    got = {(r.block, r.slice): np.unpackbits(np.frombuffer(r.bits, np.uint8)).tolist()[:3] for r in df.mapInArrow(phrases._sums(30), phrases.BITS).collect()}
    assert got == {(1, 3): [1, 0, 1], (2, 3): [1, 1, 0], (2, 4): [0, 0, 0]}


def test_all_fingerprints_collide():
    """When every key of a length is the same, counts by text still decide."""
    rows = made_up(random.Random(2), 200)
    blocks = [phrases.make_block(k, [("en", t) for _, t in rows[k::3]]) for k in range(3)]
    found = Counter()
    for row in blocks:
        block = phrases.Block(row)
        every = [{"level": level, "slice": s, "bits": bytes([255]) * 10_000} for level in (1, 2, 3) for s in range(64)]
        for batch in phrases._texts(3, 4, 6)([_batch(row, every)]):
            for r in batch.to_pylist():
                found[(r["lang"], tuple(r["phrase"].split(" ")))] += r["occurrences"]
        assert len(block.codes) == row["size"]
    assert found == counted([("en", t) for _, t in rows])[0]


def _batch(row, bits):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist([{**row, "bits": bits}])


def test_odd_rows(llm, odd, none):  # noqa: F811
    assert phrases.collocations(none).count() == 0
    rows = [(r[2], r[1]) for r in odd_rows()]
    got = sorted(tuple(r) for r in phrases.collocations(odd, 30).collect())
    assert got and got == expected(rows, 30)


def test_one_hot_language(llm):  # noqa: F811
    rng = random.Random(3)
    rows = [("en", "the same line again. " * 30)] * 100 + made_up(rng, 200)
    got = sorted(tuple(r) for r in phrases.collocations(llm.createDataFrame(rows, "lang string, text string"), 20).collect())
    assert got == expected(rows, 20)
