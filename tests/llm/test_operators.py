"""The operators against brute force and exact round trips, with nulls, empty and repeated rows, and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from litpulse.llm import chat, html, linejoin, mixing, ordermin, packing, residual, rules, secrets, vectors
from litpulse.llm.common import components, prepare
from litpulse.llm.tokens import encoder, piece_bounds, public_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def llm(spark):
    return prepare(spark)


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"v{k % 977}" for k in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some text", "en", "a", 9), (None, None, None, "b", None)]
    return rows + [(3, long, "en", "b", len(long)), (4, long, "en", "b", len(long)), (4, long, "en", "b", len(long)), (5, " \n\t", "en", None, 3)]


@pytest.fixture(scope="module")
def odd(llm):
    # Helper columns of the operators are taken here.
    names = ("n_words", "_words", "mix_key", "copy", "th", "h", "key", "rest", "members")
    return llm.createDataFrame(odd_rows(), DOCS).select("*", *(F.lit("x").alias(n) for n in names))


@pytest.fixture(scope="module")
def none(llm):
    return llm.createDataFrame([], DOCS)


def test_components(llm):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(20)]
    parent = list(range(200))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.id: r.root for r in components(llm.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: find(i) for e in edges for i in e if e[0] != e[1]} | {i: find(i) for i in got}


def test_token_ids_equal_the_library(sf):
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{sf}/documents.parquet").column("text").to_pylist()
    texts += ["", " ", "a  b", "\n", " x ", "a\tb", "x <|endoftext|> y", "日本 語", "a b", "\0a\0 b", "“q” — x", "don't I'll\nwe've", "1234 567\n89", "a" * 3000]
    e = encoder(public_path())
    assert e.encode(texts) == e.encode_whole(texts)
    assert e.encode(texts) == e.encode_whole(texts)


def test_best_fit_decreasing():
    rng = random.Random(2)
    lengths = [rng.randint(1, 64) for _ in range(500)]
    bins = packing.best_fit_decreasing(lengths, 64)
    assert sorted(i for b in bins for i in b) == list(range(500))
    free: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = min((f for f in free if f >= n), default=None)
        if fit is None:
            free.append(64 - n)
        else:
            free.remove(fit)
            free.append(fit - n)
    assert Counter(free) == Counter(64 - sum(lengths[i] for i in b) for b in bins)


def pieces_expected(rows):
    e = encoder(public_path())
    out = []
    for doc_id, text, *_ in rows:
        ids = e.encode_whole([text or ""])[0] + np.array([2], dtype="<u4").tobytes()
        out += [(doc_id, k, s, ids[4 * s : 4 * (s + n)]) for k, (s, n) in enumerate(piece_bounds(len(ids) // 4, 1024))]
    return out


def test_packed_matrices(odd, none):
    assert packing.pack_documents(none, public_path()).count() == 0
    got = packing.pack_documents(odd, public_path()).collect()
    found = []
    for r in got:
        assert len(r.ids) == 4096 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_ids <= 1024
        positions = np.frombuffer(r.position_ids, dtype="<u4")
        for k, (a, b) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:])):
            assert positions[a:b].tolist() == list(range(b - a))
            found.append((r.doc_ids[k], r.pieces[k], r.starts[k], bytes(r.ids[4 * a : 4 * b])))
    order = lambda x: (x[0] is None, x[0] or 0, x[1], x[3])
    assert sorted(found, key=order) == sorted(pieces_expected(odd_rows()), key=order)
    assert len({r.sequence_id for r in got}) == len(got)


@pytest.mark.parametrize("per_task", [40, 20_000])
def test_residual_packing(llm, none, odd, per_task):
    assert residual.pack_documents(none, public_path()).count() == 0
    rng = random.Random(3)
    rows = odd_rows() + [(100 + k, sentence(rng, rng.randrange(1, 500)), "en", "a", 0) for k in range(300)]
    docs = llm.createDataFrame(rows, DOCS)
    got = residual.pack_documents(docs, public_path(), items_per_task=per_task).collect()
    key = lambda d, p, s, n, c: (d is None, d or 0, p, s, n, c)
    want = [key(d, p, s, len(i) // 4, zlib.crc32(i)) for d, p, s, i in pieces_expected(rows)]
    assert sorted(key(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    if per_task > 1000:
        assert len(by) <= sum(r.length for r in got) / 1024 * 1.02 + 1


def base_reference(text):
    """The base patterns as they are stated."""
    out = []
    patterns = (r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+")
    for kind, (p, g, n) in enumerate(zip(patterns, (2, 0, 0), (6, 20, 24))):
        out += [(m.start(g), kind, m.end(g)) for m in re.finditer(p, text) if len(m.group(g)) >= n]
    return sorted(out)


def test_base_spans():
    rng = random.Random(4)
    bits = ["password", "PassWd = ", "token", ': "', "=", "abc", "0123456789abcdef", "AKIA", "QWERTYUIOP12345678", " ", "api_key", "APIKEY", "'", "é", "secret:", "x.y-z", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert secrets.base_spans(text) == base_reference(text)


def test_base_spans_in_either_case_of_unicode():
    stated = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
    rng = random.Random(6)
    bits = ["pa\u017fsword", "\u017fecret", "TO\u212aEN", "ap\u0130key", "AP\u0131_\u212aEY", "token", "=", ": ", "abc", "\u017f", "\u212a", "\u0130", "\u0131", "é", " "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(3000)]
    for text in [*texts, "\u017fecret=abcdefg", "ap\u0131key=abc\u0130efg"]:
        want = [(m.start(2), 0, m.end(2)) for m in stated.finditer(text) if len(m[2]) >= 6]
        assert secrets.base_spans(text) == want
    assert secrets.base_spans("\u017fecret=abcdefg") == [(7, 0, 14)]


def test_viterbi_over_stretches_is_that_of_the_whole():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        e, pairs = rng.normal(size=(n, 3)), rng.normal(size=(3, 3))
        e[:, 0] += rng.choice([0, 9], size=n)
        best = max(np.ndindex(*(3,) * n), key=lambda y: sum(e[i, t] for i, t in enumerate(y)) + sum(pairs[a, b] for a, b in zip(y, y[1:])))
        assert secrets.decode(e, pairs) == {i: t for i, t in enumerate(best) if t}


def test_secrets(llm, odd, none, sf):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    model = secrets.fit_on_sample(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.spans for r in secrets.find_secrets(docs, model).collect()}
    for i, text in texts.items():
        base = [(s.start, secrets.KINDS.index(s.kind), s.end) for s in got[i] if s.kind != "crf"]
        assert base == base_reference(text)
    # The field alone finds most of what the patterns find, and little else.
    tagged = secrets.crf_spans(model, list(texts.values()), ["en"] * len(texts))
    base = [{(s, e) for s, _, e in base_reference(t)} for t in texts.values()]
    hits, missed = sum(len(b & set(t)) for b, t in zip(base, tagged)), sum(len(b - set(t)) for b, t in zip(base, tagged))
    assert hits >= 0.8 * (hits + missed)
    assert sum(map(len, tagged)) - hits <= 0.02 * len(texts)
    assert secrets.find_secrets(odd, model).count() == odd.count()
    assert secrets.find_secrets(none, secrets.fit_on_sample(none)).count() == 0


def test_training_windows_are_bounded():
    most = secrets.SECRET_TOKENS + 2 * secrets.WINDOW_TOKENS
    texts = ["0123456789abcdef" * 20_000, "\n".join(f"token = 'q{k}W8e7R6t5Y4u3I2o{k}'" for k in range(3000)), "plain words only " * 50]
    windows = [secrets.training_windows(x, "en", 0) for x in texts]
    assert all(windows) and max(map(len, windows)) == secrets.DOCUMENT_WINDOWS
    assert max(len(w["tags"]) for x in windows for w in x) <= most
    model = secrets.fit([w for x in windows for w in x], rounds=3)
    assert all(np.isfinite(x).all() for x in model)


def measures_reference(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in rules.SYMBOLS for c in text), len(lines), len(lines) - len(set(lines)), len(covered)


def test_rule_ledger(llm, odd, none):
    rng = random.Random(6)
    texts = [sentence(rng, n, v) + e for n in (0, 3, 60, 200) for v in (1, 5, 300) for e in ("", "\nx\nx\n \n", " # | é")]
    docs = llm.createDataFrame([(k, t, "en", "a", 0) for k, t in enumerate(texts)], DOCS).unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    for r in rules.ledger(docs).collect():
        assert tuple(r[m] for m in rules.MEASURES) == measures_reference(r.text)
        assert bool(r.fail_bits & 1) == (r.n_words < 50) and bool(r.fail_bits & 2) == (100 * r.n_repeat_words > 50 * r.n_words)
    assert rules.keep_good(odd).columns == odd.columns
    assert {r.doc_id for r in rules.keep_good(docs).collect()} == {r.doc_id for r in rules.ledger(docs).where(rules.passes()).collect()}
    assert rules.ledger(none).count() == 0
    plan = rules.keep_good(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_ablations(llm):
    bits = [0, 1, 1, 3, 4, 12, 63]
    got = {(r.policy, r.rule): r for r in rules.ablations(llm.createDataFrame([(b,) for b in bits], "fail_bits bigint")).collect()}
    for policy, mask in rules.POLICIES.items():
        for k, (name, _) in enumerate(rules.RULES):
            if mask >> k & 1:
                r, own = got[policy, name], [b & mask for b in bits]
                assert r.rejected == sum(b >> k & 1 for b in own)
                assert r.rejected_only_by_it == sum(b == 1 << k for b in own)
                assert r.rejected_without_it == sum(bool(b & ~(1 << k)) for b in own)


def targets_reference(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values())
    open_ = set(names)
    while open_ and left > 1e-9:
        level, total, full = left, sum(weight[s] for s in open_), set()
        for s in open_:
            target[s] += level * weight[s] / total
        left = 0.0
        for s in open_:
            if target[s] > 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                full.add(s)
        open_ -= full
    return target


@pytest.mark.parametrize("seed", range(4))
def test_source_targets(llm, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 3, 50, 4000]) * rng.randrange(1, 9) for s in [None, "é", "B", "a", "z", "aa", "", "c"][: 8 - seed]}
    got = {r.source: r for r in mixing.source_targets(llm.createDataFrame(list(sizes.items()), "source string, size bigint")).collect()}
    want = targets_reference(sizes)
    for s, t in want.items():
        assert got[s].source_size == sizes[s] and got[s].target == pytest.approx(t, abs=1e-6)
    assert sum(r.target for r in got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix(llm, odd, none):
    rng = random.Random(8)
    rows = [(k, sentence(rng, 40), "en", rng.choice("abb"), 0) for k in range(600)]
    docs = llm.createDataFrame(rows, DOCS)
    taken = Counter(r.source for r in mixing.mix(docs).collect())
    want = targets_reference({s: 40 * n for s, n in Counter(r[3] for r in rows).items()})
    for s, t in want.items():
        assert abs(taken[s] * 40 - t) < 0.15 * t
    again = sorted(r.doc_id for r in mixing.mix(docs.repartition(3)).collect())
    assert again == sorted(r.doc_id for r in mixing.mix(docs).collect())
    assert max(Counter(again).values()) <= 2
    assert mixing.mix(odd).columns == odd.columns and mixing.mix(none).count() == 0


def grams(text):
    w = ordermin.TOKEN.findall((text or "").lower())
    seen, out = Counter(), set()
    for g in [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []:
        out.add((g, seen[g]))
        seen[g] += 1
    return out


def classes_reference(rows):
    texts = sorted({t or "" for _, t in rows})
    sets, parent = [grams(t) for t in texts], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for d, t in rows:
        if d is not None:
            q = find(texts.index(t or ""))
            least[q] = min(least.get(q, d), d)
    return [(d, least.get(find(texts.index(t or "")))) for d, t in rows]


def edited(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("block", [3, 192])
def test_near_duplicates(llm, odd, none, block, monkeypatch):
    monkeypatch.setattr(ordermin, "BLOCK", block)
    monkeypatch.setattr(ordermin.links_beside_pivots, "__defaults__", (ordermin.SIMILARITY, block))
    rng = random.Random(9)
    rows = []
    for g in range(6):
        original = sentence(rng, 120, 5000)
        rows += [(1000 * g + k, edited(rng, original, rng.randrange(5))) for k in range(25)]
    # Chains: each close to the next only.
    text = sentence(rng, 150, 5000)
    for k in range(12):
        rows.append((9000 + k, text))
        text = edited(rng, text, 2)
    rows += [(None, rows[0][1]), (70, rows[3][1]), (70, rows[3][1]), (80, "short one"), (81, "Short, one!"), (82, None), (83, ""), (84, "...")]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.class_id) for r in ordermin.near_duplicates(docs).collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or 0)
    assert sorted(got, key=order) == sorted(classes_reference(rows), key=order)
    if block == 192:
        kept = [r.doc_id for r in ordermin.keep_one(docs).collect()]
        assert sorted(kept) == sorted({c for _, c in classes_reference(rows)})
        assert ordermin.keep_one(odd).columns == odd.columns and ordermin.keep_one(odd).count() == 4
        assert ordermin.near_duplicates(none).count() == 0 and ordermin.near_duplicates(odd).count() == odd.count()


def test_residual_packing_spreads_repeated_rows(llm):
    """Two thousand equal rows are dealt to many tasks, and the packing stays near a global best fit."""
    rows = [(5, "the same row again and again")] * 2000 + [(k, "one two three " * (k % 90)) for k in range(1000)]
    got = residual.pack_documents(llm.createDataFrame(rows, "doc_id bigint, text string"), public_path(), items_per_task=200).collect()
    assert len(got) == 3000 and sum(r.doc_id == 5 for r in got) == 2001
    first_round = {r.sequence_id >> 32 for r in got if r.sequence_id >> 56 == 1 and r.doc_id == 5}
    assert len(first_round) > 5
    used = Counter()
    for r in got:
        used[r.sequence_id] += r.length
    best = packing.best_fit_decreasing([r.length for r in got], 1024)
    assert max(used.values()) <= 1024 and len(used) <= 1.02 * len(best) + 1


def test_links_beside_pivots_are_few(llm):
    """400 near copies of a pivot that none of them is connected to: a forest, not all pairs; a moved half is no near copy."""
    rng = random.Random(12)
    original = sentence(rng, 200, 5000)
    texts = [original] + [edited(rng, original, 1) for _ in range(400)]
    rows = [(f"h{k}", t) for k, t in enumerate(texts)]
    df = llm.createDataFrame(rows, "h string, text string")
    pairs = llm.createDataFrame([(h, "h0") for h, _ in rows[1:]], "a string, p string")
    roots = llm.createDataFrame([], "id string, root string")
    found = ordermin.links_beside_pivots(pairs, roots, df, block=64).collect()
    # Seven blocks by seven; each pair of blocks returns fewer links than it has texts, where all pairs would be 79 800.
    assert len(found) < 49 * 128
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for r in found:
        parent[find(r.a)] = find(r.b)
    assert len({find(h) for h, _ in rows[1:]}) == 1
    words = original.split(" ")
    x, counts = ordermin.kmers([original, " ".join(words[100:] + words[:100])])
    a, b = np.split(x, np.cumsum(counts)[:-1])
    assert len(np.intersect1d(a, b)) > 0.9 * len(a) and ordermin.similarity(a, b) < 0.8
    assert ordermin.spanning_links([(0, 0)], [a], [b], (["x"], ["y"])) == [] and ordermin.spanning_links([(0, 0)], [a], [a], (["x"], ["x"])) == []


def lcs(a, b):
    p = [0] * (len(b) + 1)
    for x in a:
        q = [0]
        for j, y in enumerate(b):
            q.append(p[j] + 1 if x == y else max(p[j + 1], q[-1]))
        p = q
    return p[-1]


def test_banded_alignment():
    rng = random.Random(10)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(30))]
        b = [x for x in a if rng.random() > 0.1]
        if rng.random() < 0.5:
            b.insert(rng.randint(0, len(b)), 7)
        n, best = ordermin.aligned(np.array(a, np.uint64), np.array(b, np.uint64)), lcs(a, b)
        assert n <= best
        if len(a) + len(b) and best >= 0.8 * (len(a) + len(b) - best):
            assert n == best


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a):
        q = [i + 1]
        for j, y in enumerate(b):
            q.append(min(p[j] + (x != y), p[j + 1] + 1, q[-1] + 1))
        p = q
    return p[-1]


def changed(rng, a, n):
    for _ in range(n):
        i = rng.randint(0, len(a))
        a = a[:i] + rng.choice(["", "q", "z"]) + a[i + rng.randrange(2) :]
    return a


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_line_join(llm, odd, none, edits):
    rng = random.Random(11)
    pool = [sentence(rng, rng.randrange(10, 16)) for _ in range(12)] + ["a common line of text", "tiny"]
    rows = []
    for k in range(40):
        lines = [changed(rng, rng.choice(pool), rng.randrange(3)) if rng.random() < 0.6 else sentence(rng, 12) for _ in range(rng.randrange(1, 5))]
        rows.append((k, "\n".join(lines)))
    rows += [(None, rows[0][1]), (3, rows[3][1]), (50, None), (51, "")]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.n_lines, r.n_removed, r.n_links) for r in linejoin.line_classes(docs, edits=edits).collect()}
    lines = sorted({x.strip() for _, t in rows for x in (t or "").split("\n") if len(x.strip()) >= linejoin.LEAST_CHARS})
    near = [x for x in lines if len(x) >= linejoin.NEAR_CHARS]
    root, degree = {x: x for x in lines}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(near):
        for b in near[:i]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                root[find(a)] = find(b)
                degree[a] += 1
                degree[b] += 1
    first, want = {}, set()
    for d, t in sorted(dict.fromkeys(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        mine = [x.strip() for x in (t or "").split("\n") if len(x.strip()) >= linejoin.LEAST_CHARS]
        removed = sum(first.setdefault(find(x), (d, k)) != (d, k) for k, x in enumerate(mine))
        want.add((d, len(mine), removed, sum(degree[x] for x in mine)))
    # A link counts only in lines of a class with several occurrences, which linked lines always are.
    assert got == want
    if edits == 1:
        assert linejoin.drop_repeated(odd).columns == odd.columns
        assert linejoin.line_classes(none).count() == 0 and linejoin.line_classes(odd).count() == odd.count()


def test_columns_named_like_helpers(llm):
    """Both stages give every column back as it came, whatever it is called."""
    names = ("row", "rest", "gone", "found_id", "found_th", "th", "lines", "copy", "mix_key", "mix_size", "mix_copies", "mix_target", "mix_source_size")
    rows = [(k, f"the very same line of text here\nline number {k} is its own", "en", "a", 50) for k in range(6)] + [(None, None, None, None, None)]
    plain = llm.createDataFrame(rows, DOCS)
    docs = plain.select("*", *(F.concat(F.lit(n), F.coalesce("doc_id", F.lit(-1)).cast("string")).alias(n) for n in names))
    for stage in (linejoin.drop_repeated, mixing.mix):
        got, want = stage(docs), stage(plain)
        assert got.columns == docs.columns
        order = lambda rows: sorted(map(str, rows))
        assert order(got.select(*plain.columns).collect()) == order(want.collect())
        assert all(r[n] == f"{n}{-1 if r.doc_id is None else r.doc_id}" for r in got.collect() for n in names)


def test_drop_repeated(llm):
    rng = random.Random(12)
    shared, own = sentence(rng, 60), [sentence(rng, 60) for _ in range(3)]
    rows = [(1, f"{shared}\n{own[0]}", "en", "a", 5), (2, f"{own[1]}\n{shared}x", "en", "a", 5), (3, shared, "en", "a", 5), (4, own[2], "en", "a", 5), (5, "few words", "en", "a", 5)]
    got = {r.doc_id: (r.text, r.n_chars) for r in linejoin.drop_repeated(llm.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: (rows[0][1], 5), 2: (own[1], len(own[1])), 4: (own[2], 5), 5: ("few words", 5)}


def test_short_rests_and_first_occurrences_stay(llm):
    rng = random.Random(15)
    shared, twice = sentence(rng, 30), sentence(rng, 20)
    rows = [(1, shared), (2, f"{shared}\n{twice}\nfew words of its own"), (3, twice), (4, f"{twice}\nmine alone")]
    got = linejoin.drop_repeated(llm.createDataFrame([(k, t, "en", "a", 5) for k, t in rows], DOCS)).collect()
    assert {r.doc_id: r.text for r in got} == {1: shared, 2: f"{twice}\nfew words of its own", 4: "mine alone"}


def test_short_lines_take_part(llm):
    rows = [(1, "a\nyes\nfourteen chars\n \n"), (2, "a\nyet\nfourteen charz"), (3, "yes\n\nother")]
    got = linejoin.line_classes(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.n_lines, r.n_removed, r.n_links) for r in got} == {(1, 3, 0, 1), (2, 3, 2, 1), (3, 2, 1, 0)}


def test_threshold_grows_with_the_line(llm):
    """One edit for every 40 characters of the shorter line: prose, long words, repeated words and lines about a length where it changes."""
    rng = random.Random(14)
    pool = [sentence(rng, rng.choice([16, 20, 40, 60])) for _ in range(8)] + ["".join(rng.choice("abcdef0123") for _ in range(n)) for n in (79, 120, 240)]
    pool += ["the of " * 30, "a" * 161]
    lines = sorted({changed(rng, x, rng.randrange(9)).strip() for x in pool for _ in range(6)} | {x.strip() for x in pool})
    docs = llm.createDataFrame([(k, x) for k, x in enumerate(lines)], "doc_id bigint, text string")
    want, most = Counter(), 0
    for i, a in enumerate(lines):
        for j, b in enumerate(lines[:i]):
            edits = max(1, min(len(a), len(b)) // 40)
            if min(len(a), len(b)) >= linejoin.NEAR_CHARS and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                want.update((i, j))
                most = max(most, distance(a, b))
    got = {r.doc_id: r.n_links for r in linejoin.line_classes(docs).collect()}
    assert got == {k: want[k] for k in range(len(lines))} and most > 4


def test_only_keys_that_can_meet_are_joined(llm):
    """Lines without a like one send no key to the join, copies send theirs once, and linked lines in different tasks still meet."""
    rng = random.Random(16)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    alone = [" ".join(word() for _ in range(rng.randrange(4, 60))) for _ in range(200)]
    pair = alone[0] + " " + " ".join(word() for _ in range(30))
    lines = [*alone[1:], pair, pair[:50] + "#" + pair[51:]]
    rows = lambda lines: llm.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").repartition(6)

    def keys(lines):
        near = linejoin.eligible(rows(lines)).withColumn("lid", linejoin.line_id(F.col("line")))
        return linejoin.meeting_keys(near)

    found = keys(lines).groupBy("id").count().collect()
    assert len(found) == 2 and keys(lines * 3).count() == sum(r["count"] for r in found)
    assert sum(r.n_links for r in linejoin.line_classes(rows(lines)).collect()) == 2


def test_words_of_many_lines_at_once():
    """Words as by ``split``, alike ones with one hash wherever they stand, others with others."""
    rng = random.Random(23)
    odd = ["", "one", " x\u3000y z ", "\x1c\x1dt\x85u\xa0v", "\u00e9 \U0001f600 \ud800", "a aa aaa a\0 \0a", "ab ba"]
    lines = odd + [sentence(rng, rng.randrange(50), 3000) for _ in range(400)]
    for at in (lines, lines[::-1], odd[1:2], [""], []):
        line, h, size = linejoin._words(at)
        assert list(zip(line.tolist(), size.tolist(), strict=True)) == [(i, len(w)) for i, x in enumerate(at) for w in x.split()]
        words = [w for x in at for w in x.split()]
        assert len({*zip(words, h.tolist(), strict=True)}) == len(set(words)) == len(set(h.tolist()))
    assert linejoin._words(["b a"])[1][1] == linejoin._words(["far from the start a"])[1][4]
    assert len(linejoin._words(["w " * linejoin.CHUNK_CHARS + "of a very long line"])[1]) == linejoin.CHUNK_CHARS + 5


def test_single_lines_are_not_dealt_by_class(llm, monkeypatch):
    """Occurrences of lines that occur once and have no link end where their line is joined; copies of rows count once."""
    rows = [(k, f"a line of document {k} {'x' * k}\nin two\n{sentence(random.Random(k), 9)}") for k in range(30)] + [(1, "a line of document 1 x\nin two\n" + sentence(random.Random(1), 9))]
    seen, plain = {}, linejoin.materialise
    monkeypatch.setattr(linejoin, "materialise", lambda df, name: seen.setdefault(name, plain(df, name)))
    got = linejoin.line_classes(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    linked = {x for r in rows for x in r[1].split("\n")[:1]}
    assert len(got) == 31 and sum(r.n_removed for r in got if r.doc_id != 1) >= 28
    assert 30 <= seen["spots"].count() <= 30 + len(linked)


def test_near_copies_meet_in_blocks(llm):
    """A large group of near copies: cells, not pairs of lines, are rows, and every link is counted."""
    rng = random.Random(18)
    base = sentence(rng, 60).strip()
    lines = sorted({changed(rng, base, rng.randrange(1, 4)) for _ in range(300)})
    docs = llm.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").repartition(4)
    near = linejoin.eligible(docs).withColumn("lid", linejoin.line_id(F.col("line")))
    a, b = np.triu_indices(len(lines), 1)
    edits = np.array([linejoin.allowed(min(len(lines[i]), len(lines[j]))) for i, j in zip(a, b, strict=True)])
    linked = np.array([linejoin.close(lines[i], lines[j], t) for i, j, t in zip(a, b, edits.tolist(), strict=True)])
    found = linejoin.links(near)
    rows, n = found.agg(F.count("*"), F.sum("n")).first()
    assert n == 2 * linked.sum() > 3 * rows
    assert linejoin.meeting_cells(linejoin.meeting_keys(near)).count() < len(a) / 10
    assert {r.n_links for r in linejoin.line_classes(docs).collect()} == set(np.bincount(np.concatenate([a[linked], b[linked]]), minlength=len(lines)).tolist())


def test_edit_distances_side_by_side():
    """Lines of like and of unlike length, of many letters, with few and with very many edits, agree with one pair at a time."""
    rng = random.Random(19)
    for n, letters in ((1, "ab"), (40, "ab c"), (90, "".join(map(chr, range(0x4E00, 0x4E00 + 300)))), (400, "abcdefgh "), (3000, "ab c")):
        bases = ["".join(rng.choice(letters) for _ in range(max(1, n + rng.randrange(-2, 3)))) for _ in range(2)]
        lines = [changed(rng, rng.choice(bases), rng.randrange(max(3, n // 20))) for _ in range(12)]
        a, b = np.triu_indices(len(lines), 1)
        edits = np.array([rng.choice([0, 1, linejoin.allowed(n)]) for _ in a])
        want = [linejoin.close(lines[i], lines[j], t) for i, j, t in zip(a.tolist(), b.tolist(), edits.tolist(), strict=True)]
        assert linejoin.verified(lines, a, b, edits).tolist() == want
        assert linejoin.abreast(*linejoin._codes(lines), a, b, edits).tolist() == want


def test_counts_of_character_pairs_lose_no_pair():
    rng = random.Random(17)
    for _ in range(300):
        a = "".join(rng.choice("ab c") for _ in range(rng.randrange(12, 200)))
        b, t = changed(rng, a, rng.randrange(6)), rng.randrange(7)
        near = distance(a, b) <= t
        assert linejoin.close(a, b, t) == near
        assert not near or linejoin.alike([b, a], [b, b], [0, t]) == [0, 1]
    assert linejoin.alike(["one line of words", "same"], ["other text at all", "same"], [1, 0]) == [1]


def test_edit_distance_and_keys():
    rng = random.Random(13)
    for _ in range(2000):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        b, t = changed(rng, a, rng.randrange(4)), rng.randrange(4)
        near = distance(a, b) <= t
        assert linejoin.within(a, b, t) == near
        if near and min(len(a), len(b)) > t:
            short, long = sorted((a, b), key=len)
            index, probes = linejoin.line_keys(long, t)
            assert {*index, *probes} & {*linejoin.line_keys(short, t)[0]}
            x, y = linejoin.parity_sketches([a, b])
            assert int(x ^ y).bit_count() <= 2 * t


PAGES = [
    ("<p>a</p>", "a"),
    ("", ""),
    (None, ""),
    ("<nav><a href=x>menu</a></nav><article><h1>T &amp; t</h1><p>one  two\n three<p>four&nbsp;five<b>six</b></article><footer>no</footer>", "T & t\none two three\nfour fivesix"),
    ("<script>var a='<p>no</p>'</script><!-- no --><div class='ad'>no</div><p>yes<style>p{}</style></p><form>no<input></form>", "yes"),
    ("<div class='has-sidebar'><div id='sideBar'>kept</div><div id='side_bar sidebar'>no</div><p>yes</p></div>", "kept\nyes"),
    ("<article><p>1 < 2 &lt; 3</p><section class='user-comments'><p>no</p></section><aside>no</aside></article>", "1 < 2 < 3"),
    ("<ul><li><a href=x>m1</a><li><a href=y>m2</a></ul><p>text that is long enough</p>", "text that is long enough"),
]


def test_main_text(llm):
    for page, want in PAGES:
        assert html.main_text(page) == want
    rows = [(k, None if k == 2 else "u", p) for k, (p, _) in enumerate(PAGES)] + [(0, "u", PAGES[0][0]), (None, None, "<p>x</p>")]
    pages = llm.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in html.extract(pages).collect())
    assert got == sorted((str(i), html.main_text(p), len(html.main_text(p))) for i, _, p in rows)
    assert html.extract(pages.limit(0)).count() == 0


def test_article_lines_between_stripped_parts_stay():
    advert, long = "<div class='share'>no</div>", "long text " * 80
    page = f"<article><h1>Title</h1>{advert}<p>{long}</p><h2>Part</h2>{advert}<p>{long}</p>{advert}<p>End.</p></article><p>{long}"
    assert html.main_text(page).split("\n") == ["Title", long.strip(), "Part", long.strip(), "End."]


def test_surge_and_dive():
    assert html.window_sums([5, 0, 0, 0, 7, 3], 3) == [5, 0, 7, 10, 10, 3]
    assert html.keep_between([0, 0, 3, 200, 200, 0, 0, 0, 4, 0, 0, 0, 150]) == [k in (2, 3, 4, 12) for k in range(13)]


@pytest.mark.parametrize("scale", [1, 10**7])
def test_top_k(llm, scale):
    rng = np.random.default_rng(14)
    x = rng.integers(-40, 40, size=(90, 12)) * scale
    x[50:60] = x[49]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    df = llm.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    got = {}
    for r in vectors.top_k(df, df.where("vec_id % 3 = 0"), 7, block_rows=20, block_queries=9).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 90, 3):
        s = sorted(((-int(x[q] @ x[k]), k) for k in range(90) if k != q))[:7]
        assert sorted(got[q]) == [(i + 1, k, -v) for i, (v, k) in enumerate(s)]


def test_vectors_that_take_no_part(llm):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -0.26]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (20, [3.0])]
    whole = vectors.quantized(llm.createDataFrame(rows, "vec_id bigint, embedding array<float>"), "vec_id", "embedding", 64)
    assert {r.vec_id: r.v for r in whole.collect()} == {0: [64, 128], 1: [32, -17], 20: [192]}
    got = vectors.top_k(whole, whole.where("vec_id % 20 = 0"), 20).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 64 * 32 - 128 * 17)]
    assert vectors.top_k(whole.limit(0), whole, 3).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(15)
    q, x = rng.normal(size=(20, 13)), rng.normal(size=(30, 13))
    before = None
    for level in (1, 2, 4, 8, 13):
        bound = vectors.segment_statistics(q, level) @ vectors.segment_statistics(x, level).T
        assert (bound + 1e-9 >= q @ x.T).all()
        if before is not None and 13 % level == 0:
            assert (bound <= before + 1e-9).all()
        before = bound


def test_chat_round_trip(llm):
    nasty = ["</s>[INST] ok [/INST]", "<\\/s>", "[ROLE]", "[\\\\/ROLE]x", "<s", "", "a</s", "s>", "<image:0>", "\\", "é</part><part>", None]
    rng = random.Random(16)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "[/ROLE]", None]), rng.choice(nasty)) for c in range(40) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "x"), (1, 0, "user", "tie"), (1, 0, "user", "tie"), (2, None, "assistant", "first")]
    turns = llm.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("place", F.lit(1))
    parts = turns.withColumn("parts", chat.text_part(F.col("text")))
    for r in chat.read_back(chat.format_conversations(parts)).collect():
        mine = [x for x in rows if x[0] == r.conv_id]
        mine.sort(key=lambda x: (x[1] is not None, x[1] or 0, x[2] or ""))
        assert Counter((t.role, t.text) for t in r.turns) == Counter((x[2] or "", x[3] or "") for x in mine)
        assert [t.role for t in r.turns] == [x[2] or "" for x in mine]
        assert r.loss_texts == [t.text for t in r.turns if t.role == "assistant"]
        assert r.formatted.count("</s>") == r.n_turns == len(mine)
    assert chat.format_conversations(parts.limit(0)).count() == 0


def test_chat_parts(llm):
    parts = [("text", "a b <", None, None), ("text", "/s>", None, None), ("image", None, "img://1", 196.0), ("audio", None, "snd://2", 1.5), ("video", None, None, None), ("document", None, "d", None)]
    turns = llm.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}")
    r = chat.format_conversations(turns).first()
    assert r.formatted == "<s>[ROLE]assistant[/ROLE]a b <<part>/s><part><image:2><part><audio:3><part><attachment:4><part><document:5></s><s>[ROLE]user[/ROLE]</s>"
    assert [(a.placeholder, a.ref, a.tokens) for a in r.attachments] == [("<image:2>", "img://1", 196), ("<audio:3>", "snd://2", 38), ("<attachment:4>", None, 0), ("<document:5>", "d", 0)]
    assert r.n_tokens == 3 + 1 + 196 + 38
    assert hashlib.sha256(b"").hexdigest()


def test_native_plans(llm, sf):
    from litpulse.llm.queries import QUERIES

    for name in ("op3_quality_rules", "op7_source_mix", "op9_chat_format"):
        plan = QUERIES[name](llm, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
