"""Conversation repair against trying every edit, and the odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from litpulse.llm import repair
from tests.llm.test_operators import llm  # noqa: F401

TURNS = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        chars = BLANK.findall(text)
        out.append(1 if not chars else 2 if (role, text) in seen else 3 if chars[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def every_repair(rows):
    """The least (cost, audit) over all edits with at most two rows inserted at a place."""
    put = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
    names = {"u": "user", "a": "assistant"}
    best = None
    each = []
    for (_, role, text), fault in zip(rows, faults(rows), strict=True):
        ways = [(2, "D", [])]
        if fault in (0, 3):
            more = 5 if fault == 3 else 0
            ways += [(more, "K", [(role, text)]), (1 + more, "R", [("user", text)]), (1 + more, "R", [("assistant", text)])]
        each.append(ways)
    gaps = [[(5 * len(p), "I" * len(p), [(names[x], "") for x in p]) for p in put]] * (len(rows) + 1)
    steps = [x for pair in itertools.zip_longest(gaps, each) for x in pair if x is not None]
    for way in itertools.product(*steps):
        cost = sum(w[0] for w in way)
        if best and cost > best[0]:
            continue
        out = [x for w in way for x in w[2]]
        if GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in out)):
            found = (cost, "".join(w[1] for w in way), out)
            if best is None or found[:2] < best[:2]:
                best = found
    return best


def expected(turns):
    """By plain Python: the report and digest of every conversation."""
    convs = {}
    for conv, turn, role, text in turns:
        convs.setdefault(conv, []).append((turn, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        cost, audit, fixed = every_repair(rows)
        bad, known = faults(rows), [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[conv] = (gaps, bad.count(1), bad.count(2), bad.count(3), illegal, cost, audit, digest)
    return out


def found(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def random_turns(rng, convs, most):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["yes.", "no", " \n", "", None, "what?", "well,\t", "so!"]
    return [
        (conv, turn if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts))
        for conv in range(convs)
        for turn in sorted(rng.randrange(9) for _ in range(rng.randrange(1, most + 1)))
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_edit(llm, seed):  # noqa: F811
    rng = random.Random(seed)
    turns = random_turns(rng, 60, 3) + [(None, 1, "user", "a."), (None, 2, None, None)]
    df = llm.createDataFrame(turns * 1, TURNS)
    assert found(repair.digests(repair.repair(df))) == expected(turns)


def test_long_against_a_table():
    """Longer signatures: the shared path gives what a path of its own gives, whatever came before."""
    rng = random.Random(3)
    endings = sorted({"".join(rng.choice("xsuaoSUAO" if rng.random() < 0.3 else "ua") for _ in range(rng.randrange(0, 60))) for _ in range(500)})
    shared = repair.Path()
    for e in endings:
        assert shared.ask(e) == repair.Path().ask(e)
    # Far fewer combinations are worked out than there are nodes.
    assert len(shared.steps.known) < 300 < sum(map(len, endings))
    assert repair.Path().ask("")[0] == 0 and repair.Path().ask("au") == (0, "KK") and repair.Path().ask("aus") == (0, "KKK")
    assert [repair.common_length(a, b) for a, b in (("", "x"), ("ab", "abc"), ("abd", "abc"), ("b", "a"))] == [0, 2, 2, 0]


def test_damage(llm):  # noqa: F811
    turns = [(c, t, r, x) for c in range(40) for t, r, x in ((0, "user", "Is it. so?"), (1, None, "Yes!"), (None, "system", None))]
    got = sorted((tuple(r) for r in repair.damage(llm.createDataFrame(turns, TURNS)).collect()), key=str)
    want = []
    for c, t, r, x in turns:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        r, x = r if r is not None else " ", x if x is not None else " "
        if kind == 0:
            continue
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    assert got == sorted(want, key=str)


def test_odd_rows(llm):  # noqa: F811
    empty = llm.createDataFrame([], TURNS)
    assert repair.digests(repair.repair(empty)).count() == 0
    ids = llm.createDataFrame([(7,), (None,), (7,)], "conv_id bigint")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(repair.digests(repair.repair(empty, ids))) == {7: nothing, None: nothing}
    # Extra columns that clash with helpers, a very long text, rows that repeat.
    long = "long words " * 200_000 + "end."
    turns = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 1, "assistant", long), (2, None, None, None), (2, None, "user", "ok.")]
    df = llm.createDataFrame(turns, TURNS)
    for name in ("head", "letter", "fault", "cost", "audit", "place", "blank", "seen", "row"):
        df = df.selectExpr("*", f"'x' AS {name}")
    assert found(repair.digests(repair.repair(df))) == expected(turns)


def test_one_hot_conversation(llm):  # noqa: F811
    """A third of all rows in one conversation, streamed in batches; its rows come out in order."""
    rng = random.Random(4)
    hot = [(5, k, "user" if k % 2 == 0 else "assistant", f"text {k}.") for k in range(9000)]
    rest = [(10 + k // 4, k % 4, rng.choice(["user", "assistant"]), f"t{k}.") for k in range(18000)]
    out = repair.repair(llm.createDataFrame(hot + rest, TURNS)).where("conv_id = 5").collect()
    assert out[0].place == 0 and out[0].cost == 0 and out[0].audit == "K" * 9000
    assert [r.turn for r in out[1:]] == list(range(9000))
