import datetime as dt

import pytest
from pyspark.sql import functions as F

from litpulse.operators import ledger
from litpulse.plans import queues
from litpulse.schemas import EDGES, PAPERS, REPO_TASKS, REPOS

D = dt.date
OCT = [(D(2026, 10, 1), "completed"), (D(2026, 10, 3), "running"), (D(2026, 10, 5), "failed")]


def pick(df):
    return df.first()[0]


@pytest.mark.parametrize(
    "states, target, expected",
    [
        (OCT, D(2026, 10, 10), D(2026, 10, 3)),
        ([r for r in OCT if r[1] != "running"], D(2026, 10, 10), D(2026, 10, 5)),
        (OCT[:1], D(2026, 10, 10), D(2026, 10, 2)),
        (OCT[:1], D(2026, 10, 1), None),
        ([], D(2026, 10, 10), None),
    ],
)
def test_next_day(rows, states, target, expected):
    assert pick(ledger.next_day(rows(states, "pull_date date, status string"), "pull_date", target)) == expected


@pytest.mark.parametrize(
    "states, target, expected",
    [
        ([(D(2026, 10, 1), 23, "completed")], D(2026, 10, 2), (D(2026, 10, 2), 0)),
        ([(D(2026, 10, 1), 23, "completed")], D(2026, 10, 1), (None, None)),
        ([(D(2026, 10, 1), 4, "completed")], D(2026, 9, 1), (D(2026, 10, 1), 5)),
        ([(D(2026, 10, 1), 9, "failed"), (D(2026, 10, 1), 8, "running")], D(2026, 10, 1), (D(2026, 10, 1), 8)),
        ([], D(2026, 10, 1), (None, None)),
    ],
)
def test_next_hour(rows, states, target, expected):
    df = rows(states, "task_date date, task_hour int, status string")
    assert tuple(ledger.next_hour(df, target).first()) == expected


def test_next_snapshot(rows):
    ddl = "snapshot_date date, status string"
    assert pick(ledger.next_snapshot(rows(OCT, ddl), D(2026, 10, 9))) == D(2026, 10, 3)
    assert pick(ledger.next_snapshot(rows(OCT[2:], ddl), D(2026, 10, 9))) == D(2026, 10, 5)
    assert pick(ledger.next_snapshot(rows(OCT[:1], ddl), D(2026, 10, 9))) == D(2026, 10, 9)
    assert pick(ledger.next_snapshot(rows(OCT[:1], ddl), D(2026, 10, 1))) is None
    assert pick(ledger.next_snapshot(rows([], ddl), D(2026, 10, 1))) == D(2026, 10, 1)


def test_anchors(rows):
    ddl = "task_date date, status string"
    assert pick(ledger.day_anchor(rows([(D(2026, 10, 3), "completed")], ddl), D(2026, 10, 5))) == D(2026, 10, 4)
    assert pick(ledger.day_anchor(rows([(D(2026, 10, 5), "completed")], ddl), D(2026, 10, 5))) is None
    rounds = "round_number int, snapshot_at date, status string"
    now = F.lit(D(2026, 12, 1))
    got = ledger.round_anchor(rows([(1, D(2026, 1, 1), "completed"), (2, D(2026, 2, 1), "running")], rounds), now)
    assert tuple(got.first()) == (2, D(2026, 2, 1), False)
    got = ledger.round_anchor(rows([(1, D(2026, 1, 1), "completed")], rounds), now)
    assert tuple(got.first()) == (2, D(2026, 12, 1), True)
    assert tuple(ledger.round_anchor(rows([], rounds), now).first()) == (1, D(2026, 12, 1), True)


def task(id_, status="running", tries=0, lane="p0", day=D(2000, 1, 1), rnd=0, repo=1, scan_to=D(2000, 1, 1), progress=None):
    return (id_, lane, day, rnd, repo, "o/r", day, scan_to, progress or {}, status, tries, None)


def test_queue_order(rows):
    df = rows([task(1, "failed", 3), task(2, "running", 0), task(3, "failed", 1), task(4, "failed", 2), task(5, "completed")], REPO_TASKS)
    assert [r.id for r in ledger.eligible_tasks(df).collect()] == [2, 3, 4]
    assert [r.id for r in ledger.eligible_tasks(df, 1).collect()] == [2]


def fold(rows, start, *outcomes):
    df = rows([start], REPO_TASKS)
    batch = rows([(start[0], i, k, "e" * 600) for i, k in enumerate(outcomes)], "id bigint, seq int, kind string, error string")
    r = ledger.fold_outcomes(df, batch).first()
    return r.status, r.try_number, len(r.error_msg or "")


def test_outcomes(rows):
    assert fold(rows, task(1), "transient", "transient", "transient") == ("failed", 3, 500)
    assert fold(rows, task(1), "transient") == ("running", 1, 500)
    assert fold(rows, task(1), "rate_limit", "rate_limit") == ("running", 0, 0)
    assert fold(rows, task(1), "not_found") == ("failed", 1, 500)
    assert fold(rows, task(1), "transient", "completed") == ("completed", 1, 500)
    assert fold(rows, task(1, "failed", 2), "transient") == ("failed", 3, 500)


def test_pending_metrics(rows):
    progress = {"star": (True, None, None), "fork": (False, 4, "c")}
    got = ledger.pending_metrics(rows([task(1, progress=progress)], REPO_TASKS)).collect()
    assert [(r.metric, r.page, r.cursor) for r in got] == [("fork", 4, "c"), ("issue", 1, None), ("pr", 1, None)]


RUNS = "job string, status string, started_at date, completed_at date, row_counts map<string,bigint>, error_message string"
RUN_EVENTS = "job string, seq int, status string, at date, row_counts map<string,bigint>, error string"


def runs(rows, rules, stored, *events):
    got = ledger.apply_run_events(rows(stored, RUNS), rows(list(events), RUN_EVENTS), ["job"], rules).collect()
    return {r.job: tuple(r)[1:] for r in got}


@pytest.mark.parametrize("rules", [ledger.PULL_LOG, ledger.RANK_LOG, ledger.CITATION_TASKS])
def test_run_events(rows, rules):
    stored = [("a", "failed", D(2026, 1, 1), None, None, "old"), ("b", "running", D(2026, 1, 1), None, None, None)]
    got = runs(
        rows, rules, stored,
        ("a", 1, "running", D(2026, 2, 1), None, None),
        ("a", 2, "completed", D(2026, 2, 2), {"x": 5}, None),
        ("c", 1, "failed", D(2026, 3, 1), None, "y" * 3000),
    )
    assert got["a"] == ("completed", D(2026, 2, 1), D(2026, 2, 2), {"x": 5}, None)
    assert got["b"] == ("running", D(2026, 1, 1), None, None, None)
    # The first says when an unknown run failed, the second does not, the third knows its tasks beforehand.
    first = D(2026, 3, 1) if rules is ledger.PULL_LOG else None
    assert got.get("c") == (None if rules is ledger.CITATION_TASKS else ("failed", first, None, None, "y" * 500))


def test_run_events_keep_what_the_ledger_keeps(rows):
    end, counts = D(2026, 1, 2), {"x": 1}
    stored = [(j, "completed", D(2026, 1, 1), end, counts, None) for j in "ab"]
    batch = [("a", 1, "running", D(2026, 2, 1), None, None), ("b", 1, "failed", D(2026, 2, 1), None, "y" * 3000)]
    for rules in (ledger.PULL_LOG, ledger.RANK_LOG):
        got = runs(rows, rules, stored, *batch)
        assert got["a"] == ("running", D(2026, 2, 1), end, counts, None)
        assert got["b"] == ("failed", D(2026, 1, 1), end, counts, "y" * 500)
    got = runs(rows, ledger.CITATION_TASKS, stored, *batch)
    assert got["a"] == ("running", D(2026, 2, 1), None, None, None)
    assert got["b"] == ("failed", D(2026, 1, 1), None, counts, "y" * 2000)
    # Within one batch: completed, then failed.
    got = runs(rows, ledger.RANK_LOG, [], ("d", 1, "completed", end, counts, None), ("d", 2, "failed", D(2026, 2, 1), None, "e"))
    assert got["d"] == ("failed", None, end, counts, "e")


def test_baseline(rows):
    ddl = "task_date date, status string"
    base = rows([(D(2026, 6, 16), "completed")], ddl)
    assert ledger.with_baseline(rows([], ddl), base).count() == 1
    assert ledger.with_baseline(rows(OCT, ddl), base).count() == 3
    assert ledger.with_baseline_key(rows(OCT, ddl), base, ["task_date"]).count() == 4
    assert ledger.with_baseline_key(base, base, ["task_date"]).count() == 1


def paper(pid, day):
    return (pid, "t", None, None, None, [], *[None] * 6, [], day, None, None)


def test_recent_queue(rows):
    day = D(2000, 1, 1)
    repos = rows(
        [(1, "o/1", "o", "1", D(1999, 12, 1)), (2, "o/2", "o", "2", D(1999, 12, 2)), (3, "o/3", "o", "3", D(2026, 1, 1)),
         (4, "o/4", "o", "4", D(1999, 12, 3)), (5, "o/5", "o", "5", None), (6, "o/6", "o", "6", D(1999, 12, 4))],
        REPOS,
    )
    edges = rows([(i, "p", True, day) for i in (1, 3, 4, 5, 6)] + [(2, "p", False, day), (2, "old", True, day)], EDGES)
    papers = rows([paper("p", "1999-12-25T00:00:00+00:00"), paper("old", "1999-12-17")], PAPERS)
    tasks = rows([task(1, "failed", 1, "p2", D(1999, 12, 2), repo=4), task(2, "completed", lane="p0", day=D(1999, 12, 30), repo=6, scan_to=D(1999, 12, 30))], REPO_TASKS)
    got = queues.recent_queue(repos, edges, papers, tasks, day).collect()
    assert [(r.repo_id, r.scan_start, r.scan_to) for r in got] == [(6, D(1999, 12, 31), day), (1, D(1999, 12, 1), day)]
    assert [r.repo_id for r in queues.recent_queue(repos, edges, papers, tasks, day, limit=1).collect()] == [6]
    # The window has both ends: fifteen days.
    papers = rows([paper("p", "1999-12-18")], PAPERS)
    assert queues.recent_queue(repos, edges, papers, tasks, day).count() == 2
    queued = tasks.unionByName(rows([task(9, "running", repo=1, day=day)], REPO_TASKS))
    assert [r.repo_id for r in queues.recent_queue(repos, edges, papers, queued, day).collect()] == [6]


def test_round_queue(rows):
    snap = D(2000, 1, 1)
    repos = rows([(1, "o/1", "o", "1", D(2026, 1, 1)), (2, "o/2", "o", "2", D(2027, 1, 1))], REPOS)
    assert queues.round_queue(repos, rows([], REPO_TASKS), 1, snap).count() == 0
    repos = rows(
        [(1, "o/1", "o", "1", None), (2, "o/2", "o", "2", D(1999, 1, 1)), (3, "o/3", "o", "3", D(1999, 5, 1)), (4, "o/4", "o", "4", D(1999, 6, 1))],
        REPOS,
    )
    tasks = rows(
        [task(1, "completed", lane="p2", repo=2, scan_to=D(1999, 7, 1)), task(2, "completed", lane="p2", repo=4, scan_to=snap)],
        REPO_TASKS,
    )
    got = queues.round_queue(repos, tasks, 1, snap).collect()
    # Never scanned first (newest of them ahead, unknown age last); scanned up to the snapshot: not at all.
    assert [(r.repo_id, r.scan_start) for r in got] == [(3, D(1999, 5, 1)), (1, snap), (2, D(1999, 7, 2))]
