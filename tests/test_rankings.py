"""Rankings against plain Python over a small, heavily skewed fixture."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from litpulse.operators import quality
from litpulse.operators.intervals import join_spans, top_in_spans
from litpulse.operators.ranks import numbered
from litpulse.plans import activity, citations, reader, snapshots
from litpulse.schemas import EDGES, EVENTS, METRICS, PAPERS, REPOS, WORKS
from litpulse.session import materialise
from litpulse.sources.publishing import Publication

SNAP = dt.date(2012, 3, 31)
FIRST = 2009
EVENT_COLS = "repo_id bigint, metric string, date date, count bigint"


@pytest.fixture(scope="module")
def world(spark):
    """Repository 1 has a third of all events and edges, paper p1 a third of all edges."""
    rnd = random.Random(7)
    papers = [f"p{i}" for i in range(1, 41)]
    published = {
        p: (SNAP - dt.timedelta(days=rnd.randrange(0, 1500))).isoformat() + "T00:00:00+00:00" for p in papers
    }
    published["p2"], published["p3"], published["p4"] = None, "2012-3-30", "2012-04-05T00:00:00+00:00"
    published["p5"] = (SNAP - dt.timedelta(days=13)).isoformat()
    published["p6"] = (SNAP - dt.timedelta(days=14)).isoformat()
    edges = set()
    for i in range(60):
        edges.add((1, papers[i % 40]))
        edges.add((2 + i, "p1"))
        edges.add((rnd.randrange(1, 80), rnd.choice([*papers, "ghost"])))
    edges = sorted(edges) + [(1, "p1")]  # one repeated edge
    events = {}
    for _ in range(900):
        repo = 1 if rnd.random() < 0.35 else rnd.randrange(2, 80)
        day = SNAP + dt.timedelta(days=rnd.randrange(-1500, 5))
        events[(repo, rnd.choice(METRICS), day)] = rnd.randrange(1, 6)
    frames = {
        "events": spark.createDataFrame([(r, m, d, c) for (r, m, d), c in events.items()], EVENTS),
        "edges": spark.createDataFrame([(r, p, True, SNAP) for r, p in edges], EDGES),
        "papers": spark.createDataFrame(
            [(p, None if p == "p9" else f"title {p[-1]}", "a", "b", "c", [], *[None] * 6, [], d, None, None) for p, d in published.items()],
            PAPERS,
        ),
        "repos": spark.createDataFrame([(r, f"o/{r}", "o", str(r), SNAP) for r in range(1, 70)], REPOS),
    }
    return frames, events, edges, published


def expected_ranking(events, edges, published, k):
    def total(lower, upper):
        sums = defaultdict(int)
        for (r, m, d), c in events.items():
            if (lower is None or d >= lower) and (upper is None or d <= upper):
                sums[r, m] += c
        return sums

    day = dt.timedelta(days=1)
    windows = {n: (SNAP - (d - 1) * day, None) for n, d in activity.ROLLING_DAYS.items()}
    windows |= {"year_ytd": (dt.date(SNAP.year, 1, 1), None), "total": (None, None)}
    windows |= {f"year_{y}": (None, dt.date(y, 12, 31)) for y in range(FIRST, SNAP.year)}
    values = defaultdict(int)
    for name, (lower, upper) in windows.items():
        sums = total(lower, upper)
        for r, p in edges:
            for m in METRICS:
                values[name, m, p] = max(values[name, m, p], sums.get((r, m), 0))
    strict = {p: d for p, d in published.items() if d and len(d) >= 10 and d[:10] >= (SNAP - 13 * day).isoformat()}
    for p in strict:
        for m in METRICS:
            values["d14", m, p] = values["total", m, p]
    lists = defaultdict(list)
    for (name, m, p), v in values.items():
        if v > 0:
            lists[name, m].append((-v, p))
    return {
        (name, m, i, p, -v)
        for (name, m), rows in lists.items()
        for i, (v, p) in enumerate(sorted(rows)[:k], start=1)
        if p in published
    }


@pytest.mark.parametrize("k", [5, 500])
def test_activity_ranking(world, k):
    frames, events, edges, published = world
    got = activity.activity_ranking(
        frames["events"], frames["edges"], frames["papers"], SNAP, k=k, first_year=FIRST
    )
    rows = {(r.window_name, r.metric, r.rank, r.arxiv_id, r.metric_value) for r in got.collect()}
    assert rows == expected_ranking(events, edges, published, k)


def test_no_years_before_first(world):
    frames = world[0]
    names = [w.name for w in activity.activity_windows(SNAP, first_year=SNAP.year)]
    assert names == ["rolling_7d", "rolling_30d", "rolling_3m", "rolling_6m", "year_ytd", "total"]
    got = activity.activity_ranking(frames["events"], frames["edges"], frames["papers"], SNAP, first_year=2020)
    assert not [r for r in got.select("window_name").distinct().collect() if r[0] in ("year_2010",)]


def test_snapshot_build(spark, world, tmp_path):
    frames, events, edges, published = world
    args = (frames["events"], frames["edges"], frames["papers"], frames["repos"], SNAP, str(tmp_path))
    counts = {r.table_name: r.n_rows for r in snapshots.build_activity_snapshot(*args, k=10, first_year=FIRST).collect()}
    again = {r.table_name: r.n_rows for r in snapshots.build_activity_snapshot(*args, k=10, first_year=FIRST).collect()}
    assert counts == again and all(counts.values())

    def stored(name):
        return Publication(spark, str(tmp_path)).read(name)

    ranking, details = stored("ranking"), stored("paper_details")
    assert quality.ranking_violations(ranking).where("violations > 0").count() == 0
    totals = defaultdict(int)
    for (r, m, _), c in events.items():
        totals[r, m] += c
    by_paper = defaultdict(set)
    for r, p in edges:
        by_paper[p].add(r)
    for row in details.collect():
        linked = by_paper[row.arxiv_id]
        stars = {r: totals[r, "star"] for r in linked}
        assert row.repo_count == len(linked)
        assert (row.star_max, row.star_sum) == (max(stars.values()), sum(stars.values()))
        assert [x.repo_id for x in row.linked_repos] == sorted(linked, key=lambda r: (-stars[r], r))
        assert row.repo_chunks == 1
    # With short chunks a row holds the first one, and the chunks together the list.
    short = activity.paper_details(ranking, stored("paper_linked_repos"), frames["papers"], SNAP, 10_000, size=3)
    row, n = short.where("arxiv_id = 'p1'").first(), len(by_paper["p1"])
    assert len(row.linked_repos) == 3 and row.repo_count == n and row.repo_chunks == -(-n // 3)
    chunks = activity.paper_repo_chunks(stored("paper_linked_repos"), 3).where("arxiv_id = 'p1'").orderBy("chunk").collect()
    assert [c.chunk for c in chunks] == list(range(row.repo_chunks)) and all(len(c.linked_repos) == 3 for c in chunks[:-1])
    assert [r.repo_id for c in chunks for r in c.linked_repos] == [r.repo_id for r in details.where("arxiv_id = 'p1'").first().linked_repos]
    assert stored("paper_repo_chunks").count() == details.where("repo_count > 0").count()
    repo = stored("repo_details").where("repo_id = 1").first()
    assert repo.linked_papers == sorted(repo.linked_papers, key=lambda x: (x.title is None, x.title or "", x.arxiv_id))
    assert repo.full_name == "o/1" and repo.star_total == totals[1, "star"]


def test_failed_snapshot_keeps_the_last_one(spark, world, tmp_path):
    frames = world[0]
    tables = ("repo_activity", "ranking", "bridge", "paper_linked_repos", "paper_details", "repo_details")

    def build(events, edges):
        snapshots.build_activity_snapshot(events, edges, frames["papers"], frames["repos"], SNAP, str(tmp_path), k=5, first_year=FIRST)
        return {t: Publication(spark, str(tmp_path)).read(t).count() for t in tables}

    with pytest.raises(ValueError, match="repo_activity"):
        build(frames["events"].limit(0), frames["edges"])
    assert not any(tmp_path.iterdir())
    good = build(frames["events"], frames["edges"])
    for events, edges, name in ((frames["events"].limit(0), frames["edges"], "repo_activity"), (frames["events"], frames["edges"].limit(0), "ranking")):
        with pytest.raises(ValueError, match=name):
            build(events, edges)
        assert {t: Publication(spark, str(tmp_path)).read(t).count() for t in tables} == good
    # A rerun with fewer rows replaces every table.
    fewer = build(frames["events"], frames["edges"].where("repo_id = 1"))
    assert all(fewer[t] < good[t] for t in ("bridge", "paper_linked_repos", "repo_details"))


def test_packed_rows_give_the_activity_of_every_paper(spark, rows):
    rnd = random.Random(8)
    metrics = ("star", "fork", "issue", "pr", "other", None)
    events = [(r, m, SNAP - dt.timedelta(days=rnd.randrange(4000)), rnd.choice((1, 7, -3, 40_000, 2**40, None))) for r in range(40) for m in metrics if rnd.random() < 0.6 for _ in range(3)]
    pairs = [(rnd.randrange(45), f"p{rnd.randrange(30)}", True, SNAP) for _ in range(300)] + [(5, None, True, SNAP), (None, "p1", True, SNAP)]
    pairs += [(r, "much", True, SNAP) for r in range(40)] * 3
    per_repo, edges = activity.repo_activity(rows(events, EVENT_COLS), SNAP, FIRST), rows(pairs, EDGES)
    order = lambda df: sorted(map(str, df.collect()))
    want = order(activity.linked_activity(edges, per_repo))
    for hot_links in (1, 100, 100_000):
        assert order(activity.paper_activity(edges, per_repo, hot_links)) == want
    halves = per_repo.withColumn("total", F.col("total") / 2)
    assert order(activity.paper_activity(edges, halves)) == order(activity.linked_activity(edges, halves))
    # Small values travel in two bytes, the others whole; a repository has one row of each.
    packed = activity.packed_activity(per_repo)
    kinds = {(r.repo_id, r.small is None, r.large is None) for r in packed.collect()}
    assert len(kinds) == packed.count() < per_repo.count() and {k[1:] for k in kinds} == {(True, False), (False, True)}
    assert "array<smallint>" in dict(packed.dtypes).values()


def test_papers_without_activity_keep_zeros(rows, world):
    edges = rows([(1, "a", True, SNAP), (2, "b", True, SNAP), (3, "c", True, SNAP)], EDGES)
    events = rows([(1, "star", SNAP, 4), (3, "pr", SNAP, 1)], EVENT_COLS)
    per_repo = activity.repo_activity(events, SNAP, FIRST)
    by_paper = activity.paper_activity(edges, per_repo)
    recent = rows([("a",), ("b",), ("unlinked",)], "arxiv_id string")
    got = {r.arxiv_id: (r.star, r.fork, r.issue, r.pr) for r in activity.recent_totals(per_repo, edges, recent).collect()}
    assert got == {"a": (4, 0, 0, 0), "b": (0, 0, 0, 0)}
    wide = {r.arxiv_id: r for r in activity.paper_activity_wide(by_paper).collect()}
    assert set(wide) == {"a", "c"} and len(wide["a"]) == 25
    assert (wide["a"].rolling_7d_star, wide["a"].total_pr, wide["c"].year_ytd_pr, wide["c"].total_star) == (4, 0, 1, 0)


# Citations.

AS_OF = dt.date(2012, 5, 31)


@pytest.fixture(scope="module")
def cited(spark):
    rnd = random.Random(3)
    works, papers = [], []
    for i in range(200):
        day = AS_OF - dt.timedelta(days=rnd.randrange(-20, 1400))
        papers.append((f"p{i}", f"t{i}", day.isoformat() + "T01:00:00+00:00"))
        for j in range(1 + (i % 3)):
            flags = rnd.choice([(None, None), (False, False), (True, None), (None, True), (None, None)])
            works.append((f"w{i}-{j}", f"p{i}", rnd.randrange(0, 30), *flags))
    works += [("wx", None, 9, None, None), ("wy", "  ", 9, None, None), ("wz", "unknown", 9, None, None)]
    papers += [("p0", "later", "2012-05-30"), ("p1", "undated", None), ("bad", "bad", "2012-02-30")]
    w = spark.createDataFrame(
        [(a, b, c, 1, AS_OF, 2012, True, "gold", "article", "en", 2, "n", "f", "d", x, y) for a, b, c, x, y in works], WORKS
    )
    p = spark.createDataFrame([(a, t, "abs", "au", "c", [], *[None] * 6, [], d, None, None) for a, t, d in papers], PAPERS)
    return w, p, works, papers


def expected_citations(works, papers, k):
    best, first = {}, {}
    for wid, pid, n, retracted, paratext in works:
        if pid and pid.strip() and n > 0 and not retracted and not paratext:
            best[pid] = min(best.get(pid, (0, "~")), (-n, wid))
    for pid, title, text in papers:
        if text is not None and (pid not in first or text < first[pid][0]):
            first[pid] = (text, title)
    found = []
    for pid, (n, _) in best.items():
        if pid in first:
            day = dt.date.fromisoformat(first[pid][0][:10]) if first[pid][0][:10] != "2012-02-30" else None
            if day and day <= AS_OF:
                found.append((n, pid, day))
    windows = {
        "recent_3m": (dt.date(2012, 3, 1), AS_OF), "recent_6m": (dt.date(2011, 12, 1), AS_OF),
        "recent_12m": (dt.date(2011, 6, 1), AS_OF), "year_ytd": (dt.date(2012, 1, 1), AS_OF),
        "total": (min(d for *_, d in found), AS_OF),
    }
    for y in range(min(d for *_, d in found).year, 2012):
        windows[f"year_{y}"] = (dt.date(y, 1, 1), dt.date(y, 12, 31))
    rows = set()
    for name, (a, b) in windows.items():
        inside = sorted((n, p) for n, p, d in found if a <= d <= b)
        rows |= {(name, i, p, first[p][1], -n) for i, (n, p) in enumerate(inside[:k], start=1)}
    return rows, windows


@pytest.mark.parametrize("k", [7, 500])
def test_citation_ranking(cited, k):
    w, p, works, papers = cited
    expected, windows = expected_citations(works, papers, k)
    got = citations.citation_ranking(w, p, AS_OF, k).collect()
    assert {(r.window_name, r.rank, r.arxiv_id, r.title, r.cited_by_count) for r in got} == expected
    found = citations.citation_candidates(w, p, AS_OF)
    table = citations.citation_windows(found, AS_OF)
    assert {r.window_name: (r.start_date, r.end_date) for r in table.collect()} == windows
    by_table = citations.rank_in_windows(found, table, k).collect()
    assert {(r.window_name, r["rank"], r.arxiv_id) for r in by_table} == {(a, b, c) for a, b, c, *_ in expected}


def test_no_candidates(cited):
    w, p, *_ = cited
    none = citations.citation_candidates(w.limit(0), p, AS_OF)
    names = {r.window_name for r in citations.citation_windows(none, AS_OF).collect()}
    assert names == {"recent_3m", "recent_6m", "recent_12m", "year_ytd"}


def test_citation_version(spark, cited, tmp_path):
    w, p, *_ = cited
    early = dt.date(2011, 12, 31)
    for as_of in (early, AS_OF, AS_OF):
        report = snapshots.build_citation_version(w, p, as_of, AS_OF, str(tmp_path)).first()
        assert report.passed and report.n_missing_details == 0
    ranking = Publication(spark, str(tmp_path)).read("citation_ranking")
    assert {r[0] for r in ranking.select(F.to_date("as_of_date")).distinct().collect()} == {early, AS_OF}
    with pytest.raises(ValueError, match="future"):
        snapshots.build_citation_version(w, p, AS_OF, early, str(tmp_path))
    # A rerun without candidates raises and leaves what was published; one with fewer rows replaces its version.
    before = ranking.groupBy("as_of_date").count().collect()
    with pytest.raises(ValueError, match="ranking"):
        snapshots.build_citation_version(w.limit(0), p, AS_OF, AS_OF, str(tmp_path))
    again = Publication(spark, str(tmp_path)).read("citation_ranking")
    assert sorted(again.groupBy("as_of_date").count().collect()) == sorted(before)
    report = snapshots.build_citation_version(w, p, AS_OF, AS_OF, str(tmp_path), k=3, status="running").first()
    assert report.max_rank == 3 and report.n_bad_windows == 0 and not report.passed


# Reader.

RANK_ROW = "snapshot_date date, window_name string, metric string, rank int, arxiv_id string, title string, metric_value bigint"


def test_ranking_wide(rows):
    day = dt.date(2026, 11, 6)
    data = [
        (day, "d14", "fork", 1, "b", "B", 5), (day, "d14", "fork", 2, "a", "A", 5), (day, "d14", "pr", 1, "c", "C", 9),
        (day, "d14", "pr", 2, "n", None, 9), (day, "total", "star", 1, "a", "A", 1),
    ]
    got = reader.ranking_wide(rows(data, RANK_ROW), "d14").orderBy("rank").collect()
    # No stars in the window, so forks lead; the paper without forks comes last.
    assert [(r["rank"], r.arxiv_id, r.star, r.fork, r.pr) for r in got] == [
        (1, "a", None, 5, None), (2, "b", None, 5, None), (3, "c", None, None, 9),
    ]
    assert reader.ranking_wide(rows(data, RANK_ROW), "year_1999").count() == 0


def test_window_options(rows):
    names = ["total", "year_2019", "odd", "year_ytd", "rolling_9d", "d14", "year_2020", "recent_12m", "rolling_7d"]
    got = reader.window_options(rows([(n,) for n in names], "window_name string"), dt.date(2026, 11, 6))
    found = {r.window_name: r.label for r in got.collect()}
    order = [r.window_name for r in got.orderBy("position").collect()]
    assert order == ["d14", "rolling_7d", "recent_12m", "year_ytd", "year_2020", "year_2019", "odd", "rolling_9d", "total"]
    assert found["year_ytd"] == "2026年YTD" and found["rolling_9d"] == "最近9d" and found["odd"] == "odd"


def test_cards(rows):
    ddl = "arxiv_id string, title string, published_date string, authors string, categories string, abstract string, linked_repos string"
    df = rows([("1", " ", "2026-01-01", None, "cs", "", '[{"full_name":"o/a"},{"full_name":"o/b"}]')], ddl)
    got = [(r.label, r.value) for r in reader.card_rows(df, reader.ACTIVITY_CARD).collect()]
    assert got == [("title", reader.UNTITLED), ("发布时间", "2026-01-01"), ("分类", "cs")]
    row = reader.card_repos(df, shown=1).first()
    assert (row.n_repos, row.shown, row.n_more) == (2, ["o/a"], 1)
    assert reader.find_paper(df, "2").count() == 0 and reader.find_paper(df, "1").count() == 1


def test_numbers_of_a_hot_group(rows, monkeypatch):
    """A group with a third of all rows is numbered by several tasks; null groups count; ties keep their count."""
    kept = []
    monkeypatch.setattr("litpulse.operators.ranks.materialise", lambda df, name: kept.append(materialise(df, name)) or kept[-1])
    rnd = random.Random(4)
    data = [("hot", rnd.randrange(50), k) for k in range(3000)] + [(rnd.choice(["a", "b", None, "c"]), rnd.randrange(50), k) for k in range(6000)]
    df = rows(data, "g string, v int, k int")
    got = numbered(df, ["g"], [F.col("v").desc(), F.col("k").asc()], "at", partitions=8)
    assert got.columns == ["g", "v", "k", "at"]
    want = {}
    for g in {d[0] for d in data}:
        for at, row in enumerate(sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2])), 1):
            want[row] = at
    assert {(r.g, r.v, r.k): r["at"] for r in got.collect()} == want
    every = numbered(df, [], [F.col("k").asc(), F.col("g").asc_nulls_last()], "at", partitions=8).collect()
    assert sorted(r["at"] for r in every) == list(range(1, 9001))
    assert [r.k for r in sorted(every, key=lambda r: r["at"])] == sorted(d[2] for d in data)
    assert numbered(df.limit(0), ["g"], [F.col("k").asc()], "at").count() == 0
    # The hot group's rows were sorted by more than one task.
    assert kept[0].where("g = 'hot'").select(F.shiftright("__at", 33)).distinct().count() > 1


def test_interval_join(spark, rows):
    rnd = random.Random(6)
    day = lambda k: dt.date(1990, 1, 1) + dt.timedelta(days=k)
    points = [(k, day(rnd.randrange(-9000, 9000)) if k % 20 else None) for k in range(300)]
    spans = [(k, day(a), day(a + rnd.choice([-3, 0, 1, 7, 8, 63, 64, 500, 5000, 200_000]))) for k, a in enumerate(rnd.randrange(-9000, 9000) for _ in range(300))]
    spans += [(900, None, day(3)), (901, day(3), None), (902, dt.date(1, 1, 1), dt.date(9999, 12, 31)), (903, day(5), day(5))]
    joined = join_spans(rows(points, "p int, d date"), "d", rows(spans, "s int, a date, b date"), "a", "b").collect()
    want = sorted((p, s) for p, d in points for s, a, b in spans if d and a and b and a <= d <= b)
    assert sorted((r.p, r.s) for r in joined) == want and len(want) > 3000
    assert join_spans(rows([], "p int, d date"), "d", rows(spans, "s int, a date, b date"), "a", "b").count() == 0


def _many_repos(spark, n):
    return spark.range(n).selectExpr(
        "'p' AS arxiv_id", "id AS repo_id", "concat('o/', id) AS full_name", "'o' AS owner",
        "pmod(id * 7919, 101) AS star_total", "0L AS fork_total", "0L AS issue_total", "0L AS pr_total",
    )


def test_ordered_repos_are_complete(spark):
    n = 5000
    ordered = activity.ordered_repos(_many_repos(spark, n), partitions=6)
    got = [(r.position, r.star_total, r.repo_id) for r in ordered.orderBy("position").collect()]
    assert [g[0] for g in got] == list(range(1, n + 1))
    assert [(-s, i) for _, s, i in got] == sorted((-(k * 7919 % 101), k) for k in range(n))


def test_lists_come_in_chunks_that_hold_all(spark):
    """5000 repositories: no array is longer than a chunk, the chunks are the list, and a card counts all from their JSON form."""
    n, size = 5000, activity.REPO_CHUNK
    ordered = activity.ordered_repos(_many_repos(spark, n))
    chunks = activity.paper_repo_chunks(ordered)
    got = chunks.orderBy("chunk").collect()
    assert [c.chunk for c in got] == [0, 1, 2, 3, 4] and {len(c.linked_repos) for c in got} == {size}
    want = sorted(range(n), key=lambda k: (-(k * 7919 % 101), k))
    assert [r.repo_id for c in got for r in c.linked_repos] == want
    texts = ("arxiv_id", "title", "abstract", "authors", "categories", "published_date", "datestamp")
    papers = spark.createDataFrame([("p",) * 7], ", ".join(f"{c} string" for c in texts))
    row = activity.paper_details(papers.select("arxiv_id"), ordered, papers, SNAP, 10).first()
    assert [r.repo_id for r in row.linked_repos] == want[:size] and (row.repo_count, row.repo_chunks) == (n, 5)
    for form in (chunks, chunks.withColumn("linked_repos", F.to_json("linked_repos"))):
        card = reader.card_repos_of_chunks(form, shown=3).first()
        assert (card.n_repos, card.n_more, card.shown) == (n, n - 3, [f"o/{k}" for k in want[:3]])


def test_intervals_meet_a_few_points_of_a_node(spark, rows):
    """The join of ranked intervals grows with the intervals, not with the points in them, and ranks as the whole join does."""
    first, n, k = dt.date(2000, 1, 1), 20_000, 2
    points = spark.range(n).select(
        "id", F.date_add(F.lit(first), (F.col("id") % 60).cast("int")).alias("d"), (F.col("id") * 7919 % 101).alias("v")
    )
    data = [(s, first + dt.timedelta(s * 3 % 50), first + dt.timedelta(s * 3 % 50 + s % 30 - 2)) for s in range(40)]
    spans = rows([*data, (1, None, first), (2, first, first)], "s int, a date, b date")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = top_in_spans(points, "d", spans, "a", "b", order, k)
    joined = join_spans(points, "d", spans, "a", "b")
    best = Window.partitionBy("s", "a", "b").orderBy(*order)
    want = joined.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
    assert sorted(got.select("s", "a", "b", "id").collect()) == sorted(want.select("s", "a", "b", "id").collect())
    # Each node passes on two points at most: its limit stands below the join.
    found = points.select(F.col("id").cast("string").alias("arxiv_id"), F.col("d").alias("paper_date"), F.col("v").alias("cited_by_count"))
    named = spans.select(F.col("s").cast("string").alias("window_name"), F.col("a").alias("start_date"), F.col("b").alias("end_date"))
    ranked = citations.rank_in_windows(found, named, k)
    assert "WindowGroupLimit [__node" in ranked._jdf.queryExecution().executedPlan().toString()
    assert ranked.count() == k * named.where("end_date >= start_date").select("window_name").distinct().count()


@pytest.mark.parametrize("fresh", [0, 3, 2000])
def test_only_repositories_that_can_rank_meet_the_edges(spark, fresh):
    """Papers with several repositories, ties at the floor, and fewer recent papers than ranks."""
    k, n, i = 7, 2000, F.col("id")
    events = spark.range(n).select(i.alias("repo_id"), F.lit("star").alias("metric"), F.lit(SNAP).alias("date"), (i * 7919 % 500 + 1).alias("count"))
    edges = spark.range(3 * n).select((i * 31 % n).alias("repo_id"), (i * i % 1511).cast("string").alias("arxiv_id"))
    recent = spark.range(fresh).select((i * 13).cast("string").alias("arxiv_id"))
    per_repo = activity.repo_activity(events, SNAP, FIRST)
    cut = activity.rankable_activity(per_repo, activity.rank_floors(per_repo, edges, recent, k))
    whole, few = (activity.ranked_papers(activity.paper_activity(edges, a), recent, k) for a in (per_repo, cut))
    columns = ["window_name", "metric", "rank", "arxiv_id", "metric_value"]
    assert sorted(few.select(columns).collect()) == sorted(whole.select(columns).collect())
    if fresh == 2000:  # with fewer recent papers than ranks nothing below the totals can be left out
        assert cut.count() < per_repo.count() / 5


def test_floors_ask_the_edges_of_high_repositories_only(spark, monkeypatch):
    """What meets the edges for the floors does not grow with the repositories, and without enough papers there is no floor."""
    k, n, i = 3, 5000, F.col("id")
    events = spark.range(n).select(i.alias("repo_id"), F.lit("star").alias("metric"), F.lit(SNAP).alias("date"), (i + 1).alias("count"))
    edges = spark.range(n).select(i.alias("repo_id"), (i % 2500).cast("string").alias("arxiv_id"))
    recent = spark.range(2).select(i.cast("string").alias("arxiv_id"))
    per_repo, kept = activity.repo_activity(events, SNAP, FIRST), []
    monkeypatch.setattr("litpulse.plans.activity.materialise", lambda df, name: kept.append(materialise(df, name)) or kept[-1])
    floors = activity.rank_floors(per_repo, edges, recent, k)
    assert kept[0].select("repo_id").distinct().count() == activity.FLOOR_REPOS_RECENT * k
    assert {name: value for name, _, value in floors}["total"] == n - 2 and "d14" not in {name for name, *_ in floors}
    one = activity.rank_floors(per_repo, edges.withColumn("arxiv_id", F.lit("0")), recent, k)
    assert one == [] and activity.rankable_activity(per_repo, one).count() == n


def test_windows_add_up_their_spans(rows):
    """Rows on and beside every bound, without a date or a count: each window is the sum of its own rows."""
    dates = sorted({d + dt.timedelta(s) for w in activity.activity_windows(SNAP, FIRST) for d in (w.lower, w.upper) if d for s in (-1, 0, 1)})
    data = [(1, "star", d, 1 << k) for k, d in enumerate(dates)] + [(1, "star", None, 1 << 50), (2, "fork", None, 5), (3, "pr", SNAP, None), (4, "pr", dates[0], 0)]
    got = {r.repo_id: r for r in activity.repo_activity(rows(data, "repo_id long, metric string, date date, count long"), SNAP, FIRST).collect()}
    for w in activity.activity_windows(SNAP, FIRST):
        for repo in (1, 2, 3, 4):
            mine = [n for i, _, d, n in data if i == repo and n is not None and (w.name == "total" or d and (not w.lower or d >= w.lower) and (not w.upper or d <= w.upper))]
            assert got[repo][w.name] == (sum(mine) if mine else None), (w.name, repo)
