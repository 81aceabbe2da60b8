import datetime as dt
import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from litpulse.operators import merge, quality
from litpulse.plans import release_dates
from litpulse.schemas import EDGES, EVENT_PAGES, EVENTS, PAPERS, REPOS
from litpulse.sources import documents, jsonl, sinks, tables
from litpulse.streaming import ingest

D = dt.date


def test_jsonl_lines(spark, tmp_path):
    odd = "a b c\x85d\re"
    (tmp_path / "x.jsonl").write_bytes(
        (json.dumps({"arxiv_id": "1", "title": odd}, ensure_ascii=False) + "\n\n  \n" + '{"arxiv_id":"2"}').encode()
    )
    got = jsonl.read_jsonl(spark, str(tmp_path / "x.jsonl"), "arxiv_id string, title string").collect()
    assert [tuple(r) for r in got] == [("1", odd), ("2", None)]
    assert jsonl.read_jsonl(spark, str(tmp_path / "absent"), "arxiv_id string").count() == 0
    (tmp_path / "bad.jsonl").write_text('{"arxiv_id":"1"}\n{"arxiv_id":\n')
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "arxiv_id string").collect()


def test_archive(spark, rows, tmp_path):
    path = jsonl.archive_path(str(tmp_path))
    ddl = "arxiv_id string, title string, published_date string"

    def put(*data):
        jsonl.upsert_archive(rows(list(data), f"{ddl}, seq int"), path, ddl, "published_date", "arxiv_id", "seq")

    put(
        ("1", "a", "2023-10-02", 1), ("2", "b", "2023-11-05", 1), ("3", "c", "", 1),
        (None, "d", "2023-10-01", 1), ("", "e", "2023-10-01", 1),
    )
    november = (tmp_path / "papers/published_year=2023/month=11")
    before = sorted(p.name for p in november.glob("*.json"))
    put(("1", "new", "2023-10-02", 2), ("1", "newest", "2023-10-02", 3), ("4", "x", "2023-01-09", 1))
    got = jsonl.read_jsonl(spark, path, jsonl.archive_schema(ddl)).collect()
    assert {(r.arxiv_id, r.title, r.published_year, r.month) for r in got} == {
        ("1", "newest", "2023", "10"), ("2", "b", "2023", "11"), ("4", "x", "2023", "01"),
    }
    assert sorted(p.name for p in november.glob("*.json")) == before  # untouched month


def test_optional_and_snapshot(spark, rows, tmp_path):
    ddl = "as_of_date date, v int"
    assert tables.read_optional(spark, str(tmp_path / "none"), ddl).columns == ["as_of_date", "v"]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("broken")
    with pytest.raises(Exception):
        tables.read_optional(spark, str(tmp_path / "bad"), ddl).collect()
    path = str(tmp_path / "t")
    sinks.replace_version(rows([(D(2026, 1, 1), 1), (D(2026, 1, 2), 2)], ddl), path, "as_of_date")
    sinks.replace_version(rows([(D(2026, 1, 2), 3)], ddl), path, "as_of_date")
    both = tables.read_optional(spark, path, ddl)
    assert {tuple(r) for r in both.select("as_of_date", "v").collect()} == {(D(2026, 1, 1), 1), (D(2026, 1, 2), 3)}
    assert [r.v for r in tables.latest_snapshot(both, "as_of_date").collect()] == [3]
    assert [r.v for r in tables.read_snapshot(spark, path, "as_of_date", D(2026, 1, 1)).collect()] == [1]
    with pytest.raises(ValueError, match="version"):  # names no version to replace
        sinks.replace_version(both.limit(0), path, "as_of_date")
    stats = tables.output_stats(spark, path, "as_of_date").first()
    assert stats.n_partitions == 2 and stats.n_bytes > 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(str(tmp_path / "none"))


@pytest.mark.parametrize("skip, size", [(0, 3), (7, 5), (500, 10), (995, 10), (1000, 5), (5000, 5)])
def test_page_by_offset(spark, skip, size):
    rnd = random.Random(1)
    keys = sorted(rnd.sample(range(-10_000, 1_000_000), 900) + list(range(2_000_000, 2_000_100)))
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    for small in (10, 10_000):
        got = [r.k for r in tables.page_by_offset(df, "k", skip, size, slices=8, small=small).collect()]
        assert got == keys[skip : skip + size]


def test_path_profile(spark, rows):
    """Against a plain walk over parsed records; nulls, broken text, empty and deep values included."""
    raws = ['{"a":1,"b":{"c":[1,"x",null,[true]],"d":{}}}', '{"a":"long text","b":null,"e":[]}', "[1.5,2]", '"text"', "null", "{", "", None, '{"a":1,"a.b":2}']
    want = {}

    def walk(record, path, value):
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "bigint", float: "decimal", type(None): "void"}[type(value)]
        entry = want.setdefault((path, kind), [0, set(), []])
        entry[0] += 1
        entry[1].add(record)
        if kind not in ("object", "array", "void"):
            entry[2].append(len(str(value)))
        for key, child in value.items() if kind == "object" else [(None, x) for x in value] if kind == "array" else ():
            walk(record, path + ("[]" if key is None else f".{key}"), child)

    for k, raw in enumerate(raws):
        if raw is None:
            continue
        try:
            walk(k, "$", json.loads(raw))
        except ValueError:
            entry = want.setdefault(("$", "broken"), [0, set(), []])
            entry[0] += 1
            entry[1].add(k)
    expected = {(p, k, n, len(r), min(c, default=None), max(c, default=None)) for (p, k), (n, r, c) in want.items()}
    assert {tuple(r) for r in documents.path_profile(rows([(r,) for r in raws], "j string"), "j").collect()} == expected
    assert documents.path_profile(rows([], "j string"), "j").count() == 0


def test_in_batches(spark):
    def work(batch):
        assert 0 < len(batch) <= 5
        return batch

    assert documents.in_batches(spark.range(53), 5, work, "id long").count() == 53


def test_merge_papers(rows):
    def p(pid, title, *extra):
        return (pid, title, None, None, None, [], *[None] * 6, [], None, None, None, *extra)

    old = rows([p("1", "a"), p("2", "b")], PAPERS)
    batch = rows([p("2", "x", 1), p("2", None, 2), p("3", "c", 1), p(None, "z", 1)], f"{PAPERS}, landed int")
    got = merge.merge_papers(old, batch, "landed").collect()
    assert {(r.arxiv_id, r.title) for r in got} == {("1", "a"), ("2", None), ("3", "c")}


def test_merge_repos_keeps_first_creation(rows):
    old = rows([(1, "o/a", "o", "a", None), (2, "o/b", "o", "b", D(2020, 1, 1)), (3, "o/c", "o", "c", None)], REPOS)
    batch = rows([(1, "n/a", "n", "a", D(2021, 1, 1), 1), (2, "n/b", "n", "b", D(2022, 1, 1), 1), (4, "n/d", "n", "d", None, 1)], f"{REPOS}, seq int")
    got = {r.repo_id: (r.owner, r.created) for r in merge.merge_repos(old, batch, "seq").collect()}
    assert got == {1: ("n", D(2021, 1, 1)), 2: ("n", D(2020, 1, 1)), 3: ("o", None), 4: ("n", None)}


def test_merge_edges(rows):
    old = rows([(1, "a", False, D(2020, 1, 1)), (1, "b", False, D(2020, 1, 1))], EDGES)
    found = rows([(1, "a"), (1, "c"), (1, "c"), (2, "d")], "repo_id bigint, arxiv_id string")
    papers = rows([("c", "2019-05-05T10:00:00+00:00")], "arxiv_id string, published_date string")
    today = D(2026, 12, 1)
    got = {(r.repo_id, r.arxiv_id): (r.added, r.date) for r in merge.merge_edges(old, found, papers, today).collect()}
    assert got == {
        (1, "a"): (True, D(2020, 1, 1)), (1, "b"): (False, D(2020, 1, 1)),
        (1, "c"): (True, D(2019, 5, 5)), (2, "d"): (True, today),
    }
    plain = merge.merge_edges(old, found, None, today).where("arxiv_id = 'c'").first()
    assert plain.date == today


def test_quality(rows):
    ddl = "snapshot_date date, window_name string, metric string, rank int, arxiv_id string, title string, metric_value bigint"
    d = D(2026, 1, 1)
    bad = rows([(d, "d14", "star", 1, "a", None, 1), (d, "d14", "star", 1, "b", None, 1), (d, "week", "likes", 501, None, None, 1)], ddl)
    got = {r.rule: r.violations for r in quality.ranking_violations(bad).collect()}
    assert got == {"window_name": 1, "metric": 1, "rank_range": 1, "not_null": 1, "primary_key": 1}
    with pytest.raises(ValueError):
        quality.require_contiguous(bad)
    with pytest.raises(ValueError):
        quality.require_past(None, d)


def line(pid, created):
    return json.dumps({"paper_id": pid, "metadata": {"versions": [{"version": "v1", "created": created}]}, "x": "ü"}, ensure_ascii=False)


def test_release_dates(spark, rows, tmp_path):
    # One date holds most of the rows and is spread over several files; the lines are read once.
    data = [line(f"{i} {random.Random(i).random()}", "Mon, 2 Apr 2007 19:18:42 GMT") for i in range(4000)] + [line("x", "3 Apr 2007 01:00:00 +0000")]
    (tmp_path / "in").mkdir()
    for k in range(4):
        (tmp_path / "in" / f"{k}.jsonl").write_text("\n".join(data[k::4]) + "\n", encoding="utf8")
    raw = jsonl.read_lines(spark, str(tmp_path / "in"))
    dated = release_dates.with_publish_date(raw)
    out, size = str(tmp_path / "out"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "20000")
    try:
        release_dates.write_by_date(dated, out)
    finally:
        spark.conf.unset(size)
    assert len(list((tmp_path / "out" / "publish_date=2007-04-02").glob("*.parquet"))) > 2
    assert len(list((tmp_path / "out" / "publish_date=2007-04-03").glob("*.parquet"))) == 1
    stored = release_dates.read_by_date(spark, out)
    assert {r.layer: r.passed for r in release_dates.lossless_report(raw, stored).collect()} == {"rows": True, "ids": True, "hashes": True}
    assert [tuple(r) for r in release_dates.year_histogram(dated).collect()] == [("2007", 4001)]
    assert all(r.same_hash and r.same_fields for r in release_dates.sample_matches(raw, stored).collect())
    # A line without a date is not stored: the report says so.
    more = raw.unionByName(rows([(line("y", "soon"),)], "raw_json string"))
    report = {r.layer: r for r in release_dates.lossless_report(more, stored).collect()}
    assert not report["rows"].passed and report["ids"].only_left == 1 and report["hashes"].only_left == 1


def test_streams_equal_batches(spark, rows, tmp_path):
    """Two deliveries, with a restart between them and a late re-scan of an old day."""
    landing, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    old, new = D(2020, 1, 1), D(2026, 1, 1)
    first = rows([(1, "star", old, 5, 1, 1), (1, "star", new, 2, 1, 1), (2, "fork", new, 0, 1, 1)], EVENT_PAGES)
    second = rows([(1, "star", old, 3, 2, 1), (1, "star", old, 4, 2, 2), (3, "pr", new, 1, 2, 1)], EVENT_PAGES)
    first.write.json(landing)
    ingest.stream_events(spark, landing, out, state)
    # One file per row and one file per batch: the two pages of a day meet in the table.
    second.repartition(3, "repo_id", "page").write.mode("append").json(landing)
    for _ in range(2):  # the second run finds nothing new
        ingest.stream_events(spark, landing, out, state, files_per_batch=1)
    daily = merge.daily_counts(ingest.events_table(spark, out).read())
    got = {(r.repo_id, r.metric, r.date, r["count"]) for r in daily.collect()}
    # A batch that is repeated changes nothing.
    ingest.events_table(spark, out).merge(second, merge.merge_event_pages)
    assert merge.daily_counts(ingest.events_table(spark, out).read()).exceptAll(daily).isEmpty()
    empty = rows([], EVENTS)
    batch = merge.merge_events(merge.merge_events(empty, first, "scan"), second, "scan")
    assert got == {(r.repo_id, r.metric, r.date, r["count"]) for r in batch.collect()}
    assert (1, "star", D(2020, 1, 1), 7) in got and len(got) == 3


def test_atom_links(spark, rows):
    from litpulse.sources import payloads

    feed = (
        '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://x/abs/1706.03762v7</id><title>A\n  B</title>'
        '<summary> s </summary><author><name>N</name></author><category term="cs"/>'
        '<link rel="related" type="application/pdf" href="pdf"/></entry></feed>'
    )
    row = payloads.atom_entries(rows([(feed,)], "v string"), "v").first()
    assert (row.arxiv_id, row.title, row.authors, row.pdf_url, row.abstract_url) == ("1706.03762", "A B", ["N"], "pdf", None)
    assert row.n_authors == 1 and row.categories == ["cs"]


def test_scratch_needs_a_shared_folder(spark):
    from litpulse import session

    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.materialise(spark.range(3).select(F.col("id")), "t").count() == 3


def test_whole_files_and_gates(spark, rows, tmp_path):
    from litpulse.sources import payloads

    (tmp_path / "README.md").write_text("line one\nline two\n", encoding="utf8")
    row = payloads.read_whole_files(spark, str(tmp_path)).first()
    assert row.value == "line one\nline two\n" and row.path.endswith("README.md")
    repos = rows([("o/a",), ("o/b",)], "full_name string")
    readmes = rows([("o/a", "text")], "full_name string, readme string")
    got = {r.full_name: r.readme for r in payloads.repos_with_readme(repos, readmes).collect()}
    assert got == {"o/a": "text", "o/b": None}
    assert tables.table_is_empty(repos.limit(0)) and not tables.table_is_empty(repos)
    assert not tables.table_exists(spark, "no_such_table")
    assert tables.list_objects(spark, str(tmp_path)).first().n_bytes == 18


def test_exports(spark, rows, tmp_path):
    ranking = rows([("d14", "star", 2, "b"), ("d14", "star", 1, "a")], "window_name string, metric string, rank int, arxiv_id string")
    sinks.export_ranking(ranking, str(tmp_path / "r"))
    assert [r.arxiv_id for r in spark.read.parquet(str(tmp_path / "r")).collect()] == ["a", "b"]
    details = rows([("a", 3)], "arxiv_id string, cited_by_count int")
    with pytest.raises(ValueError, match="details"):
        sinks.export_citations(ranking, details.limit(0), str(tmp_path / "c"))
    assert not (tmp_path / "c").exists()
    sinks.export_citations(ranking, details, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c/details")).count() == 1


def test_parsed_once(spark, rows):
    """A filter on parsed output stays above the parse."""
    from litpulse.sources import payloads

    pages = rows([("<a/>",)], "value string")
    df = payloads.kept_papers(payloads.classified_papers(pages, "value"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1
    raw = rows([("{}",)], "raw_json string")
    df = release_dates.year_histogram(release_dates.with_publish_date(raw))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_event_pages_are_dealt_out_once(spark, rows):
    """Pages replace themselves and later scans earlier ones as rule by rule, with repeated and null rows; one exchange serves it all."""
    rng = random.Random(29)
    ddl = "repo_id bigint, metric string, date date, count bigint, scan bigint, page bigint"
    pick = lambda n: rng.choice([None, *range(n)]) if rng.random() < 0.2 else rng.randrange(n)
    some = lambda n: [(pick(3), rng.choice(["star", "fork"]), D(2020, 1, 1 + rng.randrange(2)), rng.randrange(-1, 9), pick(3), pick(3)) for _ in range(n)]
    for n, m in ((60, 40), (0, 30), (30, 0)):
        old, batch = some(n), some(m)
        fresh = {}
        for *day, count, scan, page in batch:
            if count > 0:
                key = (*day, scan, page)
                fresh[key] = max(count, fresh.get(key, 0))
        merged = [r for r in old if None in (key := (*r[:3], r[4], r[5])) or key not in fresh] + [(*k[:3], c, *k[3:]) for k, c in fresh.items()]
        latest = {}
        for r in merged:
            if r[4] is not None:
                latest[r[:3]] = max(r[4], latest.get(r[:3], 0))
        want = [r for r in merged if None not in (*r[:3], r[4]) and r[4] == latest[r[:3]]]
        got = merge.merge_event_pages(rows(old, ddl), rows(batch, ddl))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange ") == 1
