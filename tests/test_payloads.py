import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from litpulse.sources import payloads

D = dt.date
STAMP = dt.datetime(2017, 2, 8, 13, 5, 56)
MAILED, PUBLISHED, PAPER_ID = STAMP.strftime("%a, %-d %b %Y %H:%M:%S GMT"), STAMP.isoformat() + "+00:00", "1702.09876"


def record(body="", status="", versions=None):
    if versions is None:
        versions = [("v1", MAILED)]
    v = "".join(f'<version version="{n}"><date>{d}</date><size>6kb</size></version>' for n, d in versions)
    meta = f'<metadata><arXivRaw xmlns="http://arxiv.org/OAI/arXivRaw/"><id>{PAPER_ID}</id><title>T</title>{v}{body}</arXivRaw></metadata>'
    return (
        f"<record><header{status}><identifier>oai:1</identifier><datestamp>2017-02-09</datestamp>"
        f"<setSpec>cs.LG</setSpec></header>{'' if body is None else meta}</record>"
    )


def page(*records, token="", error=""):
    inner = error or f"<ListRecords>{''.join(records)}<resumptionToken>{token}</resumptionToken></ListRecords>"
    return f'<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/">{inner}</OAI-PMH>'


@pytest.fixture
def parse(rows):
    def run(*pages):
        return payloads.classified_papers(rows([(p,) for p in pages], "value string"), "value")

    return run


def test_plain_record(parse):
    row = payloads.kept_papers(parse(page(record()))).first()
    assert row.arxiv_id == PAPER_ID and row.title == "T" and row.set_specs == ["cs.LG"]
    assert row.published_date == PUBLISHED
    assert row.abstract is None and row.versions[0].version == "v1"


def test_outcomes(parse):
    rows_ = parse(
        page(record(), record(status=' status="deleted"'), record(body=None), record(versions=[]), token="next"),
        page(record(versions=[("v1", MAILED), ("v2", "Sat, 13 Jan 2018 21:30:00 GMT")])),
        page(error='<error code="noRecordsMatch">none</error>'),
    )
    kinds = sorted(r.outcome for r in rows_.collect())
    assert kinds == ["date_fail", "deleted", "kept", "kept", "parse_fail"]
    dates = {r.published_date for r in payloads.kept_papers(rows_).collect()}
    assert dates == {PUBLISHED}


def test_page_tokens(rows):
    """One token per page, however many records it has."""
    pages = [(1, page(record(), record(), token="more")), (2, page(token="later")), (3, page(record())), (4, page(error='<error code="noRecordsMatch">none</error>'))]
    got = payloads.page_tokens(rows(pages, "n int, value string"), "value", "n").collect()
    assert {r.n: r.next_token for r in got} == {1: "more", 2: "later", 3: None, 4: None} and len(got) == 4


@pytest.mark.parametrize("payload, error", [(None, "null page"), (" null ", "null page"), ("", "broken page"), ("<html>", "broken page"), ('{"items":[{"id":1', "broken page"), ("[{", "broken page"), ("[]", None), ("{}", None)])
def test_unusable_pages_are_not_complete(rows, payload, error):
    df = rows([(payload, D(2026, 1, 1), D(2026, 2, 1), 1, 1)], STARS)
    for coverage in (payloads.star_coverage, payloads.connection_coverage):
        row = coverage(df, "payload", "repo_id").first()
        assert (row.complete, row.next_page, row.error) == (error is None, None, error)
    row = payloads.search_coverage(df, "payload").first()
    assert (row.n_items, row.next_cursor, row.hour_finished, row.error) == (0, None, error is None, error)


def test_error_page_and_bad_xml_fail(parse):
    with pytest.raises(Exception, match="badArgument"):
        parse(page(error='<error code="badArgument">no</error>')).collect()
    with pytest.raises(Exception):
        parse("<OAI-PMH><ListRecords>").collect()


@pytest.mark.parametrize(
    "versions, expected",
    [
        ([], None),
        ([("v3", "march"), ("v12", "may"), ("v2", "june")], "june"),
        ([("v7", "p"), ("", "q"), ("v?", "r")], "q"),
        ([(None, "undated version")], "undated version"),
    ],
)
def test_first_version(spark, versions, expected):
    df = spark.createDataFrame([(versions,)], "v array<struct<version:string,date:string>>")
    assert df.select(payloads.first_version_date(F.col("v"))).first()[0] == expected


def test_search_items(rows):
    value = (
        '{"items":[{"id":771,"full_name":"acme/tool","created_at":"2015-07-04T00:00:00Z"},'
        '{"id":772,"full_name":"plain","created_at":null},{"id":null,"full_name":"a/b"}]}'
    )
    items = payloads.search_items(rows([(value,)], "value string"), "value")
    assert [tuple(r) for r in payloads.repo_rows(items).collect()] == [
        (771, "acme/tool", "acme", "tool", D(2015, 7, 4))
    ]
    cover = payloads.search_coverage(rows([(value,)], "value string"), "value").first()
    assert (cover.n_items, cover.next_cursor, cover.hour_finished) == (3, None, True)
    full = '{"items":[' + ",".join(['{"id":1,"created_at":"2015-07-04T05:00:09Z"}'] * 100) + "]}"
    cover = payloads.search_coverage(rows([(full,)], "value string"), "value").first()
    assert cover.next_cursor == dt.datetime(2015, 7, 4, 5, 0, 10) and not cover.hour_finished
    # The cursor does not leave the hour.
    for second, finished in ((10, True), (11, False)):
        end = F.lit(f"2015-07-04 05:00:{second}").cast("timestamp")
        cover = payloads.search_coverage(rows([(full,)], "value string"), "value", hour_end=end).first()
        assert cover.hour_finished == finished and (cover.next_cursor is None) == finished


FIRST_DAY = D(2014, 3, 5)
STARS = "payload string, scan_start date, scan_to date, repo_id bigint, page_no int"


def after(days):
    return FIRST_DAY + dt.timedelta(days=days)


def seconds(day):
    return int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp())


def star_page(*weeks, wrap=False):
    """Weeks as (days after the first day, list of counts)."""
    body = [{"week": seconds(after(k)), "days": days} for k, days in weeks]
    return json.dumps({"weeks": body} if wrap else body)


def folded(rows, payload, low, high):
    df = rows([(payload, after(low), after(high), 1, 1)], STARS)
    return {(r.date - FIRST_DAY).days: r["count"] for r in payloads.daily_star_counts(df, "payload", "repo_id").collect()}


def plain_fold(weeks, low, high):
    """What the pages say, slot by slot: whole numbers above zero, seven slots a week, inside the range."""
    out = {}
    for start, days in weeks:
        for slot, text in enumerate(days[:7]):
            count = text if isinstance(text, int) else int(text) if isinstance(text, str) and re.fullmatch(r"\s*\+?\d+\s*", text) else 0
            if count > 0 and low <= start + slot <= high:
                out[start + slot] = out.get(start + slot, 0) + count
    return out


@pytest.mark.parametrize("seed", range(4))
def test_star_weeks(rows, seed):
    rng = random.Random(seed)
    slots = [0, 1, 5, 31, None, -4, "8", "+6", " 9", "1e3", "four", "", "-2"]
    weeks = [(rng.randrange(-20, 40), [rng.choice(slots) for _ in range(rng.choice([0, 3, 7, 9]))]) for _ in range(12)]
    low, high = sorted(rng.randrange(-15, 40) for _ in range(2))
    for wrap in (False, True):
        assert folded(rows, star_page(*weeks, wrap=wrap), low, high) == plain_fold(weeks, low, high)


def test_star_pages_without_days(rows):
    undated = json.dumps([{"week": None, "days": [3]}, {"week": "soon", "days": [3]}, {"days": [3]}, {"week": seconds(FIRST_DAY), "days": None}])
    for payload in (None, "", "null", "[]", "{}", '{"weeks":null}', "[{", undated):
        assert folded(rows, payload, -100, 100) == {}


@pytest.mark.parametrize("short", [0, 1])
@pytest.mark.parametrize("before", [0, 2])
@pytest.mark.parametrize("last", [False, True])
def test_star_coverage(rows, short, before, last):
    """A full page whose weeks all begin after the scan's first day asks for the next one, up to the last page."""
    n, page_no = payloads.STAR_PAGE_WEEKS - short, payloads.MAX_PAGES if last else 3
    df = rows([(star_page(*[(k, []) for k in range(n)]), after(-before), after(400), 1, page_no)], STARS)
    more = short == 0 and before > 0
    expected = (not more, page_no + 1 if more and not last else None, "page limit" if more and last else None)
    row = payloads.star_coverage(df, "payload", "repo_id").first()
    assert (row.complete, row.next_page, row.error) == expected


def test_connection(rows):
    days = [4, 4, 11, -30]
    nodes = [{"createdAt": f"{after(k).isoformat()}T0{i}:30:00Z"} for i, k in enumerate(days)]
    body = json.dumps({"pageInfo": {"hasNextPage": True, "endCursor": None}, "nodes": [*nodes, None, {"createdAt": "later"}]})
    low, high = 0, 10
    df = rows([(body, after(low), after(high), 1, 1)], STARS)
    counts = payloads.daily_connection_counts(df, "payload", "repo_id").collect()
    inside = [after(k) for k in days if low <= k <= high]
    assert {r.date: r["count"] for r in counts} == {d: inside.count(d) for d in inside}
    summary = payloads.connection_page_summary(df, "payload").first()
    assert (summary.oldest, summary.has_next) == (after(min(days)), True)
    done = payloads.connection_coverage(df, "payload").first()
    assert done.complete and done.error is None  # the oldest node is before the range
    early = df.withColumn("scan_start", F.lit(after(min(days) - 1)))
    assert payloads.connection_coverage(early, "payload").first().error == "missing cursor"
    empty = df.withColumn("payload", F.lit('{"nodes":[]}'))
    assert payloads.daily_connection_counts(empty, "payload", "repo_id").count() == 0
    assert payloads.connection_page_summary(empty, "payload").first().oldest is None
