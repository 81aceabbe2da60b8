import datetime as dt

import pytest
from pyspark.sql import functions as F

from litpulse.functions import dates, jsons, text
from litpulse.functions.ids import with_paper_ids

D = dt.date


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Fri, 7 Jun 2019 13:45:09 GMT", D(2019, 6, 7)),
        ("Sun, 24 Nov 2019 06:30:00 GMT", D(2019, 11, 24)),
        ("Sat, 29 Feb 2020 23:59:58 GMT", D(2020, 2, 29)),
        ("  Wed, 01 Jan 2014 08:00:01 GMT ", D(2014, 1, 1)),
        ("Tue, 31 Apr 2019 13:45:09 GMT", None),
        ("7 Jun 2019 13:45:09", None),
        (None, None),
        ("", None),
        ("   ", None),
        ("2019-06-07", None),
        ("soon", None),
    ],
)
def test_mail_timestamp(one, value, expected):
    got = one(lambda c: F.to_date(dates.parse_mail_timestamp(c)), value)
    assert got == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Mon, 2 Apr 2007 19:18:42 GMT", "2007-04-02"),
        ("2 Apr 2007 23:59:59 -0800", "2007-04-02"),
        ("Mon, 2 April 2007 19:18 +0200", "2007-04-02"),
        ("Mon, 2 Apr 07 19:18:42 GMT", "2007-04-02"),
        ("Mon, 2 Apr 98 19:18:42 GMT", "1998-04-02"),
        ("Mon, 31 Apr 2007 19:18:42 GMT", None),
        ("Mon, 2 Apr 2007", None),
        ("2007-04-02", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_mail_date(one, value, expected):
    assert one(dates.parse_lenient_mail_date, value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-02-29", D(2024, 2, 29)),
        ("2024-02-29T10:00:00+00:00", D(2024, 2, 29)),
        ("2024-02-30", None),
        ("2024-1-5", None),
        ("2024-05", None),
        (None, None),
    ],
)
def test_strict_iso_date(one, value, expected):
    assert one(dates.strict_iso_date, value) == expected


def test_iso_and_epoch_dates(one):
    assert one(dates.iso_timestamp_date, "2026-10-01T00:00:00Z") == D(2026, 10, 1)
    assert one(dates.iso_timestamp_date, "soon") is None
    assert one(dates.epoch_date, "1792281600") == D(2026, 10, 18)
    assert one(dates.epoch_date, "x") is None
    # Month ends are clamped.
    assert one(lambda c: dates.months_back(c.cast("date"), 3), "2026-05-31") == D(2026, 3, 1)


def ids_of(rows, value):
    row = with_paper_ids(rows([(value,)], "t string"), "t").first()
    return [tuple(x) for x in row["ids"]]


def test_paper_ids(rows):
    text_ = "https://arxiv.org/abs/1811.06571 arXiv: 1811.06572 eprint = {1811.06573}"
    assert ids_of(rows, text_) == [("1811.06571", "url"), ("1811.06572", "inline"), ("1811.06573", "bibtex")]
    assert ids_of(rows, "arxiv.org/abs/1811.06571 and arXiv:1811.06571") == [("1811.06571", "url")]
    assert ids_of(rows, "arxiv.org/pdf/hep-th/9901001v2 eprint='2310.00001'") == [
        ("hep-th/9901001", "url"), ("2310.00001", "bibtex"),
    ]
    # Order of discovery within a pattern, each id once.
    assert ids_of(rows, "arXiv:2401.00002 arXiv:2401.00001 arXiv:2401.00002v3") == [
        ("2401.00002", "inline"), ("2401.00001", "inline"),
    ]
    assert ids_of(rows, "") == [] and ids_of(rows, None) == []


def test_text(one):
    assert one(text.blank_to_null, " \t\n ") is None
    assert one(text.blank_to_null, "  a b ") == "a b"
    assert one(text.collapse_whitespace, " a\n\t b c ") == "a b c"
    assert one(text.owner_of, "o/n/x") == "o" and one(text.name_of, "o/n/x") == "n/x"
    assert one(text.name_of, "plain") == ""
    assert one(lambda c: text.clip(c, 500), "x" * 600) == "x" * 500


def test_missing(one, spark):
    assert one(text.is_missing_text, None) and one(text.is_missing_text, "  ")
    assert not one(text.is_missing_text, "a")
    df = spark.createDataFrame([([], float("nan")), (["a"], 1.0)], "a array<string>, d double")
    got = df.select(text.is_missing(F.col("a"), "array<string>"), text.is_missing(F.col("d"), "double")).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False)]


def test_linked_repo_array(one):
    def size(v):
        return one(lambda c: F.size(jsons.linked_repo_array(c)), v)

    assert size('[{"repo_id":1},{"repo_id":2}]') == 2
    assert size('{"a":{"repo_id":1}}') == 1
    assert size("broken") == 0 and size(None) == 0


def test_lenient_date_agrees_with_the_mail_parser(spark):
    """Generated stamps in many forms against the standard library."""
    from email.utils import parsedate_to_datetime

    forms = (
        "{wd}, {d} {m} {y} {t} GMT", "{d} {m} {y} {t} +0530", "{wd}, {d:02d} {m} {y} {hm} -0700", "{d} {m} {y} {hm}",
        "{wd} {d} {m} {y} {t} GMT", "{y}-{d} {t}", "{m} {d} {y}", "{wd}, {d} {m} {y}",
    )
    values = []
    for i in range(400):
        day = D(1991, 1, 1) + dt.timedelta(days=37 * i)
        stamp = dt.datetime(day.year, day.month, day.day, i % 24, i % 60, (7 * i) % 60)
        values.append(
            forms[i % len(forms)].format(
                wd=day.strftime("%a"), d=day.day, m=day.strftime("%b"), y=day.year,
                t=stamp.strftime("%H:%M:%S"), hm=stamp.strftime("%H:%M"),
            )
        )

    def expected(text_):
        try:
            return parsedate_to_datetime(text_).strftime("%Y-%m-%d")
        except (TypeError, ValueError):
            return None

    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", dates.parse_lenient_mail_date(F.col("v")).alias("d")).collect()
    assert {r.v: r.d for r in got} == {v: expected(v) for v in values}


def test_paper_ids_agree_with_a_plain_scan(spark):
    """Random text against the patterns applied by hand."""
    import random
    import re

    from litpulse.functions.ids import ID_PATTERNS

    rnd = random.Random(5)
    parts = ["arXiv:", "ARXIV ", "arxiv.org/abs/", "https://arxiv.org/pdf/", "eprint = {", "eprint='", " 1811.06571", "1811.06571",
             "1811.06572v2", "hep-th/9901001", "math.GT/0309136", "}", "\n", " text ", "1234.123", "99999.99999"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 14))) for _ in range(500)]

    def expected(value):
        found = {}
        for fmt, pattern in ID_PATTERNS:
            for m in re.finditer(pattern.replace("(?iU)", "(?i)"), value):
                found.setdefault(m.group(1), fmt)
        return list(found.items())

    got = with_paper_ids(spark.createDataFrame(list(enumerate(texts)), "n int, t string"), "t").collect()
    for row in got:
        assert [tuple(x) for x in row["ids"]] == expected(texts[row.n])
