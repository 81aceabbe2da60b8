"""Parsers of landed pages: XML paper pages, search pages, READMEs, activity pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litpulse.functions.dates import epoch_date, iso_timestamp_date, parse_mail_timestamp, iso_utc_text
from litpulse.functions.once import once
from litpulse.functions.text import blank_to_null, collapse_whitespace, name_of, owner_of, strip
from litpulse.schemas import (
    ATOM_FEED,
    CONNECTION,
    PAPER_PAGE,
    SEARCH_PAGE,
    STAR_WEEK,
)
from litpulse.sources.tables import side_by_side

STAR_PAGE_WEEKS = 30
MAX_PAGES = 100
SEARCH_PAGE_SIZE = 100


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: its path and its whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value")
    )


# Paper pages (XML).


def parse_xml(c: Column, schema: str) -> Column:
    """Malformed XML fails the job."""
    return F.from_xml(c, schema, {"mode": "FAILFAST"})


def page_has_records(page: Column) -> Column:
    """False for an empty answer (``noRecordsMatch``); any other error code raises."""
    code = page["error"]["_code"]
    return (
        F.when(page["error"].isNull(), F.lit(True))
        .when(code == "noRecordsMatch", F.lit(False))
        .otherwise(
            F.raise_error(
                F.concat(
                    F.lit("page error "), F.coalesce(code, F.lit("unknown")), F.lit(": "),
                    F.coalesce(page["error"]["_VALUE"], F.lit("")),
                )
            ).cast("boolean")
        )
    )


def page_tokens(pages: DataFrame, value: str, *keep: str) -> DataFrame:
    """One row per page: ``next_token``, null on the last page and on an empty answer."""
    parsed = pages.select(*keep, parse_xml(F.col(value), PAPER_PAGE).alias("p"))
    token = blank_to_null(F.col("p.ListRecords.resumptionToken"))
    return parsed.select(*keep, F.when(page_has_records(F.col("p")), token).alias("next_token"))


def page_records(pages: DataFrame, value: str, *keep: str) -> DataFrame:
    """One row per record of each page.

    The page check sits inside the outer explode: as a filter of its own, like
    the one an inner explode implies, it would be pushed below the parse and have
    every page parsed again.
    """
    parsed = pages.select(*keep, parse_xml(F.col(value), PAPER_PAGE).alias("p"))
    records = F.coalesce("p.ListRecords.record", "p.GetRecord.record")
    return parsed.select(
        *keep,
        F.explode_outer(F.when(page_has_records(F.col("p")), records)).alias("record"),
    ).where(F.col("record").isNotNull())


def version_number(c: Column) -> Column:
    """``v12`` is 12; anything else counts as 0."""
    return F.coalesce(F.regexp_extract(strip(c), r"^v(\d+)$", 1).try_cast("int"), F.lit(0))


def first_version_date(versions: Column) -> Column:
    """The date of the lowest version; the list order decides between equals."""
    ranked = F.transform(
        versions,
        lambda v, i: F.struct(
            version_number(v["version"]).alias("n"), i.alias("i"), v["date"].alias("date")
        ),
    )
    return F.get(F.array_sort(ranked), F.lit(0))["date"]


def paper_fields(records: DataFrame, *keep: str) -> DataFrame:
    """The 16 paper columns of each record, plus its deletion flag and whether it has metadata."""
    meta, head = F.col("record.metadata.arXivRaw"), F.col("record.header")
    versions = F.coalesce(
        F.transform(
            meta["version"],
            lambda v: F.struct(
                v["_version"].alias("version"), v["date"].alias("date"),
                v["size"].alias("size"), v["source_type"].alias("source_type"),
            ),
        ),
        F.from_json(F.lit("[]"), "array<struct<version:string,date:string,size:string,source_type:string>>"),
    )

    def text(tag: str) -> Column:
        return blank_to_null(meta[tag])

    return records.select(
        *keep,
        text("id").alias("arxiv_id"),
        *(text(c).alias(c) for c in ("title", "abstract", "authors", "categories")),
        F.filter(
            F.coalesce(head["setSpec"], F.array().cast("array<string>")),
            lambda s: s.isNotNull() & (s != ""),
        ).alias("set_specs"),
        *(text(c).alias(c) for c in ("submitter", "comments")),
        text("journal-ref").alias("journal_ref"),
        text("doi").alias("doi"),
        text("report-no").alias("report_no"),
        text("license").alias("license"),
        versions.alias("versions"),
        first_version_date(versions).alias("published_text"),
        head["datestamp"].alias("datestamp"),
        head["identifier"].alias("oai_identifier"),
        head["_status"].eqNullSafe("deleted").alias("is_deleted"),
        (head.isNotNull() & meta.isNotNull()).alias("has_metadata"),
        meta["update_date"].alias("update_date"),
    )


def classified_papers(pages: DataFrame, value: str, *keep: str) -> DataFrame:
    """Every record with its outcome: ``kept``, ``deleted``, ``parse_fail`` or ``date_fail``."""
    fields = paper_fields(page_records(pages, value, *keep), *keep)
    published = iso_utc_text(parse_mail_timestamp(F.col("published_text")))
    return fields.select("*", once(published).alias("published_date")).withColumn(
        "outcome",
        F.when(F.col("is_deleted"), "deleted")
        .when(~F.col("has_metadata"), "parse_fail")
        .when(F.col("published_date").isNull(), "date_fail")
        .otherwise("kept"),
    )


def kept_papers(classified: DataFrame, *keep: str) -> DataFrame:
    """The paper table rows of a harvest."""
    return classified.where("outcome = 'kept'").select(
        *keep, "arxiv_id", "title", "abstract", "authors", "categories", "set_specs", "submitter",
        "comments", "journal_ref", "doi", "report_no", "license", "versions", "published_date",
        "datestamp", "oai_identifier",
    )


def harvest_counters(classified: DataFrame, pages: DataFrame) -> DataFrame:
    """Record counters of a harvest in one pass, plus the number of pages."""

    def n(outcome: str) -> Column:
        return F.count_if(F.col("outcome") == outcome)

    records = classified.agg(
        F.count("*").alias("fetched"), n("kept").alias("written"), n("deleted").alias("deleted"),
        n("parse_fail").alias("parse_fail"), n("date_fail").alias("date_fail"),
    )
    return side_by_side([records, pages.agg(F.count("*").alias("pages"))])


def single_record_fields(pages: DataFrame, value: str, *keep: str) -> DataFrame:
    """Fields of one-record answers for comparing two interfaces of the same source."""
    fields = paper_fields(page_records(pages, value, *keep), *keep).where("has_metadata")
    return fields.select(
        *keep, F.col("arxiv_id").alias("id"), "submitter", "authors", "title", "comments",
        "journal_ref", "doi", "report_no", "categories", "license", "abstract",
        F.transform(
            "versions",
            lambda v: F.struct(v["version"].alias("version"), v["date"].alias("created"), v["size"].alias("size")),
        ).alias("versions"),
        F.size("versions").alias("n_versions"), blank_to_null(F.col("update_date")).alias("update_date"),
    )


def atom_entries(feeds: DataFrame, value: str, *keep: str) -> DataFrame:
    """Feed entries as 14 fields: id without version, collapsed texts, authors, links."""
    e = F.col("e")
    last = F.element_at(F.split(F.regexp_replace(e["id"], "/+$", ""), "/"), -1)

    def link(rel: str, kind: str) -> Column:
        hits = F.filter(e["link"], lambda x: (x["_rel"] == rel) & (x["_type"] == kind))
        # The last match wins.
        return F.try_element_at(hits, F.lit(-1))["_href"]

    authors = F.coalesce(
        F.transform(F.filter(e["author"], lambda a: a["name"].isNotNull()), lambda a: strip(a["name"])),
        F.array().cast("array<string>"),
    )
    parsed = feeds.select(*keep, parse_xml(F.col(value), ATOM_FEED)["entry"].alias("entry"))
    return (
        parsed.select(*keep, once(F.col("entry")).alias("e"))
        .where(e.isNotNull())
        .select(
            *keep,
            F.substring_index(last, "v", 1).alias("arxiv_id"),
            collapse_whitespace(F.coalesce(e["title"], F.lit(""))).alias("title"),
            collapse_whitespace(F.coalesce(e["summary"], F.lit(""))).alias("abstract"),
            authors.alias("authors"),
            F.size(authors).alias("n_authors"),
            e["published"].alias("published"),
            e["updated"].alias("updated"),
            F.transform(e["category"], lambda c: F.coalesce(c["_term"], F.lit(""))).alias("categories"),
            e["primary_category"]["_term"].alias("primary_category"),
            e["doi"].alias("doi"),
            e["journal_ref"].alias("journal_ref"),
            e["comment"].alias("comment"),
            link("alternate", "text/html").alias("abstract_url"),
            link("related", "application/pdf").alias("pdf_url"),
        )
    )


# Repository discovery.


def search_items(pages: DataFrame, value: str, *keep: str) -> DataFrame:
    """One row per item of each search page, in page order.

    A page that is null or broken has no rows here; ``search_coverage`` reports it.
    """
    parsed = pages.select(*keep, F.from_json(value, SEARCH_PAGE).alias("p"))
    items = parsed.select(*keep, F.posexplode_outer("p.items").alias("position", "item"))
    return items.where(F.col("position").isNotNull()).select(
        *keep, "position", F.col("item.id").alias("repo_id"), "item.full_name", "item.created_at"
    )


def repo_rows(items: DataFrame, *keep: str) -> DataFrame:
    """Repository rows of search items: an id and a slash in the name are required."""
    name = strip(F.coalesce(F.col("full_name"), F.lit("")))
    return items.where(
        F.col("repo_id").isNotNull() & (F.col("repo_id") != 0) & F.contains(name, F.lit("/"))
    ).select(
        *keep,
        "repo_id",
        name.alias("full_name"),
        owner_of(name).alias("owner"),
        name_of(name).alias("name"),
        iso_timestamp_date(F.col("created_at")).alias("created"),
    )


def repos_with_readme(repos: DataFrame, readmes: DataFrame) -> DataFrame:
    """README text next to its repository; a repository without one keeps a null."""
    return repos.join(readmes.select("full_name", "readme"), "full_name", "left")


def page_fault(payload: Column) -> Column:
    """Why a landed JSON page cannot be used: ``null page`` or ``broken page``; null when it can.

    Such a page holds no rows, so the coverage audits must not take it for a last page.
    """
    whole = F.json_object_keys(payload).isNotNull() | F.json_array_length(payload).isNotNull()
    absent = payload.isNull() | (strip(payload) == "null")
    return F.when(absent, F.lit("null page")).when(~whole, F.lit("broken page"))


def search_coverage(pages: DataFrame, value: str, *keep: str, hour_end: Column | None = None) -> DataFrame:
    """Per search page: whether the hour is finished, else the cursor to go on from.

    A full page continues one second after its last item; a short page, a last item
    without a usable time, or a cursor that reaches ``hour_end`` ends the hour. A page
    that is null or broken is an ``error`` and ends nothing.
    """
    items = F.from_json(value, SEARCH_PAGE)["items"]
    end = F.lit(None).cast("timestamp") if hour_end is None else hour_end
    parsed = pages.select(*keep, items.alias("items"), page_fault(F.col(value)).alias("error"), end.alias("__end"))
    last = F.try_to_timestamp(F.try_element_at("items", F.lit(-1))["created_at"])
    following = F.timestamp_seconds(F.unix_timestamp(last) + 1)
    inside = F.coalesce(following < F.col("__end"), F.lit(True))
    following = F.when((F.size("items") >= SEARCH_PAGE_SIZE) & inside, following)
    return parsed.select(
        *keep,
        F.coalesce(F.greatest(F.size("items"), F.lit(0)), F.lit(0)).alias("n_items"),
        following.alias("next_cursor"),
        (following.isNull() & F.col("error").isNull()).alias("hour_finished"),
        "error",
    )


# Daily activity.


def star_week_array(payload: Column) -> Column:
    """Weeks of a star page: a JSON list, or an object with the list in ``weeks``."""
    is_list = F.startswith(F.ltrim(payload), F.lit("["))
    return F.when(is_list, F.from_json(payload, STAR_WEEK)).otherwise(
        F.from_json(payload, f"struct<weeks:{STAR_WEEK}>")["weeks"]
    )


def star_days(pages: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Daily star counts of each page row by row: ``date`` and ``count``, positive days only.

    Days outside the row's ``scan_start .. scan_to`` are dropped; slots that are
    not numbers are skipped. A page that is null or broken has no rows here; ``star_coverage`` reports it.
    """
    low, high = F.unix_date("scan_start"), F.unix_date("scan_to")

    def dated(week: Column) -> Column:
        start = F.floor(week["week"].try_cast("bigint") / F.lit(86_400))
        return F.struct(start.alias("start"), F.slice(week["days"], 1, 7).alias("days"))

    # Weeks out of range go while they are still an array, one test a week instead of one a day.
    weeks = F.filter(F.transform(star_week_array(F.col(payload)), dated), lambda w: w["start"].between(low - 6, high))
    weeks = pages.select(*keep, low.alias("__low"), high.alias("__high"), F.explode(weeks).alias("__week"))
    days = weeks.select(*keep, "__low", "__high", F.col("__week.start").alias("__start"), F.posexplode("__week.days").alias("__slot", "__text"))
    day, text = F.col("__start") + F.col("__slot"), F.col("__text")
    # A failing cast costs far more than this test; whatever is above zero passes it.
    days = days.where(text.rlike(r"^\s*\+?[0-9]") & (text != "0") & day.between(F.col("__low"), F.col("__high")))
    counts = days.select(*keep, F.date_from_unix_date(day.cast("int")).alias("date"), text.try_cast("bigint").alias("count"))
    return counts.where(F.col("count") > 0)


def daily_star_counts(pages: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Weekly pages folded to one row per key and day."""
    return star_days(pages, payload, *keep).groupBy(*keep, "date").agg(F.sum("count").alias("count"))


def connection_nodes(pages: DataFrame, payload: str, *keep: str) -> DataFrame:
    """One row per dated node; a page without dated nodes keeps one row with a null date."""
    parsed = pages.select(
        *keep, "scan_start", "scan_to", F.from_json(payload, CONNECTION).alias("c")
    )
    dates = F.filter(
        F.transform("c.nodes", lambda n: iso_timestamp_date(n["createdAt"])), lambda d: d.isNotNull()
    )
    return parsed.select(
        *keep, "scan_start", "scan_to",
        F.coalesce("c.pageInfo.hasNextPage", F.lit(False)).alias("has_next"),
        F.col("c.pageInfo.endCursor").alias("end_cursor"),
        F.explode_outer(dates).alias("date"),
    )


def daily_connection_counts(pages: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Node time stamps folded to daily counts inside the scan range.

    A page that is null or broken has no rows here; ``connection_coverage`` reports it.
    """
    nodes = connection_nodes(pages, payload, *keep)
    return (
        nodes.where(F.col("date").between(F.col("scan_start"), F.col("scan_to")))
        .groupBy(*keep, "date")
        .agg(F.count("*").alias("count"))
    )


def connection_page_summary(pages: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Per page: oldest dated node, in range or not, and the paging flags."""
    parsed = pages.select(*keep, F.from_json(payload, CONNECTION).alias("c"))
    dates = F.transform("c.nodes", lambda n: iso_timestamp_date(n["createdAt"]))
    return parsed.select(
        *keep,
        F.array_min(dates).alias("oldest"),  # nulls are skipped
        F.coalesce("c.pageInfo.hasNextPage", F.lit(False)).alias("has_next"),
        F.col("c.pageInfo.endCursor").alias("end_cursor"),
    )


def star_coverage(pages: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Per star page (``page_no``): complete, next page, or failure.

    Too many pages fail, and so does a page that is null or broken.
    """
    weeks = star_week_array(F.col(payload))
    fault = page_fault(F.col(payload)).alias("__fault")
    parsed = pages.select(*keep, "scan_start", "page_no", weeks.alias("weeks"), fault)
    starts = F.transform(
        F.filter("weeks", lambda w: w["week"].isNotNull()), lambda w: epoch_date(w["week"])
    )
    more = F.coalesce(
        (F.size("weeks") >= STAR_PAGE_WEEKS) & (F.array_min(starts) > F.col("scan_start")), F.lit(False)
    )
    return _coverage(parsed.withColumn("__more", more), F.lit(None).cast("string"), *keep)


def connection_coverage(pages: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Per connection page: complete, next page, or failure.

    A missing cursor, too many pages, and a page that is null or broken fail.
    """
    flagged = pages.withColumn("__fault", page_fault(F.col(payload)))
    summary = connection_page_summary(flagged, payload, *keep, "scan_start", "page_no", "__fault")
    more = F.coalesce(F.col("has_next") & (F.col("oldest") > F.col("scan_start")), F.lit(False))
    lost = F.when(F.col("end_cursor").isNull() | (F.col("end_cursor") == ""), "missing cursor")
    return _coverage(summary.withColumn("__more", more), lost, *keep)


def _coverage(df: DataFrame, error: Column, *keep: str) -> DataFrame:
    more = F.col("__more")
    limit = F.when(F.col("page_no") >= MAX_PAGES, F.lit("page limit"))
    fault = F.coalesce(F.col("__fault"), F.when(more, F.coalesce(error, limit)))
    return df.select(
        *keep,
        "page_no",
        (~more & F.col("__fault").isNull()).alias("complete"),
        F.when(more & fault.isNull(), F.col("page_no") + 1).alias("next_page"),
        fault.alias("error"),
    )
