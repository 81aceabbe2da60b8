"""Explicit schemas of the tables and of the landed payloads, as DDL."""

from __future__ import annotations

METRICS = "star", "fork", "issue", "pr"

VERSION = "struct<version:string,date:string,size:string,source_type:string>"

PAPERS = (
    "arxiv_id string, title string, abstract string, authors string, categories string,"
    " set_specs array<string>, submitter string, comments string, journal_ref string,"
    f" doi string, report_no string, license string, versions array<{VERSION}>,"
    " published_date string, datestamp string, oai_identifier string"
)
REPOS = "repo_id bigint, full_name string, owner string, name string, created date"
EDGES = "repo_id bigint, arxiv_id string, added boolean, date date"
# README texts as landed: ``landed`` is in milliseconds.
READMES = "repo_id bigint, readme string, landed bigint"
EVENTS = "repo_id bigint, metric string, date date, count bigint"
# Counts of one landed page: pages of a scan add up, a later scan replaces the day.
EVENT_PAGES = f"{EVENTS}, scan bigint, page int"
WORKS = (
    "work_id string, arxiv_id string, cited_by_count bigint, referenced_works_count int,"
    " publication_date date, publication_year int, is_oa boolean, oa_status string, type string,"
    " language string, authors_count int, primary_topic_name string, primary_topic_field string,"
    " primary_topic_domain string, is_retracted boolean, is_paratext boolean"
)
RANKING = (
    "snapshot_date date, window_name string, metric string, rank int, arxiv_id string,"
    " title string, metric_value bigint"
)
BRIDGE = "snapshot_date date, arxiv_id string, repo_id bigint"
LINKED_REPO = (
    "struct<repo_id:bigint,full_name:string,owner:string,star_total:bigint,"
    "fork_total:bigint,issue_total:bigint,pr_total:bigint>"
)
PAPER_DETAILS = (
    "snapshot_date date, arxiv_id string, title string, abstract string, authors string,"
    f" categories string, published_date string, datestamp string, linked_repos array<{LINKED_REPO}>,"
    " repo_chunks int, openalex_data string, repo_count int, star_max bigint, star_sum bigint, fork_max bigint,"
    " fork_sum bigint, issue_max bigint, issue_sum bigint, pr_max bigint, pr_sum bigint"
)
REPO_DETAILS = (
    "snapshot_date date, repo_id bigint, full_name string, owner string, star_total bigint,"
    " fork_total bigint, issue_total bigint, pr_total bigint,"
    " linked_papers array<struct<arxiv_id:string,title:string>>"
)
CITATION_RANKING = (
    "as_of_date date, window_name string, rank int, arxiv_id string, title string,"
    " cited_by_count bigint"
)
CITATION_DETAILS = (
    "as_of_date date, arxiv_id string, work_id string, title string, abstract string,"
    " authors string, categories string, published_date string, doi string, datestamp string,"
    " cited_by_count bigint, referenced_works_count int, openalex_publication_date date,"
    " publication_year int, type string, language string, is_oa boolean, oa_status string,"
    " authors_count int, primary_topic_name string, primary_topic_field string,"
    " primary_topic_domain string"
)
REPO_TASKS = (
    "id bigint, lane string, task_date date, round_number int, repo_id bigint, full_name string,"
    " scan_start date, scan_to date,"
    " progress map<string,struct<done:boolean,page:int,cursor:string>>,"
    " status string, try_number int, error_msg string"
)

# Landed payloads.
PAPER_PAGE = (
    "ListRecords struct<record:array<struct<"
    "header:struct<_status:string,identifier:string,datestamp:string,setSpec:array<string>>,"
    "metadata:struct<arXivRaw:struct<id:string,title:string,abstract:string,authors:string,"
    "categories:string,submitter:string,comments:string,`journal-ref`:string,doi:string,"
    "`report-no`:string,license:string,update_date:string,"
    "version:array<struct<_version:string,date:string,size:string,source_type:string>>>>>>,"
    "resumptionToken:string>,"
    "GetRecord struct<record:array<struct<"
    "header:struct<_status:string,identifier:string,datestamp:string,setSpec:array<string>>,"
    "metadata:struct<arXivRaw:struct<id:string,title:string,abstract:string,authors:string,"
    "categories:string,submitter:string,comments:string,`journal-ref`:string,doi:string,"
    "`report-no`:string,license:string,update_date:string,"
    "version:array<struct<_version:string,date:string,size:string,source_type:string>>>>>>>,"
    "error struct<_code:string,_VALUE:string>"
)
ATOM_FEED = (
    "entry struct<id:string,title:string,summary:string,published:string,updated:string,"
    "author:array<struct<name:string>>,category:array<struct<_term:string>>,"
    "primary_category:struct<_term:string>,doi:string,journal_ref:string,comment:string,"
    "link:array<struct<_rel:string,_type:string,_href:string>>>"
)
SEARCH_PAGE = "items array<struct<id:bigint,full_name:string,created_at:string>>"
STAR_WEEK = "array<struct<week:string,days:array<string>>>"
CONNECTION = (
    "pageInfo struct<hasNextPage:boolean,endCursor:string>,nodes array<struct<createdAt:string>>"
)
DATED_RECORD = "metadata struct<versions:array<struct<version:string,created:string>>>"
FULL_TEXT_RECORD = (
    "paper_id string,"
    " metadata struct<title:string,categories:string,update_date:string,"
    "authors_parsed:array<string>,versions:array<string>>,"
    " abstract struct<text:string>, sections map<string,string>,"
    " bib_entries map<string,string>, ref_entries map<string,string>"
)
