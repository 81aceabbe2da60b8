"""Registered queries: ledgers, queues and run states."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from litpulse.catalog.bindings import (
    EDGES, EVENTS, PAPERS, REPOS, as_id, edges, events, papers, repos, table, with_,
)
from litpulse.catalog.registry import query
from litpulse.operators import ledger, quality
from litpulse.plans import queues
from litpulse.sources.tables import side_by_side, tagged_union
from litpulse.sources.tables import tagged_union

DAY = dt.date(2001, 6, 1)
TARGET = dt.date(2001, 9, 1)


# Tasks derived from orders: state from the order status, tries from the key.


def tasks(spark, sf):
    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "running")
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        key.alias("id"),
        F.when(key % 2 == 0, "p0").otherwise("p2").alias("lane"),
        day.alias("task_date"),
        F.when(key % 2 == 0, 0).otherwise((key % 7).cast("int")).cast("int").alias("round_number"),
        F.pmod(F.col("o_custkey") * 31 + key, F.lit(2000)).alias("repo_id"),
        F.concat(F.lit("o/"), as_id("o_custkey")).alias("full_name"),
        F.date_sub(day, 30).alias("scan_start"),
        day.alias("scan_to"),
        status_or_done(status).alias("status"),
        (key % 5).cast("int").alias("try_number"),
        F.lit(None).cast("string").alias("error_msg"),
    )


def status_or_done(c):
    return F.coalesce(c, F.lit("completed"))


TASKS = """tasks AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'p0' ELSE 'p2' END AS lane,
    CAST(o_orderdate AS DATE) AS task_date,
    CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_orderkey % 7 END AS round_number,
    (o_custkey * 31 + o_orderkey) % 2000 AS repo_id, 'o/' || o_custkey AS full_name,
    CAST(o_orderdate AS DATE) - 30 AS scan_start, CAST(o_orderdate AS DATE) AS scan_to,
    CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'running' ELSE 'completed' END AS status,
    o_orderkey % 5 AS try_number
  FROM orders)"""


def _ledger(spark, sf, *states):
    return tasks(spark, sf).where(F.col("status").isin(*states))


@query(
    "next_day",
    with_(TASKS)
    + f"""SELECT (SELECT MIN(task_date) FROM tasks WHERE status = 'running') AS all_states,
      (SELECT MIN(task_date) FROM tasks WHERE status = 'failed') AS no_running,
      (SELECT CASE WHEN MAX(task_date) + 1 <= DATE '{TARGET}' THEN MAX(task_date) + 1 END FROM tasks
        WHERE status = 'completed') AS only_completed,
      (SELECT CASE WHEN MAX(task_date) + 1 <= MAX(task_date) THEN MAX(task_date) END FROM tasks
        WHERE status = 'completed') AS caught_up""",
)
def _(spark, sf):
    done = _ledger(spark, sf, "completed")
    last = done.agg(F.max("task_date")).first()[0]
    parts = {
        "all_states": ledger.next_day(tasks(spark, sf), "task_date", TARGET),
        "no_running": ledger.next_day(_ledger(spark, sf, "failed", "completed"), "task_date", TARGET),
        "only_completed": ledger.next_day(done, "task_date", TARGET),
        "caught_up": ledger.next_day(done, "task_date", last),
    }
    return _one_row({n: df.withColumnRenamed("next_day", n) for n, df in parts.items()})


def _one_row(parts):
    return side_by_side(parts.values())


def _hours(spark, sf, *states):
    return _ledger(spark, sf, *states).select(
        "task_date", (F.col("id") % 24).cast("int").alias("task_hour"), "status"
    )


@query(
    "next_hour",
    with_(TASKS)
    + f"""SELECT * FROM (SELECT 'pending' AS kind, task_date, id % 24 AS task_hour FROM tasks
        WHERE status IN ('running', 'failed') ORDER BY 2, 3 LIMIT 1)
    UNION ALL SELECT 'completed', CASE WHEN h < 23 THEN d WHEN d + 1 <= DATE '{TARGET}' THEN d + 1 END,
      CASE WHEN h < 23 THEN h + 1 WHEN d + 1 <= DATE '{TARGET}' THEN 0 END
    FROM (SELECT task_date AS d, id % 24 AS h FROM tasks WHERE status = 'completed' ORDER BY 1 DESC, 2 DESC LIMIT 1)
    UNION ALL SELECT 'last_hour', MAX(task_date) + 1, 0 FROM tasks WHERE status = 'completed'""",
)
def _(spark, sf):
    done = _hours(spark, sf, "completed")
    frames = {
        "pending": ledger.next_hour(_hours(spark, sf, "running", "failed", "completed"), TARGET),
        "completed": ledger.next_hour(done, TARGET),
        "last_hour": ledger.next_hour(done.withColumn("task_hour", F.lit(23)), TARGET),
    }
    return tagged_union(frames, "kind")


@query(
    "next_snapshot",
    with_(TASKS)
    + f"""SELECT (SELECT MAX(task_date) FROM tasks WHERE status = 'running') AS all_states,
      (SELECT MAX(task_date) FROM tasks WHERE status = 'failed') AS no_running,
      (SELECT CASE WHEN MAX(task_date) < DATE '{TARGET}' THEN DATE '{TARGET}' END FROM tasks
        WHERE status = 'completed') AS only_completed,
      (SELECT CASE WHEN MAX(task_date) < DATE '{DAY}' THEN DATE '{DAY}' END FROM tasks
        WHERE status = 'completed') AS done""",
)
def _(spark, sf):
    def snap(target, *states):
        rows = _ledger(spark, sf, *states).withColumnRenamed("task_date", "snapshot_date")
        return ledger.next_snapshot(rows, target)

    parts = {
        "all_states": snap(TARGET, "running", "failed", "completed"),
        "no_running": snap(TARGET, "failed", "completed"),
        "only_completed": snap(TARGET, "completed"),
        "done": snap(DAY, "completed"),
    }
    return _one_row({n: df.withColumnRenamed("next_snapshot", n) for n, df in parts.items()})


@query(
    "work_anchors",
    with_(TASKS)
    + f"""SELECT (SELECT MIN(task_date) FROM tasks WHERE status = 'running') AS running_day,
      (SELECT CASE WHEN MAX(task_date) + 1 <= DATE '{TARGET}' THEN MAX(task_date) + 1 END FROM tasks
        WHERE status = 'completed') AS next_day,
      (SELECT MIN(id) FROM tasks WHERE status = 'running') AS running_round,
      (SELECT task_date FROM tasks WHERE status = 'running' ORDER BY id LIMIT 1) AS locked_day,
      (SELECT MAX(id) + 1 FROM tasks WHERE status = 'completed') AS new_round, TRUE AS is_new""",
)
def _(spark, sf):
    def rounds(*states):
        return _ledger(spark, sf, *states).select(
            F.col("id").alias("round_number"), F.col("task_date").alias("snapshot_at"), "status"
        )

    now = F.lit(TARGET)
    return _one_row(
        {
            "a": ledger.day_anchor(tasks(spark, sf), TARGET).select(F.col("task_date").alias("running_day")),
            "b": ledger.day_anchor(_ledger(spark, sf, "failed", "completed"), TARGET).select(F.col("task_date").alias("next_day")),
            "c": ledger.round_anchor(rounds("running", "completed"), now).select(
                F.col("round_number").alias("running_round"), F.col("snapshot_at").alias("locked_day")
            ),
            "d": ledger.round_anchor(rounds("completed"), now).select(
                F.col("round_number").alias("new_round"), "is_new"
            ),
        }
    )


@query(
    "eligible_tasks",
    with_(TASKS)
    + """SELECT id, status, try_number FROM tasks WHERE status IN ('running', 'failed')
      AND NOT (status = 'failed' AND try_number >= 3)""",
)
def _(spark, sf):
    return ledger.eligible_tasks(tasks(spark, sf)).select("id", "status", "try_number")


@query(
    "next_task_per_lane",
    with_(TASKS)
    + """SELECT lane, id FROM tasks WHERE status IN ('running', 'failed')
      AND NOT (status = 'failed' AND try_number >= 3)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY lane ORDER BY try_number, id) = 1""",
)
def _(spark, sf):
    rows = tasks(spark, sf)
    p0, p2 = (ledger.eligible_tasks(rows.where(F.col("lane") == lane), 1).select("lane", "id") for lane in ("p0", "p2"))
    return p0.unionByName(p2)


# Outcomes derived from line items: one per line, the line number is the order in time.


@query(
    "task_outcomes",
    with_(TASKS)
    + """, o AS (SELECT l_orderkey AS id, l_linenumber * 10000000 + l_partkey * 1000 + l_suppkey AS seq,
        CASE WHEN l_returnflag = 'A' THEN 'completed' WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'not_found'
             WHEN l_returnflag = 'R' THEN 'transient' ELSE 'rate_limit' END AS kind, l_partkey AS part FROM lineitem),
    f AS (SELECT id, arg_max(kind, seq) AS last, COUNT(*) FILTER (WHERE kind <> 'completed') AS tries,
            'part ' || arg_max(part, seq) FILTER (WHERE kind <> 'completed') AS err
          FROM o WHERE kind <> 'rate_limit' GROUP BY id)
    SELECT t.id, t.try_number + COALESCE(f.tries, 0) AS try_number, f.err AS error_msg,
      CASE WHEN f.last IS NULL THEN t.status WHEN f.last = 'completed' THEN 'completed'
           WHEN f.last = 'not_found' OR t.try_number + f.tries >= 3 THEN 'failed' ELSE 'running' END AS status
    FROM tasks t LEFT JOIN f ON f.id = t.id""",
)
def _(spark, sf):
    flag, state = F.col("l_returnflag"), F.col("l_linestatus")
    kind = (
        F.when(flag == "A", "completed").when((flag == "R") & (state == "O"), "not_found")
        .when(flag == "R", "transient").otherwise("rate_limit")
    )
    outcomes = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        (F.col("l_linenumber") * 10000000 + F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("seq"),
        kind.alias("kind"), F.concat(F.lit("part "), as_id("l_partkey")).alias("error"),
    )
    return ledger.fold_outcomes(tasks(spark, sf), outcomes).select("id", "try_number", "error_msg", "status")


# A run per customer; its orders are the run events, in order of their key. Each kind of ledger has its rules.

RUN_LEDGERS = {"pull": ledger.PULL_LOG, "rank": ledger.RANK_LOG, "citation": ledger.CITATION_TASKS}


@query(
    "run_states",
    """WITH rules(ledger, start_clears, failure_clears_end, failure_starts, inserts) AS (VALUES
      ('pull', FALSE, FALSE, TRUE, TRUE), ('rank', FALSE, FALSE, FALSE, TRUE), ('citation', TRUE, TRUE, FALSE, FALSE)),
    ev AS (SELECT o_custkey AS run, o_orderkey AS seq, CAST(o_orderdate AS DATE) AS day,
      CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'failed' ELSE 'completed' END AS status FROM orders),
    f AS (SELECT ledger, run, arg_max(status, seq) AS status, MAX(seq) AS seq,
        arg_max(day, seq) FILTER (WHERE status = 'running') AS began,
        arg_min({'day': CASE WHEN status = 'failed' THEN day END}, seq) AS opening,
        arg_max({'day': CASE WHEN status = 'completed' THEN day END}, seq) FILTER (WHERE status = 'completed'
          OR (start_clears AND status = 'running') OR (failure_clears_end AND status = 'failed')) AS fin,
        arg_max({'n': CASE WHEN status = 'completed' THEN seq END}, seq) FILTER (WHERE status = 'completed'
          OR (start_clears AND status = 'running')) AS cnt
      FROM ev, rules GROUP BY ledger, run)
    SELECT r.ledger, c_custkey AS run, COALESCE(f.status, 'running') AS status,
      COALESCE(f.began, CASE WHEN c_custkey % 2 = 0 THEN DATE '1990-01-01' WHEN r.failure_starts THEN f.opening.day END) AS started_at,
      CASE WHEN f.fin IS NOT NULL THEN f.fin.day WHEN c_custkey % 2 = 0 THEN DATE '1991-01-01' END AS completed_at,
      CASE WHEN f.cnt IS NOT NULL THEN f.cnt.n WHEN c_custkey % 2 = 0 THEN 7 END AS n_rows,
      CASE WHEN f.status IS NULL THEN 'old' WHEN f.status = 'failed' THEN 'order ' || f.seq END AS error_message
    FROM (SELECT * FROM customer, rules) r LEFT JOIN f ON f.run = c_custkey AND f.ledger = r.ledger
    WHERE c_custkey % 2 = 0 OR (f.run IS NOT NULL AND r.inserts)""",
)
def _(spark, sf):
    counts = F.create_map(F.lit("ranking"), F.lit(7).cast("bigint"))
    stored = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("run"), F.lit("running").alias("status"),
        F.lit("1990-01-01").cast("date").alias("started_at"), F.lit("1991-01-01").cast("date").alias("completed_at"),
        counts.alias("row_counts"), F.lit("old").alias("error_message"),
    )
    state = F.when(F.col("o_orderstatus") == "O", "running").when(F.col("o_orderstatus") == "F", "failed")
    run_events = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("seq"),
        F.coalesce(state, F.lit("completed")).alias("status"), F.to_date("o_orderdate").alias("at"),
        F.create_map(F.lit("ranking"), F.col("o_orderkey")).alias("row_counts"),
        F.concat(F.lit("order "), as_id("o_orderkey")).alias("error"),
    )
    folded = {name: ledger.apply_run_events(stored, run_events, ["run"], rules) for name, rules in RUN_LEDGERS.items()}
    return tagged_union(folded, "ledger").select(
        "ledger", "run", "status", "started_at", "completed_at",
        F.try_element_at("row_counts", F.lit("ranking")).alias("n_rows"), "error_message",
    )


@query(
    "anchor_states",
    """SELECT o_orderkey AS task, CASE WHEN o_orderkey % 3 = 0 THEN 'completed' ELSE 'running' END AS status FROM orders""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task"), F.lit("running").alias("status"))
    stored = rows.where("task % 2 = 0 OR task % 3 <> 0")
    return ledger.set_status(stored, rows.where("task % 3 = 0").withColumn("status", F.lit("completed")), ["task"])


@query(
    "baseline_rows",
    f"""SELECT o_orderkey AS task, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey > 0
    UNION ALL SELECT 0, DATE '{DAY}' UNION ALL SELECT -1, DATE '{DAY}'""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task"), F.to_date("o_orderdate").alias("day"))

    def base(task):
        return spark.range(1).select(F.lit(task).cast("bigint").alias("task"), F.lit(DAY).alias("day"))

    stored = rows.where("task > 0")
    kept = ledger.with_baseline(stored, base(-9))  # not empty: nothing is added
    keyed = ledger.with_baseline_key(ledger.with_baseline_key(kept, base(0), ["task"]), base(1), ["task"])
    first = ledger.with_baseline(rows.where("task < 0"), base(-1))  # empty: the baseline is added
    return keyed.unionByName(first)


@query(
    "status_counts",
    with_(TASKS) + "SELECT lane, status, COUNT(*) AS n_tasks FROM tasks GROUP BY 1, 2",
)
def _(spark, sf):
    return ledger.status_counts(tasks(spark, sf), "lane")


@query(
    "ledger_summary",
    with_(TASKS)
    + """SELECT COUNT(*) FILTER (WHERE status IN ('running', 'failed')) AS n_pending,
      MIN(task_date) AS first_day, MAX(task_date) AS last_day FROM tasks""",
)
def _(spark, sf):
    rows = tasks(spark, sf)
    return _one_row({"a": ledger.pending_count(rows), "b": ledger.day_range(rows, "task_date")})


@query(
    "event_freshness",
    with_(EVENTS)
    + "SELECT metric, COUNT(*) AS n_rows, MIN(date) AS first_day, MAX(date) AS last_day FROM events_long GROUP BY 1",
)
def _(spark, sf):
    return ledger.event_freshness(events(spark, sf))


@query(
    "latest_task_and_rounds",
    with_(TASKS)
    + """, r AS (SELECT id, task_date FROM tasks ORDER BY id DESC LIMIT 5)
    SELECT 'round' AS kind, id AS n FROM r
    UNION ALL SELECT 'task', datediff('day', DATE '1990-01-01', MAX(task_date)) FROM tasks""",
)
def _(spark, sf):
    rows = tasks(spark, sf)
    days = F.datediff("as_of_date", F.lit("1990-01-01").cast("date")).cast("bigint")
    latest = ledger.latest_task(rows.withColumnRenamed("task_date", "as_of_date"))
    rounds = ledger.latest_rounds(rows.select(F.col("id").alias("round_number")))
    return rounds.select(F.lit("round").alias("kind"), F.col("round_number").alias("n")).unionByName(
        latest.select(F.lit("task").alias("kind"), days.alias("n"))
    )


@query(
    "task_state_check",
    with_(TASKS) + "SELECT 'status' AS rule, COUNT(*) FILTER (WHERE status = 'failed') AS violations FROM tasks",
)
def _(spark, sf):
    # Failed tasks are given a state that the table does not allow.
    rows = tasks(spark, sf).withColumn(
        "status", F.when(F.col("status") == "failed", "lost").otherwise(F.col("status"))
    )
    return quality.task_state_violations(rows)


@query(
    "key_check",
    """SELECT 'primary_key' AS rule, COUNT(*) AS violations FROM (
      SELECT l_partkey, l_orderkey FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1)""",
)
def _(spark, sf):
    return quality.check_key(edges(spark, sf), ["repo_id", "arxiv_id"])


@query(
    "pending_metrics",
    """WITH m AS (SELECT o_orderkey AS id, unnest([1, 2, 3, 4]) AS step,
        unnest(['star', 'fork', 'issue', 'pr']) AS metric FROM orders)
    SELECT id, CAST(step AS BIGINT) AS step, metric,
      CASE WHEN metric = 'fork' THEN id % 9 + 1 ELSE 1 END AS page,
      CASE WHEN metric = 'fork' THEN 'c' || id END AS cursor
    FROM m WHERE NOT (metric = 'star' AND id % 2 = 0)""",
)
def _(spark, sf):
    key = F.col("o_orderkey")

    def state(done, page, cursor):
        return F.struct(
            done.alias("done"), page.cast("int").alias("page"), cursor.cast("string").alias("cursor")
        )

    progress = F.create_map(
        F.lit("star"), state(key % 2 == 0, F.lit(None), F.lit(None)),
        F.lit("fork"), state(F.lit(False), key % 9 + 1, F.concat(F.lit("c"), as_id("o_orderkey"))),
    )
    rows = table(spark, sf, "orders").select(
        key.alias("id"), F.col("o_custkey").alias("repo_id"), progress.alias("progress")
    )
    return ledger.pending_metrics(rows).drop("repo_id")


# Queues.

LAST_SCAN = """last_scan AS (SELECT lane, repo_id, MAX(scan_to) AS d FROM tasks WHERE status = 'completed' GROUP BY 1, 2)"""


@query(
    "last_scans",
    with_(TASKS, LAST_SCAN) + "SELECT repo_id, d AS last_scan FROM last_scan WHERE lane = 'p0'",
)
def _(spark, sf):
    return queues.last_scans(tasks(spark, sf), "p0")


@query(
    "repos_with_recent_papers",
    with_(EDGES, PAPERS)
    + f"""SELECT DISTINCT e.repo_id FROM edges e JOIN papers p ON p.arxiv_id = e.arxiv_id
    WHERE e.added AND p.paper_date BETWEEN DATE '{DAY}' - 14 AND DATE '{DAY}'""",
)
def _(spark, sf):
    return queues.repos_with_recent_papers(edges(spark, sf), papers(spark, sf), DAY)


def _queue_sql(extra: str, unit: str, lane: str, body: str) -> str:
    return (
        with_(EDGES, PAPERS, REPOS, TASKS, LAST_SCAN)
        + f"""SELECT '{lane}' AS lane, DATE '{DAY}' AS task_date, {body}
    FROM repos f LEFT JOIN last_scan s ON s.repo_id = f.repo_id AND s.lane = '{lane}'
    WHERE {extra}
      AND NOT EXISTS (SELECT 1 FROM tasks t WHERE t.repo_id = f.repo_id AND t.lane = '{lane}' AND {unit})
      AND NOT EXISTS (SELECT 1 FROM tasks t WHERE t.repo_id = f.repo_id AND t.status = 'failed'
                      AND t.task_date >= DATE '{DAY}' - 30)"""
    )


@query(
    "recent_queue",
    _queue_sql(
        f"""f.created <= DATE '{DAY}' AND EXISTS (SELECT 1 FROM edges e JOIN papers p ON p.arxiv_id = e.arxiv_id
        WHERE e.repo_id = f.repo_id AND e.added AND p.paper_date BETWEEN DATE '{DAY}' - 14 AND DATE '{DAY}')""",
        f"t.task_date = DATE '{DAY}' AND t.round_number = 0",
        "p0",
        f"""CAST(0 AS BIGINT) AS round_number, f.repo_id, f.full_name,
        COALESCE(s.d + 1, LEAST(f.created, DATE '{DAY}'), DATE '{DAY}') AS scan_start, DATE '{DAY}' AS scan_to""",
    )
    + "\n    ORDER BY f.created DESC NULLS LAST, f.repo_id LIMIT 50000",
)
def _(spark, sf):
    return queues.recent_queue(
        repos(spark, sf), edges(spark, sf), papers(spark, sf), tasks(spark, sf), DAY
    )


@query(
    "round_queue",
    _queue_sql(
        f"""(f.created IS NULL OR f.created <= DATE '{DAY}')
        AND COALESCE(s.d, f.created - 1, DATE '{DAY}' - 1) < DATE '{DAY}'""",
        "t.round_number = 3",
        "p2",
        f"""CAST(3 AS BIGINT) AS round_number, f.repo_id, f.full_name,
        COALESCE(s.d + 1, f.created, DATE '{DAY}') AS scan_start, DATE '{DAY}' AS scan_to""",
    )
    + "\n    ORDER BY COALESCE(s.d, DATE '1970-01-01'), f.created DESC NULLS LAST, f.repo_id LIMIT 50000",
)
def _(spark, sf):
    return queues.round_queue(repos(spark, sf), tasks(spark, sf), 3, DAY)
