"""Work ledgers: what to do next, and how outcomes change a task."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litpulse.functions.text import clip
from litpulse.operators.merge import insert_missing, replace_by_key
from litpulse.schemas import METRICS

MAX_TRIES = 3
ERROR_CHARS = 500
RANK_ERROR_CHARS = 2000


def _where(status: str, value: Column) -> Column:
    return F.when(F.col("status") == status, value)


def next_day(ledger: DataFrame, day: str, target: dt.date) -> DataFrame:
    """Earliest running day, else earliest failed, else the day after the last completed.

    One row; null when the ledger has caught up with ``target``.
    """
    d = F.col(day)
    following = F.date_add(F.max(_where("completed", d)), 1)
    return ledger.agg(
        F.coalesce(
            F.min(_where("running", d)),
            F.min(_where("failed", d)),
            F.when(following <= F.lit(target), following),
        ).alias("next_day")
    )


def next_hour(ledger: DataFrame, target: dt.date) -> DataFrame:
    """Earliest running or failed hour, else the hour after the last completed one.

    Only a step into a new day is checked against the target day.
    """
    at = F.struct(F.col("task_date").alias("d"), F.col("task_hour").cast("int").alias("h"))
    pending = F.when(F.col("status").isin("running", "failed"), at)
    row = ledger.agg(F.min(pending).alias("p"), F.max(_where("completed", at)).alias("c"))
    tomorrow = F.date_add("c.d", 1)
    following = F.when(
        F.col("c.h") < 23, F.struct(F.col("c.d").alias("d"), (F.col("c.h") + 1).alias("h"))
    ).when(tomorrow <= F.lit(target), F.struct(tomorrow.alias("d"), F.lit(0).alias("h")))
    nxt = F.coalesce("p", following)
    return row.select(nxt["d"].alias("task_date"), nxt["h"].alias("task_hour"))


def next_snapshot(ledger: DataFrame, target: dt.date) -> DataFrame:
    """Latest running snapshot, else latest failed, else the target unless it is done."""
    d = F.col("snapshot_date")
    done = F.coalesce(F.max(_where("completed", d)) >= F.lit(target), F.lit(False))
    return ledger.agg(
        F.coalesce(
            F.max(_where("running", d)), F.max(_where("failed", d)), F.when(~done, F.lit(target))
        ).alias("next_snapshot")
    )


def day_anchor(anchors: DataFrame, target: dt.date) -> DataFrame:
    """Earliest running day, else the day after the last completed; failures are not a tier."""
    d = F.col("task_date")
    following = F.date_add(F.max(_where("completed", d)), 1)
    return anchors.agg(
        F.coalesce(
            F.min(_where("running", d)), F.when(following <= F.lit(target), following)
        ).alias("task_date")
    )


def round_anchor(rounds: DataFrame, now: Column) -> DataFrame:
    """Lowest running round with its locked snapshot time, else a new round at ``now``."""
    run = F.min(
        _where("running", F.struct(F.col("round_number").alias("n"), F.col("snapshot_at").alias("s")))
    )
    row = rounds.agg(run.alias("r"), F.coalesce(F.max("round_number"), F.lit(0)).alias("last"))
    return row.select(
        F.coalesce("r.n", F.col("last") + 1).alias("round_number"),
        F.coalesce(F.col("r.s"), now).alias("snapshot_at"),
        F.col("r").isNull().alias("is_new"),
    )


def latest_task(tasks: DataFrame) -> DataFrame:
    """The task with the latest date."""
    return tasks.orderBy(F.col("as_of_date").desc()).limit(1)


def latest_rounds(rounds: DataFrame, n: int = 5) -> DataFrame:
    return rounds.orderBy(F.col("round_number").desc()).limit(n)


def is_eligible(max_tries: int = MAX_TRIES) -> Column:
    """Running or failed, unless failed with its tries used up."""
    return F.col("status").isin("running", "failed") & ~(
        (F.col("status") == "failed") & (F.col("try_number") >= max_tries)
    )


def eligible_tasks(tasks: DataFrame, n: int | None = None, max_tries: int = MAX_TRIES) -> DataFrame:
    """The queue of one lane: fewest tries first, then the lower id; ``n`` for its head."""
    queue = tasks.where(is_eligible(max_tries)).orderBy("try_number", "id")
    return queue if n is None else queue.limit(n)


def fold_outcomes(
    tasks: DataFrame, outcomes: DataFrame, key: str = "id", max_tries: int = MAX_TRIES
) -> DataFrame:
    """Tasks after a batch of outcomes ``(key, seq, kind, error)``.

    ``completed`` ends the task; ``not_found`` fails it and counts a try;
    ``transient`` counts a try and fails it once the tries are used up;
    ``rate_limit`` changes nothing. The last outcome decides the state, every try
    counts, the last error text stays.
    """
    real = outcomes.where(F.col("kind") != "rate_limit")
    fault = F.col("kind").isin("not_found", "transient")
    folded = real.groupBy(key).agg(
        F.max_by("kind", "seq").alias("__last"),
        F.count_if(fault).cast("int").alias("__tries"),
        F.max_by(F.coalesce("error", F.lit("")), F.when(fault, F.col("seq"))).alias("__error"),
    )
    tries = F.col("try_number") + F.coalesce("__tries", F.lit(0))
    status = (
        F.when(F.col("__last").isNull(), F.col("status"))
        .when(F.col("__last") == "completed", F.lit("completed"))
        .when((F.col("__last") == "not_found") | (tries >= max_tries), F.lit("failed"))
        .otherwise(F.lit("running"))
    )
    error = F.coalesce(clip(F.col("__error"), ERROR_CHARS), F.col("error_msg"))
    replaced = {"status": status, "try_number": tries, "error_msg": error}
    return tasks.join(folded, key, "left").select(
        *(replaced[c].alias(c) if c in replaced else F.col(c) for c in tasks.columns)
    )


@dataclass(frozen=True)
class RunRules:
    """How a run ledger treats what it holds already."""

    #: A start clears end and counts of the run before.
    start_clears: bool = False
    #: A failure clears the end.
    failure_clears_end: bool = False
    #: A run first heard of by its failure starts at that time.
    failure_starts: bool = False
    #: Runs the ledger does not know are inserted.
    inserts: bool = True
    error_chars: int = ERROR_CHARS


PULL_LOG = RunRules(failure_starts=True)
RANK_LOG = RunRules()
CITATION_TASKS = RunRules(
    start_clears=True, failure_clears_end=True, inserts=False, error_chars=RANK_ERROR_CHARS
)


def apply_run_events(
    ledger: DataFrame, events: DataFrame, keys: Sequence[str], rules: RunRules = RANK_LOG
) -> DataFrame:
    """Run ledger after a batch of ``(keys, seq, status, at, row_counts, error)``, in the order of ``seq``.

    ``running`` sets the start and clears the error; ``completed`` sets end and counts
    and clears the error; ``failed`` stores the error text, cut. The rest, which differs
    between the ledgers, is in ``rules``; what no event touches stays.
    """
    s, seq = F.col("status"), F.col("seq")
    begun, done, failed = (s == x for x in ("running", "completed", "failed"))
    counted = done | begun if rules.start_clears else done
    ended = counted | failed if rules.failure_clears_end else counted
    # One aggregate: the last event that touches a column gives its value, which may be null.
    folded = events.groupBy(*keys).agg(
        F.max_by(s, seq).alias("__status"),
        F.max_by(F.when(failed, clip(F.col("error"), rules.error_chars)), seq).alias("__error"),
        F.max_by(F.col("at"), F.when(begun, seq)).alias("__start"),
        F.min_by(F.when(failed, F.col("at")), seq).alias("__failed_first"),
        F.coalesce(F.bool_or(ended), F.lit(False)).alias("__ended"),
        F.max_by(F.when(done, F.col("at")), F.when(ended, seq)).alias("__end"),
        F.coalesce(F.bool_or(counted), F.lit(False)).alias("__counted"),
        F.max_by(F.when(done, F.col("row_counts")), F.when(counted, seq)).alias("__counts"),
    )
    start = [F.col("__start"), F.col("started_at")]
    if rules.failure_starts:
        start.append(F.when(s.isNull(), F.col("__failed_first")))
    return ledger.join(folded, list(keys), "full_outer" if rules.inserts else "left").select(
        *keys,
        F.coalesce("__status", "status").alias("status"),
        F.coalesce(*start).alias("started_at"),
        F.when(F.col("__ended"), F.col("__end")).otherwise(F.col("completed_at")).alias("completed_at"),
        F.when(F.col("__counted"), F.col("__counts")).otherwise(F.col("row_counts")).alias("row_counts"),
        F.when(F.col("__status").isNull(), F.col("error_message")).otherwise(F.col("__error")).alias("error_message"),
    )


def set_status(anchors: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Anchors with their states flipped by the batch; unknown keys are inserted."""
    return replace_by_key(anchors, batch, keys)


def with_baseline(ledger: DataFrame, baseline: DataFrame) -> DataFrame:
    """The baseline rows once, when the ledger has no rows at all."""
    any_row = ledger.limit(1).select(F.lit(True).alias("__any"))
    first = baseline.withColumn("__any", F.lit(True)).join(any_row, "__any", "left_anti")
    return ledger.unionByName(first.drop("__any"))


def with_baseline_key(ledger: DataFrame, baseline: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The baseline row unless its key is there."""
    return insert_missing(ledger, baseline, keys)


def status_counts(ledger: DataFrame, *groups: str) -> DataFrame:
    """Tasks per state, or per group and state."""
    return ledger.groupBy(*groups, "status").agg(F.count("*").alias("n_tasks"))


def pending_count(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count_if(F.col("status").isin("running", "failed")).alias("n_pending"))


def day_range(ledger: DataFrame, day: str) -> DataFrame:
    return ledger.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def event_freshness(events: DataFrame) -> DataFrame:
    """Rows, first and last day per metric."""
    return events.groupBy("metric").agg(
        F.count("*").alias("n_rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )


def pending_metrics(tasks: DataFrame) -> DataFrame:
    """One row per task and metric not done yet, with the page to resume from."""
    steps = F.array(
        *(
            F.struct(
                F.lit(i).alias("step"),
                F.lit(m).alias("metric"),
                F.try_element_at("progress", F.lit(m)).alias("p"),
            )
            for i, m in enumerate(METRICS, start=1)
        )
    )
    open_steps = F.filter(steps, lambda s: ~F.coalesce(s["p"]["done"], F.lit(False)))
    return tasks.select("id", "repo_id", F.inline(open_steps)).select(
        "id", "repo_id", "step", "metric",
        F.coalesce("p.page", F.lit(1)).alias("page"), F.col("p.cursor").alias("cursor"),
    )
