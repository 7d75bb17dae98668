"""Per-company stage status: pending work, completion, reset and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from capledger.functions.numbers import percent
from capledger.operators.entities import key_of
from capledger.operators.ranking import global_rank

# Flag, completion time and counter of each stage.
STAGES = {
    1: ("stage1_resolved", "stage1_completed_at", None),
    2: ("stage2_sec_collected", "stage2_completed_at", "stage2_rounds_found"),
    3: ("stage3_search_extracted", "stage3_completed_at", "stage3_rounds_found"),
    4: ("stage4_merged", "stage4_completed_at", "stage4_unique_rounds"),
}


def companies_with_status(companies: DataFrame, status: DataFrame) -> DataFrame:
    """Companies that have a status row, with it."""
    return companies.join(
        status.drop("id", "created_at", "updated_at"), companies["id"] == status["company_id"]
    ).drop("company_id")


def companies_needing_stage(companies: DataFrame, status: DataFrame, stage: int) -> DataFrame:
    """Companies whose flag of ``stage`` is not set; any other stage number: all with a status."""
    todo = status
    if stage in STAGES:
        todo = status.where(~F.col(STAGES[stage][0]))
    return companies.join(
        todo.select(F.col("company_id").alias("id")), "id", "left_semi"
    ).select(companies.columns)


def pending_work(companies: DataFrame, status: DataFrame, stage: int) -> DataFrame:
    """(id, name) of the companies a stage still has to process."""
    return companies_needing_stage(companies, status, stage).select("id", "name")


def finished_counts(status: DataFrame, stage: int) -> DataFrame:
    """(company_id, count) recorded for companies whose ``stage`` is done."""
    flag, _, counter = STAGES[stage]
    return status.where(F.col(flag)).select("company_id", F.col(counter).alias("rounds_found"))


def initial_status(companies: DataFrame, now: Column) -> DataFrame:
    """Status rows of new companies: nothing done."""
    stage_columns = []
    for flag, at, counter in STAGES.values():
        stage_columns += [F.lit(False).alias(flag), F.lit(None).cast("timestamp").alias(at)]
        if counter:
            stage_columns.append(F.lit(0).alias(counter))
    return companies.select(
        key_of(F.lit("status"), F.col("id")).alias("id"), F.col("id").alias("company_id"),
        *stage_columns,
        F.lit(False).alias("has_errors"), F.lit(None).cast("string").alias("error_message"),
        F.lit(0).alias("retry_count"), now.alias("created_at"), now.alias("updated_at"),
    )


def apply_completions(
    status: DataFrame, log: DataFrame, stage: int
) -> DataFrame:
    """Status after a log of stage events (company_id, at, completed, counted).

    The latest event per company decides; an event that is not ``completed`` clears flag and
    time. Companies without a status row get one.
    """
    flag, at, counter = STAGES[stage]
    latest = log.groupBy(F.col("company_id").alias("event_company")).agg(
        F.max_by(F.struct("at", "completed", "counted"), F.struct("at", "completed", "counted")).alias("event")
    )
    touched = F.col("event").isNotNull()
    fresh = initial_status(
        latest.select(F.col("event_company").alias("id"), F.col("event.at").alias("seen_at")), F.col("seen_at")
    )
    missing = fresh.join(status.select("company_id"), "company_id", "left_anti").select(status.columns)
    joined = status.unionByName(missing).join(
        latest, F.col("company_id") == F.col("event_company"), "left"
    )
    changes = {
        flag: F.when(touched, F.col("event.completed")).otherwise(F.col(flag)),
        at: F.when(touched, F.when(F.col("event.completed"), F.col("event.at"))).otherwise(F.col(at)),
        "updated_at": F.when(touched, F.col("event.at")).otherwise(F.col("updated_at")),
    }
    if counter:
        changes[counter] = F.when(touched, F.col("event.counted").cast("int")).otherwise(F.col(counter))
    return joined.withColumns(changes).select(status.columns)


def latest_per_key(log: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The newest row of every key; of equal times the largest row."""
    rest = [c for c in log.columns if c not in keys and c != at]
    return log.groupBy(*keys).agg(F.max(F.struct(at, *rest)).alias("_newest")).select(*keys, "_newest.*")


def reset_status(status: DataFrame, stages: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """Clear flag, time and counter of the given stages; stage 1 is never reset."""
    changes = {}
    for stage in stages:
        if stage in (2, 3, 4):
            flag, at, counter = STAGES[stage]
            changes[flag] = F.lit(False)
            changes[at] = F.lit(None).cast("timestamp")
            changes[counter] = F.lit(0)
    return status.withColumns(changes) if changes else status


def processing_progress(companies: DataFrame, status: DataFrame) -> DataFrame:
    """One row: companies, and per stage the number and percentage done."""
    total = companies.agg(F.count("*").alias("total_companies"))
    done = status.agg(*[
        F.count_if(F.col(flag)).alias(f"stage{n}_completed") for n, (flag, _, _) in STAGES.items()
    ])
    one = F.lit(1).alias("one")
    joined = total.select("*", one).join(done.select("*", one), "one").drop("one")
    return joined.select("*", *[
        percent(F.col(f"stage{n}_completed"), F.col("total_companies")).alias(f"stage{n}_percent")
        for n in STAGES
    ])


def stage_totals(status: DataFrame) -> DataFrame:
    """(stage, companies, rounds): companies done and rounds counted by stages 2 to 4."""
    counted = status.agg(*[
        agg
        for n in (2, 3, 4)
        for agg in (
            F.count_if(F.col(STAGES[n][0])).alias(f"companies{n}"),
            F.coalesce(F.sum(F.when(F.col(STAGES[n][0]), F.col(STAGES[n][2]))), F.lit(0)).alias(f"rounds{n}"),
        )
    ])
    return counted.select(F.inline(F.array(*[
        F.struct(
            F.lit(n).alias("stage"), F.col(f"companies{n}").alias("companies"), F.col(f"rounds{n}").alias("rounds")
        )
        for n in (2, 3, 4)
    ])))


def running_progress(status: DataFrame, stage: int, every: int) -> DataFrame:
    """(completed, total, percent) after each ``every`` completions, in order of completion."""
    flag, at, _ = STAGES[stage]
    done = status.where(F.col(flag)).select("company_id", at)
    total = status.agg(F.count("*")).scalar()
    ranked = global_rank(done, [at, "company_id"], "completed").withColumn("total", total)
    return ranked.where(F.col("completed") % every == 0).select(
        "completed", "total", percent(F.col("completed"), F.col("total")).alias("percent")
    )
