"""Evidence, conflicts between sources, and a review queue that remembers what was decided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import unique


def write_ledger(entries: DataFrame, id_col: str, path: str) -> None:
    """Entries as JSON lines in the order of their ids; an id that is there twice fails before anything is written."""
    from ..sources.files import write_json

    write_json(unique(entries, [id_col]), path, [id_col])


def summary(entries: DataFrame, record: str, status: str, statuses: list[str], source: str, primary: list[str], at: str) -> DataFrame:
    """Per record: entries, how many have each status (n_<status>), primary_sources (those of its sources that are primary, sorted) and last_verified (of the first status)."""
    counts = [F.count_if(F.col(status) == s).alias(f"n_{s}") for s in statuses]
    mine = F.array_sort(F.collect_set(F.when(F.col(source).isin(primary), F.col(source))))
    return entries.groupBy(record).agg(F.count(F.lit(1)).alias("entries"), *counts, mine.alias("primary_sources"), F.max(F.when(F.col(status) == statuses[0], F.col(at))).alias("last_verified"))


def conflicts(reports: DataFrame, key: str, fields: dict[str, tuple[str, float | None]]) -> DataFrame:
    """key, field, low, high: where reports of one key do not agree. ``fields`` says how: (``differ``, None) for any two values, (``by``, most) for numbers
    that are further apart, (``share``, most) for those further apart than a share of the larger. Null is no report. One minimum and maximum of each field decide."""
    ends = reports.groupBy(key).agg(*[f(c).alias(f"{n}_{c}") for c in fields for n, f in (("low", F.min), ("high", F.max))])

    def apart(c: str, how: str, most: float | None) -> Column:
        low, high = F.col(f"low_{c}"), F.col(f"high_{c}")
        return {"differ": lambda: low != high, "by": lambda: high - low > most, "share": lambda: high - low > most * F.abs(high)}[how]()

    marks = [F.when(apart(c, how, most), F.struct(F.lit(c).alias("field"), F.col(f"low_{c}").cast("string").alias("low"), F.col(f"high_{c}").cast("string").alias("high"))) for c, (how, most) in fields.items()]
    return ends.select(key, F.explode(F.array_compact(F.array(*marks))).alias("x")).select(key, "x.*")


def refreshed_queue(queue: DataFrame, current: DataFrame, id_col: str, run: Column) -> DataFrame:
    """The review queue (id, reasons, state, decision, since) after a run that found ``current`` (id, reasons; only records with reasons).

    state is ``open`` (to be decided), ``decided`` or ``cleared``. A decision stands while the reasons are among those that it was made on; a new reason opens the record again
    and keeps the decision to be seen. A record that was open and has no reasons any more is cleared by itself, and opened again if they come back. ``since`` is the
    run that brought the state. Reasons of decided records stay those of the decision; both tables have an id once.
    """
    old = queue.select(F.col(id_col).alias("id"), F.struct("reasons", "state", "decision", "since").alias("o"))
    new = current.select(F.col(id_col).alias("id"), F.array_sort(F.array_distinct("reasons")).alias("r")).where(F.size("r") > 0)
    both = old.join(new, "id", "full_outer")
    known = F.size(F.array_except("r", "o.reasons")) == 0
    state = (
        F.when(F.col("o").isNull(), "open")
        .when(F.col("r").isNull(), F.when(F.col("o.state") == "open", "cleared").otherwise(F.col("o.state")))
        .when(F.col("o.state") == "decided", F.when(known, "decided").otherwise("open"))
        .otherwise("open")
    )
    reasons = F.when(F.col("r").isNull() | (state == "decided"), F.col("o.reasons")).otherwise(F.col("r"))
    out = both.select("id", "o", reasons.alias("reasons"), state.alias("state"))
    return out.select(F.col("id").alias(id_col), "reasons", "state", "o.decision", F.when(F.col("state").eqNullSafe(F.col("o.state")), F.col("o.since")).otherwise(run).alias("since"))


def switched(rows: DataFrame, source: str, config: DataFrame, export: bool = False) -> DataFrame:
    """Rows of the sources that ``config`` (source, enabled, hidden) has not switched off; those of hidden ones go from an ``export`` as well. Sources that it does not name, and nulls, are on."""
    off = F.coalesce(~F.col("enabled"), F.lit(False)) | (F.coalesce(F.col("hidden"), F.lit(False)) if export else F.lit(False))
    return rows.join(config.where(off).select(F.col("source").alias("__off")).distinct(), F.col(source) == F.col("__off"), "left_anti")


def with_reasons(rules: dict[str, tuple[Column, float]], base: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """struct<score, reasons>: ``base`` and the points of the conditions that hold, and their sum between ``low`` and ``high``. reasons (array<struct<reason, points>>) is all that went into it,
    ``base`` and, if there was something to cut off, ``limit`` included, so it adds up."""
    held = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(n).alias("reason"), F.lit(float(p)).alias("points"))) for n, (c, p) in rules.items()]))
    all_of = F.concat(F.array(F.struct(F.lit("base").alias("reason"), F.coalesce(base.cast("double"), F.lit(0.0)).alias("points"))), held)
    total = F.aggregate(all_of, F.lit(0.0), lambda a, r: a + r["points"])
    score = F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), total))
    return F.struct(score.alias("score"), F.when(score == total, all_of).otherwise(F.concat(all_of, F.array(F.struct(F.lit("limit").alias("reason"), (score - total).alias("points"))))).alias("reasons"))


def adds_up(score: Column, reasons: Column) -> Column:
    """Whether the points of the reasons come to the score; null ones do not."""
    return F.coalesce(F.abs(F.aggregate(reasons, F.lit(0.0), lambda a, r: a + r["points"]) - score) < 1e-9, F.lit(False))
