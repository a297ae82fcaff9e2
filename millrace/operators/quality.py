"""Contracts, checks and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import header as counted


class ContractError(ValueError):
    """Rows break a contract."""


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Broken rules with the number of rows that break them, from one pass. A rule that is null for a row is broken."""
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"r{i}") for i, c in enumerate(rules.values())])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("broken")) for i, n in enumerate(rules)]))
    return counts.select(pairs.alias("x")).select("x.*").where("broken > 0")


def require(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df``, or ContractError with the broken rules."""
    if broken := violations(df, rules).collect():  # a row for each rule at most
        raise ContractError("; ".join(f"{r['rule']}: {r['broken']} rows" for r in broken))
    return df


def gate(df: DataFrame, invalid: dict[str, Column], doubtful: dict[str, Column], skipped: list[str] = ()) -> DataFrame:
    """A row for each check: check, offenders, outcome (PASS, INVALID, AMBIGUOUS, SKIPPED). Conditions mark the offenders."""
    checks = [(n, c, "INVALID") for n, c in invalid.items()] + [(n, c, "AMBIGUOUS") for n, c in doubtful.items()]
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"r{i}") for i, (_, c, _) in enumerate(checks)])
    rows = [F.struct(F.lit(n).alias("check"), F.col(f"r{i}").alias("offenders"), F.when(F.col(f"r{i}") == 0, "PASS").otherwise(kind).alias("outcome")) for i, (n, _, kind) in enumerate(checks)]
    rows += [F.struct(F.lit(n).alias("check"), F.lit(0).cast("long").alias("offenders"), F.lit("SKIPPED").alias("outcome")) for n in skipped]
    return counts.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def verdict(gated: DataFrame) -> str:
    """blocked if a check is INVALID, else review if one is AMBIGUOUS, else ok."""
    seen = {r["outcome"] for r in gated.select("outcome").distinct().collect()}
    return "blocked" if "INVALID" in seen else "review" if "AMBIGUOUS" in seen else "ok"


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks, repeats counted, with ``side``. Empty if both hold the same rows."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def offenders(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """check and key of each row that a check's condition marks; a row with several marks has a row for each."""
    marks = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]))
    return df.select(F.explode(marks).alias("check"), key)


def action(gated: DataFrame, override: str | None = None) -> DataFrame:
    """One row: verdict (see ``verdict``), action (the operator's ``override``, if there is one, else the verdict) and the names of the failed checks in order."""
    failed = F.array_sort(F.collect_list(F.when(F.col("outcome").isin("INVALID", "AMBIGUOUS"), F.col("check"))))
    out = gated.agg(F.max(F.when(F.col("outcome") == "INVALID", 2).when(F.col("outcome") == "AMBIGUOUS", 1).otherwise(0)).alias("worst"), failed.alias("failed"))
    name = F.when(F.col("worst") == 2, "blocked").when(F.col("worst") == 1, "review").otherwise("ok")
    return out.select(name.alias("verdict"), (F.lit(override) if override else name).alias("action"), "failed")


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, or ContractError if a key is there twice."""
    if twice := duplicate_keys(df, keys).limit(5).collect():
        raise ContractError("repeated keys, such as " + ", ".join(str(tuple(r[k] for k in keys)) for r in twice))
    return df


def header_mismatch(df: DataFrame, header: DataFrame, columns: list[str]) -> DataFrame:
    """column, value, stated, counted: where a stored header (see ``aggregates.header``) is not that of the rows. Empty if it is; a value that one side lacks counts as none there."""
    names = ["column", "value"]
    stated = header.groupBy(*names).agg(F.sum("n").alias("stated"))
    fresh = counted(df, columns).withColumnRenamed("n", "counted")
    same = [stated[c].eqNullSafe(fresh[c]) for c in names]
    both = stated.join(fresh, same, "full_outer").select(*[F.coalesce(stated[c], fresh[c]).alias(c) for c in names], F.coalesce("stated", F.lit(0)).alias("stated"), F.coalesce("counted", F.lit(0)).alias("counted"))
    return both.where("stated <> counted")
