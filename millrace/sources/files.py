"""JSON, CSV and text scans, and sinks. Schemas are always given, never inferred."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import strip


def strict_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A row for each line that is neither blank nor a ``#`` comment. A line that does not parse fails the query."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)"))
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def tolerant_jsonl(spark: SparkSession, path: str, schema: StructType, status: str | None = None, dropped: tuple[str, ...] = (), missing_ok: bool = False) -> DataFrame:
    """A row for each line that parses. Rows whose ``status`` is one of ``dropped`` go (null stays). With ``missing_ok``, a path
    that is not there is an empty table."""
    try:
        rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException as e:
        if not missing_ok or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.where(~F.coalesce(F.col(status).isin(*dropped), F.lit(False))) if status and dropped else rows


def changes(rows: DataFrame, status: str = "change_status", kept: tuple[str, ...] = ("NEW", "NEW_RECORD", "UPDATED")) -> DataFrame:
    return rows.where(F.col(status).isin(*kept))


def first_rows(rows: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first n rows in an order that the caller states; Spark's own has no meaning."""
    return rows.orderBy(*order).limit(n)


def csv(spark: SparkSession, path: str, schema: StructType, encoding: str = "UTF-8") -> DataFrame:
    """With a header line; values stripped, blank ones null."""
    rows = spark.read.schema(schema).options(header=True, encoding=encoding, escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, enforceSchema=True).csv(path)
    texts = [f.name for f in schema if f.dataType.typeName() == "string"]
    return rows.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in texts})


def csv_of_any_encoding(spark: SparkSession, path: str, schema: StructType, fallback: str = "ISO-8859-1") -> DataFrame:
    """CSV files with a header line that may be UTF-8 or not: a file with a line that is not is read by ``fallback``, whole.

    Header names are stripped and may stand in any order; all files must have the same header, and columns that ``schema`` does not name are left
    out. Values are stripped, blank ones null, what does not fit its type is null. A value cannot hold a line's end. Columns: schema, and ``__file``.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"))
    known = lines.groupBy("__file").agg(F.bool_and(F.is_valid_utf8("value")).alias("__utf8"))
    decoded = F.when(F.col("__utf8"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), fallback))
    text = lines.join(known, "__file").select("__file", F.regexp_replace(decoded, "^\ufeff|\r$", "").alias("value"))
    first = spark.read.text(path).head(1)
    if not first:
        return spark.createDataFrame([], schema.add("__file", "string"))
    header = first[0].value.lstrip("\ufeff").rstrip("\r")
    names = [n.strip().strip('"').strip() for n in header.split(",")]
    raw = ", ".join(f"`{n}` string" for n in names)
    rows = text.where((F.col("value") != header) & (F.trim("value") != "")).select("__file", F.from_csv("value", F.lit(raw), {"escape": '"'}).alias("r"))
    clean = lambda f: F.nullif(strip(F.col(f"r.`{f.name}`")), F.lit("")).try_cast(f.dataType).alias(f.name)
    return rows.select(*[clean(f) for f in schema if f.name in names], *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in names], "__file").select(*schema.names, "__file")


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def filled(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """``df`` with columns that it lacks; a column that is there keeps its nulls."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def first_present(df: DataFrame, *names: str) -> Column:
    """The first non-blank value among those of the columns that exist."""
    have = [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in names if c in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def role_parties(roles: dict[str, str]) -> Column:
    """Columns of names between semicolons as one array of struct<name, role>, in the columns' order, blanks dropped."""
    parts = []
    for column, role in roles.items():
        names = F.filter(F.transform(F.split(F.coalesce(F.col(column), F.lit("")), ";"), lambda n: F.trim(n)), lambda n: n != "")
        parts.append(_tagged(names, role))
    return F.flatten(F.array(*parts))


def _tagged(names: Column, role: str) -> Column:
    return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(role).alias("role")))


def blocks_of(df: DataFrame, text: str, heading: str, least: int = 1) -> DataFrame:
    """A row for each block of a text, split before every heading (a regular expression), with its place. Blocks under ``least``
    characters go."""
    pieces = F.transform(F.split(F.col(text), rf"(?={heading})"), lambda b: strip(b))
    exploded = df.select(*[c for c in df.columns if c != text], F.posexplode(pieces).alias("place", "block"))
    return exploded.where(F.length("block") >= least)


def write_export(df: DataFrame, *paths: str, columns: list[str], order: list[str] | None = None) -> None:
    """The columns in the given order as CSV files with headers, to each of the paths. The rows are sorted by ``order`` (all columns
    unless told) over all files, in the order of the files' names, so a second run writes the same; no task has all rows."""
    rows = df.select(*columns)
    rows = rows.repartitionByRange(*(order or columns)).sortWithinPartitions(*(order or columns))
    for path in paths:
        rows.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def write_json(df: DataFrame, path: str, order: list[str]) -> None:
    """Rows as JSON lines with their columns in the order of their names, sorted over all files: equal rows give equal bytes."""
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    df.repartitionByRange(*order).sortWithinPartitions(*order).select(line.alias("value")).write.mode("overwrite").text(path)


def json_array(spark: SparkSession, path: str, schema: StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """A row for each element of files that are JSON arrays of objects. What is no array, no object or lacks a required field fails the query."""
    if spark.read.text(path, wholetext=True).where(~F.ltrim("value").startswith("[")).limit(1).count():
        raise ValueError(f"{path} has a file that is no array")
    rows = spark.read.schema(schema).options(multiLine=True, mode="FAILFAST").json(path)
    for name in required:
        rows = rows.withColumn(name, F.when(F.col(name).isNotNull(), F.col(name)).otherwise(F.raise_error(F.lit(f"{name} is missing")).cast(schema[name].dataType)))
    return rows


def guarded(path: str, *outputs: str) -> str:
    """``path``, or ValueError if it is one of the run's own outputs or lies in one."""
    plain = lambda p: p.rstrip("/").removeprefix("file://").removeprefix("file:")
    for out in outputs:
        if plain(path) == plain(out) or plain(path).startswith(plain(out) + "/"):
            raise ValueError(f"{path} is an output of this run")
    return path


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    df.repartition(*by).write.mode("overwrite").partitionBy(*by).parquet(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
