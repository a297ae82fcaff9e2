"""What the operators of this subpackage share: the shared folder, cut lineage, joins of a checked size, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which the small side of a join is broadcast; beyond them the join is salted.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
#: Copies of the small side of a salted join, and rows of a key from which ``weighed_join`` salts it.
SALTS, HOT = 32, 1000
#: ASCII white space, as Java, RE2 and Python regular expressions read it.
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where that is unset, a local session (as in tests) gets a new
    folder of its machine; on a cluster that is an error, since its machines would not see each other's."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends there, and a lost executor loses nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _width(df: DataFrame) -> Column:
    """Bytes of a row, about."""
    out = F.lit(8 * len(df.columns)).cast("long")
    for f in df.schema:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            out = out + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array", "map"):
            out = out + 16 * F.coalesce(F.size(c), F.lit(0))
    return out


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that Spark must not broadcast by its own estimate: that is of compressed files, and does not see how many rows
    an explode makes of one."""
    return df.hint("merge")


def sized_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """Equi-join that no hot key slows down: ``small`` is broadcast if it has BROADCAST_ROWS rows and BROADCAST_BYTES bytes at most (both
    counted; who gives ``rows`` vouches for columns of fixed width); beyond that, ``small`` is repeated for each of SALTS salts and the rows of ``big`` are dealt over them.

    ``how`` is inner, left, left_semi or left_anti. Null keys match nothing. The salt is a hash of the whole row, so that a task that
    runs again deals its rows out as before.
    """
    if rows is None:
        rows, size = small.agg(F.count(F.lit(1)), F.sum(_width(small))).first()
    else:
        size = 0
    if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), keys, how)
    salted = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = big.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(SALTS)).cast("int"))
    return dealt.join(shuffled(salted), [*keys, "__salt"], how).drop("__salt")


def weighed_join(big: DataFrame, small: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Inner equi-join to ``small``, which has each key once and tells in column ``weight`` how many rows of ``big`` have it.

    Keys of over HOT rows (one in HOT rows of ``big`` at most) go by ``sized_join``, so their rows stay where they are; the others are
    joined by a plain shuffle, in which no key has more than HOT rows."""
    hot = small.where(F.col(weight) > HOT).withColumn("__hot", F.lit(True))
    marked = sized_join(big, hot, keys, "left")
    cool = marked.where("__hot is null").select(*big.columns).join(shuffled(small.where(F.col(weight) <= HOT)), keys)
    return marked.where("__hot").drop("__hot").unionByName(cool)


def each_of(df: DataFrame, times: str, nth: str, chunk: int = 10_000) -> DataFrame:
    """A row of ``df`` as often as its column ``times`` says, numbered from 0 in column ``nth``; without ``times``.

    Rows that stand for over ``chunk`` are dealt out in chunks first, so one that fills a third of a table is no single task's work.
    """
    zero, rest = F.lit(0).cast("long"), [f"`{c}`" for c in df.columns if c != times]
    few = df.where(F.col(times) <= chunk).select(*rest, F.explode(F.sequence(zero, F.col(times) - 1)).alias(nth))
    step = F.explode(F.sequence(zero, F.col(times) - 1, F.lit(chunk).cast("long"))).alias("__step")
    many = df.where(F.col(times) > chunk).select("*", step)
    many = many.repartition(*[F.col(c) for c in rest], "__step")
    last = F.least(F.col("__step") + chunk, F.col(times)) - 1
    return few.unionByName(many.select(*rest, F.explode(F.sequence(F.col("__step"), last)).alias(nth)))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list by alternating large-star and small-star steps.

    Returns node, root (the smallest node of its component) for each node that has an edge. Each step is a group minimum and
    a join back, and the edges are cut to the shared folder after each round, so no group is ever gathered in one place.
    Self loops and repeated edges change nothing; no edges give no rows.
    """

    def stars(e: DataFrame, large: bool) -> DataFrame:
        lo, hi = F.least("a", "b"), F.greatest("a", "b")
        if large:
            pairs = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        else:
            pairs = e.select(hi.alias("u"), lo.alias("v"))
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = sized_join(pairs, least, ["u"])
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        return out.where("a != b").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct(), "edges")
    seen = None
    while (now := mark(e)) != seen:
        seen = now
        if not now[0]:
            break
        e = cut(stars(cut(stars(e, True), "edges"), False), "edges")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b")).groupBy("node").agg(F.min("root").alias("root"))


def wrapped(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that no name of theirs clashes with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])
