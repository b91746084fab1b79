"""What the operators share: word rules, stored steps, connected components."""

from __future__ import annotations

import contextlib
import string
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartzo.session import shared_dir

#: What separates words in the two word rules of the contracts.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty. Pure ASCII text takes the quick built-in."""
    text = F.coalesce(text, F.lit(""))
    other = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(other)


def alnum_words(text: Column) -> Column:
    """Words of letters and digits, lower-cased A-Z; every character above ASCII belongs to a word."""
    return F.array_remove(F.split(ascii_lower(text), NOT_ALNUM), "")


def blank_words(text: Column) -> Column:
    """Words between ASCII blanks; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like those given that the frame doesn't have yet, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: rows go to the shared checkpoint folder, where lost executors can't take them along.

    With spark.cleaner.referenceTracking.cleanCheckpoints Spark deletes them after their last reader.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def _plain_read(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.nodeName() == "LogicalRelation"


def identified(df: DataFrame, name: str) -> DataFrame:
    """Add an id of each row that stays the same however often the frame is read.

    Rows of files are known by file and place, as long as nothing but projections and filters lies between: a join or an
    explode would give copies of a row one id. Anything else is stored once and numbered.
    """
    if "_metadata" not in df.columns and _plain_read(df):
        with contextlib.suppress(AnalysisException):  # files whose reader tells no place
            return df.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).alias(name))
    return stored(df.select("*", F.struct(F.lit(0).cast("long").alias("f"), F.monotonically_increasing_id().alias("i")).alias(name)))


def running(df: DataFrame, group: str, order: list[str], value: Column, name: str, pieces: int = 4096) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group, in order of a hash column and then the others.

    ``order[0]`` must be an evenly spread hash. It cuts every group into pieces; sums of pieces are added up first, so no
    task sees more than a piece of the largest group. ``df`` is read twice.
    """
    piece, before = unused(df.withColumn(name, F.lit(0)), "piece", "ahead")
    rows = df.withColumn(piece, F.shiftright(F.col(order[0]), 64 - pieces.bit_length() + 1))
    sums = rows.groupBy(group, piece).agg(F.sum(value).alias("total"))
    ahead = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(group).alias("g"), F.col(piece).alias("p"), F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias(before))
    inside = Window.partitionBy(group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    rows = rows.join(sums, F.col(group).eqNullSafe(F.col("g")) & (F.col(piece) == F.col("p")))
    return rows.withColumn(name, F.col(name) + F.col(before)).drop("g", "p", piece, before)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number the rows from 0 in a total order: range-partitioned, numbered inside, moved by the counts of the ranges before."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    counts = rows.groupBy("_part").count()  # a row for each of the parts
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return rows.withColumn(name, inside - 1).join(F.broadcast(counts), "_part").withColumn(name, F.col(name) + F.col("_ahead")).drop("_part", "_ahead")


class Work:
    """Parquet tables of one run in the shared folder, columns prunable and compressed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/quartzo-llm/{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def work(spark: SparkSession) -> Iterator[Work]:
    """Tables that are deleted on leaving; what is returned must have been stored() before."""
    w = Work(spark)
    try:
        yield w
    finally:
        w.drop()


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node in ``edges`` (a, b): columns node, root.

    Large-star and small-star rounds: each node points its larger neighbours, then its smaller ones and itself, to its
    smallest neighbour, until the edges are stars. Only grouped minima and joins; every round is stored.
    """

    def oriented(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = stored(oriented(edges))
    before, after = None, mark(now)
    while after[0] and before != after:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = oriented(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        now = stored(oriented(small.select("e.a", "e.b")))
        before, after = after, mark(now)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b"), F.col("b")).distinct())
