"""Small files of a lake folder packed into files near a target size; large files are never read.

Files are packed by bytes within their own folder, in order of their names. New files are written to a hidden folder beside
the old ones first; once all are there, they are moved in and the old ones deleted. A run that breaks off is finished, or
cleared away if it hadn't written everything, by the next call. Readers that list the folder during the move may see a row
twice, so pack where no one reads, or behind a version log.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartzo.operators.scan import number
from quartzo.session import cut_lineage
from quartzo.sources.formats import file_sizes, read_parquet

#: A file of less than this share of the target counts as small.
SMALL = 0.75
STAGING = "_packing-"


def packing_plan(spark: SparkSession, root: str, target_bytes: int) -> DataFrame:
    """path, file (as readers name it), folder, length and bin (1, 2, ...) of every small file that shares a bin with others.

    Only sizes and names decide, so the plan is the same on any cluster. A bin ends once it holds the target.
    """
    listed = file_sizes(spark, root).select("path", F.col("_metadata.file_path").alias("file"), "length")
    small = listed.where((F.col("length") < SMALL * target_bytes) & F.col("path").endswith(".parquet"))
    small = small.withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    ahead = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumn("cut", F.floor(F.coalesce(F.sum("length").over(ahead), F.lit(0)) / target_bytes))
    small = cut_lineage(small)
    bins = small.groupBy("folder", "cut").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return small.join(number(bins, [], ["folder", "cut"], "bin"), ["folder", "cut"]).drop("cut")


def pack(spark: SparkSession, root: str, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Pack the small Parquet files below ``root`` in place; returns the number of files written.

    Columns named by folders stay in the folders' names. Columns that some small files lack become NULL there.
    The driver lists and moves files, as Spark's own writer does; rows are read and written by tasks, one per new file.
    """
    finish(spark, root)
    plan = cut_lineage(packing_plan(spark, root, target_bytes))
    paths = [r.path for r in plan.select("path").toLocalIterator()]
    if not paths:
        return 0
    bins = plan.agg(F.max("bin")).first()[0]
    staging = f"{root.rstrip('/')}/{STAGING}{uuid.uuid4().hex}"
    plan.select("path", "folder", "bin").write.parquet(f"{staging}/plan")
    placed = spark.read.option("mergeSchema", True).parquet(*paths).withColumn("_file", F.col("_metadata.file_path"))
    placed = placed.join(plan.select(F.col("file").alias("_file"), F.col("bin").alias("_bin")), "_file").drop("_file")
    laid = placed.repartitionById(bins, (F.col("_bin") - 1).cast("int"))
    laid.write.option("compression", "zstd").partitionBy("_bin").parquet(f"{staging}/data")
    finish(spark, root)
    return bins


def finish(spark: SparkSession, root: str) -> None:
    """Move in what an earlier call wrote whole and delete what it replaces; clear away what it didn't finish."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path(root)):
        return
    for staging in system.listStatus(path(root)):
        if not staging.getPath().getName().startswith(STAGING):
            continue
        at = staging.getPath().toString()
        if system.exists(path(f"{at}/data/_SUCCESS")):
            plan = read_parquet(spark, f"{at}/plan")
            for row in plan.groupBy("bin", "folder").agg(F.collect_list("path").alias("old")).toLocalIterator():
                written = path(f"{at}/data/_bin={row.bin}")
                if system.exists(written):
                    for file in system.listStatus(written):
                        if not system.rename(file.getPath(), path(f"{row.folder}/{file.getPath().getName()}")):
                            raise OSError(f"{file.getPath()} can't be moved to {row.folder}")
                for old in row.old:  # only once the bin's new files are in
                    system.delete(path(old), False)
        system.delete(staging.getPath(), True)
