"""Enrolments and accesses: a small extract, transform, load flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzo.functions.columns import mapped, strict_number
from quartzo.functions.domains import COURSE_NAMES
from quartzo.operators.joins import join_validated
from quartzo.operators.quality import range_gate
from quartzo.plans.storefront import Storefront, every


def enrolments(shop: Storefront, with_bad_grades: bool = True) -> DataFrame:
    key = F.col("c_custkey")
    grade = ((key % 101).cast("decimal(6,1)") / 10).cast("decimal(4,1)").cast("string")
    bad = every("c_custkey", 13) if with_bad_grades else F.lit(False)
    return shop.table("customer").select(
        key.alias("id_aluno"),
        F.when(every("c_custkey", 3), "BSI").when(every("c_custkey", 3, 1), "Sistemas de Informacao").otherwise(" BSI ").alias("curso"),
        F.when(bad, "abc").otherwise(grade).alias("nota"),
    )


def accesses(shop: Storefront) -> DataFrame:
    return shop.table("events").groupBy(F.col("user_id").alias("id_aluno")).agg(F.count(F.lit(1)).alias("quantidade_acessos"))


def official_course(df: DataFrame) -> DataFrame:
    return df.withColumn("curso", mapped(F.trim("curso"), COURSE_NAMES))


def transform(students: DataFrame, visits: DataFrame) -> DataFrame:
    """Course names mapped, grades strictly numeric and within 0..10, accesses joined one to one."""
    graded = official_course(students).withColumn("nota", strict_number("nota", "decimal(4,2)"))
    joined = join_validated(range_gate(graded, "nota", 0, 10), visits, ["id_aluno"], "left", "1:1")
    return joined.withColumn("quantidade_acessos", F.coalesce("quantidade_acessos", F.lit(0)))


def treated(students: DataFrame) -> DataFrame:
    """Upper-case course, decimal grade; rows without a numeric grade are dropped."""
    return students.select(
        "id_aluno", F.upper(F.trim("curso")).alias("curso"), F.col("nota").try_cast("decimal(4,2)").alias("nota")
    ).filter("nota is not null")


def loaded_checks(df: DataFrame) -> DataFrame:
    """Figures to verify on the written table: rows, distinct ids, grades out of range."""
    per = df.groupBy("id_aluno").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("nota").between(0, 10)).alias("out")
    )
    return per.agg(F.sum("n").alias("linhas"), F.count(F.lit(1)).alias("alunos"), F.sum("out").alias("fora_da_faixa"))
