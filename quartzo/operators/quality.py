"""Declarative record rules: check, split, report, gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartzo.functions.columns import reasons


class BlockedRun(RuntimeError):
    """A blocking rule fired; nothing may be published."""


@dataclass(frozen=True)
class Rule:
    """``broken`` holds on records that violate the rule.

    ``action``: ``quarantine`` sets the record apart, ``alert`` only names it, ``fix``
    replaces column ``target`` by ``fixed``.
    """

    name: str
    broken: Column
    action: str = "quarantine"
    target: str | None = None
    fixed: Column | None = None


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Apply fixes, then add ``motivos`` (and ``alertas`` when there are alert rules)."""
    for rule in rules:
        if rule.action == "fix":
            df = df.withColumn(rule.target, F.when(rule.broken, rule.fixed).otherwise(F.col(rule.target)))
    named = lambda action: [(r.name, r.broken) for r in rules if r.action == action]
    out = df.withColumn("motivos", reasons(named("quarantine")))
    alerts = named("alert")
    return out.withColumn("alertas", reasons(alerts)) if alerts else out


def approved(checked: DataFrame) -> DataFrame:
    return checked.filter("motivos = ''").drop("motivos")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter("motivos <> ''")


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return approved(checked), rejected(checked)


def reason_counts(checked: DataFrame) -> DataFrame:
    """Records per reason; a record with two reasons counts in both."""
    listed = rejected(checked).select(F.explode(F.split("motivos", ", ")).alias("motivo"))
    return listed.groupBy("motivo").agg(F.count(F.lit(1)).alias("linhas"))


def report(checked: DataFrame, dataset: str) -> DataFrame:
    """One line: read, approved, quarantined, percentage."""
    counts = checked.agg(
        F.count(F.lit(1)).alias("lidos"),
        F.count_if(F.col("motivos") == "").alias("aprovados"),
        F.count_if(F.col("motivos") != "").alias("quarentena"),
    )
    share = (F.col("quarentena").cast("decimal(20,0)") * 100 / F.greatest("lidos", F.lit(1)).cast("decimal(20,0)"))
    return counts.select(
        F.lit(dataset).alias("fonte"),
        "lidos",
        "aprovados",
        "quarentena",
        F.round(share, 2).cast("decimal(7,2)").alias("percentual"),
    )


def reconcile(before: DataFrame, good: DataFrame, bad: DataFrame, dataset: str) -> DataFrame:
    """Rows read, approved, set apart, and whether they add up."""
    tagged = (
        before.select(F.lit("lidos").alias("lado"))
        .unionByName(good.select(F.lit("aprovados").alias("lado")))
        .unionByName(bad.select(F.lit("quarentena").alias("lado")))
    )
    sums = tagged.agg(*[F.count_if(F.col("lado") == s).alias(s) for s in ("lidos", "aprovados", "quarentena")])
    return sums.select(
        F.lit(dataset).alias("fonte"),
        "*",
        (F.col("lidos") == F.col("aprovados") + F.col("quarentena")).alias("fecha"),
    )


def ratio_by(checked: DataFrame, by: Column, name: str = "lote") -> DataFrame:
    """Share of set-apart records per batch."""
    return checked.groupBy(by.alias(name)).agg(
        F.count(F.lit(1)).alias("lidos"), F.count_if(F.col("motivos") != "").alias("quarentena")
    )


def over_limit(checked: DataFrame, by: Column, max_pct: int = 10, name: str = "lote") -> DataFrame:
    """Batches whose set-apart share is above ``max_pct`` percent."""
    return ratio_by(checked, by, name).filter(F.col("quarentena") * 100 > F.col("lidos") * max_pct)


def gate(checked: DataFrame, by: Column, max_pct: int = 10) -> None:
    """Stop the run when any batch is over the limit; call it before publishing."""
    worst = over_limit(checked, by, max_pct).orderBy(F.desc("quarentena"), "lote").take(5)
    if worst:
        shown = ", ".join(f"{r.lote}: {r.quarentena}/{r.lidos}" for r in worst)
        raise BlockedRun(f"more than {max_pct}% set apart in {shown}")


def scorecard(checked: DataFrame, label: Column) -> DataFrame:
    """Labelled defects that passed, and clean records that were set apart."""
    bad = F.col("motivos") != ""
    return checked.agg(
        F.count_if(label & ~bad).alias("nao_detectados"),
        F.count_if(~label & bad).alias("falsos_positivos"),
        F.count_if(label & bad).alias("detectados"),
        F.count_if(~label & ~bad).alias("corretos"),
    )


def range_gate(df: DataFrame, column: str, low, high) -> DataFrame:
    """Pass the frame through; the job fails at the first value outside low..high."""
    value = F.col(column)
    return df.withColumn(
        column,
        F.when(
            value.isNotNull() & ~value.between(F.lit(low), F.lit(high)),
            F.raise_error(F.concat(F.lit(f"{column} out of range: "), value.cast("string"))).cast(df.schema[column].dataType),
        ).otherwise(value),
    )


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(F.col(column).isNotNull() & ~F.col(column).between(F.lit(low), F.lit(high))).alias("fora_da_faixa"),
    )
