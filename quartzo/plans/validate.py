"""Checks a finished run must pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartzo.operators.profile import stacked
from quartzo.plans.gold import approved_sales


def _result(df: DataFrame, name: str, ok: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(name).alias("verificacao"), ok.alias("ok"), detail.alias("detalhe"))


def _text(*parts) -> Column:
    return F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each frame."""
    tagged = stacked([f.select(F.lit(n).alias("_of")) for n, f in frames.items()])
    return tagged.agg(*[F.count_if(F.col("_of") == n).alias(n) for n in frames])


def bronze_preserves_landing(landing: DataFrame, bronze: DataFrame) -> DataFrame:
    n = counts({"landing": landing, "bronze": bronze})
    return _result(
        n, "bronze_preserva_landing", F.col("landing") == F.col("bronze"), _text(F.col("landing"), "=", F.col("bronze"))
    )


def bronze_is_silver_plus_quarantine(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    n = counts({"bronze": bronze, "silver": silver, "quarantine": quarantine})
    return _result(
        n,
        "bronze_igual_silver_mais_quarentena",
        F.col("bronze") == F.col("silver") + F.col("quarantine"),
        _text(F.col("bronze"), "=", F.col("silver"), "+", F.col("quarantine")),
    )


def unique_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """Grouping by the key, not one distinct set, so it works at any size."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("n"))
    return _result(repeated, name, F.col("n") == 0, _text(F.col("n"), "chaves repetidas"))


def fact_grain(fact: DataFrame, key: str = "item_id") -> DataFrame:
    per = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    n = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"), F.count(F.lit(1)).alias("itens"))
    return _result(n, "grao_fato_vendas", F.col("linhas") == F.col("itens"), _text(F.col("linhas"), "=", F.col("itens")))


def dim_keys_unique(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    keys = stacked([d.select(F.lit(n).alias("dim"), F.col(k).cast("bigint").alias("sk")) for n, (d, k) in dims.items()])
    n = keys.groupBy("dim", "sk").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("n"))
    return _result(n, "chaves_dimensoes_unicas", F.col("n") == 0, _text(F.col("n"), "chaves repetidas"))


def orphans(fact: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    """Distinct fact keys the dimension lacks."""
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("linhas"))
    return used.join(dim.select(key), key, "left_anti")


#: Dimensions with their keys, and the dimensions each fact refers to.
DIMENSIONS = {"data": "sk_data", "cliente": "sk_cliente", "produto": "sk_produto", "campanha": "sk_campanha"}
REFERS = {"fato_vendas": ("data", "cliente", "produto"), "fato_eventos": ("data", "cliente", "produto"), "fato_entregas": ("data",)}


def links(gold: dict[str, DataFrame]) -> list[tuple[DataFrame, str, DataFrame]]:
    """Every link from a fact to a dimension."""
    return [(gold[fact], DIMENSIONS[d], gold[f"dim_{d}"]) for fact, dims in REFERS.items() for d in dims]


def no_orphan_keys(links: list[tuple[DataFrame, str, DataFrame]]) -> DataFrame:
    lost = stacked([orphans(f, k, d).select(F.lit(k).alias("chave")) for f, k, d in links])
    n = lost.agg(F.count(F.lit(1)).alias("n"))
    return _result(n, "fatos_sem_chaves_orfas", F.col("n") == 0, _text(F.col("n"), "chaves orfas"))


def approved_revenue_valid_only(fact: DataFrame, mart: DataFrame) -> DataFrame:
    """Revenue of the mart against revenue recomputed from the fact."""
    money = lambda df, col, tag: df.agg(F.coalesce(F.sum(col), F.lit(0)).cast("decimal(18,2)").alias("v")).select(
        F.lit(tag).alias("t"), "v"
    )
    both = money(approved_sales(fact), "valor_bruto", "fato").unionByName(money(mart, "receita", "mart"))
    n = both.agg(F.max(F.when(F.col("t") == "fato", F.col("v"))).alias("f"), F.max(F.when(F.col("t") == "mart", F.col("v"))).alias("m"))
    return _result(n, "receita_somente_pedidos_validos", F.col("f") == F.col("m"), _text(F.col("f"), "=", F.col("m")))


def validate_all(
    landing: DataFrame, bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, gold: dict[str, DataFrame]
) -> DataFrame:
    """Seven rows (verificacao, ok, detalhe)."""
    sales = gold["fato_vendas"]
    return stacked(
        [
            bronze_preserves_landing(landing, bronze),
            bronze_is_silver_plus_quarantine(bronze, silver, quarantine),
            unique_key(silver, "event_id", "silver_sem_event_id_repetido"),
            fact_grain(sales),
            dim_keys_unique({name: (gold[f"dim_{name}"], key) for name, key in DIMENSIONS.items()}),
            no_orphan_keys(links(gold)),
            approved_revenue_valid_only(sales, gold["mart_receita_categoria_dia"]),
        ]
    )


class FailedChecks(RuntimeError):
    """A run with a failed check is not finished."""


def require(results: DataFrame) -> None:
    failed = results.filter(~F.coalesce("ok", F.lit(False))).collect()
    if failed:
        raise FailedChecks("; ".join(f"{r.verificacao}: {r.detalhe}" for r in failed))
