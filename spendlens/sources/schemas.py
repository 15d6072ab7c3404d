"""Logical tables and the names the public API uses for their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

DONE_KEYS = T.StructType([
    T.StructField("entity_id", T.LongType()),
    T.StructField("yr", T.IntegerType()),
])

# Column names in the source files and the names used here.
SOURCE_NAMES = {
    "idDeputado": "entity_id",
    "nome": "name",
    "siglaPartido": "grp",
    "siglaUf": "region",
    "anoConsulta": "yr",
    "anoDocumento": "document_yr",
    "ano": "plain_yr",
    "valorLiquido": "amount",
    "valorLiquido_pos": "amount_pos",
    "eh_estorno": "is_refund",
    "tipoDespesa": "kind",
    "categoria_macro": "category",
    "idProposicao": "item_id",
    "idEvento": "event_id",
    "distancia_km": "distance_km",
    "gasto_total": "spend_total",
    "gasto_liquido": "spend_net",
    "qtd_despesas": "expense_count",
    "qtd_estornos": "refund_count",
    "total_proposicoes": "item_total",
    "total_eventos": "event_total",
    "atividade_composta": "activity",
    "gasto_normalizado_dist": "spend_per_km",
    "gasto_total_ajustado": "spend_adjusted",
    "sem_despesa": "no_expense",
    "custo_por_atividade": "cost_per_activity",
    "log_gasto_total": "log_spend",
    "faixa_gasto": "spend_band",
}


def to_canonical(df: DataFrame) -> DataFrame:
    """Rename source columns to the engine's names."""
    return df.withColumnsRenamed({k: v for k, v in SOURCE_NAMES.items() if k in df.columns})


def to_source_names(df: DataFrame) -> DataFrame:
    """Rename back, for consumers of the original files."""
    back = {v: k for k, v in SOURCE_NAMES.items()}
    return df.withColumnsRenamed({k: v for k, v in back.items() if k in df.columns})


def page_schema(row: T.StructType) -> T.StructType:
    """One page of an API answer together with the request it answers."""
    return T.StructType([
        T.StructField("request_entity", T.LongType()),
        T.StructField("request_year", T.IntegerType()),
        T.StructField("page", T.LongType()),
        T.StructField("dados", T.ArrayType(row)),
        T.StructField("links", T.ArrayType(T.StructType([
            T.StructField("rel", T.StringType()),
            T.StructField("href", T.StringType()),
        ]))),
    ])
