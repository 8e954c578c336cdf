"""Tables and columns under the names existing lakes and their queries use.

Reading: ``from_legacy`` turns a table of an existing lake into the layer the operators
expect. Serving: ``create_legacy_views`` offers the five tables under the old names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.schema import QUOTE_FIELDS
from quotelake.sources import lake

# Column names of existing tables, per layer; columns not listed keep
# their name.
META = {
    "topic": "topico_kafka", "partition": "particao_kafka", "offset": "offset_kafka",
    "key": "chave_kafka", "kafka_time": "data_hora_kafka", "raw_json": "json_bruto",
    "parse_status": "status_parse_bronze", "ingest_time": "data_hora_ingestao",
}
QUOTE = {
    "symbol": "ticket_ativo_b3", "short_name": "nome_abreviado_empresa",
    "long_name": "nome_empresa_completo", "currency": "moeda", "price": "valor_atual",
    "day_high": "valor_maximo_diario", "day_low": "valor_minimo_diario",
    "day_range": "faixa_valor_diario", "change": "variacao_valor_dia_anterior",
    "change_pct": "variacao_percentual_valor_dia",
    "quote_time": "data_hora_atualizacao_valor", "market_cap": "valor_mercado_total",
    "volume": "volume_negocios", "prev_close": "valor_fechamento_anterior",
    "open_price": "valor_abertura", "range_52w": "variacao_valor_52_semanas",
    "low_52w": "valor_minimo_52_semanas", "high_52w": "valor_maximo_52_semanas",
    "pe_ratio": "indicador_lucro", "eps": "lucro_por_acao", "logo_url": "url_logo_do_ativo",
    "trade_date": "ano_mes_dia", "silver_time": "data_hora_processamento_silver",
    "kafka_time": "data_hora_kafka", "ingest_time": "data_hora_ingestao",
}
WINDOW = {
    "window_start": "inicio_periodo", "window_end": "fim_periodo",
    "symbol": "ticket_ativo_b3", "avg_price": "preco_medio_periodo",
    "min_price": "preco_minimo_periodo", "max_price": "preco_maximo_periodo",
    "samples": "quantidade_amostras", "time_basis": "periodo_base",
    "gold_time": "data_hora_processamento",
}
# Codes stored in those tables.
CODES = {
    "parse_error": "erro_parse", "no_result": "sem_resultado", "parse_ok": "parse_ok",
    "invalid_symbol": "ticket_invalido", "invalid_price": "valor_atual_invalido",
    "invalid_quote_time": "data_hora_atualizacao_invalida",
    "invalid_ingest_time": "data_hora_ingestao_invalida",
    "ingest_time": "data_hora_ingestao", "quote_time": "data_hora_atualizacao_valor",
}
CODED_COLUMNS = ("parse_status", "rejection_reason", "time_basis")

COLUMNS = {
    lake.BRONZE: META,
    lake.SILVER: QUOTE,
    lake.QUARANTINE: {**META, "quote_time": "data_hora_atualizacao_valor"},
    lake.GOLD_OPERATIONAL: WINDOW,
    lake.GOLD_FINANCIAL: WINDOW,
}
TABLES = {
    lake.BRONZE: "cotacoes",
    lake.SILVER: "cotacoes",
    lake.QUARANTINE: "cotacoes_rejeitadas",
    lake.GOLD_OPERATIONAL: "media_precos_ingestao_5min",
    lake.GOLD_FINANCIAL: "media_precos_atualizacao_5min",
}


def _recode(codes: Column, mapping: dict[str, str]) -> Column:
    """Comma-joined codes replaced one by one; unknown codes stay."""
    listed = F.create_map(*[F.lit(text) for pair in mapping.items() for text in pair])
    return F.array_join(F.transform(
        F.split(codes, ","), lambda code: F.coalesce(F.try_element_at(listed, code), code)), ",")


def to_legacy(df: DataFrame, spec: lake.TableSpec) -> DataFrame:
    """A layer with the names and codes of existing tables."""
    names = COLUMNS[spec]
    return df.select(*[
        (_recode(F.col(c), CODES) if c in CODED_COLUMNS else F.col(c)).alias(names.get(c, c))
        for c in spec.columns])


def from_legacy(df: DataFrame, spec: lake.TableSpec) -> DataFrame:
    """A table of an existing lake with the layer's names, codes and types."""
    names, codes = COLUMNS[spec], {old: new for new, old in CODES.items()}

    def column(name: str) -> Column:
        stored = F.col(names.get(name, name))
        if name in CODED_COLUMNS:
            return _recode(stored, codes).alias(name)
        # Older tables hold the Bronze volume as an int.
        return (stored.cast("bigint") if name in QUOTE_FIELDS and "Volume" in name
                else stored).alias(name)

    return df.select(*[column(name) for name in spec.columns])


def create_legacy_views(spark: SparkSession, prefix: str = "") -> list[str]:
    """A temporary view ``<schema>_<table>`` for each registered table."""
    views = []
    for spec, table in TABLES.items():
        view = f"{spec.schema}_{table}"
        to_legacy(spark.table(lake.qualified(spec, prefix)), spec).createOrReplaceTempView(view)
        views.append(view)
    return views
