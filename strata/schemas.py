"""Wire formats, layer tables and the catalogue that the jobs share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MONEY = "DECIMAL(38,18)"
FAILURES = "ARRAY<STRUCT<error_code: STRING, error_msg: STRING, severity: STRING>>"

# The column lists of the feeds and of the stored tables.
# Landing records as they arrive in the JSON-lines feeds.
TRADE_WIRE = (
    "event_type STRING, event_time TIMESTAMP, symbol STRING, trade_id BIGINT, "
    "price STRING, quantity STRING, trade_time TIMESTAMP, buyer_is_maker BOOLEAN"
)
_BAR_HEAD = "symbol STRING NOT NULL, bar_open_ts TIMESTAMP NOT NULL, timeframe STRING NOT NULL, "
BAR_WIRE = _BAR_HEAD + (
    "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, "
    "volume BIGINT, vwap DOUBLE, trade_count BIGINT"
)
HISTORY_WIRE = _BAR_HEAD + (
    "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, adj_close DOUBLE, volume BIGINT"
)

INGEST_EXTRAS = (
    "_raw_json STRING, _ingest_ts TIMESTAMP, _source STRING, _file_path STRING, ingestion_date DATE"
)

SILVER_TRADES = (
    "event_ts TIMESTAMP NOT NULL, ingest_ts TIMESTAMP NOT NULL, event_date DATE NOT NULL, "
    "source STRING NOT NULL, asset_class STRING NOT NULL, symbol STRING NOT NULL, side STRING, "
    f"price {MONEY} NOT NULL, quantity {MONEY} NOT NULL, notional {MONEY} NOT NULL, "
    "trade_id STRING NOT NULL, late_arrival_sec INT"
)
_OHLCV = (
    f"open {MONEY}, high {MONEY}, low {MONEY}, close {MONEY}, "
    f"volume {MONEY}, vwap {MONEY}, trade_count BIGINT"
)
SILVER_BARS = (
    "bar_open_ts TIMESTAMP NOT NULL, ingest_ts TIMESTAMP NOT NULL, event_date DATE NOT NULL, "
    "source STRING NOT NULL, asset_class STRING NOT NULL, symbol STRING NOT NULL, "
    f"timeframe STRING NOT NULL, {_OHLCV}"
)
GOLD_BARS = (
    "bar_open_ts TIMESTAMP NOT NULL, bar_date DATE NOT NULL, symbol STRING NOT NULL, "
    f"asset_class STRING NOT NULL, timeframe STRING NOT NULL, {_OHLCV}"
)
GOLD_DAILY_VOLUME = (
    "bar_date DATE NOT NULL, symbol STRING NOT NULL, asset_class STRING NOT NULL, "
    f"total_volume {MONEY} NOT NULL, total_notional {MONEY} NOT NULL, trade_count BIGINT NOT NULL, "
    f"vwap {MONEY}, price_high {MONEY} NOT NULL, price_low {MONEY} NOT NULL"
)
# Partitioned by day: one directory per hour would give thousands of tiny files.
GOLD_MARKET_QUALITY = (
    "metric_hour TIMESTAMP NOT NULL, metric_date DATE NOT NULL, symbol STRING NOT NULL, "
    "asset_class STRING NOT NULL, trade_count BIGINT NOT NULL, late_arrival_pct DOUBLE, "
    "quarantine_pct DOUBLE, price_volatility DOUBLE, price_max DOUBLE, price_min DOUBLE"
)
MAINTENANCE_LOG = (
    "run_ts TIMESTAMP, run_date DATE, operation STRING, layer STRING, table STRING, "
    "metric STRING, value BIGINT"
)
BATCHES = (
    "stream STRING, batch BIGINT, state STRING, staged STRING, n_rows BIGINT, content DECIMAL(38,0), noted_ts TIMESTAMP"
)
CONSUMED_FILES = "consumer STRING, file STRING, noted_ts TIMESTAMP, noted_date DATE"
INFERRED_FIELDS = "feed STRING, field STRING, type STRING, step INT, noted_ts TIMESTAMP, noted_date DATE"
_QUARANTINE_EXTRAS = (
    f"_quality_failures {FAILURES}, _error_code STRING NOT NULL, _error_msg STRING, "
    "_quarantined_ts TIMESTAMP NOT NULL, quarantined_date DATE NOT NULL, "
    "_replay_attempts INT NOT NULL, _raw_json STRING"
)


@dataclass(frozen=True)
class TableSpec:
    """What the jobs need to know about one stored table."""

    layer: str
    name: str
    ddl: str
    partition_by: str
    cluster_by: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    keep_days: int | None = None

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


_BAR_KEY = ("symbol", "bar_open_ts", "timeframe")
_GOLD_BAR_SPECS = tuple(
    TableSpec("gold", f"bars_{width}", GOLD_BARS, "bar_date", ("symbol",), _BAR_KEY)
    for width in ("1m", "5m", "1h", "1d")
)

TABLES: dict[tuple[str, str], TableSpec] = {
    (spec.layer, spec.name): spec
    for spec in (
        TableSpec("bronze", "binance_trades", f"{TRADE_WIRE}, {INGEST_EXTRAS}", "ingestion_date",
                  keep_days=90),
        TableSpec("bronze", "binance_replay_trades", f"{TRADE_WIRE}, {INGEST_EXTRAS}",
                  "ingestion_date", keep_days=90),
        TableSpec("bronze", "alpaca_bars", f"{BAR_WIRE}, {INGEST_EXTRAS}", "ingestion_date",
                  keep_days=90),
        TableSpec("bronze", "yfinance_history", f"{HISTORY_WIRE}, {INGEST_EXTRAS}",
                  "ingestion_date", keep_days=90),
        TableSpec("silver", "trades", f"{SILVER_TRADES}, _raw_json STRING", "event_date",
                  ("symbol",), ("trade_id",), 365),
        TableSpec("silver", "bars", f"{SILVER_BARS}, _raw_json STRING", "event_date",
                  ("symbol",), _BAR_KEY, 365),
        TableSpec("silver", "quarantine_trades", f"{SILVER_TRADES}, {_QUARANTINE_EXTRAS}",
                  "quarantined_date", key=("trade_id",), keep_days=30),
        TableSpec("silver", "quarantine_bars", f"{SILVER_BARS}, {_QUARANTINE_EXTRAS}",
                  "quarantined_date", key=_BAR_KEY, keep_days=30),
        *_GOLD_BAR_SPECS,
        TableSpec("gold", "daily_volume_profile", GOLD_DAILY_VOLUME, "bar_date", ("symbol",)),
        TableSpec("gold", "market_quality", GOLD_MARKET_QUALITY, "metric_date", ("symbol",)),
        TableSpec("gold", "quarantine_bars", f"{GOLD_BARS}, {_QUARANTINE_EXTRAS}",
                  "quarantined_date", key=_BAR_KEY, keep_days=30),
        TableSpec("gold", "maintenance_metrics", MAINTENANCE_LOG, "run_date"),
        TableSpec("gold", "consumed_files", CONSUMED_FILES, "noted_date"),
        TableSpec("gold", "inferred_fields", INFERRED_FIELDS, "noted_date"),
    )
}


def table(layer: str, name: str) -> TableSpec:
    return TABLES[(layer, name)]


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def conform(df: DataFrame, shape: TableSpec | StructType | str) -> DataFrame:
    """Project onto a declared schema: fixed order and types, absent columns NULL, extras dropped."""
    schema = StructType.fromDDL(shape) if isinstance(shape, str) else shape
    fields = (schema.schema if isinstance(schema, TableSpec) else schema).fields
    have = set(df.columns)
    return df.select(
        *(
            (F.col(field.name) if field.name in have else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in fields
        )
    )
