"""Table contracts: one schema for each table, and the checks that hold frames to them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ddl(text: str) -> T.StructType:
    """A schema from its DDL; needs a running session."""
    return T._parse_datatype_string(text)


SILVER_OHLCV = "ticker string, date date, open double, high double, low double, close double, volume bigint"
SILVER_INDEX = "index_code string, date date, open double, high double, low double, close double, volume bigint, trading_value double"
SILVER_PROFILE = "ticker string, company_name string, exchange string, company_type string, shares_outstanding bigint, sector_name string, sector_id string"
SILVER_NEWS = "url string, title string, published_at date, description string, content string, source string, category string"
TICK = "ticker string, trade_ts timestamp_ntz, price double, volume bigint, data_source string"
CANDLE = "ticker string, minute_ts timestamp_ntz, resolution string, open double, high double, low double, close double, volume bigint, data_source string, ingested_at timestamp_ntz"
VWAP_STATE = "data_source string, ticker string, minute_ts timestamp_ntz, open_at timestamp_ntz, open double, high double, low double, close_at timestamp_ntz, close double, volume bigint, traded_value double, trades bigint"
RULE = "alert_id string, user_id string, ticker string, condition_type string, threshold_value double, channel string, cooldown_minutes int"

#: Tables that a stream owns: batch jobs never overwrite them.
STREAM_OWNED = frozenset({"realtime_trade_ticks_raw", "fact_realtime_vwap_1m_state", "fact_intraday_ohlcv", "fact_alert_event", "fact_alert_rule_state"})


class ContractError(ValueError):
    """A frame breaks its table's contract."""


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "frame") -> DataFrame:
    """P5: the frame itself, or an error that names the columns it lacks. Reads no data."""
    if lacking := sorted(set(needed) - set(df.columns)):
        raise ContractError(f"{what} lacks {', '.join(lacking)}")
    return df


def conform(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """P3 + P4: the contract's columns in order, values that don't fit null, absent columns null."""
    schema = ddl(schema) if isinstance(schema, str) else schema
    return df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def may_overwrite(table: str) -> str:
    """IO24: the table's name, or an error if a stream owns it."""
    if table in STREAM_OWNED:
        raise ContractError(f"{table} belongs to a stream and is not overwritten by batch jobs")
    return table
