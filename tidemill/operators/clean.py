"""Cleaning: names, aliases, casts, validity filters, fallbacks and normalisers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Source name to contract name, by feed; applied only where the target is absent.
OHLCV_ALIASES = {"symbol": "ticker", "code": "ticker", "time": "date", "trading_date": "date", "tradingdate": "date", "vol": "volume"}
INDEX_ALIASES = {"index": "index_code", "code": "index_code", "symbol": "index_code", "time": "date", "trading_date": "date", "value": "trading_value"}
PROFILE_ALIASES = {"symbol": "ticker", "organ_name": "company_name", "com_type": "company_type", "outstanding_shares": "shares_outstanding", "industry": "sector_name"}
CANDLE_ALIASES = {"time": "minute_ts", "symbol": "ticker"}


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names trimmed, lower-cased, blanks to underscores."""
    return df.toDF(*(c.strip().lower().replace(" ", "_") for c in df.columns))


def apply_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename known source names; the first alias of a target wins and a present target is kept."""
    have, rename = set(df.columns), {}
    for old, new in aliases.items():
        if old in have and new not in have:
            rename[old] = new
            have.add(new)
    return df.withColumnsRenamed(rename)


def lenient(df: DataFrame, **types: str) -> DataFrame:
    """Cast columns, values that don't parse become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def valid_bars(df: DataFrame) -> DataFrame:
    """Volume not negative, prices positive, high not below low; nulls go."""
    return df.where("volume >= 0 and open > 0 and high > 0 and low > 0 and close > 0 and high >= low")


def valid_index_bars(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Allowed codes with a date; prices may be zero or less."""
    code = F.upper(F.trim("index_code"))
    return df.withColumn("index_code", code).where(F.col("index_code").isin(*codes) & F.col("date").isNotNull()).where("high >= low and volume >= 0")


def valid_candles(df: DataFrame, resolution: str = "1m") -> DataFrame:
    """No nulls, prices positive, high not below low; tagged with the resolution."""
    return df.dropna().where("open > 0 and high >= low and low > 0 and close > 0").withColumn("resolution", F.lit(resolution))


def collapse(text: Column | str) -> Column:
    """White space runs as one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def valid_news(df: DataFrame, least: int = 50) -> DataFrame:
    """Url and title not blank, content of at least `least` characters once white space is collapsed."""
    x = df.withColumns({"url": F.trim("url"), "title": collapse("title"), "content": collapse("content")})
    return x.where((F.length("url") > 0) & (F.length("title") > 0) & (F.length("content") >= least))


def valid_profiles(df: DataFrame, exchanges: Sequence[str], key: str = "ticker") -> DataFrame:
    """P10: a symbol and an exchange in scope."""
    return df.where((F.length(F.trim(key)) > 0) & F.upper(F.trim("exchange")).isin(*exchanges))


def valid_listings(df: DataFrame, exchanges: Sequence[str], kind: str = "STOCK") -> DataFrame:
    """Exchanges in scope, stocks where a type is given, each symbol once, upper case."""
    x = df.where(F.upper("exchange").isin(*exchanges))
    if "type" in df.columns:
        x = x.where(F.upper("type") == kind)
    return x.select(F.upper(F.trim("symbol")).alias("symbol")).where("symbol <> ''").distinct()


def audited(df: DataFrame, source: str, as_of: Column, key: str = "ticker") -> DataFrame:
    """Audit columns; the clock is a parameter."""
    return df.withColumns({key: F.upper(key), "ingested_at": as_of, "processed_at": as_of, "source_name": F.lit(source)})


def profile_fallbacks(df: DataFrame) -> DataFrame:
    """Name falls back to the ticker, sector to 'Unknown', shares to outstanding, listed, then 0."""
    shares = F.coalesce("outstanding", "listed", F.lit(0))
    return df.withColumns({
        "company_name": F.coalesce(F.nullif(F.trim("company_name"), F.lit("")), F.col("ticker")),
        "sector_name": F.coalesce(F.nullif(F.trim("sector_name"), F.lit("")), F.lit("Unknown")),
        "shares_outstanding": F.round(shares).cast("long"),
    })


def sector_slug(name: Column | str) -> Column:
    """Upper case, runs of separators as one underscore, none at the ends; blank gives UNKNOWN."""
    slug = F.regexp_replace(F.upper(F.trim(name)), r"[\s\-/.,;:]+", "_")
    slug = F.regexp_replace(slug, "^_+|_+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("UNKNOWN"))


def remap(value: Column | str, table: Mapping[str, str]) -> Column:
    """Listed values replaced, others kept."""
    v = F.col(value) if isinstance(value, str) else value
    out = v
    for old, new in table.items():
        out = F.when(v == old, new).otherwise(out)
    return out


def lookup(value: Column | str, table: Mapping[str, str]) -> Column:
    """The mapped value, null where there is none."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), F.col(value) if isinstance(value, str) else value)


def display_defaults(df: DataFrame) -> DataFrame:
    """What a chart shows where an indicator is null."""
    defaults = {"rsi_14": F.lit(50.0), "macd": F.lit(0.0), "macd_signal": F.lit(0.0), "bb_upper": F.col("high"), "bb_lower": F.col("low"), "sma_20": F.col("close")}
    return df.withColumns({c: F.coalesce(c, d) for c, d in defaults.items() if c in df.columns})


def search(df: DataFrame, term: str, *columns: str) -> DataFrame:
    """Rows where one of the columns holds the term, whatever its case."""
    found = F.lit(False)
    for c in columns:
        found = found | F.contains(F.upper(c), F.lit(term.upper()))
    return df.where(found)


#: Wire form of a tick or candle message; the payload may be wrapped in data or payload.
_BODY = "symbol string, price double, matchPrice double, volume double, matchQtty double, time string, resolution string, open double, high double, low double, close double"
MESSAGE = f"struct<data:struct<{', '.join(f.replace(' ', ':', 1) for f in _BODY.split(', '))}>,payload:struct<{', '.join(f.replace(' ', ':', 1) for f in _BODY.split(', '))}>,{', '.join(f.replace(' ', ':', 1) for f in _BODY.split(', '))}>"


def unwrap_message(value: Column | str) -> Column:
    """The message's body, whichever level holds it; null if it doesn't parse."""
    m = F.from_json(value, MESSAGE)
    names = [f.split()[0] for f in _BODY.split(", ")]
    own = F.struct(*(m[n].alias(n) for n in names))
    return F.coalesce(m["data"], m["payload"], own)


def epoch_time(value: Column | str, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    """P20: microseconds, milliseconds, seconds, ISO text or a {"Seconds","Nanos"} object as local time without zone."""
    v = F.col(value) if isinstance(value, str) else value
    n = F.coalesce(v.try_cast("double"), F.get_json_object(v, "$.Seconds").try_cast("double"))
    micros = F.when(n >= 1e15, n).when(n >= 1e12, n * 1000).otherwise(n * 1000000).cast("long")
    utc = F.timestamp_micros(micros)
    return F.coalesce(F.from_utc_timestamp(utc, zone).cast("timestamp_ntz"), F.try_to_timestamp(v).cast("timestamp_ntz"))


def shape_ticks(df: DataFrame, body: str = "body", source: str = "feed") -> DataFrame:
    """Typed ticks to the second; messages without symbol, price, volume or time go."""
    b = F.col(body)
    x = df.select(
        F.upper(F.trim(b["symbol"])).alias("ticker"), F.date_trunc("second", epoch_time(b["time"])).cast("timestamp_ntz").alias("trade_ts"),
        F.coalesce(b["price"], b["matchPrice"]).alias("price"), F.coalesce(b["volume"], b["matchQtty"]).cast("long").alias("volume"), F.lit(source).alias("data_source"),
    )
    return x.where("ticker <> '' and trade_ts is not null and price is not null and volume is not null")


def shape_candles(df: DataFrame, body: str = "body", source: str = "feed", resolutions: Sequence[str] = ("1", "1m")) -> DataFrame:
    """Typed one-minute candles; other resolutions and incomplete messages go."""
    b = F.col(body)
    x = df.where(b["resolution"].isin(*resolutions)).select(
        F.upper(F.trim(b["symbol"])).alias("ticker"), F.date_trunc("minute", epoch_time(b["time"])).cast("timestamp_ntz").alias("minute_ts"), F.lit("1m").alias("resolution"),
        *(b[c].alias(c) for c in ("open", "high", "low", "close")), b["volume"].cast("long").alias("volume"), F.lit(source).alias("data_source"),
    )
    return x.dropna()


def to_message(df: DataFrame, key: str = "ticker") -> DataFrame:
    """(key, value) for a message sink."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def article_date(value: Column | str) -> Column:
    """An ISO date in the text, else dd-mm-yyyy or dd/mm/yyyy turned round, else its first ten characters."""
    v = F.trim(value)
    iso = F.nullif(F.regexp_extract(v, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    d = r"(\d{1,2})[-/](\d{1,2})[-/](\d{4})"
    turned = F.when(v.rlike(d), F.concat_ws("-", F.regexp_extract(v, d, 3), F.lpad(F.regexp_extract(v, d, 2), 2, "0"), F.lpad(F.regexp_extract(v, d, 1), 2, "0")))
    return F.coalesce(iso, turned, F.substring(v, 1, 10))


def recent(published: Column | str, as_of: Column, days: int) -> Column:
    """At most `days` old; an unknown date passes."""
    d = F.try_to_date(F.col(published) if isinstance(published, str) else published, "yyyy-MM-dd")
    return d.isNull() | (F.datediff(as_of, d) <= days)


def normalize_url(url: Column | str) -> Column:
    """Scheme and host lower-cased, tracking parameters and fragment dropped, a bare trailing ? too."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    base, rest = F.regexp_extract(u, r"^([^?]*)", 1), F.regexp_extract(u, r"^[^?]*\?(.*)$", 1)
    head, tail = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*)", 1), F.regexp_replace(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", "")
    keep = F.array_join(F.filter(F.split(rest, "&"), lambda p: ~p.rlike("(?i)^(utm_[^=]*|fbclid|gclid)(=|$)") & (p != "")), "&")
    return F.concat(F.lower(head), tail, F.when(keep != "", F.concat(F.lit("?"), keep)).otherwise(""))
