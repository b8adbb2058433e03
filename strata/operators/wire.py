"""Vendor wire messages -> landing records.

Messages are read into string maps, because their one-letter keys differ only in case (`e` / `E`,
`t` / `T`) and map keys, unlike column names, are case-sensitive. Keys without a landing name survive
under their own name in `_extra`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.market import as_col

# Wire keys of a trade message and their landing names.
TRADE_KEYS = {
    "e": "event_type",
    "E": "event_time",
    "s": "symbol",
    "t": "trade_id",
    "p": "price",
    "q": "quantity",
    "T": "trade_time",
    "m": "buyer_is_maker",
}
# Wire keys of a bar message and their landing names.
BAR_KEYS = {
    "t": "bar_open_ts",
    "S": "symbol",
    "o": "open",
    "h": "high",
    "l": "low",
    "c": "close",
    "v": "volume",
    "vw": "vwap",
    "n": "trade_count",
}

_MAP = "map<string,string>"


class _Message:
    """Typed access to a string map by landing name, under its wire key or already renamed."""

    def __init__(self, keys: dict[str, str], column: str = "message"):
        self.column = F.col(column)
        self.wire = {name: key for key, name in keys.items()}
        self.known = [*keys.keys(), *keys.values()]

    def text(self, name: str) -> Column:
        return F.coalesce(
            F.try_element_at(self.column, F.lit(self.wire.get(name, name))),
            F.try_element_at(self.column, F.lit(name)),
        )

    def typed(self, name: str, dtype: str) -> Column:
        return self.text(name).try_cast(dtype).alias(name)

    def instant(self, name: str) -> Column:
        """Epoch milliseconds or ISO text."""
        text = self.text(name)
        return F.coalesce(
            F.timestamp_millis(text.try_cast("bigint")), text.try_cast("timestamp")
        ).alias(name)

    def extra(self, *also_known: str) -> Column:
        names = [F.lit(name) for name in (*self.known, *also_known)]
        return F.map_filter(self.column, lambda key, _: ~key.isin(*names)).alias("_extra")


def unwrap_trades(lines: DataFrame, line: Column | str = "value") -> DataFrame:
    """Trade messages out of JSON text lines, inside a `data` envelope or bare, as a `message` map."""
    outer = F.from_json(as_col(line), _MAP)
    body = F.when(
        F.map_contains_key("_outer", F.lit("data")),
        F.from_json(F.try_element_at("_outer", F.lit("data")), _MAP),
    ).otherwise(F.col("_outer"))
    # Exploding a one-element array keeps the filter from being copied below the JSON parsing, which
    # would parse every message several times.
    return (
        lines.select(outer.alias("_outer"))
        .select(body.alias("_body"))
        .select(F.explode(F.array("_body")).alias("message"))
        .filter(F.try_element_at("message", F.lit("e")) == "trade")
    )


def landing_trades(messages: DataFrame) -> DataFrame:
    """`message` maps with wire keys -> typed landing columns plus `_extra`."""
    m = _Message(TRADE_KEYS)
    return messages.select(
        m.typed("event_type", "string"),
        m.instant("event_time"),
        m.typed("symbol", "string"),
        m.typed("trade_id", "bigint"),
        m.typed("price", "string"),
        m.typed("quantity", "string"),
        m.instant("trade_time"),
        m.typed("buyer_is_maker", "boolean"),
        m.extra(),
    )


def flatten_bars(lines: DataFrame, line: Column | str = "value") -> DataFrame:
    """`{"bars": {symbol: [bar, ...]}}` replies -> one `message` map per bar next to its symbol."""
    reply = F.from_json(as_col(line), f"bars map<string,array<{_MAP}>>")
    return (
        # The outer form does not add a size check that would parse each reply once more.
        lines.select(F.explode_outer(reply["bars"]).alias("symbol", "_items"))
        .select("symbol", F.explode("_items").alias("message"))
    )


def landing_bars(messages: DataFrame, timeframe: str = "1Min") -> DataFrame:
    """`message` maps with wire keys -> typed landing columns plus `_extra`.

    The symbol is the one beside the message, if there is such a column, else the one inside.
    """
    m = _Message(BAR_KEYS)
    return messages.select(
        F.col("symbol") if "symbol" in messages.columns else m.typed("symbol", "string"),
        m.typed("bar_open_ts", "timestamp"),
        F.coalesce(m.text("timeframe"), F.lit(timeframe)).alias("timeframe"),
        *(m.typed(price, "double") for price in ("open", "high", "low", "close")),
        m.typed("volume", "bigint"),
        m.typed("vwap", "double"),
        m.typed("trade_count", "bigint"),
        m.extra("timeframe"),
    )


def first_per_key(df: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key: the smallest by `order`, remaining columns breaking ties.

    Used to drop bars polled more than once. An aggregate rather than a window, so copies of one key
    are folded inside each map task and a hot key never gathers in one task. Columns must be
    orderable (no maps).
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    picked = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*key).agg(picked).select(
        *(F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in df.columns)
    )


def last_per_key(df: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key: the largest by `order`; otherwise as `first_per_key`."""
    rest = [c for c in df.columns if c not in key and c not in order]
    picked = F.max(F.struct(*order, *rest)).alias("_last")
    return df.groupBy(*key).agg(picked).select(
        *(F.col(c) if c in key else F.col(f"_last.{c}").alias(c) for c in df.columns)
    )


def poll_window(bars: DataFrame, as_of: Column, minutes: int = 2) -> DataFrame:
    """Bars a poll at `as_of` asks for: those opened in the last minutes up to that moment."""
    opened = F.col("bar_open_ts")
    return bars.filter(
        (opened >= as_of - F.make_dt_interval(mins=F.lit(minutes))) & (opened <= as_of)
    )
