"""Raw `|`-delimited log lines and web access logs as typed rows.

`parse(lines, kind)` keeps the good rows, `rejects(lines, kind)` the lines that carry the
kind's tag but do not parse. A row is good when every field it declares is present and valid.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.casts import (
    blank_as_zero_double,
    blank_as_zero_int,
    money,
    strict_double,
    strict_int,
)
from gamepulse.functions.channel import default_channel
from gamepulse.functions.times import access_log_hour, prefix_before


def _hour(c: Column) -> Column:
    return prefix_before(c, ":")


def _day(c: Column) -> Column:
    return prefix_before(c, " ")


def _same(c: Column) -> Column:
    return c


def _up_to_amp(c: Column) -> Column:
    return prefix_before(c, "&")


@dataclass(frozen=True)
class LogKind:
    """Tag that marks the line, and (output name, field index, conversion) per column."""

    tag: str
    fields: tuple[tuple[str, int, Callable[[Column], Column]], ...]
    min_fields: int = 0


_ORDER_HEAD = (("game_account", 5, _same), ("paymoney", 10, money))

# Tags and field positions of the log contract (field 0 ends with the tag).
KINDS = {
    "pubgame": LogKind("bi_pubgame", (("game_id", 1, strict_int),)),
    "channel_hour": LogKind(
        "bi_channel",
        (("type", 1, strict_int), ("expand_channel", 2, default_channel), ("game_id", 5, strict_int),
         ("publish_time", 4, _hour)),
    ),
    "channel_os": LogKind(
        "bi_channel",
        (("type", 1, strict_int), ("expand_channel", 2, default_channel), ("game_id", 5, strict_int),
         ("publish_time", 4, _day), ("os_info", 6, _same), ("os", 7, strict_int)),
    ),
    "active_hour": LogKind(
        "bi_active", (("game_id", 1, strict_int), ("expand_channel", 4, default_channel), ("publish_time", 5, _hour))
    ),
    "active_device": LogKind(
        "bi_active",
        (("game_id", 1, strict_int), ("expand_channel", 4, default_channel), ("imei", 8, _up_to_amp),
         ("update_time", 5, _same)),
    ),
    "order_hour": LogKind(
        "bi_order",
        (*_ORDER_HEAD, ("order_state", 19, strict_int), ("publish_time", 6, _hour), ("game_id", 7, strict_int)),
    ),
    "order": LogKind(
        "bi_order",
        (*_ORDER_HEAD, ("order_status", 19, strict_int), ("order_time", 6, _same), ("game_id", 7, strict_int)),
    ),
    "regi": LogKind(
        "bi_regi",
        (("game_account", 3, _same), ("expand_channel", 13, default_channel), ("game_id", 4, strict_int),
         ("resource_id", 6, strict_int), ("publish_time", 5, _hour)),
    ),
    "points_signin": LogKind(
        "bi_points",
        (("obtain_time", 3, _same), ("obtain_id", 1, _same), ("uid", 2, _same), ("game_id", 4, blank_as_zero_int),
         ("points", 6, strict_double), ("ori_price", 7, blank_as_zero_double), ("resource", 8, strict_int)),
    ),
    "points_recharge": LogKind(
        "bi_order",
        (("obtain_time", 6, _same), ("obtain_id", 2, _same), ("game_id", 7, strict_int), ("game_account", 5, _same),
         ("points", 12, strict_double), ("ori_price", 12, strict_double), ("order_state", 19, strict_int),
         ("version", 25, F.lower)),
        min_fields=26,
    ),
    "appdownload": LogKind("bi_appdownload", (("imei", 3, _same), ("game_id", 1, strict_int))),
}


def login_kind(grain: str, game_field: int) -> LogKind:
    """Logins; the game id sits at field 7 in the older layout and at 8 in the newer one."""
    return LogKind(
        "bi_login",
        (("game_account", 3, _same), ("login_time", 4, _day if grain == "day" else _hour),
         ("expand_channel", 6, default_channel), ("game_id", game_field, strict_int)),
    )


KINDS["login_day"] = login_kind("day", 7)
KINDS["login_hour"] = login_kind("hour", 8)


def _complete(names: list[str]) -> Column:
    keep = F.lit(True)
    for n in names:
        keep = keep & F.col(n).isNotNull()
    return keep


def _fields(lines: DataFrame, kind: LogKind) -> DataFrame:
    parts = F.col("parts")
    row = F.struct(*[conv(F.get(parts, F.lit(i))).alias(name) for name, i, conv in kind.fields])
    tagged = lines.filter(F.col("value").contains(kind.tag))
    split = tagged.select("value", F.split("value", r"\|", -1).alias("parts"))
    if kind.min_fields:
        split = split.filter(F.size("parts") >= kind.min_fields)
    # inline() keeps the null test above the split: pushed below it, the test would repeat
    # the split and the casts once per column and per line.
    return split.select("value", F.inline(F.array(row)))


def _kind(kind: str | LogKind) -> LogKind:
    return KINDS[kind] if isinstance(kind, str) else kind


def parse(lines: DataFrame, kind: str | LogKind) -> DataFrame:
    spec = _kind(kind)
    names = [n for n, _, _ in spec.fields]
    return _fields(lines, spec).filter(_complete(names)).select(*names)


def rejects(lines: DataFrame, kind: str | LogKind) -> DataFrame:
    spec = _kind(kind)
    return _fields(lines, spec).filter(~_complete([n for n, _, _ in spec.fields])).select("value")


# The landing-page request pattern and the marker of a dropped response.
REQUEST_PAGE = "/Ssxy/loadComplete?p="
REQUEST_LINE = r'^.*0800\] "GET /Ssxy/loadComplete[?]p=[\d|_|a-z|A-Z]+&g=[\d]+.*$'
REQUEST_NOT_FOUND = 'HTTP/1.0" 404'
ANY_NOT_FOUND = r'HTTP/[0-9.]+" 404'


def _request_rows(lines: DataFrame, drop_all_404: bool) -> DataFrame:
    line = F.col("value")
    missing = line.rlike(ANY_NOT_FOUND) if drop_all_404 else line.contains(REQUEST_NOT_FOUND)
    # The plain substring test settles most lines before the regular expression runs.
    hits = lines.filter(line.contains(REQUEST_PAGE) & ~missing & line.rlike(REQUEST_LINE))
    url = F.get(F.split(line, " ", 8), F.lit(6))
    query = F.split(F.get(F.split(F.get(F.split(url, "p=", 3), F.lit(1)), '""', 2), F.lit(0)), "&g=", 3)
    game = F.substring_index(F.get(F.col("query"), F.lit(1)), "&", 1)
    row = F.struct(
        default_channel(F.get(F.col("query"), F.lit(0))).alias("expand_channel"),
        strict_int(game).alias("game_id"),
        F.col("stamp").alias("publish_time"),
    )
    cut = hits.select("value", query.alias("query"), access_log_hour("value").alias("stamp"))
    return cut.select("value", F.inline(F.array(row)))


REQUEST_COLUMNS = ["expand_channel", "game_id", "publish_time"]


def parse_request(lines: DataFrame, drop_all_404: bool = False) -> DataFrame:
    """Landing-page requests as (expand_channel, game_id, hour)."""
    return _request_rows(lines, drop_all_404).filter(_complete(REQUEST_COLUMNS)).select(*REQUEST_COLUMNS)


def request_rejects(lines: DataFrame, drop_all_404: bool = False) -> DataFrame:
    return _request_rows(lines, drop_all_404).filter(~_complete(REQUEST_COLUMNS)).select("value")


def parse_request_batch(lines: DataFrame, drop_all_404: bool = False) -> DataFrame:
    """Batch form: upper-case channel, and the hour padded to a full time."""
    return parse_request(lines, drop_all_404).select(
        F.upper("expand_channel").alias("expand_channel"),
        "game_id",
        F.concat("publish_time", F.lit(":01:10")).alias("publish_time"),
    )


def paid_on(orders: DataFrame, run_date: str | None) -> DataFrame:
    """Paid orders of one day; with no day given, paid orders of every day."""
    paid = orders.filter(F.col("order_status") == 4)
    return paid if run_date is None else paid.filter(F.substring_index("order_time", " ", 1) == run_date)
