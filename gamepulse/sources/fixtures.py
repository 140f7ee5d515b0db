"""The `fx_*` views: this engine's input tables derived from the star-schema test tables.

Each view is declared once and rendered twice, as a DataFrame for Spark and as SQL text for
the reference database. Spark frames of event-time tables also carry the typed time as
`<time>_ts`, so that a date range prunes the file scan.
"""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from gamepulse.sources.tables import Tables, parquet_tables

BASE_TABLES = ["events", "orders", "customer", "nation", "lineitem"]

TIME = "substr(cast(ts as string), 1, 19)"
RAW_ACCOUNT = (
    "case when user_id % 3 = 0 then concat(' ACC_', cast(user_id as string), ' ') "
    "when user_id % 3 = 1 then concat('Acc_', cast(user_id as string)) "
    "else concat('acc_', cast(user_id as string)) end"
)
CHANNEL = (
    "case user_id % 6 when 0 then '' when 1 then 'gdt_lm_00020' when 2 then 'bd_bd2_zy2' when 3 then 'solo' "
    "when 4 then 'waytoolongmedium_x_y' else 'zht_xwst_10004_extra' end"
)
GAME = "cast(user_id % 10 as int)"
IMEI = "concat('imei_', cast(user_id % 97 as string))"


@dataclass(frozen=True)
class View:
    base: str
    columns: dict[str, str]
    where: str = ""
    distinct: bool = False
    unique_on: str = ""  # reduce the base to the distinct values of this column first
    time: str = ""  # output column that is the text form of the base column `ts`
    also: "View | None" = field(default=None)  # union all

    def sql(self) -> str:
        base = f"(select distinct {self.unique_on} from {self.base}) u" if self.unique_on else self.base
        cols = ", ".join(f"{e} as {n}" for n, e in self.columns.items())
        text = f"select {'distinct ' if self.distinct else ''}{cols} from {base}"
        text += f" where {self.where}" if self.where else ""
        return f"{text} union all {self.also.sql()}" if self.also else text

    def frame(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        df = VIEWS[self.base].frame(tables) if self.base in VIEWS else tables[self.base]
        if self.where:
            df = df.where(self.where)
        if self.unique_on:
            df = df.select(self.unique_on).distinct()
        exprs = [f"{e} as {n}" for n, e in self.columns.items()]
        if self.time:
            exprs.append(f"ts as {self.time}_ts")
        df = df.selectExpr(*exprs)
        df = df.distinct() if self.distinct else df
        return df.unionByName(self.also.frame(tables)) if self.also else df


VIEWS = {
    "fx_regi": View("events", {
        "game_account": RAW_ACCOUNT, "game_id": GAME, "expand_channel": CHANNEL, "imei": IMEI,
        "reg_time": "concat('2024-01-', lpad(cast(1 + user_id % 20 as string), 2, '0'), ' ', "
                    "lpad(cast(user_id % 24 as string), 2, '0'), ':15:00')",
    }, unique_on="user_id"),
    "fx_order": View("events", {
        "order_id": "event_id",
        "game_account": f"case when event_id % 4 = 0 then concat('acc_', cast(user_id as string)) "
                        f"else {RAW_ACCOUNT} end",
        "game_id": f"case when event_id % 50 = 0 then null else {GAME} end",
        "order_time": TIME,
        "order_status": "case event_type when 'purchase' then 4 else 8 end",
        "ori_price": "cast(value as decimal(18,2))",
        "total_amt": "cast(event_id % 7 as decimal(18,2))",
        "prod_type": "case when event_id % 2 = 0 then 6 else 1 end",
    }, where="event_type in ('purchase','error')", time="order_time"),
    "fx_login": View("events", {
        "game_account": RAW_ACCOUNT, "login_time": TIME, "expand_channel": CHANNEL, "game_id": GAME,
    }, where="event_type in ('click','view')", time="login_time"),
    "fx_channel": View("events", {
        "channel_type": "case event_type when 'view' then 1 when 'click' then 2 else 3 end",
        "expand_channel": CHANNEL,
        "game_id": "cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 10 as int)",
        "channel_time": TIME,
        "os": "cast(user_id % 2 + 1 as int)",
    }, where="event_type in ('view','click','signup')", time="channel_time"),
    "fx_publish_game": View("events", {"game_id": GAME}, where="user_id % 10 < 8"),
    "fx_game_sdk": View("events", {
        "old_game_id": GAME, "system_type": "cast(event_id % 2 + 1 as int)",
        "group_id": "cast(user_id % 10 % 3 as int)", "game_id": "cast(100 + user_id % 10 % 5 as int)",
    }, distinct=True),
    "fx_appdownload": View("lineitem", {
        "imei": "concat('dev_', cast(l_orderkey as string))", "game_id": "cast(l_partkey % 200 as int)",
    }),
    "fx_cp_req": View("orders", {
        "order_no": "o_orderkey", "account": "concat(' Cust#', cast(o_custkey as string))",
        "game_id": "cast(o_custkey % 25 as int)", "amount": "cast(o_totalprice as decimal(18,2))",
        "status": "case when o_orderstatus = 'P' then 0 else 1 end",
        "req_time": "substr(cast(o_orderdate as string), 1, 19)",
    }),
    "fx_bgameaccount": View("customer", {
        "account": "concat('cust#', cast(c_custkey as string))",
        "account_channel": "case when c_custkey % 7 = 0 then null else cast(c_nationkey % 4 as int) end",
        "os": "case c_custkey % 3 when 0 then null when 1 then 'ios' else 'android' end",
    }, where="c_custkey % 5 <> 0"),
    "fx_bgame": View("nation", {"id": "n_nationkey", "corporation_name": "n_name"}, where="n_nationkey % 6 <> 0"),
    "fx_receipt": View("orders", {
        "order_sn": "o_orderkey", "sandbox": "1", "state": "case when o_orderkey % 3 = 0 then 3 else 1 end",
    }, where="o_orderpriority = '5-LOW'"),
    "fx_active": View("events", {
        "game_id": GAME, "expand_channel": CHANNEL, "imei": IMEI, "update_time": TIME,
    }, where="event_type = 'signup'"),
    "fx_points_signin": View("events", {
        "obtain_time": TIME, "obtain_id": "'10'", "uid": "cast(user_id as string)", "game_id": "0",
        "points": "cast(event_id % 5 + 1 as double)", "ori_price": "cast(0 as double)",
        "resource": "case when event_id % 10 = 0 then 3 else 4 end",
    }, where="event_type = 'signup'"),
    "fx_points_recharge": View("events", {
        "obtain_time": TIME, "obtain_id": "concat('W', cast(event_id as string))",
        "game_account": "concat('acc_', cast(user_id as string))", "game_id": GAME, "amount": "value",
        "resource": "1", "order_state": "case when event_id % 9 = 0 then 8 else 4 end",
        "version": "case when event_id % 11 = 0 then 'V2.1' else 'V2.2' end",
    }, where="event_type = 'purchase'"),
    "fx_account_bind": View("events", {
        "game_account": "concat('acc_', cast(user_id as string))",
        "bind_member_id": "cast(user_id + 1000 as string)",
    }, where="user_id % 4 <> 0", distinct=True),
    "fx_member": View("events", {
        "member_id": "cast(user_id as string)", "username": "concat('name_', cast(user_id as string))",
    }, where="user_id % 5 <> 0", distinct=True, also=View("events", {
        "member_id": "cast(user_id + 1000 as string)", "username": "concat('bound_', cast(user_id as string))",
    }, distinct=True)),
    "fx_game_name": View("events", {
        "game_id": GAME, "name": "concat('game_', cast(user_id % 10 as string))",
    }, where="user_id % 10 <> 9", distinct=True),
    "fx_pkg": View("nation", {
        "pkg_code": "'00020'", "medium_account": "'acct_a'", "promotion_channel": "'search'",
    }, where="n_nationkey = 0", also=View("nation", {
        "pkg_code": "'zy2'", "medium_account": "'acct_b'", "promotion_channel": "'feed'",
    }, where="n_nationkey = 0")),
    "fx_pkg_day": View("events", {
        "pkg_code": "'00020'", "order_date": "substr(cast(ts as string), 1, 10)",
        "promotion_mode": "'cpc'", "head_people": "'owner_a'",
    }, where="event_id % 3 = 0 and user_id = 1", distinct=True),
    "fx_request_line": View("events", {
        "event_id": "event_id",
        "line": "concat('192.0.2.1 - - [', substr(cast(ts as string), 9, 2), '/Jan/2024:', "
                "substr(cast(ts as string), 12, 8), ' +0800] \"GET ', "
                "case when event_id % 17 = 0 then '/index.html' else '/Ssxy/loadComplete' end, '?p=', "
                "case when user_id % 2 = 0 then 'gdt_lm_00020' else 'bd_bd2_zy2' end, '&g=', "
                "cast(user_id % 10 as string), '&os_info=6.0 HTTP/1.', "
                "case when event_id % 13 = 0 then '0\" 404' else '1\" 200' end, ' 43')",
    }, where="event_type = 'view'"),
    "fx_channel_line": View("fx_channel", {
        "line": "concat_ws('|', '2024-01-01 00:00:00,000 [INFO] bi: bi_channel', cast(channel_type as string), "
                "expand_channel, '192.0.2.1', channel_time, cast(game_id as string), '6.0', cast(os as string))",
    }),
}


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    base = parquet_tables(spark, sf_dir, BASE_TABLES)
    return Tables(list(VIEWS), lambda name: VIEWS[name].frame(base))


def with_views(body: str, *names: str) -> str:
    """`body` preceded by the SQL text of the named views as common table expressions."""
    needed: list[str] = []
    for n in names:
        if VIEWS[n].base in VIEWS and VIEWS[n].base not in needed:
            needed.append(VIEWS[n].base)
        if n not in needed:
            needed.append(n)
    ctes = ", ".join(f"{n} as ({VIEWS[n].sql()})" for n in needed)
    body = body.strip()
    return f"with {ctes}, {body[5:]}" if body.lower().startswith("with ") else f"with {ctes} {body}"


def _line(head: str, *fields: str) -> str:
    return "concat_ws('|', " + ", ".join([f"'2024-01-01 00:00:00,000 [INFO] bi: {head}'", *fields]) + ")"


_B = "''"
LINE_TEMPLATES = {
    "pubgame": ("fx_publish_game", _line("bi_pubgame", "cast(game_id as string)")),
    "channel": ("fx_channel", _line(
        "bi_channel", "cast(channel_type as string)", "expand_channel", "'192.0.2.1'", "channel_time",
        "cast(game_id as string)", "'6.0'", "cast(os as string)")),
    "active": ("fx_active", _line(
        "bi_active", "cast(game_id as string)", _B, _B, "expand_channel", "update_time", _B, _B,
        "concat(imei, '&x=1')")),
    "order": ("fx_order", _line(
        "bi_order", _B, "cast(order_id as string)", _B, _B, "game_account", "order_time",
        "coalesce(cast(game_id as string), '')", _B, _B, "cast(ori_price as string)", _B,
        "cast(total_amt as string)", *[_B] * 6, "cast(order_status as string)", *[_B] * 5, "'v2.2'")),
    "recharge": ("fx_points_recharge", _line(
        "bi_order", _B, "obtain_id", _B, _B, "game_account", "obtain_time", "cast(game_id as string)", _B, _B,
        "'0.00'", _B, "cast(amount as string)", *[_B] * 6, "cast(order_state as string)", *[_B] * 5, "version")),
    "regi": ("fx_regi", _line(
        "bi_regi", _B, _B, "game_account", "cast(game_id as string)", "reg_time", "'1'", *[_B] * 6,
        "expand_channel")),
    "login": ("fx_login", _line(
        "bi_login", _B, _B, "game_account", "login_time", _B, "expand_channel", _B, "cast(game_id as string)",
        "'192.0.2.1'")),
    "login_old": ("fx_login", _line(
        "bi_login", _B, _B, "game_account", "login_time", _B, "expand_channel", "cast(game_id as string)",
        "'192.0.2.1'")),
    "signin": ("fx_points_signin", _line(
        "bi_points", "obtain_id", "uid", "obtain_time", _B, _B, "cast(points as string)", _B,
        "cast(resource as string)")),
    "appdownload": ("fx_appdownload", _line("bi_appdownload", "cast(game_id as string)", "'18'", "imei", "'android'")),
    "request": ("fx_request_line", "line"),
}


def log_lines(tables: Mapping[str, DataFrame], *kinds: str) -> DataFrame:
    """Log lines of the given kinds, rendered from the views, as one `value` column."""
    out = None
    for kind in kinds:
        view, text = LINE_TEMPLATES[kind]
        df = tables[view].selectExpr(f"{text} as value")
        out = df if out is None else out.unionByName(df)
    return out
