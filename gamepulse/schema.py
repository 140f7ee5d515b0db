"""Result tables: their keys, values and the rule each job writes its columns by."""

from gamepulse.operators.merge import INCREMENT, INSERT_ONLY, OVERWRITE

_MONEY = "decimal(38,2)"
_CHANNEL = {"parent_channel": "string", "child_channel": "string", "ad_label": "string"}
_ATTRIBUTES = {
    "parent_game_id": "string", "os": "string", "medium_account": "string", "promotion_channel": "string",
    "promotion_mode": "string", "head_people": "string", "group_id": "string",
}

KPI_HOUR_KEYS = {"publish_time": "string", "game_id": "int", **_CHANNEL}
KPI_HOUR_VALUES = {
    "show_num": "bigint", "download_num": "bigint", "adpage_click_num": "bigint", "request_num": "bigint",
    "regi_account_num": "bigint", "pay_account_num": "bigint", "dau_pay_account_num": "bigint",
    "pay_money": _MONEY, "pay_money_new": _MONEY, **_ATTRIBUTES,
}
KPI_DAY_KEYS = {"publish_date": "string", "game_id": "int", **_CHANNEL}
KPI_DAY_VALUES = {
    "show_num": "bigint", "download_num": "bigint", "adpage_click_num": "bigint", "request_num": "bigint",
    "regi_account_num": "bigint", "regi_device_num": "bigint", "pay_account_num": "bigint", "pay_money": _MONEY,
    "pay_money_new": _MONEY, **_ATTRIBUTES,
}
GAME_DAY_KEYS = {"publish_date": "string", "game_id": "int"}
GAME_DAY_VALUES = {"os": "string", "group_id": "string", "parent_game_id": "string", "regi_device_num": "bigint"}
COHORT_KEYS = {"reg_time": "string", "game_id": "int", **_CHANNEL}
COHORT_VALUES = {
    "add_user_num": "bigint",
    **{f"retained_{d}day": "bigint" for d in (1, 2, 3, 4, 5, 6, 14, 29, 59)},
    **{f"ltv_{d}day": _MONEY for d in (1, 2, 3, 4, 5, 6, 14, 29, 59)},
}
OS_DAY_KEYS = {"publish_time": "string", "game_id": "int", **_CHANNEL, "os": "int"}
OS_DAY_VALUES = {"os_sum": "bigint"}
LOGIN_HOUR_KEYS = {"login_time": "string", "game_id": "int", **_CHANNEL, "game_account": "string"}
BILL_KEYS = {"month_date": "string", "game_id": "int", "channel_id": "int", "os": "string"}
BILL_VALUES = {"amount": _MONEY, "corporation_name": "string"}
RECOMMEND_KEYS = {"game_id": "int"}
RECOMMEND_VALUES = {"game_id_rs": "string"}
QUOTA_KEYS = {"uid": "string"}
QUOTA_VALUES = {"uname": "string", "points": "bigint"}

STREAM_MEASURES = ("show_num", "download_num", "adpage_click_num", "request_num", "regi_account_num", "pay_money")
STREAM_HOUR_POLICY = {
    **{m: INCREMENT for m in STREAM_MEASURES}, "pay_account_num": OVERWRITE, **{a: INSERT_ONLY for a in _ATTRIBUTES},
}
STREAM_DAY_POLICY = {**{m: INCREMENT for m in STREAM_MEASURES}, **{a: INSERT_ONLY for a in _ATTRIBUTES}}
