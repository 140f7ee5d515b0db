"""SQL text of the registered queries, for a reference database with the raw test tables."""

from gamepulse.checks import params as P
from gamepulse.plans.cohort import LTV_WINDOWS, RETURN_DAYS
from gamepulse.sources.fixtures import with_views

ORACLES: dict[str, str] = {}


def add(name: str, body: str, *views: str) -> None:
    ORACLES[name] = with_views(body, *views)


def hour(c: str) -> str:
    return f"split_part({c}, ':', 1)"


def day(c: str) -> str:
    return f"split_part({c}, ' ', 1)"


def key(c: str) -> str:
    return f"lower(trim({c}))"


def channel(c: str) -> str:
    return f"case when {c} = '' then '21' else {c} end"


def between(c: str, start: str | None = P.KPI_START, end: str | None = P.KPI_END) -> str:
    day_of = f"cast(substr({c}, 1, 10) as date)"
    bounds = [f"{day_of} >= date '{start}'"] if start else []
    bounds += [f"{day_of} <= date '{end}'"] if end else []
    return " and ".join([*bounds, f"{c} is not null"])


def parts(c: str) -> str:
    text = f"regexp_replace({c}, '_+$', '')"
    items = f"string_split({text}, '_')"
    short = f"(case when {text} = '' then 0 else len({items}) end) < 3"
    blank = f"{c} in ('', '0')"
    rest = [f"case when {c} is null then null when {blank} or {short} then '' else {items}[{i}] end" for i in (2, 3)]
    return (
        f"case when {blank} then '21' when {short} then {c} else {items}[1] end as parent_channel, "
        f"{rest[0]} as child_channel, {rest[1]} as ad_label"
    )


FITS = "coalesce(length(parent_channel) <= 10 and length(child_channel) <= 10 and length(ad_label) <= 15, false)"
KEY = "publish_time, game_id, parent_channel, child_channel, ad_label"
GAMES = "(select distinct game_id from fx_publish_game)"
SDK = "(select distinct old_game_id, system_type as os, group_id, game_id as parent_game_id from fx_game_sdk)"

# --- warehouse KPIs ---

ACCOUNTS = f"(select distinct r.game_account, {channel('r.expand_channel')} as expand_channel from fx_regi r join {GAMES} g on r.game_id = g.game_id)"


def _money(amount: str, extra: str = "") -> str:
    return f"""
    select {hour('o.order_time')} as publish_time, o.game_id, r.expand_channel, cast(sum({amount}) as double) as pay_money
    from (select distinct * from fx_order where order_status = 4 {extra} and {between('order_time')}) o
    join {ACCOUNTS} r on {key('o.game_account')} = {key('r.game_account')}
    group by 1, 2, 3"""


add("pay_money_hour", _money("o.ori_price"), "fx_order", "fx_regi", "fx_publish_game")
add("pay_money_new_hour", _money("o.ori_price + o.total_amt", "and prod_type = 6"), "fx_order", "fx_regi", "fx_publish_game")
add("pay_money_day", f"""
    select {day('o.order_time')} as publish_time, o.game_id, r.expand_channel,
           cast(sum(o.ori_price + o.total_amt) as double) as pay_money, r.os, r.group_id
    from (select distinct * from fx_order where order_status = 4 and prod_type = 6 and {between('order_time')}) o
    join (select distinct r.game_account, {channel('r.expand_channel')} as expand_channel, g.os, g.group_id
          from fx_regi r join (select distinct old_game_id, system_type as os, group_id from fx_game_sdk) g
          on r.game_id = g.old_game_id) r
    on {key('o.game_account')} = {key('r.game_account')}
    group by 1, 2, 3, 5, 6""", "fx_order", "fx_regi", "fx_game_sdk")
add("regi_accounts_hour", f"""
    select {hour('r.reg_time')} as publish_time, r.game_id, {channel('r.expand_channel')} as expand_channel,
           count(distinct r.game_account) as regi_num
    from fx_regi r join {GAMES} g on r.game_id = g.game_id where {between('r.reg_time')} group by 1, 2, 3""",
    "fx_regi", "fx_publish_game")
add("regi_accounts_devices_day", f"""
    select {day('r.reg_time')} as publish_time, r.game_id, {channel('r.expand_channel')} as expand_channel,
           count(distinct r.game_account) as regi_num, count(distinct r.imei) as regi_device_num,
           g.os, g.group_id, g.parent_game_id
    from fx_regi r join {SDK} g on r.game_id = g.old_game_id where {between('r.reg_time')}
    group by 1, 2, 3, 6, 7, 8""", "fx_regi", "fx_game_sdk")
add("regi_devices_game_day", f"""
    select {day('r.reg_time')} as publish_time, r.game_id, count(distinct r.imei) as regi_device_num,
           g.os, g.group_id, g.parent_game_id
    from fx_regi r join {SDK} g on r.game_id = g.old_game_id where {between('r.reg_time')} and g.os is not null
    group by 1, 2, 4, 5, 6""", "fx_regi", "fx_game_sdk")
add("pay_accounts_hour", f"""
    select {hour('t.first_time')} as publish_time, t.game_id, t.expand_channel, count(distinct t.acct) as pay_account_num
    from (select min(o.order_time) as first_time, o.game_id, {channel('r.expand_channel')} as expand_channel,
                 {key('o.game_account')} as acct
          from fx_regi r join fx_order o on {key('o.game_account')} = {key('r.game_account')}
          join {GAMES} g on r.game_id = g.game_id
          where o.game_id is not null and o.order_status = 4 and {between('o.order_time')}
          group by {day('o.order_time')}, o.game_id, {channel('r.expand_channel')}, {key('o.game_account')}) t
    group by 1, 2, 3""", "fx_regi", "fx_order", "fx_publish_game")
add("pay_accounts_day", f"""
    select {day('o.order_time')} as publish_time, o.game_id, {channel('r.expand_channel')} as expand_channel,
           count(distinct {key('o.game_account')}) as pay_account_num, g.os, g.group_id
    from fx_regi r join fx_order o on {key('o.game_account')} = {key('r.game_account')}
    join (select distinct old_game_id, system_type as os, group_id from fx_game_sdk) g on r.game_id = g.old_game_id
    where o.game_id is not null and o.order_status = 4 and o.prod_type = 6 and {between('o.order_time')}
    group by 1, 2, 3, 5, 6""", "fx_regi", "fx_order", "fx_game_sdk")
for name, kind, measure in (("show", 1, "show_num"), ("download", 2, "download_num"), ("adpage", 3, "adpage_click_num")):
    for grain, cut in (("hour", hour), ("day", day)):
        add(f"click_{name}_{grain}", f"""
            select {cut('c.channel_time')} as publish_time, c.game_id, {channel('upper(c.expand_channel)')} as expand_channel,
                   count(*) as {measure}
            from fx_channel c join {GAMES} g on c.game_id = g.game_id
            where c.channel_type = {kind} and {between('c.channel_time')} group by 1, 2, 3""", "fx_channel", "fx_publish_game")

LOG_TIME = r"strptime(regexp_extract(line, '\[([^ ]+) ', 1), '%d/%b/%Y:%H:%M:%S')"
REQUESTS = rf"""
    (select regexp_extract(line, 'p=([^&]*)&g=', 1) as expand_channel,
            cast(regexp_extract(line, '&g=([0-9]+)', 1) as int) as game_id,
            strftime({LOG_TIME}, '%Y-%m-%d %H') as publish_time
     from fx_request_line
     where not contains(line, 'HTTP/1.0" 404')
       and regexp_full_match(line, '.*0800\] "GET /Ssxy/loadComplete[?]p=[\d|_|a-z|A-Z]+&g=[\d]+.*'))"""
for grain, cut in (("hour", "q.publish_time"), ("day", day("q.publish_time"))):
    add(f"request_{grain}", f"""
        select {cut} as publish_time, q.game_id, upper(q.expand_channel) as expand_channel, count(*) as request_num
        from {REQUESTS} q join {GAMES} g on q.game_id = g.game_id where {between('q.publish_time')}
        group by 1, 2, 3""", "fx_request_line", "fx_publish_game")
add("parse_request", f"select * from {REQUESTS} q", "fx_request_line")
add("parse_request_batch", f"""
    select upper(expand_channel) as expand_channel, game_id, concat(publish_time, ':01:10') as publish_time
    from {REQUESTS} q""", "fx_request_line")
add("access_log_hour", f"select event_id, strftime({LOG_TIME}, '%Y-%m-%d %H') as publish_time from fx_request_line",
    "fx_request_line")

# --- cohorts and bills ---

COHORT = f"""
    (select cast(substr(r.reg_time, 1, 10) as date) as reg_day, r.game_id, {channel('r.expand_channel')} as expand_channel,
            r.game_account
     from fx_regi r join {GAMES} g on r.game_id = g.game_id
     where cast(substr(r.reg_time, 1, 10) as date) between date '{P.COHORT_DAY}' - interval 59 day and date '{P.COHORT_DAY}')"""
RETURNED = ", ".join(f"count(distinct case when dur = {d} then game_account end) as retained_{d}day" for d in RETURN_DAYS)
add("retention", f"""
    with c as {COHORT},
    s as (select reg_day, game_id, expand_channel, count(game_account) as add_user_num from c group by 1, 2, 3),
    b as (select c.*, datediff('day', c.reg_day, cast(substr(l.login_time, 1, 10) as date)) as dur
          from c join fx_login l on c.game_account = l.game_account),
    r as (select reg_day, game_id, expand_channel, {RETURNED} from b
          where dur in {RETURN_DAYS} group by 1, 2, 3)
    select cast(r.reg_day as varchar) as reg_time, r.game_id, r.expand_channel, s.add_user_num,
           {', '.join(f'retained_{d}day' for d in RETURN_DAYS)}
    from r join s on r.reg_day = s.reg_day and r.game_id = s.game_id and r.expand_channel = s.expand_channel""",
    "fx_regi", "fx_login", "fx_publish_game")
ORACLES["retention_bitmap"] = ORACLES["retention"]
add("regi_distinct_sketch_day", f"""
    select {day('r.reg_time')} as publish_time, r.game_id, {channel('r.expand_channel')} as expand_channel,
           count(distinct r.game_account) as regi_num, count(distinct r.imei) as regi_device_num, true as accounts_near, true as devices_near
    from fx_regi r where {between('r.reg_time')} and r.game_id in (select old_game_id from {SDK} g)
    group by 1, 2, 3""", "fx_regi", "fx_game_sdk")
PAID_WITHIN = ", ".join(
    f"cast(coalesce(sum(case when dur >= 0 and dur < {n} then amount end), 0) as double) as ltv_{n - 1}day" for n in LTV_WINDOWS
)
add("ltv", f"""
    with c as {COHORT},
    s as (select reg_day, game_id, expand_channel, count(game_account) as add_user_num from c group by 1, 2, 3),
    p as (select c.reg_day, c.game_id, c.expand_channel,
                 datediff('day', c.reg_day, cast(substr(o.order_time, 1, 10) as date)) as dur,
                 case when o.order_status = 4 then o.ori_price else -o.ori_price end as amount
          from c join fx_order o on c.game_account = o.game_account and o.order_status in (4, 8)),
    v as (select reg_day, game_id, expand_channel, {PAID_WITHIN} from p group by 1, 2, 3)
    select cast(s.reg_day as varchar) as reg_time, s.game_id, s.expand_channel, s.add_user_num,
           {', '.join(f'coalesce(v.ltv_{n - 1}day, 0) as ltv_{n - 1}day' for n in LTV_WINDOWS)}
    from s left join v on s.reg_day = v.reg_day and s.game_id = v.game_id and s.expand_channel = v.expand_channel""",
    "fx_regi", "fx_order", "fx_publish_game")
add("sdk_bills", f"""
    select {day('q.req_time')} as month_date, q.game_id, coalesce(a.account_channel, 0) as channel_id,
           coalesce(a.os, '') as os, coalesce(b.corporation_name, '') as corporation_name,
           cast(sum(q.amount) as double) as amount
    from fx_cp_req q
    left join fx_bgameaccount a on {key('a.account')} = {key('q.account')}
    left join fx_bgame b on q.game_id = b.id
    left join (select order_sn from fx_receipt where sandbox = 1 and state = 3) v on v.order_sn = q.order_no
    where cast(substr(q.req_time, 1, 10) as date) >= date '{P.BILL_START}'
      and cast(substr(q.req_time, 1, 10) as date) < date '{P.BILL_END}' and q.status = 1 and v.order_sn is null
    group by 1, 2, 3, 4, 5""", "fx_cp_req", "fx_bgameaccount", "fx_bgame", "fx_receipt")
add("anti_sandbox_orders", """
    select q.* replace (cast(q.amount as double) as amount) from fx_cp_req q
    where not exists (select 1 from fx_receipt v where v.sandbox = 1 and v.state = 3 and v.order_sn = q.order_no)""",
    "fx_cp_req", "fx_receipt")
add("whitelist_semi", """
    select game_id, game_account, expand_channel, reg_time from fx_regi
    where game_id in (select game_id from fx_publish_game)""", "fx_regi", "fx_publish_game")

# --- log lines: the rows the lines were made from ---

CH = channel("expand_channel")
add("parse_pubgame", "select game_id from fx_publish_game", "fx_publish_game")
add("parse_channel_hour", f"select channel_type as type, {CH} as expand_channel, game_id, {hour('channel_time')} as publish_time from fx_channel", "fx_channel")
add("parse_channel_os", f"select channel_type as type, {CH} as expand_channel, game_id, {day('channel_time')} as publish_time, '6.0' as os_info, os from fx_channel", "fx_channel")
add("parse_active_hour", f"select game_id, {CH} as expand_channel, {hour('update_time')} as publish_time from fx_active", "fx_active")
add("parse_active_device", f"select game_id, {CH} as expand_channel, imei, update_time from fx_active", "fx_active")
ORDER = "select game_account, cast(ori_price as double) as paymoney, order_status as {status}, {time}, game_id from fx_order where game_id is not null"
add("parse_order_hour", ORDER.format(status="order_state", time=f"{hour('order_time')} as publish_time"), "fx_order")
add("parse_order", ORDER.format(status="order_status", time="order_time"), "fx_order")
add("paid_on_date", ORDER.format(status="order_status", time="order_time") + f" and order_status = 4 and {day('order_time')} = '{P.POINTS_DAY}'", "fx_order")
add("parse_regi", f"select game_account, {CH} as expand_channel, game_id, 1 as resource_id, {hour('reg_time')} as publish_time from fx_regi", "fx_regi")
add("parse_login_day", f"select game_account, {day('login_time')} as login_time, {CH} as expand_channel, game_id from fx_login", "fx_login")
add("parse_login_hour", f"select game_account, {hour('login_time')} as login_time, {CH} as expand_channel, game_id from fx_login", "fx_login")
add("parse_points_signin", "select obtain_time, obtain_id, uid, game_id, points, ori_price, resource from fx_points_signin", "fx_points_signin")
add("parse_points_recharge", """
    select obtain_time, obtain_id, game_id, game_account, amount as points, amount as ori_price, order_state,
           lower(version) as version from fx_points_recharge""", "fx_points_recharge")
add("parse_appdownload", "select imei, game_id from fx_appdownload", "fx_appdownload")
add("scan_text_logs", "select line from fx_channel_line union all select line from fx_request_line", "fx_channel_line", "fx_request_line")

# --- channels, dimensions, merging ---

add("channel_default", """
    select game_account, login_time,
           case expand_channel when '' then '21' when 'solo' then 'pyw' else expand_channel end as expand_channel
    from fx_login""", "fx_login")
add("channel_split", f"select game_id, channel_time, {parts('expand_channel')} from fx_channel", "fx_channel")
for name, test in (("valid", FITS), ("rejects", f"not {FITS}")):
    add(f"channel_gate_{name}", f"""
        select * from (select game_account, reg_time, game_id, expand_channel, {parts('expand_channel')} from fx_regi) t
        where {test}""", "fx_regi")


def clicks(days: tuple[str, str]) -> str:
    """Keyed hourly ad counts of some days."""
    sums = ", ".join(
        f"cast(sum(case when channel_type = {k} then 1 else 0 end) as bigint) as {m}"
        for k, m in ((1, "show_num"), (2, "download_num"), (3, "adpage_click_num"))
    )
    return f"""
    (select {KEY}, {sums}
     from (select {hour('channel_time')} as publish_time, game_id, channel_type, {parts(channel('upper(expand_channel)'))}
           from fx_channel where game_id in (select game_id from fx_publish_game) and {between('channel_time', *days)}) x
     where {FITS} group by {KEY})"""


def merged(measures: str) -> str:
    on = " and ".join(f"t.{k.strip()} = b.{k.strip()}" for k in KEY.split(","))
    keys = ", ".join(f"coalesce(t.{k.strip()}, b.{k.strip()}) as {k.strip()}" for k in KEY.split(","))
    return f"select {keys}, {measures} from {clicks(P.TARGET_DAYS)} t full outer join {clicks(P.BATCH_DAYS)} b on {on}"


CLICK_VIEWS = ("fx_channel", "fx_publish_game")
PLUS = "coalesce(t.{0}, 0) + coalesce(b.{0}, 0) as {0}"
add("upsert_overwrite", merged("""
    coalesce(b.show_num * 10, t.show_num) as show_num, coalesce(b.download_num, t.download_num) as download_num,
    t.adpage_click_num"""), *CLICK_VIEWS)
add("upsert_increment", merged(", ".join(PLUS.format(m) for m in ("show_num", "download_num", "adpage_click_num"))), *CLICK_VIEWS)
add("upsert_mixed", merged(f"""
    {PLUS.format('show_num')}, {PLUS.format('download_num')},
    coalesce(b.adpage_click_num, t.adpage_click_num) as adpage_click_num,
    case when t.publish_time is null then 'second' else 'first' end as head_people"""), *CLICK_VIEWS)
DAY_KEY = f"{day('publish_time')} as publish_date, game_id, parent_channel, child_channel, ad_label"
add("kpi_day_from_hour", f"""
    select {DAY_KEY}, cast(sum(show_num) as bigint) as show_num, cast(sum(download_num) as bigint) as download_num,
           cast(sum(adpage_click_num) as bigint) as adpage_click_num
    from {clicks(P.ALL_DAYS)} t group by 1, 2, 3, 4, 5""", *CLICK_VIEWS)
add("daily_nonzero_filter", f"""
    select {DAY_KEY}, cast(sum(show_num) as bigint) as show_num, cast(0 as bigint) as download_num
    from {clicks(P.ALL_DAYS)} t group by 1, 2, 3, 4, 5 having sum(show_num) <> 0""", *CLICK_VIEWS)
SHOWS = f"(select {KEY}, show_num from {clicks(P.ALL_DAYS)} k where show_num > 0)"
add("enrich_game_group", f"""
    select s.*, coalesce(cast(g.group_id as varchar), '0') as group_id, coalesce(cast(g.os as varchar), '1') as os
    from {SHOWS} s left join (
        select old_game_id, group_id, system_type as os from (
            select *, row_number() over (partition by old_game_id order by group_id, system_type) as rn
            from fx_game_sdk) d where rn = 1) g
    on s.game_id = g.old_game_id""", *CLICK_VIEWS, "fx_game_sdk")
add("enrich_pkg_dims", f"""
    select s.*, coalesce(p.medium_account, '') as medium_account, coalesce(p.promotion_channel, '') as promotion_channel,
           coalesce(d.promotion_mode, '') as promotion_mode, coalesce(d.head_people, '') as head_people
    from {SHOWS} s left join fx_pkg p on upper(p.pkg_code) = s.ad_label
    left join fx_pkg_day d on upper(d.pkg_code) = s.ad_label and d.order_date = {day('s.publish_time')}""",
    *CLICK_VIEWS, "fx_pkg", "fx_pkg_day")
add("union_distinct_regi", f"""
    select distinct game_account, {CH} as expand_channel, game_id, 1 as resource_id, {hour('reg_time')} as publish_time
    from fx_regi""", "fx_regi")

# --- stream measures ---

LAST_REGI = f"""
    (select distinct game_account, {CH} as expand_channel, game_id, {hour('reg_time')} as publish_time from fx_regi
     where game_id in (select game_id from fx_publish_game))"""
NET_PAY = f"""
    select {hour('o.order_time')} as publish_time, o.game_id, r.expand_channel,
           sum(case when o.order_status = 4 then o.ori_price else -o.ori_price end) as pay_money
    from fx_order o join {LAST_REGI} r on o.game_account = r.game_account
    where o.game_id is not null and o.order_status in (4, 8) group by 1, 2, 3"""
FIRST_PAY = f"""
    select {hour('first_time')} as publish_time, game_id, expand_channel, count(*) as pay_account_num
    from (select min(o.order_time) as first_time, o.game_id, r.expand_channel, o.game_account
          from fx_order o join {LAST_REGI} r on o.game_account = r.game_account
          where o.game_id is not null and o.order_status = 4
          group by {day('o.order_time')}, o.game_id, r.expand_channel, o.game_account) t
    group by 1, 2, 3"""
PAY_VIEWS = ("fx_order", "fx_regi", "fx_publish_game")
add("net_pay_money_hour", f"select publish_time, game_id, expand_channel, cast(pay_money as double) as pay_money from ({NET_PAY}) t", *PAY_VIEWS)
add("first_pay_accounts_hour", FIRST_PAY, *PAY_VIEWS)
add("os_day_count", f"""
    select publish_time, game_id, parent_channel, child_channel, ad_label, os, count(*) as os_sum
    from (select {day('channel_time')} as publish_time, game_id, os, {parts(CH)} from fx_channel
          where channel_type = 1 and game_id in (select game_id from fx_publish_game)) t
    group by 1, 2, 3, 4, 5, 6""", *CLICK_VIEWS)
add("login_accounts_hour", f"""
    select distinct * from (select {hour('login_time')} as login_time, game_id, game_account, {parts(CH)} from fx_login
          where game_id in (select game_id from fx_publish_game)) t
    where {FITS} and login_time >= '{P.KPI_START}'""", "fx_login", "fx_publish_game")
add("active_events", f"""
    select * from (select game_id, imei, update_time, {parts(CH)} from fx_active
          where game_id in (select game_id from fx_publish_game)) t where {FITS}""", "fx_active", "fx_publish_game")

# --- points ---

UNION = """
    (select obtain_time, obtain_id, uid, '' as game_account, game_id, points, ori_price, resource from fx_points_signin
     where resource = 4
     union all
     select obtain_time, obtain_id, '' as uid, game_account, game_id, amount as points, amount as ori_price, resource
     from fx_points_recharge where order_state = 4 and lower(version) = 'v2.2')"""
SHARE = f"p.points * {P.INTEGRAL * 0.01}"
# A member has one name: where the view holds two, the lookup takes the smaller one.
ENRICHED = f"""
    (select e.obtain_time, e.obtain_id, case when e.uid = '' then '0' else e.uid end as uid, coalesce(m.username, '') as uname,
            e.game_id, e.game_name, e.points, e.ori_price, e.resource
     from (select p.obtain_time, p.obtain_id,
                  case when p.resource = 1 then coalesce(b.bind_member_id, '0') else p.uid end as uid, p.game_id,
                  case when p.resource = 1 then coalesce(g.name, '') else '' end as game_name,
                  case when p.resource <> 1 then p.points when {SHARE} > 0 and {SHARE} <= 1 then 1.0
                       else trunc({SHARE}) end as points, p.ori_price, p.resource
           from {UNION} p left join fx_account_bind b on p.game_account = b.game_account
           left join fx_game_name g on p.game_id = g.game_id) e
     left join (select member_id, min(username) as username from fx_member group by member_id) m
     on e.uid = m.member_id)"""
POINT_VIEWS = ("fx_points_signin", "fx_points_recharge")
RICH_VIEWS = (*POINT_VIEWS, "fx_account_bind", "fx_member", "fx_game_name")
add("points_union", f"select * from {UNION} u", *POINT_VIEWS)
add("enrich_points", f"select * from {ENRICHED} e", *RICH_VIEWS)
add("points_running_total", f"""
    select * from (
        select obtain_time, obtain_id, uid, uname, game_id, game_name, cast(trunc(points) as bigint) as points, ori_price, resource,
               cast(sum(trunc(points)) over (order by obtain_time, obtain_id, uid, uname, game_id, game_name, points, ori_price
                    rows between unbounded preceding and current row) as bigint) as real_points
        from {ENRICHED} e) t
    where obtain_time >= '{P.POINTS_DAY}'""", *RICH_VIEWS)
add("quota_sum", f"select uid, min(uname) as uname, cast(sum(trunc(points)) as bigint) as points from {ENRICHED} e group by uid", *RICH_VIEWS)
add("quota_count", f"select uid, min(uname) as uname, count(*) as points from {ENRICHED} e group by uid", *RICH_VIEWS)

# --- recommendations ---

PAIRS = """
    (select a.game_id, b.game_id as game_id_rs, count(*) as download_num
     from (select distinct imei, game_id from fx_appdownload) a join (select distinct imei, game_id from fx_appdownload) b
     on a.imei = b.imei and a.game_id <> b.game_id group by 1, 2)"""
add("co_download_counts", f"select * from {PAIRS} p", "fx_appdownload")
for name, order in (("co_download_topk", "download_num desc, game_id_rs"),
                    ("co_download_topk_text", "concat(download_num, '_', game_id_rs)")):
    add(name, f"""
        select game_id, string_agg(cast(game_id_rs as varchar), '|' order by rn) as game_id_rs
        from (select *, row_number() over (partition by game_id order by {order}) as rn from {PAIRS} p) t
        where rn <= {P.TOP_K} group by game_id""", "fx_appdownload")
ORACLES["co_download_topk_pruned"] = ORACLES["co_download_topk"]
PRODUCT = " + ".join(
    f"((a.game_id * {i + 2} + {3 * i}) % 13 - 4) * ((b.game_id * {2 * i + 3} + {i}) % 11 - 5) * (case when b.game_id % 7 = 0 then 9 else 1 end)" for i in range(5))
add("als_lists_fixed", f"""
    with g as (select distinct cast(game_id as int) as game_id from fx_appdownload where game_id is not null),
    r as (select a.game_id, b.game_id as game_id_rs, row_number() over (partition by a.game_id order by {PRODUCT} desc, b.game_id) as rn
          from g a join g b on a.game_id <> b.game_id)
    select game_id, string_agg(cast(game_id_rs as varchar), '|' order by rn) as game_id_rs from r where rn <= {P.TOP_K} group by game_id""",
    "fx_appdownload")
add("als_ratings", """
    select cast(dense_rank() over (order by imei) - 1 as int) as user_id, game_id, cast(1 as float) as rating
    from fx_appdownload""", "fx_appdownload")

# --- streams ---

ORACLES["stream_resume"] = ORACLES["stream_replay_idempotent"] = ORACLES["os_day_count"]
add("stream_hour_window", f"""
    select {hour('channel_time')} as publish_time, channel_type as type, game_id, {CH} as expand_channel, count(*) as event_num
    from fx_channel group by 1, 2, 3, 4""", "fx_channel")
add("stream_late_rows", f"""
    select {hour('channel_time')} as publish_time,
           cast(sum(case when channel_time >= '{P.LATE_SPLIT_DAY}' then 1 else 0 end) as bigint) as on_time_num,
           cast(sum(case when channel_time < '{P.LATE_SPLIT_DAY}' then 1 else 0 end) as bigint) as late_num
    from fx_channel group by 1""", "fx_channel")

MEASURES = ("show_num", "download_num", "adpage_click_num", "request_num", "regi_account_num", "pay_money", "pay_account_num")


def _one(source: str, measure: str, value: str = "count(*)", where: str = "") -> str:
    cols = ", ".join(f"{value} as {m}" if m == measure else f"0 as {m}" for m in MEASURES)
    return f"select publish_time, game_id, expand_channel, {cols} from {source} x {where} group by 1, 2, 3"


LISTED = "game_id in (select game_id from fx_publish_game)"
CHANNEL_ROWS = f"(select {hour('channel_time')} as publish_time, game_id, {CH} as expand_channel, channel_type from fx_channel where {LISTED})"
ALL_MEASURES = " union all ".join([
    _one(CHANNEL_ROWS, "show_num", where="where channel_type = 1"),
    _one(CHANNEL_ROWS, "download_num", where="where channel_type = 2"),
    _one(CHANNEL_ROWS, "adpage_click_num", where="where channel_type = 3"),
    _one(f"(select * from {REQUESTS} q where {LISTED})", "request_num"),
    _one(f"(select {hour('reg_time')} as publish_time, game_id, {CH} as expand_channel from fx_regi where {LISTED})",
         "regi_account_num"),
    _one(f"({NET_PAY})", "pay_money", "sum(pay_money)"),
    _one(f"({FIRST_PAY})", "pay_account_num", "sum(pay_account_num)"),
])
SUMS = ", ".join(f"cast(sum({m}) as {'double' if m == 'pay_money' else 'bigint'}) as {m}" for m in MEASURES)
BASE_KPI = f"""
    (select {KEY}, {SUMS}
     from (select u.* exclude (expand_channel), {parts('upper(expand_channel)')} from ({ALL_MEASURES}) u) t
     where {FITS} group by {KEY})"""
BASE_VIEWS = ("fx_channel", "fx_request_line", "fx_regi", "fx_order", "fx_publish_game")
# Hours of accounts that only paid first there hold no additive measure, and the reverse.
add("stream_base_kpi", f"""
    select k.* exclude (pay_account_num), nullif(k.pay_account_num, 0) as pay_account_num,
           coalesce(cast(g.parent_game_id as varchar), '0') as parent_game_id,
           coalesce(cast(g.os as varchar), '1') as os, coalesce(cast(g.group_id as varchar), '0') as group_id,
           coalesce(p.medium_account, '') as medium_account, coalesce(p.promotion_channel, '') as promotion_channel,
           coalesce(d.promotion_mode, '') as promotion_mode, coalesce(d.head_people, '') as head_people
    from {BASE_KPI} k
    left join (select old_game_id, first(system_type order by group_id, system_type) as os,
                      min(group_id) as group_id, min(game_id) as parent_game_id
               from fx_game_sdk group by old_game_id) g on g.old_game_id = k.game_id
    left join fx_pkg p on upper(p.pkg_code) = k.ad_label
    left join fx_pkg_day d on upper(d.pkg_code) = k.ad_label and d.order_date = {day('k.publish_time')}""",
    *BASE_VIEWS, "fx_game_sdk", "fx_pkg", "fx_pkg_day")
ADDITIVE = MEASURES[:-1]
DAY_SUMS = ", ".join(f"cast(sum({m}) as {'double' if m == 'pay_money' else 'bigint'}) as {m}" for m in ADDITIVE)
ORACLES["stream_keyed_kpi"] = ORACLES["stream_base_kpi"]
add("stream_base_kpi_day", f"""
    select * from (select {day('publish_time')} as publish_date, game_id, parent_channel, child_channel, ad_label, {DAY_SUMS}
                   from {BASE_KPI.replace("cast(sum(pay_money) as double)", "sum(pay_money)")} k group by 1, 2, 3, 4, 5) t
    where {' or '.join(f'{m} <> 0' for m in ADDITIVE)}""", *BASE_VIEWS)

# --- invariants of the model fits ---

add("als_list_checks", """
    select cast(game_id as int) as game_id, cast(least(60, (select count(distinct game_id) from fx_appdownload) - 1) as bigint) as listed,
           cast(0 as bigint) as own, cast(0 as bigint) as repeated, cast(0 as bigint) as unknown
    from fx_appdownload group by 1""", "fx_appdownload")
add("als_rmse_checks", """
    select count(*) as ratings, count(*) as split, cast(0 as bigint) as shared, true as small from fx_appdownload""", "fx_appdownload")

# --- offline jobs ---


def folded(c: str) -> str:
    text = f"upper({c})"
    items = f"string_split(regexp_replace({text}, '_+$', ''), '_')"
    return (f"case when {text} in ('', '0') then '21' when regexp_replace({text}, '_+$', '') = '' or len({items}) < 3 then {text} "
            f"else array_to_string({items}[1:3], '_') end")


def credited(amount: str, time: str, extra: str, games: str) -> str:
    return f"""
        select {time} as t, o.game_id, r.ch, sum({amount}) as pay
        from (select distinct * from fx_order where order_status = 4 {extra} and {between('order_time')}) o
        join (select distinct game_account, {folded('expand_channel')} as ch from fx_regi where game_id in {games}) r
          on {key('o.game_account')} = {key('r.game_account')} group by 1, 2, 3"""


LISTED, IN_SDK = "(select game_id from fx_publish_game)", "(select old_game_id from fx_game_sdk)"
HOUR_PARTS = f"""
    select t, game_id, ch, pay as pay_money, null as pay_money_new, null as regi from ({credited('o.ori_price', hour('o.order_time'), '', LISTED)}) a
    union all
    select t, game_id, ch, null, pay, null from ({credited('o.ori_price + o.total_amt', hour('o.order_time'), 'and prod_type = 6', LISTED)}) b
    union all
    select {hour('reg_time')}, game_id, {folded('expand_channel')}, null, null, count(distinct game_account) from fx_regi
    where {between('reg_time')} and game_id in {LISTED} group by 1, 2, 3"""
DAY_PARTS = f"""
    select t, game_id, ch, pay as pay_money, null as regi, null as devices
    from ({credited('o.ori_price + o.total_amt', day('o.order_time'), 'and prod_type = 6', IN_SDK)}) a
    union all
    select {day('reg_time')}, game_id, {folded('expand_channel')}, null, count(distinct game_account), count(distinct imei) from fx_regi
    where {between('reg_time')} and game_id in {IN_SDK} group by 1, 2, 3"""
ATTRIBUTES = """
    (select old_game_id, cast(first(system_type order by group_id, system_type) as varchar) as os, cast(min(group_id) as varchar) as group_id,
            cast(min(game_id) as varchar) as parent_game_id from fx_game_sdk group by 1)"""
JOB_VIEWS = ("fx_order", "fx_regi", "fx_publish_game")
add("offline_kpi_hour", f"""
    select {KEY}, cast(sum(pay_money) as double) as pay_money, cast(sum(pay_money_new) as double) as pay_money_new,
           cast(sum(regi) as bigint) as regi_account_num
    from (select t as publish_time, game_id, {parts('ch')}, pay_money, pay_money_new, regi from ({HOUR_PARTS}) p) k
    where {FITS} group by {KEY}""", *JOB_VIEWS)
add("offline_kpi_day", f"""
    select d.*, a.os, a.group_id, a.parent_game_id from (
        select publish_date, game_id, parent_channel, child_channel, ad_label, cast(sum(pay_money) as double) as pay_money,
               cast(sum(regi) as bigint) as regi_account_num, cast(sum(devices) as bigint) as regi_device_num
        from (select t as publish_date, game_id, {parts('ch')}, pay_money, regi, devices from ({DAY_PARTS}) p) k
        where {FITS} group by 1, 2, 3, 4, 5) d
    left join {ATTRIBUTES} a on a.old_game_id = d.game_id""", "fx_order", "fx_regi", "fx_game_sdk")
ORACLES["offline_by_day"] = ORACLES["pay_money_day"]
add("offline_game_day", f"""
    select publish_date, game_id, os, group_id, parent_game_id, regi_device_num from (
        select {day('reg_time')} as publish_date, game_id, count(distinct imei) as regi_device_num from fx_regi
        where {between('reg_time')} group by 1, 2) d
    join (select old_game_id, cast(min(system_type) as varchar) as os, cast(min(group_id) as varchar) as group_id,
                 cast(min(game_id) as varchar) as parent_game_id from fx_game_sdk where system_type is not null group by 1) a
    on a.old_game_id = d.game_id""", "fx_regi", "fx_game_sdk")
add("offline_rejects", f"""
    select 'kpi_hour' as kind, count(*) as rows from (select t, game_id, {parts('ch')} from ({HOUR_PARTS}) p) k where not {FITS} having count(*) > 0
    union all
    select 'kpi_day', count(*) from (select t, game_id, {parts('ch')} from ({DAY_PARTS}) p) k where not {FITS} having count(*) > 0""",
    *JOB_VIEWS, "fx_game_sdk")
