"""Every registered query: (session, folder of the test tables) -> DataFrame."""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamepulse import jobs
from gamepulse.checks import params as P
from gamepulse.checks import stream_queries
from gamepulse.functions.channel import PARTS, default_channel, gate_channel, split_channel
from gamepulse.functions.times import access_log_hour, day_range
from gamepulse.operators.accounts import listed_games
from gamepulse.operators.day_table import DayTable
from gamepulse.operators.dims import enrich_game_group, enrich_packages
from gamepulse.operators.merge import INCREMENT, INSERT_ONLY, OVERWRITE, insert_or_touch, upsert
from gamepulse.plans import activity, bills, cohort, kpi_batch, kpi_stream, points, recommend, side, sketches
from gamepulse.session import new_folder
from gamepulse.sources import logs
from gamepulse.sources.fixtures import fixture_tables, log_lines
from gamepulse.sources.tables import text_lines
from gamepulse.streaming.store import AppendTable

Tables = Mapping[str, DataFrame]
KPI_KEYS = ["publish_time", "game_id", *PARTS]
RANGE = (P.KPI_START, P.KPI_END)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(fixture_tables(spark, sf_dir))
    return fn


def _double(rows: DataFrame, *names: str) -> DataFrame:
    """Money as double, only where results are compared."""
    return rows.withColumns({c: F.col(c).cast("double") for c in names})


# --- warehouse KPIs -----------------------------------------------------------------------


@register
def pay_money_hour(t: Tables) -> DataFrame:
    return _double(kpi_batch.pay_money_hour(t["fx_order"], t["fx_regi"], t["fx_publish_game"], *RANGE), "pay_money")


@register
def pay_money_new_hour(t: Tables) -> DataFrame:
    return _double(kpi_batch.pay_money_new_hour(t["fx_order"], t["fx_regi"], t["fx_publish_game"], *RANGE), "pay_money")


@register
def pay_money_day(t: Tables) -> DataFrame:
    return _double(kpi_batch.pay_money_day(t["fx_order"], t["fx_regi"], t["fx_game_sdk"], *RANGE), "pay_money")


@register
def regi_accounts_hour(t: Tables) -> DataFrame:
    return kpi_batch.regi_accounts_hour(t["fx_regi"], t["fx_publish_game"], *RANGE)


@register
def regi_accounts_devices_day(t: Tables) -> DataFrame:
    return kpi_batch.regi_accounts_devices_day(t["fx_regi"], t["fx_game_sdk"], *RANGE)


@register
def regi_devices_game_day(t: Tables) -> DataFrame:
    return kpi_batch.regi_devices_game_day(t["fx_regi"], t["fx_game_sdk"], *RANGE)


@register
def pay_accounts_hour(t: Tables) -> DataFrame:
    return kpi_batch.pay_accounts_hour(t["fx_order"], t["fx_regi"], t["fx_publish_game"], *RANGE)


@register
def pay_accounts_day(t: Tables) -> DataFrame:
    return kpi_batch.pay_accounts_day(t["fx_order"], t["fx_regi"], t["fx_game_sdk"], *RANGE)


def _clicks(t: Tables) -> DataFrame:
    return kpi_batch.clicks_hour(t["fx_channel"], t["fx_publish_game"], *RANGE)


@register
def click_show_hour(t: Tables) -> DataFrame:
    return kpi_batch.click_count(_clicks(t), "show_num")


@register
def click_show_day(t: Tables) -> DataFrame:
    return kpi_batch.click_count(_clicks(t), "show_num", "day")


@register
def click_download_hour(t: Tables) -> DataFrame:
    return kpi_batch.click_count(_clicks(t), "download_num")


@register
def click_download_day(t: Tables) -> DataFrame:
    return kpi_batch.click_count(_clicks(t), "download_num", "day")


@register
def click_adpage_hour(t: Tables) -> DataFrame:
    return kpi_batch.click_count(_clicks(t), "adpage_click_num")


@register
def click_adpage_day(t: Tables) -> DataFrame:
    return kpi_batch.click_count(_clicks(t), "adpage_click_num", "day")


@register
def request_hour(t: Tables) -> DataFrame:
    return kpi_batch.requests_hour(log_lines(t, "request"), t["fx_publish_game"], *RANGE)


@register
def request_day(t: Tables) -> DataFrame:
    return kpi_batch.requests_day(log_lines(t, "request"), t["fx_publish_game"], *RANGE)


@register
def retention(t: Tables) -> DataFrame:
    return cohort.retention(t["fx_regi"], t["fx_login"], t["fx_publish_game"], P.COHORT_DAY)


@register
def retention_bitmap(t: Tables) -> DataFrame:
    """Retention from masks of active days, kept as a table and merged from two ranges of days."""
    spark = t["fx_login"].sparkSession
    table = AppendTable(new_folder(spark, "activity"), activity.MASK_SCHEMA)
    early = F.col("login_time") < P.LATE_SPLIT_DAY
    for n, rows in enumerate((t["fx_login"].filter(early), t["fx_login"].filter(~early))):
        table.write(activity.activity_masks(rows), "logins", n)
    return activity.retention_from_masks(t["fx_regi"], activity.merged_masks(table.read(spark)), t["fx_publish_game"], P.COHORT_DAY)


@register
def regi_distinct_sketch_day(t: Tables) -> DataFrame:
    """Exact counts per day, and whether those of hourly sketches, stored in two increments, are within two percent."""
    spark, keys = t["fx_regi"].sparkSession, list(sketches.KEYS)
    table = AppendTable(new_folder(spark, "sketches"), sketches.SKETCH_SCHEMA)
    early = F.col("reg_time") < P.LATE_SPLIT_DAY
    for n, rows in enumerate((t["fx_regi"].filter(early), t["fx_regi"].filter(~early))):
        table.write(kpi_batch.regi_sketches_hour(rows, *RANGE), "regi", n)
    names = ("regi_num", "regi_device_num")
    rough = sketches.counted(sketches.days_of(table.read(spark))).withColumnsRenamed({c: f"rough_{c}" for c in names})
    exact = kpi_batch.regi_key_day(t["fx_regi"], t["fx_game_sdk"], *RANGE)
    both = exact.join(rough, keys, "left")
    near = lambda c: F.coalesce(F.abs(F.col(f"rough_{c}") - F.col(c)) <= F.col(c) * 0.02, F.lit(False))
    return both.select(*keys, *names, near("regi_num").alias("accounts_near"), near("regi_device_num").alias("devices_near"))


@register
def ltv(t: Tables) -> DataFrame:
    rows = cohort.ltv(t["fx_regi"], t["fx_order"], t["fx_publish_game"], P.COHORT_DAY)
    return _double(rows, *[c for c in rows.columns if c.startswith("ltv_")])


@register
def sdk_bills(t: Tables) -> DataFrame:
    return _double(bills.sdk_bills(
        t["fx_cp_req"], t["fx_bgameaccount"], t["fx_bgame"], t["fx_receipt"], P.BILL_START, P.BILL_END
    ), "amount")


@register
def anti_sandbox_orders(t: Tables) -> DataFrame:
    rows = bills.without_sandbox(t["fx_cp_req"], t["fx_receipt"])
    return rows.withColumn("amount", F.col("amount").cast("double"))


@register
def whitelist_semi(t: Tables) -> DataFrame:
    regi = t["fx_regi"].select("game_account", "game_id", "expand_channel", "reg_time")
    return listed_games(regi, t["fx_publish_game"])


def _offline(t: Tables) -> str:
    """Folder of the results of the offline base job over the KPI days."""
    out = new_folder(t["fx_order"].sparkSession, "offline")
    names = {"orders": "fx_order", "registrations": "fx_regi", "publish_games": "fx_publish_game", "game_sdk": "fx_game_sdk"}
    args = jobs.arguments(["base-kpi-offline", "--out", out, "--start", P.KPI_START, "--end", P.KPI_END, "--run-id", "check"])
    jobs.base_kpi_offline({n: t[v] for n, v in names.items()}, jobs.results(out), args)
    return out


@register
def offline_kpi_hour(t: Tables) -> DataFrame:
    rows = jobs.results(_offline(t))["kpi_hour"].read(t["fx_order"].sparkSession)
    return _double(rows.select(*KPI_KEYS, "pay_money", "pay_money_new", "regi_account_num"), "pay_money", "pay_money_new")


@register
def offline_kpi_day(t: Tables) -> DataFrame:
    rows = jobs.results(_offline(t))["kpi_day"].read(t["fx_order"].sparkSession)
    keys = ["publish_date", *KPI_KEYS[1:]]
    return _double(rows.select(
        *keys, "pay_money", "regi_account_num", "regi_device_num", "os", "group_id", "parent_game_id"), "pay_money")


@register
def offline_game_day(t: Tables) -> DataFrame:
    return jobs.results(_offline(t))["game_day"].read(t["fx_order"].sparkSession)


@register
def offline_by_day(t: Tables) -> DataFrame:
    """Daily revenue from a table by day: a run that missed one day's afternoon, then a rerun of that day."""
    spark, regi, sdk = t["fx_order"].sparkSession, t["fx_regi"], t["fx_game_sdk"]
    table = DayTable(new_folder(spark, "by-day"))
    rerun = P.LATE_SPLIT_DAY
    missed = (F.col("order_time") >= f"{rerun} 12") & (F.col("order_time") <= f"{rerun} 24")
    rows = kpi_batch.pay_money_day(t["fx_order"].filter(~missed), regi, sdk, *RANGE)
    table.write(rows, "publish_time", *RANGE)
    table.write(kpi_batch.pay_money_day(t["fx_order"], regi, sdk, rerun, rerun), "publish_time", rerun, rerun)
    schema = ", ".join(f"{n} {k}" for n, k in rows.dtypes)
    return _double(table.read(spark, schema, *RANGE).drop("day"), "pay_money")


@register
def offline_rejects(t: Tables) -> DataFrame:
    """How many rows the job refused, per result."""
    return jobs.rejects_table(_offline(t)).read(t["fx_order"].sparkSession).groupBy("kind").agg(F.count("*").alias("rows"))


# --- log lines ----------------------------------------------------------------------------


def _parsed(t: Tables, lines: str, kind: str) -> DataFrame:
    return logs.parse(log_lines(t, lines), kind)


@register
def parse_pubgame(t: Tables) -> DataFrame:
    return _parsed(t, "pubgame", "pubgame")


@register
def parse_channel_hour(t: Tables) -> DataFrame:
    return _parsed(t, "channel", "channel_hour")


@register
def parse_channel_os(t: Tables) -> DataFrame:
    return _parsed(t, "channel", "channel_os")


@register
def parse_active_hour(t: Tables) -> DataFrame:
    return _parsed(t, "active", "active_hour")


@register
def parse_active_device(t: Tables) -> DataFrame:
    return _parsed(t, "active", "active_device")


@register
def parse_order_hour(t: Tables) -> DataFrame:
    rows = _parsed(t, "order", "order_hour")
    return rows.withColumn("paymoney", F.col("paymoney").cast("double"))


@register
def parse_order(t: Tables) -> DataFrame:
    return _parsed(t, "order", "order").withColumn("paymoney", F.col("paymoney").cast("double"))


@register
def paid_on_date(t: Tables) -> DataFrame:
    rows = logs.paid_on(_parsed(t, "order", "order"), P.POINTS_DAY)
    return rows.withColumn("paymoney", F.col("paymoney").cast("double"))


@register
def parse_regi(t: Tables) -> DataFrame:
    return _parsed(t, "regi", "regi")


@register
def parse_login_day(t: Tables) -> DataFrame:
    return _parsed(t, "login_old", "login_day")


@register
def parse_login_hour(t: Tables) -> DataFrame:
    return _parsed(t, "login", "login_hour")


@register
def parse_request(t: Tables) -> DataFrame:
    return logs.parse_request(log_lines(t, "request"))


@register
def parse_request_batch(t: Tables) -> DataFrame:
    return logs.parse_request_batch(log_lines(t, "request"))


@register
def parse_points_signin(t: Tables) -> DataFrame:
    return _parsed(t, "signin", "points_signin")


@register
def parse_points_recharge(t: Tables) -> DataFrame:
    return _parsed(t, "recharge", "points_recharge")


@register
def parse_appdownload(t: Tables) -> DataFrame:
    return _parsed(t, "appdownload", "appdownload")


@register
def access_log_hours(t: Tables) -> DataFrame:
    return t["fx_request_line"].select("event_id", access_log_hour("line").alias("publish_time"))


QUERIES["access_log_hour"] = QUERIES.pop("access_log_hours")


def scan_text_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "text-logs")
    log_lines(fixture_tables(spark, sf_dir), "channel", "request").write.text(folder)
    return text_lines(spark, folder).withColumnRenamed("value", "line")


QUERIES["scan_text_logs"] = scan_text_logs


# --- channels, dimensions, merging ----------------------------------------------------------


@register
def channel_defaults(t: Tables) -> DataFrame:
    rows = t["fx_login"].select("game_account", "login_time", "expand_channel")
    marked = F.when(F.col("expand_channel") == "solo", F.lit("\\N")).otherwise(F.col("expand_channel"))
    return rows.select("game_account", "login_time", default_channel(marked).alias("expand_channel"))


QUERIES["channel_default"] = QUERIES.pop("channel_defaults")


@register
def channel_split(t: Tables) -> DataFrame:
    rows = t["fx_channel"].select("game_id", "channel_time", "expand_channel")
    return split_channel(rows)


def _split_regi(t: Tables) -> DataFrame:
    regi = t["fx_regi"].select("game_account", "reg_time", "game_id", "expand_channel")
    return split_channel(regi.withColumn("channel", F.col("expand_channel")), "channel")


@register
def channel_gate_valid(t: Tables) -> DataFrame:
    return gate_channel(_split_regi(t))[0]


@register
def channel_gate_rejects(t: Tables) -> DataFrame:
    return gate_channel(_split_regi(t))[1]


def _click_rows(t: Tables, days: tuple[str, str]) -> DataFrame:
    """Keyed hourly ad counts of some days."""
    rows = kpi_batch.clicks_hour(t["fx_channel"], t["fx_publish_game"], *days)
    return kpi_stream.keyed(rows, ["show_num", "download_num", "adpage_click_num"])[0]


@register
def upsert_overwrite(t: Tables) -> DataFrame:
    batch = _click_rows(t, P.BATCH_DAYS).withColumns({"show_num": F.col("show_num") * 10})
    rules = {"show_num": OVERWRITE, "download_num": OVERWRITE}
    return upsert(_click_rows(t, P.TARGET_DAYS), batch, KPI_KEYS, rules)


@register
def upsert_increment(t: Tables) -> DataFrame:
    rules = {m: INCREMENT for m in ("show_num", "download_num", "adpage_click_num")}
    return upsert(_click_rows(t, P.TARGET_DAYS), _click_rows(t, P.BATCH_DAYS), KPI_KEYS, rules)


@register
def upsert_mixed(t: Tables) -> DataFrame:
    target = _click_rows(t, P.TARGET_DAYS).withColumn("head_people", F.lit("first"))
    batch = _click_rows(t, P.BATCH_DAYS).withColumn("head_people", F.lit("second"))
    rules = {
        "show_num": INCREMENT, "download_num": INCREMENT, "adpage_click_num": OVERWRITE, "head_people": INSERT_ONLY,
    }
    return upsert(target, batch, KPI_KEYS, rules)


@register
def kpi_day_from_hour(t: Tables) -> DataFrame:
    hours = _click_rows(t, P.ALL_DAYS)
    return kpi_stream.days_from_hours(hours, ["show_num", "download_num", "adpage_click_num"])


@register
def daily_nonzero_filter(t: Tables) -> DataFrame:
    """Only show counts stay: days with downloads or ad pages alone become all-zero rows."""
    rows = _click_rows(t, P.ALL_DAYS).select(*KPI_KEYS, "show_num", F.lit(0).cast("bigint").alias("download_num"))
    days = kpi_stream.days_from_hours(rows, ["show_num", "download_num"])
    return kpi_stream.nonzero(days, ["show_num", "download_num"])


def _show_rows(t: Tables) -> DataFrame:
    hours = kpi_batch.click_count(kpi_batch.clicks_hour(t["fx_channel"], t["fx_publish_game"], *P.ALL_DAYS), "show_num")
    return kpi_stream.keyed(hours, ["show_num"])[0]


@register
def enrich_game_groups(t: Tables) -> DataFrame:
    return enrich_game_group(_show_rows(t), t["fx_game_sdk"])


QUERIES["enrich_game_group"] = QUERIES.pop("enrich_game_groups")


@register
def enrich_pkg_dims(t: Tables) -> DataFrame:
    return enrich_packages(_show_rows(t), t["fx_pkg"], t["fx_pkg_day"])


@register
def union_distinct_regi(t: Tables) -> DataFrame:
    """History and a batch that overlap, as one distinct set."""
    rows = logs.parse(log_lines(t, "regi"), "regi")
    history = day_range(rows.withColumn("t", F.concat("publish_time", F.lit(":00:00"))), "t", None, "2024-01-12")
    batch = day_range(rows.withColumn("t", F.concat("publish_time", F.lit(":00:00"))), "t", "2024-01-08", None)
    return history.drop("t").union(batch.drop("t")).distinct()


# --- stream measures as batch functions -------------------------------------------------------


@register
def net_pay_money_hour(t: Tables) -> DataFrame:
    orders = logs.parse(log_lines(t, "order"), "order")
    rows = kpi_stream.net_pay_money_hour(orders, logs.parse(log_lines(t, "regi"), "regi"), t["fx_publish_game"])
    return rows.withColumn("pay_money", F.col("pay_money").cast("double"))


@register
def first_pay_accounts_hour(t: Tables) -> DataFrame:
    orders = logs.parse(log_lines(t, "order"), "order")
    regi = logs.parse(log_lines(t, "regi"), "regi")
    return kpi_stream.first_pay_accounts_hour(kpi_stream.first_payments(orders), regi, t["fx_publish_game"])


@register
def os_day_count(t: Tables) -> DataFrame:
    return side.os_day_count(log_lines(t, "channel"), t["fx_publish_game"])


@register
def login_accounts_hour(t: Tables) -> DataFrame:
    """New accounts only: the days before the range are already stored."""
    rows = side.login_accounts_hour(log_lines(t, "login"), t["fx_publish_game"])
    known = rows.filter(F.col("login_time") < P.KPI_START)
    return insert_or_touch(known, rows, rows.columns)


@register
def active_events(t: Tables) -> DataFrame:
    return side.active_events(log_lines(t, "active"), t["fx_publish_game"])


# --- points -------------------------------------------------------------------------------


def _points(t: Tables) -> DataFrame:
    return points.points_union(
        logs.parse(log_lines(t, "signin"), "points_signin"), logs.parse(log_lines(t, "recharge"), "points_recharge")
    )


def _resolved(t: Tables) -> DataFrame:
    return points.resolve_points(_points(t), t["fx_account_bind"], t["fx_game_name"], P.INTEGRAL)


def _enriched(t: Tables) -> DataFrame:
    return points.enrich_points(_points(t), t["fx_account_bind"], t["fx_member"], t["fx_game_name"], P.INTEGRAL)


@register
def points_union(t: Tables) -> DataFrame:
    return _points(t)


@register
def enrich_points(t: Tables) -> DataFrame:
    return _enriched(t)


@register
def points_running_total(t: Tables) -> DataFrame:
    """Rows from the points day on, continuing the stored total of the days before."""
    rows = _enriched(t)
    stored = points.points_total(rows.filter(F.col("obtain_time") < P.POINTS_DAY)).scalar()
    return points.points_running_total(rows.filter(F.col("obtain_time") >= P.POINTS_DAY), stored)


@register
def quota_sum(t: Tables) -> DataFrame:
    return points.quota_sum(_resolved(t), t["fx_member"])


@register
def quota_count(t: Tables) -> DataFrame:
    return points.quota_count(_resolved(t), t["fx_member"])


# --- recommendations ------------------------------------------------------------------------


@register
def co_download_counts(t: Tables) -> DataFrame:
    return recommend.co_download_counts(t["fx_appdownload"])


@register
def co_download_topk(t: Tables) -> DataFrame:
    return recommend.co_download_topk(recommend.co_download_counts(t["fx_appdownload"]), P.TOP_K)


@register
def co_download_topk_text(t: Tables) -> DataFrame:
    return recommend.co_download_topk(recommend.co_download_counts(t["fx_appdownload"]), P.TOP_K, "text")


@register
def co_download_topk_pruned(t: Tables) -> DataFrame:
    return recommend.co_download_topk_pruned(t["fx_appdownload"], P.TOP_K)


@register
def als_lists_fixed(t: Tables) -> DataFrame:
    """Lists from whole-number factors computed from the games, so that SQL can repeat the search over all games."""
    games = t["fx_appdownload"].select(F.col("game_id").cast("int").alias("id")).filter("id is not null").distinct()
    features = [((F.col("id") * (2 * i + 3) + i) % 11 - 5) * F.when(F.col("id") % 7 == 0, 9).otherwise(1) for i in range(5)]
    tastes = [(F.col("id") * (i + 2) + 3 * i) % 13 - 4 for i in range(5)]
    made = games.select("id", F.array(*[x.cast("double") for x in features]).alias("features"))
    taste = games.select(F.col("id").alias("game_id"), F.array(*[x.cast("double") for x in tastes]).alias("taste"))
    return recommend.factor_lists(taste, made, P.TOP_K, block=16)


def _downloads(t: Tables) -> DataFrame:
    return logs.parse(log_lines(t, "appdownload"), "appdownload")


@register
def als_ratings(t: Tables) -> DataFrame:
    return recommend.als_ratings(_downloads(t))


@register
def als_rmse(t: Tables) -> DataFrame:
    return recommend.als_rmse(recommend.als_ratings(_downloads(t)), rank=10, reg_param=0.1, iterations=10)


@register
def als_recommend(t: Tables) -> DataFrame:
    ratings = recommend.als_ratings(_downloads(t))
    return recommend.als_lists(recommend.fit_als(ratings), ratings)


@register
def als_list_checks(t: Tables) -> DataFrame:
    """What every list must hold: its length, and no entry that is the game itself, a repeat or unknown."""
    ratings = recommend.als_ratings(_downloads(t))
    model = recommend.fit_als(ratings, recommend.AlsGrid((5,), (0.1,), (5,)))
    entries = recommend.als_lists(model, ratings).select("game_id", F.explode(F.split("game_id_rs", "\\|")).alias("other"))
    known = ratings.select(F.col("game_id").cast("string").alias("other")).distinct().withColumn("known", F.lit(1))
    return entries.join(known, "other", "left").groupBy("game_id").agg(
        F.count("*").alias("listed"), F.count_if(F.col("other") == F.col("game_id").cast("string")).alias("own"),
        (F.count("*") - F.count_distinct("other")).alias("repeated"), F.count_if(F.col("known").isNull()).alias("unknown"))


@register
def als_rmse_checks(t: Tables) -> DataFrame:
    """The split covers all ratings, no pair is on both sides, and the held-out error is small."""
    ratings = recommend.als_ratings(_downloads(t))
    train, test = recommend.split_pairs(ratings)
    both = train.select("user_id", "game_id").distinct().join(test.select("user_id", "game_id").distinct(), ["user_id", "game_id"])
    error = recommend.als_rmse(ratings, rank=10, reg_param=0.1, iterations=10)
    return ratings.agg(F.count("*").alias("ratings")).select(
        "ratings", (train.agg(F.count("*")).scalar() + test.agg(F.count("*")).scalar()).alias("split"),
        both.agg(F.count("*")).scalar().alias("shared"), (error.select("rmse").scalar() < 0.6).alias("small"))


QUERIES.update(stream_queries.QUERIES)
