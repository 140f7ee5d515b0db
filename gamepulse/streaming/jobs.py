"""The three stream jobs. Each is a `process(batch, batch_id)` over its merge tables."""

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse import schema as S
from gamepulse.functions.channel import PARTS, gate_channel, split_channel
from gamepulse.functions.times import day_key
from gamepulse.operators.dims import enrich_kpi
from gamepulse.operators.merge import INCREMENT, INSERT_ONLY, zero_stale
from gamepulse.plans import kpi_stream, points, side
from gamepulse.sources import logs
from gamepulse.streaming.account_state import ACCOUNT_BUCKETS, account_changes, account_events
from gamepulse.streaming.run import held, together
from gamepulse.streaming.store import AppendTable, MergeTable

Dims = Mapping[str, DataFrame]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REGI_KEYS = {
    "game_account": "string", "expand_channel": "string", "game_id": "int", "resource_id": "int",
    "publish_time": "string",
}
GAME_KEYS = {"game_id": "int"}


@dataclass(frozen=True)
class BaseKpiJob:
    """Hourly and daily base KPIs from the mixed log stream.

    What earlier batches told about games, registrations and first payments is kept as
    distinct rows; a batch adds its own rows to them before anything is counted, so
    registrations come before the orders of the same batch. `run_date` limits first-pay
    accounts to one day; without it every day is kept up to date.
    """

    root: str
    dims: Dims  # game_sdk, pkg, pkg_day; publish_game_main if parent games come from there
    run_date: str | None = None
    case: str = "upper"
    keep_rejects: bool = True
    writer: str = "base_kpi"

    @property
    def kpi_hour(self) -> MergeTable:
        return MergeTable(f"{self.root}/kpi_hour", S.KPI_HOUR_KEYS, S.KPI_HOUR_VALUES)

    @property
    def kpi_day(self) -> MergeTable:
        return MergeTable(f"{self.root}/kpi_day", S.KPI_DAY_KEYS, S.KPI_DAY_VALUES)

    @property
    def games(self) -> MergeTable:
        return MergeTable(f"{self.root}/games", GAME_KEYS)

    @property
    def regi(self) -> MergeTable:
        return MergeTable(f"{self.root}/regi", REGI_KEYS)

    @property
    def first_paid(self) -> MergeTable:
        return MergeTable(f"{self.root}/first_paid", kpi_stream.FIRST_PAY_KEYS)

    @property
    def rejects(self) -> AppendTable:
        return AppendTable(f"{self.root}/rejects", "kind string, value string")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        with held(batch.select("value")) as lines:
            if lines.isEmpty():
                return
            self._remember(lines, batch_id)
            self._count(lines, batch_id)

    def _remember(self, lines: DataFrame, batch_id: int) -> None:
        first = kpi_stream.first_payments(logs.parse(lines, "order"), self.run_date)
        kept = ((self.games, logs.parse(lines, "pubgame")), (self.regi, logs.parse(lines, "regi")), (self.first_paid, first))
        together(lines.sparkSession, *[lambda t=t, r=r: t.write(r, self.writer, batch_id, {}) for t, r in kept])

    def _count(self, lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        # Stored repeats are harmless here: each use below groups or tests for membership.
        games, regi = self.games.rows(spark), self.regi.rows(spark)
        rows = kpi_stream.batch_measures(lines, logs.parse(lines, "regi"), regi, games)
        self._store(lines, rows, self._pay_accounts(lines, regi, games), batch_id, S.STREAM_HOUR_POLICY)

    def _store(self, lines: DataFrame, rows: DataFrame, pay: DataFrame, batch_id: int, policy: Mapping[str, str]) -> None:
        """Writes the measures and first-pay counts of a batch by hour and by day, and what the gate turns down."""
        measures = list(S.STREAM_MEASURES)
        both = split_channel(rows, case=self.case).unionByName(pay, allowMissingColumns=True)
        merged = both.groupBy(*kpi_stream.KEY_COLUMNS).agg(
            *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures], F.sum("pay_account_num").alias("pay_account_num")
        )
        rich = enrich_kpi(
            merged, self.dims["game_sdk"], self.dims["pkg"], self.dims["pkg_day"], game_main=self.dims.get("publish_game_main"))
        # Kept with the rows the gate turns down, so all three outputs share one computation.
        with held(rich) as rich:
            hours, gated = gate_channel(rich)
            # Attributes depend on game, package and day only, so the days inherit them.
            days = kpi_stream.days_from_hours(hours.drop("pay_account_num"), measures)
            days = kpi_stream.nonzero(days, measures)
            writes = [
                lambda: self.kpi_hour.write(hours, self.writer, batch_id, policy, unique=True),
                lambda: self.kpi_day.write(days, self.writer, batch_id, S.STREAM_DAY_POLICY, unique=True),
            ]
            if self.keep_rejects:
                writes.append(lambda: self.rejects.write(self._rejects(lines, gated), self.writer, batch_id))
            self._run(lines.sparkSession, *writes)

    def _run(self, spark, *writes) -> None:
        together(spark, *writes)

    def _pay_accounts(self, lines: DataFrame, regi: DataFrame, games: DataFrame) -> DataFrame:
        """Counts of the days and games the batch touches; hours that lost all accounts become zero."""
        spark = regi.sparkSession
        first = self.first_paid.rows(spark)
        if self.run_date:
            first = first.filter(F.col("day") == self.run_date)
        touched = kpi_stream.touched_days(lines, first)
        day = touched.withColumnsRenamed({"day": "_day", "game_id": "_game"})

        def same_days(deltas: DataFrame) -> DataFrame:
            here = (day_key("publish_time") == F.col("_day")) & (F.col("game_id") == F.col("_game"))
            return deltas.join(day, here, "left_semi")

        stored = self.kpi_hour.read(spark, "pay_account_num", where=same_days).filter(F.col("pay_account_num") > 0)
        first = first.join(touched, ["day", "game_id"], "left_semi")
        counts = kpi_stream.first_pay_accounts_hour(first, regi, games)
        valid, _ = kpi_stream.keyed(counts, ["pay_account_num"], self.case)
        return zero_stale(stored, valid, kpi_stream.KEY_COLUMNS, ["pay_account_num"])

    @staticmethod
    def _rejects(lines: DataFrame, gated: DataFrame) -> DataFrame:
        kinds = ("pubgame", "regi", "order", "channel_hour")
        frames = [logs.rejects(lines, k).select(F.lit(k).alias("kind"), "value") for k in kinds]
        frames.append(logs.request_rejects(lines).select(F.lit("request").alias("kind"), "value"))
        text = F.to_json(F.struct(*kpi_stream.KEY_COLUMNS, *S.STREAM_MEASURES)).alias("value")
        frames.append(gated.select(F.lit("channel").alias("kind"), text))
        return reduce(DataFrame.unionByName, frames)

    def merge_tables(self) -> list[MergeTable]:
        return [self.kpi_hour, self.kpi_day, self.games, self.regi, self.first_paid]

    def compact(self, spark) -> None:
        compact(spark, self.merge_tables())


PENDING_KEYS = {"publish_time": "string", "game_id": "int", "expand_channel": "string", "regi_games": "string"}


@dataclass(frozen=True)
class KeyedKpiJob(BaseKpiJob):
    """The same tables from keyed state: a batch reads the states its accounts are in, and no stored rows.

    `stream` turns lines into lines and changes of accounts, which `process` stores, so it runs on streams only. First-pay
    accounts arrive as differences and are added up. Those whose registered games are not listed yet wait in
    `pending`, which is read only by a batch that lists a new game. `account_buckets` is the number of states and belongs
    to the checkpoint.
    """

    account_buckets: int = ACCOUNT_BUCKETS

    @property
    def pending(self) -> MergeTable:
        return MergeTable(f"{self.root}/pending", PENDING_KEYS, {"pay_account_num": "bigint"})

    def stream(self, lines: DataFrame) -> DataFrame:
        lines.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        raw = lines.select("value")
        changes = account_changes(account_events(raw, self.run_date), self.account_buckets)
        return raw.unionByName(changes, allowMissingColumns=True)

    def _run(self, spark, *writes) -> None:
        """One after the other: the rows of a batch come out of the state store."""
        for write in writes:
            write()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        with held(batch) as rows:
            if rows.isEmpty():
                return
            lines = rows.filter("value is not null").select("value")
            changes = rows.filter("value is null").drop("value")
            spark = lines.sparkSession
            before = self.games.rows(spark, without=(self.writer, batch_id))
            named = logs.parse(lines, "pubgame").select("game_id").distinct()
            with held(named.join(before, "game_id", "left_anti")) as new:
                games = before.union(new)
                if lists_games := not new.isEmpty():
                    self.games.write(new, self.writer, batch_id, {})
                marked = kpi_stream.with_listed_games(changes, games)
                money = marked.filter("listed").groupBy(*kpi_stream.GROUP).agg(F.sum("pay_money").cast("decimal(38,2)").alias("pay_money"))
                money = money.filter("pay_money is not null")
                accounts = marked.filter("pay_account_num is not null").select(*PENDING_KEYS, "pay_account_num", "listed")
                moved = self._pending_of(new, batch_id) if lists_games else None
                self._wait(accounts, moved, batch_id)
                if moved is not None:
                    accounts = accounts.unionByName(moved.withColumn("listed", F.lit(True)))
                counts = accounts.filter("listed").groupBy(*kpi_stream.GROUP).agg(F.sum("pay_account_num").alias("pay_account_num"))
                pay, _ = kpi_stream.keyed(counts, ["pay_account_num"], self.case)
                measured = kpi_stream.batch_counts(lines, logs.parse(lines, "regi"), games).unionByName(money, allowMissingColumns=True)
                policy = {**S.STREAM_HOUR_POLICY, "pay_account_num": INCREMENT}
                self._store(lines, measured, pay.filter("pay_account_num <> 0"), batch_id, policy)

    def _pending_of(self, new: DataFrame, batch_id: int) -> DataFrame:
        """Waiting counts with one of the new games behind them."""
        own = (F.col("writer") == self.writer) & (F.col("batch_id") == str(batch_id))
        waiting = self.pending.read(new.sparkSession, where=lambda d: d.filter(~own)).filter("pay_account_num <> 0")
        return kpi_stream.with_listed_games(waiting, new).filter("listed").drop("listed")

    def _wait(self, accounts: DataFrame, moved: DataFrame | None, batch_id: int) -> None:
        """Keeps the counts that no listed game is behind, and takes out those that move."""
        waits = accounts.filter("not listed").drop("listed")
        if moved is not None:
            waits = waits.unionByName(moved.withColumn("pay_account_num", -F.col("pay_account_num")))
        if not waits.isEmpty():
            self.pending.write(waits, self.writer, batch_id, {"pay_account_num": INCREMENT})

    def merge_tables(self) -> list[MergeTable]:
        return [self.kpi_hour, self.kpi_day, self.games, self.pending]


@dataclass(frozen=True)
class SideJob:
    """System counts per day, login accounts per hour and activation events."""

    root: str
    login_game_field: int = 8
    writer: str = "side"

    @property
    def games(self) -> MergeTable:
        return MergeTable(f"{self.root}/games", GAME_KEYS)

    @property
    def os_day(self) -> MergeTable:
        return MergeTable(f"{self.root}/os_day", S.OS_DAY_KEYS, S.OS_DAY_VALUES)

    @property
    def logins(self) -> MergeTable:
        return MergeTable(f"{self.root}/login_hour", S.LOGIN_HOUR_KEYS)

    @property
    def rejects(self) -> AppendTable:
        return AppendTable(f"{self.root}/side_rejects", "kind string, value string")

    @property
    def active(self) -> AppendTable:
        columns = ["game_id int", *[f"{p} string" for p in PARTS], "imei string", "update_time string"]
        return AppendTable(f"{self.root}/active", ", ".join(columns))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        with held(batch.select("value")) as lines:
            if lines.isEmpty():
                return
            self.games.write(logs.parse(lines, "pubgame"), self.writer, batch_id, {})
            games = self.games.read(lines.sparkSession)
            self.os_day.write(side.os_day_count(lines, games), self.writer, batch_id, {"os_sum": INCREMENT})
            logins = side.login_accounts_hour(lines, games, self.login_game_field)
            self.logins.write(logins, self.writer, batch_id, {}, unique=True)
            self.active.write(side.active_events(lines, games), self.writer, batch_id)
            self.rejects.write(side.side_rejects(lines, self.login_game_field), self.writer, batch_id)

    def merge_tables(self) -> list[MergeTable]:
        return [self.games, self.os_day, self.logins]


@dataclass(frozen=True)
class PointsJob:
    """Points detail with the running total, and the members' quotas."""

    root: str
    dims: Dims  # binds, members, game_names
    integral: int
    quota: str = "sum"  # or "count": one point per detail row
    writer: str = "points"

    @property
    def detail(self) -> AppendTable:
        return AppendTable(
            f"{self.root}/points",
            "obtain_time string, obtain_id string, uid string, uname string, game_id int, game_name string, "
            "points bigint, ori_price double, resource int, real_points bigint",
        )

    @property
    def totals(self) -> AppendTable:
        """One row per batch: the sum of its points. Later batches start from these."""
        return AppendTable(f"{self.root}/points_totals", "points bigint")

    @property
    def rejects(self) -> AppendTable:
        return AppendTable(f"{self.root}/points_rejects", "kind string, value string")

    @property
    def quotas(self) -> MergeTable:
        return MergeTable(f"{self.root}/quota", S.QUOTA_KEYS, S.QUOTA_VALUES)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        with held(batch.select("value")) as lines:
            if lines.isEmpty():
                return
            rows, bad = points.points_gate(points.points_union(
                logs.parse(lines, "points_signin"), logs.parse(lines, "points_recharge")
            ))
            refused = bad.select(F.lit("amount").alias("kind"), F.to_json(F.struct(*bad.columns)).alias("value"))
            for kind in ("points_signin", "points_recharge"):
                refused = refused.unionByName(logs.rejects(lines, kind).select(F.lit(kind).alias("kind"), "value"))
            self.rejects.write(refused, self.writer, batch_id)
            resolved = points.resolve_points(rows, self.dims["binds"], self.dims["game_names"], self.integral)
            rich = points.name_members(resolved, self.dims["members"])
            earlier = self.totals.read(lines.sparkSession, without=(self.writer, batch_id))
            total = points.points_total(earlier).first()[0]  # one row per batch
            self.detail.write(points.points_running_total(rich, total), self.writer, batch_id)
            own = self.detail.batch(lines.sparkSession, self.writer, batch_id).agg(F.sum("points").alias("points"))
            self.totals.write(own, self.writer, batch_id)
            quota = points.quota_sum if self.quota == "sum" else points.quota_count
            rules = {"uname": INSERT_ONLY, "points": INCREMENT}
            self.quotas.write(quota(resolved, self.dims["members"]), self.writer, batch_id, rules, unique=True)

    def merge_tables(self) -> list[MergeTable]:
        return [self.quotas]


def compact(spark, tables: list[MergeTable]) -> None:
    """Fold the commits of the tables and delete what the new bases cover; no writer may be active."""
    for table in tables:
        table.compact(spark)
        table.drop_covered(spark)
