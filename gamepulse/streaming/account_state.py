"""Keyed state of a stream: what is known of each account, and what a micro-batch changes in its counts.

An account keeps its distinct registrations and its first paid order of every day and game. Accounts share states by
a hash; a batch meets only the states its accounts are in.
"""

import json
from collections import Counter
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gamepulse.functions.times import day_key, hour_key
from gamepulse.plans.kpi_batch import PAID, REFUNDED
from gamepulse.sources import logs

REGISTERED, AMOUNT, FIRST = "registered", "amount", "first"
EVENTS = (
    "game_account string, kind string, game_id int, expand_channel string, resource_id int, time string, "
    "amount decimal(38,2), first string"
)
CHANGES = (
    "publish_time string, game_id int, expand_channel string, regi_games string, pay_money decimal(38,2), pay_account_num bigint"
)
STATE = "known string"
ACCOUNT_BUCKETS = 1 << 13
EVENT_KEYS = ["game_account", "kind", "game_id", "expand_channel", "resource_id", "time"]


def account_events(lines: DataFrame, run_date: str | None = None) -> DataFrame:
    """What lines say of accounts, reduced within each record batch so that a busy account is few rows.

    `registered` rows are registrations, `amount` rows signed amounts per hour, `first` rows the earliest paid
    time per day, of `run_date` or of every day.
    """
    regi = logs.parse(lines, "regi").select(
        "game_account", F.lit(REGISTERED).alias("kind"), "game_id", "expand_channel", "resource_id", F.col("publish_time").alias("time"),
        F.lit(None).cast("decimal(38,2)").alias("amount"), F.lit(None).cast("string").alias("first"))
    orders = logs.parse(lines, "order").filter(F.col("order_status").isin(PAID, REFUNDED))
    paid = F.col("order_status") == PAID
    signed = F.when(paid, F.col("paymoney")).otherwise(-F.col("paymoney")).cast("decimal(38,2)")
    counted = paid if run_date is None else paid & (day_key("order_time") == run_date)

    def event(kind: str, time, amount, first) -> F.Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.col("game_id"), F.lit(None).cast("string").alias("expand_channel"), F.lit(None).cast("int").alias("resource_id"),
            time.alias("time"), amount.cast("decimal(38,2)").alias("amount"), first.cast("string").alias("first"))

    both = F.array(
        event(AMOUNT, hour_key("order_time"), signed, F.lit(None)),
        F.when(counted, event(FIRST, day_key("order_time"), F.lit(None), F.col("order_time"))))
    sales = orders.select("game_account", F.inline(F.filter(both, lambda e: e.isNotNull())))
    events = regi.unionByName(sales).filter(F.col("game_account").isNotNull())
    return events.mapInArrow(_reduced, EVENTS)


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one = pa.Table.from_batches([batch]).group_by(EVENT_KEYS, use_threads=False).aggregate([("amount", "sum"), ("first", "min")])
        one = one.rename_columns([c.removesuffix("_sum").removesuffix("_min") for c in one.column_names])
        yield from one.select([f.split()[0] for f in EVENTS.split(", ")]).to_batches()


def _positions(regi: dict, first: dict, days: list[str]) -> Counter:
    """How often the account counts at each (hour, game, channel, registered games), over some of its days."""
    sets = {channel: ",".join(sorted(games)) for channel, games in regi.items()}
    return Counter((first[d].split(":")[0], int(d.split("|")[1]), channel, games) for d in days if d in first for channel, games in sets.items())


def _learn(known: list, events: Iterator[tuple]) -> tuple[dict, list[str]]:
    """Adds an account's events to what is known of it; its amounts per (hour, game) and the days to count again."""
    regi, first = known  # {channel: {game: [id and time]}}, {day|game: time}
    amounts, touched, joined = {}, set(), False
    for kind, game, channel, resource, time, amount, paid in events:
        if kind == REGISTERED:
            games = regi.setdefault(channel, {})
            joined |= str(game) not in games
            known = games.setdefault(str(game), [])
            if (one := f"{int(resource)}|{time}") not in known:
                known.append(one)
        elif kind == AMOUNT:
            amounts[time, game] = amounts.get((time, game), Decimal(0)) + amount
        else:
            day = f"{time}|{game}"
            if day not in first or paid < first[day]:
                first[day] = paid
                touched.add(day)
    return amounts, list(first) if joined else sorted(touched)


def _change(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One bucket of accounts. What its accounts move is added up; their states are kept side by side."""
    accounts = json.loads(state.get[0]) if state.exists else {}
    events: dict[str, list[tuple]] = {}
    for frame in frames:
        columns = [frame[c] for c in ["game_account", *EVENT_KEYS[1:], "amount", "first"]]
        for account, *event in zip(*columns):
            events.setdefault(account, []).append(event)
    moved, money = Counter(), {}
    for account, own in events.items():
        known = accounts.setdefault(account, [{}, {}])
        before = json.loads(json.dumps(known))
        amounts, days = _learn(known, own)
        moved.update(_positions(*known, days))
        moved.subtract(_positions(*before, days))
        for (hour, game), amount in amounts.items():
            for channel, games in known[0].items():
                for listed, times in games.items():
                    place = (hour, game, channel, listed)
                    money[place] = money.get(place, Decimal(0)) + amount * len(times)
    state.update((json.dumps(accounts),))
    rows = [(*place, None, n) for place, n in moved.items() if n] + [(*place, amount, None) for place, amount in money.items()]
    if rows:
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in CHANGES.split(", ")]).astype({"pay_account_num": "Int64"})


def account_changes(events: DataFrame, buckets: int = ACCOUNT_BUCKETS) -> DataFrame:
    """Per micro-batch what its events change, of all accounts, keyed by the registered games behind it.

    `pay_money` rows are amounts times the registrations of one game; `pay_account_num` rows add accounts to an hour, or
    take them away, under all games they are registered with in a channel. Whether such games are listed is for
    the reader to decide: the state holds listed and other registrations alike.

    Accounts are dealt by a hash into `buckets` states, because a call and a state cost far more than an account. A batch
    reads the buckets of its accounts. The number belongs to the checkpoint: choose it once, for a few hundred accounts each.
    """
    bucket = F.pmod(F.xxhash64("game_account"), F.lit(buckets)).alias("bucket")
    return events.select("*", bucket).groupBy("bucket").applyInPandasWithState(_change, CHANGES, STATE, "append", GroupStateTimeout.NoTimeout)
