"""The base KPI stream on keyed state: same tables as the batch-wise job, and no reading of what was stored."""

from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gamepulse.sources.streams import file_lines
from gamepulse.streaming import account_state
from gamepulse.streaming.account_state import account_events
from gamepulse.streaming.jobs import BaseKpiJob, KeyedKpiJob
from gamepulse.streaming.run import run_available
from gamepulse.streaming.store import MergeTable
from test_streams import dims, order, regi, text  # noqa: F401

@pytest.fixture
def play(spark, dims, tmp_path):  # noqa: F811
    """Runs batches through both jobs; gives their tables as sets of rows that are not all zero."""
    def tables(job):
        out = {}
        for name in ("kpi_hour", "kpi_day"):
            df = getattr(job, name).read(spark)
            counts = [c for c, k in df.dtypes if k == "bigint" or k.startswith("decimal")]
            out[name] = sorted(str(r) for r in df.fillna(0, subset=counts).filter(" or ".join(f"{c} <> 0" for c in counts)).collect())
        return out

    def run(batches, **options):
        keyed, plain = KeyedKpiJob(str(tmp_path / "keyed"), dims, **options), BaseKpiJob(str(tmp_path / "plain"), dims, **options)
        for i, batch in enumerate(batches):
            text(spark, *batch).coalesce(1).write.text(f"{tmp_path}/lines/{i}")
            plain.process(text(spark, *batch), i)
            run_available(keyed.stream(file_lines(spark, f"{tmp_path}/lines")), keyed.process, f"{tmp_path}/checkpoint")
        return tables(keyed), tables(plain), keyed

    return run


def test_same_tables_as_the_job_by_batch(play):
    batches = [
        ["bi_pubgame|1", regi("a"), regi("a", "x_y_z"), order("a", "2024-01-05 09:10:00"), order("b", "2024-01-05 10:00:00"), order("late", "2024-01-05 11:00:00")],
        [regi("b", game=2), regi("a"), order("a", "2024-01-05 08:00:00", "7.50"), order("a", "2024-01-05 08:30:00", "1.25", status=8), order("b", "2024-01-06 10:00:00", game=2)],
        [regi("late"), regi("two", game=1), regi("two", game=3), order("two", "2024-01-07 01:00:00"), order("two", "2024-01-07 02:00:00", game=3)],
        ["bi_pubgame|2", order("b", "2024-01-05 07:00:00"), "bad line bi_order|x"],
        ["bi_pubgame|3", "bi_pubgame|1", order("two", "2024-01-07 00:30:00", "3.00")],
    ]
    keyed, plain, _ = play(batches)
    assert keyed == plain and len(plain["kpi_hour"]) > 4


def test_one_day_of_first_payments(play):
    batches = [["bi_pubgame|1", regi("a"), order("a", "2024-01-05 09:10:00"), order("a", "2024-01-06 09:10:00")], [order("a", "2024-01-05 03:00:00")]]
    keyed, plain, _ = play(batches, run_date="2024-01-05")
    assert keyed == plain


def test_a_batch_reads_no_history(spark, dims, tmp_path, monkeypatch):  # noqa: F811
    """Rows read from stored tables are the listed games, after 1 batch and after 20."""
    job, reads, stored = KeyedKpiJob(str(tmp_path / "t"), dims, keep_rejects=False), {}, MergeTable.deltas
    batches = [["bi_pubgame|1", *[regi(f"a{k}") for k in range(30)]]]
    batches += [[order(f"a{i}", f"2024-01-{5 + i % 9:02d} {i:02d}:00:00")] for i in range(20)]
    for i, lines in enumerate(batches):
        text(spark, *lines).coalesce(1).write.text(f"{tmp_path}/lines/{i:02d}")

    def process(batch, batch_id):
        def deltas(self, session):
            found = stored(self, session)
            reads.setdefault(batch_id, []).append((self.path.rsplit("/", 1)[-1], found.count()))
            return found

        monkeypatch.setattr(MergeTable, "deltas", deltas)
        job.process(batch, batch_id)
        monkeypatch.undo()

    run_available(job.stream(file_lines(spark, f"{tmp_path}/lines", 1)), process, f"{tmp_path}/c")
    assert len(reads) == 21 and reads[0] == [("games", 0), ("pending", 0)]
    assert all(reads[k] == [("games", 1)] for k in range(1, 21))
    counts = job.kpi_hour.read(spark).agg(F.sum("pay_account_num"), F.sum("pay_money")).first()
    assert (counts[0], float(counts[1])) == (20, 100.0)


def test_replayed_batch_changes_nothing(spark, dims, tmp_path):  # noqa: F811
    job = KeyedKpiJob(str(tmp_path / "t"), dims)

    def twice(batch, batch_id):
        job.process(batch, batch_id)
        job.process(batch, batch_id)

    for i, lines in enumerate([[regi("a", game=9), order("a", "2024-01-05 09:00:00")], ["bi_pubgame|9", order("a", "2024-01-05 08:00:00")]]):
        text(spark, *lines).coalesce(1).write.text(f"{tmp_path}/lines/{i}")
        run_available(job.stream(file_lines(spark, f"{tmp_path}/lines")), twice, f"{tmp_path}/c")
    got = {r["publish_time"]: r["pay_account_num"] for r in job.kpi_hour.read(spark).collect() if r["pay_account_num"]}
    assert got == {"2024-01-05 08": 1}
    assert job.pending.read(spark).filter("pay_account_num <> 0").count() == 0


def test_events_are_reduced_before_the_shuffle(spark):
    lines = [order("busy", f"2024-01-05 09:{i % 60:02d}:00") for i in range(500)] + [regi("busy")] * 50 + [order("busy", "2024-01-05 09:00:00", status=5)]
    events = account_events(text(spark, *lines).coalesce(1)).collect()
    assert len(events) == 3 and {e["kind"] for e in events} == {"registered", "amount", "first"}
    assert [e["first"] for e in events if e["kind"] == "first"] == ["2024-01-05 09:00:00"]
    assert [float(e["amount"]) for e in events if e["kind"] == "amount"] == [2500.0]


def test_accounts_share_a_state():
    """One call for a bucket of accounts: each keeps its own state, what they move is added up."""
    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    names = ["game_account", *account_state.EVENT_KEYS[1:], "amount", "first"]
    known = pd.DataFrame([(f"a{i}", "registered", 1, "x", 1, "t", None, None) for i in range(50)], columns=names)
    orders = [(f"a{i}", "amount", 1, None, None, "2024-01-05 09", Decimal(2), None) for i in range(40)]
    orders += [(f"a{i}", "first", 1, None, None, "2024-01-05", None, "2024-01-05 09:00:00") for i in range(40)]
    earlier = pd.DataFrame([("a0", "first", 1, None, None, "2024-01-05", None, "2024-01-05 08:00:00")], columns=names)
    state = State()
    got = [[tuple(r) for f in account_state._change((0,), iter(frames), state) for r in f.astype(object).where(f.notna(), None).itertuples(index=False)]
           for frames in ([known], [pd.DataFrame(orders[:30], columns=names), pd.DataFrame(orders[30:], columns=names)], [earlier])]
    hour = "2024-01-05 09", 1, "x", "1"
    assert got[0] == [] and sorted(got[1], key=str) == sorted([(*hour, None, 40), (*hour, Decimal(80), None)], key=str)
    assert sorted(got[2], key=str) == sorted([(*hour, None, -1), ("2024-01-05 08", 1, "x", "1", None, 1)], key=str)
