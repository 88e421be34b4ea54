import time

from pyspark.sql import functions as F

from storepulse.operators import alerts, decode
from storepulse.sources import files, tables, topics
from storepulse.operators.sliding import AlertRule
from storepulse.streaming.alert_job import CouponAlertJob
from storepulse import schemas

T0 = 1_705_320_000_000


def _event(mid, evid, uid, s, item="i"):
    return {"mid": mid, "evid": evid, "uid": uid, "itemid": item, "type": "event", "ts": T0 + int(s * 1000)}


def _three(mid, s):
    return [_event(mid, "coupon", u, s + n) for n, u in enumerate("123")]


class _Replay:
    def __init__(self, spark, tmp_path, put, **kw):
        self.spark, self.put, self.folder = spark, put, str(tmp_path / "topics")
        self.job = CouponAlertJob(str(tmp_path / "job"), AlertRule(), **kw)
        self.sent = []

    def batch(self, *events):
        self.sent += events
        self.put(self.folder, "event", *events)
        self.run()

    def run(self):
        query = self.job.start(topics.read_folder(self.spark, self.folder, "event"), once=True)
        query.awaitTermination()
        self.last = query.lastProgress["batchId"]

    def alerts(self):
        return self._documents(self.job.alerts(self.spark))

    def expected(self, lines):
        rows = alerts.coupon_alerts(decode.accepted(decode.decode_event(lines(*self.sent))))
        return self._documents(rows)

    @staticmethod
    def _documents(rows):
        found = {}
        for r in rows.collect():
            found.setdefault((r.alert_id, r.ts), []).append(
                (r.kind, r.name, r.copies, r.n_uids, r.n_items, r.n_events))
        return sorted((*key, tuple(sorted(members, key=str))) for key, members in found.items())


def test_stream_equals_batch_with_late_and_repeated_batches(spark, tmp_path, put, lines):
    r = _Replay(spark, tmp_path, put)
    r.batch(*_three("a", 0), _event("b", "coupon", "1", 2))
    assert r.alerts() == []                      # no window has ended yet
    r.batch(_event("b", "addCart", "1", 130), "{broken")
    raised = r.alerts()
    assert [a[0] for a in raised] == [f"a_{T0 // 60000 + m}" for m in range(3)]
    r.batch(_event("a", "clickItem", "9", 70),   # late: takes back what it vetoes
            *_three("b", 20),                    # late: raises alerts for b
            _event("c", "addCart", "1", 200))
    assert f"a_{T0 // 60000 + 2}" not in [a[0] for a in r.alerts()]
    assert f"b_{T0 // 60000 + 2}" in [a[0] for a in r.alerts()]

    # The commit of the last batch is lost: it runs again and changes nothing.
    before = r.alerts()
    for lost in (tmp_path / "job" / "_checkpoint" / "commits").glob("*2*"):
        lost.unlink()
    r.run()
    assert r.alerts() == before

    r.job.close(spark, r.last)
    r.sent.remove("{broken")
    assert r.alerts() == r.expected(lines)
    rejected = tables.read_table(spark, str(tmp_path / "job" / "_quarantine"), schemas.QUARANTINE_TABLE)
    assert [x._error for x in rejected.collect()] == ["bad_json"]


def test_waiting_keeps_windows_open_for_stragglers(spark, tmp_path, put):
    r = _Replay(spark, tmp_path, put, wait_s=60)
    r.batch(*_three("a", 0))
    r.batch(_event("b", "addCart", "1", 61))
    assert r.alerts() == []
    r.batch(_event("b", "addCart", "1", 130))
    assert len(r.alerts()) == 2


def test_old_panes_go_and_what_is_listed_stays_the_same(spark, tmp_path):
    """Batches as the job hands them to its ring, each with an event of its own pane."""
    job = CouponAlertJob(str(tmp_path / "job"), keep_s=120)
    opened, runs, panes = [], [], []
    for n in range(24):
        pane = T0 // 5000 + 6 * n
        facts = spark.range(1).select(F.lit("b").alias("mid"), F.lit(pane).cast("long").alias("pane"),
                                      *[F.lit("x").alias(c) for c in ("evid", "uid", "itemid")], F.lit(1).cast("long").alias("n"))
        job.ring.apply(facts, n, job._oldest_of_use(pane - 1, pane))
        opened.append(len(job.ring.read(spark, low=pane, high=pane).inputFiles()))
        runs.append(len(files.names(spark, f"{job.path}/ring/runs")) + len(files.names(spark, f"{job.path}/ring/manifest")))
        panes.append(job.ring.read(spark).count())
    assert max(opened) == 1 and max(runs[5:]) == runs[5]
    assert max(panes) < 20


def test_alerts_do_not_need_what_was_let_go(spark, tmp_path, put, lines):
    r = _Replay(spark, tmp_path, put, keep_s=30)
    r.batch(*_three("a", 0))
    for n in (1, 2, 3):
        r.batch(_event("b", "addCart", "1", 180 * n), *_three("c", 170 * n))
    assert r.job.ring.read(spark).agg(F.min("pane")).first()[0] > T0 // 5000
    r.job.close(spark, r.last)
    assert r.alerts() == r.expected(lines)


def test_events_beyond_what_is_kept_are_set_aside(spark, tmp_path, put, lines):
    r = _Replay(spark, tmp_path, put, keep_s=120)
    r.batch(*_three("a", 0))
    r.batch(_event("b", "addCart", "1", 200))
    kept = [_event("a", "clickItem", "9", 90), *_three("c", 100)]
    r.batch(_event("a", "clickItem", "9", 60), *kept)
    rejected = tables.read_table(spark, f"{r.job.path}/_quarantine", schemas.QUARANTINE_TABLE)
    assert [x._error for x in rejected.collect()] == ["too_late"]
    r.job.close(spark, r.last)
    r.sent = [e for e in r.sent if e["mid"] != "a" or e["ts"] != T0 + 60_000]
    assert r.alerts() == r.expected(lines)


def test_a_lone_devices_alert_appears_as_time_passes(spark, tmp_path, put):
    r = _Replay(spark, tmp_path, put)
    now = int(time.time() * 1000)
    put(r.folder, "event", *[{**e, "ts": now} for e in _three("a", 0)])
    query = r.job.start(topics.read_folder(spark, r.folder, "event"), clock=True, every="1 second")
    try:
        for _ in range(90):
            time.sleep(1)
            if files.exists(spark, f"{r.job.path}/alerts") and r.alerts():
                break
        (found, *_), = r.alerts()[:1]
        assert found.startswith("a_") and query.exception() is None
    finally:
        query.stop()
