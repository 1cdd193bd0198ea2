import json

import pytest
from pyspark.sql import functions as F

from cloudweft import objects
from cloudweft.config import require_env
from cloudweft.errors import ConfigError, InsecureDirectoryError
from cloudweft.functions import messages as m
from cloudweft.functions import text as t
from cloudweft.streaming import consumer
from cloudweft.streaming.queue import FolderQueue

GOOD = {"type": "mesh.generate", "version": 1, "organizationId": "o", "projectId": " p ", "zoneScanObjectKeys": ["k"]}
REFINE = {"type": "mesh.refine", "organizationId": "o", "projectId": "p"}
CASES = [
    (GOOD, None), (REFINE, None), (GOOD | {"version": 1.0}, None), (GOOD | {"version": True}, None), (GOOD | {"version": "1"}, "version"), (GOOD | {"version": 2}, "version"), (GOOD | {"version": None}, "version"),
    (GOOD | {"type": "x"}, "type"), ({k: v for k, v in GOOD.items() if k != "type"}, "type"), (GOOD | {"type": 1}, "type"), (GOOD | {"organizationId": " \t"}, "organizationId"), (GOOD | {"projectId": 5}, "projectId"), (GOOD | {"projectId": None}, "projectId"),
    (GOOD | {"zoneScanObjectKeys": []}, "zoneScanObjectKeys"), (GOOD | {"zoneScanObjectKeys": [1]}, "zoneScanObjectKeys"), (GOOD | {"zoneScanObjectKeys": ["a", None]}, "zoneScanObjectKeys"), (GOOD | {"zoneScanObjectKeys": "a"}, "zoneScanObjectKeys"),
    (REFINE | {"zoneScanObjectKeys": ["k"]}, "extra_fields"), (GOOD | {"more": 1}, "extra_fields"), ([GOOD], "not_object"), ("text", "not_object"), (None, "not_object"),
]


def test_messages_in_spark_and_on_the_driver_agree(spark):
    rows = [(k, json.dumps(body)) for k, (body, _) in enumerate(CASES)] + [(99, "not json"), (100, None)]
    found = {r.k: r for r in m.validated(spark.createDataFrame(rows, "k int, body string")).collect()}
    for k, (body, error) in enumerate(CASES):
        assert found[k].error == error, body
        if error is None:
            job = m.parse_job(body)
            assert (found[k].projectId, found[k].type, found[k].version) == (job.projectId, job.type, 1) and found[k].projectId == "p"
        else:
            with pytest.raises(ValueError):
                m.parse_job(body)
    assert found[99].error == found[100].error == "not_json" and found[99].type is None


def test_jobs_and_bodies():
    assert m.Job("o", "p", zoneScanObjectKeys=["a"]).version == 1
    with pytest.raises(ValueError):
        m.Job("o", "p")
    with pytest.raises(Exception):
        m.Job("o", "p", zoneScanObjectKeys=["a"]).projectId = "x"
    assert m.parse_body('{"a": 1}') == {"a": 1} and m.parse_body("raw") == "raw" and m.parse_body(b"x") == b"x"


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.slept.append(s)
        self.now += s


class Queue:
    def __init__(self, script):
        self.script, self.acked = list(script), []

    def pull(self):
        x = self.script.pop(0) if self.script else []
        if isinstance(x, Exception):
            raise x
        return x

    def ack(self, lease):
        self.acked.append(lease)


class Sent:
    def __init__(self, body, lease_id="l"):
        self.body, self.lease_id = body, lease_id


def worker(script, handle=lambda body: None, **kw):
    clock = Clock()
    queue = Queue(script)
    return consumer.Worker(queue, handle, clock, clock.sleep, **kw), queue, clock


def test_worker_acks_after_success_and_stops_when_idle():
    seen = []
    w, queue, clock = worker([[Sent('{"a": 1}', "x")], []], seen.append)
    assert w.run() == "idle" and seen == [{"a": 1}] and queue.acked == ["x"]
    assert clock.now == 60.0


def test_confirming_poll_gets_a_message():
    w, queue, _ = worker([[], [], [], [], [], [Sent("late", "z")]])
    assert w.run() == "idle" and queue.acked == ["z"]


def test_failures_back_off_and_end():
    def broken(body):
        raise RuntimeError

    w, queue, clock = worker([[Sent("a")]] * 30, broken)
    assert w.run() == "failures: processing" and queue.acked == [] and len(clock.slept) == 9
    assert clock.slept[-1] == 300 and 12 <= clock.slept[0] <= 18
    assert worker([RuntimeError()] * 10)[0].run() == "failures: poll"
    assert worker([[Sent("a", None)]] * 10)[0].run() == "failures: processing"


def test_a_success_resets_only_its_stage():
    f = consumer.Failures(2)
    assert (f.failed("poll"), f.failed("processing"), f.over("poll")) == (1, 1, False)
    f.succeeded("poll")
    assert f.failed("poll") == 1 and f.failed("processing") == 2 and f.over("processing")


def test_runtime_and_signal():
    w, _, clock = worker([])
    clock.now = 1.0
    w.clock = lambda t=iter([0.0, 0.0, 10.0, 50_000.0]): next(t)
    assert w.run() == "runtime"
    w = worker([])[0]
    w.stop()
    assert w.run() == "signal"


def test_backoff():
    assert [consumer.backoff(n, 1.0) for n in (1, 2, 5, 6)] == [15, 30, 240, 300]


def test_folder_queue_redelivers(tmp_path):
    queue = FolderQueue(tmp_path)
    queue.send("a")
    queue.send("b")
    first = queue.pull(visibility_ms=0)
    assert [x.body for x in first] == ["a"]
    again = queue.pull()
    assert [x.body for x in again] == ["a"]
    queue.ack(again[0].lease_id)
    assert [x.body for x in queue.pull()] == ["b"] and queue.pull() == []


def test_stream_is_acknowledged_after_commit(spark, tmp_path):
    queue = FolderQueue(tmp_path / "q")
    for k in range(3):
        queue.send(json.dumps(GOOD | {"projectId": f"p{k}"}))
    queue.send("broken")
    got = []
    stream = consumer.messages(spark, str(tmp_path / "q"), str(tmp_path / "log"), batch=2)
    begin = lambda: consumer.start(stream, lambda df, _: got.extend(df.collect()), str(tmp_path / "checkpoint"), 0.2)
    assert consumer.supervise(begin, idle_s=4, look_s=0.3) == "idle"
    assert sorted((r.projectId or "", r.error or "") for r in got) == [("", "not_json"), ("p0", ""), ("p1", ""), ("p2", "")]
    assert not list((tmp_path / "q" / "pending").iterdir())


def test_streaks_in_a_stream(spark, tmp_path):
    spark.createDataFrame([("a", True), ("a", True), ("b", False), ("b", True)], "k string, failed boolean").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, failed boolean").parquet(str(tmp_path / "in"))
    query = consumer.streak_stream(stream, "k", 2).writeStream.outputMode("update").format("memory").queryName("streaks").start()
    query.processAllAvailable()
    query.stop()
    assert {(r.k, r.streak, r.over) for r in spark.table("streaks").collect()} == {("a", 2, True), ("b", 1, False)}


class Store:
    def __init__(self, keys=()):
        self.keys, self.calls = set(keys), []

    def download_file(self, bucket, key, target):
        open(target, "w").write("data")

    def upload_file(self, source, bucket, key):
        self.calls.append((source, bucket, key))

    def head_object(self, Bucket, Key):
        if Key == "forbidden":
            raise type("E", (Exception,), {"response": {"Error": {"Code": "403"}}})()
        if Key not in self.keys:
            raise type("E", (Exception,), {"response": {"Error": {"Code": "404"}}})()


def test_object_transfer(tmp_path, monkeypatch):
    monkeypatch.setenv(objects.FOLDER, str(tmp_path / "base"))
    shelf = objects.Bucket(Store({"there"}), "b")
    path = shelf.fetch_into(tmp_path, "scans/2024/a.las")
    assert path == tmp_path / "a.las" and path.read_text() == "data"
    with pytest.raises(FileExistsError):
        shelf.fetch_into(tmp_path, "scans/2025/a.las")
    assert shelf.overwriting().fetch_into(tmp_path, "scans/2025/a.las") == path
    assert shelf.fetch_into(tmp_path, "../../etc/x") == tmp_path / "x" and shelf.fetch_into(tmp_path, "k", "y") == tmp_path / "y"
    assert shelf.fetch_into(tmp_path, "c\\d.las").name == "d.las"
    for bad in ("", ".", "..", "a/"):
        with pytest.raises(ValueError):
            objects.within(tmp_path, bad)
    (tmp_path / "way").symlink_to("/etc")
    with pytest.raises(ValueError):
        objects.within(tmp_path, "way")
    with pytest.raises(FileExistsError):
        shelf.store(path, "there")
    assert shelf.overwriting().store(path, "there") == "there"
    assert shelf.store_from(tmp_path, "a.las", "new") == "new"
    with pytest.raises(Exception) as e:
        shelf.store(path, "forbidden")
    assert not isinstance(e.value, FileExistsError)
    with pytest.raises(ValueError):
        shelf.store(path, "..")
    monkeypatch.delenv(objects.BUCKET, raising=False)
    with pytest.raises(ConfigError):
        objects.Bucket.default(shelf.client)
    monkeypatch.setenv(objects.BUCKET, "c")
    assert objects.Bucket.default(shelf.client).name == "c"
    with objects.Scratch().lent("job/1") as d:
        assert d.is_dir() and d.name.startswith("job_1-") and d.stat().st_mode & 0o777 == 0o700
    assert not d.exists()
    assert shelf.fetch_aside("k/v.las").name == "v.las"
    with pytest.raises(ConfigError):
        objects.Scratch("not/absolute")


def test_private_folders(tmp_path):
    (tmp_path / "real").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "real")
    with pytest.raises(InsecureDirectoryError):
        objects.Scratch.locked(tmp_path / "link")
    with pytest.raises(ConfigError):
        objects.Scratch.locked(tmp_path / "no" / "parent")
    assert objects.Scratch.locked(tmp_path / "real").stat().st_mode & 0o777 == 0o700


def test_a_client_needs_all_settings():
    full = {objects.ACCOUNT: "0" * 32, objects.HOST: "example.org", objects.ACCESS_KEY: "k", objects.SECRET_KEY: "s"}
    with pytest.raises(ConfigError, match=objects.SECRET_KEY):
        objects.connect(full | {objects.SECRET_KEY: ""})
    with pytest.raises(ConfigError, match="account"):
        objects.connect(full | {objects.ACCOUNT: "evil.example/"})


def test_settings_and_ids():
    assert require_env("A", source={"A": "x"}) == {"A": "x"}
    with pytest.raises(ConfigError, match="B"):
        require_env("A", "B", source={"A": "x", "B": ""})
    assert objects.account_id("0123456789abcdef" * 2)
    for bad in ("", "0" * 31, "0" * 33, "A" * 32, "0" * 32 + "\n"):
        with pytest.raises(ConfigError):
            objects.account_id(bad)


def test_text_rules(spark):
    df = spark.createDataFrame([("a b/é.x",), ("",), ("x" * 80,), ("dir\\..",)], "s string")
    assert [r[0] for r in df.select(t.sanitised(F.col("s"))).collect()] == ["a_b_é_x", "job", "x" * 64, "dir___"]
    assert [r[0] for r in df.select(t.usable_segment(t.last_segment(F.col("s")))).collect()] == [True, False, True, False]
    ids = spark.createDataFrame([("0" * 32,), ("0" * 32 + "\n",)], "s string")
    assert [r[0] for r in ids.select(t.is_account_id(F.col("s"))).collect()] == [True, False]
    paths = spark.createDataFrame([("/a/b.scanproject",)], "s string")
    assert paths.select(t.stem(F.col("s")), t.numbered(F.lit(7), 3)).first()[:] == ("b", "007")
    names = spark.createDataFrame([("a.bin",), ("../a",), ("/a",), ("b/../../c",)], "s string")
    assert [r[0] for r in names.select(t.inside(F.lit("k"), F.col("s"))).collect()] == [True, False, False, False]


def test_worker_command(tmp_path, monkeypatch):
    queue = FolderQueue(tmp_path)
    queue.send(json.dumps(REFINE))
    monkeypatch.setenv("QUEUE_FOLDER", str(tmp_path))
    monkeypatch.setattr(consumer.Worker, "on_signals", lambda self: self)
    monkeypatch.setattr(consumer, "IDLE_S", 0.0)
    assert consumer.main() == 0 and not list((tmp_path / "pending").iterdir()) and not list((tmp_path / "leased").iterdir())


def test_public_names():
    from cloudweft import api

    assert all(hasattr(api, name) for name in api.__all__)
