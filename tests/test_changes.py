"""Changes one by one: retries, dead letters and restarts, in batches and as streams; row hashes as state."""

import json
import time

from docloom.streaming import changes


def test_one_bad_change_drops_no_other(spark, tmp_path):
    rows = spark.createDataFrame([(i, i // 2, f"v{i}") for i in range(100)], "change_id int, ts int, v string")
    calls = []

    def process(df):
        ids = [r.change_id for r in df.collect()]
        calls.append(ids)
        if 37 in ids or (len(calls) == 1):
            raise ValueError("no")
        return df

    report = changes.run_changes(spark, rows, process, str(tmp_path / "s"), batch=50, dead=str(tmp_path / "dead"))
    assert (report["processed"], report["done"], [d["key"] for d in report["dead"]]) == (99, 49, ["37"])
    assert sum(ids == [37] for ids in calls) == 3
    (dead,) = spark.read.parquet(str(tmp_path / "dead")).collect()
    assert (dead.change_id, dead.v, dead.error) == (37, "v37", "no")
    done = {i for ids in calls for i in ids}
    assert done == set(range(100))
    # a second run has nothing to do; new changes go on behind the last position
    calls.clear()
    assert changes.run_changes(spark, rows, process, str(tmp_path / "s"), batch=50)["processed"] == 99 and not calls
    more = rows.unionByName(spark.createDataFrame([(200, 60, "new")], rows.schema))
    changes.run_changes(spark, more, process, str(tmp_path / "s"), batch=50)
    assert {i for ids in calls for i in ids} == {200}


def test_a_run_that_stops_goes_on(spark, tmp_path):
    rows = spark.createDataFrame([(i, i) for i in range(40)], "change_id int, ts int")
    seen = []

    class Stop(BaseException):
        pass

    def process(df):
        ids = [r.change_id for r in df.collect()]
        if len(seen) == 2:
            seen.append(None)
            raise Stop
        seen.append(ids)
        return df

    try:
        changes.run_changes(spark, rows, process, str(tmp_path / "s"), batch=10)
    except Stop:
        pass
    before = {i for ids in seen if ids for i in ids}
    report = changes.run_changes(spark, rows, process, str(tmp_path / "s"), batch=10)
    assert report["processed"] == 40 and 0 < len(before) < 40
    again = [i for ids in seen if ids for i in ids]
    assert sorted(again) == list(range(40))


def test_change_records_hold_old_and_new_values(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, "z", 2)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "x", None), (2, "q", 1), (4, "w", 5)], a.schema)
    got = {r.key: r for r in changes.change_records(a, b, "k", ["s", "n"]).collect()}
    assert {k: (r.op, r.changed, r.priority) for k, r in got.items()} == {2: ("update", ["s"], 1), 3: ("delete", ["s", "n"], 3), 4: ("insert", ["s", "n"], 2)}
    assert json.loads(got[2].old) == {"s": "y", "n": 1} and json.loads(got[2].new)["s"] == "q" and got[3].new is None


def test_a_stream_of_changes_retries_and_survives_a_restart(spark, tmp_path):
    def handler(change):
        """Fails once for ids from 10 on, always for 13; what it tried is a file."""
        import json
        import pathlib

        folder = pathlib.Path(json.loads(change.new)["folder"])
        tried = folder / str(change.change_id)
        n = int(tried.read_text()) if tried.exists() else 0
        tried.write_text(str(n + 1))
        if change.change_id == 13 or (change.change_id >= 10 and n == 0):
            raise ValueError(f"try {n + 1}")

    (tmp_path / "tries").mkdir()
    new = json.dumps({"folder": str(tmp_path / "tries")})
    frame = lambda ids: spark.createDataFrame([(i, f"k{i}", "update", ["s"], f'{{"s": {i}}}', new) for i in ids], changes.CHANGE)
    frame(range(5, 15)).coalesce(1).write.parquet(str(tmp_path / "in"))
    out, dead = str(tmp_path / "out"), str(tmp_path / "dead")

    def start():
        stream = spark.readStream.schema(changes.CHANGE).parquet(str(tmp_path / "in"))
        return changes.delivered(changes.processed(stream, handler, 3, 200), out, dead, str(tmp_path / "cp"), "200 milliseconds")

    def rows(path):
        try:
            return {r.change_id: r for r in spark.read.schema(changes.RESULT).parquet(path).collect()}
        except Exception:  # noqa: BLE001 - nothing is written yet
            return {}

    def wait(q, until):
        end = time.time() + 90
        while not until() and time.time() < end:
            assert q.exception() is None
            time.sleep(0.3)

    q = start()
    wait(q, lambda: 5 in rows(out) and (tmp_path / "cp" / "commits" / "0").exists())  # the first tries are made and kept; the others wait
    q.stop()
    frame([20]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = start()
    wait(q, lambda: len(rows(out)) == 10 and 13 in rows(dead))
    q.stop()
    done, gone = rows(out), rows(dead)
    assert sorted(done) == [*range(5, 13), 14, 20] and {i: r.tries for i, r in done.items() if i < 10} == dict.fromkeys(range(5, 10), 1)
    assert all(done[i].tries == 2 for i in (10, 11, 12, 14, 20))
    assert sorted(gone) == [13] and gone[13].tries == 3 and "try 3" in gone[13].error and json.loads(gone[13].old) == {"s": 13}
    assert int((tmp_path / "tries" / "13").read_text()) >= 3  # a batch cut short by the stop is tried again


def test_row_hashes_are_state(spark, tmp_path):
    import datetime as dt

    def snapshot(day, rows):
        at = dt.datetime(2024, 1, day)
        spark.createDataFrame([(k, v, at) for k, v in rows.items()], "k int, v string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema("k int, v string, ts timestamp").parquet(str(tmp_path / "in"))
        q = changes.row_changes(stream, "k", ["v"], "ts", "36 hours").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return sorted((r.key, r.op) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    snapshot(1, {1: "a", 2: "b"})
    assert run() == [("1", "insert"), ("2", "insert")]
    snapshot(2, {1: "a", 2: "c", 3: "d"})
    assert run() == sorted([("1", "insert"), ("2", "insert"), ("2", "update"), ("3", "insert")])
    snapshot(4, {1: "a", 2: "c"})
    snapshot(8, {2: "c"})
    got = run()
    assert ("3", "delete") in got and got.count(("2", "update")) == 1 and ("1", "delete") in run()
