"""A paged catalogue as a stream: a discovery that stops goes on at its offset, and takes each entry once."""

import time

import pytest

from docloom.sources import files


def test_a_stopped_discovery_goes_on(spark, tmp_path):
    size, calls = tmp_path / "size", tmp_path / "calls"
    calls.mkdir()

    class Growing(files.PagedCatalog):
        @classmethod
        def name(cls):
            return "growing_catalog"

        def fetch(self, skip, limit):
            import pathlib
            import uuid

            total = int(pathlib.Path(self.options["size"]).read_text())
            (pathlib.Path(self.options["calls"]) / f"{skip}-{limit}-{uuid.uuid4().hex}").touch()
            return [{"id": i, "url": f"/pages/{i}"} for i in range(skip, min(skip + limit, total))]

    spark.dataSource.register(Growing)

    def discover(until):
        stream = spark.readStream.format("growing_catalog").option("size", str(size)).option("calls", str(calls)).option("pagesize", 10).load()
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="200 milliseconds").start()
        end = time.time() + 60
        while time.time() < end:
            assert q.exception() is None
            got = ids()
            if len(got) >= until:
                break
            time.sleep(0.3)
        q.stop()
        return got

    def ids():
        try:
            return sorted(r.id for r in spark.read.schema("id long, title string, url string").parquet(str(tmp_path / "out")).collect())
        except Exception:  # noqa: BLE001 - nothing is written yet
            return []

    size.write_text("34")
    assert discover(34) == list(range(34))
    size.write_text("57")
    for f in calls.iterdir():
        f.unlink()
    assert discover(57) == list(range(57))
    read = sorted(tuple(map(int, f.name.split("-")[:2])) for f in calls.iterdir())
    assert (34, 10) in read and (44, 10) in read and (54, 3) in read and not any(limit == 4 for _, limit in read)  # the first 34 aren't read again


@pytest.mark.parametrize("total", [0, 1, 9, 10, 11, 40, 41, 99])
def test_the_end_is_found(total):
    class Plain(files.PagedCatalog):
        def fetch(self, skip, limit):
            return [{"id": i} for i in range(skip, min(skip + limit, self.options["total"]))]

    options = {"pagesize": 10, "total": total}
    reader = files.PagedStream(Plain(options))
    assert reader.latestOffset() == {"skip": total}
    options["total"] = total + 25
    assert reader.latestOffset() == {"skip": total + 25}
    spans = reader.partitions({"skip": total}, {"skip": total + 25})
    assert [(p.skip, p.limit) for p in spans] == [(total, 10), (total + 10, 10), (total + 20, 5)]
