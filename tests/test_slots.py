"""The slot ledger of the detection store: late, changed and unreadable files, and runs that are lost half way."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridlake import fixed, session
from gridlake.model import DETECTION_CSV
from gridlake.plans import detections
from gridlake.plans.detections import refresh_detections, wanted_files
from gridlake.sources import slots
from gridlake.sources.manifests import date_range
from gridlake.sources.readers import read_store

HEADER = ",".join(f.name for f in DETECTION_CSV.fields if f.name != "instrument")
FIRST = dt.date(2024, 1, 1)


class Landing:
    def __init__(self, spark, path):
        self.spark, self.root, self.path = spark, str(path / "s"), path / "in"
        self.where = f"{self.path}/{{instrument}}/{{name}}"

    def put(self, day: int, instrument: str, *marks, header=HEADER):
        """A file with a line for each mark, which is the value of ``frp``."""
        name = fixed.DAILY_FILES[instrument] % (2024, day)
        file = Path(self.where.format(instrument=instrument, name=name))
        file.parent.mkdir(parents=True, exist_ok=True)
        lines = [f"1.0,2.0,300.0,1.0,1.0,2024-01-{day:02d},0312,A,n,6.1,290.0,{m},D,0.0" for m in marks]
        file.write_text("\n".join([header, *lines]) + "\n")

    def refresh(self, today: int, **options):
        refresh_detections(self.spark, self.root, self.where, dt.date(2024, 1, today), start=FIRST, **options)

    def rows(self):
        return sorted((r.acq_date.day, r.instrument, r.frp) for r in read_store(self.spark, self.root).collect())

    def states(self):
        return {(r.date.day, r.instrument): r.state for r in slots.read_slots(self.spark, self.root).collect()}


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_late_changed_and_wrong_files(spark, landing, tmp_path):
    landing.put(1, "MODIS", 1)
    landing.put(2, "MODIS", 2)
    landing.put(2, "NOAA-20-VIIRS", 5, header="lat,lon")
    landing.refresh(2, failures=str(tmp_path / "failed"))
    assert landing.rows() == [(1, "MODIS", 1.0), (2, "MODIS", 2.0)]
    assert landing.states() == {(1, "MODIS"): "stored", (2, "MODIS"): "stored", (2, "NOAA-20-VIIRS"): "failed"}
    assert spark.read.parquet(str(tmp_path / "failed")).count() == 4

    landing.put(3, "MODIS", 3)
    landing.refresh(3)
    landing.put(1, "SUOMI-NPP-VIIRS", 4)  # three runs late
    landing.put(2, "NOAA-20-VIIRS", 5, "broken")  # delivered again, one line in disorder
    landing.put(3, "MODIS", 6, 7)  # the file of the last date has grown
    landing.put(1, "MODIS", 99)  # one before the last stored date is not looked at again
    landing.refresh(4)
    want = [(1, "MODIS", 1.0), (1, "SUOMI-NPP-VIIRS", 4.0), (2, "MODIS", 2.0), (2, "NOAA-20-VIIRS", 5.0), (3, "MODIS", 6.0), (3, "MODIS", 7.0)]
    assert landing.rows() == want
    reject = slots.read_rejects(spark, landing.root).collect()
    assert [(r.date.day, r.instrument, ",broken," in r.line) for r in reject] == [(2, "NOAA-20-VIIRS", True)]
    counts = {(r.date.day, r.instrument): (r.rows, r.rejected) for r in slots.read_slots(spark, landing.root).collect()}
    assert counts[2, "NOAA-20-VIIRS"] == (1, 1) and counts[3, "MODIS"] == (2, 0)

    wanted = wanted_files(date_range(spark, FIRST, dt.date(2024, 1, 3)))
    still = slots.open_slots(spark, landing.root, wanted)
    assert still.count() == 4
    slots.give_up(spark, landing.root, still.where("instrument = 'SUOMI-NPP-VIIRS'"))
    assert slots.open_slots(spark, landing.root, wanted).count() == 2
    runs = slots.next_run(spark, landing.root)
    landing.put(3, "SUOMI-NPP-VIIRS", 8)
    landing.refresh(4)  # the slot is closed, nothing else is new
    assert landing.rows() == want and slots.next_run(spark, landing.root) == runs


@pytest.mark.parametrize("step", ["staging", "staged", "half published", "published"])
def test_lost_run_is_finished(spark, landing, monkeypatch, step):
    landing.put(1, "MODIS", 1)
    landing.put(1, "NOAA-20-VIIRS", 2)
    landing.refresh(2)
    landing.put(1, "SUOMI-NPP-VIIRS", 3)
    landing.put(2, "MODIS", 4)
    write = detections.write_store

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    def half(rows, target, **k):
        write(rows.where("mday = 1 AND instrument = 'MODIS'"), target, **k)
        lost()

    with monkeypatch.context() as m:
        if step == "staging":
            m.setattr(slots, "publish", lost)
            m.setattr(detections, "_merged", lost)
        elif step == "staged":
            m.setattr(slots, "publish", lost)
        elif step == "half published":
            m.setattr(detections, "write_store", half)
        else:
            m.setattr(slots, "_append", lost)
        with pytest.raises(RuntimeError):
            landing.refresh(2)
    landing.refresh(2)
    assert landing.rows() == [(1, "MODIS", 1.0), (1, "NOAA-20-VIIRS", 2.0), (1, "SUOMI-NPP-VIIRS", 3.0), (2, "MODIS", 4.0)]
    assert len(landing.states()) == 4 and set(landing.states().values()) == {"stored"}
    assert not session.list_names(spark, f"{landing.root}_staged")


def test_slot_of_a_version_in_another_partition_stays(spark, landing):
    landing.put(1, "MODIS", 1)
    landing.refresh(2)
    other = read_store(spark, landing.root).withColumns({"version": F.lit("2.0NRT"), "frp": F.lit(9.0)})
    detections.write_store(other, landing.root)
    landing.put(1, "NOAA-20-VIIRS", 2)
    landing.refresh(2)
    assert landing.rows() == [(1, "MODIS", 1.0), (1, "MODIS", 9.0), (1, "NOAA-20-VIIRS", 2.0)]
