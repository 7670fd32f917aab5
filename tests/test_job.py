"""The whole run on files, and where it continues."""

from pathlib import Path

import pytest

from helpers import same_rows
from stationflow.plans import job
from stationflow.sources import event_feed as feed
from stationflow.sources.metrics import read_metrics, tidy_metrics
from stationflow.spec import ModelSettings

TINY = ModelSettings(forest_trees=3, forest_depth=3, boost_iterations=2, linear_iterations=10)


def test_run_resume_and_force(spark, small, tmp_path, monkeypatch):
    csv, meta = feed.write_station_files(spark, small)
    out = str(tmp_path / "run")

    def run(**options):
        return job.run(spark, csv, meta, out, settings=TINY, **options)

    first = run()
    assert first.count() == 24
    document = read_metrics(spark, f"{out}/metrics")
    assert document.first()["train_count"] + document.first()["test_count"] == 225
    assert same_rows(tidy_metrics(document), first)
    models = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "run" / "models").iterdir()}
    assert len(models) == 6

    # Finished features: neither files nor cleaned rows are needed again, and no model is fitted.
    with monkeypatch.context() as m:
        m.setattr(job, "load_observations", lambda *_: pytest.fail("read files again"))
        m.setattr(job, "feature_rows", lambda *_: pytest.fail("made features again"))
        assert same_rows(run(), first)
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "run" / "models").iterdir()} == models

    # Unfinished features: made again from the cleaned rows.
    (tmp_path / "run" / "features" / "_SUCCESS").unlink()
    with monkeypatch.context() as m:
        m.setattr(job, "load_observations", lambda *_: pytest.fail("read files again"))
        assert same_rows(run(), first)

    with monkeypatch.context() as m:
        m.setattr(job, "load_observations", lambda *_: pytest.fail("read files again"))
        with pytest.raises(BaseException, match="read files again"):
            run(force=True)
    assert not Path(out, "features").exists() and not Path(out, "models").exists()


def test_no_rows_is_an_error(spark, small, tmp_path):
    csv, meta = feed.write_station_files(spark, small)
    with pytest.raises(ValueError):
        job.run(spark, csv, meta, str(tmp_path / "run"), minimum=2.0, settings=TINY)


def test_series_too_short_for_features_are_an_error(spark, tmp_path):
    folder = tmp_path / "obs"
    folder.mkdir()
    header = "DATE,LONGITUDE,LATITUDE,TMP,DEW,WND_ANGLE,WND_RATE,SLP,MASK,TIME_DIFF"
    rows = [f"2014-01-01 0{h}:00:00,1,2,{h},1,90,3,1000,[1 1 1 1 1],1" for h in range(6)]
    (folder / "1.csv").write_text("\n".join([header, *rows]))
    (tmp_path / "meta.json").write_text('{"1.csv": {"valid_percent": 1.0}}')
    with pytest.raises(ValueError, match="no feature rows"):
        job.run(spark, str(folder), str(tmp_path / "meta.json"), str(tmp_path / "run"), settings=TINY)
