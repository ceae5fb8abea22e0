import argparse
import json

import pytest

from acreline import cli


def test_thresholds():
    assert cli.thresholds("1, 2.5") == (1.0, 2.5)
    assert cli.thresholds("")[0] == 100.0
    with pytest.raises(argparse.ArgumentTypeError):
        cli.thresholds("a")


def test_raster_urls_and_polygonize(spark, tmp_path, capsys):
    cli.main(["raster-urls", "http://x", "2020,2021"])
    assert "http://x/2021_30m_cdls.zip" in capsys.readouterr().out
    rows = [("A0", r * 12 + c, r, c, [1, 1] if c < 6 else [5, 5]) for r in range(12) for c in range(12)]
    spark.createDataFrame(rows, "tile string, pix long, r long, c long, cdl array<int>").write.parquet(str(tmp_path / "s"))
    cli.main(["polygonize", str(tmp_path / "s"), str(tmp_path / "t"), "--start", "2020", "--end", "2021"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    cli.main(["polygonize", str(tmp_path / "s"), str(tmp_path / "t"), "--start", "2020", "--end", "2021", "--resume"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    cli.main(["index", str(tmp_path / "t"), str(tmp_path / "i")])
    capsys.readouterr()
    cli.main(["parity", str(tmp_path / "i"), str(tmp_path / "i"), "--whole"])
    assert json.loads(capsys.readouterr().out.splitlines()[0])["iou"] == pytest.approx(1)


def test_scores_and_sweeps(spark, tmp_path, capsys):
    rows = [("A0", r * 12 + c, r, c, [1, 1] if c < 6 else [5, 5]) for r in range(12) for c in range(12)]
    spark.createDataFrame(rows, "tile string, pix long, r long, c long, cdl array<int>").write.parquet(str(tmp_path / "s"))
    years = ["--start", "2020", "--end", "2021"]
    cli.main(["polygonize", str(tmp_path / "s"), str(tmp_path / "t"), *years, "--noise", "2"])
    cli.main(["index", str(tmp_path / "t"), str(tmp_path / "i")])
    capsys.readouterr()
    cli.main(["instances", str(tmp_path / "i"), str(tmp_path / "i"), "--report", str(tmp_path / "r")])
    got = json.loads(capsys.readouterr().out.splitlines()[0])
    assert (got["pq"], got["mean_m"], got["n_chamfer"]) == (1, 0, 2)
    assert spark.read.json(str(tmp_path / "r")).count() == 1
    cli.main(["sweep", str(tmp_path / "s"), str(tmp_path / "i"), *years, "--grid-tolerances", "0,60", "--grid-dissolve", "--window", "0,-360,360,0"])
    made = [json.loads(x) for x in capsys.readouterr().out.splitlines()[:-1]]
    assert len(made) == 4 and {(x["tolerance"], x["dissolve"]) for x in made} == {(0.0, True), (0.0, False), (60.0, True), (60.0, False)}
    assert all(x["iou"] == pytest.approx(1) and x["only_ours_acres"] == pytest.approx(0) for x in made)


def test_elimination_is_timed_in_processes_of_its_own(spark, tmp_path, capsys):
    rows = [("A0", r * 12 + c, r, c, [1, 1] if (r, c) != (3, 3) else [5, 5]) for r in range(12) for c in range(12)]
    spark.createDataFrame(rows, "tile string, pix long, r long, c long, cdl array<int>").write.parquet(str(tmp_path / "s"))
    capsys.readouterr()
    cli.main(["bench-eliminate", str(tmp_path / "s"), "--sizes", "12", "--repeats", "1", "--fresh"])
    got = json.loads(capsys.readouterr().out.splitlines()[0])
    assert (got["regions"], got["left"], got["area_sqm"]) == (2, 1, 144 * 900.0) and got["peak_mb"] > 1


def test_entry_without_the_optional_half(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 20
    assert set(e.oracle_sql()) <= set(e.queries())
