"""Downloads as a Spark job: tasks fetch files into a folder that all executors share.

A file is staged beside its place and moved there only when it is whole, so a
task that is lost or tried again leaves nothing half-done; a file that is
there already, and sound, is not fetched again.
"""

from __future__ import annotations

import os
import shutil
import time
import urllib.error
import urllib.request
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from acreline.sources.tables import raster_url

ATTEMPTS, PAUSE, WORKERS = 3, 3.0, 8


def fetch(url: str, target: str, attempts: int = ATTEMPTS, pause: float = PAUSE, overwrite: bool = False) -> str:
    """``there``, ``fetched``, ``missing`` (the server has no such file) or ``failed``.

    An archive (``.zip``) without its closing directory was cut short and
    counts as failed; checksums are verified where it is unpacked or read.
    The pause before another attempt grows by ``pause`` each time.
    """
    sound = lambda p: not target.endswith(".zip") or zipfile.is_zipfile(p)
    if os.path.exists(target) and not overwrite and sound(target):
        return "there"
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    part = f"{target}.{uuid.uuid4().hex}.part"
    try:
        for i in range(attempts):
            try:
                with urllib.request.urlopen(url, timeout=120) as source, open(part, "wb") as out:
                    shutil.copyfileobj(source, out, 1 << 20)
                if sound(part):
                    os.replace(part, target)
                    return "fetched"
            except urllib.error.HTTPError as e:
                if e.code in (404, 410):
                    return "missing"
            except OSError:
                pass
            if i + 1 < attempts:
                time.sleep(pause * (i + 1))
        return "failed"
    finally:
        if os.path.exists(part):
            os.remove(part)


def unpack(archive: str, folder: str, endings: tuple[str, ...] = ()) -> list[str]:
    """The members of an archive, or those with some endings, flat in ``folder``; paths inside it are ignored."""
    os.makedirs(folder, exist_ok=True)
    made = []
    with zipfile.ZipFile(archive) as z:
        for name in z.namelist():
            if not name.endswith("/") and (not endings or name.lower().endswith(endings)):
                path = os.path.join(folder, os.path.basename(name))
                try:
                    with z.open(name) as source, open(f"{path}.part", "wb") as out:
                        shutil.copyfileobj(source, out, 1 << 20)
                    os.replace(f"{path}.part", path)
                finally:
                    if os.path.exists(f"{path}.part"):
                        os.remove(f"{path}.part")
                made.append(path)
    return made


def fetched(files: DataFrame, workers: int = WORKERS, attempts: int = ATTEMPTS, pause: float = PAUSE, overwrite: bool = False) -> DataFrame:
    """``url, target, status`` of ``files(url, target)``; at most ``workers`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, targets = (c.to_pylist() for c in batch.columns)
            for u, t in zip(urls, targets, strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([u]), pa.array([t]), pa.array([fetch(u, t, attempts, pause, overwrite)])], ["url", "target", "status"])

    return files.select("url", "target").repartition(workers).mapInArrow(run, "url string, target string, status string")


def fetch_rasters(spark: SparkSession, base: str, years: tuple[int, ...], folder: str, resolution: int = 30, overwrite: bool = False, workers: int = WORKERS, pause: float = PAUSE) -> list[int]:
    """The years whose raster is in ``folder/<year>/`` afterwards; a year that fails is left out."""
    place = lambda y: f"{folder}/{y}/{y}_{resolution}m_cdls"
    wanted = [y for y in years if overwrite or not os.path.exists(f"{place(y)}.tif")]
    if wanted:
        rows = [(raster_url(base, y, resolution), f"{place(y)}.zip") for y in wanted]
        done = fetched(spark.createDataFrame(rows, "url string, target string"), min(workers, len(rows)), pause=pause, overwrite=overwrite)
        for r in done.collect():  # one row per year
            if r["status"] in ("there", "fetched"):
                try:
                    unpack(r["target"], os.path.dirname(r["target"]), (".tif",))
                except (zipfile.BadZipFile, zlib.error):
                    os.remove(r["target"])  # its checksums are wrong: the next run fetches it again
    return [y for y in years if os.path.exists(f"{place(y)}.tif")]


def fetch_lines(spark: SparkSession, pattern: str, areas: list[str], folder: str, workers: int = WORKERS, pause: float = PAUSE) -> list[str]:
    """Paths of the line archives of some areas; ``pattern`` is a URL with ``{area}``. Areas the server lacks are skipped."""
    rows = [(pattern.replace("{area}", a), f"{folder}/{a}.zip") for a in areas]
    done = fetched(spark.createDataFrame(rows, "url string, target string"), max(1, min(workers, len(rows))), pause=pause).collect()
    if failed := [r["url"] for r in done if r["status"] == "failed"]:
        raise OSError(f"{len(failed)} archives could not be fetched, the first {failed[0]}")
    return sorted(r["target"] for r in done if r["status"] != "missing")
