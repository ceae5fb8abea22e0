"""Writers: GeoParquet, Hilbert order, one folder per state, JSON reports."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.functions import geo

ROW_GROUP = 50_000

# The conterminous Albers system as PROJJSON.
ALBERS = {
    "$schema": "https://proj.org/schemas/v0.7/projjson.schema.json",
    "type": "ProjectedCRS",
    "name": "NAD83 / Conus Albers",
    "base_crs": {
        "name": "NAD83",
        "datum": {"type": "GeodeticReferenceFrame", "name": "North American Datum 1983", "ellipsoid": {"name": "GRS 1980", "semi_major_axis": geo.A, "inverse_flattening": geo.INV_F}},
        "coordinate_system": {"subtype": "ellipsoidal", "axis": [{"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"}, {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"}]},
        "id": {"authority": "EPSG", "code": 4269},
    },
    "conversion": {
        "name": "Conus Albers",
        "method": {"name": "Albers Equal Area", "id": {"authority": "EPSG", "code": 9822}},
        "parameters": [
            {"name": "Latitude of false origin", "value": geo.LAT0, "unit": "degree"},
            {"name": "Longitude of false origin", "value": geo.LON0, "unit": "degree"},
            {"name": "Latitude of 1st standard parallel", "value": geo.PARALLELS[0], "unit": "degree"},
            {"name": "Latitude of 2nd standard parallel", "value": geo.PARALLELS[1], "unit": "degree"},
            {"name": "Easting at false origin", "value": 0, "unit": "metre"},
            {"name": "Northing at false origin", "value": 0, "unit": "metre"},
        ],
    },
    "coordinate_system": {"subtype": "Cartesian", "axis": [{"name": "Easting", "abbreviation": "X", "direction": "east", "unit": "metre"}, {"name": "Northing", "abbreviation": "Y", "direction": "north", "unit": "metre"}]},
    "id": {"authority": "EPSG", "code": 5070},
}


def geo_footer(column: str = "geometry", crs: dict | None = None) -> bytes:
    """The footer that marks a Parquet file's WKB column."""
    return json.dumps({"version": "1.1.0", "primary_column": column, "columns": {column: {"encoding": "WKB", "geometry_types": [], "crs": crs or ALBERS}}}).encode()


def write_geoparquet(df: DataFrame, path: str, column: str = "geometry", crs: dict | None = None) -> int:
    """One GeoParquet file per partition under ``path``; the number of rows.

    Spark's own writer has no hook for the footer, so tasks write with
    pyarrow, each attempt under its own name in a staging folder. Only files
    of attempts that succeeded are moved to ``path``, so a task that is tried
    again leaves nothing twice. ``path`` is a URI that all executors reach.
    """
    if not path.split("://")[0].isalpha():
        path = f"file://{path}"
    stage, footer, names = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}", geo_footer(column, crs), df.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        fs, root = pa.fs.FileSystem.from_uri(stage)
        name = f"part-{TaskContext.get().partitionId():05d}-{TaskContext.get().taskAttemptId()}.parquet"
        writer, rows = None, 0
        for batch in batches:
            table = pa.Table.from_batches([batch]).rename_columns(names)
            if writer is None:
                fs.create_dir(root, recursive=True)
                schema = table.schema.with_metadata({b"geo": footer})
                writer = pq.ParquetWriter(fs.open_output_stream(f"{root}/{name}"), schema, compression="zstd")
            writer.write_table(table.replace_schema_metadata({b"geo": footer}), row_group_size=ROW_GROUP)
            rows += len(batch)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows], pa.int64())], ["name", "rows"])

    import pyarrow.fs  # noqa: F401  pa.fs

    done = df.mapInArrow(write, "name string, rows long").collect()  # one row per file
    fs, root = pa.fs.FileSystem.from_uri(path)
    staged = f"{root.rstrip('/')}/{stage.rsplit('/', 1)[1]}"
    for r in done:
        fs.move(f"{staged}/{r['name']}", f"{root.rstrip('/')}/{r['name'].rsplit('-', 1)[0]}.parquet")
    if done:
        fs.delete_dir(staged)
    return sum(r["rows"] for r in done)


def hilbert_sorted(df: DataFrame) -> DataFrame:
    """Rows with plain box columns, range-partitioned and sorted in Hilbert order."""
    keyed = df.withColumn("_h", geo.hilbert_of_box(*(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))))
    return keyed.repartitionByRange("_h").sortWithinPartitions("_h").drop("_h")


def write_indexed(df: DataFrame, path: str) -> None:
    """Hilbert-sorted Parquet with small files, so that box filters skip most of it."""
    hilbert_sorted(df).write.option("compression", "zstd").option("maxRecordsPerFile", ROW_GROUP).mode("overwrite").parquet(path)


def write_states(df: DataFrame, path: str, state: str = "STATEFIPS", drop: tuple[str, ...] = ("oid",)) -> None:
    """All states in one pass, a folder each; a state without rows has none."""
    df.drop(*drop).withColumn("_s", F.col(state)).repartition("_s").write.mode("overwrite").partitionBy("_s").option("compression", "zstd").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").json(path)


def for_map(df: DataFrame, drop: tuple[str, ...] = ("effective_count", "area_sqm", "oid", "tile")) -> DataFrame:
    """Valid geometries in degrees without the inner columns, as map archives take them; crossings are mended."""
    from acreline.functions import geometry as g

    good = df.where("geometry is not null").withColumn("geometry", g.wkb_repaired("geometry")).where("geometry is not null")
    return good.drop(*drop).withColumn("geometry", g.wkb_lon_lat("geometry"))
