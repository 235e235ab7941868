"""Writers (S9-S15): a gate first, then Parquet or JSON tables; assets as one document."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import asset_size, gate, union
from ..operators.layout import svg_document


def write_tables(folder: str, tables: dict[str, DataFrame], file_format: str = "parquet") -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").format(file_format).save(f"{folder}/{name}")


def write_then_gate(folder: str, tables: dict[str, DataFrame], checks: DataFrame) -> None:
    """Tables are there to look at even if a check is fatal."""
    write_tables(folder, tables)
    gate(checks)


def gate_then_write(folder: str, tables: dict[str, DataFrame], checks: DataFrame) -> None:
    """Nothing is written on a fatal check."""
    gate(checks)
    write_tables(folder, tables)


def as_document(tables: dict[str, DataFrame]) -> str:
    """Small tables as one JSON object of arrays (S12, S15): an asset has thousands of rows at most."""
    return json.dumps({name: [r.asDict(recursive=True) for r in df.collect()] for name, df in tables.items()}, separators=(",", ":"), ensure_ascii=False)


def sizes(document: str) -> tuple[int, int]:
    """Bytes of a document plain and packed."""
    return len(document.encode()), len(gzip.compress(document.encode()))


def write_asset(path: Path, document: str, checks: DataFrame, app: Path | None = None) -> tuple[int, int]:
    """Writes an asset within its budgets, and a copy into the app's folder if there is an app (S12); returns its sizes."""
    raw, packed = sizes(document)
    gate(union([checks, asset_size(checks.sparkSession, raw, packed)]))
    for place in [path, *([app / path.name] if app is not None and app.is_dir() else [])]:
        place.parent.mkdir(parents=True, exist_ok=True)
        whole = place.with_name(place.name + ".part")  # readers see the old file or the new one
        whole.write_text(document)
        whole.replace(place)
    return raw, packed


def write_svg(path: Path, rows: DataFrame) -> None:
    """The review drawing as a file."""
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(svg_document(rows))


def palette_document(families: DataFrame, measures: dict[str, float], surfaces: dict[str, str], checks: DataFrame) -> str:
    """The palette as one JSON document (S15), if every family has its colours.

    families: family, label, line_ids, light, dark, dash; measures: what the search reached."""
    gate(checks)
    rows = {r["family"]: {k: v for k, v in r.asDict().items() if k != "family"} for r in families.orderBy("family").collect()}  # a row a family
    return json.dumps({"surfaces": surfaces, "measures": measures, "families": rows}, ensure_ascii=False, indent=2)


def positional(places: DataFrame) -> DataFrame:
    """Places as ``[name, lat, lon, kind, locality]`` lines, one a row (S13), for a text sink."""
    fields = [F.to_json(F.array(F.col("name"))), *[F.col(c).cast("string") for c in ("lat", "lon", "kind", "locality_index")]]
    name = F.expr("substring(to_json(array(name)), 2, length(to_json(array(name))) - 2)")
    return places.select(F.concat(F.lit("["), F.concat_ws(",", name, *fields[1:]), F.lit("]")).alias("value"))


def layout_rows(points: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    """Stations and lines of a layout, coordinates to 0.1."""
    return {"stations": points.select("station_id", F.round("x", 1).alias("x"), F.round("y", 1).alias("y")), "lines": lines}
