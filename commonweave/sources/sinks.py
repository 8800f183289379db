"""Where results go: versioned tables, CSV, GeoJSON, Markdown, append-only logs."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_version(df: DataFrame, path: str) -> str:
    """df as a new version below path, and a pointer to it that is written last, so that
    readers see the old version or the new one whole."""
    version = f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{path}/{version}")
    df.sparkSession.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").parquet(f"{path}/_current")
    return version


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The version that the pointer names."""
    version = spark.read.parquet(f"{path}/_current").first()["version"]
    return spark.read.parquet(f"{path}/{version}")


def refresh(builders: dict[str, object], root: str) -> dict[str, str]:
    """Rebuild views in order and write each as a new version; stops at the first error."""
    return {name: write_version(build(), f"{root}/{name}") for name, build in builders.items()}  # type: ignore[operator]


def append(df: DataFrame, path: str) -> None:
    """Rows added to a log."""
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; commas, quotes and line ends are quoted, quotes doubled."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)


def geo_features(df: DataFrame, longitude: str, latitude: str) -> DataFrame:
    """(feature): one GeoJSON point for each row with coordinates, its other columns as properties."""
    rest = [c for c in df.columns if c not in (longitude, latitude)]
    point = F.struct(F.lit("Point").alias("type"), F.array(F.col(longitude).cast("double"), F.col(latitude).cast("double")).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*rest).alias("properties"))
    return df.dropna(subset=[longitude, latitude]).select(F.to_json(feature).alias("feature"))


def markdown_table(df: DataFrame, most: int = 50) -> str:
    """The first rows as a Markdown table, for reports."""
    rows = df.limit(most).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows])


def log_record(action: str, detail: dict[str, object]) -> str:
    """A log line as JSON."""
    return json.dumps({"action": action, **detail}, sort_keys=True, default=str)
