"""Sinks (K01-K15): CSV, partitioned parquet, GeoJSON and an SQLite copy."""

from __future__ import annotations

import sqlite3

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions.numbers import whole_number
from factweave.operators import entities as en
from factweave.operators.rows import q


def save_csv(df: DataFrame, path: str, fieldnames: list[str] | None = None) -> None:
    """Columns in the order given, else sorted; others are left out, missing ones blank."""
    names = fieldnames or sorted(df.columns)
    df.select(*(q(c).cast("string").alias(c) if c in df.columns else F.lit("").alias(c) for c in names)).write.mode("overwrite").options(header="true", quote='"', escape='"', emptyValue="").csv(path)


def dump_lines(lines: DataFrame, path: str) -> None:
    """Raw lines, cells joined by commas, quoted where needed."""
    cell = F.transform("line", lambda x: F.when(x.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x))
    lines.select(F.array_join(cell, ",")).write.mode("overwrite").text(path)


def save_log(df: DataFrame, path: str, partition: tuple[str, ...] = ("dataset", "resource"), numbers: tuple[str, ...] = ("line_number", "entry_number")) -> None:
    """A log as parquet folders, numbers as integers and all else as text; one file per folder and task."""
    rows = df.select(*(q(c).cast("int" if c in numbers else "string").alias(c) for c in df.columns))
    rows.repartition(*partition).write.mode("overwrite").partitionBy(*partition).parquet(path)


def save_parquet(df: DataFrame, path: str, sort: tuple[str, ...] = ()) -> None:
    """ZSTD parquet; sorted within files where asked, so that row groups can be skipped."""
    rows = df.sortWithinPartitions(*sort) if sort else df
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def save_package(dataset: str, path: str, facts: DataFrame, resources: DataFrame, entities: DataFrame) -> None:
    """The three tables of a dataset, each in its ``dataset=`` folder."""
    for name, df in (("fact", facts), ("fact_resource", resources), ("entity", entities)):
        save_parquet(df.drop("dataset"), f"{path}/{name}/dataset={dataset}")


def join_table(df: DataFrame, key: str, field: str) -> DataFrame:
    """The items of a ``;`` list as rows of their own."""
    return df.select(q(key), F.explode(F.split(F.coalesce(q(field), F.lit("")), ";")).alias(field)).where(q(field) != "")


def stored(df: DataFrame, integers: tuple[str, ...] = (), json: tuple[str, ...] = ()) -> DataFrame:
    """Values as a package stores them: whole numbers cut towards zero, an empty object null."""
    kinds = {**dict.fromkeys(integers, "i"), **dict.fromkeys(json, "j")}
    return df.select(*((whole_number(c) if kinds.get(c) == "i" else F.nullif(q(c), F.lit("{}")) if kinds.get(c) == "j" else q(c)).alias(c) for c in df.columns))


def export_sqlite(path: str, tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> None:
    """Tables in one SQLite file, streamed through the driver partition by partition."""
    db = sqlite3.connect(path)
    try:
        for name, df in tables.items():
            kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL"}
            columns = [f'"{c}" {kinds.get(t, "TEXT")}' + (" PRIMARY KEY" if (keys or {}).get(name) == c else "") for c, t in df.dtypes]
            db.execute(f'DROP TABLE IF EXISTS "{name}"')
            db.execute(f'CREATE TABLE "{name}" ({", ".join(columns)})')
            db.executemany(f'INSERT OR REPLACE INTO "{name}" VALUES ({", ".join("?" * len(columns))})', (tuple(r) for r in df.toLocalIterator()))
            db.commit()
    finally:
        db.close()


def save_flattened(entities: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Flattened CSV, parquet and JSON, and GeoJSON features one a line."""
    keys = en.json_keys(entities) if keys is None else keys
    flat = en.flatten(entities, keys)
    save_csv(flat, f"{path}/csv", flat.columns)
    save_parquet(flat, f"{path}/parquet", ("entity",))
    flat.write.mode("overwrite").json(f"{path}/json")
    en.geojson_features(entities).select("feature").write.mode("overwrite").text(f"{path}/geojson")


def makefile_rules(mapped: DataFrame, needed: DataFrame | None = None) -> str:
    """One rule per dataset that names its transformed resources (a report of bounded size: one line per pair)."""
    rows = (mapped if needed is None else needed).orderBy("dataset", "resource").select("dataset", "resource").toLocalIterator()
    by: dict[str, list[str]] = {}
    for r in rows:
        by.setdefault(r["dataset"], []).append(f"transformed/{r['dataset']}/{r['resource']}.parquet")
    return "\n".join(f"dataset/{d}: {' '.join(files)}" for d, files in sorted(by.items())) + "\n"
