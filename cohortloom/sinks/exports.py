"""Writing events and profiles out."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from ..functions import properties as P
from ..functions import times
from ..operators.events import raw_events
from ..session import cut_lineage, delete_path, owned_cuts, scratch_path, ship_package
from ..sources.files import list_folder, open_file


def event_json(events: DataFrame, *keep: str) -> DataFrame:
    """Shaped or raw events as one JSON object text each: column ``value``, and ``keep``."""
    raw = raw_events(events, *keep) if "distinct_id" in events.columns else events
    name = F.coalesce(P.json_text("event", "string"), F.lit("null"))
    body = P.props_to_json("properties")
    line = F.concat(F.lit('{"event":'), name, F.lit(',"properties":'), body, F.lit("}"))
    return raw.select(*keep, line.alias("value"))


def profile_json(profiles: DataFrame, id_col: str = "distinct_id") -> DataFrame:
    """Profiles as one JSON object text each: column ``value``."""
    return profiles.select(
        F.concat(
            F.lit('{"$distinct_id":'),
            P.json_text(id_col, "string"),
            F.lit(',"$properties":'),
            P.props_to_json("properties"),
            F.lit("}"),
        ).alias("value")
    )


def write_json(lines: DataFrame, path: str, append: bool = False, compress: bool = False) -> None:
    """One JSON object per line; ``lines`` has the column ``value``."""
    writer = lines.write.mode("append" if append else "errorifexists")
    writer.option("compression", "gzip" if compress else "none").text(path)


def property_names(items: DataFrame) -> list[str]:
    """Sorted names of all properties: the header of a dense table.

    Names are reduced on the executors; what comes to the driver is the header,
    which a table's schema needs there.
    """
    names = P.explode_props(items).select("name").distinct()
    return sorted(r["name"] for r in names.toLocalIterator())


def flatten(
    items: DataFrame, id_col: str, names: Iterable[str] | None = None, id_name: str | None = None
) -> DataFrame:
    """Sparse property maps to a dense table of text columns.

    Strings lose their quotes; numbers, booleans, lists and objects are JSON
    text; a missing or null property is NULL. Give ``names`` if they are known
    and the pass that finds them is saved.
    """
    names = property_names(items) if names is None else list(names)
    cells = [P.prop_string("properties", n).alias(n) for n in names]
    return items.select(F.col(id_col).alias(id_name or id_col), *cells)


def write_csv(
    dense: DataFrame, path: str, append: bool = False, compress: bool = False
) -> None:
    """A dense table as CSV with a header; quotes are doubled, NULL is empty."""
    writer = dense.write.mode("append" if append else "errorifexists")
    writer.options(
        header=True,
        escape='"',
        quote='"',
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        compression="gzip" if compress else "none",
    ).csv(path)


class _Lines(list):
    """What a CSV writer writes, a line each."""

    write = list.append


def _catalogue(folder: str) -> dict[str | None, dict[str, int]]:
    """Per type the cell of each name, from the written names in their order."""
    cells: dict[str | None, dict[str, int]] = {}
    for path in list_folder(folder):
        with open_file(path) as file:
            table = pq.read_table(file)
        for kind, name in zip(table.column("type").to_pylist(), table.column("name").to_pylist()):
            of_type = cells.setdefault(kind, {})
            of_type[name] = len(of_type) + 1
    return cells


def _cell(text: str) -> str:
    """Strings without their quotes, null as nothing, all else as JSON."""
    return "" if text == "null" else json.loads(text) if text[0] == '"' else text


def wide_lines(items: DataFrame, id_col: str, id_name: str, names_path: str, type_col: str | None = None) -> DataFrame:
    """``type, place, value``: lines of dense CSV, each task's lines of a type behind a header.

    The header is read where the lines are made, from the table of names at ``names_path``.
    """
    ship_package(items.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        catalogue, begun, place = None, set(), 0
        for batch in batches:
            catalogue = _catalogue(names_path) if catalogue is None else catalogue
            lines, kinds = _Lines(), []
            writer = csv.writer(lines, lineterminator="")
            for kind, item, props in zip(*(batch.column(i).to_pylist() for i in range(3))):
                cells = catalogue.get(kind, {})
                if kind not in begun:
                    begun.add(kind)
                    writer.writerow([id_name, *cells])
                    kinds.append(kind)
                row = [""] * (len(cells) + 1)
                row[0] = item or ""
                for name, text in props or ():
                    if text is not None:
                        row[cells[name]] = _cell(text)
                writer.writerow(row)
                kinds.append(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(range(place, place + len(lines)), pa.int64()), pa.array(lines, pa.string())],
                ["type", "place", "value"],
            )
            place += len(lines)

    kind = F.col(type_col).cast("string") if type_col else F.lit(None).cast("string")
    rows = items.select(kind.alias("type"), F.col(id_col).cast("string").alias("id"), "properties")
    return rows.mapInArrow(task, "type string, place bigint, value string")


def write_wide_csv(
    items: DataFrame,
    path: str,
    id_col: str,
    id_name: str | None = None,
    type_col: str | None = None,
    append: bool = False,
    compress: bool = False,
) -> None:
    """Sparse property maps as dense CSV of any width; with ``type_col`` a folder and a header per type.

    The header is the id and the sorted names of all properties there are. Names are
    found and sorted by Spark and written as a table, which tasks read; none comes to the
    driver, and no plan has a column per name. All types are written by one job. Each file has its header,
    so files that are appended may have other names: :func:`..sources.csv_files.read_profiles`
    takes each by its own.
    """
    spark = items.sparkSession
    names_path = scratch_path(spark, "names")
    kind = (F.col(type_col) if type_col else F.lit(None)).cast("string").alias("type")
    found = P.explode_props(items, kind).select("type", "name").distinct()
    # One file, since a header is one line.
    found.repartition(1).sortWithinPartitions("type", "name").write.parquet(names_path)
    try:
        lines = wide_lines(items, id_col, id_name or id_col, names_path, type_col)
        # Headers stay ahead: lines are in the order the write asks for.
        ordered = lines.sortWithinPartitions("type", "place").select("type", "value") if type_col else lines.select("value")
        writer = ordered.withColumnRenamed("type", type_col).write.partitionBy(type_col) if type_col else ordered.write
        writer.mode("append" if append else "errorifexists").option("compression", "gzip" if compress else "none").text(path)
    finally:
        delete_path(spark, names_path)


def export_events(
    events: DataFrame, path: str, format: str = "json", append: bool = False, compress: bool = False
) -> None:
    """Shaped events as JSON lines or CSV (``event`` and one column per property)."""
    if format == "json":
        write_json(event_json(events), path, append, compress)
    elif format == "csv":
        write_wide_csv(raw_events(events), path, "event", append=append, compress=compress)
    else:
        raise ValueError(f"format must be json or csv: {format}")


def export_profiles(
    profiles: DataFrame,
    path: str,
    format: str = "json",
    append: bool = False,
    compress: bool = False,
    id_col: str = "distinct_id",
) -> None:
    """User or group profiles as JSON lines or CSV."""
    if format == "json":
        write_json(profile_json(profiles, id_col), path, append, compress)
    elif format == "csv":
        write_wide_csv(profiles, path, id_col, "$distinct_id", append=append, compress=compress)
    else:
        raise ValueError(f"format must be json or csv: {format}")


def export_groups(groups: DataFrame, path: str, append: bool = False, compress: bool = False) -> None:
    """Group profiles of all types as CSV, a folder ``group_type=...`` and a header per type, in one job."""
    write_wide_csv(groups, path, "group_id", "$distinct_id", "group_type", append, compress)


def export_events_per_day(
    events: DataFrame, path: str, append: bool = False, compress: bool = False
) -> None:
    """One folder per calendar day (``day=YYYY-MM-DD``), all days in one job.

    No shuffle: each task writes the days it holds.
    """
    dated = events.withColumn("day", times.day_text(times.from_epoch_s("time")))
    writer = event_json(dated, "day").write.mode("append" if append else "errorifexists")
    writer.partitionBy("day").option("compression", "gzip" if compress else "none").text(path)


def copy_raw(spark, source: str, path: str) -> None:
    """Lines copied unchanged, whatever they hold.

    Only a newline ends a line, so carriage returns stay where they are. A last
    line without a newline gets one.
    """
    lines = spark.read.option("lineSep", "\n").text(source)
    lines.write.mode("errorifexists").option("lineSep", "\n").text(path)


def backup(targets: DataFrame, path: str) -> DataFrame:
    """Write the profiles an update is about to touch, and read them back.

    Use the returned table as the update's input: what was saved is then
    exactly what is changed.
    """
    targets.write.mode("errorifexists").parquet(path)
    return targets.sparkSession.read.schema(targets.schema).parquet(path)


def write_split(tagged: DataFrame, valid_path: str, invalid_path: str) -> None:
    """Write valid rows as a table and invalid raw events as JSON lines; the input is computed once."""
    with owned_cuts(tagged.sparkSession):
        rows = cut_lineage(tagged, "split")
        rows.where(F.col("valid")).drop("valid").write.mode("append").parquet(valid_path)
        write_json(event_json(rows.where(~F.col("valid")).drop("valid")), invalid_path, append=True)


def long_form(items: DataFrame, *ids: str) -> DataFrame:
    """``ids, key, value`` rows: one per property."""
    return P.explode_props(items, *ids, key="key", value="value")


