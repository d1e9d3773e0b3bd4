"""Writers for the report, histogram, summary and snapshot files.

Rows are range-partitioned on the folder columns plus their order inside a file (or a hash where
they have none), so a folder with very many rows becomes several files instead of one huge task, and
small folders share a task instead of getting a file from each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.operators.latency import formatted_histogram
from loadlens.operators.reports import report_html_rows, report_text
from loadlens.sources.schemas import REPORT_COLUMNS


def _ordered(df: DataFrame, folders: Sequence[str], order: Sequence[str]) -> DataFrame:
    columns = [*folders, *order]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def _spread(df: DataFrame, folders: Sequence[str], *columns: str) -> DataFrame:
    return df.repartitionByRange(*folders, F.xxhash64(*columns)).sortWithinPartitions(*folders)


#: Quotes are doubled, as the file format does it.
CSV = {"header": True, "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"'}


#: Of gzip, where used. At the default level packing took two fifths of a writer's time; level 3 takes half of that, for a sixth (report rows) to
#: two fifths (records with their null fields) more bytes.
GZIP_LEVEL = "THREE"


def _writer(df: DataFrame, folders: Sequence[str], name: str, compression: str | None = None):
    kept = df.write.option("mapreduce.output.basename", name).option("compression", compression or "none")
    return kept.option("zlib.compress.level", GZIP_LEVEL).partitionBy(*folders)


#: Makes what is written out of the rows that are given, row by row, behind the shuffle: only the narrower rows travel.
Render = Callable[[DataFrame], DataFrame]


def write_report_csv(
    flat: DataFrame, path: str, folders: Sequence[str] = ("runset", "run"), render: Render | None = None, compression: str | None = None
) -> str:
    """``report-*.csv`` per folder: header, 37 columns in fixed order, null as an empty cell.

    With ``render``, ``flat`` holds rows that it turns into report rows. ``compression`` (such as gzip) is part of the file names.
    """
    order = [c for c in ("run", "phase_idx", "step_idx") if c not in folders and c in flat.columns]
    placed = _ordered(flat, folders, order)
    rows = report_text(render(placed) if render else placed).select(*folders, *REPORT_COLUMNS)
    _writer(rows, folders, "report", compression).csv(path, **CSV)
    return path


def write_report_html(flat: DataFrame, path: str, folders: Sequence[str] = ("runset", "run")) -> str:
    """The table rows of the HTML report; page frame and styling are static text around them."""
    order = [c for c in ("run", "phase_idx", "step_idx") if c not in folders and c in flat.columns]
    _writer(report_html_rows(_ordered(flat, folders, order), folders), folders, "report").text(path)
    return path


def write_latency_histogram(histogram: DataFrame, path: str, folders: Sequence[str]) -> str:
    """``latency_histogram-*.csv`` per folder: ascending seconds, three decimals."""
    rows = formatted_histogram(_ordered(histogram, folders, ["epoch_sec"]), folders)
    _writer(rows, folders, "latency_histogram").csv(path, **CSV)
    return path


def write_summaries(
    records: DataFrame, path: str, folders: Sequence[str] = ("runset",), render: Render | None = None, compression: str | None = None
) -> str:
    """Step records as JSON lines below their run set, in the order of run, phase and step. ``render`` makes records of the rows."""
    order = [c for c in ("run", "phase_idx", "step_idx") if c not in folders]
    placed = _ordered(records, folders, order)
    _writer(render(placed) if render else placed, folders, "summary", compression).json(path, ignoreNullFields=False)
    return path


def write_run_documents(documents: DataFrame, path: str, name: str = "summary", compression: str | None = None, rows_per_file: int = 100_000) -> str:
    """Nested run documents, one JSON line each, with all fields. Compressed files are not split when read, so they are kept small."""
    kept = documents.write.option("mapreduce.output.basename", name).option("compression", compression or "none").option("maxRecordsPerFile", rows_per_file)
    kept.json(path, ignoreNullFields=False)
    return path


def write_snapshots(snapshots: DataFrame, path: str, folders: Sequence[str], name: str, order: Sequence[str]) -> str:
    """One JSON line per snapshot, in ``order`` within its folder."""
    _writer(_ordered(snapshots, folders, order), folders, name).json(path, ignoreNullFields=False)
    return path


def write_txn_log(lines: DataFrame, path: str, folders: Sequence[str] = ("runset", "run", "step")) -> str:
    """Transaction logs in the folder layout that the readers expect (to bring logs into a lake)."""
    _writer(_spread(lines.select(*folders, "line"), folders, "line"), folders, "pgbench_log").text(path)
    return path


def write_step_stdout(texts: DataFrame, path: str, folders: Sequence[str] = ("runset", "run", "step")) -> str:
    _writer(_spread(texts.select(*folders, "text"), folders, "text"), folders, "pgbench.log").text(path)
    return path


def write_metrics_text(
    lines: DataFrame, path: str, capture: str, node: str = "node", folders: Sequence[str] = ("runset", "run", "step")
) -> str:
    """Captured metrics text, ``<capture>_metrics-*.txt``, one folder per node position below its step."""
    levels = [*folders, node]
    _writer(_spread(lines.select(*levels, "line"), levels, "line"), levels, f"{capture}_metrics").text(path)
    return path


# -- nested documents ---------------------------------------------------------------------------
# A document is one file, so its rows meet in one task. They are written as the lines of a JSON text in order: a head, the
# elements, a tail. Nothing is collected; a series of any length streams through its writer.

def _open_object(fields: Column, more: Column | str) -> Column:
    """The JSON text of a struct without its closing brace, ready for one more field (``more`` tells whether there is one)."""
    text = F.to_json(fields)
    body = F.substring(text, F.lit(1), F.length(text) - 1)
    return F.when(F.lit(more) & (F.length(text) > 2), F.concat(body, F.lit(","))).otherwise(body)


def _document_lines(rows: DataFrame, folders: Sequence[str], order: Sequence[str], comma_after: dict[int, int], path: str, name: str, compression: str | None = None) -> str:
    """``rows`` (folders, order columns, ``kind__``, ``text__``) as files: a kind in ``comma_after`` gets a comma when the line
    before it is of the given kind. The window needs no shuffle or sort beyond that of the rows."""
    placed = rows.repartition(*folders).sortWithinPartitions(*folders, *order)
    before = F.lag("kind__").over(Window.partitionBy(*folders).orderBy(*order))
    listed = placed.withColumn("before__", before)
    comma = F.lit("")
    for kind, previous in comma_after.items():
        comma = F.when((F.col("kind__") == kind) & (F.col("before__") == previous), ",").otherwise(comma)
    _writer(listed.select(*folders, F.concat(comma, "text__").alias("value")), folders, name, compression).text(path)
    return path


def write_snapshot_documents(
    snapshots: DataFrame, path: str, folders: Sequence[str], name: str, order: Sequence[str], fields: Sequence[str], documents: DataFrame | None = None
) -> str:
    """One ``{interval_sec, snapshots[]}`` document per folder, its snapshots (``fields``) in ``order``.

    ``documents`` (folders, interval_sec) lists those to write, also such without a snapshot; by default those that have one.
    """
    heads = snapshots.groupBy(*folders).agg(F.max("interval_sec").alias("interval_sec")) if documents is None else documents
    kinds = {c: snapshots.schema[c].dataType for c in order}
    place = lambda kind: [F.lit(kind).alias("kind__"), *[F.lit(None).cast(kinds[c]).alias(c) for c in order]]
    interval = F.coalesce(F.col("interval_sec").cast("string"), F.lit("null"))
    head = F.concat(F.lit('{"interval_sec":'), interval, F.lit(',"snapshots":['))
    rows = heads.select(*folders, *place(0), head.alias("text__")).unionByName(
        snapshots.select(*folders, F.lit(1).alias("kind__"), *order, F.to_json(F.struct(*fields)).alias("text__"))
    ).unionByName(heads.select(*folders, *place(2), F.lit("]}").alias("text__")))
    return _document_lines(rows, folders, ["kind__", *order], {1: 1}, path, name)


def write_summary_documents(records: DataFrame, path: str, folders: Sequence[str] = ("runset", "run"), name: str = "summary", compression: str | None = None) -> str:
    """One nested run document per folder, from step records: the run's fields, its phases, their steps, all in order."""
    keys, others = list(folders), ["phase_idx", "phase", "step_idx", "step"]
    run_fields = [c for c in records.columns if c not in (*keys, *others)]
    stepped = F.col("step.step") != ""
    line = lambda phase, kind, step, text: [F.lit(phase).cast("int").alias("phase_idx") if isinstance(phase, int) else phase, F.lit(kind).alias("kind__"), step.cast("int").alias("step_idx"), text.alias("text__")]
    none = F.lit(None)
    runs = records.groupBy(*keys).agg(F.first(F.struct(*run_fields)).alias("run__"))
    phases = records.groupBy(*keys, "phase_idx").agg(F.first("phase").alias("phase"), F.max(stepped).alias("stepped__"))
    at, has = F.col("phase_idx").cast("int").alias("phase_idx"), F.col("stepped__")
    parts = [
        runs.select(*keys, *line(-1, 0, none, F.concat(_open_object(F.col("run__"), True), F.lit('"phases":[')))),
        phases.select(*keys, *line(at, 1, none, F.concat(_open_object(F.col("phase"), has), F.when(has, '"steps":[').otherwise("")))),
        records.where(stepped).select(*keys, *line(at, 2, F.col("step_idx"), F.to_json("step"))),
        phases.select(*keys, *line(at, 3, none, F.when(has, "]}").otherwise("}"))),
        runs.select(*keys, *line((1 << 31) - 1, 4, none, F.lit("]}"))),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return _document_lines(rows, keys, ["phase_idx", "kind__", "step_idx"], {1: 3, 2: 2}, path, name, compression)
