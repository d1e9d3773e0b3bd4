"""Run summaries: flattening, step joins, rendering, run listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions import client_overhead, html_escape, join_list, join_metric_paths
from loadlens.operators.ordered import join_keys
from loadlens.sources.schemas import HTML_COLUMNS, MONO_COLUMNS, REPORT_COLUMNS

STEP_KEY = ["run", "phase_idx", "step_idx"]

# Report columns that come from a nested struct of the step.
FROM_STATEMENTS = {
    "pg_stat_mean_ms": "mean_exec_time_ms", "pg_stat_min_ms": "min_exec_time_ms",
    "pg_stat_max_ms": "max_exec_time_ms", "pg_stat_calls": "calls",
    "yb_p50_ms": "yb_p50_ms", "yb_p90_ms": "yb_p90_ms", "yb_p95_ms": "yb_p95_ms", "yb_p99_ms": "yb_p99_ms",
}
FROM_LAG = {f"replication_{k}_lag_ms": f"{k}_lag_ms" for k in ("avg", "min", "p95", "max")}


def summary_records(summaries: DataFrame, keys: Sequence[str] = ("runset", "run")) -> DataFrame:
    """Nested run documents as one record per step, and one per phase without steps.

    A record has the run's keys, the positions and structs of phase and step. A phase without steps
    is its own single step with an empty name, so one ``explode`` covers both shapes.
    Documents may come in parts (``first_phase`` and ``first_step`` as ``scan_summary`` gives them).
    """
    places = [c for c in ("first_phase", "first_step") if c in summaries.columns]
    phases = summaries.select(*keys, *places, F.posexplode("phases").alias("phase_idx", "phase"))
    fields = phases.select("phase.steps").schema["steps"].dataType.elementType.names
    stepped = (F.col("phase.type") == "pgbench") & F.col("phase.steps").isNotNull()
    alone = F.array(F.struct(*[(F.lit("") if f == "step" else F.col(f"phase.{f}")).alias(f) for f in fields]))
    # A phase that comes in parts and counts as one without steps counts once.
    steps = F.when(stepped, F.col("phase.steps"))
    steps = steps.when(F.col("first_step") == 0, alone) if places else steps.otherwise(alone)
    records = phases.select(*keys, *places, "phase_idx", F.col("phase").dropFields("steps").alias("phase"), F.posexplode(steps).alias("step_idx", "step"))
    if not places:
        return records
    return records.withColumns({"phase_idx": F.col("first_phase") + F.col("phase_idx"), "step_idx": F.col("first_step") + F.col("step_idx")}).drop(*places)


def flatten_records(records: DataFrame, keys: Sequence[str] = ("runset", "run")) -> DataFrame:
    """One report row per record; keys and positions come first, then the 37 columns."""
    fields = records.select("step.*").columns
    special: dict[str, Column] = {
        "phase": F.col("phase.name"),
        "operation": F.col("phase.name"),
        "type": F.col("phase.type"),
        "pgbench_log_files": join_list(F.col("step.pgbench_log_files")),
        "server_metrics": join_metric_paths(F.col("step.server_metrics")),
        "overhead_ms": client_overhead(F.col("step.latency_avg_ms"), F.col("step.pg_stat_statements.mean_exec_time_ms")),
        **{name: F.col(f"step.pg_stat_statements.{field}") for name, field in FROM_STATEMENTS.items()},
        **{name: F.col(f"step.replication_summary.{field}") for name, field in FROM_LAG.items()},
    }
    return records.select(
        *keys, "phase_idx", "step_idx",
        *[special.get(c, F.col(f"step.{c}") if c in fields else F.lit(None)).alias(c) for c in REPORT_COLUMNS],
    )


def flatten_report(summaries: DataFrame, keys: Sequence[str] = ("runset", "run")) -> DataFrame:
    """The report rows of nested run documents."""
    return flatten_records(summary_records(summaries, keys), keys)


def number_text(value: Column) -> Column:
    """A float as the file format prints it: plain from 1e-4 up to below 1e16, else ``1.5e-05``, ``1e+16``.

    The engine's own text is right unless it has an exponent (below 1e-3 and from 1e7), so only those are rewritten.
    """

    def rewritten(text: Column) -> Column:
        power = F.substring_index(text, "E", -1).try_cast("int")
        mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
        size = F.abs(power).cast("string")
        far = F.concat(
            mantissa, F.when(power < 0, "e-").otherwise("e+"), F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size)
        )
        near = F.call_function("format_number", text.cast("double"), F.lit("0.0####################"))
        return F.when(power.between(-4, 15), near).otherwise(far)

    text, size = value.cast("string"), F.abs(value)
    exponent = ((size > 0.0) & (size < 1e-3)) | ((size >= 1e7) & (size < float("inf")))
    # A function over an array is not written out in generated code, and Spark cuts the code around it into methods. Written out for all
    # columns of a report it was one method of 39,000 bytes, and the JVM runs what is above 8,000 without compiling it.
    return F.when(exponent, F.get(F.transform(F.array(text), rewritten), F.lit(0))).otherwise(text)


def report_text(flat: DataFrame) -> DataFrame:
    """All columns as the text that the report files hold; null stays null."""
    kinds = dict(flat.dtypes)
    text = lambda c: number_text(F.col(c)) if kinds[c] == "double" else F.col(c).cast("string")
    return flat.select(*[text(c).alias(c) if c in REPORT_COLUMNS else F.col(c) for c in flat.columns])


def report_html_rows(flat: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One table row of markup per report row."""
    texts = report_text(flat)
    kinds = dict(flat.dtypes)

    def cell(name: str) -> list[Column]:
        tag = '<td class="mono">' if name in MONO_COLUMNS else "<td>"
        text = F.col(name)  # a number has no characters to escape
        content = html_escape(text) if kinds[name] == "string" else F.coalesce(text, F.lit(""))
        return [F.lit(tag), content, F.lit("</td>")]

    cells = [part for name in HTML_COLUMNS for part in cell(name)]
    return texts.select(*keys, F.concat(F.lit("        <tr>"), *cells, F.lit("</tr>")).alias("html"))


def join_step_results(steps: DataFrame, results: DataFrame, keys: Sequence[str] = STEP_KEY) -> DataFrame:
    """Attach per-step results (statement statistics, lag summary, latency); absent results are null.

    Both sides have one row per step, so the join neither multiplies nor skews.
    """
    return join_keys(steps, results, list(keys), "left")


def runs_with_labels(runs: DataFrame, summaries: DataFrame) -> DataFrame:
    """Every run with its label, '' when the summary is missing or unreadable."""
    labels = summaries.select("runset", "run", "run_label")
    return runs.join(labels, ["runset", "run"], "left").withColumn(
        "run_label", F.coalesce("run_label", F.lit(""))
    )


def run_set_counts(runs: DataFrame) -> DataFrame:
    """Run sets that hold at least one run (a set without any is a row with a null run)."""
    return runs.groupBy("runset").agg(F.count("run").alias("runs")).where(F.col("runs") >= 1)


def latest_run(runs: DataFrame) -> DataFrame:
    """Newest run per run set: run ids sort by time."""
    return runs.groupBy("runset").agg(F.max("run").alias("latest"))


def sorted_runs(runs: DataFrame) -> DataFrame:
    return runs.orderBy("runset", "run")


def phase_last_step(steps: DataFrame, keys: Sequence[str] = ("run", "phase_idx")) -> DataFrame:
    """A phase's throughput is that of its last step, even when that is null."""
    # Both go by the same order, so they are of the same step; of a struct Spark would sort the steps, numbers are kept in a hash table.
    return steps.groupBy(*keys).agg(*[F.max_by(c, "step_idx").alias(c) for c in ("tps", "tps_excluding")])


def metrics_before_after(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("node", "metric", "labels")) -> DataFrame:
    """Change of every metric over a step. A series seen in one capture only has a null change.

    ``labels`` is text here (maps cannot be compared); a series listed twice in a capture counts once, by its maximum.
    """
    left = before.groupBy(*keys).agg(F.max("value").alias("value_before"))
    right = after.groupBy(*keys).agg(F.max("value").alias("value_after"))
    return left.join(right, list(keys), "full_outer").withColumn(
        "delta", F.col("value_after") - F.col("value_before")
    )


def label_text(labels: Column) -> Column:
    """Label map in canonical text form, sorted by name."""
    entries = F.array_sort(F.map_entries(labels))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def join_steps(phases: DataFrame, steps: DataFrame, keys: Sequence[str] = ("runset", "run"), throughput: bool = True) -> DataFrame:
    """``phases`` (keys, phase_idx, phase struct) and ``steps`` (keys, phase_idx, step_idx, step struct) -> one row per step, and
    one with a null step per phase without steps; ``stepped`` tells which.

    A phase's throughput is that of its last step. Of the structs only ``tps`` and ``tps_excluding`` are looked at, so they
    may hold what a document is made of instead of the document, and that alone is shuffled. Keys are never null.
    Without ``throughput`` a phase with steps keeps its own, which report rows never show: that saves a join.
    """
    keys = [*keys, "phase_idx"]
    # Phases are nearly as many as steps and their size is guessed from compressed files: a join of them is never broadcast.
    if throughput:
        figures = steps.select(*keys, "step_idx", F.col("step.tps").alias("tps"), F.col("step.tps_excluding").alias("tps_excluding"))
        last = phase_last_step(figures, keys).withColumnsRenamed({"tps": "last_tps__", "tps_excluding": "last_excluding__"})
        known = phases.join(last.withColumn("stepped", F.lit(True)).hint("merge"), keys, "left")
        stepped = F.col("stepped").isNotNull()
        alone = known.where(~stepped)
        figures = F.col("phase").withField("tps", F.col("last_tps__")).withField("tps_excluding", F.col("last_excluding__"))
        phases = known.where(stepped).withColumn("phase", figures)
    else:
        alone = phases.join(steps.select(*keys).distinct().hint("merge"), keys, "left_anti")
    alone = alone.select(
        *keys, "phase", F.lit(0).alias("step_idx"), F.lit(None).cast(steps.schema["step"].dataType).alias("step"), F.lit(False).alias("stepped")
    )
    measured = steps.join(phases.select(*keys, "phase").hint("merge"), keys)
    return measured.select(*keys, "phase", "step_idx", "step", F.lit(True).alias("stepped")).unionByName(alone)


def own_steps(rows: DataFrame) -> DataFrame:
    """A phase without steps becomes its own step with an empty name."""
    step = lambda f: F.when(F.col("stepped"), F.col(f"step.{f}")).otherwise(F.lit("") if f == "step" else F.col(f"phase.{f}"))
    fields = rows.select("step.*").columns
    missing = F.col("stepped") & F.col("step").isNull()
    whole = F.struct(*[step(f).alias(f) for f in fields])
    return rows.withColumn("step", F.when(~missing, whole) if rows.schema["step"].nullable else whole).drop("stepped")


def step_records(phases: DataFrame, steps: DataFrame, keys: Sequence[str] = ("runset", "run")) -> DataFrame:
    """``phases`` (keys, phase_idx, phase struct) and ``steps`` (keys, phase_idx, step_idx, step struct) -> records.

    One record per step, the same layout at every size. A phase's throughput is that of its last
    step; phases without steps become their own step with an empty name. Keys are never null.
    Whole documents are shuffled here: where they are made of less, ``join_steps`` comes first and ``own_steps`` last.
    """
    return own_steps(join_steps(phases, steps, keys))


def run_listing(records: DataFrame, keys: Sequence[str] = ("runset", "run")) -> DataFrame:
    """One row per run: label, number of phases and steps, sum of the phases' throughput."""
    per_phase = records.groupBy(*keys, "phase_idx").agg(
        F.first("run_label").alias("run_label"), F.first("phase.type").alias("type"), F.first("phase.tps").alias("tps"),
        F.count_if(F.col("step.step") != "").alias("steps"),
    )
    return per_phase.groupBy(*keys).agg(
        F.first("run_label").alias("run_label"), F.count(F.lit(1)).alias("phases"), F.sum("steps").alias("steps"),
        F.count_if(F.col("type") == "http").alias("http_phases"), F.sum("tps").alias("phase_tps"),
    )
