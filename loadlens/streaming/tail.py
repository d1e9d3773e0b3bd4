"""Logs that are still written to: every pass reads only what was appended, cut at the last line end.

An offset table holds, per file, how far it was read and the bytes just before that place. A pass joins it with the listing
of the folder, reads the appended ranges on the executors, in parts of bounded size, and stores the new rows and then the
new offsets. The offsets are the commit: a pass that fails leaves none and is repeated as it was.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.operators.latency import parse_txn_lines
from loadlens.operators.ordered import join_apart
from loadlens.sources.files import step_levels
from loadlens.streaming.store import _folders

#: A part of a range that one task reads, how much of it is read at once, and how many lines go on together.
PART_BYTES, BLOCK_BYTES, LINES = 64 << 20, 1 << 20, 20_000
#: Bytes before the offset that must still be the same; else the file was begun anew under its name.
TAIL_BYTES = 64

OFFSETS = "file string, begun bigint, upto bigint, length bigint, modified timestamp, tail binary"


def open_file(path: str):
    """A file of any store that the workers' Arrow file systems reach."""
    from pyarrow import fs

    local = re.match(r"file:/*(/.*)", path)
    if local:
        return fs.LocalFileSystem().open_input_file(local[1])
    system, where = fs.FileSystem.from_uri(path)
    return system.open_input_file(where)


def complete_lines(file, start: int, end: int, limit: int, at_line_start: bool, block: int = BLOCK_BYTES) -> Iterator[tuple[bytes, int]]:
    """(lines, place behind them) of the lines that begin in [start, end) and are complete before ``limit``.

    ``lines`` ends with a line feed. A part that does not begin at a line start leaves the line it falls into to the part
    before, so every line belongs to one part.
    """
    at = start if at_line_start else start - 1
    held, place, skip = b"", at, not at_line_start
    while place < end:
        data = file.read_at(min(block, limit - at), at) if at < limit else b""
        if not data:
            return
        at += len(data)
        held += data
        if skip:
            first = held.find(b"\n")
            if first < 0:
                place, held = at, b""
                continue
            place, held, skip = place + first + 1, held[first + 1 :], False
            if place >= end:
                return
        last = held.rfind(b"\n") if place + len(held) <= end else held.find(b"\n", max(0, end - 1 - place))
        if last < 0 and place + len(held) > end:  # the last line of the part is longer than what is held
            last = held.rfind(b"\n", 0, max(0, end - 1 - place))
        if last >= 0:
            lines, held = held[: last + 1], held[last + 1 :]
            place += len(lines)
            yield lines, place


def _starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Where to go on in each changed file: at its offset, or at 0 if it is new, shorter, or another file under its name."""
    for frame in frames:
        out = []
        for r in frame.itertuples(index=False):
            known = not pd.isna(r.upto)
            start = int(r.upto) if known else 0
            if known and start:
                tail = bytes(r.tail or b"")
                if r.length < start:
                    known = False
                else:
                    with open_file(r.file) as file:
                        known = file.read_at(len(tail), start - len(tail)) == tail
            out.append((r.file, int(r.begun) if known else int(r.now), start if known else 0, r.length, r.modified, (r.tail if known else None)))
        yield pd.DataFrame(out, columns=["file", "begun", "start", "length", "modified", "tail"])


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for r in frame.itertuples(index=False):
            place, tail = None, b""
            with open_file(r.file) as file:
                for lines, place in complete_lines(file, r.part, min(r.part + r.size, r.length), r.length, r.part == r.start):
                    tail = (tail + lines)[-TAIL_BYTES:]
                    texts = lines[:-1].decode("utf-8", "replace").split("\n")
                    for low in range(0, len(texts), LINES):
                        yield pd.DataFrame({"file": r.file, "begun": r.begun, "line": texts[low : low + LINES], "upto": None, "tail": None})
            if place is not None:
                yield pd.DataFrame({"file": [r.file], "begun": [r.begun], "line": [None], "upto": [place], "tail": [tail]})


def _parts(plan: DataFrame, part_bytes: int, count: int) -> DataFrame:
    """The ranges to read, dealt to a task each up to the session's number of shuffle partitions. The number is given, for
    adaptive execution judges by the few bytes of a range's description and would leave all of them to one task."""
    parts = plan.where("length > start").select("*", F.explode(F.sequence("start", F.col("length") - 1, F.lit(part_bytes))).alias("part"), F.lit(part_bytes).alias("size"))
    tasks = max(1, min(count, int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return parts.repartition(tasks, F.xxhash64("file", "part"))


def _listing(spark: SparkSession, root: str, files: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", files).load(root)
    return found.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))  # the content is not read


def ingest_appended(spark: SparkSession, root: str, path: str, files: str = "pgbench_log*", part_bytes: int = PART_BYTES) -> int:
    """One pass over log files that may still grow; returns the bytes that were appended since the pass before. Call it again at will.

    Of each file that is longer, or changed at another time, than at its last reading, only the bytes behind its offset are
    read, in parts of ``part_bytes`` by as many tasks. An unfinished last line waits for the pass that finds its end. A file
    that is shorter than its offset, or holds other bytes before it, was begun anew: it is read from its start and replaces
    what it had (see ``appended_logs``). A file that vanished keeps its rows. Neither names nor lines come to the driver.
    """
    done, _ = _folders(spark, f"{path}/offsets")
    number = max(done, default=-1) + 1
    listing = _listing(spark, root, files)
    known = spark.read.schema(OFFSETS).parquet(done[number - 1]) if done else spark.createDataFrame([], OFFSETS)
    seen = known.withColumnsRenamed({"length": "known_length", "modified": "known_modified"})
    changed = listing.join(seen, "file", "left").where(
        F.col("upto").isNull() | (F.col("length") != F.col("known_length")) | (F.col("modified") != F.col("known_modified"))
    )
    plan_path, raw_path = f"{path}/plan/batch_id={number}", f"{path}/raw/batch_id={number}"
    columns = "file string, begun bigint, start bigint, length bigint, modified timestamp, tail binary"
    asked = changed.select("file", "length", "modified", "begun", "upto", "tail", F.lit(number).alias("now")).repartition(F.xxhash64("file"))
    asked.mapInPandas(_starts, columns).write.mode("overwrite").parquet(plan_path)
    plan = spark.read.schema(columns).parquet(plan_path)
    new = F.greatest(F.col("length") - F.col("start"), F.lit(0))
    asked_for = plan.agg(F.sum(F.col("length") - F.col("start")).alias("appended"), F.sum(F.ceil(new / part_bytes)).alias("parts")).first()
    pieces = _parts(plan, part_bytes, asked_for["parts"] or 1).mapInPandas(_read, "file string, begun bigint, line string, upto bigint, tail binary")
    pieces.write.mode("overwrite").parquet(raw_path)
    raw = spark.read.schema("file string, begun bigint, line string, upto bigint, tail binary").parquet(raw_path)
    lines = raw.where("line is not null").select(*step_levels(F.col("file")), "file", "begun", "line")
    parse_txn_lines(lines).write.mode("overwrite").parquet(f"{path}/rows/batch_id={number}")
    reached = raw.where("upto is not null").groupBy("file").agg(F.max_by(F.struct(F.col("upto").alias("at"), F.col("tail").alias("end")), "upto").alias("r"))
    moved = plan.join(reached, "file", "left").select(
        "file", "begun", F.coalesce("r.at", "start").alias("upto"), "length", "modified", F.coalesce("r.end", "tail").alias("tail")
    )
    kept = known.join(plan.select("file"), "file", "left_anti")
    kept.unionByName(moved).write.mode("overwrite").parquet(f"{path}/offsets/batch_id={number}")
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for old in (plan_path, raw_path, *[done[n] for n in done if n < number - 1]):
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)
    return int(asked_for["appended"] or 0)


def appended_logs(spark: SparkSession, path: str) -> DataFrame:
    """What ``ingest_appended`` has stored: of each file the rows since it was begun, with run set, run, step and file."""
    done, _ = _folders(spark, f"{path}/offsets")
    last = max(done)
    rows, _ = _folders(spark, f"{path}/rows")
    read = spark.read.option("basePath", f"{path}/rows").parquet(*[rows[n] for n in sorted(rows) if n <= last]).drop("batch_id")
    newest = spark.read.schema(OFFSETS).parquet(done[last]).select("file", "begun")
    return join_apart(read, newest, ["file", "begun"], "left_semi").drop("begun")
