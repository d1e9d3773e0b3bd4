"""WARC archives of captures, and their index by an external merge of sorted runs.

Every record is a gzip member of its own (several, if it is very long), so that offset and length fetch it from
its file. Spark's text writer and its committer write the files: the last byte of a member of less than 16 MB is zero
(the top byte of its size), and that byte is the writer's line end. Files are cut by bytes, so that one is a cell of
bounded size when it is read back. Reading goes through their records, checks every digest and sorts the captures of a
file by URL key and time: a capture run. Runs are stored, cut into ranges of (URL key, time, id) and merged, k ways, by
a loser tree per range: capture histories in one global order.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.scratch import join_apart, stored
from loadlens.session import scratch_path
from loadlens.streaming.tail import open_file

REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
MEMBER_BYTES = 8 << 20
BATCH_BYTES = 16 << 20
ROWS_PER_RANGE = 100_000
FAN_IN = 256
FIRST_CAPTURE = 1704067200
_BREAK = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _clean(column):
    """Header values hold no line breaks: they are percent-encoded."""
    return F.replace(F.replace(column, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def url_key(url):
    """Host labels in reverse order, a closing bracket, then path and query; lower-cased, without scheme,
    fragment, user, port and a leading ``www.``. Empty for null."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[^/?#]*?://|#[\s\S]*$", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*", 0), r"^[\s\S]*@|:[0-9]*$|^www\.", "")
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.concat(labels, F.lit(")"), F.regexp_replace(rest, r"^[^/?]*", ""))


def captures(pages: DataFrame) -> DataFrame:
    """Pages with payload size and digest, capture time and record type.

    Of equal payloads of at least 100 bytes, that of the smallest page_id is the response, others refer to it (repeated
    rows of that id are responses too, null ids follow all others). Pages carry no time: it is a fixed
    start plus page_id seconds.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    made = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("bytes"), F.sha2(F.col("payload").cast("binary"), 256).alias("digest")
    )
    first = made.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    ).where("n > 1 and first is not null").select("digest", "first")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return join_apart(made, first, "digest", "left").select(
        "page_id", "url", "payload", "bytes", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("type"), F.when(revisit, F.col("first")).alias("refers"),
    )


def record(with_payload: DataFrame) -> DataFrame:
    """One WARC record per row as text, without its two closing line breaks."""
    revisit = F.col("type") == "revisit"
    time = F.date_format(F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_BREAK))  # noqa: E731  null if the value is
    page = lambda column: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}"),
        line("Content-Length", F.col("bytes").cast("string")), F.lit(_BREAK),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return with_payload.withColumn("_block", block).select(F.concat(
        F.lit(f"WARC/1.1{_BREAK}"), line("WARC-Type", F.col("type")), line("WARC-Record-ID", page("page_id")), line("WARC-Date", time),
        F.coalesce(line("WARC-Target-URI", _clean(F.col("url"))), F.lit("")),
        F.coalesce(line("X-URL-Key", _clean(url_key(F.col("url")))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("WARC-Refers-To", page("refers")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length("_block").cast("string")),
        F.lit(_BREAK), F.col("_block"),
    ).alias("value"))


def members(data: bytes) -> bytes:
    """gzip members that hold ``data``, of at most ``MEMBER_BYTES`` each before compression."""
    parts = (data[i : i + MEMBER_BYTES] for i in range(0, len(data), MEMBER_BYTES))
    return b"".join(gzip.compress(part, 6, mtime=0) for part in parts)


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> str:
    """WARC files below ``path``, each of at most ``file_bytes`` or one record; a lost task is written again by Spark's committer."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive, filled = 0, 0
        for frame in frames:
            packed, archives, held = [], [], 0
            for text in frame["value"]:
                data = members(bytes(text) + _BREAK.encode() * 2)
                if filled and filled + len(data) > file_bytes:
                    archive, filled = archive + 1, 0
                filled += len(data)
                held += len(data)
                packed.append(data[:-1])  # the writer adds the last byte
                archives.append(archive)
                if held > BATCH_BYTES:
                    yield pd.DataFrame({"value": packed, "archive": archives})
                    packed, archives, held = [], [], 0
            yield pd.DataFrame({"value": packed, "archive": archives})

    rows = record(captures(pages)).select(F.col("value").cast("binary").alias("value")).mapInPandas(pack, "value binary, archive int")
    rows.select(F.col("value").cast("string").alias("value"), "archive").write.option("lineSep", "\0").partitionBy("archive").text(path)
    return path


def read_records(stream) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record, by its Content-Length."""
    offset = 0
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at {offset}: {line[:40]!r}")
        length, headers = len(line), {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            length += len(line)
            name, _, value = line[:-2].decode().partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        end = stream.read(4)
        if end != b"\r\n\r\n" or len(block) != int(headers["Content-Length"]):
            raise ValueError(f"record at {offset} is cut off")
        length += len(line) + len(block) + 4
        yield offset, length, headers, block
        offset += length


def _member(content: memoryview, at: int) -> tuple[bytes, int]:
    """The data of the gzip member at ``at``, and the place behind it."""
    reader, parts, step = zlib.decompressobj(31), [], 4096
    while not reader.eof:
        piece = content[at : at + step]
        if not len(piece):
            raise ValueError("a member is cut off")
        parts.append(reader.decompress(piece))
        at, step = at + len(piece), min(2 * step, 1 << 20)
    return b"".join(parts), at - len(reader.unused_data)


def _whole(data: bytes) -> bool:
    """Whether ``data`` reaches to the end of the record that it begins with."""
    head = data.find(b"\r\n\r\n")
    if head < 0:
        return False
    (size,) = (int(line[16:]) for line in data[:head].split(b"\r\n") if line.startswith(b"Content-Length: "))
    return len(data) >= head + 4 + size + 4


def read_archive(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record; ``content[offset : offset + length]`` are the members that hold it.

    Members that hold several whole records are read too; these records share offset and length.
    """
    view, at = memoryview(content), 0
    while at < len(view):
        start, data = at, b""
        while not _whole(data):
            if at >= len(view):
                raise ValueError(f"record at {start} is cut off")
            more, at = _member(view, at)
            data += more
        for _, _, headers, block in read_records(io.BytesIO(data)):
            yield start, at - start, headers, block


INDEX = "run string, file string, url_key string, time string, page_id string, type string, digest string, bytes long, refers string, offset long, length long"


def _number(urn: str) -> str | None:
    return urn[len("<urn:page:") : -1] or None


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index lines of each archive, sorted by URL key, time and id; digests of stored payloads are checked."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                lines = []
                for offset, length, headers, block in read_archive(content):
                    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["X-Payload-Length"])
                    if headers["WARC-Type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                            raise ValueError(f"{name}: the payload at {offset} is not what its digest says")
                    refers = headers.get("WARC-Refers-To")
                    lines.append((
                        headers.get("X-URL-Key", ""), headers["WARC-Date"], _number(headers["WARC-Record-ID"]), headers["WARC-Type"],
                        digest, size, _number(refers) if refers else None, offset, length,
                    ))
                lines.sort(key=lambda x: (x[0].encode(), x[1], int(x[2] or -1), x[7]))
                out = pd.DataFrame(lines, columns=["url_key", "time", "page_id", "type", "digest", "bytes", "refers", "offset", "length"])
                yield out.assign(run=hashlib.md5(name.encode()).hexdigest()[:12], file="/".join(name.rsplit("/", 2)[1:]))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    names = [x.split()[0] for x in INDEX.split(", ")]
    return files.mapInPandas(lambda frames: (f[names] for f in run(frames)), INDEX)


def fetch(index: DataFrame, path: str) -> DataFrame:
    """The lines of ``index`` with the ``block`` of their records, each read from the archives below ``path`` by its range alone.

    Files are opened by the workers' Arrow file systems. The block is the HTTP message; that of a revisit has no payload.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, lines in frame.groupby("file", sort=False):
                held, blocks = 0, []
                with open_file(f"{path.rstrip('/')}/{file}") as source:
                    for i, (at, size) in enumerate(zip(lines["offset"], lines["length"], strict=True)):
                        ((_, _, _, block),) = read_archive(source.read_at(int(size), int(at)))
                        blocks.append(block)
                        held += len(block)
                        if held > BATCH_BYTES:
                            yield lines.iloc[i + 1 - len(blocks) : i + 1].assign(block=blocks)
                            held, blocks = 0, []
                yield lines.iloc[len(lines) - len(blocks) :].assign(block=blocks)

    lines = index.select(*[x.split()[0] for x in INDEX.split(", ")])
    return lines.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInPandas(read, f"{INDEX}, block binary")


class LoserTree:
    """Merges sorted lists: inner nodes keep the loser of their match, so that each next row costs one path to the root."""

    def __init__(self, runs: list[list]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.loser = [-1] * self.size
        self.winner = self._build(1)

    def _head(self, run: int):
        return self.runs[run][self.at[run]] if 0 <= run < len(self.runs) and self.at[run] < len(self.runs[run]) else None

    def _before(self, a: int, b: int) -> bool:
        """Whether the head of run a comes first; ended runs come last, ties go to the smaller run."""
        one, two = self._head(a), self._head(b)
        if one is None or two is None:
            return two is None and (one is not None or a < b)
        return (one, a) < (two, b)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (a, b) if self._before(a, b) else (b, a)
        self.loser[node] = lose
        return win

    def __iter__(self):
        while (row := self._head(self.winner)) is not None:
            yield row
            self.at[self.winner] += 1
            node = (self.winner + self.size) >> 1
            while node:
                if self._before(self.loser[node], self.winner):
                    self.loser[node], self.winner = self.winner, self.loser[node]
                node >>= 1


def merge_runs(runs: list[list], fan_in: int = FAN_IN) -> list:
    """One sorted list, in passes of at most ``fan_in`` runs."""
    while len(runs) > 1:
        runs = [list(LoserTree(runs[i : i + fan_in])) for i in range(0, len(runs), fan_in)]
    return runs[0] if runs else []


def merged_index(runs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """All index lines in one order of (url_key, time, page_id): partitions are ranges, each merged from its pieces of the runs.

    The cut is by the whole key, so the captures of one URL may span ranges. A piece arrives in blocks; rows that go on in
    order lengthen the run of their block, others begin a new one.
    """
    ranges = max(1, -(-runs.count() // rows_per_range))

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        one = pd.concat(held, ignore_index=True)
        keys = list(zip(
            [k.encode() for k in one["url_key"]], one["time"], [int(p) if isinstance(p, str) else -1 for p in one["page_id"]], one["run"],
            one["offset"], range(len(one)), strict=True,
        ))
        pieces: list[list] = []
        for key in keys:
            if pieces and pieces[-1][-1][3] == key[3] and pieces[-1][-1] < key:
                pieces[-1].append(key)
            else:
                pieces.append([key])
        yield one.iloc[np.array([key[-1] for key in merge_runs(pieces)])]

    number = F.coalesce(F.col("page_id").cast("long"), F.lit(-1))
    return runs.repartitionByRange(ranges, "url_key", "time", number, "run", "offset").mapInPandas(merge, INDEX)


def archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the archives of ``pages``, reads them back and returns the merged index, one line per page.

    Null html is an empty payload, a null url has no target and an empty key, a null page_id stays null; repeated rows are
    records of their own. An empty table gives an empty index; other columns are ignored.
    """
    spark = pages.sparkSession
    path = write_archives(pages, path or scratch_path(spark, "warc"))
    return merged_index(stored(capture_runs(spark, path), "capture-runs"))


def digest(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url_key."""
    return index.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers").cast("long").alias("refers_to"), "url_key",
    )
