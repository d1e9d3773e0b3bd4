"""Growing logs: appended bytes are read once, lines are never split or lost."""

import io
import os

import numpy as np
import pytest

from loadlens.streaming import tail


class Memory:
    def __init__(self, data):
        self.data, self.reads = data, 0

    def read_at(self, n, at):
        self.reads += n
        return self.data[at : at + n]


@pytest.mark.parametrize("part", [1, 2, 3, 7, 50, 1000])
@pytest.mark.parametrize("block", [1, 5, 4096])
def test_every_line_belongs_to_one_part(part, block):
    rng = np.random.default_rng(part * 100 + block)
    for _ in range(20):
        lines = [b"x" * int(rng.choice([0, 1, 2, 9, 40])) for _ in range(int(rng.integers(0, 12)))]
        data = b"".join(x + b"\n" for x in lines) + b"y" * int(rng.integers(0, 5))
        got, reached = [], 0
        for low in range(0, len(data), part):
            for text, place in tail.complete_lines(Memory(data), low, min(low + part, len(data)), len(data), low == 0, block):
                assert text.endswith(b"\n") and data[place - len(text) : place] == text
                got += text[:-1].split(b"\n")
                reached = max(reached, place)
        assert got == lines and reached == sum(len(x) + 1 for x in lines)


def test_a_part_reads_little_more_than_itself():
    data = b"0123456789\n" * 10_000
    file = Memory(data)
    list(tail.complete_lines(file, 50_000, 60_000, len(data), False, 1000))
    assert file.reads <= 12_000


def line(n):
    return f"1 {n} {n % 977} 0 1700000{n % 1000:03d} 5"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with io.open(path, "w", newline="") as f:
        f.write(text)


def test_passes_over_growing_cut_and_new_files(spark, tmp_path):
    root, path = str(tmp_path / "logs"), str(tmp_path / "store")
    a, b, c = (f"{root}/set/run/{s}/pgbench_log.1" for s in ("s1", "s2", "s3"))
    text = lambda *numbers: "".join(line(n) + "\n" for n in numbers)
    seen = lambda: sorted((r["step"], r["txn_no"]) for r in tail.appended_logs(spark, path).collect())
    go = lambda: tail.ingest_appended(spark, root, path, part_bytes=64)
    put(a, text(*range(50)) + line(50)[:7])
    put(b, text(1, 2))
    put(f"{root}/set/run/s2/pgbench.log", text(99))
    first = go()
    assert first == os.path.getsize(a) + os.path.getsize(b)
    assert seen() == [("s1", n) for n in range(50)] + [("s2", 1), ("s2", 2)]
    assert go() == 0 and len(seen()) == 52
    before = os.path.getsize(a)
    put(a, text(*range(80)))  # the half line is finished and more follow
    assert go() == os.path.getsize(a) - before + 7
    assert seen() == [("s1", n) for n in range(80)] + [("s2", 1), ("s2", 2)]
    put(b, text(7))  # shorter: begun anew
    put(a, text(*range(500, 700)))  # longer, but other bytes: begun anew
    put(c, "")
    assert go() == os.path.getsize(a) + os.path.getsize(b)
    assert seen() == [("s1", n) for n in range(500, 700)] + [("s2", 7)]
    os.remove(b)
    put(c, "no line\n" + text(3))
    go()
    assert seen() == [("s1", n) for n in range(500, 700)] + [("s2", 7), ("s3", 3)]
    left = sorted(os.listdir(f"{path}/offsets"))
    assert len(left) <= 2 and not os.listdir(f"{path}/plan") and not os.listdir(f"{path}/raw")


def test_a_pass_that_failed_is_repeated(spark, tmp_path):
    import shutil

    root, path = str(tmp_path / "logs"), str(tmp_path / "store")
    put(f"{root}/set/run/s/pgbench_log", "".join(line(n) + "\n" for n in range(9)))
    tail.ingest_appended(spark, root, path)
    put(f"{root}/set/run/s/pgbench_log", "".join(line(n) + "\n" for n in range(12)))
    tail.ingest_appended(spark, root, path)
    shutil.rmtree(f"{path}/offsets/batch_id=1")  # as if the pass had ended before its commit
    assert tail.appended_logs(spark, path).count() == 9
    tail.ingest_appended(spark, root, path)
    assert sorted(r["txn_no"] for r in tail.appended_logs(spark, path).collect()) == list(range(12))


def test_ranges_are_dealt_to_many_tasks(spark):
    plan = spark.createDataFrame([("a", 0, 0, 6400), ("b", 0, 640, 1280), ("c", 0, 5, 5)], "file string, begun bigint, start bigint, length bigint")
    parts = tail._parts(plan, 64, 110)
    rows = parts.selectExpr("file", "part", "spark_partition_id() as task").collect()
    assert sorted((r.file, r.part) for r in rows) == [("a", n) for n in range(0, 6400, 64)] + [("b", n) for n in range(640, 1280, 64)]
    assert len({r.task for r in rows}) > 1
