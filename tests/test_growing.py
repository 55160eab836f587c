"""S4 over several runs: growth, rotation, unfinished lines; only new bytes are read."""

import io
import os
import random

import pytest

from tessera.session import staging_path
from tessera.sources import files, growing
from tests.helpers import rows


class Log:
    def __init__(self, spark):
        self.path = staging_path(spark, "growing-in").replace("file:", "")
        self.root = staging_path(spark, "growing-root")

    def name(self, host, file):
        os.makedirs(f"{self.path}/source={host}", exist_ok=True)
        return f"{self.path}/source={host}/{file}"

    def add(self, host, file, text, mode="ab"):
        with open(self.name(host, file), mode) as fh:
            fh.write(text.encode())


@pytest.fixture
def log(spark):
    return Log(spark)


def line(host, i):
    return f"{host} {i:06d} " + "x" * (i * 7 % 50)


def text(host, a, b):
    return "".join(line(host, i) + "\n" for i in range(a, b))


def want(**upto):
    return sorted(((h, i, line(h, i)) for h, n in upto.items() for i in range(n)), key=repr)


def ingested(spark, log, **kw):
    return rows(growing.read_ingested(spark, log.root, **kw), ["source", "line_no", "line"])


def test_two_runs_equal_one(spark, log):
    log.add("a", "log", text("a", 0, 300))
    log.add("b", "log", text("b", 0, 5))
    assert growing.ingest(spark, log.path, log.root, chunk=1000) == 1
    assert ingested(spark, log) == want(a=300, b=5)
    new = text("a", 300, 420)
    log.add("a", "log", new)
    log.add("c", "log", text("c", 0, 3))
    assert growing.ingest(spark, log.path, log.root, chunk=1000) == 2
    assert ingested(spark, log) == want(a=420, b=5, c=3)
    assert growing.planned_bytes(spark, log.root, 2) == len(new) + len(text("c", 0, 3))
    assert ingested(spark, log, since=1) == [r for r in want(a=420, c=3) if r not in want(a=300)]
    assert rows(files.read_text_lines(spark, log.path, source="source"), ["source", "line_no", "line"]) == want(a=420, b=5, c=3)
    assert growing.ingest(spark, log.path, log.root) == 3  # nothing new
    assert growing.planned_bytes(spark, log.root, 3) == 0 and ingested(spark, log) == want(a=420, b=5, c=3)


def test_rotation_by_renaming(spark, log):
    log.add("a", "log", text("a", 0, 100))
    growing.ingest(spark, log.path, log.root)
    log.add("a", "log", text("a", 100, 150))  # written after the run, before the rotation
    os.rename(log.name("a", "log"), log.name("a", "log.1"))
    log.add("a", "log", text("a", 150, 180))
    growing.ingest(spark, log.path, log.root)
    assert ingested(spark, log) == want(a=180)
    os.rename(log.name("a", "log.1"), log.name("a", "log.2"))
    os.rename(log.name("a", "log"), log.name("a", "log.1"))
    log.add("a", "log", text("a", 180, 181))
    growing.ingest(spark, log.path, log.root)
    assert ingested(spark, log) == want(a=181)
    assert growing.planned_bytes(spark, log.root, 3) == len(text("a", 180, 181))
    os.remove(log.name("a", "log.2"))  # old files may go
    log.add("a", "log", text("a", 181, 200))
    growing.ingest(spark, log.path, log.root)
    assert ingested(spark, log) == want(a=200)


def test_a_file_written_anew(spark, log):
    log.add("a", "log", text("a", 0, 50))
    growing.ingest(spark, log.path, log.root)
    log.add("a", "log", text("a", 50, 53), mode="wb")  # cut down and reused
    growing.ingest(spark, log.path, log.root)
    assert ingested(spark, log) == want(a=53)
    log.add("a", "log", text("a", 53, 60))
    growing.ingest(spark, log.path, log.root)
    assert ingested(spark, log) == want(a=60)


def test_unfinished_last_line(spark, log):
    log.add("a", "log", text("a", 0, 10) + line("a", 10)[:5])
    growing.ingest(spark, log.path, log.root)
    assert ingested(spark, log) == want(a=10)
    log.add("a", "log", line("a", 10)[5:] + "\n" + line("a", 11))
    growing.ingest(spark, log.path, log.root)
    assert ingested(spark, log) == want(a=11)
    growing.ingest(spark, log.path, log.root, final=True)
    assert ingested(spark, log) == want(a=12)


def test_a_lost_run_is_done_again(spark, log, monkeypatch):
    log.add("a", "log", text("a", 0, 30))
    growing.ingest(spark, log.path, log.root)
    log.add("a", "log", text("a", 30, 60))
    with monkeypatch.context() as m:  # the run ends before its manifest
        m.setattr(growing, "MANIFEST", "no such type")
        with pytest.raises(Exception):
            growing.ingest(spark, log.path, log.root)
    assert ingested(spark, log) == want(a=30)
    assert growing.ingest(spark, log.path, log.root) == 2
    assert ingested(spark, log) == want(a=60)


def test_nothing_there_and_files_as_sources(spark, log):
    os.makedirs(log.path)
    assert ingested(spark, log) == []
    with open(f"{log.path}/one.log", "wb") as fh:
        fh.write(b"caf\xc3\xa9\r\n\n\nlast\n")
    growing.ingest(spark, log.path, log.root, source=None)
    got = [(r[1], r[2]) for r in ingested(spark, log)]
    assert got == [(0, "café\r"), (1, ""), (2, ""), (3, "last")]


@pytest.mark.parametrize("seed", range(5))
def test_chunks_of_any_size(seed):
    """Every line once, whatever the borders, without Spark."""
    r = random.Random(seed)
    body = "\n".join("y" * r.choice([0, 1, 3, 40, 300]) for _ in range(60)).encode() + r.choice([b"", b"\n"])
    for final in (True, False):
        for chunk in (1, 2, 7, 64, 5000):
            got = []
            for start in range(0, len(body), chunk):
                got += growing.lines_of(io.BytesIO(body + b"later\n"), 0, len(body), start, min(start + chunk, len(body)), final)
            whole = body.split(b"\n")
            whole = whole[:-1] if whole[-1] == b"" or not final else whole
            assert [x[0] for x in got] == whole
