"""S1 by blocks: one large file read by many tasks, against Python's csv module."""

import csv
import io
import os
import random

import pytest
from hypothesis import given, settings, strategies as st

from tessera.session import staging_path
from tessera.sources import files, quoted_csv

KEY = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in (KEY, "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield lambda n: spark.conf.set(KEY, str(n))
    for k, v in old.items():
        spark.conf.set(k, v)


def write(spark, name, rows, header=("row_id", "source_text", "target_text"), end="\n"):
    folder = staging_path(spark, "csv-in").replace("file:", "")
    os.makedirs(folder, exist_ok=True)
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(header)
    w.writerows(rows)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as fh:
        fh.write(out.getvalue())
    return folder


def want(rows):
    return sorted((str(a), b or None, c or None) for a, b, c in rows)


def got(df):
    return sorted(tuple(r) for r in df.select("row_id", "source_text", "target_text").collect())


def hard_rows(n, seed=0):
    r = random.Random(seed)
    bits = ['"', '""', ",", "\n", "\n\n", "\r\n", "x", "word ", "é", "中", " ", "a,b", '\n"', '",\n']
    return [(i, "".join(r.choices(bits, k=r.randrange(12))), "t" * r.randrange(30) + r.choice(bits)) for i in range(n)]


def test_blocks_of_one_file_are_read_by_many_tasks(spark, small_blocks):
    rows = hard_rows(3000)
    # a field far longer than a block, full of line feeds and quotes: whole blocks lie inside it
    rows[1500] = (1500, "\n".join(['say "no"'] * 600), "end")
    path = write(spark, "one.csv", rows)
    small_blocks(2048)
    df = files.read_pairs_csv(spark, path, keep=("row_id",))
    blocks = quoted_csv.block_parity(quoted_csv._lines(spark, path))
    assert blocks.count() > 30 and blocks.where("opens").count() > 3
    assert quoted_csv._lines(spark, path).rdd.getNumPartitions() > 30
    assert got(df) == want(rows)


def test_without_broadcast(spark, small_blocks, monkeypatch):
    monkeypatch.setattr(quoted_csv, "BROADCAST_BLOCKS", 0)
    rows = hard_rows(800, 3)
    path = write(spark, "one.csv", rows)
    small_blocks(1024)
    assert got(files.read_pairs_csv(spark, path, keep=("row_id",))) == want(rows)


def test_no_text_is_shuffled_but_pieces(spark, small_blocks):
    path = write(spark, "one.csv", hard_rows(500))
    small_blocks(1024)
    plan = files.read_pairs_csv(spark, path)._jdf.queryExecution().executedPlan().toString()
    whole = plan.split("Union")[1].split("Window")[0]
    assert "Exchange" not in whole.split("MapInPandas")[0] or "BroadcastExchange" in whole


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_several_files_line_ends_and_header(spark, small_blocks, end):
    a, b = hard_rows(40, 1), [(100 + i, s, t) for i, s, t in hard_rows(40, 2)]
    # a carriage return right before the end of an unquoted record would be part of the line end
    path = write(spark, "a.csv", a, end=end)
    other = write(spark, "b.csv", b, end=end)
    os.rename(f"{other}/b.csv", f"{path}/b.csv")
    open(f"{path}/empty.csv", "w").close()
    small_blocks(512)
    assert got(files.read_pairs_csv(spark, path, keep=("row_id",))) == want(a + b)


def test_typed_schema_header_names_and_bom(spark):
    from tessera.plans.queries import PAIR_ROW_SCHEMA

    path = write(spark, "a.csv", [(1, "s", "t")])
    with open(f"{path}/a.csv", encoding="utf-8") as fh:
        text = fh.read()
    with open(f"{path}/a.csv", "w", encoding="utf-8") as fh:
        fh.write("\ufeff" + text + "\n\n2,,\n")
    assert sorted(map(tuple, files.read_pairs_csv(spark, path, schema=PAIR_ROW_SCHEMA).collect())) == [(1, "s", "t"), (2, None, None)]
    other = write(spark, "b.csv", [(2, "x", "y")], header=("row_id", "target_text", "source_text"))
    with pytest.raises(Exception, match="the header is not"):
        files.read_pairs_csv(spark, [path, other], schema=PAIR_ROW_SCHEMA).collect()


def test_malformed(spark):
    from tessera.plans.queries import PAIR_ROW_SCHEMA

    path = write(spark, "a.csv", [])
    with open(f"{path}/a.csv", "a") as fh:
        fh.write('1,"open,t\n2,a,b\n')
    with pytest.raises(ValueError, match="not closed"):
        files.read_pairs_csv(spark, path)
    path = write(spark, "a.csv", [("x", "s", "t")])
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        files.read_pairs_csv(spark, path, schema=PAIR_ROW_SCHEMA).collect()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='a",\n', max_size=8), min_size=1, max_size=3), max_size=12),
       st.lists(st.integers(1, 60), max_size=6))
def test_assembly_is_independent_of_the_cuts(fields, cuts):
    """Records from any cut of the lines into blocks, without Spark."""
    import pandas as pd

    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(fields)
    lines = out.getvalue().split("\n")[:-1]
    at, blocks = 0, []
    for c in cuts + [len(lines)]:
        blocks.append(lines[at:at + c])
        at += c
    frames, odd = [], 0
    for i, block in enumerate(blocks):
        frames.append(pd.DataFrame({"file": "f", "block": i, "opens": bool(odd), "value": block}))
        odd ^= sum(line.count('"') for line in block) % 2
    done = pd.concat(list(quoted_csv._assembled(iter(frames))))
    text, parts = [], []
    for kind, piece in zip(done["kind"], done["text"]):
        parts.append(piece)
        if kind in (quoted_csv.RECORD, quoted_csv.END):
            text.append("\n".join(parts))
            parts = []
    assert not parts
    assert [next(csv.reader(io.StringIO(t))) for t in text] == fields
