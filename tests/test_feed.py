"""Order, ranks and batches."""

import hashlib

import pytest

from tessera.operators.feed import assign_batch, assign_rank, collect_batches, shuffle_position
from tessera.operators.ordered import carry, positions
from tests.helpers import rows


def py_order(ids, epoch, seed):
    key = lambda r: (hashlib.md5(f"{seed}:{epoch}:{r}".encode()).hexdigest(), r)
    return sorted(ids, key=key)


def test_shuffle_equals_python(spark):
    ids = list(range(0, 300, 3))
    df = spark.createDataFrame([(i,) for i in ids], "row_id long")
    got = {(r.epoch, r.pos): r.row_id for r in shuffle_position(df, epochs=2, seed=7, bucket_digits=1).collect()}
    for e in range(2):
        assert [got[(e, p)] for p in range(len(ids))] == py_order(ids, e, 7)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_shuffle_is_partition_invariant(spark, parts):
    df = spark.createDataFrame([(i,) for i in range(50)], "row_id long").repartition(parts)
    base = spark.createDataFrame([(i,) for i in range(50)], "row_id long")
    assert rows(shuffle_position(df, epochs=2)) == rows(shuffle_position(base, epochs=2))


def test_positions_range_method_equals_row_number(spark):
    data = [(k % 3, (k * 37) % 101, k) for k in range(200)]
    df = spark.createDataFrame(data, "g int, o int, id int")
    got = {r.id: r.pos for r in positions(df, ["o", "id"], ["g"], num_partitions=5).collect()}
    for g in range(3):
        ordered = sorted((o, i) for gg, o, i in data if gg == g)
        for p, (_, i) in enumerate(ordered):
            assert got[i] == p


@pytest.mark.parametrize("n,world", [(10, 4), (3, 8), (8, 4), (1, 3)])
def test_wrap_padding(spark, n, world):
    df = spark.createDataFrame([(0, i, i) for i in range(n)], "epoch int, row_id long, pos long")
    out = assign_rank(df, world_size=world, devices_per_node=2).collect()
    total = -(-n // world) * world
    assert len(out) == total
    by_pos = {r.pos: r for r in out}
    for p in range(total):
        assert by_pos[p].row_id == p % n
        assert by_pos[p].is_padding == (p >= n)
        assert by_pos[p].rank == p % world and by_pos[p].pos_in_rank == p // world
        assert by_pos[p].node_rank == (p % world) // 2 and by_pos[p].local_rank == (p % world) % 2
    sizes = {}
    for r in out:
        sizes[r.rank] = sizes.get(r.rank, 0) + 1
    assert len(set(sizes.values())) == 1


def test_no_padding_mode(spark):
    df = spark.createDataFrame([(0, i, i) for i in range(10)], "epoch int, row_id long, pos long")
    assert assign_rank(df, world_size=4, pad="none").count() == 10


def test_batches_keep_short_last_batch(spark):
    df = spark.createDataFrame([(0, i, i) for i in range(10)], "epoch int, row_id long, pos long")
    b = collect_batches(assign_batch(assign_rank(df, world_size=2, pad="none"), 3)).collect()
    sizes = sorted((r.rank, r.batch_id, r.n_rows) for r in b)
    assert sizes == [(0, 0, 3), (0, 1, 2), (1, 0, 3), (1, 1, 2)]
    r0 = [r for r in b if r.rank == 0 and r.batch_id == 0][0]
    assert r0.row_ids == [0, 2, 4]


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("chunk_by", ["value", "position"])
def test_carry_equals_python(spark, direction, inclusive, chunk_by):
    data = [(g, i * 1000003 if chunk_by == "position" else i, (i * 7) % 10 if i % 4 == 0 else None)
            for g in range(2) for i in range(40)]
    df = spark.createDataFrame(data, "g int, o long, v int")
    out = {(r.g, r.o): r.c for r in carry(df, "v", "c", ["g"], "o", direction, inclusive, chunk=6,
                                           chunk_by=chunk_by).collect()}
    for g in range(2):
        seq = [(o, v) for gg, o, v in data if gg == g]
        for idx, (o, _) in enumerate(seq):
            if direction == "forward":
                cand = seq[: idx + 1] if inclusive else seq[:idx]
                vals = [v for _, v in cand if v is not None]
                want = vals[-1] if vals else None
            else:
                cand = seq[idx:] if inclusive else seq[idx + 1:]
                vals = [v for _, v in cand if v is not None]
                want = vals[0] if vals else None
            assert out[(g, o)] == want


def test_results_do_not_depend_on_aqe(spark):
    from tessera.plans.queries import QUERIES
    from tests.conftest import SF_SMALL
    names = ["shuffle_epoch", "rank_batches", "corpus_lines_group", "monitor_parse_backfill"]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    out = {}
    try:
        for flag in ("true", "false"):
            spark.conf.set("spark.sql.adaptive.enabled", flag)
            out[flag] = [rows(QUERIES[n](spark, SF_SMALL)) for n in names]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert out["true"] == out["false"]
