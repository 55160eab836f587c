import random

from tessera.llm import lines
from tests.llm.helpers import DOC_SCHEMA, documents, doc_rows, got, prose


def expected(rows):
    """The same by one walk over the documents in order."""
    seen, out = set(), {}
    key = lambda r: (r[0] is None, r[0] or 0)
    for doc, text in sorted({r for r in rows if r[1] is not None}, key=key):
        data = text.encode()
        all_ = data.split(b"\n")
        gone = set()
        for first, end, body in lines._candidates(data):
            if body in seen:
                gone |= set(range(first, end))
            seen.add(body)
        out[doc, text] = b"\n".join(x for i, x in enumerate(all_) if i not in gone).decode()
    return out


def corpus():
    r = random.Random(3)
    shared = ["\n".join(prose(i * 10 + j, 6) for j in range(8)) for i in range(4)]
    long = prose(99, 60)
    rows = []
    for i in range(60):
        own = [prose(1000 + i * 50 + j, 7) for j in range(10)]
        if i % 3 == 0:
            own.insert(r.randrange(10), shared[i % 4])
        if i % 5 == 0:
            own.insert(r.randrange(10), long)
        rows.append((i, "\n".join(own)))
    return rows + [(60, rows[4][1]), (61, "short\nlines"), (62, "short\nlines"), (63, long), (64, "a\n\n\nb")]


def test_against_one_walk(spark):
    rows = corpus()
    out = {r["doc_id"]: r for r in got(lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), counts=True))}
    want = expected(rows)
    for doc, text in rows:
        assert out[doc]["text"] == want[doc, text]
        assert out[doc]["removed_words"] == len(text.split()) - len(out[doc]["text"].split())
    long = prose(99, 60)
    assert [i for i, r in out.items() if long in r["text"]] == [0]  # a long line repeated anywhere goes
    assert out[62]["text"] == "short\nlines" and out[60]["text"] == ""
    cut = [i for i in range(3, 60, 3) if out[i]["removed_lines"] > 2]
    assert len(cut) >= 10  # shifted copies of a passage lose most of it


def test_same_hash_but_other_bytes_stays(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(lines.F, "xxhash64", lambda *c: F.length(c[0]).cast("bigint") * 0, raising=True)
    rows = [(1, "\n".join(prose(i, 9) for i in range(6))), (2, "\n".join(prose(i, 9) for i in range(20, 26)))]
    out = {r["doc_id"]: r["text"] for r in got(lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")))}
    assert out == dict(rows)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in doc_rows()] + [(None, "x " * 30 + "\n" + "y " * 30), (5, None)]
    full = doc_rows() + [(None, "x " * 30 + "\n" + "y " * 30, None, None, None, None, None, None, None), (5, None, *[None] * 7)]
    docs = spark.createDataFrame(full, DOC_SCHEMA)
    out = lines.dedup(docs)
    assert out.columns == docs.columns
    want = expected(rows)
    have = sorted(((r["doc_id"], r["text"]) for r in got(out)), key=repr)
    assert have == sorted(((i, want[i, t] if t is not None else None) for i, t in rows), key=repr)
    assert lines.dedup(documents(spark, [])).collect() == []


def test_passages_at_random_places_go_as_a_whole(spark):
    r = random.Random(11)
    rows, passages, n = [], {}, 0
    for size in range(2, 9):
        for k in range(6):
            # 50 words and more in lines that are all below LONG_WORDS
            passage = [f"p{size}.{k}.{j} " + prose(7000 + size * 100 + k * 10 + j, 25 if size < 4 else 15) for j in range(size)]
            for _ in range(2):
                own = [f"own{n}.{j} " + prose(20_000 + n * 20 + j, 9) for j in range(12)]
                at = r.randrange(len(own) + 1)
                rows.append((n, "\n".join(own[:at] + passage + own[at:])))
                passages[n] = (passage, own)
                n += 1
    out = {x["doc_id"]: x["text"].split("\n") for x in got(lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")))}
    for doc, text in rows:
        assert out[doc] == (passages[doc][1] if doc % 2 else text.split("\n"))


def test_many_blank_lines_stay_cheap():
    sizes = [3, *[0] * 50_000, 6, 9]
    runs = lines.shortest_runs(sizes)
    assert (0, 50_002) in runs and sum(end - first for first, end in runs) < 20 * len(sizes)
