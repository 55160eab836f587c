"""Quality rules: counts and the robust estimate against brute force."""

import random

import numpy as np
import pytest

from tessera.llm import outliers
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.helpers import doc_rows, documents, prose

SPACE = " \t\n\x0b\x0c\r"


def cut(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACE:
            out, word = out + [word] if word else out, ""
        else:
            word += c
    return out + [word] if word else out


def base(text):
    """The contract's counts and base rule, by plain loops."""
    words = cut(text) if text is None or len(text) < 20_000 else text.split()
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(SPACE):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def counted(r):
    return tuple(r[c] for c in outliers.COUNTS) + (r["base_failed"],)


def test_counts(spark):
    rows = doc_rows()
    rows += [(200 + i, t, "en", "s0") + (None,) * 5 for i, t in enumerate([
        "a b c d e f g h " * 3, "a " * 40, "x\n" * 30, "a\n a\na \nb\nb\n\n \n", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w1 w2 w3 w4 w5 w6 w7 w8",
        "#*$%&|<> " * 5, "é ü \U0001f600 中文 a\x1cb\x85c", "a\x0bb\x0cc\rd", prose(1, 7), prose(1, 8), prose(2, 40) + "\n" + prose(2, 40)])]
    got = outliers.judge(documents(spark, rows))
    have = sorted(((r["doc_id"] is None, r["doc_id"] or 0, counted(r)) for r in got.collect()))
    assert have == sorted((r[0] is None, r[0] or 0, base(r[1])) for r in rows)
    assert all(r["kept"] is (not r["base_failed"]) for r in got.collect())  # too few rows for any estimate
    assert outliers.judge(documents(spark, [])).collect() == []
    assert got.columns[0] == "doc_id" and {"base_failed", "kept"} < set(got.columns)


def test_one_very_long_text():
    words = [f"v{i % 99_991}" for i in range(400_000)]
    got, _ = outliers.counts(" ".join(words).encode())
    assert got[0] == 400_000 and got[4] == 400_000  # the first period is repeated whole, and so are the others


def corpus():
    """Three sources of unlike prose, one of half of the rows; a few odd texts in each."""
    r = random.Random(4)
    rows, odd = [], set()
    for i in range(900):
        source = "hot" if i % 2 else f"s{i % 4}"
        text = prose(i, 60 + i % 90)
        if source == "s2":  # digits are usual here, and odd elsewhere
            text = " ".join(w + str(r.randrange(10 ** 6)) for w in text.split())
        else:
            text = "".join("abcdefghij"[int(c)] if c.isdigit() else c for c in text)
        if i % 30 == 7:
            odd.add(i)
            text = [text.upper(), " ".join(w + "###" for w in text.split()), " ".join(w * 7 for w in text.split()),
                    " | ".join(text.split())][i % 4]
        rows.append((i, text, None if source == "s0" else "en", source) + (None,) * 5)
    rows += [(2000 + i, " ".join(str(r.randrange(10 ** 9)) for _ in range(60)), "xx", "lone") + (None,) * 5 for i in range(5)]
    return rows, odd


def test_odd_texts_go_and_clean_ones_stay(spark):
    rows, odd = corpus()
    kept = {r["doc_id"] for r in outliers.judge(documents(spark, rows)).where("kept").collect()}
    assert kept == {r[0] for r in rows} - odd


def test_least_determinant(spark):
    """The model found is as good as the best of many random starts."""
    rows, _ = corpus()
    docs = documents(spark, [r for r in rows if r[3] == "hot"])
    measured = outliers.measured(docs).withColumn("base_failed", outliers.F.col("n_words") < 20)
    z = outliers._standardised(outliers._grouped(measured))
    x = np.array([[r[f"z_{c}"] for c in outliers.NAMES] for r in z.collect()])
    floor = np.diag(np.asarray(z.first()["floor"]))
    h = int(np.ceil(outliers.SHARE * len(x)))

    def step(at):
        mean = x[at].mean(axis=0)
        cov = (x[at] - mean).T @ (x[at] - mean) / len(at) + floor
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        return np.argsort(d, kind="stable")[:h], np.linalg.slogdet(cov)[1]

    rng, best = np.random.default_rng(0), np.inf
    for _ in range(200):
        at, det = rng.choice(len(x), outliers.P + 1, replace=False), np.inf
        for _ in range(30):
            at, det = step(at)
        best = min(best, step(at)[1])
    keep = z.select("grp", "floor", *[f"z_{c}" for c in outliers.NAMES])
    model = outliers._starts(keep)
    for _ in range(2):
        model = outliers._step(keep, model, 3, outliers.SHARE)
    model = outliers._best(model)
    for _ in range(10):
        model = outliers._step(keep, model, 1, outliers.SHARE)
    assert model.first()["logdet"] <= best + 0.05


def test_quantile():
    assert abs(outliers.chi2_quantile(10, 0.5) - 9.3418) < 1e-3 and abs(outliers.chi2_quantile(10, 0.025) - 20.4832) < 1e-3
    assert abs(outliers.chi2_quantile(10, 1e-4) - 35.564) < 1e-3
    assert outliers.P % 2 == 0


@pytest.mark.parametrize("folder", [SF_SMALL, SF_CHECK])
def test_the_whole_table(spark, folder):
    from tessera.llm.queries import QUERIES

    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op12_robust_outliers"](spark, folder).collect()
    assert {r["doc_id"]: counted(r) for r in got} == {i: base(t) for i, t in rows.items()} and len(got) == len(rows)
    good = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r["quality"] is not None}
    judged = [(good[r["doc_id"]], r["kept"]) for r in got if r["doc_id"] in good and not r["base_failed"]]
    clean, bad = [k for q, k in judged if q == 1], [k for q, k in judged if q == 0]
    assert np.mean(clean) >= 0.99 and (folder == SF_SMALL or np.mean(bad) <= 0.3)
