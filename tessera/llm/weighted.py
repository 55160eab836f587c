"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

The terms of a text are its words, weighted by their counts.  For every sample
k and term t, variates r and c of Gamma(2, 1) and a uniform b come from a hash
of (t, k).  With the weight w, ``s = floor(ln w / r + b)`` and
``ln a = ln c - r (s - b) - r``; the sample is the pair (t, s) of the term with
the least a.  Two texts draw the same pair with a probability equal to their
generalised Jaccard similarity, the sum of the lesser weights over the sum of
the greater ones.

The table is cut into chunks of consecutive doc_ids; one shuffle of the texts
by chunk serves the successor of a document, the counts of its terms and its
samples.  The first text of the next chunk comes by a small join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLES = 32
#: Samples per row of work (a divisor of the samples), bits of a table index.
GROUP, TABLE_BITS = 4, 12
CHUNK_ROWS = 250
#: Characters of text per task, so that the terms of a task fit in memory.
TASK_CHARS = 4_000_000
KNOTS = 200
#: Hex digits per sample.
DIGITS = 6


def gamma_quantiles(n: int) -> list[float]:
    """Gamma(2, 1) at the middles of n equal steps of probability, by Newton's method."""
    out, x = [], 0.01
    for i in range(n):
        p = (i + 0.5) / n
        for _ in range(60):
            step = (1 - (1 + x) * math.exp(-x) - p) / (x * math.exp(-x))
            x = max(x - step, x / 2)
            if abs(step) < 1e-13 * x:
                break
        out.append(x)
    return out


def _draw(terms: DataFrame, samples: int) -> DataFrame:
    """``(chunk, rn, kind, print)`` from ``(chunk, rn, kind, term, weight)``.

    The variates come from tables of quantiles, looked up by the bits of one
    hash per (term, sample).  A sample is the least of one number per term: ln a
    in the high bits, a hash of (term, s) in the low 24.  ``GROUP`` samples are
    one row's work, which keeps the compiled code short.
    """
    spark = terms.sparkSession
    q = gamma_quantiles(1 << TABLE_BITS)
    tables = spark.createDataFrame([(q, [math.log(x) for x in q])], "r array<double>, lnc array<double>")
    all_r, all_c = tables.select("r").scalar(), tables.select("lnc").scalar()
    groups = samples // GROUP
    rows = terms.select("chunk", "rn", "kind", "term", F.ln("weight").alias("lnw"),
                        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    mask = F.lit((1 << TABLE_BITS) - 1)
    least = []
    for j in range(GROUP):
        g = F.xxhash64("term", "part", F.lit(j))
        r = F.get(all_r, g.bitwiseAND(mask).cast("int"))
        c = F.get(all_c, F.shiftright(g, TABLE_BITS).bitwiseAND(mask).cast("int"))
        b = F.shiftrightunsigned(g, 2 * TABLE_BITS).bitwiseAND(F.lit((1 << 24) - 1)) / F.lit(float(1 << 24))
        s = F.floor(F.col("lnw") / r + b)
        a = c - r * (s - b + 1)
        mark = F.xxhash64("term", s, "part", F.lit(j)).bitwiseAND(F.lit((1 << 24) - 1))
        least.append(F.min(F.shiftleft(F.floor((a + 64) * F.lit(float(1 << 32))), 24).bitwiseOR(mark)).alias(f"s{j}"))
    drawn = rows.groupBy("chunk", "rn", "kind", "part").agg(*least)
    digits = [F.lpad(F.lower(F.hex(F.col(f"s{j}").bitwiseAND(F.lit((1 << 24) - 1)))), DIGITS, "0") for j in range(GROUP)]
    drawn = drawn.select("chunk", "rn", "kind", "part", F.concat(*digits).alias("print"))
    in_order = [F.max(F.when(F.col("part") == p, F.col("print"))) for p in range(groups)]
    return drawn.groupBy("chunk", "rn", "kind").agg(F.concat(*in_order).alias("print"))


def _with_chunk(rows: DataFrame, knots: list[int], chunks: int) -> DataFrame:
    """Add ``chunk``, which never falls with doc_id: by the approximate quantiles
    ``knots`` of the ids about equally many rows in each of ``chunks``.  Rows
    without an id are dealt to negative chunks by the hash of their text."""
    nil = -1 - F.pmod("tie", F.lit(chunks))
    if len(knots) < 2 or knots[0] == knots[-1]:
        return rows.withColumn("chunk", F.when(F.col("doc_id").isNull(), nil).otherwise(0))
    steps = len(knots) - 1
    all_ = F.array(*[F.lit(k).cast("bigint") for k in knots])
    below = F.greatest(F.lit(1), F.least(F.lit(steps), F.size(F.filter(all_, lambda k: k <= F.col("doc_id")))))
    rows = rows.withColumn("_at", below)
    rows = rows.withColumn("_lo", F.element_at(all_, F.col("_at"))).withColumn("_hi", F.element_at(all_, F.col("_at") + 1))
    share = (F.col("doc_id").cast("double") - F.col("_lo")) / F.greatest(F.lit(1.0), F.col("_hi").cast("double") - F.col("_lo"))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
    chunk = F.least(F.lit(chunks - 1), F.floor((F.col("_at") - 1 + share) / steps * chunks))
    return rows.withColumn("chunk", F.when(F.col("doc_id").isNull(), nil).otherwise(chunk)).drop("_at", "_lo", "_hi")


def _following(chunks: DataFrame) -> DataFrame:
    """``(chunk, following)``: the next chunk that has rows; after the last, the first."""
    one = chunks.withColumn("g", F.floor(F.col("chunk") / 1024))
    heads = one.groupBy("g").agg(F.min("chunk").alias("head"))
    over_all = Window.orderBy("g")  # a millionth of the rows
    heads = heads.select("g", F.lead("head").over(over_all).alias("next_head"),
                         F.first("head").over(over_all).alias("very_first"))
    inside = one.withColumn("n", F.lead("chunk").over(Window.partitionBy("g").orderBy("chunk")))
    return inside.join(heads, "g").select("chunk", F.coalesce("n", "next_head", "very_first").alias("following"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints."""
    one = lambda x, i: F.substring(x, i * DIGITS + 1, F.lit(DIGITS))
    same = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: one(a, i) == one(b, i))
    return F.size(same) / F.lit(float(samples))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprint every text of ``docs (doc_id, text, ...)`` and its edited text,
    the last ``floor(n / 2)`` code points replaced by the first as many of the
    next document by doc_id (after the last: the first).

    Returns one row per input row: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.
    A null text is empty; a text without words has the one term "".  Rows of
    one doc_id follow each other by a hash of the text.  A row with a null
    doc_id has no successor: its next document is the empty text.  An empty
    table gives an empty result; other columns are not read.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / KNOTS for i in range(KNOTS + 1)]
    n, chars, knots = base.agg(F.count(F.lit(1)), F.sum(F.length("text")), F.percentile_approx("doc_id", shares, 20_000)).first()
    chunks = max(1, math.ceil(n / CHUNK_ROWS))
    rows = _with_chunk(base.withColumn("tie", F.xxhash64("text")), knots or [], chunks)
    tasks = max(math.ceil((chars or 0) / TASK_CHARS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(tasks, "chunk")

    order = Window.partitionBy("chunk").orderBy("doc_id", "tie")
    lined = rows.select("chunk", F.row_number().over(order).alias("rn"), "doc_id", "text",
                        F.lead("text").over(order).alias("next"), F.lead(F.lit(1)).over(order).isNull().alias("last"))
    # no filter on the chunk here: it would be pushed below the shuffle of the
    # texts, which then could not be shared with the one above
    heads = rows.withColumn("rn", F.row_number().over(order)).where("rn = 1").select(
        F.col("chunk").alias("following"), F.col("text").alias("head"))
    ids = rows.where("chunk >= 0").select("chunk").distinct()
    border = _following(ids).join(heads, "following").select(F.col("chunk").alias("c"), "head")
    lined = lined.join(border, (F.col("chunk") == F.col("c")) & F.col("last"), "left")
    after = F.when(F.col("doc_id").isNull(), F.lit("")).otherwise(F.coalesce("next", "head", F.lit("")))
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - half), F.substring(after, F.lit(1), half))
    lined = lined.select("chunk", "rn", "doc_id", "text", "last", length.cast("bigint").alias("n_chars"),
                         after.alias("after"), edited.alias("edited"))

    own = F.struct(F.lit(0).alias("kind"), F.col("text").alias("t"))
    new = F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t"))
    nxt = F.struct(F.lit(2).alias("kind"), F.col("after").alias("t"))
    alone = F.col("last") | F.col("doc_id").isNull()
    texts = lined.select("chunk", "rn", F.explode(F.when(alone, F.array(own, new, nxt)).otherwise(F.array(own, new))).alias("x"))
    words = texts.select("chunk", "rn", F.col("x.kind").alias("kind"),
                         F.explode(F.split("x.t", r"[\x20\x09-\x0D]+")).alias("word"))
    terms = words.groupBy("chunk", "rn", "kind", F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("weight"))
    drawn = _draw(terms, samples)
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("print")))
    prints = drawn.groupBy("chunk", "rn").agg(of(0).alias("fingerprint"), of(1).alias("edited_fingerprint"), of(2).alias("next_own"))
    along = Window.partitionBy("chunk").orderBy("rn")
    prints = prints.withColumn("next_print", F.coalesce("next_own", F.lead("fingerprint").over(along)))

    facts = lined.select("chunk", "rn", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    out = facts.join(prints, ["chunk", "rn"])
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next_print"), samples).alias("near_next"))
