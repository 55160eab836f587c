"""URL filters by Bloom filter cascades, in DataFrame operations only.

A cascade answers exactly whether a key of a known universe is listed.  Level 1
is a Bloom filter of the listed keys; the unlisted keys of the universe that it
lets through are the keys of level 2, the listed ones that level 2 lets through
those of level 3, and so on until no false positive is left.  A key is looked
up level by level until a filter says no.  The universe is every key that the
corpus holds, so no page needs a join: the bit arrays are scalar subqueries.  A
list too long for that is judged in parts, key by key.

Rules are listed by the key ``host + path``.  A page's candidate keys are its
host's suffixes and path's prefixes of the shapes that the rules have (labels
of the host, length of the path), the longest first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import staged
from tessera.session import staging_path

#: A filter of more bits than this is not sent to all tasks: so long a list is
#: split by a hash of the keys into parts, each with a cascade of its own that
#: judges the distinct keys of its part.
MOST_BITS = 1 << 26

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _positions(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 100 + i)), F.lit(bits)).cast("bigint") for i in range(hashes)]


class Cascade:
    """Exact membership of the keys of a universe in a list (see above)."""

    def __init__(self, universe: DataFrame, listed: DataFrame):
        """Both frames have one column ``key`` of distinct non-null strings; keys
        that are listed but not in the universe are left out."""
        flagged = universe.join(listed.withColumn("listed", F.lit(True)), "key", "left")
        flagged = staged(flagged.select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "url-keys")
        self.levels: list[tuple[DataFrame, int, int]] = []
        self.parts = 1  # how many parts the list must be split into
        encoded, others = flagged.where("listed").select("key"), flagged.where("not listed").select("key")
        n, m = encoded.count(), others.count()
        while n:
            rate = min(0.5, n / (m * math.sqrt(2))) if m and not self.levels else 0.5
            bits = max(64, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2))
            bits = -(-bits // 64) * 64
            if bits > MOST_BITS:
                self.parts = 2 * math.ceil(bits / MOST_BITS)
                return
            hashes = max(1, min(20, round(bits / n * math.log(2))))
            level = len(self.levels)
            at = encoded.select(F.explode(F.array(*_positions(F.col("key"), level, hashes, bits))).alias("p"))
            words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
                F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("p", F.lit(64)).cast("int"))).alias("b"))
            full = encoded.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("w"), "left")
            row = full.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0).cast("bigint")).alias("b")))),
                                       lambda x: x["b"]).alias("words"))
            self.levels.append((staged(row, "url-bits"), hashes, bits))
            passed = staged(others.where(self._in(level, F.col("key"))), "url-passed")
            encoded, others, n, m = passed, encoded, passed.count(), n

    def _in(self, level: int, key: Column) -> Column:
        row, hashes, bits = self.levels[level]
        words = row.scalar()
        hit = F.lit(True)
        for p in _positions(key, level, hashes, bits):
            word = F.get(words, F.shiftright(p, 6).cast("int"))
            one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(p, F.lit(64)).cast("int"))
            hit = hit & (word.bitwiseAND(one) != 0)
        return hit

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed; a null key is not."""
        n = len(self.levels)
        answer = F.lit(n % 2 == 1)
        for level in range(n - 1, -1, -1):
            answer = F.when(self._in(level, key), answer).otherwise(F.lit(level % 2 == 1))
        return key.isNotNull() & answer


def members(universe: DataFrame, listed: DataFrame, parts: int) -> DataFrame:
    """The keys of the universe that are listed, part by part: a part's keys and
    its list are those of one hash value, and its cascade is sent to the tasks
    that read this part only.  A part that is still too long is split again."""
    spark, found = universe.sparkSession, None
    root = staging_path(spark, "url-parts")
    for name, keys in (("universe", universe), ("listed", listed)):
        keys.select("key", F.pmod(F.xxhash64("key", F.lit(7_919 * parts)), F.lit(parts)).alias("part")).write.partitionBy(
            "part").parquet(f"{root}/{name}")
    schema = "key string, part int"
    for part in range(parts):
        own = spark.read.schema(schema).parquet(f"{root}/universe").where(F.col("part") == part).select("key")
        own_list = spark.read.schema(schema).parquet(f"{root}/listed").where(F.col("part") == part).select("key")
        cascade = Cascade(own, own_list)
        keys = own.where(cascade.contains(F.col("key"))) if cascade.parts == 1 else members(own, own_list, 2 * parts + 1)
        keys = staged(keys, "url-members")
        found = keys if found is None else found.unionByName(keys)
    return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], blocked_labels: Sequence[str] = ()) -> DataFrame:
    """Judge the url of each of ``pages (page_id, url, ...)``.

    ``rules`` are pairs of a rule (host and path, like ``example.net/en/``) and
    ``block`` or ``allow``.  A rule fits its host and all subdomains, where the
    path starts with the rule's; the longest fitting rule decides.  A page that
    no rule fits is blocked if its host is listed: if one of the host's labels is in
    ``blocked_labels``.

    Returns one row per input row: ``page_id``, ``host``, ``path``, ``rule``
    (null if none fits) and ``verdict``.  A null url, or one without ``://``,
    has empty host and path, no rule and the verdict allow; repeated rows are
    judged alike; other columns are not read.  An empty table gives an empty
    result.
    """
    spark = pages.sparkSession
    verdicts = {"".join(_split_rule(r)): v for r, v in rules}
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p in map(_split_rule, verdicts)}, reverse=True)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    names = []
    for labels, size in shapes:
        names.append(f"_k{labels}_{size}")
        fits = (F.length("path") >= size) & (F.length("host") > 0)
        rows = rows.withColumn(names[-1], F.when(fits, F.concat(
            F.substring_index("host", ".", -labels), F.substring("path", 1, size))))
    seen = staged(rows.select("host", *names).distinct(), "url-hosts")

    def keys(values: Column) -> DataFrame:
        return seen.select(F.explode(values).alias("key")).where("key is not null").distinct()

    universe = staged(keys(F.array(*[F.col(n) for n in names])) if names else seen.select(F.col("host").alias("key")).limit(0),
                      "url-universe")
    known = spark.createDataFrame([(r, v) for r, v in verdicts.items()], "key string, verdict string")
    listed = {v: Cascade(universe, known.where(F.col("verdict") == v).select("key")) for v in ("block", "allow")}
    hosts = staged(seen.select(F.col("host").alias("key")).distinct(), "url-hosts")
    labels = spark.createDataFrame([(x,) for x in dict.fromkeys(blocked_labels)], "label string")
    of_host = hosts.select("key", F.explode(F.split("key", r"\.")).alias("label"))
    spam_hosts = of_host.join(labels, "label", "left_semi").select("key").distinct()
    spam = Cascade(hosts, spam_hosts)

    if any(c.parts > 1 for c in (*listed.values(), spam)):
        by_rule = [members(universe, known.where(F.col("verdict") == v).select("key"), c.parts).withColumn("verdict", F.lit(v))
                   for v, c in listed.items()]
        return _judge_by_keys(rows, names, by_rule[0].unionByName(by_rule[1]), members(hosts, spam_hosts, spam.parts))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    if names:
        found = [(F.col(n), listed["block"].contains(F.col(n)), listed["allow"].contains(F.col(n))) for n in names]
        found = F.array(*[F.when(b | a, F.struct(F.length(k).alias("length"), k.alias("rule"),
                                                 F.when(b, "block").otherwise("allow").alias("verdict"))) for k, b, a in found])
        rows = rows.withColumn("_best", F.array_max(found))
        rule, verdict = F.col("_best.rule"), F.col("_best.verdict")
    else:
        rows = rows.withColumn("_best", F.lit(None))
    by_label = spam.contains(F.col("host"))
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, F.when(by_label, "block").otherwise("allow")).alias("verdict"))


def _judge_by_keys(rows: DataFrame, names: list[str], rules: DataFrame, spam: DataFrame) -> DataFrame:
    """The same from keys that cascades have judged in parts.  Verdicts come back
    to the pages by shuffled joins of distinct places, so a hot host is one row."""
    places = staged(rows.select("host", "path", *names).distinct().withColumn("_id", F.xxhash64("host", "path")), "url-places")
    keys = places.select("_id", F.explode(F.array(*[F.col(n) for n in names])).alias("key")).where("key is not null").distinct()
    best = keys.join(rules, "key").groupBy("_id").agg(F.max(F.struct(F.length("key").alias("n"), "key", "verdict")).alias("b"))
    hit = spam.select(F.col("key").alias("host"), F.lit(True).alias("spam"))
    judged = places.select("host", "path", "_id").join(best, "_id", "left").join(hit, "host", "left").select(
        "host", "path", F.col("b.key").alias("rule"),
        F.coalesce("b.verdict", F.when(F.col("spam"), "block").otherwise("allow")).alias("verdict"))
    return rows.select("page_id", "host", "path").join(judged, ["host", "path"])
