"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import extract, lines, minhash, mixing, neighbours, outliers, packing, quality, search, secrets, urls, weighted, whitening
from tessera.llm.common import staged, table, word_count


def op1_splitting_tree(spark, sf_dir):
    """Mix of all documents: sources weigh 1, 2, 3 in turn, three passes at most."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(staged(docs, "words"), size=F.col("words"))
    shards = F.transform("draws", lambda d: d["shard"]).alias("shards")
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken", shards)


#: The rules of op2, and host labels blocked where no rule fits.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
BLOCKED_LABELS = ("casino-win", "cheap-pills", "free-bets", "spam-farm")


def op2_bloom_cascade(spark, sf_dir):
    """Verdicts on the urls of all pages."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, BLOCKED_LABELS)


def op3_hyperminhash(spark, sf_dir):
    """Near-duplicate groups over four-word shingles at similarity 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op4_pruned_graph(spark, sf_dir):
    """Near-duplicate vectors of each label at cosine 0.98."""
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_hilbert_packing(spark, sf_dir):
    """All documents packed into sequences of 1024 ids along the Hilbert curve."""
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_bradley_terry(spark, sf_dir):
    """Quality scores of all documents from pairwise ranking."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_weighted_sampling(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return weighted.fingerprints(table(spark, sf_dir, "documents"))


def op8_minimum_cut(spark, sf_dir):
    """Main text of all pages."""
    return extract.extract(table(spark, sf_dir, "pages"))


def op9_line_chunks(spark, sf_dir):
    """All documents without the runs of lines that an earlier one has."""
    return lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op10_zstd_novelty(spark, sf_dir):
    """Secret spans in all documents."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_feast_whitening(spark, sf_dir):
    """All vectors on the 32 leading components of their covariance, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_robust_outliers(spark, sf_dir):
    """Counts and verdicts of the quality rules on all documents."""
    return outliers.judge(table(spark, sf_dir, "documents"))


def op13_bit_sliced_search(spark, sf_dir):
    """The ten best documents for each benchmark item."""
    return search.rank_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_splitting_tree": op1_splitting_tree,
    "op2_bloom_cascade": op2_bloom_cascade,
    "op3_hyperminhash": op3_hyperminhash,
    "op4_pruned_graph": op4_pruned_graph,
    "op5_hilbert_packing": op5_hilbert_packing,
    "op6_bradley_terry": op6_bradley_terry,
    "op7_weighted_sampling": op7_weighted_sampling,
    "op8_minimum_cut": op8_minimum_cut,
    "op9_line_chunks": op9_line_chunks,
    "op10_zstd_novelty": op10_zstd_novelty,
    "op11_feast_whitening": op11_feast_whitening,
    "op12_robust_outliers": op12_robust_outliers,
    "op13_bit_sliced_search": op13_bit_sliced_search,
}

ORACLE: dict[str, str] = {
    "op2_bloom_cascade": """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM u),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN list_has_any(string_split(host, '.'), ['casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block'
    ELSE 'allow' END AS verdict
FROM r""",
    "op13_bit_sliced_search": r"""
WITH t AS (
  SELECT row_number() OVER () AS nth, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM documents),
tf AS (SELECT nth, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT nth, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
c AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM d),
w AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term),
q AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark),
qt AS (SELECT item_id, term, count(*)::BIGINT AS times FROM q GROUP BY ALL),
s AS (
  SELECT item_id, nth, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // big_l))))::BIGINT AS score
  FROM qt JOIN w USING (term) JOIN tf USING (term) JOIN d USING (nth), c GROUP BY ALL),
r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10""",
}
