"""Secret scanning: three fixed patterns, and zstandard novelty for the rest.

A string that follows a sensitive word is compressed with a dictionary made of
the text around it and of common identifiers.  A value that the surroundings
explain (a name, a placeholder, a word of the text) shrinks to a few bytes; a
random secret does not.  What keeps most of its size is reported.

Every candidate is measured; what it is made of only moves the limit.  Letters of
one case alone may be a word that the near surroundings lack, so these are
measured against much more of the text, whose syllables a word shares.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import in_small_batches, runs

# fixed patterns of the contract
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(
    r"(?ai:pass(?:word|phrase|code|wd)?|pwd|secret|token|credentials?|auth(?:orization)?|bearer|private|signature|salt|"
    r"session|api|key)(?a:[\w.-]{0,16})[\"']?[\x20\t]{0,4}(?:[:=]|=>|is|bearer|basic)?[\x20\t]{0,4}[\"'`]?"
    r"([A-Za-z0-9+/_.=~!@#$%^&*-]{12,})")
IDENTIFIERS = (b"password passwd secret token api_key apikey access_key secret_key private_key public_key client_id "
               b"client_secret username user_name example changeme placeholder your_password_here os.environ getenv "
               b"config settings default localhost https://www.example.com/ xxxxxxxxxxxxxxxx 0000000000000000 "
               b"1234567890 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ authorization bearer session_id "
               b"return function import class public static void string null true false none undefined")
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
#: Letters of both cases, other than a capital in front.
BOTH_CASES = re.compile("(?s)(?=.*[a-z]).+[A-Z]")
#: What values of one kind of character must keep beyond ``least_novelty``.
PLAIN_EXTRA = 0.1
#: Characters before and after a word-like value that it is measured against.
WIDE = 16_384
_HEXISH = bytes(0x78 if i in b"0123456789abcdef" else 0x20 for i in range(256))


def novelty(value: bytes, around: bytes, level: int = 3) -> float:
    """Marginal compressed bytes per byte of ``value`` after ``around``."""
    known = zstandard.ZstdCompressionDict(IDENTIFIERS + b" " + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    c = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
    return (len(c.compress(value)) - len(c.compress(b""))) / len(value)


def is_novel(text: str, lo: int, hi: int, least: float, window: int) -> bool:
    """Whether ``text[lo:hi]`` keeps enough of its size after its surroundings."""
    value = text[lo:hi]
    near = lambda n: (text[max(0, lo - n) : lo] + text[hi : hi + n]).encode()
    if DIGIT.search(value) and LETTER.search(value):
        return novelty(value.encode(), near(window)) >= least
    if novelty(value.encode(), near(window)) < least + PLAIN_EXTRA:
        return False
    return bool(not LETTER.search(value) or BOTH_CASES.search(value)) or novelty(
        value.encode(), near(WIDE), level=19) >= least + PLAIN_EXTRA


def spans(text: str, least_novelty: float = 0.8, window: int = 256) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all spans of a text, in code points, in order."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"x" * 24 in text.encode().translate(_HEXISH):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    base = sorted(found)
    for m in SENSITIVE.finditer(text):
        lo, hi = m.span(1)
        if any(s < hi and lo < e for s, _, e in base):
            continue
        if is_novel(text, lo, hi, least_novelty, window):
            found.append((lo, 3, hi))
    return sorted(found)


def digest(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def scan(docs: DataFrame, least_novelty: float = 0.8) -> DataFrame:
    """Spans in each whole text of ``docs (doc_id, text, ...)``: ``doc_id``,
    ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` (of the spans of the
    three patterns) and ``spans`` (these and the novel ones) as
    ``kind:start:end``, by start and then kind, in code points, end exclusive.

    One row per input row, repeated rows included; a null or empty text has no
    spans; a null doc_id passes through.  An empty table gives an empty result.
    """
    def work(batches):
        for b in batches:
            texts = list(b["text"])
            for lo, hi in runs([len(t or "") for t in texts]):
                all_ = [spans(t or "", least_novelty) for t in texts[lo:hi]]
                base = [[x for x in s if x[1] < 3] for s in all_]
                count = lambda k: [sum(x[1] == k for x in s) for s in base]
                yield pd.DataFrame({
                    "doc_id": b["doc_id"].iloc[lo:hi].to_numpy(), "n_assign": count(0), "n_access": count(1), "n_hex": count(2),
                    "base_sha256": [hashlib.sha256(digest(s).encode()).hexdigest() for s in base],
                    "spans": [digest(s) for s in all_]})

    narrow = in_small_batches(docs).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInPandas(work, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
                                    "base_sha256 string, spans string")
