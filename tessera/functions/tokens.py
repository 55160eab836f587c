"""Byte-level token encoding as native Spark expressions.

The byte family needs no vocabulary: every UTF-8 byte ``b`` becomes id
``b + 3``.  Everything below is built from ``encode``/``hex``/``conv`` and
array functions, so encoding runs in the JVM with no Python worker.  Texts
are cut to the byte budget *before* they are expanded into arrays, so a
20,000-word document costs no more than its first ``max_length`` bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Fixed values of the byte-level tokenizer family (public library
# behaviour): pad, end-of-sequence and unknown ids, and the offset added to
# every byte value.
BYTE_PAD = 0
BYTE_EOS = 1
BYTE_UNK = 2
BYTE_OFFSET = 3
# The text of the special tokens when they are not skipped.
BYTE_SPECIAL_TEXT = {BYTE_PAD: "<pad>", BYTE_EOS: "</s>", BYTE_UNK: "<unk>"}

# The spacing clean-up applied by ``decode(...,
# clean_up_tokenization_spaces=True)``, in the order the library applies it.
CLEAN_UP_REPLACEMENTS = [
    (" .", "."),
    (" ?", "?"),
    (" !", "!"),
    (" ,", ","),
    (" ' ", "'"),
    (" n't", "n't"),
    (" 'm", "'m"),
    (" 's", "'s"),
    (" 've", "'ve"),
    (" 're", "'re"),
]


@dataclass(frozen=True)
class TokenPreset:
    """How a text becomes a fixed-length id row.

    ``labels``: ``copy`` (causal, padding included), ``mask_zero`` (every
    id 0 becomes -100) or ``mask_pad`` (every padded position becomes -100).
    """

    name: str
    bos: int | None
    eos: int | None
    pad: int
    side: str
    labels: str

    @property
    def n_special(self) -> int:
        return int(self.bos is not None) + int(self.eos is not None)


PRESETS = {
    "seq2seq": TokenPreset("seq2seq", bos=None, eos=BYTE_EOS, pad=BYTE_PAD, side="right", labels="mask_zero"),
    "causal_copy": TokenPreset("causal_copy", bos=None, eos=None, pad=BYTE_EOS, side="right", labels="copy"),
    "causal_left": TokenPreset("causal_left", bos=BYTE_UNK, eos=None, pad=BYTE_EOS, side="left", labels="mask_zero"),
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def preset(p: str | TokenPreset) -> TokenPreset:
    if isinstance(p, TokenPreset):
        return p
    try:
        return PRESETS[p]
    except KeyError:
        raise ValueError(f"unknown token preset {p!r}; known: {sorted(PRESETS)}") from None


def byte_ids(text, max_bytes: int) -> Column:
    """H4 + H6: ids of the first ``max_bytes`` UTF-8 bytes of ``text``.

    The cut happens on the binary value, so it may fall inside a multi-byte
    character exactly as the tokenizer's id truncation does.  The bytes are
    then read as ISO-8859-1, where every byte is one character with the
    byte's value as code point, so splitting into characters and taking
    code points yields the byte values without a per-byte conversion.
    """
    b = F.substring(F.encode(_col(text), "UTF-8"), 1, max_bytes)
    chars = F.split(F.decode(b, "ISO-8859-1"), "", -1)
    ids = F.transform(chars, lambda x: F.ascii(x) + F.lit(BYTE_OFFSET))
    return F.when(F.octet_length(b) > 0, ids).otherwise(F.array().cast("array<int>"))


def byte_count(text, max_bytes: int) -> Column:
    """``size(byte_ids(text, max_bytes))`` without building the array: the
    byte length of the cut text (0 for an empty or null text)."""
    return F.coalesce(F.octet_length(F.substring(F.encode(_col(text), "UTF-8"), 1, max_bytes)), F.lit(0))


def encode_text(text, max_length: int, p: str | TokenPreset = "seq2seq") -> dict[str, Column]:
    """H4-H11 for one text column: ``input_ids``, ``attention_mask`` and
    ``labels``, each an ``ARRAY<INT>`` of exactly ``max_length``.

    The attention mask comes from the real length, never from the ids (pad
    may equal eos).  Byte ids are never 0, so ``mask_zero`` only touches
    padding when pad is 0 and can be built without a per-element lambda.
    """
    p = preset(p)
    budget = max_length - p.n_special
    if budget < 0:
        raise ValueError("max_length is smaller than the number of special tokens")
    parts = []
    if p.bos is not None:
        parts.append(F.array(F.lit(p.bos)))
    parts.append(byte_ids(text, budget))
    if p.eos is not None:
        parts.append(F.array(F.lit(p.eos)))
    real = F.concat(*parts) if len(parts) > 1 else parts[0]
    # the real length from the byte count, not from ``size(real)``: a mask
    # (or a token count) then never builds the id array
    k = byte_count(text, budget) + F.lit(p.n_special)
    fill = F.lit(max_length) - k

    def pad_with(value) -> Column:
        return F.array_repeat(F.lit(value), fill)

    if p.side == "right":
        ids = F.concat(real, pad_with(p.pad))
        mask = F.concat(F.array_repeat(F.lit(1), k), pad_with(0))
    elif p.side == "left":
        ids = F.concat(pad_with(p.pad), real)
        mask = F.concat(pad_with(0), F.array_repeat(F.lit(1), k))
    else:
        raise ValueError(f"unknown padding side {p.side!r}")

    if p.labels == "copy":
        labels = ids
    elif p.labels == "mask_pad" or (p.labels == "mask_zero" and p.pad == 0):
        labels = F.concat(real, pad_with(-100)) if p.side == "right" else F.concat(pad_with(-100), real)
    elif p.labels == "mask_zero":
        labels = ids
    else:
        raise ValueError(f"unknown labels mode {p.labels!r}")
    return {"input_ids": ids, "attention_mask": mask, "labels": labels}


def clean_up_spaces(c) -> Column:
    """Remove the blank before punctuation and common contractions."""
    out = _col(c)
    for search, repl in CLEAN_UP_REPLACEMENTS:
        out = F.replace(out, F.lit(search), F.lit(repl))
    return out


# fixed values: the well-formed UTF-8 byte sequences of two to four bytes
UTF8_SEQUENCE = (
    r"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    r"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}")


def decode_ids(ids, skip_special: bool = True, clean_spaces: bool = True) -> Column:
    """Byte ids back to text.  Special ids are skipped, or written as
    their token text with ``skip_special=False``; out-of-range ids are
    skipped; bytes that do not form valid UTF-8 are dropped (as
    ``errors='ignore'``)."""
    a = _col(ids)
    in_range = lambda x: (x >= F.lit(BYTE_OFFSET)) & (x < F.lit(BYTE_OFFSET + 256))
    if skip_special:
        a = F.filter(a, in_range)
        piece = lambda x: F.chr(x - F.lit(BYTE_OFFSET))
    else:
        def piece(x):
            out = F.when(in_range(x), F.chr(x - F.lit(BYTE_OFFSET)))
            for i, t in BYTE_SPECIAL_TEXT.items():
                out = out.when(x == F.lit(i), F.lit(t))
            return out.otherwise(F.lit(""))
    # one ISO-8859-1 character per byte; the characters that spell no valid
    # UTF-8 sequence are taken out (errors="ignore"), the rest goes back to
    # bytes and is read as UTF-8, so a genuine U+FFFD stays
    latin1 = F.array_join(F.transform(a, piece), "")
    valid = F.regexp_replace(latin1, f"({UTF8_SEQUENCE})|[\\x80-\\xff]", "$1")
    text = F.encode(valid, "ISO-8859-1").cast("string")
    return clean_up_spaces(text) if clean_spaces else text
