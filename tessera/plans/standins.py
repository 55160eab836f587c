"""Small deterministic stand-ins for user-supplied tokenizers, models and
metric callbacks (no model library or network is available).  They follow
the call conventions the user-function operators expect."""

from __future__ import annotations

import numpy as np
import pandas as pd

from tessera.functions.tokens import BYTE_EOS, BYTE_OFFSET, BYTE_PAD, BYTE_SPECIAL_TEXT, CLEAN_UP_REPLACEMENTS


class ByteTokenizer:
    """Byte-level tokenizer: id = byte + 3, eos 1 appended, pad 0 on the right."""

    def __call__(self, texts, max_length, padding="max_length", truncation=True, add_special_tokens=True):
        ids = np.full((len(texts), max_length), BYTE_PAD, dtype=np.int32)
        mask = np.zeros((len(texts), max_length), dtype=np.int32)
        budget = max_length - (1 if add_special_tokens else 0)
        for i, t in enumerate(texts):
            b = np.frombuffer(t.encode("utf-8"), dtype=np.uint8)
            if truncation:
                b = b[:budget]
            row = b.astype(np.int32) + BYTE_OFFSET
            if add_special_tokens:
                row = np.append(row, BYTE_EOS)
            ids[i, :len(row)] = row
            mask[i, :len(row)] = 1
        return {"input_ids": ids, "attention_mask": mask}

    def decode(self, ids, skip_special_tokens=True, clean_up_tokenization_spaces=True):
        data = bytearray()
        for x in map(int, ids):
            if BYTE_OFFSET <= x < BYTE_OFFSET + 256:
                data.append(x - BYTE_OFFSET)
            elif not skip_special_tokens and x in BYTE_SPECIAL_TEXT:
                data.extend(BYTE_SPECIAL_TEXT[x].encode())
        text = bytes(data).decode("utf-8", errors="ignore")
        if clean_up_tokenization_spaces:
            for a, b in CLEAN_UP_REPLACEMENTS:
                text = text.replace(a, b)
        return text


class EchoModel:
    """A "model" whose every returned sequence is the input echoed back
    (encoded, cut to ``max_length`` with its end token, decoded)."""

    def __init__(self):
        self.tok = ByteTokenizer()

    def generate(self, texts, num_return_sequences=1, max_length=512, **_options):
        enc = self.tok(texts, max_length=max_length)
        outs = []
        for row, m in zip(enc["input_ids"], enc["attention_mask"]):
            text = self.tok.decode(row[m == 1])
            outs.append([text] * num_return_sequences)
        return outs


def python_split_lines(batch: pd.DataFrame) -> pd.DataFrame:
    """A batch mapper written the plain-Python way: split every text on
    line feeds, strip, drop blank and heading lines."""
    rows = []
    for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
        if text is None:
            continue
        for i, x in enumerate(text.split("\n")):
            line = x.strip()
            if line == "" or line.endswith(":"):
                continue
            rows.append((doc_id, i, line))
    return pd.DataFrame(rows, columns=["doc_id", "line_no", "text"]).astype({"doc_id": "int64", "line_no": "int64"})


def accuracy_partial(batch: pd.DataFrame) -> dict[str, float]:
    """Additive part of an argmax accuracy callback."""
    if len(batch) == 0:
        return {"n_examples": 0.0, "n_correct": 0.0}
    logits = np.stack(batch["logits"].to_numpy())
    pred = np.argmax(logits, axis=-1)
    return {"n_examples": float(len(batch)), "n_correct": float((pred == batch["label"].to_numpy()).sum())}
