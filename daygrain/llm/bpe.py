"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

``encode_table`` adds the token ids of each whole text, ``decode_table``
turns ids back into bytes.  The rank file is read once per task; only its
path travels.  Long texts are cut at safe boundaries before they
reach the tokenizer: between a visible ASCII character and a space.  The
split pattern lets a match hold a space only as its first character or in a
run of white space, and a run of white space cannot begin left of that
space, so every such place is a match boundary in the uncut text too and the
ids do not change.  A text without such a place goes through whole.

Runs of white space of ``RUN_CHARS`` characters and more never reach the split
pattern, whose engine keeps a way back for each character and breaks on a
million: by its rule ``\\s+(?!\\S)`` matches the run up to its last character
(all of it at the end of the text), which is encoded as the one match it is,
and the last character goes with what follows.  Patterns that treat white
space otherwise are not cut there.

Defined cases: null text encodes as empty (no ids, empty bytes); strings
that look like special tokens are ordinary text; repeated rows are encoded
each on their own; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import release, small_batches

SAFE = re.compile(r"(?<=[!-~])(?= [!-~])")
PIECE_CHARS = 1 << 16
RUN_CHARS = 1 << 12
# fixed values: the characters of the White_Space property, which the pattern's \s stands for
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The end of a split pattern whose runs of white space are matched by the rule above.
RUN_RULE = r"|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The tiktoken encoding of a rank file, and the decimal form of every id."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    enc = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    decimal = [""] * (max(ranks.values()) + 1)
    for i in ranks.values():
        decimal[i] = str(i)
    return enc, decimal


def pieces(text: str, size: int = PIECE_CHARS):
    """Cut ``text`` at the first safe boundary after every ``size`` characters."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def runs(text: str, least: int = RUN_CHARS):
    """(start, stop) of each match that is a run of at least ``least`` - 1 white-space characters."""
    for run in re.finditer(f"[{_SPACES}]{{{least},}}", text):
        yield run.start(), run.end() - (run.end() < len(text))


def encode_text(text, enc, size: int = PIECE_CHARS, run: int = RUN_CHARS) -> list[int]:
    """Ids of a whole text; ``size`` and ``run`` (at least 2) only bound what goes to the tokenizer at once."""
    if not isinstance(text, str) or not text:
        return []
    if len(text) <= size:
        return enc.encode_ordinary(text)
    out: list[int] = []
    at = 0
    for start, stop in runs(text, max(2, run)) if enc._pat_str.endswith(RUN_RULE) else ():
        for piece in pieces(text[at:start], size):
            out.extend(enc.encode_ordinary(piece))
        out.extend(enc._encode_single_piece(text[start:stop]))
        at = stop
    for piece in pieces(text[at:], size):
        out.extend(enc.encode_ordinary(piece))
    return out


def decode_ids(ids, enc) -> bytes:
    """The bytes of the ids: pieces of a character may stand alone, so no text is assumed."""
    return enc.decode_bytes(ids)


_KINDS = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}
_ARROW = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}


def encode_table(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep=("doc_id",), outputs=("n_tokens", "ids")) -> DataFrame:
    """``keep`` columns of ``docs`` plus ``outputs``, any of n_tokens, ids, ids_sha256, decoded_sha256.

    The digests are of the decimal ids joined by one space and of the bytes
    decoded from the ids.  One pass, no shuffle.
    """
    keep, outputs = list(keep), list(outputs)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, _KINDS[c]) for c in outputs])
    rows = docs.select(*keep, F.col(text_col).alias("__text"))

    def run(batches):
        enc, decimal = encoding(path, pattern)
        for batch in small_batches(batches, "__text"):
            made = {c: [] for c in outputs}
            for text in batch.column("__text").to_pylist():
                ids = encode_text(text, enc)
                if "n_tokens" in made:
                    made["n_tokens"].append(len(ids))
                if "ids" in made:
                    made["ids"].append(np.array(ids, np.int32))
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(" ".join([decimal[i] for i in ids]).encode()).hexdigest())
                if "decoded_sha256" in made:
                    made["decoded_sha256"].append(hashlib.sha256(decode_ids(ids, enc)).hexdigest())
            columns = [batch.column(c) for c in keep] + [pa.array(made[c], _ARROW[c]) for c in outputs]
            yield pa.RecordBatch.from_arrays(columns, names=keep + outputs)
        # workers outlive the task: one that goes on with other work should not keep the ranks
        del enc, decimal
        encoding.cache_clear()
        release()

    return rows.mapInArrow(run, schema)


def decode_table(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``decoded`` (binary); null ids decode to empty bytes."""
    keep = list(keep)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())])

    def run(batches):
        enc, _ = encoding(path, pattern)
        for batch in batches:
            decoded = [decode_ids(ids or [], enc) for ids in batch.column("__ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(decoded, pa.binary())], names=[*keep, "decoded"])

    return df.select(*keep, F.col(ids_col).alias("__ids")).mapInArrow(run, schema)
