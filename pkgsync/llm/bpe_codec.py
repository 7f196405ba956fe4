"""Byte-level BPE encoding and decoding by the tiktoken library with a local rank file.

Long texts are cut at safe boundaries first (before a single space between two characters that aren't white
space, where the split pattern always starts a new match), so that the library never holds one huge text; the ids
are those of the whole text.  Decoding joins the ids' raw bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents

#: Texts of more characters than this are cut into parts of about this size.
LONG = 32_768
BOUNDARY = re.compile(r"(?<=\S)(?= \S)")


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    """One tiktoken encoding for each worker process; no special tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def decimals(path: str, pattern: str) -> list[str]:
    return [str(i) for i in range(encoding(path, pattern).max_token_value + 1)]


def parts(text: str, long: int = LONG) -> Iterator[str]:
    """The text in order, in parts of about ``long`` characters that end at safe boundaries.

    A stretch without a boundary (one very long word, or white space only) stays whole.
    """
    at = 0
    while len(text) - at > long:
        cut = BOUNDARY.search(text, at + long)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str, path: str, pattern: str) -> list[int]:
    """Ids of a whole text, as the library's ``encode_ordinary``."""
    enc, ids = encoding(path, pattern), []
    for p in parts(text):
        ids += enc.encode_ordinary(p)
    return ids


def bpe_roundtrip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """Encode every text and decode its ids again, in one pass over the rows without a shuffle.

    One row per input row: ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas),
    ``decoded_sha256`` (of the decoded bytes), and with ``with_ids`` also ``ids`` (array of int) and ``decoded``
    (binary).  Null and empty texts have no ids.  Repeated rows and null ids give a row each; extra columns of the
    input are left out.  The rank file must be at ``ranks_path`` on every worker.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    more = [("ids", pa.list_(pa.int32())), ("decoded", pa.binary())] if with_ids else []

    def run(batches):
        enc, word = encoding(ranks_path, pattern), decimals(ranks_path, pattern)
        for b in batches:
            out = [[] for _ in fields + more]
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                ids = encode(text, ranks_path, pattern)
                raw = enc.decode_bytes(ids)
                row = [doc_id, len(ids), hashlib.sha256(",".join([word[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()]
                for column, value in zip(out, row + [ids, raw], strict=False):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, fields + more, strict=True)], names=[n for n, _ in fields + more])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_ids else "")
    return documents(docs, id_col, text_col).select("doc_id", "text").mapInArrow(run, schema)
