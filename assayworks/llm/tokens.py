"""Documents as pieces of token ids."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from assayworks.llm.arrowtext import text_chunks

CAPACITY = 1024
#: Both libraries give the same ids for texts of these characters; other texts go to the reference tokenizer.
COMMON = 0x250
#: The fast library's pattern goes deeper with every character of a run of white space, and overflows its stack near 700,000.
LONG_SPACE = 10_000
_SPACES = re.compile(r"\s{%d}" % LONG_SPACE)


@lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str, pattern: str) -> Callable[[list[str]], list[np.ndarray]]:
    """Token ids as ``tokenizers`` gives them for a vocabulary file, without special tokens of its own.

    ``ranks`` is the same vocabulary as merge ranks for tiktoken, which is four times as fast;
    it encodes texts in Latin letters that hold no special token and no very long run of white space. With an empty
    ``ranks`` all texts go the slow way. Both give the same ids.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)
    exact.no_truncation()
    special = [x["content"] for x in _added(vocabulary)]
    if not ranks:
        return lambda texts: [np.array(exact.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]
    import tiktoken

    with open(ranks, "rb") as file:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def one(text: str) -> np.ndarray:
        common = text.isascii() or ord(max(text)) < COMMON
        if len(text) >= LONG_SPACE and _SPACES.search(text):
            common = False
        if common and not any(x in text for x in special):
            return np.array(fast.encode_ordinary(text), np.uint32)
        return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)

    return lambda texts: [one(t) for t in texts]


def _added(vocabulary: str) -> list[dict]:
    import json

    with open(vocabulary) as file:
        return json.load(file).get("added_tokens", [])


def cuts(tokens: int, capacity: int) -> list[int]:
    """Starts of the pieces of a document, and its end. The first piece of a long one takes the remainder."""
    first = tokens % capacity or min(tokens, capacity)
    return [0, *range(first, tokens + 1, capacity)] if tokens else [0, 0]


def token_pieces(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, end_id: int,
                 capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length and ids (little-endian unsigned 32-bit).

    A document is its ids followed by ``end_id``; a NULL text is empty, so it is the end id alone. Only
    documents longer than ``capacity`` are cut. Repeated rows and NULL ids give pieces of their own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks, pattern)
        for batch in batches:
            texts, ids = batch.column(1), batch.column(0)
            for part in text_chunks(texts):
                rows, piece, start, length, blobs = [], [], [], [], []
                own = texts.slice(int(part.rows[0]), len(part.rows)).to_pylist()
                for row, encoded in zip(part.rows, encode([t or "" for t in own]), strict=True):
                    whole = np.append(encoded, np.uint32(end_id)).astype("<u4")
                    at = cuts(len(whole), capacity)
                    for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                        rows.append(row)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        blobs.append(whole[a:b].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(blobs, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"])

    schema = "doc_id long, piece int, start long, length long, ids binary"
    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS string) AS text").mapInArrow(run, schema)
