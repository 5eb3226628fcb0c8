"""Token counts by section, from one encoding of the whole document.

A document is encoded once, as a whole, by a byte-level vocabulary, so the tokens' bytes put together are the
text and every token has a span.  Sections are spans as well (by default sentences and lines, each with the
blank that ends it, so that they cover the text).  Sorted spans of tokens and sections are joined by position;
a token that crosses a boundary belongs to the section that holds most of its bytes, the earlier one if two
hold as many.  Counting section by section instead would encode the text anew and split such tokens: a word
with its leading blank is one token, and the blank belongs to the sentence before.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reviewmill.llm.shared import sliced

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's public tokenizer cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = "doc_id bigint, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint"


def encoding(path: str):
    """The encoder and the number of bytes of each of its tokens."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def sentence_ends(text: bytes) -> np.ndarray:
    """Byte positions where sections end: after each line break, after the blank that follows . ! or ?, and at
    the end of the text."""
    letters = np.frombuffer(text, np.uint8)
    closed = np.zeros(len(letters), bool)
    closed[1:] = np.isin(letters[:-1], np.frombuffer(b".!?", np.uint8)) & (letters[1:] == 32)
    ends = np.flatnonzero(closed | (letters == 10)) + 1
    return ends if len(ends) and ends[-1] == len(text) else np.append(ends, len(text))


def attributed(token_ends: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section and, of them, those that cross a boundary.  Both cover the same bytes."""
    token_starts = np.append(0, token_ends[:-1])
    section_starts = np.append(0, section_ends[:-1])
    first = np.searchsorted(section_ends, token_starts, "right")
    last = np.searchsorted(section_ends, token_ends - 1, "right")
    in_first = section_ends[first] - token_starts
    in_last = token_ends - section_starts[last]
    owner = np.where((first == last) | (in_first >= in_last), first, last)
    for i in np.flatnonzero(last - first > 1):  # tokens over three sections and more are rare
        touched = np.arange(first[i], last[i] + 1)
        held = np.minimum(section_ends[touched], token_ends[i]) - np.maximum(section_starts[touched], token_starts[i])
        owner[i] = touched[np.argmax(held)]
    n = len(section_ends)
    return np.bincount(owner, minlength=n), np.bincount(owner[first != last], minlength=n)


def count(
    docs: DataFrame, vocabulary: str = VOCABULARY, cut: Callable[[bytes], np.ndarray] = sentence_ends
) -> DataFrame:
    """One row per document and section: doc_id, section (from 0), start and end in code points of the whole text,
    n_tokens, n_crossing (tokens counted here that reach into another section).

    ``docs`` needs doc_id and text; other columns are ignored.  The sum of n_tokens over a document is its
    number of tokens.  ``cut`` gives the byte positions where sections end, ascending, the length of the text last
    (fields joined into one text can be counted with their ends).  A null or empty text gives one empty section; ids are passed through.  ``vocabulary`` is
    a path that every executor can read.  A map over rows without a shuffle.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = encoding(vocabulary)
        for batch in sliced(batches, 200):
            parts = []
            for text in batch.column("text").to_pylist():
                raw = (text or "").encode()
                sections = cut(raw)
                tokens = encoder.encode_to_numpy(text, disallowed_special=()) if text else np.zeros(0, np.int64)
                if len(tokens):
                    found = attributed(np.cumsum(lengths[tokens]), sections)
                else:
                    found = np.zeros(len(sections), np.int64), np.zeros(len(sections), np.int64)
                points = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))[sections]
                parts.append((np.append(0, points[:-1]), points, *found))
            each = np.array([len(part[0]) for part in parts])
            row = np.repeat(np.arange(len(parts)), each)
            columns = [np.concatenate(column).astype(np.int64) for column in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()).take(pa.array(row)),
                    pa.array(np.concatenate([np.arange(n) for n in each]).astype(np.int32)),
                    *[pa.array(column) for column in columns],
                ],
                names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
            )

    return docs.select("doc_id", "text").mapInArrow(counted, SCHEMA)
