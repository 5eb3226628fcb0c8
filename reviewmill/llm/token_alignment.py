"""Two tokenizers side by side: groups of tokens between common ends, overlapping pairs, and how common the pairs are.

Both encodings of a text cover the same bytes, so walking along both at once finds every pair of tokens that overlap
and every byte where both end.  The walk is done for all documents of a batch in lockstep: one vector of pointers
into A and one into B; in each step every document emits the link of its two current tokens, a cut where
they end together, and moves on whichever ends first; finished documents leave the vectors.  A long document is
dealt to several places of the vectors (``LANE``), cut where both tokenizers must end, so it doesn't go on alone.

Encoding: neither vocabulary can join a blank to the word before it (``Units`` checks that), so a text is cut before
single blanks between other characters and each distinct piece is encoded once per task.

Counting: a scope is some MB of documents of one task.  It keeps its distinct pairs once, and per document the places
of its pairs among them.  Pairs are summed over the scopes, joined back to the scopes, and a scope's documents are
then scored together, so the pairs of single documents never cross the network.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.shared import raw_texts, sliced
from reviewmill.session import materialise

# Bytes of text that are aligned at a time, and that share one list of distinct pairs.
BATCH = 4 << 20
SCOPE = 16 << 20
# Tokens of A after which a long document goes on in another place of the vectors.
LANE = 4096
REMEMBERED = 200_000
REMEMBERED_TOKENS = 4_000_000
# Fixed value: how vocabulary A's public tokenizer cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = re.compile(r"(?<=\S) (?=\S)")
# A blank beside another one, of any kind.
BESIDE = [pair for c in map(chr, range(0x3001)) if c.isspace() for pair in ((c + " ", " " + c) if c != " " else ("  ",))]
# New pieces that are encoded in one go.
TOGETHER = 2000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: bytes that print stand for themselves, the
    others, in order, for the letters from 256 on."""
    prints = [b for b in range(256) if b not in (32, 160, 173) and unicodedata.category(chr(b)) != "Cc"]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level(path: str):
    """Encoder and token bytes by id of a byte-level vocabulary in JSON whose ids follow the order of its merges."""
    import tiktoken

    with open(path, encoding="utf-8") as lines:
        model = json.load(lines)["model"]
    letters = str.maketrans({letter: chr(byte) for letter, byte in byte_letters().items()})
    raw = lambda written: written.translate(letters).encode("latin-1")
    merged = [raw("".join(pair) if isinstance(pair, list) else pair.replace(" ", "")) for pair in model["merges"]]
    # Special tokens come after the merges; in a text their strings are plain.
    ranks = {raw(token): number for token, number in model["vocab"].items() if number < 256 + len(merged)}
    if [ranks.get(token) for token in merged] != list(range(256, 256 + len(merged))):
        raise ValueError(f"the ids of {path} don't follow its merges")
    encoder = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoder, {number: token for token, number in ranks.items()}


def pieces(path: str):
    """Encoder and token bytes by id of a piece vocabulary; U+2581 is a blank, <0xHH> a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        found[i] = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        if "▁" in piece.lstrip("▁"):
            raise ValueError(f"{path} joins blanks to words before them: {piece}")
    return model, found


class Flat:
    """Lists of ids, one per unit, one after the other."""

    def __init__(self):
        self.ids, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []

    def settle(self) -> None:
        """Takes over the lists of ``new``: their ids and their lengths."""
        if self.new:
            ids, sizes = (np.concatenate(each) for each in zip(*self.new, strict=True))
            self.ids = np.concatenate([self.ids, ids])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
            self.new = []

    def gathered(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after the other, and the number of tokens per unit."""
        sizes = self.at[units + 1] - self.at[units]
        ends = np.cumsum(sizes)
        places = np.repeat(self.at[units] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[places], sizes


def cut(text: str) -> list[str]:
    """The pieces of a text between single blanks that have other characters on both sides."""
    if not text:
        return []
    if text[0].isspace() or text[-1].isspace() or any(pair in text for pair in BESIDE):
        return CUT.split(text)
    return text.split(" ")


class Numbers(dict):
    """Numbers pieces as they are met."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        number = self[word] = len(self)
        return number


class Units:
    """Both encodings of the pieces of text met so far.  A piece stands for itself with a blank before it."""

    def __init__(self, a_path: str, b_path: str):
        self.encoder_a, self.bytes_a = byte_level(a_path)
        self.encoder_b, self.bytes_b = pieces(b_path)
        self.sizes = [np.array([len(table.get(i, b"")) for i in range(max(table) + 1)]) for table in (self.bytes_a, self.bytes_b)]
        largest = max(max(self.bytes_a), max(self.bytes_b)) + 1
        # "7,", "7|" and "7;" for each id.
        self.written = np.array([b"%d%c" % (i, mark) for i in range(largest) for mark in b",|;"], object)
        self.forget()

    def forget(self) -> None:
        self.known = Numbers()
        self.a, self.b = Flat(), Flat()
        self.same = np.zeros(0, bool)

    def of(self, words: list[str]) -> np.ndarray:
        """Numbers of the pieces."""
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        new, self.known.new = self.known.new, []
        same, run = [], []
        for word in [*new, None]:
            # Only the first and the last piece of a text can have a blank at an end.
            odd = word is None or word[:1].isspace() or word[-1:].isspace()
            if odd or len(run) == TOGETHER:
                same.append(self.add_joined(run))
                run = []
            if not odd:
                run.append(word)
            elif word is not None:
                same.append(self.add_one(word))
        self.a.settle()
        self.b.settle()
        self.same = np.concatenate([self.same, *same])
        return numbers

    def add_one(self, word: str) -> np.ndarray:
        in_a, in_b, text = self.encoder_a.encode_ordinary(" " + word), self.encoder_b.encode(word), (" " + word).encode()
        same = b"".join(map(self.bytes_a.__getitem__, in_a)) == text and b"".join(map(self.bytes_b.__getitem__, in_b)) == text
        self.a.new.append((np.array(in_a, np.int64), np.array([len(in_a)])))
        self.b.new.append((np.array(in_b, np.int64), np.array([len(in_b)])))
        return np.array([same])

    def add_joined(self, words: list[str]) -> np.ndarray:
        """Encodes the pieces as one text: no token reaches over the blank between two of them.  If its bytes differ
        somewhere, one by one."""
        if not words:
            return np.zeros(0, bool)
        text = " ".join(words)
        whole = (" " + text).encode()
        ends = np.cumsum([len(word.encode()) + 1 for word in words])
        found = []
        for ids, table, sizes in (
            (self.encoder_a.encode_ordinary(" " + text), self.bytes_a, self.sizes[0]),
            (self.encoder_b.encode(text), self.bytes_b, self.sizes[1]),
        ):
            if b"".join(map(table.__getitem__, ids)) != whole:
                return np.concatenate([self.add_one(word) for word in words])
            ids = np.array(ids, np.int64)
            at = np.searchsorted(np.cumsum(sizes[ids]), ends) + 1
            found.append((ids, np.diff(at, prepend=0)))
        self.a.new.append(found[0])
        self.b.new.append(found[1])
        return np.ones(len(words), bool)

    def is_full(self) -> bool:
        return len(self.known) > REMEMBERED or len(self.a.ids) > REMEMBERED_TOKENS


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a: np.ndarray, b: np.ndarray, a_stops: np.ndarray):
    """Links (places in A and in B) and cuts (ends of groups, exclusive) of many lanes at once.

    ``a``, ``b``: the first token of each lane in either sequence of ends; ``a_stops``: where a lane's A tokens end,
    at a common end.  One pair of pointers per lane moves on in each step; lanes that are done are taken out.
    """
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    open_lanes = a < a_stops
    a, b, a_stops = a[open_lanes], b[open_lanes], a_stops[open_lanes]
    while len(a):
        end_a, end_b = a_ends[a], b_ends[b]
        links_a.append(a)
        links_b.append(b)
        together = end_a == end_b
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        cuts_a.append(a[together])
        cuts_b.append(b[together])
        open_lanes = a < a_stops
        if not open_lanes.all():
            a, b, a_stops = a[open_lanes], b[open_lanes], a_stops[open_lanes]
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(each + none) for each in (links_a, links_b, cuts_a, cuts_b))


def bounds(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes))


def aligned(units: Units, texts: list[str]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Per text its counts and the digest of its groups; then the distinct links of all texts: text, pair, times."""
    words = [cut(text) for text in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    numbers = units.of([word for each in words for word in each])
    owner = np.repeat(np.arange(len(texts)), counts)
    # A text with one piece whose bytes differ has no tokens at all.
    whole = np.bincount(owner[~units.same[numbers]], minlength=len(texts)) == 0
    numbers, owner = numbers[whole[owner]], owner[whole[owner]]
    (a_ids, a_per_unit), (b_ids, b_per_unit) = units.a.gathered(numbers), units.b.gathered(numbers)
    a_ends, b_ends = np.cumsum(units.sizes[0][a_ids]), np.cumsum(units.sizes[1][b_ids])
    a_at, b_at = bounds(a_per_unit), bounds(b_per_unit)
    n_a, n_b = (np.bincount(owner, weights=x, minlength=len(texts)).astype(np.int64) for x in (a_per_unit, b_per_unit))
    a_doc, b_doc = bounds(n_a), bounds(n_b)

    lane = (a_at[:-1] - a_doc[owner]) // LANE
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (lane[1:] != lane[:-1]))[: len(owner)])
    stops = np.append(a_at[first[1:]], len(a_ids))[: len(first)]
    link_a, link_b, cut_a, cut_b = lockstep(a_ends, b_ends, a_at[first], b_at[first], stops)

    # The lanes cover both sequences, so sorted cuts are the ends of all groups.
    cut_a, cut_b = np.sort(cut_a), np.sort(cut_b)
    per_group = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    written = np.empty(len(a_ids) + len(b_ids), object)
    last_a, last_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    last_a[cut_a - 1], last_b[cut_b - 1] = 1, 2
    written[np.arange(len(a_ids)) + np.repeat(cut_b - per_group[1], per_group[0])] = units.written[3 * a_ids + last_a]
    written[np.arange(len(b_ids)) + np.repeat(cut_a, per_group[1])] = units.written[3 * b_ids + last_b]
    digests = [
        hashlib.sha256(b"".join(written[i:j].tolist())[:-1]).hexdigest() if j > i else ""
        for i, j in zip((a_doc + b_doc)[:-1].tolist(), (a_doc + b_doc)[1:].tolist(), strict=True)
    ]

    of_text = np.searchsorted(a_doc[1:], link_a, "right")
    n_groups = np.bincount(np.searchsorted(a_doc[1:], cut_a - 1, "right"), minlength=len(texts))
    n_links = np.bincount(of_text, minlength=len(texts))
    # Text and pair in one number: fewer than 2^24 texts a batch, 20 bits an id.
    keys, times = np.unique((of_text << 40) | (a_ids[link_a] << 20) | b_ids[link_b], return_counts=True)
    sums = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links}
    return sums, digests, keys >> 40, keys & ((1 << 40) - 1), times


def packed(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(columns).astype(np.uint32).tobytes())


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32).reshape(n, -1).astype(np.int64)


def readable(raw: bytes) -> str:
    """A text that isn't UTF-8 can't be given back byte by byte: empty, so it has no tokens."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return ""


FOUND = (
    "scope bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "links binary, place int, pair bigint, docs bigint"
)
RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
NAMES = [part.split()[0] for part in FOUND.split(", ")]


class Scope:
    """Documents that share one list of distinct pairs."""

    def __init__(self, number: int):
        self.number, self.rows, self.text, self.pair, self.times, self.bytes, self.n = number, [], [], [], [], 0, 0

    def add(self, units: Units, ids: list, texts: list[str]) -> None:
        sums, digests, text, pair, times = aligned(units, texts)
        self.rows += zip(ids, *(sums[c].tolist() for c in ("n_a", "n_b", "n_groups", "n_links")), digests, strict=True)
        self.text.append(text + self.n)
        self.pair.append(pair)
        self.times.append(times)
        self.n += len(texts)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """A row per document, then a row per distinct pair with the number of its documents."""
        text, pair, times = (np.concatenate(each) for each in (self.text, self.pair, self.times))
        distinct, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
        # Common pairs first: small numbers pack well.
        order = np.argsort(-docs, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = rank[place]
        at = np.searchsorted(text, np.arange(self.n + 1))
        links = [packed(place[i:j], times[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        n = len(links)
        ids, *rest = (list(column) for column in zip(*self.rows, strict=True))
        types = [pa.int64()] * 5 + [pa.string()]
        columns = [pa.array(column, kind) for column, kind in zip([ids, *rest], types, strict=True)]
        empty = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, self.number)), *columns, pa.array(links, pa.binary()), *empty], names=NAMES)
        m = len(order)
        if m:
            nothing = [pa.nulls(m, kind) for kind in [*types, pa.binary()]]
            found = [pa.array(np.arange(m, dtype=np.int32)), pa.array(distinct[order]), pa.array(docs[order].astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, self.number)), *nothing, *found], names=NAMES)


def walked(docs: DataFrame, a_path: str, b_path: str, scope_bytes: int = SCOPE) -> DataFrame:
    """The rows of all scopes (``FOUND``)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(a_path, b_path)
        scope = Scope(TaskContext.get().partitionId() << 32)
        ids, texts, held = [], [], 0

        def flush() -> None:
            nonlocal held
            if units.is_full():
                units.forget()
            scope.add(units, ids, texts)
            scope.bytes += held
            ids.clear()
            texts.clear()
            held = 0

        for batch in sliced(batches, 200):
            for doc_id, raw in zip(batch.column("doc_id").cast(pa.int64()).to_pylist(), raw_texts(batch.column("text")), strict=True):
                ids.append(doc_id)
                texts.append(readable(raw))
                held += len(raw)
                if held >= min(BATCH, scope_bytes):
                    flush()
                    if scope.bytes >= scope_bytes:
                        yield from scope.batches()
                        scope = Scope(scope.number + 1)
        if ids:
            flush()
        if scope.n:
            yield from scope.batches()

    return docs.select("doc_id", "text").mapInArrow(rows, FOUND)


def rated(entries: DataFrame) -> DataFrame:
    """pair, count (documents that hold it), best (whether no pair with its A id has more).  The highest counts have a
    row per id of vocabulary A: that bounds the broadcast."""
    counts = materialise(entries.groupBy("pair").agg(F.sum("docs").alias("count")))
    a = F.shiftright("pair", 20)
    highest = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    return counts.withColumn("a", a).join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, scope_bytes: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``docs`` needs doc_id and text; other columns are ignored.  A is a byte-level vocabulary in JSON, applied to the text
    with a blank before it, B a piece vocabulary, which adds that blank; both files are at paths that every executor
    can read.  A null or empty text, and one whose bytes an encoding doesn't give back, has no tokens: zeros and an empty
    digest.  Special tokens inside a text are plain text.  Rows that repeat an id, also whole rows, count as documents
    of their own.  A text may be of any length; one without blanks is walked alone.  An empty table gives an empty result.
    """
    found = materialise(walked(docs, a_path, b_path, scope_bytes))
    entries = found.filter("place is not null").select("scope", "place", "pair", "docs")
    looked_up = entries.select("scope", "place", "pair").join(rated(entries), "pair").select("scope", "place", "count", "best")
    rows = found.filter("place is null").select(F.col("scope").alias("scope"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        n = right.num_rows
        count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if n:
            place = np.asarray(right["place"])
            count[place], best[place] = np.asarray(right["count"]), np.asarray(right["best"])
        n_best, count_sum = [], []
        for data in left["links"].to_pylist():
            place, times = unpacked(data, 2)
            n_best.append(int(times @ best[place]))
            count_sum.append(int(times @ count[place]))
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        sums = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())]
        return pa.table([*(left[c] for c in names), *sums, left["groups_sha256"]], names=[*names, "n_best", "count_sum", "groups_sha256"])

    return rows.groupBy("scope").cogroup(looked_up.groupBy("scope")).applyInArrow(scored, RESULT)
