"""Packing tokenised documents into sequences, shortest pack first.

1. Documents become token ids plus an end id, cut into full pieces of
   ``max_tokens`` and a rest (:func:`tokenize_pieces`).
2. The histogram of piece lengths (at most ``max_tokens`` numbers) is packed on
   the driver: lengths are placed longest first, each into the shortest pack
   with room, as counts of equal packing patterns (:func:`pack_histogram`).
3. Patterns are joined back to pieces by their rank within their length
   (:func:`assign_sequences`).

Defined cases: null or empty text is one piece of the end id alone; an empty
table gives an empty result; rows equal in doc_id and text each get their own
pieces; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.llm.common import gapless_rank, lean, salts_for, written

MAX_TOKENS = 4096
END_ID = 2
CACHE_WORDS = 500_000  # cached words per Python worker, about 100 MB
OUT_BYTES = 4 << 20

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1
    bytes stand for themselves, the others are numbered from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {b: 256 + i for i, b in enumerate(others)}


# Lower-case Latin-1 letters: one pre-token, the same after normalisation.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch


class _WordIds(dict):
    """Token ids (little-endian 32-bit) of a run of text without blanks.

    The tokenizer's own rules never join text across a blank or a line end, a
    word with a plain full stop or comma behind a letter splits before it, and
    lower-casing ASCII is its first step; so ids of texts are those of their
    runs, and the cache only has to know words.  This holds for a tokenizer of
    this kind (NFC, lower-casing, splitting at blanks, byte-level BPE).
    """

    def __init__(self, tokenizer):
        super().__init__({"": b""})
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters = _byte_letters()
        self.tails = {c: self._encoded(c) for c in ".,"}

    def _encoded(self, text: str) -> bytes:
        # Plain words by the model alone: four times as fast as the whole tokenizer.
        if text.isascii() and text.isalpha() and text.islower():
            ids = [t.id for t in self.model.tokenize(text)]
        elif _PLAIN(text):
            letters = text.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(letters)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, run: str) -> bytes:
        word, tail = run, b""
        if run[-1] in ".," and run[-2:-1].isalpha() and run[-2] != "\u0130":
            word, tail = run[:-1], self.tails[run[-1]]
        if word.isascii() and "<|" not in word:
            word = word.lower()
        ids = self.get(word)
        if ids is None:
            ids = self._encoded(word)
            if len(self) < CACHE_WORDS:
                self[word] = ids
        if word != run:
            ids += tail
            if len(self) < CACHE_WORDS:
                self[run] = ids
        return ids


# A full stop or comma behind anything but a letter, a number or a blank; the
# capital dotted I ends in a combining mark when lowered.
_ODD_STOP = re.compile("(?:[^\\w ]|[_\u0130])[.,]").search


def _runs(text: str) -> list[str]:
    """Runs of ``text`` whose ids, one after the other, are the text's.  Where
    that is safe, capitals are lowered (not those of special tokens) and
    stops behind words are runs of their own, so there are fewer to know."""
    if "<|" not in text:
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
    text = text.replace("\n", " ")
    if _ODD_STOP(text) is None:
        text = text.replace(". ", " . ").replace(", ", " , ")
    return text.split(" ")


_CACHES: dict[str, _WordIds] = {}  # by tokenizer file; kept while the worker lives


def _word_ids(path: str) -> _WordIds:
    if path not in _CACHES:
        from tokenizers import Tokenizer

        _CACHES[path] = _WordIds(Tokenizer.from_file(path))
    return _CACHES[path]


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
                    end_id: int = END_ID) -> DataFrame:
    """A row per piece: ``doc_id``, ``start`` (the document's ids before it),
    ``length``, ``ids`` (binary, little-endian unsigned 32-bit) and
    ``doc_tokens``.  ``tokenizer_path`` is a `tokenizers` JSON file that every
    executor has at that place."""
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids", pa.binary()), ("doc_tokens", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_ids(tokenizer_path)
        rows, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = b"".join(map(ids_of.__getitem__, _runs(text.as_py() or ""))) + end
                doc, total = doc_id.as_py(), len(ids) // 4
                for at in range(0, total, max_tokens):
                    piece = ids[4 * at:4 * (at + max_tokens)]
                    rows.append((doc, at, len(piece) // 4, piece, total))
                held += len(ids)
                if held >= OUT_BYTES:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lean(work), PIECES)


def pack_histogram(histogram: dict[int, int], max_tokens: int = MAX_TOKENS
                   ) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Packing patterns ``(((length, how often), ...), packs)`` for a histogram
    ``{length: pieces}``.

    Lengths go longest first; a piece enters the shortest pack with room and
    opens a pack only if none has.  Packs of one pattern are moved together,
    so the work depends on the lengths, not on the pieces: each length splits
    at most one pattern and opens at most two, so the patterns stay within
    three times ``max_tokens``.
    """
    open_packs: dict[int, list[tuple[tuple, int]]] = defaultdict(list)  # by room
    room_left: list[int] = [0] * (max_tokens + 1)  # patterns by room
    top = 0  # no pattern has more room

    def put(room: int, pattern: tuple, packs: int) -> None:
        nonlocal top
        open_packs[room].append((pattern, packs))
        room_left[room] += 1
        top = max(top, room)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while top and not room_left[top]:
                top -= 1
            if top >= length and room_left[top]:
                pattern, packs = open_packs[top].pop()
                room_left[top] -= 1
                used = min(packs, left)
                if packs > used:
                    put(top, pattern, packs - used)
                grown = (*pattern[:-1], (length, pattern[-1][1] + 1)) if (
                    pattern[-1][0] == length) else (*pattern, (length, 1))
                put(top - length, grown, used)
                left -= used
            else:
                each = max_tokens // length
                full, rest = divmod(left, each)
                if full:
                    put(max_tokens - each * length, ((length, each),), full)
                if rest:
                    put(max_tokens - rest * length, ((length, rest),), 1)
                left = 0
    return [x for room in sorted(open_packs) for x in open_packs[room]]


def pattern_slots(patterns: list) -> dict[str, np.ndarray]:
    """Patterns as slots sorted by (length, first rank): pieces of ``length``
    with ranks from ``rank`` on go, ``times`` to a sequence, to ``sequence``
    and those behind it, from ``offset`` on."""
    slots, next_rank, sequence = [], defaultdict(int), 0
    for pattern, packs in patterns:
        offset = 0
        for length, times in pattern:
            slots.append((length, next_rank[length], times, sequence, offset))
            next_rank[length] += times * packs
            offset += length * times
        sequence += packs
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "times", "sequence", "offset"), table.T))


def assign_sequences(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``doc_id, start, length, doc_tokens`` and any further columns of
    ``pieces`` (a written table) plus ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").count().collect()  # at most max_tokens rows
    slots = pattern_slots(pack_histogram({r["length"]: r["count"] for r in counts}, max_tokens))
    # At most 3 * max_tokens patterns of fewer than 2 * sqrt(max_tokens) lengths.
    model = spark.sparkContext.broadcast(slots)
    order = ["doc_id", "start", *[c for c in pieces.columns
                                  if c not in ("doc_id", "start", "length")]]
    ranked = gapless_rank(pieces, ["length"], order, "__rank",
                          salts_for(sum(r["count"] for r in counts)))
    schema = T.StructType([
        *[f for f in ranked.schema.fields if f.name != "__rank"],
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = model.value
        wide = np.int64(1) << 40
        key = s["length"] * wide + s["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy()
            slot = np.searchsorted(key, length * wide + rank, "right") - 1
            nth, inside = np.divmod(rank - s["rank"][slot], s["times"][slot])
            rest = batch.drop_columns(["__rank"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(s["sequence"][slot] + nth),
                 pa.array(s["offset"][slot] + inside * length)],
                names=[*rest.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(lean(work), schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
                   end_id: int = END_ID, digest: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset.  With
    ``digest`` the column ``ids`` gives way to ``ids_crc32``."""
    pieces = tokenize_pieces(docs, tokenizer_path, max_tokens, end_id)
    if digest:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return assign_sequences(written(pieces), max_tokens)


def padding(patterns: list, max_tokens: int = MAX_TOKENS) -> int:
    """Padded ids of a packing; sequences as long as a power of two stay so."""
    used = ((sum(a * b for a, b in p), n) for p, n in patterns)
    return sum(n * (max_tokens - u) for u, n in used if u & (u - 1))


__all__ = ["MAX_TOKENS", "END_ID", "tokenize_pieces", "pack_histogram", "pattern_slots",
           "assign_sequences", "pack_documents", "padding"]
