"""Packing: best-fit decreasing over the splits of the input, without a shuffle."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import per_process, query, table, whole_text

WINDOW = 2048
#: A bin is packed when it holds this many ids, which bounds the memory of a task.
BIN_IDS = 1 << 24
CACHED_CHUNKS = 600_000
OUTPUT_IDS = 1 << 20

#: Texts with these go to the tokenizer whole: special tokens, and separators that str.split() drops.
WHOLE = re.compile(r"<\||[\x1c-\x1f]")
#: A comma or full stop after anything but white space, a digit or a letter that stays one letter when
#: normalized: it may belong to a run of marks, so the text's chunks are left as they are.
RUN = re.compile("[^a-z0-9\\s\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f][.,]\\s")
JOINED_CHUNKS = 2_000


class Places(dict):
    """The number of each chunk; a new one gets the next number."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = place = len(self)
        return place


class ChunkTokenizer:
    """Ids of a text by way of its white-space separated chunks, which are encoded once and kept.

    Exact for tokenizers whose pre-tokens never span white space, part letters from marks and drop
    white space, and that lower-case. A comma or full stop that ends a word is a chunk of its own.
    Ids must be below 65,536.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.places = Places()
        self.starts = self.lengths = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint16)

    def _learn(self, chunks: list[str]) -> None:
        """Encodes new chunks, many to a call; offsets tell which chunk an id belongs to."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1
        lengths, pools = [], [self.pool]
        for at in range(0, len(chunks), JOINED_CHUNKS):
            encoded = self.tokenizer.encode(" ".join(chunks[at : at + JOINED_CHUNKS]), add_special_tokens=False)
            ends = np.cumsum(sizes[at : at + JOINED_CHUNKS])
            starts = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(encoded))
            owners = np.searchsorted(ends, starts, side="right")
            lengths.append(np.bincount(owners, minlength=len(ends)))
            pools.append(np.array(encoded.ids, np.uint16))
        added = np.concatenate(lengths).astype(np.int32)
        starts = (len(self.pool) + np.cumsum(added) - added).astype(np.int32)
        self.starts, self.lengths = np.append(self.starts, starts), np.append(self.lengths, added)
        self.pool = np.concatenate(pools)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.places) > CACHED_CHUNKS:
            self._forget()
        known, number = len(self.places), self.places.__getitem__
        whole, found = {}, []
        for at, text in enumerate(texts):
            if WHOLE.search(text):
                whole[at], text = text, ""
            lowered = text.encode().lower().decode()
            if not RUN.search(lowered):
                lowered = lowered.replace(", ", " , ").replace(". ", " . ").replace(".\n", " . ")
            chunks = lowered.split()
            found.append(np.fromiter(map(number, chunks), np.int32, len(chunks)))
        if len(self.places) > known:
            self._learn(list(islice(self.places, known, None)))
        places = np.concatenate(found)
        lengths = self.lengths[places]
        ends = np.cumsum(lengths, dtype=np.int64)
        at = np.repeat((self.starts[places] - ends + lengths).astype(np.int32), lengths)
        at += np.arange(len(at), dtype=np.int32)
        cuts = np.append(0, ends)[np.cumsum([len(f) for f in found])]
        results = np.split(self.pool[at], cuts[:-1])
        for at, text in whole.items():
            encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
            results[at] = np.array(encoded.ids, np.uint16)
        return results


class OpenWindows:
    """Open windows by remaining room, with a segment tree that finds the tightest fit.

    Leaf r holds the windows with r free places; an inner node says whether any leaf below has one.
    """

    def __init__(self, window: int):
        self.width = 1 << window.bit_length()
        self.filled = bytearray(2 * self.width)
        self.leaves: list[list[int]] = [[] for _ in range(self.width)]

    def add(self, room: int, name: int) -> None:
        self.leaves[room].append(name)
        node = room + self.width
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, name) of a window with the least room of at least `need`; it is removed."""
        node = need + self.width
        if not self.filled[node]:
            while node > 1 and (node & 1 or not self.filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.filled[2 * node] else 2 * node + 1
        room = node - self.width
        name = self.leaves[room].pop()
        if not self.leaves[room]:
            self.filled[node] = 0
            while node > 1 and not (self.filled[node] or self.filled[node ^ 1]):
                node >>= 1
                self.filled[node] = 0
        return room, name


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset) of each piece: longest first into the tightest open window.

    Pieces of equal length go in their given order, so equal input gives equal windows.
    """
    names, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    windows, count = OpenWindows(window), 0
    for at in np.argsort(-lengths, kind="stable"):
        need = int(lengths[at])
        found = windows.take(need)
        if found is None:
            found, count = (window, count), count + 1
        room, names[at] = found
        offsets[at] = window - room
        if room > need:
            windows.add(room - need, int(names[at]))
    return names, offsets


SCHEMA = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Bin:
    """Pieces of documents gathered until they are packed together."""

    def __init__(self, window: int, first: int):
        self.window, self.first = window, first
        self.ids, self.docs, self.starts, self.lengths, self.totals, self.held = [], [], [], [], [], 0

    def add(self, doc: object, ids: np.ndarray) -> None:
        for start in range(0, len(ids), self.window):
            piece = ids[start : start + self.window]
            self.docs.append(doc), self.ids.append(piece), self.totals.append(len(ids))
            self.starts.append(start), self.lengths.append(len(piece))
        self.held += len(ids)

    def packed(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        lengths = np.array(self.lengths, np.int64)
        names, offsets = best_fit(lengths, self.window)
        order = np.lexsort((offsets, names))
        cuts = np.searchsorted(np.cumsum(lengths[order]), np.arange(OUTPUT_IDS, self.held, OUTPUT_IDS))
        for rows in np.split(order, cuts):
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([self.docs[i] for i in rows], schema.field(0).type),
                        pa.array([self.starts[i] for i in rows], pa.int64()),
                        pa.array(lengths[rows]),
                        pa.array([self.ids[i].astype("<u4").tobytes() for i in rows], pa.binary()),
                        pa.array([self.totals[i] for i in rows], pa.int64()),
                        pa.array(names[rows] + self.first),
                        pa.array(offsets[rows]),
                    ],
                    schema=schema,
                )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    window: int = WINDOW,
    doc: str = "doc_id",
    text: str = "text",
    bin_ids: int = BIN_IDS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    A document is the ids of its text and `end_id`; `ids` holds a piece's ids as little-endian
    unsigned 32-bit numbers. Documents longer than a window are cut into full windows first, then
    all pieces are placed best-fit decreasing. Each input partition is packed on its own, in bins of
    about `bin_ids` ids, so nothing is shuffled, a hot source changes nothing, and what stays unfilled
    is the last windows of a bin. A lost task repeats with the same result.

    Null text counts as empty: such a document is its end id alone. A null or repeated doc_id is
    allowed; every row is packed once. An empty table gives no rows. `tokenizer` is a path that every
    executor can read; the tokenizer must drop white space (see ChunkTokenizer). Other columns are
    left out.
    """
    kind = docs.schema[doc].dataType.simpleString()
    chosen = docs.select(F.col(doc).alias("doc_id"), whole_text(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process("chunks", tokenizer, lambda: ChunkTokenizer(tokenizer))
        schema = None
        following = TaskContext.get().partitionId() << 32
        held = Bin(window, following)
        end = np.array([end_id], np.uint16)
        for batch in batches:
            schema = schema or pa.schema(
                [batch.schema.field(0).with_name("doc_id")]
                + [pa.field(n, pa.binary() if n == "ids" else pa.int64()) for n in PIECE_COLUMNS]
            )
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                encoded = encoder.ids(part.column(1).to_pylist())
                for name, ids in zip(part.column(0).to_pylist(), encoded):
                    held.add(name, np.concatenate([ids, end]))
                if held.held >= bin_ids:
                    following += len(held.docs)
                    yield from held.packed(schema)
                    held = Bin(window, following)
        if held.docs:
            yield from held.packed(schema)

    return chosen.mapInArrow(run, SCHEMA.format(id=kind))


PIECE_COLUMNS = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into windows of 2048 ids, with the checksum of each piece."""
    import public_tokenizers

    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
