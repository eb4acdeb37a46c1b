"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 23 bits. Two fingerprints that differ in
at most four bits differ in at most two bits of some two segments together, for the three pairs of
segments hold every bit twice. A 23-bit word is given the codewords of the binary Golay code within
distance four, one or six of them: two words at most two bits apart always share one. So fingerprints
within four bits share a key made of two segments' codewords, and only those that share one are compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import by_batch, extra_name, query, table, whole_text
from caselog.session import cut_lineage

WORDS, DISTANCE, SEED = 4, 4, 42
#: (lowest bit, bits) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Text is hashed in blocks of about this many bytes, and so many bits of hashes are counted at once.
BLOCK_BYTES, BLOCK_HASHES = 1 << 20, 1 << 15
#: A longer run of fingerprints with one key is dealt out in blocks of this size.
BLOCK = 1 << 14
SPACE = b" \t\n\r\x0b\x0c"


def text_blocks(data: bytes, words: int) -> Iterator[list[bytes]]:
    """The words of a text, in blocks that overlap by `words` - 1 words."""
    at, held = 0, []
    while at < len(data):
        end = at + BLOCK_BYTES
        while end < len(data) and data[end] not in SPACE:
            end += 1
        held += data[at:end].split()
        at = end
        if at < len(data) and len(held) >= words:
            yield held
            held = held[len(held) - words + 1 :] if words > 1 else []
    yield held


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of the text's word shingles; zero without a word.

    A-Z is lower-cased and words are parted by ASCII white space. A bit is set if it is set in over
    half the shingles' XXH64. A text of fewer words than a shingle is one shingle.
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, count = np.zeros(64, np.int64), 0
    for block in text_blocks(text.encode("utf-8", "surrogatepass").lower(), words):
        if not block or (len(block) < words and count):
            continue
        ends = np.cumsum(np.fromiter(map(len, block), np.int64, len(block)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        last = max(1, len(block) - words + 1)
        joined = b" ".join(block)
        spans = zip(starts[:last].tolist(), ends[min(words, len(block)) - 1 :].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
        count += last
        for at in range(0, last, BLOCK_HASHES):
            bits = np.unpackbits(hashes[at : at + BLOCK_HASHES].view(np.uint8), bitorder="little")
            ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0]) if count else 0


def with_fingerprints(docs: DataFrame, doc: str, text: str, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id and `bits`, the fingerprint as a signed long."""
    kind = docs.schema[doc].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t.as_py(), words, seed) for t in batch.column(1)]
        bits = pa.array(np.array(found, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), bits], names=["doc_id", "bits"])

    chosen = docs.select(F.col(doc).alias("doc_id"), whole_text(text).alias("text"))
    return by_batch(chosen, run, f"doc_id {kind}, bits long")


class Golay:
    """Codewords of the binary Golay code of length 23 within distance four of a word."""

    #: Fixed value: the code's generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
    GENERATOR = 0b101011100011

    def __init__(self) -> None:
        self.rest = np.array([self._remainder(x << 11) for x in range(1 << 12)], np.uint32)
        patterns = [
            sum(1 << b for b in bits) for weight in range(5) for bits in combinations(range(23), weight)
        ]
        by_syndrome: list[list[int]] = [[] for _ in range(1 << 11)]
        for pattern in patterns:
            by_syndrome[self._remainder(pattern)].append(pattern)
        self.counts = np.array([len(x) for x in by_syndrome])
        self.errors = np.zeros((1 << 11, self.counts.max()), np.uint32)
        for at, found in enumerate(by_syndrome):
            self.errors[at, : len(found)] = found

    @classmethod
    def _remainder(cls, word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= cls.GENERATOR << (bit - 11)
        return word

    def indices(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(12-bit codeword numbers, how many of them count) for each word."""
        syndromes = self.rest[words >> 11] ^ (words & 0x7FF)
        return (words[:, None] ^ self.errors[syndromes]) >> 11, self.counts[syndromes]


def keys_of(bits: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(keys, position of the fingerprint) of all keys of all fingerprints."""
    parts = [
        code.indices((bits >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.uint32))
        for low, width in SEGMENTS
    ]
    keys, owners = [], []
    for number, ((first, n), (second, m)) in enumerate(combinations(parts, 2)):
        for i in range(first.shape[1]):
            for j in range(second.shape[1]):
                has = np.flatnonzero((n > i) & (m > j))
                pair = first[has, i].astype(np.int64) << 12 | second[has, j]
                keys.append(pair | number << 24)
                owners.append(has)
    return np.concatenate(keys), np.concatenate(owners)


def forest(bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked: a walk that compares each member with those not reached yet."""
    left, sources, targets = np.arange(1, len(bits)), [], []
    queue, done = [0], 0
    while len(left):
        if done == len(queue):
            queue.append(int(left[0]))
            left = left[1:]
        here = queue[done]
        done += 1
        near = np.bitwise_count(bits[left] ^ bits[here]) <= distance
        if near.any():
            found = left[near]
            sources.append(np.full(len(found), here))
            targets.append(found)
            queue += found.tolist()
            left = left[~near]
    empty = np.zeros(0, np.int64)
    return np.concatenate(sources or [empty]), np.concatenate(targets or [empty])


def run_links(
    keys: np.ndarray, bits: np.ndarray, distance: int, short: int = 24
) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal keys; short runs by shifted comparison, long ones by `forest`."""
    bounds = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(bounds, len(keys)))
    left, right = [], []
    few = np.repeat(sizes <= short, sizes)
    for shift in range(1, short):
        at = np.flatnonzero((keys[shift:] == keys[:-shift]) & few[shift:])
        if not len(at):
            break
        at = at[np.bitwise_count(bits[at] ^ bits[at + shift]) <= distance]
        left.append(bits[at]), right.append(bits[at + shift])
    for start, size in zip(bounds[sizes > short], sizes[sizes > short]):
        own = bits[start : start + size]
        a, b = forest(own, distance)
        left.append(own[a]), right.append(own[b])
    empty = np.zeros(0, np.uint64)
    return np.concatenate(left or [empty]), np.concatenate(right or [empty])


LINKS = "a long, b long, key long, block long"


def _link_batch(a: np.ndarray, b: np.ndarray, key: np.ndarray | None, block: np.ndarray | None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    columns = [a.view(np.int64), b.view(np.int64)]
    rest = [none if x is None else pa.array(x) for x in (key, block)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns] + rest, names=["a", "b", "key", "block"])


def link_sorted(batches: Iterable[pa.RecordBatch], distance: int, block: int) -> Iterator[pa.RecordBatch]:
    """Links of fingerprints that come sorted by key.

    A run longer than a block is linked block by block; its rows also come out with their block
    number, for the pairs of blocks to be compared by other tasks.
    """
    keys, bits, number = np.zeros(0, np.int64), np.zeros(0, np.uint64), 0

    def whole(keys: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        a, b = run_links(keys, bits, distance)
        low, high = np.minimum(a, b), np.maximum(a, b)
        pairs = np.unique(np.stack([low, high]), axis=1) if len(low) else np.zeros((2, 0), np.uint64)
        return _link_batch(pairs[0].copy(), pairs[1].copy(), None, None)

    def spilled(keys: np.ndarray, bits: np.ndarray, number: int) -> pa.RecordBatch:
        return _link_batch(bits, bits, keys, np.full(len(keys), number, np.int64))

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.append(keys, batch.column(0).to_numpy())
        bits = np.append(bits, batch.column(1).to_numpy().view(np.uint64))
        last = int(np.searchsorted(keys, keys[-1]))
        if last and number:
            end = int(np.searchsorted(keys, keys[0], side="right"))
            yield spilled(keys[:end], bits[:end], number)
            yield whole(keys[:end], bits[:end])
            keys, bits, last, number = keys[end:], bits[end:], last - end, 0
        if last:
            yield whole(keys[:last], bits[:last])
            keys, bits = keys[last:], bits[last:]
        while len(keys) > block:
            yield spilled(keys[:block], bits[:block], number)
            yield whole(keys[:block], bits[:block])
            keys, bits, number = keys[block:], bits[block:], number + 1
    if len(keys):
        if number:
            yield spilled(keys, bits, number)
        yield whole(keys, bits)


def links(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """a < b: links among the distinct fingerprints of column `bits`, enough to join what is joined.

    Every pair within `distance` bits (four at most) is in one component of the result, and every row
    of the result is such a pair. Rows with a key are spread by key; a run of one key above `block`
    is dealt out as pairs of blocks, so no task holds more than two blocks at once.
    """
    if distance > DISTANCE:
        raise ValueError(f"the keys find up to {DISTANCE} differing bits")

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            for at in range(0, batch.num_rows, 5_000):
                bits = batch.column(0).slice(at, 5_000).to_numpy(zero_copy_only=False)
                keys, owners = keys_of(bits.view(np.uint64), code)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(bits[owners])], names=["key", "bits"])

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return link_sorted(batches, distance, block)

    # A fingerprint becomes some eighty rows, so these few bytes each are spread over all tasks first.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = prints.select("bits").distinct().repartition(parts, "bits")
    rows = nodes.mapInArrow(keyed, "key long, bits long")
    found = cut_lineage(rows.repartition("key").sortWithinPartitions("key").mapInArrow(linked, LINKS))
    pairs = found.where(F.col("key").isNull()).select("a", "b").distinct()
    long = found.where(F.col("key").isNotNull()).select("key", "block", F.col("a").alias("bits"))
    if long.isEmpty():
        return pairs
    last = long.groupBy("key").agg(F.max("block").alias("last"))
    sides = long.join(last, "key").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    sides = sides.where(F.col("other") != F.col("block")).select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "bits"
    )

    def across(group: pa.Table) -> pa.Table:
        bits = group.column("bits").to_numpy().view(np.uint64)
        a, b = forest(bits, distance)
        a, b = np.minimum(bits[a], bits[b]), np.maximum(bits[a], bits[b])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    more = sides.groupBy("key", "low", "high").applyInArrow(across, "a long, b long")
    return pairs.unionByName(more).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge, and none leads to a node with an edge of its own."""
    below = edges.select("node", F.lit(1).alias("down"), F.lit(0).alias("up"))
    above = edges.select(F.col("to").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    sums = below.unionByName(above).groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return sums.where((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).isEmpty()


def components(pairs: DataFrame) -> DataFrame:
    """node, root: the smallest node each node of the links reaches.

    Rounds of hooking each node and its neighbours to the smallest of them; the number of rounds
    grows with the logarithm of the longest chain. Each round is written before the next.
    """
    edges = cut_lineage(pairs.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("to").alias("node"), F.col("node").alias("to")))
        least = both.groupBy("node").agg(F.min("to").alias("least"))
        hooked = both.join(least, "node").select("node", "to", F.least("node", "least").alias("root"))
        large = hooked.where("to > node").select(F.col("to").alias("node"), F.col("root").alias("to")).distinct()
        least = large.groupBy("node").agg(F.min("to").alias("root"))
        small = large.join(least, "node").select(
            F.when(F.col("to") == F.col("root"), F.col("node")).otherwise(F.col("to")).alias("node"),
            F.col("root").alias("to"),
        )
        following = cut_lineage(small.distinct())
        if _all_stars(following):
            return following.select("node", F.col("to").alias("root"))
        edges = following


def near_duplicates(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    distance: int = DISTANCE,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable by links.

    Fingerprints link at `distance` or fewer differing bits; equal ones are one node, so copies cost
    one row each. Null text counts as empty; texts without a word have fingerprint zero, linked like
    any other. A null doc_id keeps its row but is never a component's id unless all its members are
    null. Repeated rows stay repeated. An empty table gives no rows. Other columns are left out.
    """
    prints = cut_lineage(with_fingerprints(docs, doc, text, words, seed))
    nodes = prints.groupBy("bits").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes, distance, block))
    placed = nodes.join(roots, nodes["bits"] == roots["node"], "left")
    placed = placed.select("bits", "least", F.coalesce("root", "bits").alias("root"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(ids, "root").select("bits", "component_id")
    return prints.join(named, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row left of each near-duplicate group: that of the smallest doc_id.

    Rows are told apart by doc_id and text. Of a group the smallest doc_id stays, a null one only where
    there is no other; of several texts with this doc_id that of the smallest hash, and of rows that
    repeat both one. So a doc_id that stands for several groups keeps a row of each.
    """
    row, missing, name, digest = (extra_name(docs, n) for n in ("_row", "_missing", "_name", "_hash"))
    own = docs.withColumns(
        {
            missing: F.col(doc).isNull(),
            name: F.coalesce(F.col(doc).cast("string"), F.lit("")),
            digest: F.xxhash64(whole_text(text)),
        }
    )
    named = F.struct(F.col(missing).alias("missing"), F.col(doc).alias("id"), F.col(digest).alias("hash"))
    groups = near_duplicates(own.withColumn(row, named), row, text)
    best = groups.where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id.missing").alias(missing),
        F.coalesce(F.col("doc_id.id").cast("string"), F.lit("")).alias(name),
        F.col("doc_id.hash").alias(digest),
    )
    # Repeated rows are folded before the shuffle; the join has the same keys, so texts move once.
    key = [missing, name, digest]
    return own.dropDuplicates(key).join(best.distinct(), key, "left_semi").select(*docs.columns)


@query("op10_simhash")
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint and near-duplicate group of every document."""
    return near_duplicates(table(spark, folder, "documents"))
