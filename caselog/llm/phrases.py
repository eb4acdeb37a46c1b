"""Phrase mining: padded lead windows counted once, shorter phrases by rolling their counts up.

Every word leads one window: itself and the words after it in its piece, padded to the longest phrase
length. Only these windows are counted; a phrase is as frequent as all windows that begin with it.
Before the ROLLUP, windows that are too rare to be a candidate become one word shorter, level by
level, which changes no prefix sum and leaves little to roll up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselog.llm.common import query, table, whole_text
from caselog.operators.skew import lookup
from caselog.session import cut_lineage

LONGEST, LEAST, SHARE, TOP, MILLION = 3, 10, 50, 2000, 1_000_000
UNKNOWN = "und"
#: Windows are counted in chunks of so many bytes of text, and summed in buckets of so many.
CHUNK_BYTES, BUCKET_BYTES = 2 << 20, 4 << 20
#: Blocks of so many bytes on average are packed before the shuffle, which then packs them no further.
PACK_BYTES = 1024
#: Candidates of one language are first ranked in so many groups.
RANK_GROUPS = 64
#: Marks in the token stream; no UTF-8 text holds these bytes.
BREAK, LANGUAGE = b"\xff", b"\xfe"
BLOCK = "bucket long, lang string, counted boolean, packed boolean, head binary, last binary, n binary, sure binary"
CONTENTS, COUNTED = ("head", "last", "n", "sure"), 2
ROWS = "lang string, words array<string>, n long"


def _byte_table() -> bytes:
    """A-Z in lower case; the characters between pieces become breaks."""
    to = bytearray(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        to[upper] += 32
    for mark in b".,;:!?\n\x0b\x0c\r":
        to[mark] = BREAK[0]
    return bytes(to)


BYTES = _byte_table()


def streams(texts: Iterable[tuple[str, bytes]], longest: int, size: int) -> Iterator[tuple[bytes, list[str], bool]]:
    """(tokens apart by blanks, languages, whether the last document goes on) in chunks of about `size` bytes.

    A document starts with a mark of its language. One longer than a chunk is cut between words, and
    its next part repeats the words whose windows reach over the cut.
    """
    held, room, langs = [], size, {}
    for lang, text in texts:
        held.append(b"%s%d" % (LANGUAGE, langs.setdefault(lang, len(langs))))
        text, low = text.translate(BYTES).replace(b"\t", b" "), 0
        while len(text) - low > size:
            cut = max(text.rfind(b" ", low, low + size), text.rfind(BREAK, low, low + size))
            if cut <= low:
                ends = [at for at in (text.find(b" ", low + size), text.find(BREAK, low + size)) if at >= 0]
                if not ends:
                    break
                cut = min(ends)
            held.append(text[low:cut].replace(BREAK, b" %s " % BREAK))
            tokens = b" ".join(held).strip()
            yield tokens, list(langs), True
            again = tokens[tokens.rindex(LANGUAGE) :].rsplit(maxsplit=longest - 1)[1:] if longest > 1 else []
            held, room, langs, low = [b"%s0" % LANGUAGE, *again[-(longest - 1) :]], size, {lang: 0}, cut
        held += [text[low:].replace(BREAK, b" %s " % BREAK), BREAK]
        room -= len(text) - low
        if room <= 0:
            yield b" ".join(held), list(langs), False
            held, room, langs = [], size, {}
    if held:
        yield b" ".join(held), list(langs), False


def _split(joined: bytes, by: str | None) -> pa.Array:
    """The parts of one text: at runs of blanks, or at every `by`."""
    ends = pa.py_buffer(np.array([0, len(joined)], np.int64))
    if by is None:
        whole = pa.Array.from_buffers(pa.large_string(), 1, [None, ends, pa.py_buffer(joined)])
        return pc.ascii_split_whitespace(whole).flatten().cast(pa.large_binary()).cast(pa.binary())
    whole = pa.Array.from_buffers(pa.large_binary(), 1, [None, ends, pa.py_buffer(joined)])
    return pc.split_pattern(whole, by).flatten().cast(pa.binary())


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts of equal rows in that order); the first key varies slowest."""
    spans = [int(k.max()) + 1 if len(k) else 1 for k in keys]
    if reduce(lambda a, b: a * b, spans, 1) < 1 << 63:
        one = reduce(lambda a, b: a * b[1] + b[0], zip(keys[1:], spans[1:]), keys[0].astype(np.int64))
        order = np.argsort(one)
        one = one[order]
        changed = one[1:] != one[:-1]
    else:
        order = np.lexsort(keys[::-1])
        changed = np.zeros(max(len(order) - 1, 0), bool)
        for key in keys:
            key = key[order]
            changed |= key[1:] != key[:-1]
    return order, np.concatenate([[0], np.flatnonzero(changed) + 1]) if len(order) else order


def count_windows(tokens: bytes, longest: int, goes_on: bool) -> tuple[pa.Array, np.ndarray, list[np.ndarray], np.ndarray]:
    """(words, language, word numbers per place, count) of the distinct windows; null words have number -1."""
    found = _split(tokens, None).dictionary_encode()
    words, code = found.dictionary, found.indices.to_numpy()
    del found
    marks = pc.starts_with(words, LANGUAGE).to_numpy(zero_copy_only=False)
    is_word = ~(marks | pc.equal(words, BREAK).to_numpy(zero_copy_only=False))
    known = np.full(len(words), 0, np.int64)
    for at in np.flatnonzero(marks):
        known[at] = int(words[at].as_py()[1:])
    at_mark = np.maximum.accumulate(np.where(marks[code], np.arange(len(code), dtype=np.int32), 0))
    lead = np.flatnonzero(is_word[code]).astype(np.int32)
    if goes_on:
        lead = lead[(lead < len(code) - (longest - 1)) | (lead < at_mark[-1])]
    places, inside = [code[lead]], np.ones(len(lead), bool)
    padded = np.concatenate([np.where(is_word[code], code, -1), np.full(longest, -1, np.int32)])
    for step in range(1, longest):
        following = padded[lead + step]
        inside = inside & (following >= 0)
        places.append(np.where(inside, following, -1))
    lang = known[code[at_mark[lead]]]
    order, starts = _runs(lang, *[p + 1 for p in places])
    first = order[starts]
    n = np.diff(np.concatenate([starts, [len(order)]])) if len(order) else order
    return words, lang[first], [p[first] for p in places], n.astype(np.int64)


def _with_ends(texts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(texts, pa.scalar(b""), pa.scalar(b"\n"))


def _joined(parts: list[pa.Array]) -> pa.Array:
    """The words of each row with blanks between; null words are left out."""
    return pc.binary_join_element_wise(*parts, pa.scalar(b" "), null_handling="skip")


def _slices(texts: pa.Array, bounds: np.ndarray) -> pa.Array:
    """One value for each run of rows, without a loop over them."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][bounds]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.copy()), texts.buffers()[2]])


def _numbers(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    )


def blocks(
    bucket: np.ndarray, lang: np.ndarray, langs: list[str], head: pa.Array, last: pa.Array,
    n: np.ndarray, sure: np.ndarray, counted: bool,
) -> Iterator[pa.RecordBatch]:
    """Windows as one row per bucket and language: their texts line by line, counts as bytes."""
    if not len(n):
        return
    order, starts = _runs(bucket, lang)
    bounds = np.concatenate([starts, [len(order)]])
    first, take = order[starts], pa.array(order)
    contents = [
        _slices(_with_ends(head.take(take)), bounds),
        _slices(_with_ends(last.take(take)), bounds),
        _numbers(n[order].astype(np.int64), bounds),
        _numbers(sure[order].astype(np.uint8), bounds),
    ]
    packed = sum(c.nbytes for c in contents) >= PACK_BYTES * len(first)
    if packed:
        pack = zstandard.ZstdCompressor(level=1).compress
        contents = [pa.array([pack(v.as_buffer()) for v in c], pa.binary()) for c in contents]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[first].astype(np.int64)),
            pa.array(langs, pa.string()).take(pa.array(lang[first])),
            pa.array(np.full(len(first), counted)),
            pa.array(np.full(len(first), packed)),
            *contents,
        ],
        ["bucket", "lang", "counted", "packed", *CONTENTS],
    )


def unpacked(batch: pa.RecordBatch, i: int) -> dict:
    """Row i of a batch of blocks, with its contents as written."""
    row = {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}
    if row["packed"]:
        unpack = zstandard.ZstdDecompressor().decompress
        row |= {c: unpack(row[c]) for c in CONTENTS}
    return row


def _bucket_of(texts: pa.Array, buckets: int) -> np.ndarray:
    hashes = (xxhash.xxh64_intdigest(t) for t in texts.to_pylist())
    return (np.fromiter(hashes, np.uint64, len(texts)) >> np.uint64(8)) % np.uint64(buckets)


def _count_in_chunks(longest: int, buckets: int):
    """Maps (lang, text) rows to blocks of counted windows, dealt by a hash of the whole window."""

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            for i, lang in enumerate(batch.column(0).to_pylist()):
                yield lang, column[i].as_py()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, langs, goes_on in streams(texts(batches), longest, CHUNK_BYTES):
            words, lang, places, n = count_windows(tokens, longest, goes_on)
            if not len(n):
                continue
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))
            mixed = np.zeros(len(n), np.uint64)
            for place in places:
                mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + np.where(place >= 0, hashes[place], 0).astype(np.uint64)
            bucket = (mixed >> np.uint64(8)) % np.uint64(buckets)
            parts = [words.take(pa.array(p, mask=p < 0)) for p in places]
            head = _joined(parts[:-1]) if longest > 1 else pa.array([b""] * len(n), pa.binary())
            last = parts[-1].fill_null(b"")
            yield from blocks(bucket, lang, langs, head, last, n, np.zeros(len(n), np.uint8), False)

    return run


def _next_level(texts: pa.Array, width: int) -> tuple[pa.Array, pa.Array]:
    """(head, last) of texts at the level of `width` words; shorter ones are all head."""
    nothing = pa.array([b""] * len(texts), pa.binary())
    if width == 1:
        return nothing, texts
    full = pc.equal(pc.count_substring(texts, " "), width - 1)
    halves = pc.split_pattern(texts, " ", max_splits=1, reverse=True)
    ends = halves.offsets.to_numpy()
    flat = halves.values
    head = pc.if_else(full, flat.take(pa.array(ends[:-1])), texts)
    return head, pc.if_else(full, flat.take(pa.array(ends[1:] - 1)), nothing)


def _sum_level(width: int, least: int, buckets: int):
    """Sums the windows of `width` words, bucket by bucket; the rare ones go on one word shorter.

    A text whose longer windows were kept is marked as sure and kept as well, so that the ROLLUP has
    its whole sum. The last level returns rows instead of blocks.
    """

    def level(lang: str, bucket: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        heads = _split(b"".join(r["head"] for r in rows)[:-1], "\n").dictionary_encode()
        lasts = _split(b"".join(r["last"] for r in rows)[:-1], "\n").dictionary_encode()
        n = np.frombuffer(b"".join(r["n"] for r in rows), np.int64)
        sure = np.frombuffer(b"".join(r["sure"] for r in rows), np.uint8)
        rows.clear()
        order, starts = _runs(heads.indices.to_numpy(), lasts.indices.to_numpy())
        total, marked = np.add.reduceat(n[order], starts), np.maximum.reduceat(sure[order], starts)
        head = heads.indices.to_numpy()[order[starts]]
        last = lasts.indices.to_numpy()[order[starts]]
        words = lasts.dictionary
        whole = pc.not_equal(words, b"").to_numpy(zero_copy_only=False)[last]
        keep = whole & ((total >= least) | (marked > 0))
        kept_heads = heads.dictionary.take(pa.array(head[keep]))
        kept_words = words.take(pa.array(last[keep]))
        kept = _joined([kept_heads, kept_words]) if width > 1 else kept_words
        per_head = np.concatenate([[0], np.flatnonzero(head[1:] != head[:-1]) + 1])
        rest = np.add.reduceat(np.where(keep, 0, total), per_head)
        has_kept = np.maximum.reduceat(keep.astype(np.uint8), per_head)
        going = (rest > 0) | (has_kept > 0)
        shorter = heads.dictionary.take(pa.array(head[per_head][going]))
        rest, has_kept = rest[going], has_kept[going]
        if width == 1:
            yield from rows_of(lang, kept, total[keep])
            yield from rows_of(lang, shorter, rest)
            return
        none = np.zeros(int(keep.sum()), np.int64)
        empty = pa.array([b""] * len(none), pa.binary())
        yield from blocks(none + bucket, none, [lang], kept, empty, total[keep], none, True)
        head, last = _next_level(shorter, width - 1)
        zero = np.zeros(len(rest), np.int64)
        yield from blocks(_bucket_of(shorter, buckets), zero, [lang], head, last, rest, has_kept, False)

    def rows_of(lang: str, texts: pa.Array, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        some = n > 0
        texts, n = texts.filter(pa.array(some)), n[some]
        if len(n):
            words = pc.split_pattern(texts.cast(pa.string()), " ").cast(pa.list_(pa.string()))
            langs = pa.array([lang] * len(n), pa.string())
            yield pa.RecordBatch.from_arrays([langs, words, pa.array(n)], ["lang", "words", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(COUNTED)[i].as_py():
                    if width == 1:
                        row = unpacked(batch, i)
                        texts = _split(row["head"][:-1], "\n")
                        yield from rows_of(row["lang"], texts, np.frombuffer(row["n"], np.int64))
                    else:
                        yield batch.slice(i, 1)
                    continue
                row = unpacked(batch, i)
                if row["bucket"] != bucket:
                    for lang in held:
                        yield from level(lang, bucket, held[lang])
                    bucket, held = row["bucket"], {}
                held.setdefault(row["lang"], []).append(row)
        for lang in held:
            yield from level(lang, bucket, held[lang])

    return run


def phrase_counts(documents: DataFrame, longest: int = LONGEST, least: int = LEAST, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, width, phrase, words, n) of every phrase of at most `longest` words that occurs `least` times.

    Width 0 holds each language's number of words. The rows are written once to the shared folder.
    """
    language = F.coalesce(F.col(lang), F.lit(UNKNOWN)).cast("string").alias("lang")
    named = documents.select(language, whole_text(text).alias("text"))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = -(-size // BUCKET_BYTES) or 1
    tasks = min(buckets, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = named.mapInArrow(_count_in_chunks(longest, buckets), BLOCK)
    for width in range(longest, 0, -1):
        dealt = found.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)).cast("int"))
        dealt = dealt.sortWithinPartitions("bucket")
        found = dealt.mapInArrow(_sum_level(width, least, buckets), BLOCK if width > 1 else ROWS)
    places = [f"w{i}" for i in range(longest)]
    padded = [F.coalesce(F.get("words", F.lit(i)), F.lit("")).alias(p) for i, p in enumerate(places)]
    rolled = found.select("lang", *padded, "n").rollup("lang", *places)
    sums = rolled.agg(F.sum("n").alias("n"), F.grouping_id().alias("rolled"))
    # A set without the last k places has k low bits set in its grouping id.
    widths = [F.when(F.col("rolled") == (1 << (longest - w)) - 1, F.lit(w)) for w in range(longest + 1)]
    sums = sums.withColumn("width", F.coalesce(*widths)).withColumn("words", F.array_compact(F.array(*places)))
    whole = (F.col("width") == 0) | (F.element_at("words", -1) != "")
    kept = sums.where(F.col("width").isNotNull()).where(whole)
    return cut_lineage(kept.select("lang", "width", F.array_join("words", " ").alias("phrase"), "words", "n"))


def _lowest_cuts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds l, r and score of each candidate's lowest-scoring cut; ties go to the first cut.

    Quotients are those of whole decimals, exact for counts below 10^14.
    """
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k"), "words")
    left = F.array_join(F.slice("words", F.lit(1), F.col("k")), " ")
    right = F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", left.alias("left"), right.alias("right"))
    parts = counts.where(F.col("width") > 0)
    for side, count in (("left", "l"), ("right", "r")):
        known = parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(count))
        cuts = lookup(cuts, known, ["lang", side], how="inner")
    a, l, r = (f"cast({c} AS decimal(14,0))" for c in "alr")
    score = F.expr(f"({a} * {a} * cast({MILLION} AS decimal(7,0))) div ({l} * {r})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(best)
    return lowest.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _outside_longer(candidates: DataFrame, share: int) -> DataFrame:
    """Candidates that no longer candidate holds in `share` percent of their places."""
    longer = candidates.where(F.col("width") > 2)
    inner = F.expr(
        "flatten(transform(sequence(2, width - 1), m -> transform(sequence(1, width - m + 1), "
        "i -> array_join(slice(words, i, m), ' '))))"
    )
    held = longer.select("lang", F.explode(inner).alias("phrase"), "a")
    most = held.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = candidates.join(most, ["lang", "phrase"], "left")
    return kept.where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))).drop("most")


def mine_phrases(
    documents: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` collocations, longs but for texts.

    Texts are cut into pieces at .,;:!? and line breaks, pieces into words at blanks and tabs, with
    A-Z in lower case. Phrases of 2 to `longest` words that occur `least` times are candidates: a
    counts a phrase, l and r the two parts of its lowest-scoring cut, n the language's words, and the
    score is floor(1000000 * a * a / (l * r)). Candidates inside a longer one that has at least `share`
    percent of their count are dropped. Order: score and a descending, phrase ascending by bytes.
    A null text has no words, a null language is `und`, repeated rows count as often as they come,
    and without words there are no rows.

    All windows are counted, in chunks and buckets of bounded size that a hash of the whole window
    deals out, so that no word, pair or language meets in one task.
    """
    counts = phrase_counts(documents, longest, least, text, lang)
    candidates = counts.where((F.col("width") > 1) & (F.col("n") >= least)).withColumnRenamed("n", "a")
    scored = _lowest_cuts(_outside_longer(candidates, share), counts)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS)).alias("group")
    near = scored.select("*", group)
    place = F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order))
    near = near.withColumn("place", place).where(F.col("place") <= top).drop("place", "group")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = near.withColumn("rank", rank).where(F.col("rank") <= top)
    sizes = counts.where(F.col("width") == 0).select("lang", "n")
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _sql() -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sizes = " UNION ALL ".join(
        f"SELECT lang, {m} AS width, array_to_string(w[i:i + {m - 1}], ' ') AS phrase FROM places WHERE i + {m - 1} <= len(w)"
        for m in range(1, LONGEST + 1)
    )
    return f"""
    WITH pieces AS (
        SELECT coalesce(lang, '{UNKNOWN}') AS lang,
               unnest(regexp_split_to_array({lowered}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    worded AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
    places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
    f AS MATERIALIZED (
        SELECT lang, width, phrase, count(*) AS n, string_split(phrase, ' ') AS w FROM ({sizes}) GROUP BY ALL),
    candidates AS MATERIALIZED (SELECT * FROM f WHERE width > 1 AND n >= {LEAST}),
    held AS (
        SELECT lang, phrase, max(n) AS most FROM (
            SELECT lang, n, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (
                SELECT *, unnest(range(1, width - m + 2)) AS i FROM (
                    SELECT *, unnest(range(2, width)) AS m FROM candidates))) GROUP BY ALL),
    kept AS (
        SELECT c.* FROM candidates c LEFT JOIN held h USING (lang, phrase)
        WHERE most IS NULL OR 100 * most < {SHARE} * n),
    cuts AS (
        SELECT lang, phrase, n, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
        FROM (SELECT *, unnest(range(1, width)) AS k FROM kept)),
    scored AS (
        SELECT c.lang, c.phrase, c.n AS a,
               min((({MILLION}::HUGEINT * c.n * c.n) // (x.n::HUGEINT * y.n), k, x.n, y.n)) AS best
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = lp JOIN f y ON y.lang = c.lang AND y.phrase = rp
        GROUP BY ALL),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY best[1] DESC, a DESC, phrase) AS rank, phrase, a,
               best[3] AS l, best[4] AS r, best[1]::BIGINT AS score FROM scored),
    sizes AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE width = 1 GROUP BY lang)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}"""


@query("op13_phrases", _sql())
def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Each language's first 2000 phrases of two or three words."""
    return mine_phrases(table(spark, folder, "documents"))
