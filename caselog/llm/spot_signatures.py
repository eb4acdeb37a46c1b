"""Document fingerprints by spot signatures: chains of content words after common words. Native.

A signature is a common word (the anchor) and the CHAIN content words that follow it; other common
words in between are passed over, so small changes of style move few signatures. A fingerprint is
the set of a text's signatures, kept sorted as 32-bit hashes. Fingerprints are alike by the Jaccard
measure of their sets. Sets fall into partitions by length such that two sets can only be alike by
`least` or more if their partitions are the same or neighbours; other pairs are not compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselog.llm.common import extra_name, query, table, whole_text

CHAIN = 3
LEAST = 0.8

# Common words that anchor signatures, by language.
ANCHORS = {
    "en": "a an and are as at be but by for from had has have he her his in is it not of on or that the their they "
    "this to was were which with",
    "de": "als am an auch auf aus bei das dass dem den der des die ein eine einer er es für ich im in ist mit nicht "
    "sich sie sind und von war wie zu zum",
    "fr": "au aux avec ce ces dans de des du elle en est et il la le les mais ne ou par pas pour qui que se son sur "
    "un une",
    "es": "al como con de del el en es esta la las lo los mas no o para pero por que se ser son su sus un una y",
}
COMMON = tuple(sorted({word for words in ANCHORS.values() for word in words.split()}))

#: Neighbours are found in ranges of about so many rows, of which there are at most so many.
RANGE_ROWS, MOST_RANGES = 1_000, 50_000


def with_signatures(df: DataFrame, text: str, name: str, chain: int = CHAIN) -> DataFrame:
    """Adds `name`, the sorted distinct signatures of the text as ints.

    The j-th anchor of a text, at word p, has p - j content words before it; so its chain starts at
    content word p - j. A chain cut short by the end of the text counts as it is. A text without an
    anchor has one signature per content word, a text without a word one signature of its
    characters, an empty text none.
    """
    words, content, anchors = (extra_name(df, f"_{n}") for n in ("words", "content", "anchors"))
    plain = F.trim(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "))
    split = F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))
    spots = F.array_remove(F.transform(words, lambda w, i: F.when(w.isin(*COMMON), i).otherwise(F.lit(-1))), -1)

    def links(at: Column) -> list[Column]:
        return [F.get(F.col(content), at + i) for i in range(chain)]

    found = F.transform(anchors, lambda p, j: F.hash(F.get(F.col(words), p), *links(p - j)))
    bare = F.transform(content, lambda _w, i: F.hash(F.lit(""), *links(i)))
    marks = F.when(F.col(text) == "", F.array().cast("array<int>")).otherwise(F.array(F.hash(F.col(text))))
    signed = F.when(F.size(anchors) > 0, found).when(F.size(content) > 0, bare).otherwise(marks)
    return (
        df.withColumn(words, split)
        .withColumns({content: F.filter(words, lambda w: ~w.isin(*COMMON)), anchors: spots})
        .withColumn(name, F.array_sort(F.array_distinct(signed)))
        .drop(words, content, anchors)
    )


def fingerprint_text(signatures: Column) -> Column:
    """The signatures as eight hex digits each."""
    digits = F.transform(signatures, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.lower(F.array_join(digits, ""))


def length_partition(size: Column, least: float = LEAST) -> Column:
    """Sets alike by `least` or more lie in the same or in neighbouring partitions: each is 1 / least long."""
    return F.floor(F.ln(F.greatest(size, F.lit(1)).cast("double")) / math.log(1 / least)).cast("int")


def likeness(left: Column, right: Column, least: float = 0.0) -> Column:
    """The Jaccard measure of two fingerprints; 0 where their lengths alone keep it below `least`.

    Two empty sets are alike by 1.
    """
    small, large = F.least(F.size(left), F.size(right)), F.greatest(F.size(left), F.size(right))
    common = F.size(F.array_intersect(left, right))
    measure = common / (small + large - common).cast("double")
    pruned = small < large * F.lit(float(least))
    if least > 0:
        apart = F.abs(length_partition(small, least) - length_partition(large, least)) > 1
        pruned = pruned | apart
    return F.when(large == 0, F.lit(1.0)).when((small == 0) | pruned, F.lit(0.0)).otherwise(measure)


def _range_of(key: Column, bounds: list) -> Column:
    """How many bounds lie below the key, by halving; null keys come first."""
    if not bounds:
        return F.pmod(F.hash(key), F.lit(1))
    sorted_bounds = F.lit(bounds)

    def step(low_high: Column, _i: Column) -> Column:
        low, high = low_high["low"], low_high["high"]
        middle = F.floor((low + high) / 2).cast("int")
        less = F.get(sorted_bounds, middle) < key
        open_ = low < high
        return F.struct(
            F.when(open_ & less, middle + 1).otherwise(low).alias("low"),
            F.when(open_ & ~less, middle).otherwise(high).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    halvings = F.array(*[F.lit(i) for i in range(len(bounds).bit_length())])
    return F.when(key.isNull(), F.lit(0)).otherwise(F.aggregate(halvings, start, step, lambda x: x["low"]))


def with_next(
    docs: DataFrame, doc: str, text: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """doc_id, text, signatures and those of the next row by doc_id: next_text, next_signatures.

    The row after the last is the first. Rows are shuffled once, by ranges of ids; within a range the
    next row is found by a window, and the first row of each range is handed to the one before.
    """
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    total = docs.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    count = min(MOST_RANGES, max(1, total // range_rows))
    shares = [i / count for i in range(1, count)]
    bounds = []
    if shares:
        bounds = docs.agg(F.percentile_approx(F.col(doc).cast("long"), shares, 10 * count)).first()[0] or []
        bounds = sorted(set(bounds))
    placed = rows.withColumn("part", _range_of(F.col("doc_id"), bounds))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    window = Window.partitionBy("part").orderBy(*order)

    ids = placed.select("part", "doc_id")
    firsts = ids.groupBy("part").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id")).alias("least")
    )
    along = Window.orderBy("part")
    everywhere = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = firsts.select(
        F.coalesce(F.lag("part").over(along), F.last("part").over(everywhere)).alias("before"),
        F.col("least.doc_id").alias("head"),
    )
    first_rows = placed.join(F.broadcast(heads), placed["doc_id"].eqNullSafe(heads["head"]))
    first_rows = first_rows.groupBy("before").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    first_rows = with_signatures(first_rows.select("before", F.col("first.text").alias("first_text")), "first_text", "first_signatures")

    signed = with_signatures(placed.repartition("part"), "text", "signatures")
    inside = signed.withColumn("following", F.lead(F.struct("text", "signatures")).over(window))
    joined = inside.join(first_rows, inside["part"] == first_rows["before"], "left")
    return joined.select(
        "doc_id",
        "text",
        "signatures",
        F.coalesce("following.text", "first_text").alias("next_text"),
        F.coalesce("following.signatures", "first_signatures").alias("next_signatures"),
    )


def fingerprints(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint, length_partition and n_signatures of every whole text.

    Null text counts as empty and has the empty fingerprint. Equal texts have equal fingerprints. Rows
    are independent: null and repeated ids keep their rows. An empty table gives no rows. Other columns
    are left out, and nothing is shuffled.
    """
    rows = docs.select(F.col(doc).alias("doc_id"), whole_text(text).alias("text"))
    return with_signatures(rows, "text", "signatures").select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        fingerprint_text(F.col("signatures")).alias("fingerprint"),
        length_partition(F.size("signatures")).alias("length_partition"),
        F.size("signatures").cast("long").alias("n_signatures"),
    )


def edit_stability(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike neighbours are.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the
    next document, or all of it. The next document is the next by ascending id (equal ids by a hash of
    the text; null ids first), after the last the first; a single document is its own next. Null text
    counts as empty. An empty table gives no rows. Ids are taken as longs.
    """
    rows = with_next(docs, doc, text)
    half = F.floor(F.length("text") / 2).cast("int")
    head = F.col("text").substr(F.lit(1), F.length("text") - half)
    edited = F.concat(head, F.col("next_text").substr(F.lit(1), half))
    signed = with_signatures(rows.withColumn("edited", edited), "edited", "edited_signatures")
    own = F.col("signatures")
    return signed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprint_text(own).alias("fingerprint"),
        fingerprint_text(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(own, F.col("edited_signatures")).alias("near_edited"),
        likeness(own, F.col("next_signatures")).alias("near_next"),
        length_partition(F.size(own)).alias("length_partition"),
    )


@query("op7_spot_signatures")
def op7_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of every document and of its edited text."""
    return edit_stability(table(spark, folder, "documents"))
