"""Language identification by rank-order n-gram profiles and out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import extra_name, per_process, query, table, whole_text

UNKNOWN = "und"
#: Ranks a profile keeps. The distance charges an n-gram the profile lacks as many places.
PROFILE = 400
#: Fitting reads at most about this many labelled rows of a language, spread evenly by a hash.
FIT_ROWS = 5_000
#: Row counts of up to so many languages travel to every task; more are joined.
LISTED_LANGUAGES = 10_000
CHAR_BITS = 21
#: The character that stands for all that are no letters.
BLANK = 1
PIECE = 1 << 20


def _letters() -> np.ndarray:
    """For every code point: its lower case if it is a letter, else BLANK."""
    table = np.full(0x110000, BLANK, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(code, count) of the text's n-grams. Words are runs of letters, framed by one blank.

    An n-gram's code holds its characters in 21 bits each. N-grams of a long text are counted piece
    by piece.
    """
    letters = per_process("letters", "lower case", _letters)
    codes, counts = [], []
    for at in range(0, len(text), PIECE):
        raw = np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = letters[raw].astype(np.int64)
        chars = np.concatenate([[BLANK], chars, [BLANK]])
        blank = chars == BLANK
        chars = chars[~(blank & np.append(False, blank[:-1]))]
        if len(chars) < 2:
            continue
        pairs = chars[:-1] << CHAR_BITS | chars[1:]
        triples = pairs[:-1] << CHAR_BITS | chars[2:]
        grams = np.concatenate([chars[chars != BLANK], pairs, triples[chars[1:-1] != BLANK]])
        code, count = np.unique(grams, return_counts=True)
        codes.append(code), counts.append(count)
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(codes) == 1:
        return codes[0], counts[0]
    code, place = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(place, np.concatenate(counts)).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order of rank; ties by code."""
    return codes[np.lexsort((codes, -counts))[:size]]


class Profiles:
    """Language profiles as one sorted table of n-grams with a column of ranks per language."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.languages, self.size = sorted(profiles), size
        known = sorted({c for grams in profiles.values() for c in grams})
        self.codes = np.array(known, np.int64)
        self.ranks = np.full((len(known) + 1, len(self.languages)), -1, np.int64)
        for column, language in enumerate(self.languages):
            at = np.searchsorted(self.codes, np.array(profiles[language], np.int64))
            self.ranks[at, column] = np.arange(len(at))

    def judge(self, text: str) -> tuple[str, float]:
        """(language, score): the least out-of-place distance; the score is 1 less its share of the most.

        `und` and 0 for a text without a letter, or without any profile.
        """
        own = ranked(*gram_counts(text), self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = -1
        at[self.codes[at] != own] = len(self.codes)
        ranks = self.ranks[at]
        places = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks < 0, self.size, np.minimum(places, self.size)).sum(axis=0)
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / (self.size * len(own)))


def in_fold(doc: Column) -> Column:
    """Held out: the CRC-32 of the id as text leaves the remainder 1 by 3."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_profiles(
    rows: DataFrame, text: str, lang: str, doc: str, fit_rows: int = FIT_ROWS, size: int = PROFILE
) -> dict[str, list[int]]:
    """language -> ranked n-grams of its labelled rows.

    `fit_rows` bounds the rows read per language: larger languages are thinned evenly by a hash of
    the id. Counts are summed per task before they are shuffled; each language keeps `size` n-grams,
    which is all the driver sees.
    """
    labelled = rows.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), whole_text(text).alias("text"), F.xxhash64(doc).alias("spot")
    )
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    few = sizes.limit(LISTED_LANGUAGES + 1).collect()
    if len(few) <= LISTED_LANGUAGES:
        sizes = F.broadcast(rows.sparkSession.createDataFrame(few, sizes.schema))
    part = F.least(F.lit(1.0), F.lit(float(fit_rows)) / F.col("n")) * F.lit(float(1 << 20))
    chosen = labelled.join(sizes, "lang").where(F.pmod("spot", F.lit(1 << 20)) < part).select("lang", "text")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            for language in dict.fromkeys(langs):
                found = [gram_counts(t.as_py()) for x, t in zip(langs, texts) if x == language]
                code, place = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                total = np.bincount(place, np.concatenate([f[1] for f in found])).astype(np.int64)
                names = pa.array([language] * len(code), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(code), pa.array(total)], names=["lang", "gram", "n"])

    counts = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    entry = F.struct((-F.col("n")).alias("n"), F.col("gram").alias("gram"))
    tops = counts.groupBy("lang", F.pmod(F.hash("gram"), F.lit(64)).alias("part")).agg(
        F.slice(F.sort_array(F.collect_list(entry)), 1, size).alias("top")
    )
    merged = tops.groupBy("lang").agg(F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, size).alias("top"))
    return {row["lang"]: [x["gram"] for x in row["top"]] for row in merged.collect() if row["top"]}


def predict(profiles: dict[str, list[int]], text: str = "text", size: int = PROFILE) -> Column:
    """struct(lang_pred, score) of the whole text; `und` for a null text or one without a letter."""

    @F.arrow_udf("lang_pred string, score double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Profiles(profiles, size)
        for texts in batches:
            found = [model.judge(t.as_py()) for t in texts]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.StructArray.from_arrays(columns, names=["lang_pred", "score"])

    return judge(whole_text(text))


def identify_languages(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """Adds held_out, lang_pred and score; replaces columns of those names.

    Profiles are learned from text and non-null `lang` of the rows that are not held out; predictions
    see the text alone. A null text, or one without a letter, is `und` with score 0, and so is every
    text if there is nothing to learn from. Equal texts get equal answers; ties between languages go
    to the first by name. A null id counts as not held out. Predicting shuffles nothing.
    """
    profiles = fit_profiles(docs.where(~in_fold(F.col(doc))), text, lang, doc, fit_rows)
    found = extra_name(docs, "_found")
    placed = docs.withColumn(found, predict(profiles, text))
    return placed.withColumns(
        {
            "held_out": in_fold(F.col(doc)),
            "lang_pred": F.col(f"{found}.lang_pred"),
            "score": F.col(f"{found}.score"),
        }
    ).drop(found)


#: Below this score a text follows no profile: letters in no language's order.
LEAST_SCORE = 0.05


def in_known_language(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents whose language is known: `und` and scores below LEAST_SCORE go."""
    placed = identify_languages(docs.select(doc, text, lang, F.struct(*docs.columns).alias("_row")), doc, text, lang)
    kept = placed.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col(f"_row.{c}").alias(c) for c in docs.columns])


@query("op5_language_id")
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return identify_languages(docs).select("doc_id", "held_out", "lang_pred", "score")
