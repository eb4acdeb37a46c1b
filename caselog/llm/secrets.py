"""Secret scan: patterns for known forms, sliding-window entropy for the rest."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import extra_name, query, table, whole_text

# The base patterns, in the order that breaks ties of position.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)

# Bits a window must reach, by the character class of the window.
HEX_BITS, ALNUM_BITS, BASE64_BITS = 3.0, 3.6, 3.7
#: A window of letters alone is prose in languages with long words, however even its letters are.
LEAST_DIGITS = 2

# What is never a secret as a whole.
ALLOWED = re.compile(
    r"""(?x) ^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$ # UUIDs
    | ^[0-9_=+/-]+$                                 # numbers, dates and rules
    | ^(?:[A-Za-z]+[-_/]){2,}(?:[A-Za-z]+|[0-9]{1,4}|[A-Za-z][a-z]{0,7}[0-9]{1,2})$ # slugs and paths of words
    """
)
# Words that mark the part they stand in as harmless; a scheme is a part of its own.
PLACEHOLDER = re.compile(r"(?i:example|sample|dummy|placeholder|changeme|lorem)|(?<![A-Za-z0-9])(?:https?|ftp)(?=/)")
PART = re.compile(r"[A-Za-z0-9]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches, leftmost and non-overlapping per kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def windows_over(candidate: str) -> Iterator[tuple[int, float, int, int, int]]:
    """(start, entropy, letters, digits, other) of each window, by counts kept up to date.

    The entropy of a window of n characters is log2(n) - sum(c log2 c) / n. Moving it on by one
    changes two counts, so a candidate costs one step per character however wide the window is.
    """
    gain = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
    counts: dict[str, int] = {}
    total, kinds = 0.0, [0, 0, 0]
    for at, new in enumerate(candidate):
        if at >= WINDOW:
            old = candidate[at - WINDOW]
            counts[old] = count = counts[old] - 1
            total += gain[count] - gain[count + 1]
            kinds[_class(old)] -= 1
        counts[new] = count = counts.get(new, 0) + 1
        total += gain[count] - gain[count - 1]
        kinds[_class(new)] += 1
        if at >= WINDOW - 1:
            yield at - WINDOW + 1, math.log2(WINDOW) - total / WINDOW, *kinds


def _class(character: str) -> int:
    return 1 if character.isdigit() else 0 if character.isalpha() else 2


def stretches(candidate: str) -> Iterator[tuple[int, str]]:
    """(start, stretch) of what is left of a candidate without its placeholder parts.

    Parts lie between separators; a separator beside a part goes with it. A part that could hold a key
    on either side of its placeholder word is kept, for its windows to be judged.
    """
    at = 0
    if PLACEHOLDER.search(candidate):
        for part in PART.finditer(candidate):
            if len(part[0]) >= 2 * WINDOW or not PLACEHOLDER.search(candidate, part.start(), part.end() + 1):
                continue
            if part.start() - 1 > at:
                yield at, candidate[at : part.start() - 1]
            at = part.end() + 1
    if at < len(candidate):
        yield at, candidate[at:]


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, 3, end) of the merged windows whose entropy is too high for their character class."""
    found: list[tuple[int, int, int]] = []
    for match in CANDIDATE.finditer(text):
        for offset, stretch in stretches(match[0]):
            if len(stretch) < WINDOW or stretch.isalpha() or ALLOWED.search(stretch):
                continue
            first = match.start() + offset
            lowest = HEX_BITS if not stretch.strip("0123456789abcdefABCDEF") else None
            start = end = -1
            for at, bits, _letters, digits, other in windows_over(stretch):
                least = lowest or (BASE64_BITS if other else ALNUM_BITS)
                if digits < LEAST_DIGITS or bits < least:
                    continue
                if start >= 0 and at > end:
                    found.append((first + start, 3, first + end))
                    start = -1
                start, end = (at if start < 0 else start), at + WINDOW
            if start >= 0:
                found.append((first + start, 3, first + end))
    return found


def secret_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each sorted by start and kind.

    An entropy span that lies inside a stretch of base spans adds nothing and is left out.
    """
    base = sorted(base_spans(text))
    starts, reach = [b[0] for b in base], list(accumulate((b[2] for b in base), max))
    more = [x for x in entropy_spans(text) if not ((at := bisect_right(starts, x[0])) and reach[at - 1] >= x[2])]
    return base, sorted(base + more)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each union of overlapping spans replaced by a mark of its first kind."""
    pieces, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            pieces += [text[done:start], f"<{KINDS[kind]}>"]
        done = max(done, end)
    return "".join(pieces) + text[done:]


def scan_secrets(docs: DataFrame, text: str = "text", redacted: bool = False) -> DataFrame:
    """Adds n_assign, n_access, n_hex, n_entropy, base_spans and spans; replaces columns of those names.

    Spans are kind:start:end in code points, end exclusive, comma-joined by start and then kind.
    `redacted=True` also replaces every found span in the text. A null text counts as empty, has no
    spans and stays null. Every text is scanned whole; rows are independent, so repeated rows give
    repeated results and nothing is shuffled.
    """
    key = extra_name(docs, "_scanned")
    counted = ["n_assign", "n_access", "n_hex", "n_entropy"]
    written = ["base_spans", "spans", "redacted"]

    @F.arrow_udf(", ".join([*(f"{n} long" for n in counted), *(f"{n} string" for n in written)]))
    def scan(texts: pa.Array) -> pa.Array:
        columns = [[] for _ in (*counted, *written)]
        for text in texts:
            value = text.as_py()
            base, spans = secret_spans(value)
            counts = [sum(s[1] == k for s in spans) for k in range(4)]
            new = redact(value, spans) if redacted and spans else None
            for column, item in zip(columns, (*counts, _joined(base), _joined(spans), new)):
                column.append(item)
        kinds = [pa.int64()] * len(counted) + [pa.string()] * len(written)
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*counted, *written]
        )

    found = docs.withColumn(key, scan(whole_text(text)))
    names = [*counted, "base_spans", "spans"]
    if redacted:
        found = found.withColumn(text, F.coalesce(F.col(f"{key}.redacted"), F.col(text)))
    return found.withColumns({n: F.col(f"{key}.{n}") for n in names}).drop(key)


def redact_secrets(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents with every secret replaced by a mark; the length column follows the text.

    Every document stays. A null text stays null with its given length.
    """
    found, changed = scan_secrets(docs, text, redacted=True), F.length(text)
    if length in docs.columns:
        found = found.withColumn(length, F.when(F.col("spans") != "", changed.cast("long")).otherwise(F.col(length)))
    return found.select(*docs.columns)


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, spans and the digest of the base spans of every document."""
    found = scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_entropy"
    )
