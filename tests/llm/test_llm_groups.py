"""Packing, chat formatting, mixing, nearest neighbours, SimHash, spot signatures and the pipeline."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from caselog.llm import catalog, chat_format, mixing, nearest, packing, simhash, spot_signatures

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    return [(r["doc_id"], r["text"] or "") for r in rows]


# Packing


def check_packed(rows, texts, window=2048):
    """Every id lies in one piece; sequences have no gaps and fit the window."""
    plain = Tokenizer.from_file(TOKENIZER)
    ids = {k: [*plain.encode(t, add_special_tokens=False).ids, 1] for k, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = np.array(ids[doc][at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[doc]), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids[doc])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
    return sum(map(len, ids.values())) / (window * len(by_sequence))


def test_packing_query_round_trip(spark, folder):
    rows = catalog.QUERIES["op1_packing"](spark, folder).collect()
    assert check_packed(rows, dict(documents(spark, folder))) > 0.95


def test_best_fit_equals_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        window = rng.choice([1, 7, 16, 100])
        lengths = [rng.randint(1, window) for _ in range(rng.randrange(60))]
        names, offsets = packing.best_fit(np.array(lengths, np.int64), window)
        rooms, want = [], {}
        for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [r for r in rooms if r >= lengths[at]]
            want[at] = min(fits) if fits else window
            if fits:
                rooms.remove(min(fits))
            rooms.append(want[at] - lengths[at])
        assert [window - o for o in offsets.tolist()] == [want[i] for i in range(len(lengths))]
        assert len(set(names.tolist())) == len(rooms)


def test_chunked_ids_equal_the_tokenizer():
    plain, chunked = Tokenizer.from_file(TOKENIZER), packing.ChunkTokenizer(TOKENIZER)
    rng = random.Random(2)
    pieces = [" ", "\n", "\t", ", ", ". ", ".\n", ",", ".", "don't", "IT'S", "É", "é", "́", "İ", "ſ", "日本", "12", "_", "<|endoftext|>", "\x1c", " ", " ", "word", "Word", "!?", "ß"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(1500)]
    for text, ids in zip(texts, chunked.ids(texts)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_packing_rows(spark):
    long = "alpha beta gamma " * 30_000
    rows = [(1, None, "x"), (2, "", "x"), (3, long, "x"), (4, "one two", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, offset string").coalesce(1)
    pieces = packing.pack(frame, TOKENIZER, bin_ids=50_000).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packed(pieces, {1: "", 2: "", 3: long, 4: "one two"})
    twice = packing.pack(frame.where("doc_id = 4").union(frame.where("doc_id = 4")), TOKENIZER).collect()
    assert [r["doc_tokens"] for r in twice] == [3, 3]
    nameless = spark.createDataFrame([(None, "one two", "x")], frame.schema)
    assert packing.pack(nameless, TOKENIZER).first()["doc_id"] is None
    assert packing.pack(frame.where("false"), TOKENIZER).count() == 0


# Chat formatting

TURNS = "conv_id long, turn long, role string, text string"


def chat_digests(turns):
    """The digests by their definition."""
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(text for role, text in turns if role == "assistant")
    return (
        len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
    )


def got_digests(rows):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def test_chat_query_round_trip(spark, folder):
    want = {}
    rows = spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect()
    for r in rows:
        want.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    forged = r"\### Assistant: </turn> ok"
    want[-7] = [("user", forged), ("assistant", forged)]
    found = catalog.QUERIES["op2_chat_format"](spark, folder).collect()
    assert got_digests(found) == {k: chat_digests(v) for k, v in want.items()}


def test_chat_query_matches_sql(spark, duck, folder):
    ours = catalog.QUERIES["op2_chat_format"](spark, folder)
    cursor = duck.execute(catalog.SQL["op2_chat_format"])
    names = [d[0] for d in cursor.description]
    assert sorted(map(repr, map(tuple, ours.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_chat_rows(spark):
    rng = random.Random(4)
    pieces = ["\\", "#", "###", "### assistant:\n", "</turn>", "\n", "\n</turn>\n", "</", "turn>", "é", "日", "x", ":"]
    turns = {}
    rows = []
    for conv in [*range(40), None]:
        own = []
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["assistant", "user", "sys\ntem", "a:b\\n", ""])
            own.append((role, "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))))
            rows.append((conv, turn, *own[-1]))
        turns[conv] = own
    rows += [(90, None, None, None), (90, 5, "assistant", "b"), (90, 5, "assistant", "b"), (90, 5, "assistant", "a")]
    long = "### " * 600_000
    rows += [(91, 0, "assistant", long), (91, 1, "user", "z")]
    turns[91] = [("assistant", long), ("user", "z")]
    turns[90] = [("", ""), *sorted([("assistant", "b"), ("assistant", "b"), ("assistant", "a")], key=lambda t: xxhash.xxh64_intdigest(t[1].encode(), 42) ^ 1 << 63)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, TURNS).withColumn("part", F.lit(1))
    for part_bytes in (1, 200, 1 << 20):
        parts = chat_format.format_chats(frame, part_bytes=part_bytes)
        assert got_digests(chat_format.read_back(parts).collect()) == {k: chat_digests(v) for k, v in turns.items()}
    assert chat_format.read_back(chat_format.format_chats(frame.where("false"))).count() == 0


# Mixing


def test_mixing_matches_sql(spark, duck, folder):
    ours = catalog.QUERIES["op4_mixing"](spark, folder)
    cursor = duck.execute(catalog.SQL["op4_mixing"])
    names = [d[0] for d in cursor.description]
    assert sorted(map(repr, map(tuple, ours.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


def poisson_count(mean, u):
    k, p = 0, math.exp(-mean)
    total = p
    while total < u:
        k += 1
        p *= mean / k
        total += p
    return k


@pytest.mark.parametrize("listed", [True, False])
def test_mixing_rows(spark, monkeypatch, listed):
    if not listed:
        monkeypatch.setattr(mixing, "LISTED_SOURCES", 0)
    rows = [(i, "t", "en", "a" if i % 3 else None, 10) for i in range(300)] + [(1000, None, None, "b", None)] * 2
    frame = spark.createDataFrame(rows, DOCS).withColumn("_source", F.lit("clash"))
    weights = spark.createDataFrame([("a", 3.0), (None, 1.0)], "source string, weight double")
    total = 6000.0
    mixed = mixing.mix_sources(frame, weights, total)
    assert mixed.columns == [*frame.columns, "copy"]
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for doc, _text, _lang, source, _n in rows[:300]:
        rate = total * (0.75 / 2000 if source else 0.25 / 1000)
        digits = hashlib.md5(f"{mixing.SEED}:{doc}:1".encode()).hexdigest()[:13]
        assert counts.get(doc, 0) == poisson_count(rate, int(digits, 16) / 16**13)
    assert 1000 not in counts
    assert mixing.mix_sources(frame.where("false")).count() == 0
    assert {r["doc_id"] for r in mixing.mix_sources(frame, total=60_000.0).collect()} >= set(range(300))


def test_large_rates_are_sums_of_parts(spark):
    frame = spark.createDataFrame([(i, "t", "en", "a", 1) for i in range(20)], DOCS)
    counts = mixing.mix_sources(frame, total=40_000.0).groupBy("doc_id").count().collect()
    assert len(counts) == 20 and all(1800 < r["count"] < 2200 for r in counts)


# Nearest neighbours

VECTORS = "vec_id long, embedding array<float>, label int"


def exact(ids, vectors, queries, k):
    found = {}
    for q in queries:
        scores = vectors @ vectors[ids.index(q)]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-scores[i], ids[i]))[:k]
        found[q] = [ids[i] for i in order]
    return found


def found_by(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    return found


def test_nearest_recall(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], np.float64)
    found = catalog.QUERIES["op8_nearest"](spark, folder).collect()
    want = exact(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    got = found_by(found)
    assert set(got) == set(want)
    hits = sum(len(set(want[q]) & set(got[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for r in found:
        product = float(vectors[ids.index(r["query_id"])] @ vectors[ids.index(r["vec_id"])])
        assert r["score"] == pytest.approx(product, abs=1e-12)


def test_nearest_rows(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 8)
    monkeypatch.setattr(nearest, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(60, 5)).astype(np.float32) * rng.uniform(0.1, 4, (60, 1)).astype(np.float32)
    vectors[30:55] = vectors[0]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [0.0] * 5, [1.0, None, 0.0, 0.0, 0.0], [nan] * 5, [inf, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], []]
    rows += [(100 + i, v, 1) for i, v in enumerate(bad)] + [(None, [1.0] * 5, 1), rows[3]]
    frame = spark.createDataFrame(rows, VECTORS).withColumn("bucket", F.lit("clash"))
    ids = list(range(60))
    want = exact(ids, vectors.astype(np.float64), ids[::4], 7)
    everywhere = nearest.nearest(frame, frame.where("vec_id % 4 = 0"), k=7, probes=16).collect()
    assert found_by(everywhere) == want
    few = nearest.nearest(frame.where("vec_id < 3"), frame.where("vec_id = 1"), k=7, probes=16).collect()
    assert [r["rank"] for r in few] == [1, 2]
    assert nearest.nearest(frame.where("false"), frame.where("false")).count() == 0
    assert nearest.nearest(frame, frame.where("vec_id >= 100")).count() == 0


@pytest.mark.parametrize("exact", [nearest.EXACT, 5])
def test_nearest_is_whole_for_few_long_and_stray_vectors(spark, monkeypatch, exact):
    """Few vectors, one long one, skewed lengths, and stray vectors of more components; also where all are hashed."""
    monkeypatch.setattr(nearest, "EXACT", exact)
    rng = np.random.default_rng(8)
    unit = rng.normal(size=(400, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    one_long = unit[:200] * np.where(np.arange(200) == 7, 100, 1)[:, None]
    skewed = unit * rng.lognormal(sigma=1.5, size=(400, 1))
    stray = [(1000 + i, rng.normal(size=65).tolist(), 1) for i in range(2)]
    for vectors in (unit[:10], one_long, skewed):
        rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
        frame = spark.createDataFrame(rows + stray, VECTORS)
        asked = list(range(0, len(vectors), 5))
        got = found_by(nearest.nearest(frame, frame.where("vec_id % 5 = 0")).collect())
        assert got.pop(1000) == [1001]
        want = exact_by(vectors, asked)
        assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items()}
        hits = sum(len(set(want[q]) & set(got[q])) for q in want)
        assert hits >= (1 if exact > 5 else 0.7) * sum(map(len, want.values()))


@pytest.mark.parametrize("spread", [0.0, 0.2, 0.7])
def test_nearest_recall_over_skewed_lengths_in_hashed_ranges(spark, monkeypatch, spread):
    monkeypatch.setattr(nearest, "EXACT", 300)
    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(4_000, 64))
    vectors *= rng.lognormal(sigma=spread, size=(4_000, 1)) / np.linalg.norm(vectors, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], VECTORS)
    asked = list(range(0, len(vectors), 20))
    got = found_by(nearest.nearest(frame, frame.where("vec_id % 20 = 0")).collect())
    want = exact_by(vectors, asked)
    hits = sum(len(set(want[q]) & set(got[q])) for q in want)
    assert {len(x) for x in got.values()} == {20} and hits >= 0.9 * sum(map(len, want.values()))


def exact_by(vectors, asked):
    return exact(list(range(len(vectors))), vectors, asked, 20)


# SimHash


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=4):
    """fingerprint -> root by comparing all pairs."""
    roots = {p: p for p in prints}

    def find(p):
        while roots[p] != p:
            p = roots[p]
        return p

    distinct = sorted(roots)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= distance:
                roots[find(a)] = find(b)
    return {p: find(p) for p in distinct}


def check_groups(rows, prints):
    groups = plain_groups({p for _d, p in prints})
    least = {}
    for doc, p in prints:
        if doc is not None:
            least[groups[p]] = min(doc, least.get(groups[p], doc))
    want = sorted((doc is None, doc or 0, f"{p:016x}", least.get(groups[p])) for doc, p in prints)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in rows) == want


def test_simhash_query_equals_all_pairs(spark, folder):
    prints = [(doc, plain_fingerprint(text)) for doc, text in documents(spark, folder)]
    check_groups(catalog.QUERIES["op10_simhash"](spark, folder).collect(), prints)


def test_words_two_bits_apart_share_a_codeword():
    code, rng = simhash.Golay(), np.random.default_rng(8)
    words = rng.integers(0, 1 << 23, 3000).astype(np.uint32)
    for flips in (0, 1, 2):
        other = words.copy()
        for _ in range(flips):
            other ^= (1 << rng.integers(0, 23, len(words))).astype(np.uint32)
        (a, n), (b, m) = code.indices(words), code.indices(other)
        assert all(set(x[:i]) & set(y[:j]) for x, i, y, j in zip(a, n, b, m))


@pytest.mark.parametrize("block", [3, 40, 1 << 14])
def test_links_join_what_all_pairs_join(spark, block):
    rng = random.Random(9)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, 1, (1 << 64) - 1}
    for center in list(prints)[:6]:
        at = center
        for _ in range(50):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(5)))
            prints |= {at, center ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    roots = simhash.components(simhash.links(spark.createDataFrame(signed, "bits long"), block=block)).collect()
    got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in roots}
    want = plain_groups(prints)
    parts = {}
    for p in prints:
        parts.setdefault(want[p], set()).add(got.get(p, p))
    assert all(len(x) == 1 for x in parts.values())
    assert len({got.get(p, p) for p in prints}) == len(parts)


def test_simhash_rows(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    texts = [(5, None), (3, ""), (8, " \t\n"), (2, "one two"), (9, "ONE  two"), (7, " ".join(words)), (1, " ".join([*words, "x"]))]
    texts += [(7, " ".join(words)), (None, "nobody here at all today"), (6, "é É a b c d")]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in texts], "doc_id long, text string, bits int, root string")
    prints = [(d, plain_fingerprint(t or "")) for d, t in texts]
    check_groups(simhash.near_duplicates(frame).collect(), prints)
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted((0, 1, 2, 3, 6))
    odd = [(1, "a b c d e f", 0, "x"), (2, "a b c d e f", 0, "y"), (2, "other words than these here", 0, "z")]
    odd += [(None, "a b c d e f", 0, "n"), (None, "null alone in its group", 0, "n"), (None, "null alone in its group", 0, "m")]
    odd += [(3, "one text", 0, "p"), (3, "quite another text", 0, "q"), (3, "one text", 0, "r")]
    left = simhash.one_of_each(spark.createDataFrame(odd, frame.schema).repartition(3)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == [
        (0, "null alone in its group"), (1, "a b c d e f"), (2, "other words than these here"),
        (3, "one text"), (3, "quite another text"),
    ]
    assert simhash.near_duplicates(frame.where("false")).count() == 0
    text = " ".join(random.Random(1).choice(words) for _ in range(5000))
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 100)
    assert simhash.fingerprint(text) == plain_fingerprint(text)
    for n in range(8):
        assert simhash.fingerprint("abcdefghij " * n) == plain_fingerprint("abcdefghij " * n)


# Spot signatures


def plain_signatures(text):
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    content = [w for w in words if w not in spot_signatures.COMMON]
    links = [tuple(content[i : i + 3]) for i in range(len(content))] + [()]
    before, found = 0, set()
    for word in words:
        if word in spot_signatures.COMMON:
            found.add((word, *links[min(before, len(content))]))
        else:
            before += 1
    return found or set(links[:-1]) or ({text} if text else set())


def plain_likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check_spots(rows, texts):
    """texts: (doc_id, text) in order."""
    by_doc = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    for at, (doc, text) in enumerate(texts):
        following = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row, own = by_doc[doc], plain_signatures(text)
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert len(row["fingerprint"]) == 8 * len(own)
        assert row["near_edited"] == pytest.approx(plain_likeness(own, plain_signatures(edited)))
        assert row["near_next"] == pytest.approx(plain_likeness(own, plain_signatures(following)))


def test_spot_query_equals_brute_force(spark, folder):
    check_spots(catalog.QUERIES["op7_spot_signatures"](spark, folder).collect(), documents(spark, folder))


def test_spot_rows_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(spot_signatures, "RANGE_ROWS", 5)
    rng = random.Random(11)
    vocabulary = [*spot_signatures.COMMON[:20], "house", "tree", "Été", "42", "stone", "---", "日本"]
    texts = [(i * 7, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(60)]
    texts += [(1000, ""), (1001, "?!"), (1002, "the"), (1003, "the house " * 20_000), (1004, "the house " * 20_000)]
    frame = spark.createDataFrame([(d, t, "clash") for d, t in texts], "doc_id long, text string, part string")
    with_null = frame.withColumn("text", F.when(F.col("doc_id") != 1000, F.col("text")))
    rows = spot_signatures.edit_stability(spot_signatures_small(with_null)).collect()
    check_spots(rows, texts)
    prints = {r["doc_id"]: r["fingerprint"] for r in spot_signatures.fingerprints(frame).collect()}
    assert prints == {r["doc_id"]: r["fingerprint"] for r in rows} and prints[1003] == prints[1004]
    assert spot_signatures.edit_stability(frame.where("false")).count() == 0
    check_spots(spot_signatures.edit_stability(frame.where("doc_id = 7")).collect(), texts[1:2])
    odd = spark.createDataFrame([(None, "the tree here", "x"), (3, "a", "x"), (3, "a", "x")], frame.schema)
    assert spot_signatures.edit_stability(odd).count() == 3


def spot_signatures_small(frame):
    return frame.repartition(3)


def test_likeness_is_pruned_by_length_only_below_the_limit(spark):
    pairs = [(list(range(n)), list(range(m))) for n in (0, 1, 4, 5, 10, 30) for m in (0, 1, 4, 5, 10, 30)]
    frame = spark.createDataFrame(pairs, "a array<int>, b array<int>")
    for row in frame.select("a", "b", spot_signatures.likeness(F.col("a"), F.col("b"), 0.8).alias("s")).collect():
        true = plain_likeness(set(row["a"]), set(row["b"]))
        assert row["s"] == (pytest.approx(true) if true >= 0.8 or row["s"] else 0.0)


# The pipeline


def test_pipeline_stage_by_stage(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == docs.columns
        result.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
    every = documents(spark, folder)
    languages = {r["doc_id"]: r["text"] for r in seen["language_id"]}
    assert {d for d, t in every if any(c.isalpha() for c in t)} == set(languages)
    prints = {d: plain_fingerprint(t) for d, t in languages.items()}
    groups = plain_groups(set(prints.values()))
    least = {}
    for doc in sorted(prints):
        least.setdefault(groups[prints[doc]], doc)
    assert sorted(r["doc_id"] for r in seen["near_duplicates"]) == sorted(least.values())
    scanned = {r["doc_id"]: r["text"] for r in seen["secret_scan"]}
    assert set(scanned) == set(least.values())
    assert not any(re.search("AKIA[A-Z0-9]{16}|[0-9a-f]{24}", t) for t in scanned.values())
    assert all(t == languages[d] for d, t in scanned.items() if "<" not in t)
    assert {r["doc_id"] for r in seen["mixing"]} <= set(scanned)
    lengths = {}
    for r in seen["packing"]:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    plain, mixed = Tokenizer.from_file(TOKENIZER), {}
    for r in seen["mixing"]:
        mixed[r["doc_id"]] = mixed.get(r["doc_id"], 0) + len(plain.encode(r["text"], add_special_tokens=False).ids) + 1
    assert lengths == mixed


def test_pipeline_runs_as_one(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_takes_odd_rows(spark, tmp_path, empty):
    prose = "the house of the king and the garden of the queen "
    rows = [(i, f"{prose * 3} number {i} " + " ".join(f"w{i * j}" for j in range(30)), "en", "a", 10) for i in range(20)]
    rows += [rows[3], (50, None, None, None, None), (51, "", "en", "b", 0), (52, "12 34 !?", "de", "b", 8)]
    rows += [(None, prose + "nobody knows", None, "b", 5), (53, prose * 20_000, "en", None, None), (54, "password=abcdef " + prose * 5, "en", "b", 9)]
    frame = spark.createDataFrame([] if empty else rows, DOCS).withColumn("copy", F.lit("clash"))
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, str(tmp_path))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert sorted(result.columns) == sorted(frame.columns)
        result.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    if empty:
        assert all(not ids for ids in kept.values())
        return
    assert sorted(kept["language_id"], key=str) == sorted([*range(20), 3, 53, 54, None], key=str)
    assert sorted(kept["near_duplicates"], key=str) == sorted(set(kept["near_duplicates"]), key=str)
    assert set(kept["packing"]) == set(kept["mixing"]) <= set(kept["secret_scan"]) == set(kept["near_duplicates"])
