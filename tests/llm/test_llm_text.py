"""URL filter, secret scan, language identification, quality: rows that stand alone."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselog.llm import catalog, language_id, quality, secrets, url_filter

PAGES = "page_id long, url string, host int, note string"


def test_url_rules_and_terms(spark):
    urls = {
        0: None,
        1: "",
        2: "no scheme/casino/win",
        3: "http://A.Example.COM/en/x?win&casino",
        4: "https://www.example.com/en/x",
        5: "http://example.com",
        6: "x://net/es/1#://com/",
        7: "http://m.foo.net/xx/bet/bonus",
        8: "http://m.foo.net/xx/bets/bonus",
        9: "http://xxx.org/",
        10: "http://xxxl.org/bet/bet/bet",
        11: "http://a://com/b",
        12: "http://é.org/bet-win",
    }
    rows = [(k, u, 7, "kept") for k, u in urls.items()] + [(9, urls[9], 8, "twice")]
    found = url_filter.judge_urls(spark.createDataFrame(rows, PAGES)).collect()
    assert len(found) == len(rows) and {r["note"] for r in found} == {"kept", "twice"}
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}
    assert got == {
        0: ("", "", None, "allow"),
        1: ("", "", None, "allow"),
        2: ("", "", None, "block"),
        3: ("a.example.com", "/en/x", "example.com/en/", "block"),
        4: ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        5: ("example.com", "", None, "allow"),
        6: ("net", "/es/1", "net/es/", "block"),
        7: ("m.foo.net", "/xx/bet/bonus", None, "block"),
        8: ("m.foo.net", "/xx/bets/bonus", None, "allow"),
        9: ("xxx.org", "/", None, "block"),
        10: ("xxxl.org", "/bet/bet/bet", None, "allow"),
        11: ("a:", "//com/b", None, "allow"),
        12: ("é.org", "/bet-win", None, "block"),
    }
    assert url_filter.judge_urls(spark.createDataFrame([], PAGES)).count() == 0


def test_url_query_matches_sql(spark, duck, folder):
    ours = catalog.QUERIES["op9_url_filter"](spark, folder)
    cursor = duck.execute(catalog.SQL["op9_url_filter"])
    names = [d[0] for d in cursor.description]
    assert sorted(map(repr, map(tuple, ours.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


def plain_secrets(text):
    """The base spans as the contract words them."""
    found = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, text, re.IGNORECASE | re.ASCII):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(found)


def plain_entropy(text):
    counts = [text.count(c) for c in set(text)]
    return -sum(c / len(text) * math.log2(c / len(text)) for c in counts)


def test_secret_spans_equal_brute_force():
    rng = random.Random(3)
    pieces = ["password", "Token", "API_KEY", "apikey", "ſecret", "=", ": ", '"', "'", " ", "é", "AKIA", "abcdef", "0123456789", "QZ7x", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(25)))
        base, spans = secrets.secret_spans(text)
        assert base == plain_secrets(text)
        assert set(base) <= set(spans) and spans == sorted(spans)


def test_incremental_entropy_equals_definition():
    text = "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7-_/=aaaaaaaaaaaaaaaaaaaaaaaa"
    for at, bits, letters, digits, other in secrets.windows_over(text):
        window = text[at : at + secrets.WINDOW]
        assert bits == pytest.approx(plain_entropy(window), abs=1e-9)
        assert (letters, digits) == (sum(c.isalpha() for c in window), sum(c.isdigit() for c in window))
        assert other == secrets.WINDOW - letters - digits


def test_entropy_finds_keys_and_passes_allowed_strings():
    key = "wJalrXUtnFEMI7K7MDENG9bPxRfiCYzZ4kQ2pL8v"
    assert [text_kind for _s, text_kind, _e in secrets.secret_spans(f"see {key} there")[1]] == [3]
    for harmless in (
        "123e4567-e89b-12d3-a456-426614174000",
        "Donaudampfschifffahrtsgesellschaftskapitaen",
        "2024-01-02_03-04-05_2024-01-02",
        "the-quick-brown-fox-jumps-over-the-lazy-dog",
        "EXAMPLEwJalrXUtnFEMI7K7MDENG9bPx",
    ):
        assert secrets.secret_spans(f"see {harmless} there")[1] == []


def test_allow_list_hides_only_the_harmless_part():
    key = "4eC39HqLyjWDarjtT1zdp7dc"
    block = "wJ4lrXUtn9EMI7K7MDENG9bPxRfiCYzZ4kQ2pL8v"
    for text in (
        f"sk_live_{key}",
        f"sk-proj-{key}Qw8",
        f"api/key/{key}",
        f"/examples/{key}",
        f"{key}/examples/docs",
        f"/docs/sample-code/{key}/dummy",
        f"{block}lorem{block}",
        f"{block}/examples_{block}",
        f"https/docs/{key}",
    ):
        spans = secrets.secret_spans(f"see {text} there")[1]
        hidden = secrets.redact(f"see {text} there", spans)
        assert spans and key not in hidden and block[:20] not in hidden and block[-20:] not in hidden, text
    for harmless in ("/examples/getting-started-with-words", "a-long-slug-of-words-2024", "docs/reference/file10", "EXAMPLE7KEY8VALUE9a0b1c"):
        assert secrets.secret_spans(f"see {harmless} there")[1] == [], harmless


def test_secret_rows(spark):
    schema = "doc_id long, text string, spans int, n_chars long"
    long = "word " * 300_000 + "password=abcdef " + "x1Y2" * 50_000
    rows = [(1, None, 5, 9), (2, "", 5, 0), (3, "token: abc123", 5, 13), (3, "token: abc123", 5, 13), (None, long, 5, len(long))]
    frame = spark.createDataFrame(rows, schema)
    found = secrets.scan_secrets(frame).collect()
    assert len(found) == 5
    assert [r["spans"] for r in found if r["doc_id"] == 3] == ["assign:0:13"] * 2
    assert [r["spans"] for r in found if r["doc_id"] in (1, 2)] == ["", ""]
    assert [r["n_assign"] for r in found if r["doc_id"] is None] == [1]
    cleaned = {(r["doc_id"], r["text"], r["n_chars"]) for r in secrets.redact_secrets(frame).collect() if r["doc_id"]}
    assert cleaned == {(1, None, 9), (2, "", 0), (3, "<assign>", 8)}
    assert secrets.redact_secrets(frame).columns == frame.columns
    assert secrets.scan_secrets(spark.createDataFrame([], schema)).count() == 0


def test_secret_query_equals_brute_force(spark, folder):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = catalog.QUERIES["op6_secret_scan"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for row in rows:
        base = plain_secrets(texts[row["doc_id"]])
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(b[1] == k for b in base) for k in range(3)]
        assert {x for x in joined.split(",") if x} <= set(row["spans"].split(","))


def plain_profile(text):
    """N-gram counts by the definition, as strings with _ for a blank."""
    words = re.findall(r"[^\W\d_]+", text.lower())
    counts = {}
    framed = "_" + "_".join(words) + "_" if words else ""
    for n in (1, 2, 3):
        for at in range(len(framed) - n + 1):
            gram = framed[at : at + n]
            if (n == 1 and gram != "_") or n == 2 or (n == 3 and gram[1] != "_"):
                counts[gram] = counts.get(gram, 0) + 1
    return counts


def test_gram_counts_equal_definition():
    for text in ("", "12 34", "Été, été! a", "Straße 5 x", "a" * 50):
        codes, counts = language_id.gram_counts(text)
        got = {}
        for code, count in zip(codes.tolist(), counts.tolist()):
            chars = ""
            while code:
                chars, code = chr(code & 0x1FFFFF) + chars, code >> 21
            got[chars.replace(chr(language_id.BLANK), "_")] = count
        assert got == plain_profile(text)


def test_languages(spark):
    english, german = "the house and the garden of the king ", "das haus und der garten des koenigs "
    rows = [(i, (english if i % 2 else german) * 4, "en" if i % 2 else "de", 1) for i in range(60)]
    rows += [(100, None, "en", 1), (101, "", None, 1), (102, "12 ?!", "en", 1), (103, english, None, 1)]
    rows += [(104, english * 40_000, None, 1), (105, english * 4, None, 1), (None, german, None, 1)]
    schema = "doc_id long, text string, lang string, held_out int"
    frame = spark.createDataFrame(rows, schema)
    found = {r["doc_id"]: r for r in language_id.identify_languages(frame).collect()}
    assert len(found) == len(rows)
    for doc, row in found.items():
        if doc is not None:
            assert row["held_out"] == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
    assert {found[i]["lang_pred"] for i in (100, 101, 102)} == {"und"}
    assert {found[i]["lang_pred"] for i in range(1, 60, 2)} == {"en"}
    assert {found[i]["lang_pred"] for i in range(0, 60, 2)} == {"de"}
    assert [found[i]["lang_pred"] for i in (103, 104, None)] == ["en", "en", "de"]
    assert found[105]["score"] == found[1]["score"]
    kept = language_id.in_known_language(frame)
    assert kept.columns == frame.columns and kept.count() == len(rows) - 3
    assert language_id.identify_languages(spark.createDataFrame([], schema)).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None, 1)], schema)
    assert language_id.identify_languages(unlabelled).first()["lang_pred"] == "und"


def test_out_of_place_distance_equals_definition():
    profiles = {"a": [5, 9, 2, 7], "b": [7, 2, 11]}
    model = language_id.Profiles(profiles, 4)
    own = np.array([2, 5, 13])
    for column, language in enumerate(model.languages):
        want = sum(abs(profiles[language].index(g) - i) if g in profiles[language] else 4 for i, g in enumerate(own))
        at = np.searchsorted(model.codes, own)
        ranks = [model.ranks[x, column] if x < len(model.codes) and model.codes[x] == g else -1 for x, g in zip(at, own)]
        assert want == sum(4 if r < 0 else abs(r - i) for i, r in enumerate(ranks))


def test_language_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = catalog.QUERIES["op5_language_id"](spark, folder).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held) > 0


def plain_kneser_ney(grams):
    """Probabilities of seen n-grams by the textbook recursion over dicts."""
    orders = {quality.ORDER: dict(grams)}
    for order in range(quality.ORDER - 1, 0, -1):
        orders[order] = {}
        for gram in orders[order + 1]:
            suffix = gram % quality.SYMBOLS**order
            orders[order][suffix] = orders[order].get(suffix, 0) + 1
    below, result = None, {}
    for order in range(1, quality.ORDER + 1):
        counts = orders[order]
        n = [max(1, sum(c == i for c in counts.values())) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        discount = [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]
        total, rest = {}, {}
        for gram, count in counts.items():
            context = gram // quality.SYMBOLS
            total[context] = total.get(context, 0) + count
            rest[context] = rest.get(context, 0) + discount[min(count, 3) - 1]
        p = {}
        for gram, count in counts.items():
            context = gram // quality.SYMBOLS
            lower = 1 / quality.SYMBOLS if order == 1 else below[gram % quality.SYMBOLS ** (order - 1)]
            p[gram] = (count - discount[min(count, 3) - 1] + rest[context] * lower) / total[context]
        below = result[order] = p
    return result


def test_kneser_ney_tables_equal_textbook_and_sum_to_one(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcab d") for _ in range(4000))
    texts = spark.createDataFrame([(text,), ("",), ("d a b",)], "text string")
    model = quality.fit(texts)
    symbols = quality.symbol_table(model.alphabet)
    counts = {}
    for t in (text, "", "d a b"):
        for piece in quality.gram_codes(t, symbols):
            for code in piece.tolist():
                counts[code] = counts.get(code, 0) + 1
    want = plain_kneser_ney(counts)
    for order in range(1, quality.ORDER + 1):
        grams, p = model.probabilities[order - 1]
        assert dict(zip(grams.tolist(), p.tolist())) == pytest.approx(want[order])
    sums = np.exp(model.logs()).reshape(-1, quality.SYMBOLS).sum(axis=1)
    assert np.abs(sums - 1).max() < 1e-9


def test_long_text_in_pieces_gives_the_same_grams(monkeypatch):
    symbols = quality.symbol_table([ord(c) for c in "abc"])
    text = "ab  c\n\nzz a" * 50
    whole = np.concatenate(list(quality.gram_codes(text, symbols)))
    monkeypatch.setattr(quality, "PIECE", 7)
    assert np.array_equal(whole, np.concatenate(list(quality.gram_codes(text, symbols))))


def test_quality_rows(spark):
    good = [(i, f"the cat sat on the mat and the dog ran {i}", "en") for i in range(40)]
    odd = [(100, "#$%^&*()#$%^&*()", "en"), (101, None, "en"), (102, "", None), (103, "the cat sat", None), (None, "the dog", "xx")]
    docs = spark.createDataFrame(good + odd + good[:1], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.judge_quality(docs, labels, quantile=1.0, rare_quantile=1.0).collect()
    assert len(rows) == 46
    keep = {r["doc_id"]: r["keep"] for r in rows}
    assert all(keep[i] for i in range(40)) and not keep[100] and not keep[101] and not keep[102]
    empty = spark.createDataFrame([], docs.schema)
    assert quality.judge_quality(empty, labels).count() == 0
    unjudged = quality.judge_quality(docs, labels.where("quality = 7")).collect()
    assert len(unjudged) == 46 and all(r["keep"] and r["perplexity"] is None for r in unjudged)


def test_quality_sees_a_few_odd_words_in_a_good_text(spark):
    """Rare characters are counted by brute force; they tell what the perplexity of the whole text does not."""
    rng = random.Random(9)
    prose = ["".join(rng.choice(["the ", "an ", "her ", "tin ", "one ", "ate "]) for _ in range(300)) for _ in range(200)]
    foul = prose[0][:600] + "qwyx kqvz zzkq vyqx xkwq " + prose[0][600:]
    rows = [(i, text, "en") for i, text in enumerate(prose)] + [(500, foul, "en"), (501, prose[1], "de"), (502, foul, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(prose))], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in quality.judge_quality(docs, labels, rare_quantile=1.0).collect()}
    assert not found[500]["keep"] and not found[502]["keep"] and found[501]["keep"]
    assert all(found[i]["rare_share"] <= found[i]["rare_threshold"] for i in range(len(prose)))

    model = quality.fit(docs.where("doc_id < 200").select("text"))
    symbols, logs = quality.symbol_table(model.alphabet), model.logs()
    codes = [c for piece in quality.gram_codes(foul, symbols) for c in piece.tolist()]
    assert found[500]["rare_share"] == sum(logs[c] < -np.log(quality.ODDS) for c in codes) / len(codes)
    assert found[500]["n_symbols"] == len(codes)


def test_quality_counts_every_trusted_document(spark, monkeypatch):
    """More trusted documents than the 20,000 the model was once thinned to, and runs of a few n-grams."""
    monkeypatch.setattr(quality, "RUN", 1000)
    fitted, fit_tables = [], quality.fit_tables
    monkeypatch.setattr(quality, "fit_tables", lambda grams: fitted.append(grams.agg(F.sum("n")).first()[0]) or fit_tables(grams))
    docs = spark.range(25_000).selectExpr("id AS doc_id", "concat('doc ', id) AS text", "'en' AS lang")
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    rows = quality.judge_quality(docs, labels)
    assert fitted == [rows.agg(F.sum("n_symbols")).first()[0]]


def test_quality_query_matches_sql(spark, duck, folder):
    ours = catalog.QUERIES["op3_quality"](spark, folder)
    cursor = duck.execute(catalog.SQL["op3_quality"])
    names = [d[0] for d in cursor.description]
    theirs = {r[0]: r for r in cursor.fetchall()}
    found = ours.select(*names).collect()
    assert len(found) == len(theirs)
    for row in found:
        for ours_value, value in zip(row, theirs[row["doc_id"]]):
            assert ours_value == (pytest.approx(value, rel=1e-6) if isinstance(value, float) else value)


def test_quality_query_parts_good_from_bad(spark, folder):
    """Clean are documents of quality 1 that are not toxic; insults stand in English documents only."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = catalog.QUERIES["op3_quality"](spark, folder).join(labels, "doc_id")

    def kept(condition):
        return rows.where(condition).agg(F.avg(F.col("keep").cast("int"))).first()[0]

    assert kept("quality = 1 AND toxic = 0") > 0.95
    assert kept("quality = 0") < 0.5
    assert kept("quality = 1 AND toxic = 1 AND lang = 'en'") < 0.5
