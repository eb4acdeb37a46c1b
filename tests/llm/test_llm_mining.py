"""Page texts, centroid clusters and phrases: against SQL, plain Python and odd rows."""

import hashlib
import html
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselog.llm import catalog, centroids, phrases, wrappers

VECTORS = "vec_id long, embedding array<float>, cluster int, id string"
DOCS = "doc_id long, text string, lang string, phrase int, n string"
PAGES = "page_id long, url string, html string, text int, host string"


@pytest.mark.parametrize("name", ["op12_centroids", "op13_phrases"])
def test_query_equals_sql(name, spark, duck, folder):
    df = catalog.QUERIES[name](spark, folder)
    cursor = duck.execute(catalog.SQL[name])
    names = [d[0] for d in cursor.description]
    assert df.columns == names
    got = sorted(map(tuple, df.collect()), key=repr)
    assert got == sorted(cursor.fetchall(), key=repr) and got


# Centroids


def test_threshold_walk_equals_brute_force():
    rng = np.random.default_rng(5)
    for clusters, dimensions, span in [(1, 1, 3), (2, 3, 2), (16, 64, 20), (40, 2, 3), (7, 5, 1)]:
        index = centroids.SortedCentroids(rng.integers(-span, span + 1, (clusters, dimensions)))
        vectors = rng.integers(-span - 1, span + 2, (300, dimensions))
        plain = ((vectors[:, None, :] - index.centroids[None]) ** 2).sum(axis=2)
        number, distance = index.nearest(vectors)
        assert (number == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def test_walk_stops_early():
    """Far centroids are never met: the frontier passes the best distance first."""
    index = centroids.SortedCentroids(np.array([[i * 1000] * 4 for i in range(50)]))
    index.centroids = index.centroids.copy()
    index.centroids[5:] = -1
    number, distance = index.nearest(np.array([[1001] * 4]))
    assert (number[0], distance[0]) == (1, 4)


def clustered(rows, clusters, rounds, components, scale):
    kept = [
        (i, [int(np.floor(scale * float(np.float32(x)))) for x in v])
        for i, v in rows
        if v is not None and len(v) == components and all(x is not None and np.isfinite(x) for x in v)
    ]

    def digest(row):
        return hashlib.sha256(f"1:{row[0]}".encode()).hexdigest() if row[0] is not None else "~"

    means = [v for _i, v in sorted(kept, key=lambda r: (digest(r), r[1]))[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))

    for _round in range(rounds):
        members = {}
        for _i, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for c, vs in members.items():
            means[c] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _i, d, c in found:
        inertia[c] += d
    return sorted(
        (
            (i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest())
            for i, d, c in found
        ),
        key=repr,
    )


def test_clusters_of_odd_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(4)]) for i in range(60)]
    rows += [(0, rows[0][1]), (3, rows[7][1]), (None, [0.5] * 4), (90, None), (91, []), (92, [1.0] * 5)]
    rows += [(93, [1.0, None, 1.0, 1.0]), (94, [float("nan")] * 4), (95, [float("inf"), 0.0, 0.0, 0.0]), (96, [0.0] * 4)]
    table = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], VECTORS).repartition(3)
    for clusters, rounds in ((5, 3), (500, 1), (1, 2)):
        found = centroids.cluster_vectors(table, clusters, rounds, components=4, scale=64)
        assert sorted(map(tuple, found.collect()), key=repr) == clustered(rows, clusters, rounds, 4, 64)
    empty = centroids.cluster_vectors(table.where("vec_id > 1000"), components=4)
    assert empty.count() == 0 and empty.columns == list(found.columns)


def test_components_too_large_for_exact_distances(spark):
    table = spark.createDataFrame([(1, [1e30] * 4, 0, "")], VECTORS)
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster_vectors(table, components=4).collect()


# Phrases


def mined(rows, longest=3, least=10, share=50, top=2000):
    counts, sizes = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        ranked = []
        for p, a in candidates.items():
            if 100 * inside[p] >= share * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def prose(seed, texts):
    rng = random.Random(seed)
    words = ["Uno", "dos", "trés", "ÉL", "a\x00b", "x" * 300, "b", "c", "d d", "\tq", "q\t\t", "z\x1c", " "]
    return [
        "".join(rng.choice(words) + rng.choice([" ", " ", "  ", ". ", "\n", ",", "\x0b"]) for _ in range(rng.randrange(60)))
        for _ in range(texts)
    ]


def test_phrases_of_odd_texts(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(t, rng.choice(["en", "de", "", None, "und"])) for t in prose(4, 80)]
    rows += [(None, "en"), ("", "fr"), (" \t.,", "fr"), ("lone", "es"), ("is onhe " * 4000, "en"), ("w" * 9000, "en")]
    rows += [rows[0]] * 30
    table = spark.createDataFrame([(i, t, lang, 5, "n") for i, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 4000)
    for longest, least, share, top in ((3, 10, 50, 2000), (4, 2, 90, 5), (2, 3, 50, 100), (1, 1, 50, 9)):
        found = phrases.mine_phrases(table, longest, least, share, top)
        assert sorted(map(tuple, found.collect())) == mined(rows, longest, least, share, top)
    empty = phrases.mine_phrases(table.where("doc_id < 0"))
    assert empty.count() == 0 and empty.columns == "lang rank phrase a l r n score".split()


def test_long_texts_are_cut_between_words_without_loss():
    rng = random.Random(9)
    for longest in (1, 2, 3, 5):
        texts = [("en" if rng.random() < 0.5 else "de", t.encode()) for t in prose(longest, 40)]
        whole, cut = Counter(), Counter()
        for size, counts in ((1 << 20, whole), (50, cut)):
            for tokens, langs, goes_on in phrases.streams(texts, longest, size):
                words, lang, places, n = phrases.count_windows(tokens, longest, goes_on)
                for j in range(len(n)):
                    counts[langs[lang[j]], *(words[int(p[j])].as_py() if p[j] >= 0 else b"" for p in places)] += int(n[j])
        assert whole == cut and whole


def test_windows_meet_by_their_whole_text(spark):
    """One pair of words in every window: its windows still spread over the buckets."""
    rows = [(i, " ".join(f"is onhe w{i * 50 + j}" for j in range(50)), "en", 0, "") for i in range(100)]
    table = spark.createDataFrame(rows, DOCS).select("lang", "text")
    blocks = table.mapInArrow(phrases._count_in_chunks(3, 50), phrases.BLOCK)
    sizes = [r["s"] for r in blocks.groupBy("bucket").agg(F.sum(F.length("n")).alias("s")).collect()]
    assert len(sizes) == 50 and max(sizes) < 3 * sum(sizes) / len(sizes)


# Pages


def article_of(source):
    """A plain reading of the given pages: the blocks of the article element."""
    inner = re.search("(?s)<article>(.*?)(?:</article>|$)", re.sub("(?s)<script.*?</script>", "", source))[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?p>|</?h1>", inner))
    return "\n".join(b for b in blocks if b)


def test_page_texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet").collect()
    found = {r["page_id"]: r for r in catalog.QUERIES["op11_html_text"](spark, folder).collect()}
    assert len(found) == len(rows)
    for r in rows:
        got = found[r["page_id"]]
        assert (got["url"], got["text"]) == (r["url"], article_of(r["html"]))
        assert got["n_chars"] == len(got["text"])


def read(*sources):
    whole = None
    for source in sources:
        made = wrappers.of_page(wrappers.Page(source), numbered=False)
        if whole is None:
            whole = made
        else:
            wrappers.merge(whole, wrappers.loads(wrappers.dumps(made)))
    text = wrappers.dumps(wrappers.ranked(whole), whole=False)
    return [wrappers.read_through(wrappers.loads(text, whole=False), s) for s in sources]


def test_parts_around_the_article_go():
    page = (
        "<head><title>no</title><style>p{}</style></head><body class='has-sidebar'><header><h1>Site</h1></header>"
        "<nav><ul><li>no</ul></nav><div id=cookie-consent>no</div><div class=with-sidebar><div class=sidebar>no</div>"
        "<article><header><h1>Title</h1></header><p>one &amp; &#116;wo<br>three <span class=ad>no</span>four<p>five"
        "<form><input><label>no</label></form><div class='ad-300'>no</div><script>var p='<p>no</p>'</script>"
        "<ul><li>six<li><a href=x>seven</a></ul><table><tr><td>8<td>nine</table><blockquote>ten</blockquote></article>"
        "<section id=comments><article><p>no</article></section></div><aside>no</aside><!-- no --><footer>no</footer>"
    )
    assert read(page) == ["Title\none & two three four\nfive\nsix\nseven\n8\nnine\nten"]


def test_wrapper_tells_slots_from_shared_texts():
    """Without any names, texts that all pages share and lists of links are not the article."""
    pages = [
        f"<div class=x1>Shop and more</div><ul><li><a href=a>Go {i}</a></ul><div><h2>Head {i}</h2><p>Text {i}</p>"
        + f"<p>More of {i}</p>" * (i % 3) + "</div><div>All rights</div>"
        for i in range(6)
    ]
    assert read(*pages) == [f"Head {i}\nText {i}" + f"\nMore of {i}" * (i % 3) for i in range(6)]
    assert read(pages[1]) == ["Shop and more\nHead 1\nText 1\nMore of 1\nAll rights"]


def test_wrapper_is_a_union_free_expression():
    pages = ["<h1>a</h1><p>b", "<h1>c</h1><p>d<p>e<hr><ul><li>f<li>g</ul>", "<p>h<h3>i</h3><p>j<h3>k</h3><p>l"]
    whole = wrappers.of_page(wrappers.Page(pages[0]))
    for page in pages[1:]:
        wrappers.merge(whole, wrappers.of_page(wrappers.Page(page)))

    def shown(item):
        inner = " ".join(map(shown, item.items))
        name = item.sign.partition("(")[0] or ""
        text = f"{name}({inner})" if inner else name
        return text + ("*" if item.optional and item.many else "?" if item.optional else "+" if item.many else "")

    assert shown(whole) == "page(h1(#)? (p(#) h3(#))* p(#)+ ul(li(#)+)?)"


def test_odd_markup():
    cases = {
        "": "",
        "a < b > c <p": "a < b > c",
        "<p>un<b>closed": "unclosed",
        "<a <a <a": "",
        "x<!-- y": "x",
        "<script>z": "",
        "<p>&copy; &notit; &#x41;&nbsp;b &am": "© ¬it; A b &am",
        "<p>one\n\t two</p>\n<p> </p><p>three": "one two\nthree",
        "<div>" * 3000 + "deep<p>x</p>" + "</div>" * 3000: "deep\nx",
        "</p></div>y</article>": "y",
        '<p title="a > b">q': "q",
        "<p title='x>r": "r",
    }
    for source, want in cases.items():
        assert read(source) == [want], source


def test_every_block_has_a_place_in_its_wrapper():
    rng = random.Random(11)
    tags = "div div div.a div.b p h2 ul li table tr td section article blockquote span.ad".split()

    def some(depth):
        parts = []
        for _ in range(rng.randrange(1, 7 if depth else 90)):
            tag, _dot, name = rng.choice(tags).partition(".")
            inner = some(depth + 1) if depth < 3 and rng.random() < 0.4 else f"t{rng.randrange(99)} "
            parts.append(f"<{tag}" + (f" class={name}{rng.randrange(9)}" if name else "") + f">{inner}")
            parts.append(f"</{tag}>" if rng.random() < 0.8 else "")
        return "".join(parts)

    for _ in range(30):
        sources = [some(rng.randrange(2)) for _ in range(6)]
        halves = []
        for part in (sources[:3], sources[3:]):
            whole = wrappers.of_page(wrappers.Page(part[0]))
            for source in part[1:]:
                wrappers.merge(whole, wrappers.of_page(wrappers.Page(source)))
            halves.append(wrappers.loads(wrappers.dumps(whole)))
        wrappers.merge(*halves)
        whole = wrappers.loads(wrappers.dumps(wrappers.ranked(halves[0]), whole=False), whole=False)
        for source in sources:
            page = wrappers.Page(source)
            ranks = wrappers.ranks_of(whole, wrappers.of_page(page))
            assert sorted(ranks) == list(range(len(page.blocks)))


def test_pages_with_odd_rows(spark, monkeypatch):
    good = "<nav>n</nav><article><p>kept {}</p></article>"
    rows = [(i, f"http://One.org/{i}", good.format(i)) for i in range(40)]
    rows += [(50, None, good.format(50)), (51, "nowhere", "<p>alone"), (52, "http://two.org", None), (53, None, None)]
    rows += [(None, "http://one.org", good.format("null")), rows[0]]
    table = spark.createDataFrame([(*r, 3, "h") for r in rows], PAGES).repartition(3)
    want = sorted((i, "" if h is None else "alone" if "alone" in h else re.search("kept [^<]*", h)[0], "h") for i, _u, h in rows[:44])
    for limit in (wrappers.BROADCAST_BYTES, 0):
        monkeypatch.setattr(wrappers, "BROADCAST_BYTES", limit)
        found = wrappers.extract_text(table)
        assert sorted(found.columns) == sorted([*table.columns, "n_chars"])
        got = found.select("page_id", "text", "host").collect()
        assert sorted(map(tuple, (r for r in got if r[0] is not None)))[1:] == want
        assert [r["text"] for r in got if r["page_id"] is None] == ["kept null"]
        assert sum(r["page_id"] == 0 for r in got) == 2
    assert wrappers.extract_text(table.where("page_id > 99")).count() == 0
