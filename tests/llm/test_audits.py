"""Operators 11 to 13 against plain versions."""

import collections
import hashlib
import re

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardline.llm import divergence, html_text, merkle

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def plain_fold(levels, i, node):
    siblings = []
    for level in levels[:-1]:
        run = level[i // 3 * 3 : i // 3 * 3 + 3]
        siblings += run[: i % 3] + run[i % 3 + 1 :]
        run[i % 3] = node
        node, i = digest(*run), i // 3
    return siblings, node


def plain_audit(rows, tampered):
    """Rows of ``DOCS``; ``tampered`` gives a row's other text."""
    of = collections.defaultdict(list)
    for r in rows:
        of[r[1]].append((r[0], digest(*map(field, r)), digest(*map(field, (*r[:4], tampered(r))))))
    names = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        of[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: plain_tree([x[1] for x in of[s]]) for s in names}
    top = plain_tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (doc_id, leaf, other) in enumerate(of[s]):
            low, node = plain_fold(trees[s], i, other)
            high, node = plain_fold(top, k, node)
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], digest(*low, *high), node, node == top[-1][0]))
    return out


def test_states_equal_the_library():
    parts = [hashlib.sha256(b"%d" % i) for i in range(6)]
    words = np.frombuffer(b"".join(p.digest() for p in parts), ">u4").astype(np.uint32).reshape(-1, 8)
    built = merkle.levels_over(np.array([4, 2]), words, np.array([True, True]))
    for own, top in ((parts[:4], 0), (parts[4:], 1)):
        levels = plain_tree([p.hexdigest() for p in own])
        level = len(levels) - 1
        at = built.starts(level)[top]
        assert merkle.hex_text(built.digests[level])[at].tobytes().decode() == levels[-1][0]
    # The state before the second slot is that of a hash that took in the first child alone.
    resumed = merkle.close(merkle.take(built.states[0][:1, 0], words[1:2]), np.array([2]))
    assert merkle.hex_text(resumed)[0].tobytes().decode() == digest(parts[0].hexdigest(), parts[1].hexdigest())


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (3, 4, 1), (729, 730, 2188), (0,)])
def test_folds_equal_a_plain_tree(spark, sizes):
    """Sources of one chunk and of several, hot ones and lone leaves."""
    rows = [(i, f"s{k}", "en", 5, f"text {i}\nof {k}") for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    out = merkle.audit(docs, F.when(F.col("doc_id") % 3 == 0, F.lit("other")).otherwise(F.col("text")))
    wanted = plain_audit(rows, lambda r: "other" if r[0] % 3 == 0 else r[4])
    assert sorted(map(tuple, out.collect())) == sorted(wanted)


def test_more_sources_than_a_chunk_has_nodes(spark):
    rows = [(i, f"s{i}", None, None, None) for i in range(800)] + [(5, None, "de", 1, ""), (None, "", "de", 1, "x")]
    out = merkle.audit(spark.createDataFrame(rows, DOCS), F.when(F.col("doc_id") == 7, "new").otherwise(F.col("text")))
    wanted = plain_audit(rows, lambda r: "new" if r[0] == 7 else r[4])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(wanted, key=str)
    assert out.where("NOT verified").select("doc_id").collect() == [(7,)]


def test_manifest_takes_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    out = merkle.audit(odd_docs, F.col("text"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(plain_audit(rows, lambda r: r[4]), key=str)
    assert out.where("NOT verified").isEmpty()
    assert merkle.audit(no_docs, F.col("text")).collect() == []


TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain_counts(rows, least):
    """(lang, source, text) rows: counts by group, kept terms by language."""
    counts, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = ["".join(c.lower() if c.isascii() else c for c in t) for t in TERM.findall(text or "")]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    return counts, {lang: {t for t, n in own.items() if n >= least} for lang, own in docs.items()}


def plain_divergence(rows, least, top):
    counts, kept = plain_counts(rows, least)
    out = []
    for lang, terms in kept.items():
        v = len(terms)
        groups = [s for g, s in counts if g == lang]
        totals = {s: sum(counts[lang, s][t] for t in terms) for s in groups}

        def price(c, n):
            return 1 + 10**9 * (c + 5) // (n + 5 * v)

        p = {s: {t: price(counts[lang, s][t], totals[s]) for t in terms} for s in groups}
        q = {t: price(sum(counts[lang, s][t] for s in groups), sum(totals.values())) for t in terms}
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in terms)) for o in groups if o != s]
            over = [(t, p[s][t] - q[t]) for t in terms if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", over, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return out


def made_up(n_sources, n_docs, seed=1):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n_docs):
        lang = ("en", "de", None)[int(draw.integers(3))]
        # A third of all rows in one source.
        source = "hot" if i % 3 == 0 else f"s{int(draw.integers(n_sources))}"
        words = [f"w{chr(97 + int(k) % 26)}{'é' * (int(k) // 26 % 3)}" if k < 60 else "Über" for k in draw.zipf(1.3, 20)]
        rows.append((lang, source, " ".join(words)))
    return [*rows, ("en", None, None), ("xx", "s1", "1 2 3"), ("xx", "s2", None), ("yy", "s1", "alone")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, value bigint, term bigint")


@pytest.mark.parametrize("n_sources, least", [(3, 2), (40, 5)])
def test_divergence_equals_a_plain_version(spark, n_sources, least):
    rows = made_up(n_sources, 400)
    out = divergence.audit(frame(spark, rows), least_docs=least, top_terms=4)
    assert sorted(map(tuple, out.collect())) == sorted(plain_divergence(rows, least, 4))


def test_joint_tables_hold_every_kept_term(spark):
    rows = made_up(10, 300, seed=2)
    counts, kept = plain_counts(rows, 3)
    got = {tuple(r) for r in divergence.joint_tables(divergence.count_terms(frame(spark, rows), 3)).collect()}
    wanted = collections.Counter()
    for lang, a in counts:
        for other, b in counts:
            if lang == other and a.encode() < b.encode():
                wanted.update((lang, a, b, counts[lang, a][t], counts[lang, b][t]) for t in kept[lang])
    assert got == {(*k, n) for k, n in wanted.items()}


def test_prices_are_exact_beyond_a_long(spark):
    row = spark.sql("SELECT 90000000000000001L AS c, 90000000000000007L AS n, 3L AS v").select(divergence.price(F.col("c"), F.col("n"), F.col("v")))
    assert row.first()[0] == 1 + 10**9 * (90000000000000001 + 5) // (90000000000000007 + 15)


def test_divergence_takes_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    out = divergence.audit(odd_docs, least_docs=2)
    assert sorted(map(tuple, out.collect())) == sorted(plain_divergence(rows, 2, divergence.TOP_TERMS))
    assert divergence.audit(no_docs).collect() == []


P = "Words of the article, in a sentence. And more of them; so it goes on, and on."
PAGES = {
    "parts": (
        f"<html><head><title>No</title><style>p{{}}</style></head><body class='has-sidebar'><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>"
        f"<div id=cookie-notice>We use cookies. Accept, please.</div><div class='content'><h1>Title</h1><p>{P}</p><ul><li>one item</li>"
        f"<li>two items</ul><table><tr><td>cell<td>next</table><form><label>Mail</label><input><button>Go</button></form><aside>Read also.</aside>"
        f"<p>{P}</div><section id=comments><h2>Comments</h2><article>{P * 9}</article></section><footer>&copy; all</footer></body></html>",
        f"Title {P} one item two items cell next {P}",
    ),
    "article header": (
        f"<body><main><article><header><h1>T</h1><p>By me</p></header><section><h2>A</h2><p>{P}</p></section><section><h2>B</h2><p>{P}<p>x</section>"
        f"<div class='share'><a href=x>Share</a></div><footer>End</footer></article><div class=sidebar><p>{P * 2}</p></div></main></body>",
        f"T By me A {P} B {P} x",
    ),
    "no containers": (f"<div><a href=1>a</a> <a href=2>b</a></div><h1>Title</h1><p>{P}<p>{P}<p>x<div class=advert>Buy now!</div>", f"Title {P} {P} x"),
    "form around all": (f"<body><form id=aspnetForm><div class=menu><a href=1>x</a></div><div id=main><h2>H</h2><p>{P}</p></div></form>", f"H {P}"),
    "layout by table": (f"<table><tr><td><a href=1>m1</a><br><a href=2>m2</a></td><td><p>{P}</p><p>{P}</p></td></tr></table>", f"{P} {P}"),
    "tiny article": (f"<div class=ad>{P}</div><article><h1>Von.</h1><p>Von.</p></article>", "Von. Von."),
    "deep": (f"<article><div><div><p>{P}</p><div><ul><li><ul><li><p>deep</p></li></ul></li></ul></div></div></div></article>", f"{P} deep"),
    "references": ("<p>1 &lt; 2 &amp;&amp; 3&nbsp;4 \n\t&#8364; fo<b>o</b>bar</p><!-- <p>no</p> --><p>a<br>b", "1 < 2 && 3 4 € foobar a b"),
    "raw text": (f"<script>if (a<b) x='</p>'</script><noscript>Enable</noscript><textarea><p>t</textarea><p>{P}</p><script>open", P),
    "unclosed quote": ("<p a='x>oops</p><p>z", "oops z"),
    "text alone": ("just words", "just words"),
    "menu alone": ("<nav><a href=1>x</a></nav>", ""),
    "nothing": ("", ""),
    "null": (None, ""),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_main_text(name):
    source, wanted = PAGES[name]
    assert html_text.main_text(source) == wanted


def test_pages_of_the_tables(spark, sf):
    """Against the article element of each given page."""
    from html import unescape

    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = entry.queries()["op12_html_text"](spark, sf).collect()
    assert len(out) == len(pages)
    for r in out:
        own = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = re.split("<(?!/?b>)[^>]+>", own)
        wanted = " ".join(" ".join(unescape(re.sub("</?b>", "", x)).split()) for x in blocks if x.strip())
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, wanted, len(wanted))


def test_extraction_takes_odd_rows(spark):
    rows = [(None, None, None, 1), (1, "u", "", 1), (1, "u", "", 1), (2, "v", "<p>" * 5_000 + "x" * 200_000, 1), (3, "w", "<div>" * 3_000 + P, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text bigint")
    out = [tuple(r) for r in html_text.extract(pages).collect()]
    wanted = [(None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0), (2, "v", "x" * 200_000, 200_000), (3, "w", P, len(P))]
    assert sorted(out, key=str) == sorted(wanted, key=str)
    assert html_text.extract(pages.limit(0)).collect() == []
    blocks = html_text.content_blocks(pages).where("page_id = 3").collect()
    assert len(blocks) == 1 and blocks[0].chosen and blocks[0].path.startswith("/div/div")


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_merkle_manifest"])
def test_queries_equal_sql_where_ids_and_texts_are_odd(spark, fresh_dir, odd_docs, name):
    odd_docs.select("doc_id", "source", "lang", "n_chars", "text").write.parquet(f"{fresh_dir}/documents.parquet")
    connection = compare.duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{fresh_dir}/documents.parquet/*.parquet')")
    got = entry.queries()[name](spark, fresh_dir)
    wanted = connection.sql(entry.oracle_sql()[name])
    order = [wanted.columns.index(c) for c in got.columns]
    right = sorted((tuple(r[i] for i in order) for r in wanted.fetchall()), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == right
