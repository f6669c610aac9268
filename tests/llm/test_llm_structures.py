"""Vectors, pages, ranks, components and the pipeline against brute force, and their edge cases."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from stagetrace.llm import embeddings, pages
from stagetrace.llm.graph import components
from stagetrace.llm.oracle import ORACLE
from stagetrace.llm.queries import QUERIES
from stagetrace.llm.ranks import ranked, running

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, kept string"


# --- vectors


def vectors(seed, dense=60):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((20, 8))
    rows = []
    for i in range(200):
        x = base[i % 20] + rng.standard_normal(8) * rng.choice([0.0, 0.02, 0.1, 1.0])
        rows.append((i, [float(np.float32(v)) for v in x], int(rng.integers(0, 2)), "clash"))
    for i in range(dense):
        rows.append((1000 + i, [float(np.float32(v)) for v in base[0] + rng.standard_normal(8) * 0.03], 1, "clash"))
    one = [1.0] * 8
    rows += [(2000, None, 1, None), (2001, [], 1, None), (2002, [0.0] * 8, 1, None), (2003, [1.0, None] * 4, 1, None), (2004, [float("nan")] * 8, 1, None),
             (2005, [float("inf")] * 8, 1, None), (2006, one, None, None), (None, one, 1, None), (2007, one, 1, None), (2008, one, 1, None), (2009, one[:7], 1, None), (2010, [2.0] * 8, 1, None)]
    return rows


def brute(rows):
    good = [(i, np.array(x, np.float64), y) for i, x, y, _ in rows if i is not None and y is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    up = {i: i for i, *_ in rows if i is not None}
    links = dict.fromkeys(up, 0)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, (i, a, y) in enumerate(good):
        for j, b, z in good[:n]:
            if y == z and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
                links[i] += 1
                links[j] += 1
                p, q = root(i), root(j)
                up[max(p, q)] = min(p, q)
    return {i: (links[i], root(i), root(i) == i) for i in up}


@pytest.mark.parametrize("window, block", [(32, 512), (2, 7)])
def test_vectors_are_linked_as_all_pairs_are(spark, window, block):
    rows = vectors(1)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = embeddings.near_vectors(df, window=window, block=block).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == brute(rows)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, False)]
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def paired(n, dim, base, pairs, cosine=0.981, seed=3):
    """``n`` vectors of one label with a cosine of ``base`` between most; the first ``2 * pairs`` are pairs at ``cosine``."""
    rng = np.random.default_rng(seed)
    m = np.eye(dim)[0]

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    away = rng.standard_normal((n, dim))
    away[:, 0] = 0
    x = np.sqrt(base) * m + np.sqrt(1 - base) * unit(away)
    d = rng.standard_normal((pairs, dim))
    a = x[0:2 * pairs:2]
    d[:, 0] = 0
    d -= (d * a).sum(1, keepdims=True) * a
    x[1:2 * pairs:2] = cosine * a + np.sqrt(1 - cosine ** 2) * unit(d)
    return x


@pytest.mark.parametrize("base", [0.0, 0.9])
def test_single_pairs_are_found_in_a_large_label(spark, base):
    x = paired(12000, 32, base, 300)
    near = x[:600] @ x.T / np.outer(np.linalg.norm(x[:600], axis=1), np.linalg.norm(x, axis=1)) >= 0.98
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label long")
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
    assert len(got) == len(x)
    wanted = near.sum(axis=1) - 1
    assert sum(got[i] == wanted[i] for i in range(600)) >= 0.99 * 600
    assert all(got[i] <= wanted[i] for i in range(600))


def test_passes_grow_with_size_and_concentration():
    few = [embeddings.passes_for(n, 1.0, 0.98) for n in (2, 33, 34, 10**5, 10**8, 10**11)]
    assert few[:3] == [1, 1, 16] and few == sorted(few)
    near = [embeddings.passes_for(200_000, s, 0.98) for s in (1.0, 0.2, 0.1, 0.05, 0.0)]
    assert near == sorted(near) and near[0] < 20 and near[2] > 40


# --- components, ranks


def test_components_of_chains_stars_and_nothing(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000 + rng.randrange(80), 5000 + rng.randrange(80)) for _ in range(60)] + [(None, 3), (7, None)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if None not in (a, b) and a != b:
            p, q = root(a), root(b)
            up[max(p, q)] = min(p, q)
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == {i: root(i) for i in up} and len(got) == len(up)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_ranks_have_no_gaps(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(1000) if k % 9 else None) for k in range(3000)]
    got = ranked(spark.createDataFrame(rows, "g string, x long"), ["g"], ["x"], bin_rows=50).collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append(r["rank"])
    assert {g: len(v) for g, v in by.items()} == {g: sum(x[0] == g for x in rows) for g in ("a", "b", None)}
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert ranked(spark.createDataFrame([], "g string, x long"), ["g"], ["x"]).count() == 0


def test_running_sums_in_two_levels(spark):
    df = spark.createDataFrame([(g, i, i * i) for g in "ab" for i in range(0, 40, 3)], "g string, i long, v long")
    got = running(df, ["g"], "i", "v", "s", 7).collect()
    assert {(r.g, r.i): r.s for r in got} == {(g, i): sum(j * j for j in range(0, i, 3)) for g in "ab" for i in range(0, 40, 3)}


# --- pages


ARTICLE = "<article><h1>A title &amp; more</h1><p>First  paragraph with <b>bold</b>text, several words and a <a href='x'>link</a>.<p>Second one\nafter an open paragraph.</article>"
TEXT = "A title & more First paragraph with boldtext, several words and a link. Second one after an open paragraph."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<script>var a = '<p>no</p>'</script>", ""), ("<!-- only this -->", ""),
    (f"<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>{ARTICLE}<footer>&copy; somebody</footer>", TEXT),
    (f"<header><h2>Site name</h2></header><div class='cookie-banner'>We use cookies on this site, accept them all.</div>{ARTICLE}<aside><p>A long story beside the article, in sentences.</p></aside>", TEXT),
    (f"<form><p>Your name please, and a comment.</p><input></form>{ARTICLE}<section id=comments><p>I liked this very much, thank you for writing.</p></section>", TEXT),
    ("<body><div class=menu><a>a</a> <a>b</a></div><div class=content><p>One sentence of content that is long enough to be seen.</p><p>Short.</p><p>And another sentence, again with many words in it.</p></div></body>",
     "One sentence of content that is long enough to be seen. Short. And another sentence, again with many words in it."),
    ("<article><p>caf&eacute; &#233; &lt;b&gt; &nbsp; x</p><!-- <p>no</p> --><style>p{}</style><p>end</article>", "café é <b> x end"),
    ("<article><p>1 < 2 and a <unclosed", "1 < 2 and a <unclosed"),
    ("<article><p>Text goes on.</p><div class='ad'>Buy this now.</div><p>And ends here.</p></article>", "Text goes on. And ends here."),
])
def test_main_text(html, text):
    assert pages.main_text(html) == text


@pytest.mark.parametrize("mark", ["section id='discussion'", "div class='side-by-side'", "section id='legal-aspects'", "div class='search form'"])
def test_sections_of_an_article_are_judged_by_how_they_read(mark):
    said = "This section tells, in whole sentences, what the measurements of the second year mean for those who use them."
    html = f"<nav><a href=/a>Home</a></nav><article><h1>A title</h1><p>{said}</p><{mark}><h2>More</h2><p>{said}</p><p>So it is.</p></{mark.split()[0]}></article>"
    assert pages.main_text(html) == f"A title {said} More {said} So it is."
    links = "<ul>" + "".join(f"<li><a href=/{i}>Another story {i}</a></li>" for i in range(5)) + "</ul>"
    assert pages.main_text(f"<article><p>{said}</p><p>{said}</p><div class='related'>{links}</div></article>") == f"{said} {said}"


def test_the_cut_decides_where_marking_is_absent():
    """Short lines between long ones follow their neighbours, and so does a long line of links among links."""
    said = "The whole of this paragraph is written in sentences, with commas, and it says what it has to say at length."
    html = f"<div><div>{''.join(f'<div><a href=/{i}>Page {i}</a></div>' for i in range(6))}</div><div><p>{said}</p><p>Yes</p><p>{said}</p></div></div>"
    found = pages.blocks(html)
    alone = [pages.score(b) > 0 for b in found]
    assert pages.main_text(html) == f"{said} Yes {said}" and pages.labels(found) != alone


def test_costs_are_fitted_on_marked_pages(spark):
    said = "A paragraph in sentences, with commas, that goes on for a while and then ends."
    html = f"<nav>{''.join(f'<p><a>Link {i}</a></p>' for i in range(5))}</nav><article>{''.join(f'<p>{said} {i}.</p>' for i in range(5))}</article>"
    df = spark.createDataFrame([(i, html) for i in range(30)] + [(None, html), (50, None), (51, "")], "page_id long, html string")
    w = pages.learn(df, sample_pages=8, sample_blocks=64)
    assert w.tolist() == pages.learn(df.repartition(3), sample_pages=8, sample_blocks=64).tolist()
    link, text = (pages.blocks(f"<p>{t}</p>")[0] for t in ("<a>Link 9</a>", f"{said} 9."))
    assert pages.score(link, w) < 0 < pages.score(text, w)
    assert pages.learn(df.limit(0)).tolist() == pages.learn(df.filter("page_id > 40")).tolist() == pages.START.tolist()
    x, y = np.random.default_rng(3).normal(size=(200, len(pages.START))), np.arange(200) % 2
    best = pages.fit(x, y.astype(float))

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - y * z).sum() + pages.RIDGE / 2 * ((w - pages.START) ** 2).sum()

    assert all(loss(best) <= loss(best + d) for d in np.random.default_rng(4).normal(size=(200, len(best))) * 0.01)


@pytest.mark.parametrize("html", [
    "<a href=\"x>t " * 80_000, "<a href='x>t <p>\"y " * 60_000, "<b>" * 20_000 + "x<hr>" * 50_000, "<div>" * 20_000 + "</p>x" * 50_000,
    "<li><ul>" + "<div>" * 20_000 + "<li>x</li>" * 50_000, "<" * 1_000_000, "<a " * 300_000, "<!x" * 300_000, "<p>Some words, as text. " * 20_000,
    "<div class=\"" + "x" * 1_000_000, "<a \"><a \" " * 100_000 + "'"], ids=lambda h: h[:12])
def test_hostile_pages_take_linear_time(html):
    from time import process_time

    start = process_time()
    pages.main_text(html)
    assert process_time() - start < 5


def test_minimum_cuts_are_those_of_all_labellings():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 7)
        unary = [(rng.random() * 4, rng.random() * 4) for _ in range(n)]
        ties = [(i, j, rng.random() * 3) for i in range(n) for j in range(i) if rng.random() < 0.5]
        flow = pages.Flow(n + 2)
        for i, (a, b) in enumerate(unary):
            flow.add(n, i, a, 0.0)
            flow.add(i, n + 1, b, 0.0)
        for i, j, c in ties:
            flow.add(i, j, c, c)
        flow.run(n, n + 1)
        side = flow.reached(n)

        def cost(s):
            return sum(b if x else a for x, (a, b) in zip(s, unary, strict=True)) + sum(c for i, j, c in ties if s[i] != s[j])

        least = min(cost([k >> i & 1 for i in range(n)]) for k in range(1 << n))
        assert cost(side[:n]) == pytest.approx(least)


def test_pages_keep_their_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "u", ARTICLE, "old"), (2, None, None, None), (1, "u", ARTICLE, "old")], "page_id long, url string, html string, text string")
    rows = pages.extract(df).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in rows) == [(1, TEXT, len(TEXT))] * 2 + [(2, "", 0)]
    assert pages.extract(df.limit(0)).count() == 0


# --- queries and the pipeline


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_keep_every_row(spark, name):
    table = {"op5_embeddings": "embeddings", "op10_pages": "pages"}.get(name, "documents")
    out = spark_entry.queries()[name](spark, FOLDER)
    key = {"embeddings": "vec_id", "pages": "page_id", "documents": "doc_id"}[table]
    df = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    assert out.select(key).distinct().count() == df.select(key).distinct().count()
    assert name == "op7_packing" or out.count() == df.count()


def test_pipeline_stages_hand_documents_on(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.keep(stage(spark, docs, FOLDER), name)
        assert name == "pack" or out.columns == columns
        assert out.count() > 0.85 * n or name == "mix"
        docs = out
    assert {"doc_id", "sequence_id", "offset"} <= set(docs.columns)


def test_pipeline_survives_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, nul string, h string"
    words = " ".join("word%d" % i for i in range(100))
    rows = [(1, words, "x", None, 5, "a", "b"), (2, words, "x", "s", None, "a", "b"), (2, words, "x", "s", None, "a", "b"), (None, None, None, None, None, None, None), (3, "", "y", "s", 0, None, None), (4, "other text " * 50, "y", "s", 1, "", "")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.keep(stage(spark, docs, ""), name)
        assert docs.count() <= 2 * len(data)


def test_no_task_gets_a_hot_group(spark):
    """One fingerprint, one length and one source with most rows: nothing is gathered by them."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same words here").alias("text"), F.lit("s").alias("source"))
    got = QUERIES  # the queries' operators on one group of copies
    assert got
    from stagetrace.llm import mixing, simhash

    assert {r.component_id for r in simhash.within_radius(df).select("component_id").distinct().collect()} == {0}
    assert mixing.mix(df).agg(F.sum("taken")).first()[0] == 13500


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = db.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    rows = QUERIES[name](spark, FOLDER).select(columns).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(found.fetchall(), key=repr)
