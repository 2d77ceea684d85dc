"""Language ID, quality, page text and top-k against brute force and labels."""
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionkit.llm import language_id as L
from sessionkit.llm import quality
from sessionkit.llm import queries as Q
from sessionkit.llm.html_text import Page, main_text
from sessionkit.llm.topk import SortedLists, top_k

SF = "/root/testdata/sf0.001"
PIECES = {p: i for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "aba", "ba", "▁ab"])}


def segmentations(word, lattices):
    if not word:
        return [[]]
    out = []
    for k in range(1, min(len(word), lattices.longest) + 1):
        i = lattices.pieces.get(word[:k], lattices.unknown if k == 1 else None)
        if i is not None:
            out += [[i] + rest for rest in segmentations(word[k:], lattices)]
    return out


def test_forward_and_expected_counts_equal_all_segmentations():
    lattices = L.Lattices(PIECES)
    probs = np.random.default_rng(0).random((len(PIECES) + 2, 3))
    probs[:-1] /= probs[:-1].sum(0)
    probs[-1] = 0
    words = ["▁abab", "▁a", "▁xab", "▁ababxaba", "▁bb", "▁"]
    cuts = [segmentations(w, lattices) for w in words]
    got = lattices.log_probs(words, probs)
    for g, c in zip(got, cuts):
        assert np.allclose(g, np.log(sum(np.prod(probs[s], axis=0) for s in c)))
    counts, out, want = np.arange(1.0, 7.0), np.zeros(len(probs)), np.zeros(len(probs))
    lattices.expected(words, counts, probs[:, 1], out)
    for c, n in zip(cuts, counts):
        p = [np.prod(probs[s, 1]) for s in c]
        for s, x in zip(c, p):
            for i in s:
                want[i] += n * x / sum(p)
    assert np.allclose(out, want)


def test_long_words_do_not_underflow():
    lattices = L.Lattices(PIECES)
    probs = np.full((len(PIECES) + 2, 2), 1e-9)
    probs[-1] = 0
    got = lattices.log_probs(["▁" + "ab" * 2000], probs)
    assert np.isfinite(got).all() and (got < -10_000).all()


def test_language_held_out_accuracy_and_columns(spark):
    got = Q.QUERIES["op9_language_id"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    import zlib
    assert len(both) == len(docs)
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.97
    assert both.score.between(0, 1).all()


def odd_documents(spark):
    rows = [(1, "the cat and the dog", "en", "s", 19), (2, None, "en", "s", None), (3, "", None, "s", 0),
            (4, "12 %% 34", "fr", None, 8), (5, "le chat et le chien " * 400, "fr", "s", 9),
            (6, "das " + "x" * 3000, "de", "s", 9), (1, "the cat and the dog", "en", "s", 19),
            (None, "der hund und die katze", "de", "s", 5), (8, "日本", None, "s", 2)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, "
                                       "n_chars bigint").withColumn("score", F.lit("x"))


def test_language_odd_rows(spark):
    docs = odd_documents(spark)
    path = Q.vocabulary("piece_bpe_32k.model")
    model = L.fit(docs, path)
    assert model.languages == ["de", "en", "fr"] and np.allclose(model.probs.sum(axis=0), 1)
    got = L.identify(docs, model).collect()
    assert len(got) == 9
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert [by_id[i] for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert by_id[1][0] == "en" and by_id[5][0] == "fr" and by_id[None][0] == "de"
    kept = L.identified(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "5", "6", "8", "None"]
    empty = L.fit(docs.limit(0), path)
    assert {r.lang_pred for r in L.identify(docs, empty).collect()} == {"und"}
    assert L.identify(docs.limit(0), model).count() == 0


def test_quality_held_out(spark):
    """Fitted without the labels of a third of the documents, it finds them."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = quality.fit(docs, labels.filter(~held))
    both = quality.score(docs, model).join(labels.filter(held), "doc_id").toPandas()
    assert len(both) > 80
    assert (both.accepted == (both.quality == 1)).mean() >= 0.97
    assert both[both.quality == 1].accepted.mean() >= 0.98
    assert both[["text_score", "meta_score", "score"]].stack().between(0, 1).all()


def test_quality_pool_is_drawn_from_the_rows_not_learned_from(spark, monkeypatch):
    """Rows whose label is not among those used are in the pool."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    seen, views = [], quality._with_views
    monkeypatch.setattr(quality, "_with_views", lambda rows: seen.append(rows.count()) or views(rows))
    n = docs.count()
    quality.fit(docs, labels, max_labelled=n // 4, rounds=1)
    known, pool = seen[:2]
    assert 0 < known < n / 2 and pool == n - known


def test_quality_odd_rows(spark):
    docs = odd_documents(spark)
    schema = "doc_id bigint, quality int"
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (5, 1), (3, 0), (None, 1), (77, 1)], schema)
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    one = quality.fit(docs, labels.filter("quality = 1"))
    assert {r.score for r in quality.score(docs, one).collect()} == {1.0}
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    kept = quality.accepted(docs, one)
    assert kept.columns == docs.columns and kept.count() == 9
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels)).count() == 0


def test_pages_of_the_table(spark):
    """The article element's blocks, on pages whose template is known."""
    import html
    import re
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in Q.QUERIES["op7_html_main_text"](spark, SF).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split())
                  for x in re.split(r"</?(?:p|h1)>", body)]
        want = "\n\n".join(x for x in blocks if x)
        assert got[r.page_id].text == want
        assert (got[r.page_id].n_chars, got[r.page_id].url) == (len(want), r.url)


def template(n, main, extra=""):
    return (f"<!doctype html><html><head><title>t{n}</title><style>p{{}}</style></head><body class='b{n}'>"
            f"<header><h1>Site</h1></header><nav><a href='/'>Home</a></nav>{extra}"
            f"<div class='wrap-{n} story'>{main}</div><div id=cookie-notice>We use cookies</div>"
            f"<aside>Aside</aside><form><p>Search</p></form>"
            f"<section class='comments'><article class='comment'><p>{'I disagree. ' * 80}</p></article>"
            f"</section><footer>&copy; me</footer><script>var a = '<p>no</p>';</script>")


def test_consensus_path_wins_over_a_page_of_its_own_shape(spark):
    long = "Long words here. " * 20
    pages = [(i, "http://h.net/a", template(i, f"<h2>Head {i}</h2><p>{long}<p>Tom &amp; Ann&nbsp;go\n on</p>"))
             for i in range(5)]
    # a page whose own best container is a long related box beside a short story
    box = f"<div class='teaser'><p>{'Other story text. ' * 9}</p></div>"
    pages.append((9, "http://h.net/b", template(9, f"<h2>Short</h2><p>{'One line. ' * 12}</p>", box)))
    # another template on the same host: the path is missing
    pages.append((10, "http://h.net/c", f"<body><main><p>{long}</p></main><footer>f</footer>"))
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string") \
        .withColumn("path", F.lit("x")).withColumn("host", F.lit(1))
    got = {r.page_id: r.text for r in main_text(df).collect()}
    words = " ".join(long.split())
    for i in range(5):
        assert got[i] == f"Head {i}\n\n{words}\n\nTom & Ann go on"
    assert got[9] == "Short\n\n" + " ".join(("One line. " * 12).split())
    assert got[10] == words


def test_pages_odd_rows(spark):
    rows = [(1, None, None), (2, "x", ""), (3, "http://a.b/", "plain &lt;text&gt;\n  here"),
            (4, "http://a.b/", "<"), (4, "http://a.b/", "<"), (None, None, "<p>a<p>b<br>c</b></p>"),
            (6, "http://a.b/", "<p>" + "word " * 60000), (7, "u", "<script>never closed"),
            (8, "u", "<div " + "a=\"" * 3000 + ">x"), (9, "u", "<p>" * 5000 + "deep")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string") \
        .withColumn("text", F.lit("x"))
    got = sorted(((r.page_id, r.text, r.n_chars, r.url) for r in main_text(df).collect()), key=str)
    assert len(got) == len(rows)
    text = {i: t for i, t, _, _ in got}
    assert text[1] == text[2] == text[7] == "" and text[3] == "plain <text> here"
    assert text[None] == "a\n\nb c" and text[9] == "deep" and len(text[6]) == 5 * 60000 - 1
    assert main_text(df.limit(0)).count() == 0


def test_images_stay_inside_their_block_and_named_boxes_go():
    page = Page("<div class='main-text'><p>one <img src='x'>two<wbr>three<!-- c --> four<hr>five</p>"
                "<div class=cookiebar>c</div><div id='userComments'><p>no</p></div>"
                "<div class='advertBox'>ad</div><ul><li>six<li>seven</ul></div>")
    assert page.extract(None) == "one twothree four\n\nfive\n\nsix\n\nseven"


def test_truncated_references_and_quotes():
    assert Page("<p>a &am</p><p>b &amp c</p><p title='x>y'>d &#x41;&#0;&bogus;</p>").extract(None) \
        == "a &am\n\nb & c\n\nd A�&bogus;"


WRAPPERS = ["overflow-hidden", "no-sidebar", "has-sidebar", "with-header", "long-form",
            "category-commentary", "has-comments"]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_layout_names_do_not_leave_out_the_article(wrapper):
    comments = f"<div id=comments><article class=comment><p>{'No. ' * 200}</p></article></div>"
    story = f"<h1>Head</h1><p>{'Words of it. ' * 9}</p>"
    want = "Head\n\n" + " ".join(("Words of it. " * 9).split())
    side = "<div class=sidebar><p>Side.</p></div><div class=related><article>Less.</article></div>"
    for tag in ("article", "main", "div role=main"):
        inner = f"<{tag}>{story}</{tag.split()[0]}>"
        for page in (f"<div class='{wrapper}'>{inner}</div>{comments}<p>Stray</p>",
                     f"<div id='{wrapper}'><div class='{wrapper}'>{inner}{side}</div>{comments}</div>",
                     f"<main><div class='a {wrapper}'>{inner}</div></main>{side}{comments}"):
            assert Page(f"<html><body>{page}</body></html>").extract(None) == want


@pytest.mark.parametrize("wrapper", WRAPPERS[:-1])
def test_layout_names_do_not_leave_out_most_of_the_text(wrapper):
    comments = f"<div id=comments><div class=comment><p>{'No. ' * 200}</p></div></div>"
    story = f"<h1>Head</h1><p>{'Words of it. ' * 9}</p>"
    want = "Head\n\n" + " ".join(("Words of it. " * 9).split())
    side = "<div class=sidebar><p>Side box.</p></div><div class=cookies>We use them.</div>"
    for page in (f"<div class='{wrapper}'>{story}</div>{side}{comments}",
                 f"<div class='{wrapper}'><div class='x {wrapper}'>{story}{side}</div>{comments}</div>"):
        assert Page(f"<html><body>{page}</body></html>").extract(None) == want


def test_named_boxes_beside_the_article_still_go():
    page = (f"<main><article><p>{'Story. ' * 20}</p></article><div class=related><article>Other one."
            f"</article></div><div class='user-comments'><article>A</article><article>B</article></div>")
    assert Page(page).extract(None) == " ".join(["Story."] * 20)
    assert Page("<div class=comments><p>Only this</p></div>").extract(None) == "Only this"
    assert Page("<nav>x</nav><div class=hidden><nav><article>y</article></nav></div>").extract(None) == ""


def test_h1_and_lead_beside_the_body_stay(spark):
    body = "Long words here. " * 60
    words = " ".join(body.split())

    def post(n, inner):
        return f"<html><body><nav><p>Go</p></nav><div class='post p-{n}'>{inner}</div></body></html>"

    entry = f"<div class=entry><p>{body}</p></div>"
    pages = [(i, f"http://{'ab'[i % 2]}.net/{i}", post(i, f"<h1>H {i}</h1><p>Lead {i}</p>{entry}"))
             for i in range(6)]
    # most pages of a host without h1 and lead, then such with, and other templates
    pages += [(10 + i, "http://c.net/x", post(i, entry)) for i in range(6)]
    pages.append((20, "http://c.net/y", post(0, f"<h1>Head</h1>{entry}")))
    pages.append((21, "http://c.net/y", post(0, f"{entry}<div class=more><p>{body}</p></div>")))
    pages.append((22, "http://c.net/y", post(0, f"{entry}<p><a href=x>Link</a></p><aside>No</aside>")))
    pages.append((23, "http://c.net/y", post(0, f"{entry}<p>By me</p>")))
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in main_text(df).collect()}
    for i in range(6):
        assert got[i] == f"H {i}\n\nLead {i}\n\n{words}" and got[10 + i] == words
    assert got[20] == f"Head\n\n{words}" and got[21] == f"{words}\n\n{words}"
    assert got[22] == got[23] == words  # a twentieth beside the host's path goes
    assert Page(f"<body><h1>H</h1><p>Lead</p>{entry}</body>").extract(None) == f"H\n\nLead\n\n{words}"
    assert Page("<body><article>One a.</article><article>Two b.</article></body>").extract(None) \
        == "One a.\n\nTwo b."


def test_top_k_scores_few_candidates_and_only_those_that_remain():
    t = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    vectors = np.floor(np.array([v for _, v in t]) * 256)
    asked = np.array([i for i, (x, _) in enumerate(t) if x % 50 == 0])
    lists, scored = SortedLists(vectors), []

    class Vectors(np.ndarray):
        def __matmul__(self, other):
            scored.append(len(self))
            return np.asarray(self) @ np.asarray(other)

        def __rmatmul__(self, other):
            scored.append(self.size)
            return np.asarray(other) @ np.asarray(self)

    lists.bounds = lambda *a: SortedLists.bounds(plain, *a)
    plain, lists.vectors = SortedLists(vectors), vectors.view(Vectors)
    tie = np.arange(len(vectors))
    for q, rows, score in lists.best(vectors[asked], 5, asked, tie):
        want = vectors @ vectors[asked[q]]
        want[asked[q]] = -np.inf
        best = np.lexsort((tie, -want))[:5]
        assert rows.tolist() == best.tolist() and np.asarray(score).tolist() == want[best].tolist()
    assert len(scored) == len(asked) and max(scored) <= 20


def brute_top(rows, k, is_query):
    vectors = [(n, i, [math.floor(256 * float(x)) for x in v]) for n, (i, v) in enumerate(rows)
               if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in vectors:
        if i is None or not is_query(i):
            continue
        scores = sorted(((-sum(a * b for a, b in zip(q, v)), j is None, j or 0, m, j)
                         for m, j, v in vectors if m != n and len(v) == len(q)))[:k]
        out += [(i, r + 1, s[4], max(-(1 << 63), min((1 << 63) - 1, -s[0])))
                for r, s in enumerate(scores)]
    return sorted(map(str, out))


@pytest.mark.parametrize("block,query_block", [(2048, 1024), (16, 3)])
def test_top_k_odd_rows(spark, block, query_block):
    r = random.Random(block)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(8)]) for i in range(150)]
    rows += [(200, rows[3][1]), (200, rows[3][1]), (201, rows[3][1]), (None, rows[3][1]), (50, None),
             (100, [1.0, None] + [0.0] * 6), (150, [float("nan")] * 8), (0, [float("inf")] * 8),
             (300, [1.0, 2.0]), (350, []), (400, [3.0]), (301, [5.0, -1.0]), (10, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>") \
        .withColumn("row", F.lit("x")).withColumn("v", F.lit(1)).coalesce(1)
    got = top_k(df, F.col("vec_id") % 50 == 0, block=block, query_block=query_block).collect()
    assert sorted(str(tuple(x)) for x in got) == brute_top(rows, 5, lambda i: i % 50 == 0)
    assert top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_huge_values(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 5.0]), (3, [3e9, 1.0]), (50, [2e9, 0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").coalesce(1)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in
           top_k(df, F.col("vec_id") % 50 == 0).collect()}
    assert got[0, 1] == (1, (1 << 63) - 1) and got[0, 4] == (2, -(1 << 63))
    assert len(got) == 8


def test_op10_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(Q.ORACLE["op10_exact_top_k"]).fetchall()
    got = Q.QUERIES["op10_exact_top_k"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_floors_come_from_all_labelled_rows(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice(["house", "river", "stone", "green", "xq" + str(i)]) for _ in range(9))
             for i in range(3000)]                     # three times the rows that are learned from
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, lang string")
    model = L.fit(docs, Q.vocabulary("piece_bpe_32k.model"))
    fits = sorted(fit for _, _, fit in model.predict(texts, model.scorer()))
    floor = L.with_floors(model, docs).floors["en"]
    assert abs(floor - (2 * fits[0] - fits[1499])) < 1e-9
