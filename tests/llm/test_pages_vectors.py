"""Pages, archives, nearest neighbours and language-model scores."""

import gzip
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillhouse.llm import ann, html, lm, warc
from tillhouse.llm.files import open_input
from tillhouse.llm.queries import QUERIES
from tillhouse.session import new_folder

SF = "/root/testdata/sf0.001"
LONG = ("The quick brown fox that was in the field and of the river is with us for a long time and it has been there as well as "
        "the others who were not in the place at all for the whole of the day.")


def test_marked_article():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no";</script></head>
    <body class="has-sidebar"><header><a href=/>Site</a> of ours</header><nav><ul><li><a>Home</a><li><a>News</a></ul></nav>
    <div class="cookie-notice">{LONG}</div><!-- <p>{LONG}</p> --><article><header><h1>Title &amp; more</h1></header><p><b>Bold.<br>next
    line<p>{LONG}<p>A &lt; B&nbsp;&euro;</p><div class="share-bar">Share it</div><form>Mail <input></form></article>
    <aside>{LONG}</aside><section id="comments"><article class="comment"><p>{LONG}</article></section><footer>&copy; {LONG}</footer>"""
    assert html.main_text(page) == f"Title & more\n\nBold. next line\n\n{LONG}\n\nA < B €"


def test_unmarked_page_by_words():
    page = f"""<div><a>Home</a> <a>About us</a> <a>Contact</a></div><h2>Head</h2><p>{LONG}</p><p>Short</p><p>{LONG}</p>
    <div><a>one link</a> <a>another link</a></div><div>Copyright © me</div>"""
    assert html.main_text(page) == f"Head\n\n{LONG}\n\nShort\n\n{LONG}"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<nav>menu</nav>", ""), ("plain a < b text", "plain a < b text"), ("<p>x<!-- open <p>y", "x"), ("<script>var a", ""),
    ("<form><main><p>in a form</main></form>", "in a form"), ("<div id='mainContent'><div class='siteNav'>x</div>text</div>", "text"),
    ("<div class='main-header'>no</div><div class='post'>yes<div class=post-footer>no</div></div>", "yes"), ("<p title='a>b'>q</p>", "q"), ("<p>x</b></div>y", "xy"),
])
def test_small_and_broken_pages(page, text):
    assert html.main_text(page) == text.replace("xy", "x\n\ny")


def test_pages_query(spark):
    rows = QUERIES["op7_html"](spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        for tag in ("<p>", "</p>", "<h1>", "</h1>"):
            body = body.replace(tag, "\n")
        lines = (" ".join(html.unescape(line.replace("<b>", "").replace("<br>", " ")).split()) for line in body.split("\n"))
        assert r.text == "\n\n".join(x for x in lines if x) and r.n_chars == len(r.text)
    edge = spark.createDataFrame([(None, None, None, 1), (1, "u", "", 1)], "page_id bigint, url string, html string, text int")
    assert sorted(map(tuple, html.extract(edge).collect()), key=str) == [(1, "u", "", 0), (None, None, "", 0)]


def test_archives(spark):
    body = "é" * 600
    rows = [(1, "http://a b\n", body), (5, None, body), (3, "u", body), (None, "u", body), (7, "s", "short"), (8, "s", "short"), (9, "n", None), (5, "z", body)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id bigint, url string, html string, record_type int")
    manifests = [warc.write_warc(pages.repartition(n), new_folder(spark, "w"), roll_bytes=700).orderBy("shard", "number").collect() for n in (1, 3)]
    assert len(manifests[0]) > 2 and sum(r.records for r in manifests[0]) == len(rows)
    files = [[open_input(r.path).read() for r in m] for m in manifests]
    assert files[0] == files[1]
    assert all(gzip.decompress(f).startswith(b"WARC/1.0\r\nWARC-Type: warcinfo") for f in files[0])
    got = warc.round_trip(pages).collect()
    assert sorted((r.page_id or -1, r.record_type, r.refers_to or 0, r.payload_bytes) for r in got) == [
        (-1, "revisit", 5, 1200), (1, "revisit", 5, 1200), (3, "revisit", 5, 1200), (5, "response", 0, 1200), (5, "response", 0, 1200),
        (7, "response", 0, 5), (8, "response", 0, 5), (9, "response", 0, 0)]
    assert warc.round_trip(pages.filter("page_id = 99")).count() == 0


def _brute(rows, k=20, every=20):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if i % every == 0:
            scores = (vectors * np.array(v, float)).sum(axis=1)
            order = [x for x in np.lexsort((ids, -scores)) if ids[x] != i][:k]
            out[i] = [(int(ids[x]), float(scores[x])) for x in order]
    return out


def _lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_nearest_with_ties_and_unusable_rows(spark):
    draw = np.random.default_rng(0)
    base = draw.normal(size=(50, 8)).round(2)
    rows = [(i, base[draw.integers(0, 50) if i % 3 else 0].tolist()) for i in range(600)]
    bad = [(None, [1.0] * 8), (1000, None), (1020, [0.0] * 8), (1040, [float("nan")] + [1.0] * 7), (1060, [None] + [1.0] * 7),
           (1080, [1.0] * 5), (1100, []), (1120, [float("inf")] * 8)]
    table = spark.createDataFrame([(*r, 1) for r in rows + bad + rows[:40]], "vec_id bigint, embedding array<double>, score int")
    query = F.col("vec_id") % 20 == 0
    assert _lists(ann.nearest(table, query, shard_rows=16).collect()) == _brute(rows)
    assert len(_lists(ann.nearest(table.filter("vec_id < 3"), query).collect())[0]) == 2
    assert ann.nearest(table.filter("vec_id < 0"), query).count() == 0


def test_recall(spark):
    got = _lists(QUERIES["op9_nearest"](spark, "/root/testdata/sf0.1").collect())
    exact = _brute([(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()])
    assert got.keys() == exact.keys()
    shared = [len({i for i, _ in got[q]} & {i for i, _ in exact[q]}) for q in exact]
    assert sum(shared) / sum(map(len, exact.values())) >= 0.95
    truth = {q: dict(x) for q, x in exact.items()}
    assert all(truth[q].get(i, s) == s for q, x in got.items() for i, s in x)


def test_language_model_predicts_unseen_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lm.train(docs.filter("doc_id % 10 > 0").repartition(2), rounds=2)
    texts = [r.text for r in docs.filter("doc_id % 10 = 0").collect()]
    draw = random.Random(1)
    shuffled = [" ".join(draw.sample(t.split(), len(t.split()))) for t in texts]
    ids, around, _ = lm._contexts(pa.array(texts), model.vocabulary)
    real = lm.log_probabilities(model.weights, ids, around).mean()
    other_ids, other, _ = lm._contexts(pa.array(shuffled), model.vocabulary)
    share = (np.bincount(ids, minlength=lm.SIZE) + 1) / (len(ids) + lm.SIZE)
    assert real > lm.log_probabilities(model.weights, other_ids, other).mean() + 0.02
    assert real > np.log(share[ids]).mean() + 0.05  # better than knowing the frequencies of these very words


def test_gradient():
    draw = np.random.default_rng(3)
    w = lm.new_weights()
    ids, around = draw.integers(0, lm.SIZE, 50).astype(np.uint16), draw.integers(0, lm.SIZE + 1, (2 * lm.SIDE, 50)).astype(np.uint16)
    before = lm.log_probabilities(w, ids, around).mean()
    state = {name: np.zeros_like(x) for name, x in w.items()}
    for _ in range(20):
        lm._step(w, state, ids, around)
    assert lm.log_probabilities(w, ids, around).mean() > before + 0.5


def test_scores_of_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "a b", 0), (3, "a b", 0), (3, "a b", 0)], "doc_id bigint, text string, n_tokens int")
    got = {r.doc_id: r for r in lm.score(docs, lm.train(docs)).collect()}
    assert (got[1].n_tokens, got[1].log_likelihood, got[1].mean_log_likelihood) == (0, 0.0, None)
    assert got[2].n_tokens == 0 and got[3].n_tokens == 2 and got[3].log_likelihood == got[None].log_likelihood < 0
    none = docs.filter("doc_id = 9")
    assert lm.score(none, lm.train(none)).count() == 0


def test_rare_words_are_scored_by_their_own_share(spark):
    common = " ".join(f"c{k}" for k in range(896))
    other = next(w for w in (f"r{k}" for k in range(10_000)) if zlib.crc32(w.encode()) % lm.HASHED == zlib.crc32(b"often") % lm.HASHED)
    rows = [(k, f"{common} {common}\n{common}") for k in range(9)] + [(10, " ".join(["often"] * 20)), (11, other)]
    model = lm.train(spark.createDataFrame(rows, "doc_id bigint, text string"))
    asked = spark.createDataFrame([(1, "often"), (2, other), (3, "c5 often"), (4, f"c5 {other} {other}")], "doc_id bigint, text string")
    got = {r.doc_id: r.log_likelihood for r in lm.score(asked, model).collect()}
    assert got[1] - got[2] == pytest.approx(np.log(20))
    ids, around, _ = lm._contexts(pa.array(["often"]), model.vocabulary)
    assert got[1] == pytest.approx(lm.log_probabilities(model.weights, ids, around)[0] + np.log(20 / 22))


def test_vocabulary_grows_with_the_corpus(spark):
    docs = spark.range(1200).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 1199), k -> concat(id, 'x', k))) AS text")
    model = lm.train(docs)
    assert len(model.vocabulary) == 1200 - lm.HASHED and model.counts.count() == 1_440_000
    assert model.weights["classes"].shape[1] * lm.MEMBERS >= 1200
    got = lm.score(docs.limit(1), model).first()
    assert got.n_tokens == 1200 and got.mean_log_likelihood < np.log(1 / 1000)


@pytest.mark.parametrize("lengths, rows", [((), 2000), ((1e3,), 2000), ((1e4, 2e4, 1e7), 2000), ((1e4,), 24_000)])
def test_recall_with_very_long_vectors(spark, lengths, rows):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(rows, 16))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    for k, length in enumerate(lengths):
        vectors[7 * k + 1] *= length
    table = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id bigint, embedding array<double>")
    got = _lists(ann.nearest(table, F.col("vec_id") % 100 == 0).collect())
    exact = _brute(list(enumerate(vectors.tolist())), every=100)
    assert got.keys() == exact.keys()
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in exact[q]}) for q in exact) / (20 * len(exact)) >= 0.95


@pytest.mark.parametrize("page, text", [
    *((f"<div class='{c}'><nav>menu</nav><article><p>{LONG}</p></article><div class=sidebar>{LONG[:80]}</div></div>", LONG)
      for c in ("page has-sidebar", "no-sidebar", "with-comments", "search-results", "widget")),
    (f"<article class='post has-comments'><p>{LONG}</p></article><div class=comments><article>{LONG}</article></div>", LONG),
    (f"<div class='search-page'><p>{LONG}</p></div>", LONG),
    (f"<article>Teaser</article><p>{LONG} {LONG}</p><p>{LONG}</p><div class=sidebar><p>{LONG}</div>", f"Teaser\n\n{LONG} {LONG}\n\n{LONG}"),
])
def test_layout_names_and_text_beyond_articles(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("body", [
    "Быстрая коричневая лиса перепрыгнула через ленивую собаку возле реки. " * 4, "敏捷的棕色狐狸跳过了河边那只懒惰的狗。" * 12,
    "Szybki brązowy lis przeskoczył nad leniwym psem obok rzeki wczoraj. " * 4, "x = compute(y)[0]; total += x.size * 2; " * 8,
])
def test_unmarked_page_without_stop_words(body):
    body = body.strip()
    menu = "".join(f"<a>{body[:30]}</a> " for _ in range(5))
    assert html.main_text(f"<div>{menu}</div><p>{body}</p><p>{body[:80]}</p><div>{menu}</div>") == f"{body}\n\n{body[:80].strip()}"


@pytest.mark.parametrize("piece", ["<a", "<a \"", "<a '\"", "</script", "<!-", "<div class=ad>x", "<div>", "<p title='a", "<li class=comment>x", "</section>", "<a b=\"<", "< ", "<script>", "&am", "<span hidden>x"])
def test_broken_markup_takes_little_time(piece):
    import time

    for page in (piece * (1_000_000 // len(piece)), "<div>" * 50_000 + piece * (700_000 // len(piece))):
        start = time.process_time()
        html.main_text(page)
        assert time.process_time() - start < 6, page[:20]


@pytest.mark.parametrize("inner", [
    "<p class='ad'>no</p>", "<span class=ad>no</span>", "<ul><li class='comment'><div>no<p>no</div></ul>", "<h3 class=related>no</h3>",
    "<p hidden>no</p>", "<p class=sponsored>no", "<li class=comment>no<ul><li>no</ul>no</li>", "<table><tr class=advert><td>no<td>no</table>",
    "<i style='display:none'>no <i>no</i> no</i>", "<b aria-hidden=true>no</b>",
])
def test_marked_parts_of_an_article_go(inner):
    page = f"<article><h1>Title</h1><p>{LONG}</p>{inner}<p>{LONG}</p><p class='text-body'>End don't <b title=\"a>b\">stop</b></p></article>"
    assert html.main_text(page) == f"Title\n\n{LONG}\n\n{LONG}\n\nEnd don't stop"


def test_copyright_only_cuts_short_blocks():
    text = LONG + " The sign © of the law is what this text is about, and it has been so for a long time in all of the places there are."
    assert html.main_text(f"<div><p>{text}<p>{LONG}</div><div>© me</div>") == f"{text}\n\n{LONG}"


def test_pages_edge_tables(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html.extract(empty).count() == 0
    long = f"<article><p>{LONG} {'x ' * 500_000}</p></article>"
    row = html.extract(spark.createDataFrame([(1, "u", long)] * 2, "page_id bigint, url string, html string")).collect()
    assert len(row) == 2 and row[0].n_chars == len(" ".join((LONG + " " + "x " * 500_000).split()))


@pytest.mark.parametrize("number", range(20))
def test_unmarked_pages(number):
    """The two passes alone: nothing on the page is named."""
    draw = random.Random(number)
    body = [LONG + f" It is the part {i} of {number}." for i in range(draw.randint(2, 6))]
    short = [f"Short line {i}" for i in range(len(body) - 1)]
    menu = "".join(f"<li><a href=/{i}>Menu entry {i}</a>" for i in range(draw.randint(3, 12)))
    middle = "".join(f"<p>{b}</p><p>{s}</p>" for b, s in zip(body, [*short, ""]))
    page = f"<html><body><ul>{menu}</ul><div>{middle}</div><div><a>more of this</a> <a>and of that</a></div><p>Copyright © {number}</body>"
    want = [x for pair in zip(body, [*short, ""]) for x in pair if x]
    assert html.main_text(page) == "\n\n".join(want)


@pytest.mark.parametrize("shape", ["0.3", "1", "wide clusters", "tight clusters"])
def test_recall_where_vectors_differ_in_length(shape):
    """One graph against brute force."""
    draw = np.random.default_rng(4)
    n, size = 3000, 64
    x = draw.normal(size=(n, size))
    if shape == "wide clusters":
        x += 2 * draw.normal(size=(8, size))[draw.integers(0, 8, n)]
    elif shape == "tight clusters":
        x = 0.2 * x + draw.normal(size=(200, size))[draw.integers(0, 200, n)]
    else:
        x *= np.exp(float(shape) * draw.normal(size=(n, 1))) / np.linalg.norm(x, axis=1, keepdims=True)
    level = ann._level(x)
    edges, entries = ann.build_graph(level)
    queries = np.arange(0, n, 20)
    found, _ = ann.beam_search(level.astype(np.float32), edges, entries, np.column_stack([x[queries], np.zeros(len(queries))]).astype(np.float32), ann.QUERY_BEAM)
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    assert np.mean([len(set(f[:42].tolist()) & set(b.tolist())) / 20 for f, b in zip(found, best)]) >= 0.9
