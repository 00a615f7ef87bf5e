"""Mixing, page extraction, vector searches and the pipeline."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import plan_of
from sentimill.llm import ann, html_extract, mixing, queries, topk_exact
from sentimill.llm.components import connected_components
from test_text_operators import DOC, ODD

# Mixing --------------------------------------------------------------------------------------


def plain_targets(sizes):
    """sizes: by source in order; the excess over a cap is shared again until none is above."""
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    left, full = 1.5 * sum(sizes), {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        level = left / sum(weights[i] for i in open_) if open_ else 0
        over = [i for i in open_ if weights[i] * level >= 2 * sizes[i]]
        if not over:
            return [full.get(i, weights[i] * level) for i in range(len(sizes))]
        for i in over:
            full[i] = 2.0 * sizes[i]
            left -= full[i]


def test_mix_meets_its_targets(spark, sf_dir):
    found = queries.QUERIES["op1_source_mixing"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    rows = found.join(docs, "doc_id").toPandas()
    assert len(rows) == docs.count()
    assert ((rows.taken >= 0) & (rows.taken <= 2 * rows["size"])).all()
    by_source = rows.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum")).sort_index()
    assert np.allclose(by_source.target, plain_targets(by_source["size"].tolist()))
    assert ((by_source.taken - by_source.target).abs() <= 2 * mixing.BLOCK_WORDS).all()
    again = queries.QUERIES["op1_source_mixing"](spark, sf_dir)
    assert again.exceptAll(found).count() == 0
    assert "Python" not in plan_of(found) and "ArrowEval" not in plan_of(found)


def test_seats_go_to_the_highest_quotients(spark):
    rnd = np.random.default_rng(4)
    children = [(p, c, int(v)) for p in range(6) for c, v in enumerate(rnd.integers(0, 1000, rnd.integers(1, 40)))]
    seats = {p: int(rnd.integers(0, 300)) for p in range(6)}
    df = spark.createDataFrame([(p, c, v, seats[p]) for p, c, v in children], "p int, c int, votes long, seats long")
    ours = {(r.p, r.c): r.quota for r in mixing.apportion(df, ["p"], "c", "votes", "seats").collect()}
    for p in range(6):
        own = [(c, v) for q, c, v in children if q == p]
        quotients = sorted((-v / (2 * k + 1), c) for c, v in own for k in range(seats[p]) if v)[: seats[p]]
        for c, _ in own:
            assert ours[p, c] == sum(q[1] == c for q in quotients)


def test_mixing_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOC).withColumn("key", F.lit(1)).withColumn("shard", F.lit(2))
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ODD) and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.filter("doc_id = 2").count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixed_documents_with_clashing_columns(spark):
    docs = spark.createDataFrame(ODD, DOC)
    for name in ("size", "taken", "target", "source_size", "_row", "_copy", "_draw"):
        docs = docs.withColumn(name, F.lit(name))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    plain = mixing.mixed_documents(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    assert mixed.select(*plain.columns).exceptAll(plain).count() == 0 and mixed.count() == plain.count()


def test_rows_without_an_id_are_many_shards(spark):
    docs = spark.range(4000).select(
        F.lit(None).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit("w"), "id").alias("text"), F.lit("one").alias("source")
    )
    units = mixing.mix(docs)
    assert units.count() == 4000
    plan = docs.select(mixing.unit(F.concat_ws(":", F.lit(""), F.md5("text")), mixing.SEED + " shard").alias("u"))
    assert plan.select(F.floor(F.col("u") * 8)).distinct().count() == 8
    again = mixing.mix(docs)
    assert again.exceptAll(units).count() == 0


def test_hot_source_is_split(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("w " * 20).alias("text"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source")
    )
    rows = mixing.mix(docs).toPandas()
    assert abs(rows.taken.sum() - 1.5 * rows["size"].sum()) <= 10 * mixing.BLOCK_WORDS


# Pages ---------------------------------------------------------------------------------------


def test_pages_give_their_article(spark, sf_dir):
    import html
    import re

    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.QUERIES["op3_html_consensus"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for row in rows:
        inner = re.search(r"(?s)<article>(.*?)(</article>|$)", pages[row.page_id].html).group(1)
        blocks = re.sub(r"<(/?(p|h1|br)\b[^>]*)>", " ", inner)
        assert row.text == " ".join(html.unescape(re.sub("<[^>]*>", "", blocks)).split())
        assert row.n_chars == len(row.text)


def body(inner):
    return f"<html><body><nav><a>menu</a></nav><div class='page-1'>{inner}</div><div id=comments><p>first!</p></div><footer>f</footer></body></html>"


def test_consensus_beats_a_page_of_its_own(spark):
    long = "word " * 80
    pages = [(i, f"http://h.org/{i}", body(f"<div class='text'><p>{long}</p><p>{i} end</p></div>")) for i in range(6)]
    # A short article next to a long teaser list: alone, the page would give the list.
    pages.append((9, "http://h.org/9", body(f"<div class='text'><p>short news</p></div><div class='list'><p>{long}</p></div>")))
    pages.append((10, "http://other.org", body(f"<div class='list'><p>{long}</p></div>")))
    found = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert found[0] == " ".join(f"{long} 0 end".split())
    assert found[9] == "short news"
    assert found[10] == long.strip()


def test_broken_and_odd_pages(spark):
    rows = [
        (1, None, None), (2, "u", ""), (3, "http://x/", "just text &amp; more &#233;"),
        (4, "http://x/", "<p>open <b>bold<br><p>next</i> <script>var a='<p>no</p>'"),
        (5, "http://x/", "<!-- never closed <p>gone"), (6, "http://x/", "<p a=\"'>>\">a < b</p>"),
        (6, "http://x/", "<p a=\"'>>\">a < b</p>"), (7, "http://x/", "<" * 20_000 + "<a '" * 20_000),
        (8, "http://x/", "<div>" * 5_000 + "deep"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    found = html_extract.extract(pages).collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(rows)
    assert text[1] == text[2] == text[5] == ""
    assert text[3] == "just text & more é"
    assert text[4] == "open bold next"
    assert text[6] == "a < b"
    assert text[8] == "deep"
    assert html_extract.extract(pages.limit(0)).count() == 0


def main_text(spark, pages):
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_extract.extract(rows).collect()}


def test_heading_lead_and_split_sections_stay_together(spark):
    long = "word " * 60
    inner = f"<h1>Head</h1><p>lead</p><section><p>{long}</p></section><section><p>{long}</p></section>"
    one = f"<h1>Head</h1><p>lead</p><div class=body><p>{long}</p></div>"
    pages = [(i, f"http://h{i % 2}.org/{i}", f"<body><nav>n</nav><article>{(inner, one)[i % 2]}</article></body>") for i in range(8)]
    found = main_text(spark, pages)
    assert found[0] == " ".join(f"Head lead {long} {long}".split())
    assert found[1] == " ".join(f"Head lead {long}".split())


def test_every_template_of_a_host_keeps_its_article(spark):
    long = "word " * 60
    letters = "abcdefg"
    pages = [(i, f"http://h.org/{i}", f"<body><div class=t{x}><p>{long}{x}{i}</p></div><div class=ta><p>box</p></div></body>") for i, x in enumerate(letters * 3)]
    pages = [(i, u, h if "class=ta><p>word" not in h else h.replace("<div class=ta><p>box</p></div>", "")) for i, u, h in pages]
    found = main_text(spark, pages)
    for i, x in enumerate(letters * 3):
        assert found[i] == " ".join(f"{long}{x}{i}".split())


def test_pages_without_a_host_decide_alone(spark):
    long = "word " * 60
    pages = [(i, None, f"<body><div class=a><p>{long}</p></div></body>") for i in range(5)]
    pages.append((9, "/rel", f"<body><div class=a><p>box</p></div><div class=b><p>{long}</p></div></body>"))
    assert main_text(spark, pages)[9] == long.strip()


@pytest.mark.parametrize(
    "name", ["has-sidebar", "no-sidebar", "elementor-widget-container", "post comments-open", "share-enabled"]
)
def test_wrappers_named_like_boilerplate_keep_their_text(name):
    page = html_extract.Page(f"<body><div class='{name}'><article><p>the text</p></article></div><div class=ad>advert</div></body>")
    assert page.extract(None) == "the text"


@pytest.mark.parametrize(
    "tag", ["<svg width='1'/>", "<math/>", "<iframe src='x' />", "<title/>", "<svg>", "<object>", "<select>"]
)
def test_raw_elements_without_an_end_drop_nothing(tag):
    page = html_extract.Page(f"<body><p>one</p>{tag}<p>two</p></body>")
    assert page.extract(None) == "one two"
    page = html_extract.Page("<body><p>one</p><svg/><p>two</p><svg><text>no</text></svg></body>")
    assert page.extract(None) == "one two"


@pytest.mark.parametrize(
    "name",
    [
        "comment-list", "comments-area", "user-comments-section", "sidebar-left", "ad-container", "advert-slot", "related-posts",
        "share-buttons", "cookie-notice-bar", "newsletter-box", "social-links", "banner-top",
    ],
)
def test_boilerplate_is_known_by_any_part_of_its_name(name):
    inner = f"<h1>Head</h1><p>the text of it</p><div class='{name}'><p>other</p></div><p>more of the text</p>"
    for page in (f"<body><article>{inner}</article></body>", f"<body><div>{inner}</div></body>", f"<body>{inner}</body>"):
        assert html_extract.Page(page).extract(None) == "Head the text of it more of the text"


def test_references_end_with_their_element():
    for source, text in (("AT&<b>amp;</b>T", "AT&amp;T"), ("&<i>lt;</i>", "&lt;"), ("a&amp;<b>&lt;</b>&#x41;", "a&<A")):
        assert html_extract.Page(f"<body><p>{source}</p></body>").extract(None) == text


def test_an_article_in_links_keeps_its_text():
    page = "<body><nav><a>menu</a></nav><article><p><a href=x>all of the text</a></p><p><a href=y>stands in links</a></p></article></body>"
    assert html_extract.Page(page).extract(None) == "all of the text stands in links"


def test_containers_deep_down_have_paths_of_their_own():
    page = html_extract.Page("<body>" + "<div>" * 60 + "<div class=a><p>one</p></div><div class=b><p>two</p></div>")
    assert len(set(page.paths)) == len(page.paths)


# Vectors -------------------------------------------------------------------------------------

VECTOR = "vec_id long, embedding array<float>"


def brute(rows, step, k, scale=None):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    found = {}
    for q, own in usable:
        if q % step:
            continue
        a = np.floor(scale * own) if scale else own
        scores = [(-(a @ (np.floor(scale * v) if scale else v)), i) for i, v in usable if i != q and len(v) == len(own)]
        found[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return found


def odd_vectors():
    rnd = np.random.default_rng(1)
    rows = [(i, rnd.normal(size=8).round(3).tolist()) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 400)]  # ties
    return rows + [
        (400, None), (402, [None] * 8), (404, [float("nan")] * 8), (406, [float("inf")] * 8), (408, []), (None, [1.0] * 8),
        (410, [1.0, 2.0]), (420, [2.0, 1.0]), (430, [0.0] * 8),
    ]


def test_top_k_is_exact(spark):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, VECTOR).withColumn("rank", F.lit(0)).withColumn("score", F.lit("clash")).repartition(5)
    expected = brute([(i, [np.float32(x) if x is not None else None for x in v] if v else v) for i, v in rows], 10, 5, 256)
    ours = {}
    for r in sorted(topk_exact.top_k(df, F.col("vec_id") % 10 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        ours.setdefault(r.query_id, []).append((r.vec_id, float(r.score)))
    assert ours == {q: v for q, v in expected.items() if v}
    assert topk_exact.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_a_repeated_query_id_asks_once(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).normal(size=4)]) for i in range(1, 30)] + [(20, [1.0, 0.0, 0.0, 0.0]), (20, [0.0, 9.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, VECTOR)
    for found, k in ((topk_exact.top_k(df, F.col("vec_id") % 20 == 0), 5), (ann.nearest(df, F.col("vec_id") % 20 == 0), 20)):
        rows_found = found.orderBy("rank").collect()
        assert [r["rank"] for r in rows_found] == list(range(1, k + 1))
        assert len({r.vec_id for r in rows_found}) == k and all(r.query_id == 20 != r.vec_id for r in rows_found)


def unit_vectors(n, dim):
    vectors = np.random.default_rng(6).normal(size=(n, dim))
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def test_reading_stops_before_most_scores():
    """Exact results, and no full product: few entries are read beyond the common depth, fewer scores are resolved."""
    from sentimill.llm.vectors import Best

    vectors, ids = np.floor(256 * unit_vectors(12_000, 32)), np.arange(12_000)
    asked = vectors[::600]
    best, work = Best(ids[::600], 5, np.int64), {"read": 0, "all": 0, "resolved": 0, "pairs": 0}
    for at in range(0, 12_000, 4096):
        topk_exact.aggregate(asked, ids[at : at + 4096], vectors[at : at + 4096], best, work)
    for q, own in enumerate(ids[::600]):
        scores = vectors @ asked[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != own][:5]
        assert best.found[q][1].tolist() == order and best.found[q][0].tolist() == scores[order].tolist()
    assert work["read"] < 0.4 * work["all"] and work["resolved"] < 0.1 * work["pairs"]


def test_few_vectors_are_verified():
    from sentimill.llm.vectors import Best

    vectors, ids = unit_vectors(20_000, 64), np.arange(20_000)
    asked = vectors[:20_000:1000]
    best, work = Best(ids[::1000], 20, np.float64), {"verified": 0, "pairs": 0}
    for at in range(0, 20_000, ann.BLOCK_ROWS):
        ann.count_collisions(asked, ids[at : at + ann.BLOCK_ROWS], vectors[at : at + ann.BLOCK_ROWS], best, 1.0, work)
    hits = 0
    for q, own in enumerate(ids[::1000]):
        scores = vectors @ asked[q]
        hits += len(set(best.found[q][1].tolist()) & {i for i in np.argsort(-scores)[:21].tolist() if i != own})
    assert hits >= 0.9 * 20 * len(asked)
    assert work["pairs"] == 20 * 19_999 and work["verified"] < 0.2 * work["pairs"]


def test_bounds_hold_the_scores():
    rnd = np.random.default_rng(2)
    queries_, vectors = rnd.integers(-50, 50, (7, 6)).astype(float), rnd.integers(-50, 50, (90, 6)).astype(float)
    lists, scores = np.sort(vectors, axis=0), queries_ @ vectors.T
    for depth in (1, 10, 44):
        most, least = topk_exact._bounds(np.maximum(queries_, 0), np.minimum(queries_, 0), vectors, lists, depth)
        assert (least <= scores).all() and (scores <= most).all()


def test_scores_beyond_doubles_are_exact():
    from sentimill.llm.vectors import Best

    best = Best(np.array([0]), 2, np.int64)
    topk_exact.aggregate(np.array([[2.0**30, 1.0]]), np.array([1, 2, 3]), np.array([[2.0**29, 1.0], [2.0**29, 2.0], [2.0**60, 0.0]]), best)
    assert best.found[0][0].tolist() == [2**63 - 1, 2**59 + 2]


def test_top_k_query(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected = brute(rows, 50, 5, 256)
    for r in queries.QUERIES["op5_topk_exact"](spark, sf_dir).collect():
        assert expected[r.query_id][r.rank - 1] == (r.vec_id, r.score)


def test_nearest_neighbours_reach_the_recall(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected = brute(rows, 20, 20)
    found = queries.QUERIES["op9_collision_ann"](spark, sf_dir).collect()
    hits = sum(r.vec_id in {i for i, _ in expected[r.query_id]} for r in found)
    assert len(found) == 20 * len(expected) and hits / len(found) >= 0.9
    vectors = dict(rows)
    assert all(abs(r.score - np.dot(vectors[r.query_id], vectors[r.vec_id])) < 1e-12 for r in found)


def test_neighbours_of_odd_vectors(spark):
    df = spark.createDataFrame(odd_vectors(), VECTOR).withColumn("dim", F.lit("clash"))
    found = ann.nearest(df, F.col("vec_id") % 10 == 0).toPandas()
    assert not set(found.query_id) & {400, 430} and not set(found.vec_id) & {400, 402, 404, 406, 408, 430}
    # All candidates of a query with fewer than 20, and ties by id.
    assert found[found.query_id == 410].vec_id.tolist() == [420]
    tied = found[(found.query_id == 350)].sort_values("rank")
    same = tied[np.isclose(tied.score, 2.0)].vec_id.tolist()
    assert same == sorted(same)
    assert ann.nearest(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


# Components and pipeline ---------------------------------------------------------------------


def test_components_of_chains_stars_and_rings(spark):
    pairs = [(i, i + 1) for i in range(0, 120)] + [(500, i) for i in range(501, 700)] + [(900, 901), (901, 902), (902, 900), (7, 7), (None, 3)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(1, 121)}, **{i: 500 for i in range(501, 700)}, 901: 900, 902: 900}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, sf_dir), name)
        assert docs.columns == columns
        kept[name] = docs.toPandas()
    assert len(kept["language"]) == n
    assert kept["near_dedup"].doc_id.is_unique and len(kept["near_dedup"]) < n
    assert len(kept["without_pii"]) == len(kept["near_dedup"])
    assert not kept["without_pii"].text.str.contains(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[a-z]", regex=True).any()
    assert kept["mixed"].groupby("doc_id").size().max() <= 2
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    assert set(packed.doc_id) == set(kept["mixed"].doc_id)


def test_pipeline_of_odd_documents(spark):
    docs = spark.createDataFrame(ODD, DOC)
    for rows in (docs, docs.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            rows = corpus_pipeline.stage(step(spark, rows, ""), name)
        assert rows.filter("length < 1").count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_have_their_number(name):
    assert name.startswith("op") and name.split("_")[0][2:].isdigit()


def test_blocks_are_dealt_to_the_tasks_evenly(spark):
    """Tasks had been drawn by hash: one had several blocks and others none, so most of the search waited for one task."""
    from pyspark import TaskContext

    from sentimill.llm.vectors import search, usable

    tasks, rows = 2 * spark.sparkContext.defaultParallelism, 8
    vectors = spark.range(0, rows * tasks, 1, 4).select(
        F.col("id").alias("vec_id"), F.array(*[F.lit(1.0), F.col("id").cast("double")]).alias("embedding")
    )

    def kernel(queries, ids, block, best):
        for q in range(len(queries)):
            best.add(q, np.full(len(ids), float(TaskContext.get().partitionId())), ids)

    found = search(usable(vectors), F.col("vec_id") == 0, kernel, rows * tasks, "double", rows).collect()
    held = {}
    for r in found:
        held.setdefault(r.score, []).append(r.vec_id)
    assert len(found) == rows * tasks and len(held) == tasks and {len(ids) for ids in held.values()} == {rows}
    # Fewer blocks than tasks: every query meets every block once, in tasks that share the queries.
    asked = search(usable(vectors), F.col("vec_id") % 2 == 0, kernel, rows * tasks, "double", rows * tasks)
    assert asked.groupBy("query_id").count().select("count").distinct().collect() == [(rows * tasks,)]


def test_collisions_are_counted_exactly(monkeypatch):
    """Vectors that have missed too many windows are given up early; the others are those that a full count finds."""
    rnd = np.random.default_rng(5)
    stands = np.argsort(rnd.random((ann.PROJECTIONS, 400)), axis=1).astype(np.uint16)
    lower, width = rnd.integers(0, 200, ann.PROJECTIONS), rnd.integers(50, 200, ann.PROJECTIONS)
    full = ((stands >= lower[:, None]) & (stands < (lower + width)[:, None])).sum(axis=0)
    for needed in (1, 60, 80, 100, 120, 250):
        for few in (1, 4, 10**9):
            monkeypatch.setattr(ann, "FEW", few)
            assert ann._collided(stands, lower, lower + width, needed).tolist() == np.flatnonzero(full >= needed).tolist()
