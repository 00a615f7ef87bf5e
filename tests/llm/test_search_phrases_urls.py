"""Ranked lexical search, phrase collocations and URL filters against plain versions and on odd rows."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentimill.llm import collocations, lexical, queries, url_filter

DOCS = "doc_id long, text string, lang string"

# Ranked lexical search -----------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_rank(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    counted = [(doc_id, tf, sum(tf.values())) for doc_id, tf in counted if tf]
    n, words = len(counted), sum(size for _, _, size in counted)
    df = Counter(t for _, tf, _ in counted for t in tf)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    asked = defaultdict(set)
    for item_id, text in items:
        asked[item_id] |= set(plain_terms(text))
    rows = []
    for item_id, terms in asked.items():
        scored = []
        for doc_id, tf, size in counted:
            m = 100 - 90 + (90 * size * n) // words
            score = sum(weight[t] * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms if t in tf)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(rows, key=repr)


def ranked(spark, docs, items, k=lexical.K):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical.rank(frame, asked, k).collect()), key=repr)


def test_search_equals_scoring_everything(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = queries.QUERIES["op11_document_tree_search"](spark, sf_dir)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_rank(docs, items, 10)


def test_search_with_odd_rows(spark):
    long_text = " ".join(f"w{i % 977}" for i in range(200_000))
    docs = [
        (1, "Alpha beta"), (1, "Alpha beta"), (2, "ALPHA  beta"), (None, "alpha beta"), (3, ""), (4, None), (5, "... !"),
        (6, long_text), (7, "ÄLPHA beta"), (8, "gamma Äl\u00e9 1st"), (9, "alpha " * 500),
    ]
    items = [(1, "alpha ALPHA gamma"), (1, "w5"), (2, None), (3, ""), (None, "beta"), (4, "nowhere"), (5, "1st Älé")]
    assert ranked(spark, docs, items) == plain_rank(docs, items, 10)
    assert ranked(spark, docs, items, 2) == plain_rank(docs, items, 2)
    assert ranked(spark, [], items) == ranked(spark, docs, []) == []


def test_search_ignores_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 7)], "doc_id long, text string, n int, score int")
    items = spark.createDataFrame([(1, "a", 3)], "item_id long, text string, doc_id int")
    assert lexical.rank(docs, items).count() == 1


def test_items_in_several_packs(spark, monkeypatch):
    rnd = np.random.default_rng(1)
    docs = [(i, " ".join(f"t{x}" for x in rnd.zipf(1.3, rnd.integers(1, 60)) % 300)) for i in range(300)]
    items = [(i, " ".join(f"t{x}" for x in rnd.integers(0, 300, 12))) for i in range(40)]
    monkeypatch.setattr(lexical, "PACK_TERMS", 300)
    monkeypatch.setattr(lexical, "TREE_TERMS", 700)
    monkeypatch.setattr(lexical, "CELLS", 50)
    assert ranked(spark, docs, items) == plain_rank(docs, items, 10)


def tree_of(vectors):
    """vectors: (id, m, {rank: tf})."""
    rows = [(i, True, m, np.array(sorted(v), np.int32), np.array([v[r] for r in sorted(v)], np.int64)) for i, m, v in vectors]
    return lexical.Tree(rows)


def test_nodes_bound_what_lies_below_them():
    rnd = np.random.default_rng(2)
    vectors = [(i, int(rnd.integers(10, 300)), {int(r): int(rnd.integers(1, 9)) for r in rnd.zipf(1.5, 20) % 40}) for i in range(400)]
    vectors += [(400 + i, 50, {0: 1, 1: 1}) for i in range(100)]  # a group of copies
    tree = tree_of(vectors)
    by_id = {i: (m, v) for i, m, v in vectors}
    buckets = [n for n in tree.nodes if not n.children]
    assert sorted(x for b in buckets for x in range(b.begin, b.end)) == list(range(500))
    assert max(b.end - b.begin for b in buckets) <= lexical.BUCKET
    for node in tree.nodes:
        below = [by_id[i] for i in tree.ids[node.begin : node.end].tolist()]
        most = defaultdict(int)
        for _, v in below:
            for r, tf in v.items():
                most[r] = max(most[r], tf)
        assert dict(zip(node.ranks.tolist(), node.tf.tolist(), strict=True)) == most
        assert node.m == min(m for m, _ in below)


def test_nested_documents_do_not_recurse():
    tree = tree_of([(i, 10, dict.fromkeys(range(i + 1), 1)) for i in range(1500)])
    assert tree.root.end == 1500


def test_items_leave_out_most_documents(spark):
    """In a collection with different subjects, most pairs of document and item are never scored."""
    rnd = np.random.default_rng(3)
    subject = lambda s: " ".join(f"s{s}x{x}" for x in rnd.zipf(1.4, 40) % 200)
    docs = spark.createDataFrame([(i, subject(i % 20)) for i in range(4000)], "doc_id long, text string")
    own = lexical.item_terms(spark.createDataFrame([(s, subject(s)) for s in range(20)], "item_id long, text string")).collect()
    vocabulary = sorted({t.encode() for row in own for t in row["terms"]})
    rows = lexical.vectors(docs, vocabulary).toArrow()
    df = Counter(p for places in rows.column("places").to_pylist() for p in places)
    items = lexical._ranked_items(own, vocabulary, df, rows.num_rows, sum(rows.column("n").to_pylist()))
    search = lexical.Search(items)
    for tree in lexical._trees(iter(rows.combine_chunks().to_batches()), items):
        search.visit(tree)
    assert search.all > 0.9 * 4000 * 20
    assert search.scored < 0.2 * search.all


# Phrase collocations -------------------------------------------------------------------------


def plain_collocations(rows, least, first):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts[lang].update(tuple(words[i : i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    if 100 * a >= 80 * f[p[i : i + n]]:
                        dropped.add(p[i : i + n])
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (score, a, phrase, l, r) in enumerate(sorted(scored)[:first]):
            out.append((lang, i + 1, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found_collocations(spark, rows, least=3, first=50):
    docs = spark.createDataFrame(rows, "lang string, text string")
    return sorted(map(tuple, collocations.collocations(docs, least, first).collect()))


def test_collocations_equal_plain_counting(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").collect()]
    found = queries.QUERIES["op12_collocations"](spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows, 30, 2000)
    assert all(t == "bigint" for c, t in found.dtypes if c not in ("lang", "phrase"))


def test_collocations_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(collocations, "GATHERED", 64)
    rnd = np.random.default_rng(5)
    rows = [("en", " ".join(f"w{x}" for x in rnd.zipf(1.5, 50) % 9)) for _ in range(60)]
    rows += [
        (None, "Ab ab\tAB  ab. ab"), (None, None), ("und", "ab ab, ab ab"), ("fr", ""), ("de", " .,;:!?\n\x0b\x0c\r"),
        ("en", "É É É é é\x1fé\u00a0é é\u00a0é é\u00a0é"), *[("en", "same text of copies, again")] * 5, ("xx", "a " * 5000),
    ]
    assert found_collocations(spark, rows) == plain_collocations(rows, 3, 50)
    assert found_collocations(spark, rows, 3, 4) == plain_collocations(rows, 3, 4)
    assert found_collocations(spark, []) == found_collocations(spark, [("en", None)]) == []


def test_collocations_ignore_other_columns(spark):
    docs = spark.createDataFrame([("en", "a b", 1, 2, 3, 4)] * 40, "lang string, text string, phrase int, n int, part int, k int")
    (row,) = collocations.collocations(docs).collect()
    assert tuple(row) == ("en", 1, "a b", 40, 40, 40, 80, 1000000)


def test_products_may_pass_a_long(spark, monkeypatch):
    huge = 6 * 10**17
    table = spark.createDataFrame(
        [("en", 1, "a", huge), ("en", 1, "b", huge + 1), ("en", 2, "a b", huge)], "lang string, size int, phrase string, f long"
    )
    monkeypatch.setattr(collocations, "frequent_phrases", lambda docs, least: table)
    (row,) = collocations.collocations(spark.createDataFrame([("en", "a b")], "lang string, text string")).collect()
    assert row["score"] == 2000000 * huge // (2 * huge + 1)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), max_size=80), max_size=12), st.integers(2, 9))
def test_summaries_keep_every_frequent_key(runs, least):
    """Capacity beyond mass / least: what was taken off stays below least, and frequent keys survive, however runs come."""
    total = Counter(x for run in runs for x in run)
    summary = collocations.Summary(sum(total.values()) // least + 1)
    for run in runs:
        own = Counter(run)
        summary.add(np.array(list(own), np.uint32), np.array(list(own.values()), np.int64))
        summary.merge()
        assert len(summary.keys) <= summary.capacity
    kept = set(summary.survivors(least).tolist())
    assert summary.taken < least
    assert {x for x, n in total.items() if n >= least} <= kept
    for key, n in zip(summary.keys.tolist(), summary.counts.tolist(), strict=True):
        assert total[key] - summary.taken <= n <= total[key]


def test_the_filter_has_every_survivor_and_a_bounded_size(spark, monkeypatch):
    found = spark.range(5000).select((F.col("id") % 7).cast("int").alias("part"), (F.col("id") * 7919).alias("key"))
    keys = np.array([(r.part << 32) | r.key for r in found.collect()], dtype=np.uint64)
    others = np.random.default_rng(0).integers(0, 1 << 40, 20_000, dtype=np.uint64) | np.uint64(1 << 45)
    kept = collocations.key_filter(found)
    assert collocations._has(kept, keys).all()
    assert collocations._has(kept, others).mean() < 0.05
    # A filter that is too small lets more through, and the exact counts do not change.
    monkeypatch.setattr(collocations, "FILTER_BITS", 64)
    assert len(collocations.key_filter(found)) == 1
    rows = [("en", "the quick fox. the quick dog, a quick fox")] * 4
    assert found_collocations(spark, rows) == plain_collocations(rows, 3, 50)


# URL filters ---------------------------------------------------------------------------------


def plain_glob(glob):
    parts = re.split(r"(\*\*|\*|\?)", glob)
    return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts), re.DOTALL)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text("ab/.*?é", min_size=1, max_size=90), min_size=1, max_size=9),
    st.lists(st.text("ab/.éx", max_size=100), min_size=1, max_size=9),
)
def test_the_automaton_equals_regular_expressions(globs, texts):
    found = url_filter.build([(glob, i) for i, glob in enumerate(globs)]).run(texts)
    for text, fits in zip(texts, found, strict=True):
        assert sorted(fits) == [i for i, glob in enumerate(globs) if plain_glob(glob).fullmatch(text)]


def judged(spark, urls, **settings):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    return [tuple(r)[1:] for r in url_filter.judge(pages, **settings).orderBy("page_id").collect()]


def test_urls_are_cut_and_judged(spark):
    cases = {
        "http://a.NET/x": ("a.net", "/x", "net/", "block"),
        "http://net/": ("net", "/", "net/", "block"),
        "http://net": ("net", "", None, "allow"),
        "http://a.net?q=/": ("a.net", "", None, "allow"),
        "http://foonet/": ("foonet", "/", None, "allow"),
        "https://m.example.net/en/25#top": ("m.example.net", "/en/25", "example.net/en/", "allow"),
        "https://m.example.net/EN/25": ("m.example.net", "/EN/25", "net/", "block"),
        "https://badexample.com/de/": ("badexample.com", "/de/", None, "allow"),
        "https://x.example.com/de/?a": ("x.example.com", "/de/", "example.com/de/", "block"),
        "https://example.com/de": ("example.com", "/de", None, "allow"),
        "//a.net/": ("", "", None, "allow"),
        "http://a.com/b.net/": ("a.com", "/b.net/", None, "allow"),
        "http://a.com/http://b.net/": ("a.com", "/http://b.net/", None, "allow"),
        "http://ÄB.Org/fr/\n": ("Äb.org", "/fr/\n", "org/fr/", "allow"),
        "http://a.net:80/": ("a.net:80", "/", None, "allow"),
        "": ("", "", None, "allow"),
        "http://a.net/" + "x" * 200_000: ("a.net", "/" + "x" * 200_000, "net/", "block"),
    }
    assert judged(spark, [*cases, None, "http://a.net/x", "http://a.net/x"]) == [
        *cases.values(), ("", "", None, "allow"), *[("a.net", "/x", "net/", "block")] * 2
    ]
    assert judged(spark, []) == []


def test_many_rules_with_wildcards(spark):
    rules = [("block", f"host{i}.example", f"/a{i}/*/z") for i in range(300)] + [("allow", "host7.example", "/a7/ok/zz")]
    found = judged(spark, ["u://host7.example/a7/ok/zzz", "u://www.host299.example/a299/b/z9", "u://host8.example/a8/b/c/z"], rules=rules)
    assert [f[2:] for f in found] == [
        ("host7.example/a7/ok/zz", "allow"), ("host299.example/a299/*/z", "block"), (None, "allow"),
    ]
    with pytest.raises(ValueError, match="words of masks"):
        url_filter.build([("".join(chr(200 + i) for i in range(20_000)), 0)] * 20)


def test_urls_ignore_other_columns(spark):
    pages = spark.createDataFrame([(1, "u://a.net/", "h", 2)], "page_id long, url string, host string, path int")
    assert tuple(url_filter.judge(pages).first()) == (1, "a.net", "/", "net/", "block")
