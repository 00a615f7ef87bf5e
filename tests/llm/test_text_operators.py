"""The operators on texts against plain versions, and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import plan_of
from sentimill.llm import langid, packing, pii, quality, queries, simhash_dedup, text_features, toxicity

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n ", "en", "a", 3),
    (None, "no id here", "en", "b", 10),
    (4, "same text twice", "en", "a", 15),
    (4, "same text twice", "en", "a", 15),
    (5, "x" * 200_000, None, "a", 200_000),
    (6, "long " * 30_000, "en", "b", 150_000),
    (7, "émoji 😀 <|endoftext|> é", "fr", "a", 24),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC).withColumn("key", F.lit(1)).withColumn("rank", F.lit("clash"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_definition(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    for text in [*texts, None, "", " ", "one", "One TWO", "É a É", "a\x1cb c"]:
        assert simhash_dedup.fingerprint_of(text) == plain_fingerprint(text)


def plain_components(fingerprints):
    root = list(range(len(fingerprints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fingerprints)):
        for j in range(i):
            if ((fingerprints[i] ^ fingerprints[j]) & (2**64 - 1)).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fingerprints))]


def test_links_connect_all_pairs_within_two_bits(spark):
    rnd = random.Random(5)
    seeds = [rnd.getrandbits(64) for _ in range(12)]
    fps = set(seeds)
    for seed in seeds[:4]:  # dense groups: chains and balls of near fingerprints
        for _ in range(60):
            seed ^= 1 << rnd.randrange(64)
            fps.add(seed)
            fps.add(seed ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    signed = [f - 2**64 if f >= 2**63 else f for f in sorted(fps)]
    pairs = simhash_dedup.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    assert all(((p.a ^ p.b) & (2**64 - 1)).bit_count() <= 2 for p in pairs)
    place = {f: i for i, f in enumerate(signed)}
    root = list(range(len(signed)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for p in pairs:
        root[find(place[p.a])] = find(place[p.b])
    ours = [find(i) for i in range(len(signed))]
    theirs = plain_components(signed)
    assert len(set(ours)) == len(set(theirs)) == len(set(zip(ours, theirs)))


def test_simhash_query_equals_brute_force(spark, sf_dir):
    found = queries.QUERIES["op7_simhash_dedup"](spark, sf_dir).toPandas()
    roots = plain_components([int(f, 16) for f in found.fingerprint])
    least = {}
    for root, doc in zip(roots, found.doc_id):
        least[root] = min(least.get(root, doc), doc)
    assert [least[r] for r in roots] == found.component_id.tolist()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_near_duplicates_of_odd_rows(spark, odd, empty):
    found = simhash_dedup.near_duplicates(odd).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].fingerprint == "0" * 16
    assert by_id[1].component_id == by_id[2].component_id == by_id[3].component_id == 1
    assert by_id[None].component_id is None
    kept = simhash_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7]
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_one_row_of_each_component_is_kept(spark):
    """Brute force over fingerprints; rows with one id and different components stay each."""
    rnd = random.Random(11)
    rows = []
    for g in range(25):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([4, 40, 900]))]
        for copy in range(rnd.choice([1, 1, 3])):
            other = list(words)
            if copy == 2:
                other[rnd.randrange(len(other))] = "changed"
            rows.append((rnd.choice([g, 100 + g, 7, None]), " ".join(other)))
    rows += [(50, rows[0][1]), (50, rows[0][1]), (60, None), (61, "")]
    kept = simhash_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    roots = plain_components([plain_fingerprint(t) for _, t in rows])
    best = {}
    for root, (doc, text) in zip(roots, rows):
        order = (doc is None, doc or 0, hashlib.md5((text or "").encode()).hexdigest())
        best[root] = min(best.get(root, order), order)
    found = sorted((r.doc_id is None, r.doc_id or 0, hashlib.md5((r.text or "").encode()).hexdigest()) for r in kept)
    assert found == sorted(best.values())


def test_rows_with_any_columns_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6), (1, "a b", 5, 6), (2, "c d", 7, 8)], "doc_id long, text string, _id int, hash int")
    docs = docs.withColumn("row", F.create_map(F.lit("a"), F.lit(1))).withColumn("fp", F.array(F.lit(1))).withColumn("nameless", F.lit("x"))
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r._id, r["hash"], r["row"]["a"]) for r in kept.collect()) == [(1, 5, 6, 1), (2, 7, 8, 1)]


# Personal data -------------------------------------------------------------------------------


def plain_base(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        check = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and check % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


@pytest.mark.parametrize("letters", ["0123456789.- +@a", "a.@-b1é+ ", "0123456789 -", "+0123456789() .-"])
def test_base_spans_equal_the_patterns(letters):
    rnd, find = random.Random(7), pii.Finder()
    for _ in range(5000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        assert [s[:3] for s in find(text) if s[3]] == plain_base(text), text


def test_pii_query_equals_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in queries.QUERIES["op4_pii_anchors"](spark, sf_dir).collect():
        base = plain_base(docs[row.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(
            sum(s[0] == kind for s in base) for kind in pii.BASE_KINDS
        )


def test_spans_the_method_adds():
    find = pii.Finder()

    def added(text):
        return [(k, text[a:b]) for k, a, b, base in find(text) if not base]

    assert added("IBAN: DE89 3704 0044 0532 0130 00.") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert added("IBAN: DE89 3704 0044 0532 0130 01.") == []
    assert added("josé@exámple.org") == [("email", "josé@exámple.org")]
    assert added("ftp://me:pw@host.example/x") == [("url", "ftp://me:pw@host.example")]
    assert added("ssn 123-45-6789, ssn 000-12-3456") == [("account", "123-45-6789")]
    assert added("see https://example.org/licenses and a token of thanks") == []


def test_masking_odd_rows(odd, empty, spark):
    rows = spark.createDataFrame([(1, "mail a@b.co now", "en", "s", 15)], DOC)
    assert [tuple(r) for r in pii.masked(rows).collect()] == [(1, "mail <email> now", "en", "s", 16)]
    assert pii.masked(odd).drop("n_chars").exceptAll(odd.drop("n_chars")).count() == 0
    assert pii.find(odd).count() == len(ODD) and pii.find(empty).count() == 0
    assert pii.digest(pii.find(odd)).filter("spans != ''").count() == 0


# Packing -------------------------------------------------------------------------------------


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    path = queries.vocabulary_path()
    encoder, tokenizer = packing.Encoder(path), Tokenizer.from_file(path)
    rnd = random.Random(1)
    letters = [*" \n\t\r\x1c\x85\xa0 ab'stéÈ12,.!!<|endoftext|>世😀²½", "<|endoftext|>", " <|endoftext|> "]
    assert np.frombuffer(encoder.ids("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [7, 16, 64])
def test_plans_use_every_piece_once(capacity):
    rnd = random.Random(capacity)
    for _ in range(60):
        counts = {rnd.randint(1, capacity): rnd.randint(1, 50) for _ in range(rnd.randint(0, 12))}
        used = {}
        for lengths, n in packing.combine(counts, capacity):
            assert sum(lengths) <= capacity and n > 0
            for length in lengths:
                used[length] = used.get(length, 0) + n
        assert used == counts


def plain_best_fit(lengths, capacity):
    """Best fit in falling order, piece by piece."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, gap in enumerate(gaps) if gap >= length]
        if fits:
            at = min(fits, key=lambda i: gaps[i])
            gaps[at] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_plans_need_no_more_sequences_than_plain_best_fit(seed):
    rnd = random.Random(seed)
    lengths = [min(64, max(1, int(rnd.lognormvariate(2.5, 1)))) for _ in range(600)]
    plan = packing.combine(dict(Counter(lengths)), 64)
    assert -(-sum(lengths) // 64) <= sum(n for _, n in plan) <= plain_best_fit(lengths, 64)


def test_exact_fits_are_found():
    assert sum(n for _, n in packing.combine({10: 3, 6: 3, 5: 6, 4: 3, 2: 9, 3: 6}, 16)) == 8  # 126 tokens do not fit into 7


def test_packing_query_is_a_packing(spark, sf_dir):
    found = queries.QUERIES["op8_best_fit_packing"](spark, sf_dir).toPandas()
    ordered = found.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id").length.cumsum()
    assert (ends - ordered.length == ordered.offset).all() and ends.max() <= 2048
    assert found.sequence_id.nunique() <= 1.03 * np.ceil(found.length.sum() / 2048)
    pieces = found.sort_values(["doc_id", "piece"])
    assert (pieces.groupby("doc_id").length.cumsum() - pieces.length == pieces.start).all()
    assert (pieces[pieces.piece > 0].length == 2048).all()
    assert found.doc_id.nunique() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_sequences_hold_the_ids(spark, odd, empty):
    path = queries.vocabulary_path()
    pieces = packing.stage(packing.pieces(odd, path, keep_ids=True), "pieces")
    packed = packing.pack(pieces)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    rows = packed.collect()
    assert all(whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids for r in rows)
    assert sum(len(ids) for ids in whole.values()) == 4 * sum(r.length for r in rows)
    assert {r.length for r in rows if r.doc_id in (1, 2)} == {1}
    assert sum(r.doc_id == 4 for r in rows) == 2
    assert packing.pack_documents(empty, path).count() == 0


# Classifiers ---------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.QUERIES["op2_language_id"](spark, sf_dir)
    known = found.join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = known.filter("held_out").toPandas()
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert held.score.between(0, 1).all()


def plain_language(model, text):
    """The model's definition, number by number."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    counts = langid.gram_counts(text)
    values = {p: (1 + np.log(c)) * model.idf[p] for p, c in enumerate(counts) if c}
    length = sum(v * v for v in values.values()) ** 0.5
    scores = []
    for j in range(len(model.languages)):
        seen = ((p, v) for p, v in values.items() if model.rows[p] >= 0)
        scores.append((model.weights[-1, j] + sum(v / length * model.weights[model.rows[p], j] for p, v in seen)) / model.temperature)
    chances = [np.exp(s - max(scores)) for s in scores]
    best = int(np.argmax(scores))
    return model.languages[best], chances[best] / sum(chances)


def test_language_scores_equal_the_definition(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs)
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for row in docs.limit(40).collect():
        lang, score = plain_language(model, row.text)
        assert found[row.doc_id].lang_pred == lang and abs(found[row.doc_id].score - score) < 1e-3


def test_numerals_are_no_letters(spark):
    model = langid.Model(["x"], np.zeros((1, 1), np.float32), np.ones(langid.PLACES), rows=np.full(langid.PLACES, -1, np.int32))
    for text in ("²³¹", "½ ¼", "①②", "Ⅷ ⅻ", "123 _ !", ""):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("² é")[0] == "x"


def plain_ordinal_loss(values, theta, grades, weight):
    total = 0.0
    for v, g, w in zip(values, grades, weight, strict=True):
        above = [1.0, *[1 / (1 + np.exp(t - v)) for t in theta], 0.0]
        total -= w * np.log(above[g] - above[g + 1])
    return total


def test_the_likelihood_and_its_slopes():
    rnd = np.random.default_rng(3)
    values, theta, grades = rnd.normal(size=40), np.array([-0.5, 0.3, 1.4]), rnd.integers(0, 4, 40)
    weight = rnd.random(40)
    loss, by_value, by_edge = toxicity.ordinal_loss(values, theta, grades, weight)
    assert abs(loss - plain_ordinal_loss(values, theta, grades, weight)) < 1e-9
    for i in range(40):
        moved = values + 1e-6 * (np.arange(40) == i)
        assert abs((plain_ordinal_loss(moved, theta, grades, weight) - loss) / 1e-6 - by_value[i]) < 1e-4
    for j in range(3):
        moved = theta + 1e-6 * (np.arange(3) == j)
        assert abs((plain_ordinal_loss(values, moved, grades, weight) - loss) / 1e-6 - by_edge[j]) < 1e-4
    extreme = toxicity.ordinal_loss(np.array([800.0, -800.0]), theta, np.array([1, 2]), np.ones(2))
    assert np.isfinite(extreme[0]) and np.isfinite(extreme[1]).all()


def test_no_other_weights_have_a_better_likelihood():
    rnd = np.random.default_rng(4)
    rows = [(np.flatnonzero(rnd.random(6) < 0.5), None) for _ in range(200)]
    rows = [(c, 1.0 + rnd.random(len(c))) for c, _ in rows]
    truth = np.array([2.0, -1.0, 0.0, 0.0, 1.0, 0.0])
    values = np.array([v @ truth[c] for c, v in rows]) + rnd.logistic(size=200)
    grades = (values[:, None] > np.array([0.5, 2.0, 4.0])).sum(axis=1)
    x, weight = toxicity._Sparse(rows, 6), np.full(200, 1 / 200)
    w, theta = toxicity._fit_ordinal(x, grades, weight)

    def penalised(w, theta):
        return plain_ordinal_loss(x.times(w), theta, grades, weight) + toxicity.L1 * np.abs(w).sum()

    best = penalised(w, theta)
    for _ in range(300):
        assert penalised(w + rnd.normal(size=6) * 0.02, np.sort(theta + rnd.normal(size=3) * 0.02)) >= best - 1e-6


@pytest.mark.parametrize("fit, label", [(quality.fit, "quality"), (toxicity.fit, "toxic")])
def test_a_draw_shuffles_no_texts_and_is_bounded(spark, monkeypatch, fit, label):
    """A third of all rows have one drawn id: one of their texts is learned from, and texts meet the draw by broadcast."""
    rows = [(3 if i % 3 == 0 else i, f"text {i} good" if i % 2 else f"text {i} vile") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)] * 2, f"doc_id long, {label} int")
    marks = text_features.learnable(labels).select("doc_id", F.col(label).alias("label"))
    sample = text_features.labelled_sample(text_features.learnable(docs), marks, "label", 60)
    assert len(sample) <= 60 + 2 * text_features.CLASS_ROWS
    drawn = text_features.class_sample(marks, "label", 60)
    met = docs.join(F.broadcast(drawn), "doc_id")
    assert "Exchange hashpartitioning" not in plan_of(met)
    fit(docs, labels)


def test_every_class_has_a_place_and_the_rest_is_shared(spark):
    rows = [(i, f"text {i}", f"junk{i}") for i in range(300)] + [(1000 + i, f"text {i}", "abcd"[i % 4]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = Counter(r.lang for r in text_features.class_sample(docs, "lang", 700).collect())
    assert len(drawn) == 304
    assert [drawn[lang] for lang in "abcd"] == [100] * 4


def test_language_of_odd_rows(spark, odd, empty):
    model = langid.fit(odd)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == len(ODD)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert langid.accepted(odd, model).columns == odd.columns
    nothing = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
    assert langid.predict(empty, nothing).count() == 0


def test_held_out_rule(spark):
    import zlib

    rows = langid.predict(spark.range(30).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), langid.Model([], np.zeros((1, 0)), np.zeros(0)))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.collect())


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.QUERIES["op6_quality_votes"](spark, sf_dir)
    held = found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert (held.quality == held.predicted).mean() > 0.95
    assert found.count() == 1000


def test_quality_votes_equal_brute_force():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["ab", "CD!!", "ef,", "gh"]) for _ in range(rnd.randint(1, 30))) for _ in range(60)]
    model = quality.Model(np.ones(quality.PLACES, np.float32), np.zeros((quality.PLACES, 4), np.float32), np.zeros((0, 4), np.float32), np.zeros(0), 0.4)
    assert (model.score(texts) == 0.4).all()
    model.axes = quality._axes(model.weighed(texts), 4)
    model.vectors, model.labels = model.place(texts), np.array([i % 2 for i in range(60)], dtype=float)
    for text, score in zip(texts[:10], model.score(texts[:10])):
        cosines = (model.place([text])[0] @ model.vectors.T).astype(float)
        near = sorted(range(60), key=lambda i: -cosines[i])[: quality.NEIGHBOURS]
        weight = [max(0.0, cosines[i]) for i in near]
        # Texts alike have equal cosines, and which of them are the last of the nearest is open: their labels bracket the score.
        edge = cosines[near[-1]]
        sure = [i for i in range(60) if cosines[i] > edge + 1e-6]
        open_labels = sorted(model.labels[i] for i in range(60) if abs(cosines[i] - edge) <= 1e-6)
        votes = [sum(cosines[i] * model.labels[i] for i in sure) + edge * sum(open_labels[part]) for part in
                 (slice(0, len(near) - len(sure)), slice(len(open_labels) - len(near) + len(sure), None))]
        assert votes[0] / sum(weight) - 1e-4 <= score <= votes[1] / sum(weight) + 1e-4


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(2, 0), (4, 1), (6, None), (None, 1), (5, 1), (99, 0)], "doc_id long, quality int")
    rows = quality.score(odd, quality.fit(odd, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert quality.score(empty, quality.fit(empty, labels.limit(0))).count() == 0


def test_severity_grows_with_the_cues():
    rnd = random.Random(3)
    clean = [" ".join(rnd.choice("one two three four five six".split()) for _ in range(20)) for _ in range(300)]
    toxic = [f"{t} " + " ".join(["scum"] * rnd.randint(1, 9)) for t in clean[:150]]
    model = toxicity.fit_texts([(0, t) for t in clean] + [(1, t) for t in toxic], 0.3)
    assert list(model.thresholds) == sorted(model.thresholds)
    severity = [model.above("one two " + "scum " * n).sum() for n in (0, 1, 4, 9)]
    assert severity == sorted(severity) and severity[0] < 0.2 < 1 <= severity[2]


def test_toxicity_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = queries.QUERIES["op10_toxicity_severity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("toxic", "label")
    held = found.join(labels, "doc_id").filter("held_out").toPandas()
    assert held[held.label == 1].toxic.mean() > 0.9 and held[held.label == 0].toxic.mean() < 0.01


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(2, 0), (4, 1), (6, None), (None, 1), (7, 1), (3, 0)], "doc_id long, toxic int")
    rows = toxicity.severity(odd, toxicity.fit(odd, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.severity <= 3 for r in rows)
    untrained = toxicity.fit(odd, labels.limit(0))
    assert {r.severity for r in toxicity.severity(odd, untrained).collect()} == {0.0}
    assert toxicity.severity(empty, untrained).count() == 0
