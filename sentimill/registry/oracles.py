"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from sentimill.functions.constants import (
    CONTRACTIONS,
    EXTRA_CHARS,
    SHOP_WORDS,
    STOP_WORDS,
    TOKEN,
    VECTOR_TERM,
    WORD_RUN,
    markup_pattern,
)
from sentimill.operators.linear import LR_C, SVM_ALPHA, SVM_ALPHAS, SVM_LOSSES, SVM_MIN_DF, SVM_PENALTIES
from sentimill.operators.naive_bayes import GRID_ALPHAS, GRID_MAX_DF, GRID_MIN_DF
from sentimill.operators.nmf import EPSILON
from sentimill.registry.queries import NMF_ITERATIONS, PRODUCT


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def word_list(words) -> str:
    return ", ".join(quote(w) for w in words)


def hash_unit(key: str, seed: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {quote(TOKEN)})"


def without_stop_words(words: str) -> str:
    return f"list_filter({words}, lambda w: w NOT IN ({word_list(STOP_WORDS)}))"


def review_tokens(text: str, extra: str = "") -> str:
    plain = f"regexp_replace(lower({text}), {quote(markup_pattern(extra))}, '', 'g')"
    return f"regexp_extract_all({plain}, {quote(TOKEN)})"


def review_text(text: str, remove: bool, extra: str = "") -> str:
    words = review_tokens(text, extra)
    return f"array_to_string({without_stop_words(words) if remove else words}, ' ')"


def expanded(text: str) -> str:
    cases = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in CONTRACTIONS.items())
    words = f"regexp_extract_all({text}, {quote(WORD_RUN)})"
    return f"array_to_string(list_transform({words}, lambda w: CASE w {cases} ELSE w END), ' ')"


def summary_words(text: str) -> str:
    return without_stop_words(
        f"regexp_extract_all({expanded(f'lower({text})')}, {quote(TOKEN)})"
    )


def with_ctes(ctes: list[tuple[str, str]], select: str) -> str:
    """A query over named parts; each part is computed once."""
    parts = ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in ctes)
    return f"WITH {parts}\n{select}"


# Shared parts --------------------------------------------------------------------------------

RAW = (
    "raw",
    """SELECT cast(d.doc_id AS VARCHAR) AS "Id", d.source AS "ProductId",
       CASE WHEN l.quality = 1 THEN '5' WHEN l.quality = 0 THEN '1'
            WHEN d.doc_id % 7 = 0 THEN 'junk' WHEN d.doc_id % 11 = 0 THEN NULL
            ELSE cast(2 + d.doc_id % 3 AS VARCHAR) END AS "Score",
       cast(1325376000 + d.doc_id * 86400 AS VARCHAR) AS "Time",
       split_part(d.text, chr(10), 1) AS "Summary", d.text AS "Text"
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
LENGTHS = (
    "lengths",
    f"""SELECT *, len({tokens('"Summary"')})::BIGINT AS "Summary_len",
       len({tokens('"Text"')})::BIGINT AS "Text_len" FROM raw""",
)
LENGTH_RULE = (
    '"Summary_len" <= 20 AND "Text_len" > 20 AND "Text_len" * 0.5 > "Summary_len" '
    'AND "Text_len" <= 250'
)
CLEAN = (
    "clean",
    f"""SELECT "Id", "ProductId", cast("Score" AS INTEGER) AS "Score", "Time",
       lower("Summary") AS "Summary", lower("Text") AS "Text", "Summary_len", "Text_len",
       array_to_string({summary_words('"Summary"')}, ' ') AS "Summary_cleaned"
FROM lengths WHERE "Score" IN ('1', '2', '3', '4', '5') AND {LENGTH_RULE}""",
)
RATIO = """(SELECT CASE WHEN count(*) FILTER (WHERE "Score" = 5) = 0 THEN NULL
       ELSE least(count(*) FILTER (WHERE "Score" = 1) / count(*) FILTER (WHERE "Score" = 5)::DOUBLE, 1.0) END FROM clean)"""
DRAWN = f"{hash_unit(chr(34) + 'Id' + chr(34), 'undersample')} < {RATIO}"
BALANCED = (
    "balanced",
    f"""SELECT * FROM clean WHERE "Score" = 1
UNION ALL SELECT * FROM clean WHERE "Score" = 5 AND {DRAWN}""",
)
CLEANED = [RAW, LENGTHS, CLEAN]

LABELLED = (
    "labelled",
    """SELECT d.doc_id, l.quality AS label, d.text,
       split_part(d.text, chr(10), 1) AS predicted_summary,
       CASE WHEN l.quality = 1 THEN 5 ELSE 1 END AS score,
       d.source AS productid, 1325376000 + d.doc_id * 86400 AS time
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
)
SPLIT = (
    "split",
    """SELECT doc_id, label, rn <= quota AS is_train FROM (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('100:' || doc_id)) AS rn
  FROM labelled
) JOIN (
  SELECT label, floor(exact)::BIGINT + (row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, label)
         <= take - sum(floor(exact)) OVER ())::INT AS quota
  FROM (SELECT label, n, take, n * take / total::DOUBLE AS exact FROM (
    SELECT label, count(*) AS n, sum(count(*)) OVER () AS total,
           floor(sum(count(*)) OVER () * 0.75::DOUBLE) AS take FROM labelled GROUP BY label))
) USING (label)""",
)


def posting_part(name: str, source: str, columns: str, text: str = "text") -> tuple[str, str]:
    return (
        name,
        f"""SELECT {columns}, term, count(*) AS tf FROM (
  SELECT {columns}, unnest({review_tokens(text)}) AS term FROM {source})
WHERE length(term) > 1 AND term NOT IN ({word_list(STOP_WORDS)}) GROUP BY ALL""",
    )


POSTINGS = posting_part("postings", "labelled", "doc_id, label")
TRAIN = ("train", "SELECT p.* FROM postings p JOIN split s USING (doc_id) WHERE s.is_train")
SIZES = (
    "sizes",
    "SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1, count(*) AS n FROM split WHERE is_train",
)
BNB = (
    "bnb",
    """SELECT term, df, ln((n + 1) / (df + 1)::DOUBLE) + 1 AS idf, ln(p0) AS lp0, ln(p1) AS lp1,
       ln(1 - p0) AS ln0, ln(1 - p1) AS ln1 FROM (
  SELECT term, df, n, (c0 + 1) / (n0 + 2)::DOUBLE AS p0, (c1 + 1) / (n1 + 2)::DOUBLE AS p1 FROM (
    SELECT term, count(*) AS df, count(*) FILTER (WHERE label = 0) AS c0, count(*) FILTER (WHERE label = 1) AS c1
    FROM train GROUP BY term), sizes)""",
)


def margins_part(name: str, reviews: str, postings: str) -> tuple[str, str]:
    return (
        name,
        f"""SELECT l.doc_id, l.label, coalesce(e.d0, 0) + b.s0 AS s0, coalesce(e.d1, 0) + b.s1 AS s1
FROM {reviews} l
LEFT JOIN (SELECT doc_id, sum(lp0 - ln0) AS d0, sum(lp1 - ln1) AS d1
           FROM {postings} JOIN bnb USING (term) GROUP BY doc_id) e USING (doc_id)
CROSS JOIN (SELECT any_value(ln(n0 / n::DOUBLE)) + sum(ln0) AS s0,
                   any_value(ln(n1 / n::DOUBLE)) + sum(ln1) AS s1 FROM bnb, sizes) b""",
    )


def scored_part(name: str, margins: str) -> tuple[str, str]:
    return (
        name,
        f"""SELECT doc_id, label, (s1 > s0)::INT AS predicted,
       1 / (1 + CASE WHEN s0 - s1 > 700 THEN 'Infinity'::DOUBLE ELSE exp(s0 - s1) END) AS proba
FROM {margins}""",
    )


MARGINS = margins_part("margins", "labelled", "postings")
SCORED = scored_part("scored", "margins")
TESTED = ("tested", "SELECT c.* FROM scored c JOIN split s USING (doc_id) WHERE NOT s.is_train")
REVIEWS = (
    "reviews",
    """SELECT cast("Id" AS BIGINT) AS doc_id, NULL AS label, "Text" AS text, "Summary" AS predicted_summary,
       coalesce(try_cast("Score" AS INTEGER), 0) AS score, "ProductId" AS productid, cast("Time" AS BIGINT) AS time FROM raw""",
)
REVIEW_POSTINGS = posting_part("review_postings", "reviews", "doc_id")
ENTRIES = (
    "entries",
    """SELECT l.doc_id, text, predicted_summary, score, productid, time,
       predicted AS predicted_score, CASE WHEN predicted = 1 THEN 1 ELSE -1 END AS predicted_sentiment,
       round(proba, 6) AS predicted_proba FROM reviews l JOIN review_scores USING (doc_id)""",
)
FITTED = [LABELLED, SPLIT, POSTINGS, TRAIN, SIZES, BNB]
TEST = [*FITTED, MARGINS, SCORED, TESTED]
ENTRY = [
    *FITTED,
    RAW,
    REVIEWS,
    REVIEW_POSTINGS,
    margins_part("review_margins", "reviews", "review_postings"),
    scored_part("review_scores", "review_margins"),
    ENTRIES,
]

NUM = (
    "num",
    """SELECT cast(l_partkey AS VARCHAR) AS productid, epoch(l_shipdate)::BIGINT AS time,
       CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS predicted_score,
       CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS predicted_sentiment,
       l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem""",
)
DATE_OF_TIME = "(DATE '1970-01-01' + (time // 86400)::INT)"

TOTALS = (
    "totals",
    """SELECT productid, sum(predicted_sentiment)::BIGINT AS sentiment,
       ((200 * sum(predicted_score) + count(*)) // (2 * count(*)))::BIGINT AS positive_percent,
       count(*) AS reviews FROM num GROUP BY productid""",
)

# Profiling -----------------------------------------------------------------------------------

RAW_COLUMNS = ("Id", "ProductId", "Score", "Time", "Summary", "Text")


def per_column(condition: str) -> str:
    parts = [
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {condition.replace('?', chr(34) + c + chr(34))}) AS rows FROM raw"""
        for c in RAW_COLUMNS
    ]
    return with_ctes([RAW], "\nUNION ALL ".join(parts))


IS_NAN = "coalesce(isnan(try_cast(? AS DOUBLE)), false)"


def histogram(name: str, where: str) -> str:
    return f"""SELECT b.bin, round(lo + b.bin * (hi - lo) / 10, 6) AS low,
       round(lo + (b.bin + 1) * (hi - lo) / 10, 6) AS high, count("Text_len") AS rows, '{name}' AS texts
FROM (SELECT unnest(range(10))::INT AS bin) b
CROSS JOIN (SELECT min("Text_len")::DOUBLE AS lo, max("Text_len")::DOUBLE AS hi FROM lengths WHERE {where}) m
LEFT JOIN (SELECT "Text_len" FROM lengths WHERE {where}) t
  ON least(floor(("Text_len" - lo) * 10 / (hi - lo)), 9)::INT = b.bin
GROUP BY b.bin, lo, hi"""


# The rows a profile is taken of: those the earlier rules of the funnel keep.
FUNNEL_SHORT = '"Summary_len" < "Text_len" AND "Summary_len" BETWEEN 1 AND 20'
FUNNEL_LONG = f'{FUNNEL_SHORT} AND "Text_len" > 20 AND "Text_len" * 0.5 > "Summary_len"'


def described(where: str, column: str = '"Text_len"') -> str:
    return with_ctes(
        [RAW, LENGTHS],
        f"""SELECT count({column}) AS count, round(avg({column}), 6) AS mean,
       round(stddev_samp({column}), 6) AS stddev, min({column}) AS min, max({column}) AS max FROM lengths
WHERE {where}""",
    )


PROFILE = {
    "describe_lengths_kept": described(FUNNEL_LONG),
    "describe_lengths_before_text_filter": described(FUNNEL_SHORT),
    "describe_summary_lengths": described("true", '"Summary_len"'),
    "short_text_share_kept": with_ctes(
        [RAW, LENGTHS],
        f"""SELECT count(*) FILTER (WHERE "Text_len" <= 20) AS short_rows, count(*) AS rows,
       ((200 * count(*) FILTER (WHERE "Text_len" <= 20) + count(*)) // (2 * count(*))) / 100::DOUBLE AS share
FROM lengths WHERE {FUNNEL_SHORT}""",
    ),
    "length_histogram_kept": with_ctes(
        [RAW, LENGTHS],
        histogram("all", FUNNEL_LONG) + "\nUNION ALL " + histogram("up to 250", f'{FUNNEL_LONG} AND "Text_len" <= 250'),
    ),
    "row_count": with_ctes([RAW], "SELECT count(*) AS rows FROM raw"),
    "nan_counts": per_column(IS_NAN),
    "null_or_nan_counts": per_column(f"? IS NULL OR {IS_NAN}"),
    "describe_lengths": with_ctes(
        [RAW, LENGTHS],
        """SELECT count("Text_len") AS count, round(avg("Text_len"), 6) AS mean,
       round(stddev_samp("Text_len"), 6) AS stddev, min("Text_len") AS min, max("Text_len") AS max FROM lengths""",
    ),
    "distinct_scores": with_ctes(
        [RAW],
        """SELECT DISTINCT "Score", 'before' AS stage FROM raw
UNION ALL SELECT DISTINCT "Score", 'after' AS stage FROM raw WHERE "Score" IN ('1', '2', '3', '4', '5')""",
    ),
    "length_funnel": with_ctes(
        [RAW, LENGTHS],
        """SELECT count(*) FILTER (WHERE s >= t) AS summary_not_shorter, count(*) FILTER (WHERE s < t AND s > 20) AS summary_too_long,
       count(*) FILTER (WHERE s < t AND s <= 20 AND s = 0) AS summary_empty,
       count(*) FILTER (WHERE s < t AND s <= 20 AND s <= 1) AS summary_one_word_or_less,
       count(*) FILTER (WHERE s < t AND s BETWEEN 1 AND 20 AND t <= 20) AS text_too_short,
       count(*) FILTER (WHERE s < t AND s BETWEEN 1 AND 20 AND t > 20 AND t * 0.5 <= s) AS summary_over_half,
       count(*) FILTER (WHERE s BETWEEN 1 AND 20 AND t > 20 AND t * 0.5 > s AND t <= 250
                AND "Score" IN ('1', '2', '3', '4', '5')) AS valid_scores
FROM (SELECT "Score", "Summary_len" AS s, "Text_len" AS t FROM lengths)""",
    ),
    "short_text_share": with_ctes(
        [RAW, LENGTHS],
        """SELECT count(*) FILTER (WHERE "Text_len" <= 20) AS short_rows, count(*) AS rows,
       ((200 * count(*) FILTER (WHERE "Text_len" <= 20) + count(*)) // (2 * count(*))) / 100::DOUBLE AS share FROM lengths""",
    ),
    "length_histogram": with_ctes(
        [RAW, LENGTHS],
        histogram("all", "true") + "\nUNION ALL " + histogram("up to 250", '"Text_len" <= 250'),
    ),
    "score_histogram": with_ctes(
        [RAW], 'SELECT "Score", count(*) AS rows FROM raw GROUP BY "Score"'
    ),
    "class_counts": with_ctes(
        [RAW],
        """SELECT count(*) FILTER (WHERE "Score" = '1') AS one_star, count(*) FILTER (WHERE "Score" = '5') AS five_star FROM raw""",
    ),
    "sample_short_summaries": with_ctes(
        [RAW, LENGTHS],
        """(SELECT "Id", "Summary", 0 AS length FROM lengths WHERE "Summary_len" = 0 ORDER BY "Id" LIMIT 5)
UNION ALL (SELECT "Id", "Summary", 1 AS length FROM lengths WHERE "Summary_len" = 1 ORDER BY "Id" LIMIT 20)""",
    ),
}

# Sources, text, sampling ---------------------------------------------------------------------

TEXT = {
    "read_reviews": with_ctes([RAW], "SELECT * FROM raw"),
    "read_reviews_in_blocks": with_ctes([RAW], "SELECT * FROM raw"),
    "read_balanced": with_ctes(
        [*CLEANED, BALANCED], 'SELECT "Text", "Summary", "Score" FROM balanced'
    ),
    "read_sql_table": with_ctes(
        [NUM], "SELECT productid, time, predicted_sentiment FROM num WHERE predicted_score = 0"
    ),
    "export_pairs": with_ctes(
        CLEANED,
        f"""SELECT "Id", "Text", "Summary",
       CASE WHEN {hash_unit('"Id"', 'split')} < 0.9 THEN 'train' ELSE 'valid' END AS split FROM clean""",
    ),
    "lowercase_text": with_ctes(
        [RAW], 'SELECT "Id", lower("Summary") AS "Summary", lower("Text") AS "Text" FROM raw'
    ),
    "token_lengths": with_ctes(
        [RAW, LENGTHS], 'SELECT "Id", "Summary_len", "Text_len" FROM lengths'
    ),
    "filter_reviews": with_ctes(
        [RAW, LENGTHS],
        f"""SELECT "Id", false AS drop_empty FROM lengths WHERE {LENGTH_RULE}
UNION ALL SELECT "Id", true AS drop_empty FROM lengths
WHERE {LENGTH_RULE} AND "Summary_len" < "Text_len" AND "Summary_len" > 0""",
    ),
    "expand_contractions": with_ctes(
        [RAW], f"""SELECT "Id", {expanded('lower("Text")')} AS "Text" FROM raw"""
    ),
    "clean_summary": with_ctes(
        [RAW],
        f"""SELECT "Id", len(words)::INT AS words, array_to_string(words, ' ') AS "Summary_cleaned"
FROM (SELECT "Id", {summary_words('"Summary"')} AS words FROM raw)""",
    ),
    "clean_review_text": f"""SELECT kind, id, {review_text('text', True)} AS cleaned,
       {review_text('text', False, EXTRA_CHARS)} AS cleaned_all_words
FROM (SELECT 'document' AS kind, doc_id AS id, text FROM documents
      UNION ALL SELECT 'page', page_id, html FROM pages)""",
    "clean_text_columns": with_ctes(
        [RAW],
        f"""SELECT "Id", {review_text('"Summary"', False)} AS "Summary",
       {review_text('"Text"', True)} AS "Text" FROM raw""",
    ),
    "valid_scores": with_ctes(
        [RAW],
        """SELECT "Id", cast("Score" AS INTEGER) AS "Score" FROM raw
WHERE "Score" IN ('1', '2', '3', '4', '5')""",
    ),
    "binary_label": with_ctes(
        [*CLEANED, BALANCED],
        """SELECT "Text", "Summary", CASE "Score" WHEN 1 THEN 0 ELSE 1 END AS "Score" FROM balanced""",
    ),
    "clean_reviews": with_ctes(CLEANED, "SELECT * FROM clean"),
    "event_time": with_ctes(
        [NUM],
        "SELECT productid, TIMESTAMP '1970-01-01' + to_seconds(time) AS time, predicted_sentiment FROM num",
    ),
    "star_subsets": with_ctes(CLEANED, 'SELECT "Id", "Score" FROM clean WHERE "Score" IN (1, 5)'),
    "undersample": with_ctes(
        CLEANED, f'SELECT "Id", "Score" FROM clean WHERE "Score" = 5 AND {DRAWN}'
    ),
    "balanced_subset": with_ctes([*CLEANED, BALANCED], 'SELECT "Id", "Score" FROM balanced'),
    "random_split": with_ctes(
        [RAW],
        f"""SELECT "Id", CASE WHEN {hash_unit('"Id"', 'split')} < 0.9 THEN 'train' ELSE 'valid' END AS split
FROM raw""",
    ),
    "stratified_split": with_ctes(
        [LABELLED, SPLIT], "SELECT doc_id, label, is_train::INT AS is_train FROM split"
    ),
}

# Features and models -------------------------------------------------------------------------

ALL_POSTINGS = posting_part("postings", "documents", "doc_id")
ALL_DF = (
    "counted",
    "SELECT term, count(*) AS df, (SELECT count(*) FROM documents) AS n FROM postings GROUP BY term",
)
MNB = [
    (
        "vocab",
        """SELECT term, df, ln((n + 1) / (df + 1)::DOUBLE) + 1 AS idf FROM (
  SELECT term, count(*) AS df FROM train GROUP BY term), sizes
WHERE df >= 2 AND df <= 0.95::DOUBLE * n""",
    ),
    (
        "weights",
        """SELECT doc_id, label, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w
FROM (SELECT doc_id, label, term, tf * idf AS w FROM train JOIN vocab USING (term))""",
    ),
    (
        "summed",
        """SELECT term, sum(CASE WHEN label = 0 THEN w ELSE 0 END) AS s0,
       sum(CASE WHEN label = 1 THEN w ELSE 0 END) AS s1 FROM weights GROUP BY term""",
    ),
    (
        "mnb",
        """SELECT term, ln((s0 + 1) / (t0 + v)) AS lp0, ln((s1 + 1) / (t1 + v)) AS lp1 FROM summed
CROSS JOIN (SELECT sum(s0) AS t0, sum(s1) AS t1, count(*) AS v FROM summed)""",
    ),
]


def long_params(table: str) -> str:
    return f"""SELECT 0 AS class, term, round(lp0, 6) AS log_prob FROM {table}
UNION ALL SELECT 1, term, round(lp1, 6) FROM {table}"""


OPTIMUM = "SELECT n AS documents, (SELECT count(*) FROM bnb) AS terms, 0.0::DOUBLE AS relative_gap, 1 AS is_optimal"


def listed(column: str, items) -> str:
    """A table of the items."""
    return f"(SELECT unnest([{', '.join(map(repr, items))}]) AS {column})"


def fold_part(folds: int) -> tuple[str, str]:
    return (
        "folds",
        f"""SELECT doc_id, label, (SELECT count(*) FROM range(1, {folds}) r(j)
         WHERE rn > floor(j * n / {folds}::DOUBLE))::INT AS fold
FROM (SELECT doc_id, label, count(*) OVER (PARTITION BY label) AS n,
             row_number() OVER (PARTITION BY label ORDER BY md5('folds:' || doc_id)) AS rn
      FROM split WHERE is_train)""",
    )


def fold_sizes(folds: int) -> tuple[str, str]:
    return (
        "fold_sizes",
        f"""SELECT f::INT AS fold, count(*) FILTER (WHERE label = 0 AND folds.fold <> f) AS n0,
       count(*) FILTER (WHERE label = 1 AND folds.fold <> f) AS n1 FROM folds, range({folds}) g(f) GROUP BY f""",
    )


def fold_counts(folds: int) -> tuple[str, str]:
    return (
        "fold_counts",
        f"""SELECT term, f::INT AS fold, count(*) FILTER (WHERE t.label = 0 AND folds.fold <> f) AS c0,
       count(*) FILTER (WHERE t.label = 1 AND folds.fold <> f) AS c1
FROM train t JOIN folds USING (doc_id), range({folds}) g(f) GROUP BY term, f""",
    )


CROSS_VALIDATE = with_ctes(
    [
        LABELLED, SPLIT, POSTINGS, TRAIN, fold_part(10), fold_sizes(10), fold_counts(10),
        (
            "logs",
            """SELECT term, fold, ln(p1) - ln(p0) AS seen, ln(1 - p1) - ln(1 - p0) AS unseen FROM (
  SELECT term, fold, (c0 + 1) / (n0 + 2)::DOUBLE AS p0, (c1 + 1) / (n1 + 2)::DOUBLE AS p1
  FROM fold_counts JOIN fold_sizes USING (fold))""",
        ),
        (
            "starts",
            """SELECT fold, any_value(ln(n1 / n0::DOUBLE)) + sum(unseen) AS start
FROM logs JOIN fold_sizes USING (fold) GROUP BY fold""",
        ),
        (
            "guesses",
            """SELECT f.doc_id, f.label, f.fold, any_value(start) + coalesce(sum(seen - unseen), 0) > 0 AS positive
FROM folds f JOIN starts s ON s.fold = f.fold LEFT JOIN train t ON t.doc_id = f.doc_id
LEFT JOIN logs g ON g.term = t.term AND g.fold = f.fold GROUP BY f.doc_id, f.label, f.fold""",
        ),
        (
            "per_fold",
            """SELECT fold, count(*) AS rows, count(*) FILTER (WHERE positive = (label = 1)) AS correct,
       count(*) FILTER (WHERE positive = (label = 1)) / count(*)::DOUBLE AS accuracy FROM guesses GROUP BY fold""",
        ),
    ],
    """SELECT fold, rows, correct, round(accuracy, 6) AS accuracy,
       round((SELECT avg(accuracy) FROM per_fold), 6) AS mean_accuracy FROM per_fold""",
)


def values(column: str, items) -> str:
    """Numbers with a flag telling counts from shares."""
    rows = ", ".join(f"({float(i)!r}::DOUBLE, {str(isinstance(i, int)).lower()})" for i in items)
    return f"(VALUES {rows}) {column}v({column}, {column}_is_count)"


GRID = with_ctes(
    [
        LABELLED, SPLIT, POSTINGS, TRAIN, fold_part(5), fold_sizes(5), fold_counts(5),
        (
            "configs",
            f"""SELECT * FROM {values('alpha', GRID_ALPHAS)}, {values('min_df', GRID_MIN_DF)},
{values('max_df', GRID_MAX_DF)}""",
        ),
        (
            "logs",
            """SELECT term, fold, alpha, min_df, max_df, ln(p1) - ln(p0) AS seen,
       ln(1 - p1) - ln(1 - p0) AS unseen FROM (
  SELECT term, fold, alpha, min_df, max_df, (c0 + alpha) / (n0 + 2 * alpha) AS p0,
         (c1 + alpha) / (n1 + 2 * alpha) AS p1
  FROM fold_counts JOIN fold_sizes USING (fold), configs
  WHERE c0 + c1 > 0
    AND c0 + c1 >= CASE WHEN min_df_is_count THEN min_df ELSE min_df * (n0 + n1) END
    AND c0 + c1 <= CASE WHEN max_df_is_count THEN max_df ELSE max_df * (n0 + n1) END)""",
        ),
        (
            "starts",
            """SELECT fold, alpha, min_df, max_df, any_value(ln(n1 / n0::DOUBLE)) + coalesce(sum(unseen), 0) AS start
FROM fold_sizes CROSS JOIN configs LEFT JOIN logs USING (fold, alpha, min_df, max_df)
GROUP BY fold, alpha, min_df, max_df""",
        ),
        (
            "gains",
            """SELECT t.doc_id, g.alpha, g.min_df, g.max_df, sum(seen - unseen) AS gain
FROM train t JOIN folds f USING (doc_id) JOIN logs g ON g.term = t.term AND g.fold = f.fold
GROUP BY t.doc_id, g.alpha, g.min_df, g.max_df""",
        ),
        (
            "held_out",
            """SELECT f.fold, f.label, s.alpha, s.min_df, s.max_df,
       round(1 / (1 + exp(-(s.start + coalesce(g.gain, 0)))), 12) AS score
FROM folds f JOIN starts s ON s.fold = f.fold
LEFT JOIN gains g ON g.doc_id = f.doc_id AND g.alpha = s.alpha AND g.min_df = s.min_df AND g.max_df = s.max_df""",
        ),
        (
            "ranked",
            """SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY fold, alpha, min_df, max_df, score) - 1) / 2.0::DOUBLE AS r
FROM held_out WINDOW w AS (PARTITION BY fold, alpha, min_df, max_df ORDER BY score)""",
        ),
        (
            "aucs",
            """SELECT fold, alpha, min_df, max_df,
       (sum(CASE WHEN label = 1 THEN r END) - p * (p + 1) / 2.0::DOUBLE) / nullif(p * (n - p), 0) AS auc
FROM (SELECT *, count(*) FILTER (WHERE label = 1) OVER g AS p, count(*) OVER g AS n FROM ranked
      WINDOW g AS (PARTITION BY fold, alpha, min_df, max_df))
GROUP BY fold, alpha, min_df, max_df, p, n""",
        ),
        (
            "means",
            "SELECT alpha, min_df, max_df, round(avg(auc), 6) AS mean_auc FROM aucs GROUP BY alpha, min_df, max_df",
        ),
    ],
    """SELECT alpha, min_df, max_df, mean_auc,
       (row_number() OVER (ORDER BY mean_auc DESC, alpha, min_df, max_df) = 1)::INT AS is_best FROM means""",
)

MODELS = {
    "term_counts": with_ctes([ALL_POSTINGS], "SELECT * FROM postings"),
    "vocabulary": with_ctes(
        [ALL_POSTINGS, ALL_DF],
        "SELECT term, df, (df >= 2 AND df <= 0.95::DOUBLE * n)::INT AS in_narrow FROM counted",
    ),
    "tfidf": with_ctes(
        [ALL_POSTINGS, ALL_DF],
        """SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight
FROM (SELECT doc_id, term, tf * (ln((n + 1) / (df + 1)::DOUBLE) + 1) AS w
      FROM postings JOIN counted USING (term))""",
    ),
    "bernoulli_nb_fit": with_ctes(FITTED, long_params("bnb")),
    "save_model": with_ctes(FITTED, long_params("bnb")),
    "multinomial_nb_fit": with_ctes(
        [LABELLED, SPLIT, POSTINGS, TRAIN, SIZES, *MNB], long_params("mnb")
    ),
    "load_model": with_ctes(
        [LABELLED, SPLIT, POSTINGS, TRAIN, SIZES, *MNB],
        """SELECT doc_id, label, (s1 > s0)::INT AS predicted, round(1 / (1 + exp(s0 - s1)), 6) AS proba FROM (
  SELECT s.doc_id, s.label, ln(any_value(n0) / any_value(n)::DOUBLE) + coalesce(sum(tf * idf * lp0) / sqrt(sum(tf * idf * tf * idf)), 0) AS s0,
         ln(any_value(n1) / any_value(n)::DOUBLE) + coalesce(sum(tf * idf * lp1) / sqrt(sum(tf * idf * tf * idf)), 0) AS s1
  FROM split s CROSS JOIN sizes
  LEFT JOIN (postings p JOIN vocab USING (term) JOIN mnb USING (term)) k ON k.doc_id = s.doc_id
  WHERE NOT s.is_train GROUP BY s.doc_id, s.label)""",
    ),
    "nb_predict": with_ctes(TEST, "SELECT doc_id, label, predicted FROM tested"),
    "nb_predict_proba": with_ctes(
        TEST, "SELECT doc_id, round(1 - proba, 6) AS proba0, round(proba, 6) AS proba1 FROM tested"
    ),
    "score_reviews": with_ctes(ENTRY, "SELECT * FROM entries"),
    "negative_reviews": with_ctes(
        ENTRY, "SELECT doc_id, productid, text FROM entries WHERE predicted_score = 0"
    ),
    "sentiment_label": with_ctes(
        ENTRY,
        """SELECT doc_id, CASE WHEN predicted_score = 1 THEN 'Positive' ELSE 'Negative' END AS sentiment,
       round(predicted_proba * 100, 1) AS proba_percent FROM entries""",
    ),
    # What a converged linear model must say of itself; its weights have no SQL.
    "logistic_fit_optimum": with_ctes(FITTED, f"{OPTIMUM}, 1.0::DOUBLE AS c FROM sizes"),
    "svm_fit_optimum": with_ctes(FITTED, f"{OPTIMUM}, {SVM_ALPHA}::DOUBLE AS alpha FROM sizes"),
    "svm_cross_validate_folds": with_ctes(
        [LABELLED, SPLIT, fold_part(10)], "SELECT fold, count(*) AS rows, 1 AS is_converged FROM folds GROUP BY fold"
    ),
    "svm_grid_settings": with_ctes(
        [LABELLED, SPLIT],
        f"""SELECT loss, penalty, alpha::DOUBLE AS alpha, min_df::DOUBLE AS min_df,
       (SELECT count(*) FROM split WHERE is_train) AS held_out
FROM {listed("loss", SVM_LOSSES)}, {listed("penalty", SVM_PENALTIES)}, {listed("alpha", SVM_ALPHAS)}, {listed("min_df", SVM_MIN_DF)}""",
    ),
    "lr_grid_settings": with_ctes(
        [LABELLED, SPLIT],
        f"""SELECT c::DOUBLE AS c, (SELECT count(*) FROM split WHERE is_train) AS held_out, 1 AS is_converged
FROM {listed("c", LR_C)}""",
    ),
    "cross_validate": CROSS_VALIDATE,
    "nb_grid_search": GRID,
}

# Evaluation ----------------------------------------------------------------------------------

CELLS = (
    "cells",
    """SELECT count(*) FILTER (WHERE predicted = 0 AND label = 0) AS m00, count(*) FILTER (WHERE predicted = 0 AND label = 1) AS m01,
       count(*) FILTER (WHERE predicted = 1 AND label = 0) AS m10, count(*) FILTER (WHERE predicted = 1 AND label = 1) AS m11 FROM tested""",
)


def auc(score: str, name: str) -> str:
    return f"""SELECT round((sum(CASE WHEN label = 1 THEN r END) - p * (p + 1) / 2.0::DOUBLE)
       / nullif(p * (n - p), 0), 6) AS auc, '{name}' AS score
FROM (SELECT label, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0::DOUBLE AS r,
             count(*) FILTER (WHERE label = 1) OVER () AS p, count(*) OVER () AS n
      FROM (SELECT label, predicted, round(proba, 12) AS proba FROM tested)) GROUP BY p, n"""


METRICS = {
    "accuracy": with_ctes(
        TEST,
        "SELECT count(*) AS rows, round(count(*) FILTER (WHERE predicted = label) / count(*)::DOUBLE, 6) AS accuracy FROM tested",
    ),
    "roc_auc": with_ctes(TEST, auc("proba", "proba") + "\nUNION ALL " + auc("predicted", "class")),
    "roc_curve": with_ctes(
        [
            *TEST,
            (
                "points",
                """SELECT s, pos, neg, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, sum(pos) OVER () AS p,
       sum(neg) OVER () AS n, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
       row_number() OVER w AS place
FROM (SELECT round(proba, 12) AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
      FROM tested GROUP BY round(proba, 12)) WINDOW w AS (ORDER BY s DESC)""",
            ),
        ],
        """SELECT round(s, 6) AS threshold, round(fps / n::DOUBLE, 6) AS fpr, round(tps / p::DOUBLE, 6) AS tpr
FROM points WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT round(max(s) + 1, 6), 0.0, 0.0 FROM points""",
    ),
    "confusion_matrix": with_ctes(
        [*TEST, CELLS],
        """SELECT 0 AS predicted, m00 AS true_0, m01 AS true_1 FROM cells
UNION ALL SELECT 1, m10, m11 FROM cells""",
    ),
    "confusion_normalised": with_ctes(
        [*TEST, CELLS],
        """SELECT 0 AS predicted, round(m00 / nullif(m00 + m01, 0)::DOUBLE, 6) AS true_0,
       round(m01 / nullif(m00 + m01, 0)::DOUBLE, 6) AS true_1 FROM cells
UNION ALL SELECT 1, round(m10 / nullif(m10 + m11, 0)::DOUBLE, 6),
       round(m11 / nullif(m10 + m11, 0)::DOUBLE, 6) FROM cells""",
    ),
    "confusion_rates": with_ctes(
        [*TEST, CELLS],
        """SELECT round(m01 / nullif(m01 + m11, 0)::DOUBLE, 6) AS miss_rate_pos,
       round(m00 / nullif(m00 + m01, 0)::DOUBLE, 6) AS precision_neg,
       round(m11 / nullif(m01 + m11, 0)::DOUBLE, 6) AS tpr,
       round(m10 / nullif(m00 + m10, 0)::DOUBLE, 6) AS fpr FROM cells""",
    ),
}

# Reports -------------------------------------------------------------------------------------

REVIEW_COLUMNS = "text, predicted_summary, predicted_score, score, predicted_proba, productid"
BEST_FIRST = "ORDER BY predicted_proba DESC NULLS FIRST, doc_id"
LIKE = f"productid LIKE '{PRODUCT}'"


def period(bucket: str, name: str) -> str:
    return with_ctes(
        [
            NUM,
            (
                "periods",
                f"""SELECT {bucket} AS {name}, count(*) FILTER (WHERE predicted_sentiment = 1) AS positive,
       count(*) FILTER (WHERE predicted_sentiment = -1) AS negative FROM num GROUP BY 1""",
            ),
        ],
        "SELECT *, (SELECT max(greatest(positive, negative)) + 1 FROM periods) AS axis_limit FROM periods",
    )


def product_period(bucket: str, name: str) -> str:
    return with_ctes(
        [NUM],
        f"""SELECT *, max(greatest(positive, negative)) OVER (PARTITION BY productid) + 1 AS axis_limit FROM (
  SELECT productid, {bucket} AS {name}, count(*) FILTER (WHERE predicted_sentiment = 1) AS positive,
         count(*) FILTER (WHERE predicted_sentiment = -1) AS negative FROM num GROUP BY ALL)""",
    )


REPORTS = {
    "product_quarterly_sentiment": product_period(f"date_trunc('quarter', {DATE_OF_TIME})::DATE::VARCHAR", "quarter"),
    "product_yearly_sentiment": product_period(f"year({DATE_OF_TIME})::INT", "year"),
    "top_reviews": with_ctes(
        ENTRY, f"SELECT doc_id, {REVIEW_COLUMNS} FROM entries {BEST_FIRST} LIMIT 30"
    ),
    "distinct_products": with_ctes([NUM], "SELECT DISTINCT productid FROM num"),
    "product_top_reviews": with_ctes(
        ENTRY, f"SELECT doc_id, {REVIEW_COLUMNS} FROM entries WHERE {LIKE} {BEST_FIRST} LIMIT 30"
    ),
    "top_reviews_per_product": with_ctes(
        ENTRY,
        f"""SELECT doc_id, (row_number() OVER (PARTITION BY productid {BEST_FIRST}))::INT AS place,
       {REVIEW_COLUMNS} FROM entries QUALIFY place <= 30""",
    ),
    "product_negative_text": with_ctes(
        ENTRY, f"SELECT doc_id, text FROM entries WHERE predicted_score = 0 AND {LIKE}"
    ),
    "product_timeline": with_ctes(
        ENTRY,
        f"SELECT doc_id, time, predicted_sentiment FROM entries WHERE {LIKE} ORDER BY time, doc_id",
    ),
    "sentiment_totals": with_ctes([NUM, TOTALS], "SELECT * FROM totals ORDER BY sentiment, productid"),
    "rolling_sentiment": with_ctes(
        [NUM],
        """SELECT time, productid, predicted_sentiment,
       (sum(predicted_sentiment) OVER (ORDER BY time))::BIGINT AS running_sentiment
FROM (SELECT DISTINCT time, productid, predicted_sentiment FROM num)""",
    ),
    "quarterly_sentiment": period(f"date_trunc('quarter', {DATE_OF_TIME})::DATE::VARCHAR", "quarter"),
    "yearly_sentiment": period(f"year({DATE_OF_TIME})::INT", "year"),
    "cumulative_sentiment": with_ctes(
        [NUM],
        """SELECT productid, time, l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
       (sum(predicted_sentiment) OVER (PARTITION BY productid
          ORDER BY time, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
          ROWS UNBOUNDED PRECEDING))::BIGINT AS cumulative FROM num""",
    ),
    "recent_dates": with_ctes(
        [RAW, REVIEWS],
        f"""SELECT doc_id, {DATE_OF_TIME}::DATE::VARCHAR AS date
FROM (SELECT doc_id, time FROM reviews ORDER BY time DESC, doc_id DESC LIMIT 50) ORDER BY time, doc_id""",
    ),
    "sorted_totals": with_ctes(
        [NUM, TOTALS],
        """SELECT productid, sentiment::INT AS sentiment, positive_percent::INT AS positive_percent,
       reviews::INT AS reviews FROM totals ORDER BY reviews DESC, productid""",
    ),
}

# Topics --------------------------------------------------------------------------------------

TOPICS = 10
L1, L2 = 0.1 * 0.5, 0.1 * 0.5


def start_values(name: str, key: str) -> str:
    """Three hex digits of a hash per topic, scaled to (0, 1]."""
    digits = f"substr(md5('nmf-{name}0:' || {key}), 3 * t::INT + 1, 3)"
    return f"(('0x' || {digits})::BIGINT + 1) / 4096.0::DOUBLE"


NEGATIVE = [
    (
        "negative_terms",
        f"""SELECT productid, doc_id, term, count(*) AS tf FROM (
  SELECT productid, doc_id, unnest(regexp_extract_all(lower(text), {quote(VECTOR_TERM)})) AS term
  FROM entries WHERE predicted_score = 0) WHERE term NOT IN ({word_list(STOP_WORDS)}) GROUP BY ALL""",
    ),
    (
        "x",
        """SELECT productid, doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY productid, doc_id)) AS weight
FROM (SELECT productid, doc_id, term, tf * idf AS w FROM negative_terms JOIN bnb USING (term))""",
    ),
    (
        "topic_numbers",
        f"""SELECT productid, t FROM (SELECT productid, least({TOPICS}, count(*)) AS k FROM entries
WHERE predicted_score = 0 GROUP BY productid),
range({TOPICS}) g(t) WHERE t < k""",
    ),
    (
        "w0",
        f"""SELECT productid, doc_id, t, {start_values('w', "productid || '|' || doc_id")} AS v
FROM (SELECT DISTINCT productid, doc_id FROM x) JOIN topic_numbers USING (productid)""",
    ),
    (
        "h0",
        f"""SELECT productid, term, t, {start_values('h', "productid || '|' || term")} AS v
FROM (SELECT DISTINCT productid, term FROM x) JOIN topic_numbers USING (productid)""",
    ),
]


def shares(w: str, h: str) -> str:
    return f"""SELECT productid, doc_id, term, weight / greatest(sum(w.v * h.v), {EPSILON!r}::DOUBLE) AS q
FROM x JOIN {w} w USING (productid, doc_id) JOIN {h} h USING (productid, term, t)
GROUP BY productid, doc_id, term, weight"""


def nmf_parts(iterations: int) -> list[tuple[str, str]]:
    parts = []
    for i in range(iterations):
        w, h, new_w, new_h = f"w{i}", f"h{i}", f"w{i + 1}", f"h{i + 1}"
        for name, old, fixed, mine, other in (
            (new_w, w, h, "doc_id", "term"),
            (new_h, h, new_w, "term", "doc_id"),
        ):
            quotient = shares(w, h) if name == new_w else shares(new_w, h)
            parts.append((f"q_{name}", quotient))
            parts.append(
                (
                    name,
                    f"""SELECT o.productid, o.{mine}, o.t,
       o.v * n.n / greatest(s.s + {L1} + {L2} * o.v, {EPSILON!r}::DOUBLE) AS v
FROM {old} o
JOIN (SELECT q.productid, q.{mine}, f.t, sum(q.q * f.v) AS n FROM q_{name} q
      JOIN {fixed} f ON f.productid = q.productid AND f.{other} = q.{other} GROUP BY ALL) n
  ON n.productid = o.productid AND n.{mine} = o.{mine} AND n.t = o.t
JOIN (SELECT productid, t, sum(v) AS s FROM {fixed} GROUP BY ALL) s
  ON s.productid = o.productid AND s.t = o.t""",
                )
            )
    return parts


FACTORED = [*ENTRY, *NEGATIVE, *nmf_parts(NMF_ITERATIONS)]
WORDS = (
    "words",
    f"""SELECT productid, t::INT AS topic,
       (row_number() OVER (PARTITION BY productid, t ORDER BY round(v, 9) DESC, term))::INT AS place, term
FROM h{NMF_ITERATIONS} QUALIFY place <= 10""",
)
CLASSED = (
    "classed",
    "SELECT productid, topic, place, term, (round(lp1 - lp0, 9) > 0)::INT AS word_class FROM words JOIN bnb USING (term)",
)
NEGATIVE_WORDS = (
    "negative_words",
    f"SELECT * FROM classed WHERE word_class = 0 AND term NOT IN ({word_list(SHOP_WORDS)})",
)

TOPIC = {
    "negative_tfidf": with_ctes(
        [*ENTRY, *NEGATIVE[:2]],
        "SELECT productid, doc_id, term, round(weight, 6) AS weight FROM x",
    ),
    "nmf_topics_finished": with_ctes(
        [*ENTRY, *NEGATIVE[:3]],
        """SELECT productid, topics, reviews, terms, 1 AS is_settled, 1 AS is_stationary
FROM (SELECT productid, count(*)::INT AS topics FROM topic_numbers GROUP BY productid)
JOIN (SELECT productid, count(DISTINCT doc_id) AS reviews, count(DISTINCT term) AS terms FROM x GROUP BY productid)
  USING (productid)""",
    ),
    "nmf_topics_five_steps": with_ctes(
        FACTORED,
        f"SELECT productid, t::INT AS topic, term, round(v, 6) AS weight FROM h{NMF_ITERATIONS}",
    ),
    "top_topic_words_five_steps": with_ctes([*FACTORED, WORDS], "SELECT * FROM words"),
    "word_class_five_steps": with_ctes([*FACTORED, WORDS, CLASSED], "SELECT * FROM classed"),
    "negative_words_five_steps": with_ctes(
        [*FACTORED, WORDS, CLASSED, NEGATIVE_WORDS], "SELECT * FROM negative_words"
    ),
    "word_weights_five_steps": with_ctes(
        [*FACTORED, WORDS, CLASSED, NEGATIVE_WORDS],
        """SELECT productid, term, count(*) AS frequency FROM negative_words GROUP BY productid, term
QUALIFY row_number() OVER (PARTITION BY productid ORDER BY count(*) DESC, term) <= 200""",
    ),
}

ORACLES: dict[str, str] = {**PROFILE, **TEXT, **MODELS, **METRICS, **REPORTS, **TOPIC}
