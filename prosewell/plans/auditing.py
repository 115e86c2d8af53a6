"""Registered queries: corpus quality and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.functions import text as T
from prosewell.operators import classify, quality, similarity, sketches, terms
from prosewell.plans import fixtures as fx
from prosewell.plans.learning import _fold_sql
from prosewell.plans.messaging import MESSAGES_SQL, messages
from prosewell.plans.registry import query
from prosewell.plans.text import documents
from prosewell.sources.store import fresh_path
from prosewell.sources.tables import read_table
from prosewell.streaming.scoring import score_stream

DIGEST_SQL = r"""md5(trim(regexp_replace(text, '[ \t\n\r\f\x0b]+', ' ', 'g')))"""


@query(
    "H1_exact_duplicates",
    f"""SELECT {DIGEST_SQL} AS digest, count(*) AS copies, min(doc_id) AS first FROM documents
    GROUP BY 1 HAVING count(*) > 1""",
)
def h1(spark, folder):
    return quality.exact_duplicates(documents(spark, folder))


@query(
    "H3_drop_duplicates",
    f"""SELECT doc_id, lang, source, text FROM (SELECT *, row_number() OVER (PARTITION BY {DIGEST_SQL} ORDER BY doc_id) AS rn
    FROM documents) WHERE rn = 1""",
)
def h3(spark, folder):
    return quality.drop_duplicates(documents(spark, folder)).select("doc_id", "lang", "source", "text")


# No document is blank; those of some lengths lose their letters, alike in both engines.
BLANKED = "CASE WHEN n_chars % 25 = 0 THEN replace(repeat('0.', 20), '.', chr(10)) ELSE text END"


@query(
    "H4_blank_documents",
    f"""WITH documents AS (SELECT doc_id, {BLANKED} AS text FROM documents), a AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
    b AS (SELECT doc_id, unnest(l) AS line, (generate_subscripts(l, 1) - 1)::BIGINT AS line_no FROM a)
    SELECT doc_id, line_no FROM b WHERE len(regexp_extract_all(lower(line), '[a-z]+')) = 0
    UNION ALL SELECT doc_id, -1 FROM documents WHERE text IS NULL OR len(regexp_extract_all(lower(text), '[a-z]+')) = 0""",
)
def h4(spark, folder):
    """Blank documents, as line -1, and blank lines, each line taken as a text of its own."""
    docs = read_table(spark, folder, "documents", "doc_id").select("doc_id", F.expr(BLANKED).alias("text"))
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    blank_lines = quality.blank_documents(lines, key=["doc_id", "line_no"])
    blank_docs = quality.blank_documents(docs).withColumn("line_no", F.lit(-1))
    return blank_lines.unionByName(blank_docs).withColumn("line_no", F.col("line_no").cast("bigint"))


@query(
    "H5_cross_group_threads",
    f"""WITH {MESSAGES_SQL} SELECT thread, string_agg(DISTINCT grp, '|' ORDER BY grp) AS groups FROM threads
    GROUP BY thread HAVING count(DISTINCT grp) > 1""",
)
def h5(spark, folder):
    out = quality.cross_group_threads(messages(spark, folder))
    return out.select("thread", F.array_join("groups", "|").alias("groups"))


@query(
    "H5_cross_source_texts",
    f"""SELECT {DIGEST_SQL} AS thread, string_agg(DISTINCT source, '|' ORDER BY source) AS groups FROM documents
    GROUP BY 1 HAVING count(DISTINCT source) > 1""",
)
def h5b(spark, folder):
    digested = documents(spark, folder).select(quality.text_digest().alias("thread"), "source")
    out = quality.cross_group_threads(digested, group="source")
    return out.select("thread", F.array_join("groups", "|").alias("groups"))


SIDES_SQL = f"sides AS (SELECT *, {_fold_sql('doc_id', 5)} = 0 AS test, {DIGEST_SQL} AS digest FROM documents)"


def sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    both = classify.split(documents(spark, folder), "doc_id")
    return both.filter("side = 'train'"), both.filter("side = 'test'")


@query(
    "H6_shared_documents",
    f"WITH {SIDES_SQL} SELECT doc_id FROM sides WHERE test AND digest IN (SELECT digest FROM sides WHERE NOT test)",
)
def h6(spark, folder):
    train, test = sides(spark, folder)
    return quality.shared_documents(test, train)


@query(
    "H6_vocabulary_overlap",
    """WITH a AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents),
    b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM conversations),
    j AS (SELECT a.token AS x, b.token AS y FROM a FULL OUTER JOIN b ON a.token = b.token)
    SELECT count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS both, count(*) FILTER (y IS NULL) AS only_a,
      count(*) FILTER (x IS NULL) AS only_b, round(count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) / count(*), 6) AS jaccard FROM j""",
)
def h6b(spark, folder):
    turns = read_table(spark, folder, "conversations", ["conv_id", "turn"])
    out = quality.vocabulary_overlap(
        terms.tokenize(documents(spark, folder)), terms.tokenize(turns, key=["conv_id", "turn"])
    )
    return out.withColumn("jaccard", F.round("jaccard", 6))


@query(
    "H7_profile",
    r"""WITH s AS (SELECT lang, source, coalesce(len(regexp_extract_all(lower(text), '[a-z]+')), 0) AS tokens, strlen(coalesce(text, '')) AS b,
      len(string_split(text, chr(10))) AS lines, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\s*[>|:]'))) AS quoted FROM documents)
    SELECT lang, source, count(*) AS docs, sum(tokens)::BIGINT AS tokens, min(b)::BIGINT AS min_bytes, median(b)::DOUBLE AS median_bytes,
      max(b)::BIGINT AS max_bytes, round(avg((tokens = 0)::INT), 6) AS share_blank, round(sum(quoted) / sum(lines), 6) AS share_quoted
    FROM s GROUP BY ALL""",
)
def h7(spark, folder):
    out = quality.profile(documents(spark, folder), ["lang", "source"])
    return out.select(
        "lang",
        "source",
        "docs",
        "tokens",
        F.col("min_bytes").cast("bigint"),
        "median_bytes",
        F.col("max_bytes").cast("bigint"),
        F.round("share_blank", 6).alias("share_blank"),
        F.round("share_quoted", 6).alias("share_quoted"),
    )


@query("I1_score_stream", f"WITH {fx.HITS_SQL} SELECT doc_id, tokens, pos, neg, net, class FROM classed")
def i1(spark, folder):
    return score_stream(
        spark,
        f"{folder.rstrip('/')}/documents.parque[t]",
        "doc_id bigint, text string",
        fx.opinion_lexicon(spark),
        fresh_path(spark, "stream"),
    )


SHINGLES_SQL = """t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents),
    k AS (SELECT doc_id, len(w) AS n, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM t),
    g AS (SELECT doc_id, n, i, a || ' ' || lead(a, 1) OVER o || ' ' || lead(a, 2) OVER o || ' ' || lead(a, 3) OVER o || ' ' || lead(a, 4) OVER o AS gram FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    h AS (SELECT DISTINCT doc_id, ('0x' || substr(md5(gram), 1, 15))::BIGINT AS s FROM (
      SELECT doc_id, gram FROM g WHERE gram IS NOT NULL
      UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM t WHERE len(w) BETWEEN 1 AND 4)),"""

BANDS, ROWS, ROUNDS = 12, 3, 6


def _near_sql() -> str:
    """Leader election written out round by round; the tests hold the rule for any number of rounds."""
    lowest = ", ".join(
        f"min(({a}::HUGEINT * x + {b}) % {quality.PRIME}) AS m{i}"
        for i, (a, b) in enumerate(quality.permutations(BANDS * ROWS))
    )
    bands = " UNION ALL ".join(
        f"SELECT doc_id, '{i}:' || " + " || ':' || ".join(f"m{i * ROWS + r}" for r in range(ROWS)) + " AS bucket FROM ones"
        for i in range(BANDS)
    )
    rounds = ""
    for r in range(ROUNDS):
        rounds += f""",
    l{r} AS MATERIALIZED (SELECT bucket, min(doc_id) AS leader FROM left{r} GROUP BY bucket HAVING count(*) > 1),
    p{r} AS MATERIALIZED (SELECT f.doc_id, l.leader, f.bucket FROM left{r} f JOIN l{r} l ON l.bucket = f.bucket WHERE f.doc_id <> l.leader),
    s{r} AS MATERIALIZED (SELECT a.doc_id, a.leader, len(list_intersect(x.s, y.s)) AS c, len(x.s) + len(y.s) AS t FROM (SELECT DISTINCT doc_id, leader FROM p{r}) a
      JOIN sets x ON x.doc_id = a.doc_id JOIN sets y ON y.doc_id = a.leader),
    f{r} AS MATERIALIZED (SELECT doc_id, leader, c / (t - c) AS jaccard FROM s{r} WHERE c / (t - c) >= 0.8),
    left{r + 1} AS MATERIALIZED (SELECT p.doc_id, p.bucket || ':' || o.m{quality.refinement(r, BANDS, ROWS)} AS bucket
      FROM p{r} p JOIN ones o ON o.doc_id = p.doc_id ANTI JOIN f{r} f ON p.doc_id = f.doc_id AND p.leader = f.leader)"""
    found = " UNION ".join(f"SELECT * FROM f{r}" for r in range(ROUNDS))
    return f"""WITH {SHINGLES_SQL}
    sets AS MATERIALIZED (SELECT doc_id, list(s ORDER BY s) AS s FROM h GROUP BY doc_id),
    lows AS MATERIALIZED (SELECT doc_id, {lowest} FROM (SELECT doc_id, s % {quality.PRIME} AS x FROM h) GROUP BY doc_id),
    firsts AS MATERIALIZED (SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS leader FROM sets),
    ones AS MATERIALIZED (SELECT lows.* FROM lows JOIN firsts USING (doc_id) WHERE leader = doc_id),
    left0 AS MATERIALIZED ({bands}) {rounds}
    SELECT doc_id, leader, round(jaccard, 6) AS jaccard FROM (SELECT doc_id, leader, 1.0::DOUBLE AS jaccard FROM firsts WHERE leader <> doc_id UNION {found})"""


@query("H2_near_duplicates", _near_sql())
def h2(spark, folder):
    out = quality.near_duplicates(
        documents(spark, folder), 0.8, 5, BANDS, ROWS, hashed=quality.md5_number
    )
    return out.withColumn("jaccard", F.round("jaccard", 6))


@query(
    "H2_exact_near_duplicates",
    f"""WITH {SHINGLES_SQL}
    sets AS MATERIALIZED (SELECT doc_id, list(s ORDER BY s) AS s FROM h GROUP BY doc_id),
    firsts AS MATERIALIZED (SELECT doc_id, len(s) AS n, min(doc_id) OVER (PARTITION BY s) AS leader FROM sets),
    ones AS MATERIALIZED (SELECT h.doc_id, h.s, n FROM h JOIN firsts USING (doc_id) WHERE leader = doc_id),
    pairs AS (SELECT y.doc_id, x.doc_id AS leader, count(*) AS c, any_value(x.n + y.n) AS t FROM ones x JOIN ones y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL)
    SELECT doc_id, leader, 1.0::DOUBLE AS jaccard FROM firsts WHERE leader <> doc_id
    UNION ALL SELECT doc_id, leader, round(c / (t - c), 6) FROM pairs WHERE c / (t - c) >= 0.8""",
)
def h2_exact(spark, folder):
    """The pairs of all classes of equal shingles, and each class's members."""
    out = similarity.exact_near_duplicates(documents(spark, folder))
    return out.withColumn("jaccard", F.round("jaccard", 6))


# Sides with copies of their own: texts of one source against those of all others, by the first letters of their folded text.
SHORT_SQL = f"""sides AS (SELECT doc_id, source = (SELECT min(source) FROM documents) OR doc_id % 3 = 0 AS in_a,
  left(trim(regexp_replace(text, '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g')), 2) AS text FROM documents),
  digested AS (SELECT doc_id, in_a, {DIGEST_SQL} AS digest FROM sides),
  counted AS (SELECT digest, count(*) FILTER (in_a) AS in_a, count(*) FILTER (NOT in_a) AS in_b FROM digested GROUP BY 1)"""


def short_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Beginnings of texts, of which many are alike, on two sides."""
    docs = documents(spark, folder)
    first = docs.agg(F.min("source")).scalar()
    short = docs.select(
        "doc_id", F.coalesce((F.col("source") == first) | (F.col("doc_id") % 3 == 0), F.lit(False)).alias("in_a"),
        F.substring(T.folded("text"), 1, 2).alias("text"),
    )
    return short.filter("in_a"), short.filter("NOT in_a")


@query(
    "H6_text_multiplicities",
    f"""WITH {SHORT_SQL} SELECT digest, in_a, in_b, least(in_a, in_b) AS "both", in_a - least(in_a, in_b) AS only_a, in_b - least(in_a, in_b) AS only_b FROM counted""",
)
def h6_counts(spark, folder):
    return quality.text_multiplicities(*short_sides(spark, folder))


@query(
    "H6_multiset_difference",
    f"""WITH {SHORT_SQL}, placed AS (SELECT doc_id, in_a, digest, row_number() OVER (PARTITION BY digest, in_a ORDER BY doc_id) AS n FROM digested)
    SELECT doc_id, CASE WHEN p.in_a THEN 'a' ELSE 'b' END AS side, n <= least(c.in_a, c.in_b) AS matched FROM placed p JOIN counted c USING (digest)""",
)
def h6_rows(spark, folder):
    """Which rows of two sides match one to one, and which are left over on either."""
    return quality.multiset_difference(*short_sides(spark, folder))


@query(
    "H7_sketch_sums",
    """SELECT lang, count(*) AS docs, sum(len(regexp_extract_all(lower(text), '[a-z]+')))::BIGINT AS tokens, sum(strlen(text))::BIGINT AS bytes,
      count(*) FILTER (len(regexp_extract_all(lower(text), '[a-z]+')) = 0) AS blank, min(strlen(text))::BIGINT AS smallest, max(strlen(text))::BIGINT AS largest FROM documents GROUP BY 1""",
)
def h7_sums(spark, folder):
    """Profiles by language, merged from profiles by language and source; what sketches hold exactly."""
    apart = sketches.sketch_profile(documents(spark, folder), ["lang", "source"])
    found = sketches.read_profile(sketches.merge_profiles(apart, "lang"), (0.0, 1.0))
    ends = [F.get("size_quantiles", F.lit(i)).alias(n) for i, n in enumerate(("smallest", "largest"))]
    return found.select("lang", *sketches.SUMS, *ends)


@query("H7_sketch_profile")
def h7_sketched(spark, folder):
    """Quantiles and distinct counts by language, estimated from merged sketches."""
    apart = sketches.sketch_profile(documents(spark, folder), ["lang", "source"])
    return sketches.read_profile(sketches.merge_profiles(apart, "lang"))


@query("H6_sketched_overlap")
def h6_sketched(spark, folder):
    """Words of documents and of conversations, from two stored sketches."""
    docs = documents(spark, folder).withColumn("all", F.lit(0))
    turns = read_table(spark, folder, "conversations", ["conv_id", "turn"]).withColumn("all", F.lit(0))
    return sketches.sketched_overlap(*(sketches.sketch_profile(x, "all") for x in (docs, turns)))
