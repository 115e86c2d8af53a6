"""Registered queries: message structure, on messages derived from the conversations.

The given tables hold no raw messages. Each conversation turn is written out as one: headers with
the irregularities the parser must survive, the previous turn quoted, the turn itself, a signature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.operators import messages as M
from prosewell.operators import opinion
from prosewell.plans import fixtures as fx
from prosewell.plans.registry import query, values_sql
from prosewell.plans.sentiment import TURN_LEXICON
from prosewell.plans.text import documents
from prosewell.sources.corpus import read_bundles, write_bundles
from prosewell.sources.store import fresh_path
from prosewell.sources.tables import read_table

# One expression, read alike by both engines.
RAW = """
CASE WHEN turn % 7 = 3 THEN ' relay!site' || chr(10) ELSE '' END
|| 'From: ' || CASE turn % 4
  WHEN 0 THEN role || cast(conv_id AS string) || '@site.example (' || upper(role) || ' ' || cast(conv_id AS string) || ')'
  WHEN 1 THEN upper(role) || ' <' || role || cast(conv_id AS string) || '@site.example>'
  WHEN 2 THEN '"' || upper(role) || ' R" <' || role || cast(conv_id AS string) || '@site.example>' ELSE '' END || chr(10)
|| 'Subject: ' || CASE WHEN turn = 0 THEN '' WHEN turn % 3 = 0 THEN 'Re: RE: ' WHEN turn % 3 = 1 THEN 'Re: ' ELSE 're[2]: ' END
|| 'Talk ' || cast(conv_id % 40 AS string) || chr(10)
|| CASE WHEN turn % 2 = 0 THEN 'Organization: ' ELSE 'Orginization: ' END || 'Dept. of ' || role || chr(10) || chr(9) || 'Second floor' || chr(10)
|| 'Lines: ' || cast(length(text) - length(replace(text, chr(10), '')) + 1 AS string) || chr(10)
|| CASE WHEN turn % 5 = 4 THEN 'LINES: 3' || chr(10) ELSE '' END
|| 'Keywords: talk, ' || role || chr(10)
|| 'NNTP-Posting-Host: host' || cast(turn AS string) || '.example' || chr(10)
|| chr(10)
|| CASE WHEN turn % 3 = 2 THEN 'Followup-To:talk.' || role || chr(10) || 'Keywords: ' || chr(10) || chr(10) ELSE '' END
|| coalesce('In article <' || cast(conv_id AS string) || '@site> ' || prev_role || ' writes:' || chr(10)
  || '> ' || replace(prev_text, chr(10), chr(10) || 'AB>> ') || chr(10) || chr(10), '')
|| CASE WHEN turn % 4 = 1 THEN ':-) well' || chr(10) || ':Don''t tell me' || chr(10) ELSE '' END
|| text
|| CASE turn % 3 WHEN 0 THEN chr(10) || '-- ' || chr(10) || role || ' of talk'
  WHEN 1 THEN chr(10) || '-----BEGIN PGP SIGNATURE-----' || chr(10) || 'iQCVAgUBK' || chr(10) || '-----END PGP SIGNATURE-----'
  ELSE '' END
"""

MESSAGES_SQL = rf"""
prev AS (SELECT conv_id, turn + 1 AS turn, role AS prev_role, text AS prev_text FROM conversations),
corpus AS (SELECT 'talk.' || role AS grp, conv_id * 1000 + turn AS msg_no, {RAW} AS raw FROM conversations LEFT JOIN prev USING (conv_id, turn)),
parts AS (SELECT grp, msg_no, string_split(raw, chr(10) || chr(10))[1] AS head, raw FROM corpus),
parts2 AS (SELECT grp, msg_no, head, substr(raw, length(head) + 3) AS body FROM parts),
hl AS (SELECT grp, msg_no, list_filter(string_split(regexp_replace(head, '\n[ \t]+', ' ', 'g'), chr(10)),
  lambda h: regexp_matches(h, '^[A-Za-z][A-Za-z0-9._\[\]-]*[ ]*:')) AS a FROM parts2),
h1 AS (SELECT grp, msg_no, unnest(a) AS h, generate_subscripts(a, 1) AS i FROM hl),
headers AS (SELECT grp, msg_no, i, lower(trim(string_split(h, ':')[1])) AS name, trim(substr(h, strpos(h, ':') + 1)) AS value FROM h1),
typed AS (SELECT p.grp, p.msg_no, p.body,
  (SELECT min_by(value, i) FROM headers h WHERE h.grp = p.grp AND h.msg_no = p.msg_no AND name = 'from') AS sender,
  (SELECT min_by(value, i) FROM headers h WHERE h.grp = p.grp AND h.msg_no = p.msg_no AND name = 'subject') AS subject,
  (SELECT min_by(value, i) FROM headers h WHERE h.grp = p.grp AND h.msg_no = p.msg_no AND name IN ('organization', 'orginization')) AS organization,
  (SELECT max_by(try_cast(regexp_extract(value, '^\s*(\d+)', 1) AS INT), i) FROM headers h WHERE h.grp = p.grp AND h.msg_no = p.msg_no AND name = 'lines') AS lines,
  (SELECT min_by(value, i) FROM headers h WHERE h.grp = p.grp AND h.msg_no = p.msg_no AND name = 'keywords') AS keywords,
  (SELECT min_by(value, i) FROM headers h WHERE h.grp = p.grp AND h.msg_no = p.msg_no AND name = 'nntp-posting-host') AS posting_host
  FROM parts2 p),
threads AS (SELECT *, lower(trim(regexp_replace(subject, '(?i)^(\s*re(\[\d+\])?:\s*)+', ''))) AS thread FROM typed)
"""


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(grp, msg_no, raw). The previous turn comes by an equi-join on a unique key."""
    turns = read_table(spark, folder, "conversations", ["conv_id", "turn"])
    previous = turns.select(
        "conv_id",
        (F.col("turn") + 1).alias("turn"),
        F.col("role").alias("prev_role"),
        F.col("text").alias("prev_text"),
    )
    joined = turns.join(previous, ["conv_id", "turn"], "left")
    return joined.select(
        F.concat(F.lit("talk."), "role").alias("grp"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("msg_no"),
        F.expr(RAW).alias("raw"),
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return M.parse_messages(corpus(spark, folder))


@query(
    "B1_split_message",
    f"WITH {MESSAGES_SQL} SELECT grp, msg_no, md5(head) AS head, md5(body) AS body, length(body)::BIGINT AS chars FROM parts2",
)
def b1(spark, folder):
    out = M.split_message(corpus(spark, folder))
    return out.select(
        "grp",
        "msg_no",
        F.md5("head").alias("head"),
        F.md5("body").alias("body"),
        F.length("body").cast("bigint").alias("chars"),
    )


@query(
    "B2_parse_headers",
    f"""WITH {MESSAGES_SQL} SELECT grp, msg_no, name, value,
    row_number() OVER (PARTITION BY grp, msg_no, name ORDER BY i) - 1 AS seq FROM headers""",
)
def b2(spark, folder):
    parsed = M.parse_headers(M.split_message(corpus(spark, folder)))
    named = parsed.select("grp", "msg_no", F.inline(F.map_entries("headers")).alias("name", "values"))
    return named.select("grp", "msg_no", "name", F.posexplode("values").alias("seq", "value")).withColumn(
        "seq", F.col("seq").cast("bigint")
    )


@query(
    "B3_header_columns",
    f"""WITH {MESSAGES_SQL} SELECT grp, msg_no, subject, organization, lines::BIGINT AS lines,
    replace(keywords, ', ', '|') AS keywords, posting_host FROM typed""",
)
def b3(spark, folder):
    return messages(spark, folder).select(
        "grp",
        "msg_no",
        "subject",
        "organization",
        F.col("lines").cast("bigint"),
        F.array_join("keywords", "|").alias("keywords"),
        "posting_host",
    )


@query(
    "B4_parse_sender",
    rf"""WITH {MESSAGES_SQL} SELECT grp, msg_no,
    coalesce(nullif(regexp_extract(sender, '[A-Za-z0-9._%+!=/-]+@[A-Za-z0-9._-]+', 0), ''), '-') AS from_email,
    coalesce(nullif(regexp_extract(sender, '^\s*"?([^"<]*[^"<\s])"?\s*<', 1), ''), nullif(regexp_extract(sender, '\(([^)]*)\)', 1), ''), '-') AS from_name
    FROM typed""",
)
def b4(spark, folder):
    none = F.lit("-")
    return messages(spark, folder).select(
        "grp",
        "msg_no",
        F.coalesce("from_email", none).alias("from_email"),
        F.coalesce("from_name", none).alias("from_name"),
    )


@query("B5_thread_key", f"WITH {MESSAGES_SQL} SELECT grp, msg_no, thread FROM threads")
def b5(spark, folder):
    return messages(spark, folder).select("grp", "msg_no", "thread")


@query(
    "B6_check_lines",
    rf"""WITH {MESSAGES_SQL}, t AS (SELECT *, regexp_replace(body, '\n+$', '') AS b FROM typed),
    d AS (SELECT grp, msg_no, min_by(try_cast(regexp_extract(value, '^\s*(\d+)', 1) AS INT), i) AS declared FROM headers WHERE name = 'lines' GROUP BY ALL),
    c AS (SELECT t.grp, len(string_split(b, chr(10))) - declared AS gap FROM t LEFT JOIN d USING (grp, msg_no))
    SELECT grp, CASE WHEN gap IS NULL THEN 'no value' WHEN gap = 0 THEN 'equal' WHEN gap > 0 THEN 'more'
      WHEN gap >= -5 THEN '1 to 5 fewer' ELSE '6 or more fewer' END AS "check", count(*) AS n FROM c GROUP BY ALL""",
)
def b6(spark, folder):
    checked = M.check_lines(messages(spark, folder))
    return checked.groupBy("grp", "check").agg(F.count(F.lit(1)).alias("n"))


LINES_SQL = (
    MESSAGES_SQL
    + r""", la AS (SELECT grp, msg_no, string_split(replace(body, chr(13), ''), chr(10)) AS a FROM parts2),
l1 AS (SELECT grp, msg_no, unnest(a) AS line, generate_subscripts(a, 1) - 1 AS line_no FROM la),
l2 AS (SELECT *, regexp_matches(line, '^--\s*$') AS sig, regexp_matches(line, '^-----(?:BEGIN|END) PGP [A-Z ]+-----') AS mark,
  regexp_matches(line, '^-----BEGIN PGP (?:SIGNATURE|MESSAGE|PUBLIC KEY BLOCK|PRIVATE KEY BLOCK)') AS opens,
  regexp_matches(line, '^-----END PGP') AS closes,
  CASE WHEN regexp_matches(line, '^\s*[:;]-?[)(DP](?:[^A-Za-z]|$)') THEN '' ELSE regexp_extract(line, '^(?:\s*(?:[A-Za-z]{1,3}>|[>|:]))+', 0) END AS prefix,
  regexp_matches(line, '""" + M.INNER_HEADER + r"""') AS inner_header FROM l1),
l3 AS (SELECT *, max((NOT inner_header AND NOT regexp_matches(line, '^\s*$'))::INT) OVER w AS begun, max(sig::INT) OVER w AS after_sig, sum(opens::INT) OVER w - (sum(closes::INT) OVER w - closes::INT) AS depth_in
  FROM l2 WINDOW w AS (PARTITION BY grp, msg_no ORDER BY line_no)),
lines AS (SELECT grp, msg_no, line_no, line, length(regexp_replace(prefix, '[^>|:]', '', 'g')) AS depth,
  CASE WHEN mark OR depth_in > 0 THEN 'armor' WHEN after_sig = 1 THEN 'signature' WHEN trim(replace(line, chr(9), ' ')) = '' THEN 'blank'
    WHEN inner_header AND begun = 0 THEN 'header'
    WHEN prefix <> '' THEN 'quote' WHEN regexp_matches(line, '(?i)^\s*in article\b|\b(?:writes|wrote|says|said)\s*:\s*$') THEN 'attribution'
    ELSE 'text' END AS kind FROM l3)
"""
)


@query(
    "B7_body_lines",
    f"WITH {LINES_SQL} SELECT grp, msg_no, line_no::BIGINT AS line_no, depth::BIGINT AS depth, kind, line FROM lines",
)
def b7(spark, folder):
    out = M.body_lines(M.split_message(corpus(spark, folder)))
    return out.withColumn("line_no", F.col("line_no").cast("bigint")).withColumn(
        "depth", F.col("depth").cast("bigint")
    )


@query(
    "B8_own_text",
    f"""WITH {LINES_SQL} SELECT grp, msg_no, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (kind = 'text'), '') AS text
    FROM lines GROUP BY ALL""",
)
def b8(spark, folder):
    return M.own_text(M.split_message(corpus(spark, folder)))


# The documents hold no control characters; some are put in from their own letters.
DIRTY = "replace(replace(replace(replace(text, 'th', 't' || chr(8) || 'h'), ', ', chr(9) || '  '), 'ou', chr(7) || 'o' || chr(13) || 'u'), '.', '.' || chr(13) || chr(10))"


@query(
    "B9_clean_text",
    rf"""WITH d AS (SELECT doc_id, {DIRTY} AS t FROM documents),
    a AS (SELECT doc_id, regexp_replace(replace(t, chr(13) || chr(10), chr(10)), '[^\n]\x08', '', 'g') AS t FROM d),
    b AS (SELECT doc_id, regexp_replace(t, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g') AS t FROM a)
    SELECT doc_id, trim(regexp_replace(regexp_replace(t, '[\t\r]', ' ', 'g'), ' {{2,}}', ' ', 'g')) AS text FROM b""",
)
def b9(spark, folder):
    dirty = documents(spark, folder).select("doc_id", F.expr(DIRTY).alias("text"))
    return M.clean_text(dirty, "text")


def _count_sql(pattern: str, col: str = "text") -> str:
    return f"len(regexp_extract_all({col}, '{pattern}'))::BIGINT"


@query(
    "B10_style_features",
    f"""SELECT doc_id, {_count_sql(M.T.EMOTICON)} AS emoticons, {_count_sql(M.T.EXCLAMATION)} AS exclamations,
    len(list_filter(regexp_extract_all(text, '[A-Za-z]+'), lambda w: length(w) >= 3 AND w = upper(w)))::BIGINT AS shouted,
    {_count_sql(M.T.STRETCHED, 'lower(text)')} AS stretched, {_count_sql(M.T.URL)} AS urls, {_count_sql(M.T.EMAIL)} AS emails,
    {_count_sql(M.T.PRICE)} AS prices FROM documents""",
)
def b10(spark, folder):
    return M.style_features(documents(spark, folder), ["doc_id"], "text")


@query(
    "B11_group_rollup",
    """SELECT coalesce(lang, '(all)') AS top, coalesce(lang || '.' || source, '(all)') AS grp,
    grouping(lang, lang || '.' || source)::BIGINT AS level, count(*) AS docs FROM documents GROUP BY ROLLUP (lang, lang || '.' || source)""",
)
def b11(spark, folder):
    named = documents(spark, folder).select(F.concat_ws(".", "lang", "source").alias("grp"))
    out = M.group_rollup(named, M.top_level())
    whole = F.lit("(all)")
    return out.select(
        F.coalesce("top", whole).alias("top"), F.coalesce("grp", whole).alias("grp"), "level", "docs"
    )


# Opinion of the authors' own words: what they quote is somebody else's opinion.
OWN_SCORES_SQL = (
    LINES_SQL
    + f""", own AS (SELECT grp, msg_no, unnest(regexp_extract_all(lower(line), '[a-z]+')) AS token FROM lines WHERE kind = 'text'),
own_hits AS (SELECT grp, msg_no, count(*) FILTER (polarity > 0) AS pos, count(*) FILTER (polarity < 0) AS neg
  FROM own JOIN {values_sql(TURN_LEXICON, 'word, polarity')} ON own.token = t.word GROUP BY ALL),
own_scores AS (SELECT m.thread, coalesce(nullif(regexp_extract(m.sender, '[A-Za-z0-9._%+!=/-]+@[A-Za-z0-9._-]+', 0), ''), '-') AS from_email,
  coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg FROM threads m LEFT JOIN own_hits h ON h.grp = m.grp AND h.msg_no = m.msg_no)
"""
)


def own_scores(spark: SparkSession, folder: str) -> DataFrame:
    parsed = messages(spark, folder).withColumn("from_email", F.coalesce("from_email", F.lit("-")))
    keep = [*M.KEY, "thread", "from_email"]
    lexicon = fx.table(spark, TURN_LEXICON, "word string, polarity int")
    return opinion.count_polarity(M.own_text(parsed, keep), lexicon, key=keep)


@query(
    "D11_own_text_by_thread",
    f"""WITH {OWN_SCORES_SQL} SELECT thread, count(*) AS docs, sum(pos)::BIGINT AS pos, sum(neg)::BIGINT AS neg,
    (sum(pos) - sum(neg))::BIGINT AS net FROM own_scores GROUP BY thread""",
)
def own_by_thread(spark, folder):
    return opinion.thread_polarity(own_scores(spark, folder))


@query(
    "D11_own_text_by_sender",
    f"""WITH {OWN_SCORES_SQL} SELECT from_email, count(*) AS docs, sum(pos)::BIGINT AS pos, sum(neg)::BIGINT AS neg,
    (sum(pos) - sum(neg))::BIGINT AS net FROM own_scores GROUP BY from_email""",
)
def own_by_sender(spark, folder):
    return opinion.sender_polarity(own_scores(spark, folder))


@query(
    "A1_read_corpus",
    f"WITH {MESSAGES_SQL} SELECT grp || ' c++' AS grp, msg_no, md5(raw) AS raw FROM corpus",
)
def a1(spark, folder):
    """The messages written as bundles, a folder per group, and read back. One file per message is read in tests."""
    path = fresh_path(spark, "corpus")
    named = corpus(spark, folder).withColumn("grp", F.concat("grp", F.lit(" c++")))
    write_bundles(named, path)
    return read_bundles(spark, path).select("grp", "msg_no", F.md5("raw").alias("raw"))
