"""Structure of plain-text messages: headers, sender, thread, lines and the author's own words.

All of it happens inside the message's row. The corpus key is (grp, msg_no) throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosewell.functions import text as T

KEY = ("grp", "msg_no")

# The patterns that define message structure.
HEADER = r"^[A-Za-z][A-Za-z0-9._\[\]-]*[ ]*:"
FOLD = "\n[ \t]+"
SUBJECT = r"(?im)^subject[ ]*:(.*)$"
LINE_COUNT = r"^\s*(\d+)"
EMAIL_ADDRESS = r"[A-Za-z0-9._%+!=/-]+@[A-Za-z0-9._-]+"
NAME_BEFORE = r'^\s*"?([^"<]*[^"<\s])"?\s*<'
NAME_AFTER = r"\(([^)]*)\)"
REPLY_PREFIX = r"(?i)^(\s*re(\[\d+\])?:\s*)+"
QUOTE_PREFIX = r"^(?:\s*(?:[A-Za-z]{1,3}>|[>|:]))+"
# A colon that begins an emoticon quotes nothing; `:Don't` is a quote.
EMOTICON_LINE = r"^\s*[:;]-?[)(DP](?:[^A-Za-z]|$)"
# Headers that some messages repeat at the start of the body.
INNER_HEADER = (
    r"(?i)^(?:from|subject|organization|lines|keywords|distribution|reply-to|nntp-posting-host|newsgroups|date"
    r"|message-id|summary|expires|article-i\.d\.|sender|path|references|followup-to|x-[a-z-]+)[ ]*:"
)
INNER_OR_BLANK = INNER_HEADER + r"|^\s*$"
ATTRIBUTION = r"(?i)^\s*in article\b|\b(?:writes|wrote|says|said)\s*:\s*$"
SIGNATURE = r"^--\s*$"
ARMOR_MARK = r"^-----(?:BEGIN|END) PGP [A-Z ]+-----"
ARMOR_BEGIN = r"^-----BEGIN PGP (?:SIGNATURE|MESSAGE|PUBLIC KEY BLOCK|PRIVATE KEY BLOCK)"
ARMOR_END = r"^-----END PGP"


def split_message(corpus: DataFrame, keep: Sequence[str] = KEY) -> DataFrame:
    """(key, head, body): cut at the first empty line; the rest of the text is the body."""
    raw = F.regexp_replace("raw", "\r\n", "\n")
    head = F.substring_index("_raw", "\n\n", 1)
    return (
        corpus.select(*keep, raw.alias("_raw"))
        .withColumn("head", head)
        .withColumn("body", F.expr("substr(_raw, length(head) + 3)"))
        .drop("_raw")
    )


def parse_headers(parts: DataFrame) -> DataFrame:
    """Adds `headers`, lower-cased name to the array of its values in order.

    Continuation lines are unfolded into the header before them; lines that are no header are
    ignored; repeats are kept.
    """
    lines = F.filter(
        F.split(F.regexp_replace("head", FOLD, " "), "\n"), lambda h: h.rlike(HEADER)
    )
    pairs = F.transform(
        lines,
        lambda h: F.struct(
            F.lower(F.trim(F.substring_index(h, ":", 1))).alias("name"),
            F.trim(F.substr(h, F.instr(h, ":") + 1)).alias("value"),
        ),
    )

    def grouped(found: Column, known: Column) -> Column:
        return F.map_from_arrays(
            known,
            F.transform(
                known,
                lambda n: F.transform(
                    F.filter(found, lambda p: p["name"] == n), lambda p: p["value"]
                ),
            ),
        )

    headers = T.let(
        pairs,
        lambda found: T.let(
            F.array_distinct(F.transform(found, lambda p: p["name"])),
            lambda known: grouped(found, known),
        ),
    )
    return parts.withColumn("headers", headers)


def _header(name: str, which: int = 1) -> Column:
    return F.try_element_at(F.try_element_at("headers", F.lit(name)), F.lit(which))


def header_columns(parsed: DataFrame) -> DataFrame:
    """Adds typed columns for the common headers; the last `Lines` wins.

    A header that was removed can leave its continuation lines behind, most often message ids
    after the subject. `subject` is therefore its own line only; `headers` has all of it.
    """
    keywords = F.filter(
        F.transform(F.split(_header("keywords"), ","), lambda w: F.trim(w)), lambda w: w != ""
    )
    return parsed.select(
        "*",
        _header("from").alias("from"),
        F.coalesce(F.trim(F.regexp_extract("head", SUBJECT, 1)), F.lit("")).alias("subject"),
        F.coalesce(_header("organization"), _header("orginization")).alias("organization"),
        F.regexp_extract(_header("lines", -1), LINE_COUNT, 1).try_cast("int").alias("lines"),
        keywords.alias("keywords"),
        _header("distribution").alias("distribution"),
        _header("reply-to").alias("reply_to"),
        _header("nntp-posting-host").alias("posting_host"),
    )


def parse_sender(messages: DataFrame) -> DataFrame:
    """Adds from_email and from_name, null when absent."""
    email = F.regexp_extract("from", EMAIL_ADDRESS, 0)
    before = F.nullif(F.regexp_extract("from", NAME_BEFORE, 1), F.lit(""))
    after = F.nullif(F.regexp_extract("from", NAME_AFTER, 1), F.lit(""))
    return messages.withColumn("from_email", F.nullif(email, F.lit(""))).withColumn(
        "from_name", F.coalesce(before, after)
    )


def thread_key(messages: DataFrame) -> DataFrame:
    """Adds `thread`: the subject without reply prefixes, lower case, trimmed."""
    return messages.withColumn(
        "thread", F.lower(F.trim(F.regexp_replace("subject", REPLY_PREFIX, "")))
    )


def parse_messages(corpus: DataFrame) -> DataFrame:
    """Key, headers, typed header columns, sender, thread and body."""
    parsed = header_columns(parse_headers(split_message(corpus)))
    return thread_key(parse_sender(parsed)).drop("head")


def check_lines(messages: DataFrame) -> DataFrame:
    """Adds `counted`, `gap` (counted minus the first `Lines` value) and `check`.

    Line ends at the end of the body do not count; a blank body is one line.
    """
    counted = F.size(F.split(F.regexp_replace("body", "\n+$", ""), "\n"))
    declared = F.regexp_extract(_header("lines"), LINE_COUNT, 1).try_cast("int")
    gap = counted - declared
    check = (
        F.when(gap.isNull(), "no value")
        .when(gap == 0, "equal")
        .when(gap > 0, "more")
        .when(gap >= -5, "1 to 5 fewer")
        .otherwise("6 or more fewer")
    )
    return (
        messages.withColumn("counted", counted).withColumn("gap", gap).withColumn("check", check)
    )


def _places(lines: Column, pattern: str, matching: bool = True) -> Column:
    """Indexes of the lines that match, or of those that do not."""
    found = F.transform(lines, lambda x, i: F.when(x.rlike(pattern) == matching, i))
    return F.filter(found, lambda i: i.isNotNull())


def _line_records(body: Column | str) -> Column:
    """array<struct<line_no, depth, kind, line>>. Markers change the kind of what follows them.

    Header lines before the first other line of a body are a second header block, kind `header`.
    """

    def record(line: Column, i: Column, at: Column) -> Column:
        opened = F.size(F.filter(at["begins"], lambda b: b <= i))
        closed = F.size(F.filter(at["ends"], lambda e: e < i))
        prefix = F.when(line.rlike(EMOTICON_LINE), F.lit("")).otherwise(F.regexp_extract(line, QUOTE_PREFIX, 0))
        marks = F.regexp_replace(prefix, "[^>|:]", "")
        kind = (
            F.when(line.rlike(ARMOR_MARK) | (opened > closed), "armor")
            .when(at["signature"].isNotNull() & (i >= at["signature"]), "signature")
            .when(F.trim(F.translate(line, "\t", " ")) == "", "blank")
            .when((i < at["plain"]) & line.rlike(INNER_HEADER), "header")
            .when(prefix != "", "quote")
            .when(line.rlike(ATTRIBUTION), "attribution")
            .otherwise("text")
        )
        return F.struct(
            i.alias("line_no"), F.length(marks).alias("depth"), kind.alias("kind"), line.alias("line")
        )

    def records(lines: Column) -> Column:
        markers = F.struct(
            F.array_min(_places(lines, SIGNATURE)).alias("signature"),
            _places(lines, ARMOR_BEGIN).alias("begins"),
            _places(lines, ARMOR_END).alias("ends"),
            F.coalesce(F.array_min(_places(lines, INNER_OR_BLANK, False)), F.size(lines)).alias("plain"),
        )
        return T.let(markers, lambda at: F.transform(lines, lambda x, i: record(x, i, at)))

    return T.let(F.split(F.regexp_replace(body, "\r", ""), "\n"), records)


def body_lines(df: DataFrame, keep: Sequence[str] = KEY, col: str = "body") -> DataFrame:
    """(key, line_no, depth, kind, line): every line with its role and depth of quotation."""
    return df.select(*keep, F.inline(_line_records(col)))


def own_text(df: DataFrame, keep: Sequence[str] = KEY, col: str = "body") -> DataFrame:
    """(key, text): the author's own lines in order."""
    own = F.filter(_line_records(col), lambda r: r["kind"] == "text")
    joined = F.array_join(F.transform(own, lambda r: r["line"]), "\n")
    return df.select(*keep, joined.alias("text"))


def clean_text(df: DataFrame, col: str = "body") -> DataFrame:
    """Replaces `col` by its cleaned form."""
    return df.withColumn(col, T.cleaned(col))


def style_features(df: DataFrame, keep: Sequence[str] = KEY, col: str = "body") -> DataFrame:
    """Counts of emoticons, repeated exclamation marks, shouted and stretched words, URLs, e-mails, prices."""
    return df.select(
        *keep,
        T.occurrences(col, T.EMOTICON).alias("emoticons"),
        T.marked(col, T.EXCLAMATION, "!!").alias("exclamations"),
        T.shouted_words(col).alias("shouted"),
        T.stretched_words(col).alias("stretched"),
        T.marked(col, T.URL, "://").alias("urls"),
        T.marked(col, T.EMAIL_AT, "@", ".").alias("emails"),
        T.marked(col, T.PRICE, "$").alias("prices"),
    )


def group_rollup(df: DataFrame, top: Column, grp: str = "grp") -> DataFrame:
    """(top, grp, level, docs): counts per topic, per top-level hierarchy and in total."""
    return (
        df.select(top.alias("top"), F.col(grp).alias("grp"))
        .rollup("top", "grp")
        .agg(F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("docs"))
    )


def top_level(grp: str = "grp") -> Column:
    return F.substring_index(F.col(grp), ".", 1)
