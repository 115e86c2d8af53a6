"""The message parser on hand-made messages, one irregularity each."""

import re
import os

import pytest
from prosewell.operators import messages as M
from prosewell.operators import quality, terms
from prosewell.sources.corpus import read_bundles, read_corpus, write_bundles, write_corpus, write_files
from pyspark.sql import functions as F


def corpus(spark, *raws):
    return spark.createDataFrame([("a.b", i, r) for i, r in enumerate(raws)], "grp string, msg_no long, raw string")


def parse(spark, raw):
    return M.parse_messages(corpus(spark, raw)).first()


def kinds(spark, body):
    df = spark.createDataFrame([("a.b", 1, body)], "grp string, msg_no long, body string")
    return [(r.kind, r.depth) for r in M.body_lines(df).orderBy("line_no").collect()]


def test_folded_repeated_and_junk_headers(spark):
    m = parse(
        spark,
        " a!b!c\nSubject: Re: RE: re[2]: Hello There\n\t<9@left.over>\nFrom: Jo Do <Jo@X.org>\nLines: 31\n\t<123@x>\nLines: 32\n"
        "Article-I.D.: q.9\nNntp-Posting-Host: h\nKeywords: one, two ,\n\nbody\n",
    )
    assert m.headers["lines"] == ["31 <123@x>", "32"]
    assert m.headers["article-i.d."] == ["q.9"]
    assert (m.lines, m.keywords, m.posting_host) == (32, ["one", "two"], "h")
    assert (m.from_email, m.from_name, m.thread) == ("Jo@X.org", "Jo Do", "hello there")
    assert m.body == "body\n"


@pytest.mark.parametrize(
    "sender, email, name",
    [
        ("a.b@c.d (Jo Do)", "a.b@c.d", "Jo Do"),
        ("Jo Do <a@c.d>", "a@c.d", "Jo Do"),
        ('"Jo Do" <a@c.d>', "a@c.d", "Jo Do"),
        ("a@c.d", "a@c.d", None),
        ("", None, None),
    ],
)
def test_sender_shapes(spark, sender, email, name):
    m = parse(spark, f"From: {sender}\nSubject: x\n\nb")
    assert (m.from_email, m.from_name) == (email, name)


def test_missing_and_misspelled_headers(spark):
    m = parse(spark, "From: a@b.c\nOrginization: Club\n\nNote: not a header\n")
    assert (m.organization, m.lines, m.subject, m.thread) == ("Club", None, "", "")
    assert list(m.headers) == ["from", "orginization"]


def test_blank_body(spark):
    rows = M.split_message(corpus(spark, "From: a\n", "From: a\n\n", "From: a\r\n\r\nb")).collect()
    assert [r.body for r in rows] == ["", "", "b"]


def test_line_kinds(spark):
    body = "In article <1> Jo writes:\n> one\n>> two\n| three\n: four\nGK> five\n\nmine\n-- \nJo\n> not a quote"
    assert kinds(spark, body) == [
        ("attribution", 0),
        ("quote", 1),
        ("quote", 2),
        ("quote", 1),
        ("quote", 1),
        ("quote", 1),
        ("blank", 0),
        ("text", 0),
        ("signature", 0),
        ("signature", 0),
        ("signature", 1),
    ]


def test_armor(spark):
    body = "-----BEGIN PGP SIGNED MESSAGE-----\nmine\n-----BEGIN PGP SIGNATURE-----\nxyz\n-----END PGP SIGNATURE-----\nafter"
    assert [k for k, _ in kinds(spark, body)] == ["armor", "text", "armor", "armor", "armor", "text"]


def test_own_text(spark):
    df = spark.createDataFrame([("g", 1, "> quoted\nmine\n\nalso mine\n-- \nsig")], "grp string, msg_no long, body string")
    assert M.own_text(df).first().text == "mine\nalso mine"


def test_clean_text(spark):
    df = spark.createDataFrame([("_\x08a_\x08b\tc\r\nd\x07e   f\rg",)], "body string")
    assert M.clean_text(df).first().body == "ab c\nde f g"


def test_style_features(spark):
    text = "WOW!! soooo good :-) see ftp://a.b/c or mail a@b.co for $1,000.50 and $ 5 ;)"
    df = spark.createDataFrame([("g", 1, text)], "grp string, msg_no long, body string")
    r = M.style_features(df).first()
    assert (r.emoticons, r.exclamations, r.shouted, r.stretched, r.urls, r.emails, r.prices) == (2, 1, 1, 1, 1, 1, 2)


def test_check_lines(spark):
    raws = ["Lines: 2\n\na\nb\n\n\n", "Lines: 9\n\na", "Lines: 4\n\na\nb", "Subject: x\n\na", "Lines: 0\nLines: 1\n\na"]
    checked = M.check_lines(M.parse_messages(corpus(spark, *raws))).orderBy("msg_no").collect()
    assert [r.check for r in checked] == ["equal", "6 or more fewer", "1 to 5 fewer", "no value", "more"]


def test_corpus_folder_round_trip(spark, tmp_path):
    for grp, no, text in [("x.y", 1, "From: a\n\none"), ("x.y", 2, "From: b\n\ntwo"), ("z", 1, "From: c\n\nthree\nlines")]:
        (tmp_path / "in" / grp).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / grp / str(no)).write_text(text)
    read = read_corpus(spark, str(tmp_path / "in"))
    assert sorted((r.grp, r.msg_no, r.raw[:7]) for r in read.collect()) == [
        ("x.y", 1, "From: a"),
        ("x.y", 2, "From: b"),
        ("z", 1, "From: c"),
    ]
    write_corpus(read, str(tmp_path / "out"), partition_by="grp")
    assert spark.read.parquet(str(tmp_path / "out")).filter("grp = 'x.y'").count() == 2


# A full message corpus, when one is at hand: the numbers to expect from it.
CORPUS = os.environ.get("MESSAGE_CORPUS")


@pytest.mark.skipif(not CORPUS, reason="MESSAGE_CORPUS names no folder")
def test_corpus_numbers(spark, tmp_path):
    write_corpus(read_corpus(spark, CORPUS), str(tmp_path / "corpus"))
    raw = spark.read.parquet(str(tmp_path / "corpus")).repartition(8, "grp", "msg_no")
    M.parse_messages(raw).write.parquet(str(tmp_path / "messages"))
    m = spark.read.parquet(str(tmp_path / "messages"))
    assert (m.count(), m.select("grp").distinct().count()) == (12_956, 20)
    assert m.select("grp", "msg_no").distinct().count() == 12_956
    got = {r["check"]: r["count"] for r in M.check_lines(m).groupBy("check").count().collect()}
    tokens = terms.tokenize(m, "body", M.KEY)
    numbers = {
        "checks": got,
        "threads": m.select("thread").distinct().count(),
        "cross": quality.cross_group_threads(m).count(),
        "no_email": m.filter("from_email is null").count(),
        "emails": m.select(F.coalesce("from_email", F.lit(""))).distinct().count(),
        "tokens": tokens.count(),
        "words": tokens.select("token").distinct().count(),
        "organization": m.filter("headers['organization'] is not null").count(),
        "keywords": m.filter("headers['keywords'] is not null").count(),
    }
    sets = quality.exact_duplicates(
        m.select(F.concat_ws("/", "grp", "msg_no").alias("doc_id"), F.col("body").alias("text"))
    )
    numbers["sets"] = tuple(sets.agg(F.count("*"), F.sum(F.col("copies") - 1), F.max("copies")).first())
    print(numbers)
    assert numbers == {
        "checks": {"equal": 9_745, "1 to 5 fewer": 3_079, "6 or more fewer": 44, "more": 45, "no value": 43},
        "threads": 6_755,
        "cross": 38,
        "no_email": 46,
        "emails": 7_010,
        "tokens": 1_517_393,
        "words": 54_478,
        "organization": 12_512,
        "keywords": 989,
        "sets": (47, 82, 34),
    }


def kinds_of(spark, body):
    rows = spark.createDataFrame([("g", 1, body)], "grp string, msg_no long, body string")
    return [(r.kind, r.depth) for r in M.body_lines(rows).orderBy("line_no").collect()]


def test_second_header_block_and_emoticon_lines(spark):
    block = "Followup-To:someone@site.example \nDistribution: ne\nOrganization: Somewhere\nKeywords: \n\nI am looking\nSubject: no header now"
    assert [k for k, _ in kinds_of(spark, block)] == ["header"] * 4 + ["blank", "text", "text"]
    assert kinds_of(spark, ">quoted\n\tPlease do!\n:-) I don't know") == [("quote", 1), ("text", 0), ("text", 0)]
    assert kinds_of(spark, ":Don't tell me\n;-) so\n:) \n:D\n:Dx") == [("quote", 1), ("text", 0), ("text", 0), ("text", 0), ("quote", 1)]


def test_files_with_odd_folder_names(spark, tmp_path):
    for name, number, raw in (("c++", 7, "a\n\nb\n"), ("x y%", 8, "c\n")):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / str(number)).write_text(raw)
    read = read_corpus(spark, str(tmp_path / "in"))
    assert sorted(map(tuple, read.collect())) == [("c++", 7, "a\n\nb\n"), ("x y%", 8, "c\n")]
    write_files(read, str(tmp_path / "out"))
    again = read_corpus(spark, str(tmp_path / "out"), partitions=True)
    assert sorted((r.grp, r.msg_no, r.raw[:-1]) for r in again.collect()) == sorted(map(tuple, read.collect()))


def test_bundles_hold_any_message(spark, tmp_path):
    """Many messages a file, whatever they hold: the record's end, its escape, returns, blank lines, no newline at the end, nothing."""
    texts = ["a\n\nb\n", "", "\n", "no end", "x\x1ey\x1fz\x1f0\x1f1", "\r\n\r", "tab\there", "é 你"]
    rows = [(f"g{i % 3}", i, texts[i % len(texts)]) for i in range(200)] + [("12", 5, "number"), ("x y%/c++", 6, "odd")]
    df = spark.createDataFrame(rows, "grp string, msg_no long, raw string")
    write_bundles(df, str(tmp_path / "b"), rows_per_file=20)
    assert sorted(map(tuple, read_bundles(spark, str(tmp_path / "b")).collect())) == sorted(rows)
    files = [f for _, _, names in os.walk(tmp_path / "b") for f in names if f.endswith(".txt")]
    assert 11 <= len(files) <= 60


def test_style_counts_equal_a_plain_search(spark):
    """Patterns that begin a search at fewer places count what the plain patterns count; no list of all words is made."""
    import random

    from prosewell.functions import text as T

    rng = random.Random(5)
    parts = ["a@b.c", "_d@e.f", "x", "aaa", "AAAA", "İ", "K", "!!", "!", "$ 5", "$1,0.50", "http://", "ftp://z", "@", ".", "-", "%", " ", "\n", "bbbcccd", ":-)", "ABCd", "É", "OK", "YES"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(600)] + ["", None, "a@b.c_d@e.f+g@h.i"]
    docs = spark.createDataFrame([*enumerate(texts)], "msg_no int, body string")
    found = M.style_features(docs, ["msg_no"])
    plan = found._jdf.queryExecution().analyzed().toString()
    assert T.SHOUTED in plan and T.ASCII_WORD not in plan and T.STRETCHED not in plan
    got = {r.msg_no: r for r in found.collect()}
    plain = {"emoticons": T.EMOTICON, "exclamations": T.EXCLAMATION, "urls": T.URL, "emails": T.EMAIL, "prices": T.PRICE}
    for i, text in enumerate(texts):
        if text is None:
            assert all(got[i][c] is None for c in [*plain, "shouted", "stretched"])
            continue
        for name, pattern in plain.items():
            # Java's \s knows ASCII blanks only, as do these texts.
            assert got[i][name] == len(re.findall(pattern, text)), (name, text)
        assert got[i].shouted == sum(len(w) > 2 and w == w.upper() for w in re.findall("[A-Za-z]+", text)), text
        assert got[i].stretched == len(re.findall(T.STRETCHED, text.lower())), text
