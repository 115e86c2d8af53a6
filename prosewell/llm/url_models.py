"""URL filter: rules first, then the ratio of two character language models.

URLs that an allow rule fits teach one model, those that a block rule fits the other. Whole URLs are read, with what follows ? or #. A model
holds contexts of up to `ORDER` characters; how long a context may be varies with how often it was met. Probabilities are interpolated with those of the shorter context (Witten-Bell).
A URL is scored by the difference of the two log likelihoods by length, and held against a threshold that separates the ruled
URLs kept out of the counts best.

Counts are over all ruled URLs, summed in each task before they are shuffled. Every counted context stays: the models are one table in the
shared folder, a row per context with its followers (no more than `SYMBOLS`), and grow with the URLs. Distinct URLs are cut into grams;
each distinct gram gets its log ratio order by order, and a URL is the sum of its grams' ratios.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosewell.llm.common import sliced
from prosewell.operators.joins import sliced_join
from prosewell.sources.store import cut

ORDER = 5
SYMBOLS = 128
HELD = 200_000
# Log ratios are summed as whole numbers of this part, so that a sum does not depend on the order of its rows.
PARTS = 1 << 32
FOLDS, CALIBRATION = 4, 2
BINS, WIDEST = 2_000, 5.0
ACCEPT, REJECT = 1, 0
BEGIN, END, OTHER = "\x02", "\x03", "\x01"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A to Z lower-cased; empty without `://`."""
    return F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")


def rule_for(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule (host/path) that fits; a rule fits its host and all subdomains, and paths that start with its own."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        on_host = (host == name) | F.endswith(host, F.lit("." + name))
        fits.append(F.when(on_host & F.startswith(path, F.lit(slash + rest)), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def spelled(*pieces: str) -> str:
    """What the models read: the URL between a begin and an end mark, rare characters as one."""
    body = "".join(c if "\x20" <= c < "\x7f" else OTHER for c in "".join(pieces))
    return BEGIN * ORDER + body + END


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    """The spelled URLs of a batch."""
    return map(spelled, batch.column("url").to_pylist())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def give() -> pa.RecordBatch:
        keys = list(held)
        out = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()),
             pa.array(list(held.values()), pa.int64())],
            ["kind", "gram", "n"],
        )
        held.clear()
        return out

    for batch in batches:
        kinds = batch.column("kind").to_pylist()
        for kind, text in zip(kinds, _texts(batch), strict=True):
            held.update(
                (kind, text[at - k : at + 1])
                for at in range(ORDER, len(text))
                for k in range(ORDER + 1)
            )
            if len(held) >= HELD:
                yield give()
    if held:
        yield give()


def threshold_of(scores: DataFrame) -> float:
    """The threshold that errs least on both kinds of ruled URLs (kind, score), each kind weighing the same.

    Scores are counted in bins, so the driver gets a bounded table. Of equally good bounds the middle one is taken.
    """
    spot = F.floor((F.col("score") + WIDEST) / (2 * WIDEST) * BINS)
    spot = F.least(F.greatest(spot, F.lit(0)), F.lit(BINS - 1)).alias("bin")
    rows = scores.groupBy("kind", spot).count().collect()
    counts = {ACCEPT: [0] * BINS, REJECT: [0] * BINS}
    for row in rows:
        counts[row["kind"]][row["bin"]] += row["count"]
    accepts, rejects = sum(counts[ACCEPT]), sum(counts[REJECT])
    if not accepts or not rejects:
        return 0.0
    best, at, below, passed = math.inf, [], 0, rejects
    for bound in range(BINS + 1):
        error = below / accepts + passed / rejects
        if error < best - 1e-12:
            best, at = error, [bound]
        elif abs(error - best) <= 1e-12:
            at.append(bound)
        if bound < BINS:
            below += counts[ACCEPT][bound]
            passed -= counts[REJECT][bound]
    return (at[0] + at[-1]) / 2 / BINS * 2 * WIDEST - WIDEST


def _kept_out() -> Column:
    """About a quarter of the URLs, by a hash of `key`, is kept out of the counts to calibrate."""
    return F.crc32(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary")) % FOLDS == CALIBRATION


def _grams(ruled: DataFrame) -> DataFrame:
    counted = ruled.filter(~_kept_out()).drop("key")
    grams = counted.mapInArrow(_counted, "kind int, gram string, n long")
    return grams.groupBy("kind", "gram").agg(F.sum("n").alias("n"))


def context_table(ruled: DataFrame) -> DataFrame:
    """(context, a, r, a_kinds, r_kinds, followers) of every context of the counted URLs (kind, url, key).

    a and r: how often accepted and rejected URLs have the context, and how many characters follow it; followers: both counts by character.
    """
    n = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    both = _grams(ruled).groupBy("gram").agg(n(ACCEPT).alias("a"), n(REJECT).alias("r"))
    both = both.select(F.expr("left(gram, length(gram) - 1)").alias("context"), F.expr("right(gram, 1)").alias("char"), "a", "r")
    return cut(
        both.groupBy("context").agg(
            F.sum("a").alias("a"),
            F.sum("r").alias("r"),
            F.count_if(F.col("a") > 0).alias("a_kinds"),
            F.count_if(F.col("r") > 0).alias("r_kinds"),
            F.map_from_entries(F.collect_list(F.struct("char", F.struct("a", "r")))).alias("followers"),
        )
    )


def _url_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, gram, n) of (id, url): the longest grams of each URL."""
    for whole in batches:
        for batch in sliced(whole, 500):
            ids, grams, counts = [], [], []
            for id_, text in zip(batch.column("id").to_pylist(), _texts(batch), strict=True):
                found = Counter(text[at - ORDER : at + 1] for at in range(ORDER, len(text)))
                ids += [id_] * len(found)
                grams += found.keys()
                counts += found.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())], ["id", "gram", "n"]
            )


def ratios(needed: DataFrame, contexts: DataFrame) -> DataFrame:
    """Adds the log ratio, in `PARTS`, to the distinct `gram`s of full length.

    Order by order, each order from the one below. Grams are distinct, so no context or ending has more rows than there are characters.
    """
    below = None
    for k in range(ORDER + 1):
        own = needed if k == ORDER else needed.select(F.expr(f"right(gram, {k + 1})").alias("gram")).distinct()
        own = own.withColumn("context", F.expr(f"left(gram, {k})"))
        own = own.join(contexts.filter(F.length("context") == k), "context", "left")
        own = own.withColumn("own", F.try_element_at("followers", F.expr("right(gram, 1)")))
        if below is None:
            own = own.withColumn("pa", F.lit(1.0 / SYMBOLS)).withColumn("pr", F.lit(1.0 / SYMBOLS))
        else:
            own = own.withColumn("ending", F.expr(f"right(gram, {k})")).join(below, "ending")
        p = {}
        for side in "ar":
            seen, kinds = F.coalesce(F.col(f"own.{side}"), F.lit(0)), F.col(f"{side}_kinds")
            lower = F.col(f"p{side}")
            p[side] = F.when(F.col(side) > 0, (seen + kinds * lower) / (F.col(side) + kinds)).otherwise(lower)
        if k < ORDER:
            below = own.select(F.col("gram").alias("ending"), p["a"].alias("pa"), p["r"].alias("pr"))
    ratio = F.round(F.log(p["a"] / p["r"]) * PARTS).cast("bigint")
    return own.select(*needed.columns, ratio.alias("ratio"))


def url_scores(urls: DataFrame, contexts: DataFrame) -> DataFrame:
    """(id, score) of (id, url): difference of the log likelihoods by length."""
    # A given number of partitions is kept: URLs are few bytes but many grams, and would else be put into one task.
    tasks = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = urls.select("id", "url").repartition(tasks, "id")
    grams = spread.mapInArrow(_url_grams, "id long, gram string, n long")
    needed = cut(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")))
    table = cut(ratios(needed, contexts))
    found = sliced_join(grams, table, "gram", rows_per_key="rows")
    sums = found.groupBy("id").agg(F.sum(F.col("n") * F.col("ratio")).alias("sum"), F.sum("n").alias("length"))
    return sums.select("id", (F.col("sum") / F.col("length") / PARTS).alias("score"))


def judged(urls: DataFrame, allow: list[str], block: list[str]) -> DataFrame:
    """Adds host, path, rule, score and verdict to (key, url): one row per row.

    A URL without a rule is allowed if its score reaches the threshold. With one kind of ruled URLs only, it gets their verdict; with none it
    is allowed, and there is no score. Rules read host and path, scores the whole url. A null url is empty and judged like any other.
    """
    parts = urls.select(
        "key",
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    )
    parts = parts.withColumn("rule", rule_for(F.col("host"), F.col("path"), allow + block))
    by_rule = F.when(F.col("rule").isin(allow), "allow").when(F.col("rule").isNotNull(), "block")
    parts = cut(parts.withColumn("ruled", by_rule))
    ruled = parts.filter("ruled IS NOT NULL").select(
        F.when(F.col("ruled") == "allow", ACCEPT).otherwise(REJECT).alias("kind"), "url", "key"
    )
    kinds = [r["kind"] for r in ruled.filter(~_kept_out()).select("kind").distinct().collect()]
    if len(kinds) < 2:
        kinds = [r["kind"] for r in ruled.select("kind").distinct().collect()]
        rest = F.lit("block" if kinds == [REJECT] else "allow")
        rows = parts.withColumn("score", F.lit(None).cast("double"))
    else:
        urls = cut(parts.select("url").distinct().withColumn("id", F.monotonically_increasing_id()))
        scores = urls.join(url_scores(urls, context_table(ruled)), "id").drop("id")
        rows = cut(sliced_join(parts, scores, "url"))
        kind = F.when(F.col("ruled") == "allow", ACCEPT).otherwise(REJECT).alias("kind")
        threshold = threshold_of(rows.filter(F.col("ruled").isNotNull() & _kept_out()).select(kind, "score"))
        rest = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return rows.select(
        "key", "host", "path", "rule", F.coalesce("ruled", rest).alias("verdict"), "score"
    )
