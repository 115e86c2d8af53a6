"""Registered queries: cluster features and spherical k-means on the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.functions import vectors as V
from prosewell.operators import cluster, learn
from prosewell.plans import messaging
from prosewell.plans.registry import query
from prosewell.plans.text import TF_SQL, documents
from prosewell.sources.store import cut
from prosewell.sources.tables import read_table


def points(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, label, vector) in double precision."""
    return read_table(spark, folder, "embeddings", "vec_id").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("vector")
    )


def grouped(spark: SparkSession, folder: str) -> DataFrame:
    """Points with a starting cluster of their own making: the place of their largest value of 8."""
    first = F.slice("vector", 1, 8)
    return points(spark, folder).withColumn("k", F.array_position(first, F.array_max(first)).cast("int") - 1)


def start_centers(spark: SparkSession, folder: str) -> DataFrame:
    sums = grouped(spark, folder).groupBy("k").agg(cluster.vector_sum("vector").alias("s"))
    return sums.select("k", V.unit("s").alias("center"))


POINTS_SQL = """
p AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
g AS (SELECT *, list_position(v[1:8], list_max(v[1:8])) - 1 AS k FROM p),
e AS (SELECT vec_id, k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM g),
vsum AS (SELECT k, i, sum(x) AS x FROM e GROUP BY k, i),
c AS (SELECT k, list(x ORDER BY i) AS ls FROM vsum GROUP BY k),
centers AS (SELECT k, list_transform(ls, lambda x: x / sqrt(list_inner_product(ls, ls))) AS center FROM c),
sims AS (SELECT p.vec_id, p.label, p.v, m.k, list_inner_product(p.v, m.center) / sqrt(list_inner_product(p.v, p.v)) AS sim FROM p CROSS JOIN centers m),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, k) AS rn FROM sims),
assigned AS (SELECT vec_id, label, v, k, sim FROM ranked WHERE rn = 1)
"""


@query(
    "G1_unit_vectors",
    """WITH p AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: CASE WHEN x > 0.05 THEN x ELSE 0 END) AS v FROM embeddings),
    q AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM p)
    SELECT vec_id, n > 0 AS kept, coalesce(CASE WHEN n > 0 THEN round(list_sum(list_transform(v, lambda x: x / n)), 6) END, 0) AS total,
      CASE WHEN n > 0 THEN round(list_max(v) / n, 6) ELSE 0 END AS largest FROM q""",
)
def g1(spark, folder):
    clipped = points(spark, folder).withColumn(
        "vector", F.transform("vector", lambda x: F.when(x > 0.05, x).otherwise(F.lit(0.0)))
    )
    good, rejects = cluster.unit_vectors(clipped, "vec_id")
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    kept = good.select(
        "vec_id",
        F.lit(True).alias("kept"),
        F.round(total, 6).alias("total"),
        F.round(F.array_max("vector"), 6).alias("largest"),
    )
    gone = rejects.select(
        "vec_id", F.lit(False).alias("kept"), F.lit(0.0).alias("total"), F.lit(0.0).alias("largest")
    )
    return kept.unionByName(gone)


@query(
    "G2_cosine",
    """SELECT a.vec_id, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) /
      (sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6) AS sim
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def g2(spark, folder):
    a = points(spark, folder).select("vec_id", "vector")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vector").alias("next"))
    return a.join(b, "vec_id").select("vec_id", F.round(V.cosine("vector", "next"), 6).alias("sim"))


def summaries(spark: SparkSession, folder: str, max_entries: int = 64) -> DataFrame:
    return cluster.cluster_features(points(spark, folder), 0.4, max_entries, "vec_id")


SUMS_SQL = f"""WITH {POINTS_SQL}, z AS (SELECT count(*) AS n, sum(list_inner_product(v, v)) AS ss FROM p),
    x AS (SELECT i, sum(x) AS ls FROM e GROUP BY i) SELECT n::BIGINT AS n, round(ss, 4) AS ss, i::BIGINT AS i, round(ls, 4) AS ls FROM x, z"""


def feature_sums(cf: DataFrame) -> DataFrame:
    """(n, ss, i, ls): what all cluster features add up to. It must be what all points add up to."""
    total = cf.agg(F.sum("n").alias("n"), F.sum("ss").alias("ss"), cluster.vector_sum("ls").alias("ls"))
    rows = total.select("n", F.round("ss", 4).alias("ss"), F.posexplode("ls").alias("i", "ls"))
    return rows.select("n", "ss", (F.col("i") + 1).cast("bigint").alias("i"), F.round("ls", 4).alias("ls"))


@query("G3_cluster_features", SUMS_SQL)
def g3(spark, folder):
    return feature_sums(summaries(spark, folder))


MERGED_SQL = f"""WITH {POINTS_SQL},
    f AS (SELECT g.k, count(*) AS n, sum(list_inner_product(g.v, g.v)) AS ss FROM g GROUP BY g.k)
"""


@query(
    "G4_merge_features",
    MERGED_SQL
    + " SELECT s.k::BIGINT AS k, s.i::BIGINT AS i, f.n, round(f.ss, 6) AS ss, round(s.x, 6) AS ls FROM vsum s JOIN f ON s.k = f.k",
)
def g4(spark, folder):
    by_label = cluster.point_features(grouped(spark, folder), ["k", "label"])
    merged = cluster.merge_features(by_label, "k")
    return merged.select(
        F.col("k").cast("bigint"), "n", F.round("ss", 6).alias("ss"), F.posexplode("ls").alias("i", "ls")
    ).select("k", (F.col("i") + 1).cast("bigint").alias("i"), "n", "ss", F.round("ls", 6).alias("ls"))


def condensed(spark: SparkSession, folder: str, max_entries: int = 64) -> DataFrame:
    return cluster.condense(summaries(spark, folder, max_entries), 0.4, max_entries)


@query("G5_condense", SUMS_SQL)
def g5(spark, folder):
    return feature_sums(condensed(spark, folder, 32))


@query(
    "G6_cf_stats",
    MERGED_SQL
    + """ SELECT c.k::BIGINT AS k, f.n, round(list_inner_product(ls, ls) / (f.n * f.n), 6) AS centroid_square,
      round(list_max(ls) / sqrt(list_inner_product(ls, ls)), 6) AS direction_max,
      round(sqrt(greatest(0, f.ss / f.n - list_inner_product(ls, ls) / (f.n * f.n))), 6) AS radius
    FROM c JOIN f ON c.k = f.k""",
)
def g6(spark, folder):
    stats = cluster.cf_stats(cluster.point_features(grouped(spark, folder), "k"))
    return stats.select(
        F.col("k").cast("bigint"),
        "n",
        F.round(V.dot("centroid", "centroid"), 6).alias("centroid_square"),
        F.round(F.array_max("direction"), 6).alias("direction_max"),
        F.round("radius", 6).alias("radius"),
    )


@query("G7_spherical_kmeans_cf")
def g7(spark, folder):
    assigned, _, _ = cluster.birch(points(spark, folder), 10, 0.4, 64, key="vec_id")
    return assigned.select("vec_id", "k", F.round("sim", 6).alias("sim"))


def assigned(spark: SparkSession, folder: str) -> DataFrame:
    return cluster.assign(points(spark, folder), start_centers(spark, folder))


@query(
    "G8_assign", f"WITH {POINTS_SQL} SELECT vec_id, k::BIGINT AS k, round(sim, 6) AS sim FROM assigned"
)
def g8(spark, folder):
    return assigned(spark, folder).select(
        "vec_id", F.col("k").cast("bigint"), F.round("sim", 6).alias("sim")
    )


@query(
    "G9_recenter",
    f"""WITH {POINTS_SQL}, e2 AS (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM assigned),
    s2 AS (SELECT k, i, sum(x) AS x FROM e2 GROUP BY k, i),
    n2 AS (SELECT k, sqrt(sum(x * x)) AS n FROM s2 GROUP BY k)
    SELECT s2.k::BIGINT AS k, i::BIGINT AS i, round(x / n, 6) AS center FROM s2 JOIN n2 ON s2.k = n2.k
    UNION ALL SELECT m.k, i, round(m.center[i], 6) FROM centers m, range(1, len(m.center) + 1) r(i)
      WHERE m.k NOT IN (SELECT k FROM n2)""",
)
def g9(spark, folder):
    centers = start_centers(spark, folder)
    out = cluster.recenter(assigned(spark, folder), centers)
    return out.select(F.col("k").cast("bigint"), F.posexplode("center").alias("i", "center")).select(
        "k", (F.col("i") + 1).cast("bigint").alias("i"), F.round("center", 6).alias("center")
    )


@query("G10_spherical_kmeans")
def g10(spark, folder):
    data = points(spark, folder)
    found = cluster.assign(data, cluster.spherical_kmeans(data, 10))
    return found.select("vec_id", "k", F.round("sim", 6).alias("sim"))


@query(
    "G11_cluster_terms",
    f"""WITH {TF_SQL}, {POINTS_SQL},
    w AS (SELECT a.k, t.token, sum(t.tf_idf) AS score FROM tfidf t JOIN assigned a ON a.vec_id = t.doc_id GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(score, 9) DESC, token) AS rank FROM w)
    SELECT k::BIGINT AS k, token, round(score, 6) AS score, rank FROM r WHERE rank <= 10""",
)
def g11(spark, folder):
    groups = assigned(spark, folder).select(F.col("vec_id").alias("doc_id"), "k")
    out = cluster.cluster_terms(documents(spark, folder), groups, 10)
    return out.select(
        F.col("k").cast("bigint"), "token", F.round("score", 6).alias("score"), F.col("rank").cast("bigint")
    )


@query(
    "G12_contingency",
    f"WITH {POINTS_SQL} SELECT k::BIGINT AS k, label::BIGINT AS label, count(*) AS n FROM assigned GROUP BY ALL",
)
def g12(spark, folder):
    return cluster.contingency(assigned(spark, folder)).select(
        F.col("k").cast("bigint"), F.col("label").cast("bigint"), "n"
    )


@query(
    "G12_contingency_pivot",
    f"WITH {POINTS_SQL} SELECT k::BIGINT AS k, "
    + ", ".join(f'count(*) FILTER (label = {i}) AS "l{i}"' for i in range(8))
    + ", count(*) FILTER (label IS NULL OR label NOT BETWEEN 0 AND 7) AS other FROM assigned GROUP BY k",
)
def g12b(spark, folder):
    out = cluster.contingency_pivot(assigned(spark, folder), list(range(8)))
    return out.select(
        F.col("k").cast("bigint"), *[F.col(str(i)).cast("bigint").alias(f"l{i}") for i in range(8)], "other"
    )


@query(
    "G13_cluster_quality",
    f"""WITH {POINTS_SQL}, t AS (SELECT k, label, count(*)::DOUBLE AS n FROM assigned GROUP BY ALL),
    r AS (SELECT k, sum(n) AS a, max(n) AS top FROM t GROUP BY k), q AS (SELECT label, sum(n) AS b FROM t GROUP BY label),
    z AS (SELECT sum(n) AS n FROM t),
    rr AS (SELECT -sum(a / z.n * ln(a / z.n)) AS h, sum(a * (a - 1) / 2) AS p, sum(top) / any_value(z.n) AS purity FROM r, z),
    qq AS (SELECT -sum(b / z.n * ln(b / z.n)) AS h, sum(b * (b - 1) / 2) AS p FROM q, z),
    x AS (SELECT sum(t.n / z.n * ln(z.n * t.n / (a * b))) AS mi, sum(t.n * (t.n - 1) / 2) AS p
      FROM t JOIN r USING (k) JOIN q USING (label), z)
    SELECT round(purity, 6) AS purity, round(mi / ((rr.h + qq.h) / 2), 6) AS nmi,
      round((x.p - rr.p * qq.p / (z.n * (z.n - 1) / 2)) / ((rr.p + qq.p) / 2 - rr.p * qq.p / (z.n * (z.n - 1) / 2)), 6) AS ari
    FROM x, rr, qq, z""",
)
def g13(spark, folder):
    cells = cut(cluster.contingency(assigned(spark, folder)))
    out = cluster.cluster_quality(cells)
    return out.select(*[F.round(c, 6).alias(c) for c in ("purity", "nmi", "ari")])


@query(
    "G14_cohesion",
    f"""WITH {POINTS_SQL} SELECT coalesce(k, -1)::BIGINT AS k, count(*) AS n, round(avg(sim), 6) AS cohesion
    FROM assigned GROUP BY ROLLUP (k)""",
)
def g14(spark, folder):
    out = cluster.cohesion(assigned(spark, folder))
    return out.select(F.col("k").cast("bigint"), "n", F.round("cohesion", 6).alias("cohesion"))


@query("G15_choose_k")
def g15(spark, folder):
    return cluster.choose_k(condensed(spark, folder), [5, 10, 15])


@query("G16_outliers")
def g16(spark, folder):
    return cluster.outliers(condensed(spark, folder), 3).select("part", "cf_id", "n")


@query(
    "G16_far_documents",
    f"""WITH {POINTS_SQL}, r2 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(sim, 9), vec_id) AS rank FROM assigned)
    SELECT k::BIGINT AS k, vec_id, round(sim, 6) AS sim, rank FROM r2 WHERE rank <= 5""",
)
def g16b(spark, folder):
    out = cluster.far_documents(assigned(spark, folder), 5, "vec_id")
    return out.select(
        F.col("k").cast("bigint"), "vec_id", F.round("sim", 6).alias("sim"), F.col("rank").cast("bigint")
    )


@query(
    "G14_silhouette",
    f"""WITH {POINTS_SQL}, u AS (SELECT vec_id, k, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM assigned),
    e2 AS (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM u), s2 AS (SELECT k, i, sum(x) AS x FROM e2 GROUP BY ALL),
    sums AS (SELECT s2.k, list(x ORDER BY i) AS s, any_value(n) AS n FROM s2 JOIN (SELECT k, count(*) AS n FROM u GROUP BY k) c ON c.k = s2.k GROUP BY s2.k),
    far AS (SELECT u.vec_id, u.k = m.k AS own, m.n, 1 - list_inner_product(u.v, m.s) / m.n AS d FROM u CROSS JOIN sums m),
    ab AS (SELECT vec_id, max(n) FILTER (own) AS n, max(d * n / nullif(n - 1, 0)) FILTER (own) AS a, min(d) FILTER (NOT own) AS b FROM far GROUP BY vec_id)
    SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab""",
)
def g14b(spark, folder):
    found = cut(assigned(spark, folder))
    return spark.createDataFrame([(round(float(cluster.silhouette(found)), 6),)], "silhouette double")


WIDTH = 256


def topics(docs: DataFrame, keys: list[str], label: str, k: int) -> DataFrame:
    """(k, label, n): texts by topic, as projected TF-IDF, unit length, summary and clusters; texts without a word that counts are in no cluster.

    The vectors are narrow on purpose: a cluster feature is as wide as they are.
    """
    vectors = cut(learn.project_text(docs, WIDTH, [*keys, label]))
    units, rejects = cluster.unit_vectors(vectors, [*keys, label])
    found, _, _ = cluster.birch(cut(units), k, 0.4, 128, key=keys)
    lost = rejects.select(label, F.lit(None).cast("int").alias("k"))
    return cluster.contingency(found.select(label, "k").unionByName(lost), label)


@query("G17_cluster_documents")
def cluster_documents(spark, folder):
    """Documents by topic, compared with language."""
    docs = documents(spark, folder).select("doc_id", F.col("lang").alias("label"), "text")
    return topics(docs, ["doc_id"], "label", 8)


@query("G17_cluster_messages")
def cluster_messages(spark, folder):
    """Messages by the words of their bodies, compared with their groups."""
    found = messaging.messages(spark, folder).select("grp", "msg_no", F.col("body").alias("text"))
    keyed = found.withColumn("label", F.col("grp"))
    return topics(keyed, ["grp", "msg_no"], "label", 4)
