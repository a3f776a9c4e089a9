"""Slice 6: cluster indices, K-Means, DBSCAN and outlier removal on ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.operators import cluster as cu
from reviewlab.plans.registry import r_sql, register, rnd
from reviewlab.sources.fixtures import VECTORS_EMB_SQL, vectors_emb

EPS, MIN_SAMPLES = 1.18, 5
ASSIGN_CTE = f"""WITH RECURSIVE e AS ({VECTORS_EMB_SQL}),
c AS (SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) AS cluster, v AS c FROM (SELECT * FROM e ORDER BY id LIMIT 4)),
dd AS (SELECT e.id, c.cluster, list_distance(e.v, c.c) AS d FROM e, c),
a AS (SELECT e.id, e.v, e.label, x.cluster FROM e JOIN (
        SELECT id, cluster FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, cluster) rn FROM dd) WHERE rn = 1) x
      ON e.id = x.id)
"""
CENTROID_CTE = """,
cm AS (SELECT cluster, i, avg(v[i]) AS m FROM (SELECT cluster, v, unnest(generate_series(1, len(v))) AS i FROM a) GROUP BY cluster, i),
cen AS (SELECT cluster, list(m ORDER BY i) AS c FROM cm GROUP BY cluster),
cnt AS (SELECT cluster, count(*) AS n FROM a GROUP BY cluster),
gm AS (SELECT list(m ORDER BY i) AS c FROM (SELECT i, avg(v[i]) AS m FROM (
         SELECT v, unnest(generate_series(1, len(v))) AS i FROM a) GROUP BY i))
"""


def _assigned(spark, sf):
    e = vectors_emb(spark, sf)
    first4 = e.orderBy("id").limit(4).select("v").collect()  # the 4-row initial model
    cs = spark.createDataFrame([(i, list(r["v"])) for i, r in enumerate(first4)], "cluster long, c array<double>")
    return cu.assign_to_centres(e, cs)


@register("emb_kmeans_assign", ASSIGN_CTE + "SELECT id, cluster FROM a")
def emb_kmeans_assign(spark, sf):
    """CLU-2 (deterministic): assignment to 4 given centres (the first 4 vectors)."""
    return _assigned(spark, sf).select("id", "cluster")


@register("emb_cluster_quality", ASSIGN_CTE + CENTROID_CTE + f""",
w AS (SELECT sum(list_distance(a.v, cen.c) * list_distance(a.v, cen.c)) AS W, count(*) AS n FROM a JOIN cen ON a.cluster = cen.cluster),
b AS (SELECT sum(cnt.n * list_distance(cen.c, gm.c) * list_distance(cen.c, gm.c)) AS B, count(*) AS K
      FROM cen JOIN cnt ON cen.cluster = cnt.cluster, gm),
s AS (SELECT a.cluster, avg(list_distance(a.v, cen.c)) AS S FROM a JOIN cen ON a.cluster = cen.cluster GROUP BY a.cluster),
db AS (SELECT avg(m) AS db FROM (
        SELECT x.cluster, max((x.S + y.S) / list_distance(cx.c, cy.c)) AS m
        FROM s x JOIN s y ON x.cluster <> y.cluster JOIN cen cx ON cx.cluster = x.cluster JOIN cen cy ON cy.cluster = y.cluster
        GROUP BY x.cluster))
SELECT {r_sql('W', 4)} AS inertia, {r_sql('(B / (K - 1)) / (W / (n - K))')} AS calinski_harabasz,
       {r_sql('db')} AS davies_bouldin FROM w, b, db""")
def emb_cluster_quality(spark, sf):
    """CLU-9 inertia, CLU-6 Calinski-Harabasz, CLU-5 Davies-Bouldin of the assignment."""
    a = _assigned(spark, sf)
    i = cu.inertia(a, "cluster").first()[0]
    ch = cu.calinski_harabasz(a, "cluster").first()[0]
    db = cu.davies_bouldin(a, "cluster").first()[0]
    return spark.createDataFrame([(i, ch, db)], "inertia double, calinski_harabasz double, davies_bouldin double").select(
        rnd("inertia", 4).alias("inertia"), rnd("calinski_harabasz").alias("calinski_harabasz"),
        rnd("davies_bouldin").alias("davies_bouldin"))


AGREE_SQL = """,
ct AS (SELECT label, cluster, count(*) AS nij FROM a GROUP BY label, cluster),
t AS (SELECT sum(nij * (nij - 1) / 2.0) AS sij, sum(nij) AS n FROM ct),
sa AS (SELECT sum(x * (x - 1) / 2.0) AS A FROM (SELECT sum(nij) AS x FROM ct GROUP BY label)),
sb AS (SELECT sum(x * (x - 1) / 2.0) AS B FROM (SELECT sum(nij) AS x FROM ct GROUP BY cluster)),
ai AS (SELECT label, sum(nij) AS ai FROM ct GROUP BY label),
bj AS (SELECT cluster, sum(nij) AS bj FROM ct GROUP BY cluster),
mi AS (SELECT sum(ct.nij / t.n * ln(t.n * ct.nij / (ai.ai * bj.bj))) AS mi
       FROM ct JOIN ai ON ct.label = ai.label JOIN bj ON ct.cluster = bj.cluster, t)
"""


@register("emb_cluster_agreement", ASSIGN_CTE + AGREE_SQL + f"""
SELECT {r_sql('(sij - A * B / (n * (n - 1) / 2.0)) / ((A + B) / 2.0 - A * B / (n * (n - 1) / 2.0))')} AS adjusted_rand,
       {r_sql('mi')} AS mutual_info FROM t, sa, sb, mi""")
def emb_cluster_agreement(spark, sf):
    """CLU-7 adjusted Rand index and CLU-8 mutual information (label vs cluster)."""
    a = _assigned(spark, sf)
    ari = cu.adjusted_rand(a, "label", "cluster").first()[0]
    mi = cu.mutual_info(a, "label", "cluster").first()[0]
    return spark.createDataFrame([(ari, mi)], "adjusted_rand double, mutual_info double").select(
        rnd("adjusted_rand").alias("adjusted_rand"), rnd("mutual_info").alias("mutual_info"))


@register("emb_silhouette", ASSIGN_CTE + f""",
pd AS (SELECT x.id, x.cluster AS own, y.cluster, sum(list_distance(x.v, y.v)) AS dsum, count(*) AS cnt
       FROM a x, a y GROUP BY x.id, x.cluster, y.cluster),
per AS (SELECT id, max(CASE WHEN cluster = own AND cnt > 1 THEN dsum / (cnt - 1) END) AS a,
               max(CASE WHEN cluster = own THEN cnt END) AS n_own,
               min(CASE WHEN cluster <> own THEN dsum / cnt END) AS b FROM pd GROUP BY id)
SELECT {r_sql('avg(CASE WHEN n_own <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette FROM per""")
def emb_silhouette(spark, sf):
    """CLU-4: exact Euclidean silhouette of the assignment."""
    return cu.silhouette(_assigned(spark, sf), "cluster").select(rnd("silhouette").alias("silhouette"))


DBSCAN_CTE = f"""WITH RECURSIVE e AS ({VECTORS_EMB_SQL}),
p AS (SELECT x.id AS a, y.id AS b FROM e x, e y WHERE list_distance(x.v, y.v) <= {EPS}),
core AS (SELECT a AS id FROM p GROUP BY a HAVING count(*) >= {MIN_SAMPLES}),
ce AS (SELECT p.a, p.b FROM p JOIN core c1 ON p.a = c1.id JOIN core c2 ON p.b = c2.id),
reach(id, r) AS (SELECT id, id FROM core UNION SELECT reach.id, ce.b FROM reach JOIN ce ON reach.r = ce.a),
comp AS (SELECT id, min(r) AS component FROM reach GROUP BY id),
num AS (SELECT component, dense_rank() OVER (ORDER BY component) - 1 AS cl FROM (SELECT DISTINCT component FROM comp)),
core_lab AS (SELECT comp.id, num.cl FROM comp JOIN num ON comp.component = num.component),
border AS (SELECT p.a AS id, min(core_lab.cl) AS cl FROM p JOIN core_lab ON p.b = core_lab.id
           WHERE p.a NOT IN (SELECT id FROM core) GROUP BY p.a),
lab AS (SELECT * FROM core_lab UNION ALL SELECT * FROM border),
db AS (SELECT e.id, CAST(coalesce(lab.cl, -1) AS INTEGER) AS cluster FROM e LEFT JOIN lab ON e.id = lab.id)
"""


def _dbscan(spark, sf):
    return cu.dbscan(vectors_emb(spark, sf), EPS, MIN_SAMPLES)


@register("emb_dbscan", DBSCAN_CTE + "SELECT id, cluster FROM db")
def emb_dbscan(spark, sf):
    """CLU-3: exact DBSCAN (eps 1.18, 5 samples) on the 64-d vectors."""
    return _dbscan(spark, sf).select("id", "cluster")


@register("emb_dbscan_summary", DBSCAN_CTE + """
SELECT count(*) FILTER (WHERE cluster = -1) AS n_noise, count(DISTINCT cluster) FILTER (WHERE cluster <> -1) AS n_clusters FROM db""")
def emb_dbscan_summary(spark, sf):
    """AGG-10: noise rows and number of clusters."""
    return cu.noise_summary(_dbscan(spark, sf))


@register("emb_kmeans_sweep")
def emb_kmeans_sweep(spark, sf):
    """CLU-1: MLlib K-Means for k = 3..13 with inertia and exact silhouette (rows-only)."""
    return cu.kmeans_sweep(vectors_emb(spark, sf), range(3, 14))


OUT_DIMS, OUT_EPS, OUT_MIN = 64, 1.55, 4


def _out_sql() -> str:
    from reviewlab.sources.fixtures import points_emb_sql
    xs = [f"x{i + 1}" for i in range(OUT_DIMS)]
    sc = ", ".join(f"({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) AS {x}" for x in xs)
    return f"""WITH RECURSIVE p AS ({points_emb_sql(OUT_DIMS)}),
e AS (SELECT id, list_value({', '.join(xs)}) AS v FROM (SELECT id, {sc} FROM p)),
d AS (SELECT x.id AS a, y.id AS b, list_distance(x.v, y.v) AS dist FROM e x, e y),
core AS (SELECT a AS id, dist AS core FROM (
           SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(dist, 9), b) AS rn FROM d) WHERE rn = {OUT_MIN}),
ed AS (SELECT d.a, d.b FROM d JOIN core ca ON d.a = ca.id JOIN core cb ON d.b = cb.id
       WHERE d.a <> d.b AND greatest(d.dist, ca.core, cb.core) <= {OUT_EPS}),
reach(id, r) AS (SELECT id, id FROM e UNION SELECT reach.id, ed.b FROM reach JOIN ed ON reach.r = ed.a),
comp AS (SELECT id, min(r) AS component FROM reach GROUP BY id),
sz AS (SELECT component, count(*) AS n FROM comp GROUP BY component),
num AS (SELECT component, dense_rank() OVER (ORDER BY component) - 1 AS cl FROM sz WHERE n >= {OUT_MIN}),
lab AS (SELECT comp.id, CAST(coalesce(num.cl, -1) AS INTEGER) AS cluster FROM comp LEFT JOIN num ON comp.component = num.component)
"""


def _out_labels(spark, sf):
    from reviewlab.operators.outliers import density_labels
    from reviewlab.sources.fixtures import points_emb
    p = points_emb(spark, sf, OUT_DIMS)
    return density_labels(p, [f"x{i + 1}" for i in range(OUT_DIMS)], OUT_EPS, OUT_MIN)


@register("emb_outlier_labels", _out_sql() + "SELECT id, cluster FROM lab")
def emb_outlier_labels(spark, sf):
    """OUT-1: one level of the density hierarchy on all 64 min-max scaled dimensions (-1 = outlier)."""
    return _out_labels(spark, sf)


@register("emb_outlier_counts", _out_sql() + """
SELECT count(*) AS rows_before, count(*) FILTER (WHERE cluster <> -1) AS rows_after FROM lab""")
def emb_outlier_counts(spark, sf):
    """OUT-1: shape before and after dropping the outliers (MTH-2 inside)."""
    return _out_labels(spark, sf).agg(F.count(F.lit(1)).alias("rows_before"),
                                      F.count_if(F.col("cluster") != -1).alias("rows_after"))


def _hierarchy(spark, sf):
    from reviewlab.operators.outliers import hierarchy_labels
    from reviewlab.sources.fixtures import points_emb
    return hierarchy_labels(points_emb(spark, sf, OUT_DIMS), [f"x{i + 1}" for i in range(OUT_DIMS)], OUT_MIN)


@register("emb_hierarchy_labels")
def emb_hierarchy_labels(spark, sf):
    """OUT-1: stable clusters of the density hierarchy on all 64 min-max scaled dimensions, -1 = outlier (brute force in tests)."""
    return _hierarchy(spark, sf)


@register("emb_hierarchy_counts")
def emb_hierarchy_counts(spark, sf):
    """OUT-1: rows, rows kept and clusters of the density hierarchy."""
    return _hierarchy(spark, sf).agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col("cluster") != -1).alias("rows_after"),
                                     F.count_distinct(F.when(F.col("cluster") != -1, F.col("cluster"))).alias("n_clusters"))


def _tree_sql() -> str:
    """Sums over the tree: by the cut property each row's lightest edge is in it, and the weights' total is the least."""
    return f"""WITH e AS ({VECTORS_EMB_SQL}),
d AS (SELECT x.id AS a, y.id AS b, list_distance(x.v, y.v) AS dist FROM e x, e y WHERE x.id <> y.id),
core AS (SELECT a AS id, dist AS core FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(dist, 9), b) AS rn FROM d) WHERE rn = {OUT_MIN}),
ed AS (SELECT d.a, d.b, greatest(d.dist, ca.core, cb.core) AS w FROM d JOIN core ca ON d.a = ca.id JOIN core cb ON d.b = cb.id)
SELECT a AS id, {r_sql('min(w)')} AS w FROM ed GROUP BY a"""


@register("emb_reachability_nearest", _tree_sql())
def emb_reachability_nearest(spark, sf):
    """OUT-1: each row's lightest edge in the spanning tree of mutual reachability, which is its lightest of all."""
    from reviewlab.operators.hierarchy import spanning_tree
    tree = spanning_tree(vectors_emb(spark, sf).select("id", "v"), OUT_MIN)
    ends = tree.select(F.explode(F.array("a", "b")).alias("id"), "w")
    return ends.groupBy("id").agg(rnd(F.min("w")).alias("w"))


@register("emb_reachability_tree")
def emb_reachability_tree(spark, sf):
    """OUT-1: the minimum spanning tree of mutual reachability (rows-only)."""
    from reviewlab.operators.hierarchy import spanning_tree
    return spanning_tree(vectors_emb(spark, sf).select("id", "v"), OUT_MIN).select("a", "b", rnd("w").alias("w"))
