"""Registered queries over the driver's tables and their DuckDB twins.

The tables stand in for a labelled set (see FIXTURES.md): embeddings joined with documents
give vectors, texts and labels; the signs of the first components give hashes short enough
for some to be near each other; three deterministic expressions give the scores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearset import storage
from clearset.functions import scores as fn
from clearset.jobs import reference, scoring
from clearset.operators import cleaning, dedup, diagnostics, hash_neighbours, images, metrics, mislabel, outliers, ranking, similarity, sketches, validate
from clearset.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FLAGSHIP = "ood_rank_average"

#: Bits of the stand-in hash, and the distance within which rows are near.
BITS, NEAR = 16, 2
AXES = list(cleaning.SCORES)


def query(sql: str | None = None):
    """Register a function under its name; ``sql`` may use the views b, s and h."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = _views(sql) + sql.removeprefix("--with RECURSIVE").removeprefix("--with")
        return f

    return register


_CTE = {
    "b": "b AS (SELECT vec_id AS id, label % 2 AS label, CAST(embedding AS DOUBLE[]) AS vec, text, lang, source, n_chars FROM embeddings JOIN documents ON vec_id = doc_id)",
    "h": f"h AS (SELECT id, label, vec, list_sum(list_transform(range(1, {BITS + 1}), lambda i: CASE WHEN vec[i] > 0 THEN 1 << ({BITS} - i) ELSE 0 END)) AS hash FROM b)",
    "s": "s AS (SELECT id, label, n_chars, lang, ((id * 37) % 101) / CAST(100 AS DOUBLE) AS mislabel_score, ((n_chars * 7 + id * 13) % 997) / CAST(996 AS DOUBLE) AS dup_score, (n_chars % 1000) / CAST(1000 AS DOUBLE) AS ood_score FROM b)",
}


def _views(sql: str) -> str:
    """The WITH clause of the views that ``sql`` names; a leading --with line continues it."""
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
    names = [k for k in _CTE if k in words or (k == "b" and words & {"h", "s"})]
    head = "WITH RECURSIVE " if "RECURSIVE" in words else "WITH "
    more = sql.lstrip().startswith("--with")
    if not names:
        return head if more else ""
    return head + ", ".join(_CTE[k] for k in names) + (", " if more else " ")


def _rows(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    t = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    both = e.join(t, F.col("vec_id") == F.col("doc_id"))
    vec = F.col("embedding").cast("array<double>")
    return both.select(F.col("vec_id").alias("id"), (F.col("label") % 2).cast("int").alias("label"), vec.alias("vec"), "text", "lang", "source", "n_chars", similarity.sign_hash("embedding", BITS).alias("hash"))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    b = _rows(spark, d)
    return b.select(
        "id", "label", "n_chars", "lang",
        ((F.col("id") * 37 % 101) / F.lit(100.0)).alias("mislabel_score"),
        (((F.col("n_chars") * 7 + F.col("id") * 13) % 997) / F.lit(996.0)).alias("dup_score"),
        ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("ood_score"),
    )


def _r(c: Column | str, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or c)


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[_r(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ off-topic scores
_DIST = "sqrt(list_sum(list_transform(range(1, len(x.vec) + 1), lambda i: (x.vec[i] - y.vec[i]) ** 2)))"
_CENTER = "c AS (SELECT list(m ORDER BY i) AS vec FROM (SELECT i, avg(v) AS m FROM (SELECT unnest(vec) AS v, generate_subscripts(vec, 1) AS i FROM b) GROUP BY i))"
_KNN = f"k AS (SELECT id, avg(d) FILTER (n <= 5) AS knn FROM (SELECT x.id, {_DIST} AS d, row_number() OVER (PARTITION BY x.id ORDER BY {_DIST}, y.id) AS n FROM b x JOIN b y ON x.id <> y.id) GROUP BY id)"
_LEN = r"length(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g'))"


def _avg_rank(col: str) -> str:
    return f"rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0"


@query(f"""--with
{_CENTER}, {_KNN},
g AS (SELECT x.id, {_DIST} AS d, {_LEN.replace('text', 'x.text')} AS l, knn FROM b x JOIN k ON x.id = k.id, c y),
m AS (SELECT id, ({_avg_rank('round(d, 9)')} + {_avg_rank('l')} + {_avg_rank('round(knn, 9)')}) / 3.0 AS raw FROM g)
SELECT id, round((raw - min(raw) OVER ()) / (max(raw) OVER () - min(raw) OVER () + 1e-8), 6) AS ood_score FROM m""")
def ood_rank_average(spark, d):
    return _rounded(outliers.rank_average_score(_rows(spark, d)), "ood_score")


@query(f"""--with
{_CENTER}, g AS (SELECT x.id, {_DIST} AS d, {_LEN.replace('text', 'x.text')} AS l FROM b x, c y),
m AS (SELECT id, ({_avg_rank('round(d, 9)')} + {_avg_rank('l')}) / 2.0 AS raw FROM g),
z AS (SELECT id, round((raw - min(raw) OVER ()) / (max(raw) OVER () - min(raw) OVER () + 1e-8), 6) AS ood_score FROM m)
SELECT id, ood_score FROM z ORDER BY ood_score DESC, id LIMIT 20""")
def ood_top_without_neighbours(spark, d):
    return ranking.top_n(_rounded(outliers.rank_average_score(_rows(spark, d), neighbours=False), "ood_score"), "ood_score", 20)


@query(f"--with\n{_CENTER} SELECT x.id, round({_DIST}, 6) AS centroid_dist FROM b x, c y")
def centroid_distance(spark, d):
    return _rounded(outliers.centroid_distance(_rows(spark, d)), "centroid_dist")


_FEATURES = "f AS (SELECT id, vec[1] AS g, vec[2] AS dk, vec[3] AS sk, vec[4] AS ve, vec[5] AS w, n_chars % 50 AS o, vec[6] AS z FROM b), n AS (SELECT count(*) - 1 + 1e-8 AS n FROM f)"


def _ord(c: str) -> str:
    return f"((row_number() OVER (ORDER BY {c}, id) - 1) / (SELECT n FROM n))"


def _features(spark, d):
    at = lambda i: F.element_at("vec", i)
    return _rows(spark, d).select("id", at(1).alias("grid_regularity"), at(2).alias("dark_blue_gray"), at(3).alias("skin_ratio"), at(4).alias("vegetation_ratio"), at(5).alias("watermark_ratio"), (F.col("n_chars") % 50).alias("ocr_text_length"), at(6).alias("zero_shot"))


@query(f"""--with
{_FEATURES}, r AS (SELECT id, {_ord('g')} AS g, {_ord('dk')} AS dk, {_ord('sk')} AS sk, {_ord('ve')} AS ve, {_ord('w')} AS w, {_ord('o')} AS o FROM f),
p AS (SELECT *, 0.5 * g + dk - sk - ve AS panel FROM r)
SELECT id, round(greatest(1 - {_ord('panel')}, w, o), 6) AS ood_score FROM p""")
def ood_handcrafted(spark, d):
    return _rounded(outliers.handcrafted_score(_features(spark, d)), "ood_score")


@query(f"""--with
{_FEATURES}, r AS (SELECT id, {_ord('z')} AS z, {_ord('g')} AS g, {_ord('o')} AS o, {_ord('w')} AS w FROM f)
SELECT id, round(greatest(0.7 * z + 0.3 * g, o, w), 6) AS ood_score FROM r""")
def ood_fused(spark, d):
    f = _features(spark, d).select("id", "zero_shot", F.col("grid_regularity").alias("handcrafted"), "ocr_text_length", F.col("watermark_ratio").alias("person_ratio"))
    return _rounded(outliers.fused_score(f), "ood_score")


@query(f"""--with
g AS (SELECT x.id, y.id AS nn, {_DIST} AS d, row_number() OVER (PARTITION BY x.id ORDER BY {_DIST}, y.id) AS n FROM b x JOIN b y ON x.id <> y.id),
t AS (SELECT id, nn, d FROM g WHERE n <= 10), kd AS (SELECT id, max(d) AS kd FROM t GROUP BY id),
l AS (SELECT t.id, 1 / (avg(greatest(d, kd)) + 1e-10) AS lrd FROM t JOIN kd ON t.nn = kd.id GROUP BY t.id)
SELECT t.id, round(avg(o.lrd) / any_value(w.lrd), 6) AS lof FROM t JOIN l o ON t.nn = o.id JOIN l w ON t.id = w.id GROUP BY t.id""")
def local_outlier_factor(spark, d):
    return _rounded(outliers.local_outlier_factor(_rows(spark, d), 10), "lof")


@query("""--with
t AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS s FROM b)
SELECT id, len(vec) + 1 AS dims, round(3 * (n_chars - m) / (s + 1e-8), 6) AS extra FROM b, t""")
def augmented_vectors(spark, d):
    v = outliers.augmented_vectors(_rows(spark, d), ["n_chars"])
    return v.select("id", F.size("vec").cast("long").alias("dims"), _r(F.element_at("vec", -1), "extra"))


@query()
def isolation_forest(spark, d):
    return outliers.isolation_forest(_rows(spark, d))


# ------------------------------------------------------------------ similarity
_HAM = "bit_count(CAST(xor(x.hash, y.hash) AS BIGINT))"


@query(f"SELECT least(x.id, y.id) AS id_a, greatest(x.id, y.id) AS id_b, CAST({_HAM} AS INT) AS dist FROM h x JOIN h y ON x.id < y.id WHERE {_HAM} <= {NEAR}")
def hamming_pairs(spark, d):
    return similarity.hamming_pairs(_rows(spark, d), NEAR, bits=BITS)


@query(f"SELECT CAST({_HAM} AS INT) AS dist, count(*) AS n FROM h x JOIN h y ON x.id < y.id WHERE {_HAM} BETWEEN 1 AND {NEAR} GROUP BY 1")
def pair_distance_counts(spark, d):
    pairs = similarity.hamming_pairs(_rows(spark, d), NEAR, bits=BITS)
    return diagnostics.value_counts(pairs.where(F.col("dist").between(1, NEAR)), "dist")


@query(f"SELECT CAST({_HAM} AS INT) AS dist, count(*) AS n FROM h x JOIN h y ON x.id < y.id WHERE {_HAM} <= {NEAR} GROUP BY 1")
def near_pair_counts(spark, d):
    return diagnostics.value_counts(similarity.hamming_pairs(_rows(spark, d), NEAR, bits=BITS), "dist")


@query(f"SELECT x.id AS id_a, y.id AS id_b, CAST({_HAM} AS INT) AS dist FROM h x JOIN h y ON x.id < y.id WHERE {_HAM} <= {NEAR} ORDER BY 3, 1, 2 LIMIT 20")
def closest_pairs(spark, d):
    return similarity.hamming_pairs(_rows(spark, d), NEAR, bits=BITS).orderBy("dist", "id_a", "id_b").limit(20)


@query(f"SELECT x.id AS id_a, y.id AS id_b, CAST({_HAM} AS INT) AS dist FROM h x JOIN h y ON x.id < y.id WHERE {_HAM} <= {NEAR} ORDER BY md5('42:' || x.id || ':' || y.id), 1, 2 LIMIT 10")
def pairs_for_review(spark, d):
    pairs = similarity.hamming_pairs(_rows(spark, d), NEAR, bits=BITS)
    return pairs.orderBy(ranking.seeded_order("id_a", "id_b"), "id_a", "id_b").limit(10)


def _nn(sim: str, pair: str = "h x JOIN h y ON x.id <> y.id") -> str:
    return f"SELECT id, nn_id, sim FROM (SELECT x.id, y.id AS nn_id, {sim} AS sim, row_number() OVER (PARTITION BY x.id ORDER BY {sim} DESC, y.id) AS n FROM {pair}) WHERE n = 1"


@query(f"SELECT id, nn_id, CAST(-sim AS INT) AS dist FROM ({_nn(f'-{_HAM}')})")
def hamming_nearest(spark, d):
    b = _rows(spark, d).select("id", "hash")
    return hash_neighbours.nearest_hash(b, b, bits=BITS)


@query(f"SELECT id, nn_id, CAST(-sim AS INT) AS dist FROM ({_nn(f'-{_HAM}', 'h x JOIN h y ON x.id <> y.id AND x.id % 5 = 0')})")
def hamming_nearest_across_sets(spark, d):
    b = _rows(spark, d).select("id", "hash")
    test, train = b.where("id % 5 = 0"), b.where("id % 5 <> 0")
    return hash_neighbours.nearest_hash(test, train.unionByName(test), bits=BITS)


_DOT = "list_sum(list_transform(range(1, len(x.vec) + 1), lambda i: x.vec[i] * y.vec[i]))"
_NORM = "(sqrt(list_sum(list_transform({0}.vec, lambda v: v * v))) + 1e-8)"
_COS = f"({_DOT} / ({_NORM.format('x')} * {_NORM.format('y')}))"


@query(f"SELECT id, nn_id, round(greatest(sim, 0), 6) AS sim FROM ({_nn(_COS)})")
def cosine_nearest(spark, d):
    b = _rows(spark, d).select("id", "vec")
    return _rounded(similarity.first_neighbour(b, b, similarity.cosine, floor=0.0), "sim")


@query(f"SELECT id, nn_id, round(least(1, greatest(0, sim)), 6) AS dup_score FROM ({_nn(f'(0.6 * (1 - {_HAM} / CAST({BITS} AS DOUBLE)) + 0.4 * {_COS})')})")
def fused_dup_score(spark, d):
    return _rounded(similarity.dup_scores(_rows(spark, d).select("id", "hash", "vec"), BITS), "dup_score")


@query(f"--with\n{_KNN} SELECT id, round(knn, 6) AS knn_dist FROM k")
def knn_mean_distance(spark, d):
    b = _rows(spark, d).select("id", "vec")
    return _rounded(similarity.mean_neighbour_distance(b, b, 5), "knn_dist")


@query(f"""SELECT id, round(avg(d), 6) AS knn_dist FROM (SELECT x.id, {_DIST} AS d, row_number() OVER (PARTITION BY x.id ORDER BY {_DIST}, y.id) AS n
FROM b x JOIN b y ON x.id % 5 = 0 AND y.id % 5 <> 0) WHERE n <= 5 GROUP BY id""")
def knn_mean_distance_across_sets(spark, d):
    b = _rows(spark, d).select("id", "vec")
    return _rounded(similarity.mean_neighbour_distance(b.where("id % 5 = 0"), b.where("id % 5 <> 0"), 5), "knn_dist")


@query(f"""--with
n AS ({_nn(_COS)}), f AS (SELECT n.id, nn_id FROM n JOIN b x ON n.id = x.id JOIN b y ON nn_id = y.id WHERE sim >= 0.4 AND x.label <> y.label)
SELECT id FROM f UNION SELECT nn_id AS id FROM f""")
def label_conflicts(spark, d):
    b = _rows(spark, d)
    vectors = b.select("id", "vec")
    near = similarity.first_neighbour(vectors, vectors, similarity.cosine).withColumnRenamed("sim", "dup_score")
    return similarity.label_conflicts(near, b.select("id", "label"), 0.4)


@query(f"""--with
p AS (SELECT id AS prompt, id < 3 AS positive, vec FROM b WHERE id < 8),
e AS (SELECT x.id, y.positive, exp({_DOT}) AS e FROM b x, p y)
SELECT id, round(1 - sum(e) FILTER (positive) / sum(e), 6) AS zero_shot FROM e GROUP BY id""")
def zero_shot(spark, d):
    b = _rows(spark, d)
    prompts = b.where("id < 8").select(F.col("id").alias("prompt"), (F.col("id") < 3).alias("positive"), "vec")
    return _rounded(similarity.zero_shot(b, prompts), "zero_shot")


@query("SELECT id, dup_score, place FROM (SELECT id, dup_score, row_number() OVER (ORDER BY dup_score DESC, id) AS place FROM s ) WHERE id % 50 = 7")
def known_duplicate_places(spark, d):
    return ranking.position(_scores(spark, d).select("id", "dup_score"), "dup_score", "place").where("id % 50 = 7")


def _greedy(most: int) -> str:
    """lost: the removed rows of the greedy rule, which goes through the rows in the order of their ids
    and keeps the list of those that lead."""
    far = lambda one, many: f"CAST(bit_count(CAST(xor({one}, {many}) AS BIGINT)) AS INT)"
    return f"""o AS (SELECT row_number() OVER (ORDER BY id) AS n, id, hash FROM h ),
w AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS ids, CAST([] AS BIGINT[]) AS hashes UNION ALL
SELECT o.n, CASE WHEN len(list_filter(hashes, lambda y: {far('o.hash', 'y')} <= {most})) > 0 THEN ids ELSE list_append(ids, o.id) END,
CASE WHEN len(list_filter(hashes, lambda y: {far('o.hash', 'y')} <= {most})) > 0 THEN hashes ELSE list_append(hashes, o.hash) END FROM w JOIN o ON o.n = w.n + 1),
l AS (SELECT unnest(ids) AS leader, unnest(hashes) AS lh FROM (SELECT * FROM w ORDER BY n DESC LIMIT 1)),
lost AS (SELECT id, min(leader) AS leader, arg_min({far('hash', 'lh')}, leader) AS dist FROM o JOIN l ON leader < id AND {far('hash', 'lh')} <= {most} WHERE id NOT IN (SELECT leader FROM l) GROUP BY id)"""


@query(f"""--with RECURSIVE
{_greedy(NEAR)}
SELECT id, leader, dist, 1 - dist / CAST({NEAR + 1} AS DOUBLE) AS suspicion_score FROM lost""")
def greedy_dedup(spark, d):
    return dedup.greedy_dedup(_rows(spark, d), NEAR, bits=BITS)


@query(f"""--with RECURSIVE
e AS (SELECT x.id AS u, y.id AS v FROM h x JOIN h y ON x.id <> y.id WHERE {_HAM} <= 1),
r AS (SELECT id, id AS reach FROM h UNION SELECT r.id, e.v FROM r JOIN e ON r.reach = e.u)
SELECT id, min(reach) AS cluster FROM r GROUP BY id""")
def duplicate_clusters(spark, d):
    return dedup.duplicate_clusters(_rows(spark, d), 1, bits=BITS)


#: Cuts of the wide stand-in hash: one word of 64 bits each, 256 bits in all.
CUTS = (-0.1, 0.0, 0.1, 0.2)
_WIDE = "list_sum(list_transform(range(1, 65), lambda i: " + " + ".join(f"CAST((x.vec[i] > {c}) <> (y.vec[i] > {c}) AS INT)" for c in CUTS) + "))"


def _wide(spark: SparkSession, d: str) -> DataFrame:
    words = F.array(*[similarity.sign_hash("vec", 64, c) for c in CUTS])
    return _rows(spark, d).select("id", "vec", words.alias("hash"))


@query(f"SELECT id, nn_id, round(sim, 6) AS dup_score FROM ({_nn(f'(1 - {_WIDE} / CAST(256 AS DOUBLE))', 'b x JOIN b y ON x.id <> y.id')})")
def wide_hash_dup_score(spark, d):
    return _rounded(similarity.dup_scores(_wide(spark, d).select("id", "hash"), 256), "dup_score")


@query(f"SELECT id, nn_id, round(least(1, greatest(0, sim)), 6) AS dup_score FROM ({_nn(f'(0.6 * (1 - {_WIDE} / CAST(256 AS DOUBLE)) + 0.4 * {_COS})', 'b x JOIN b y ON x.id <> y.id')})")
def wide_fused_dup_score(spark, d):
    return _rounded(similarity.dup_scores(_wide(spark, d), 256), "dup_score")


# ------------------------------------------------------------------ joins and cleaning
@query("""SELECT l.doc_id AS id, coalesce(ood_score, 0) AS ood_score, coalesce(dup_score, 0) AS dup_score, coalesce(mislabel_score, 0) AS mislabel_score, s.id IS NULL AS scores_missing
FROM labels l LEFT JOIN s ON l.doc_id = s.id""")
def labels_with_scores(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("id"))
    return cleaning.with_scores(labels, _scores(spark, d).select("id", *AXES)).select("id", *AXES, "scores_missing")


@query("""SELECT count(*) FILTER (m IS NULL) AS mislabel_score_nulls, count(*) FILTER (p IS NULL) AS dup_score_nulls, count(*) FILTER (o IS NULL) AS ood_score_nulls
FROM (SELECT CASE WHEN id % 2 = 0 THEN mislabel_score END AS m, CASE WHEN id % 3 = 0 THEN dup_score END AS p, CASE WHEN id % 5 = 0 THEN ood_score END AS o FROM s )""")
def assembled_score_nulls(spark, d):
    s = _scores(spark, d)
    parts = [s.where(F.col("id") % k == 0).select("id", c) for k, c in ((2, "mislabel_score"), (3, "dup_score"), (5, "ood_score"))]
    return cleaning.null_counts(cleaning.assemble(s.select("id"), *parts))


def _clean_sql(mode: str) -> str:
    tail = (
        "coalesce(r, CASE WHEN m > mc AND r IS NULL THEN 'mislabel' END) AS exclude_reason, CAST(1 AS DOUBLE) AS sample_weight"
        if mode == "exclude"
        else "r AS exclude_reason, round(CASE WHEN m > mc AND r IS NULL THEN 1 - 0.9 * m ELSE 1 END, 6) AS sample_weight"
    )
    return f"""--with
q AS (SELECT quantile_cont(ood_score, 0.95) AS oc, quantile_cont(dup_score, 0.95) AS dc, quantile_cont(mislabel_score, 0.9) AS mc FROM s ),
c AS (SELECT id, row_number() OVER (ORDER BY dup_score DESC, id) % 2 = 0 AS second FROM s, q WHERE dup_score > dc AND ood_score <= oc),
t AS (SELECT s.id, mislabel_score AS m, mc, CASE WHEN ood_score > oc THEN 'ood' WHEN second THEN 'dup' END AS r FROM s JOIN q ON true LEFT JOIN c ON s.id = c.id)
SELECT id, {tail} FROM t"""


def _cleaned(spark, d, mode):
    s = _scores(spark, d)
    return cleaning.clean_train_set(s.select("id", "label"), s.select("id", *AXES), mode=mode)


@query(_clean_sql("weight"))
def clean_train_set_weighted(spark, d):
    return _cleaned(spark, d, "weight").select("id", "exclude_reason", _r("sample_weight"))


@query(_clean_sql("exclude"))
def clean_train_set_excluded(spark, d):
    return _cleaned(spark, d, "exclude").select("id", "exclude_reason", "sample_weight")


@query("SELECT id, CASE WHEN NOT ood_score < 0.5 THEN 'ood' WHEN mislabel_score >= 0.6 THEN 'relabel' WHEN NOT dup_score < 0.95 THEN 'dup' ELSE 'keep' END AS outcome FROM s ")
def static_cleaning(spark, d):
    return cleaning.static_cleaning(_scores(spark, d))


@query("--with\nq AS (SELECT quantile_cont(mislabel_score, 0.9) AS m, quantile_cont(ood_score, 0.9) AS o FROM s ) SELECT id, mislabel_score > m OR ood_score > o AS outlier FROM s, q")
def quantile_cleaning(spark, d):
    return cleaning.quantile_cleaning(_scores(spark, d))


@query("--with\nq AS (SELECT quantile_cont(dup_score, 0.95) AS p, quantile_cont(ood_score, 0.95) AS o FROM s ) SELECT id, dup_score > p OR ood_score > o OR (id % 20) / CAST(100 AS DOUBLE) > 0.1 AS excluded FROM s, q")
def hard_mask(spark, d):
    s = _scores(spark, d).withColumn("person_ratio", (F.col("id") % 20) / F.lit(100.0))
    return cleaning.hard_mask(s)


_SUSPECT = "u AS (SELECT id, dup_score AS x, 'duplicate' AS t FROM s UNION ALL SELECT id, ood_score, 'ood' FROM s UNION ALL SELECT id, mislabel_score, 'other' FROM s ), f AS (SELECT * FROM u WHERE (t = 'duplicate' AND x >= 0.9) OR (t = 'ood' AND x >= 0.95))"


def _suspicions(spark, d):
    s = _scores(spark, d)
    kinds = [("dup_score", "duplicate"), ("ood_score", "ood"), ("mislabel_score", "other")]
    return diagnostics.union_all([s.select("id", F.col(c).alias("suspicion_score"), F.lit(k).alias("noise_type")) for c, k in kinds])


_BOUNDS = {"duplicate": 0.9, "ood": 0.95}


@query(f"--with\n{_SUSPECT} SELECT id, label FROM s WHERE id NOT IN (SELECT id FROM f)")
def removed_by_scores(spark, d):
    return cleaning.remove_by_scores(_scores(spark, d).select("id", "label"), _suspicions(spark, d), _BOUNDS)


@query(f"--with\n{_SUSPECT} SELECT id, label FROM b WHERE id IN (SELECT id FROM s WHERE id NOT IN (SELECT id FROM f))")
def kept_labels(spark, d):
    clean = cleaning.remove_by_scores(_scores(spark, d).select("id", "label"), _suspicions(spark, d), _BOUNDS)
    return cleaning.keep_labels(_rows(spark, d).select("id", "label"), clean)


@query("SELECT id, suspicion_score, noise_type FROM (SELECT id, dup_score AS suspicion_score, 'duplicate' AS noise_type FROM s UNION ALL SELECT id, ood_score, 'ood' FROM s ) WHERE suspicion_score >= CASE noise_type WHEN 'duplicate' THEN 0.9 ELSE 0.95 END ORDER BY suspicion_score DESC, id, noise_type")
def suspicion_list(spark, d):
    return cleaning.suspicion_list(_suspicions(spark, d), _BOUNDS)


@query(f"""--with
{_SUSPECT} SELECT t AS item, count(*) AS n FROM f GROUP BY t UNION ALL SELECT 'distinct_removed', count(DISTINCT id) FROM f
UNION ALL SELECT 'before', count(*) FROM s UNION ALL SELECT 'after', count(*) FROM s WHERE id NOT IN (SELECT id FROM f)""")
def removal_report(spark, d):
    return cleaning.removal_report(_scores(spark, d).select("id", "label"), cleaning.flagged(_suspicions(spark, d), _BOUNDS))


@query("SELECT id, round(abs(label - mislabel_score), 6) AS suspicion_score FROM s WHERE id % 3 <> 0 AND abs(label - mislabel_score) > 0.7")
def suspected_mislabels(spark, d):
    s = _scores(spark, d)
    return _rounded(cleaning.suspected_mislabels(s.select("id", "label"), s.where("id % 3 <> 0").select("id", F.col("mislabel_score").alias("p"))), "suspicion_score")


@query("SELECT id, round(abs(label - mislabel_score), 6) AS suspicion_score FROM s WHERE abs(label - mislabel_score) > 0.7")
def all_suspected_mislabels(spark, d):
    s = _scores(spark, d)
    return _rounded(cleaning.suspected_mislabels(s.select("id", "label"), s.select("id", F.col("mislabel_score").alias("p"))), "suspicion_score")


@query("""--with
r AS (SELECT id, label, [NULL, 'ood', 'dup', 'mislabel', 'strange'][id % 5 + 1] AS w FROM s )
SELECT CASE WHEN w IS NULL THEN 'train' ELSE 'excluded' END AS split, CASE WHEN w IS NULL THEN CASE WHEN label = 0 THEN 'clean' ELSE 'dusty' END WHEN w = 'strange' THEN 'mislabel' ELSE w END AS bucket,
count(*) FILTER (id % 7 <> 0) AS copied, count(*) FILTER (id % 7 = 0) AS missing FROM r GROUP BY 1, 2""")
def export_counts(spark, d):
    reason = F.element_at(F.array(F.lit(None).cast("string"), *[F.lit(x) for x in ("ood", "dup", "mislabel", "strange")]), (F.col("id") % 5 + 1).cast("int"))
    s = _scores(spark, d).withColumn("exclude_reason", reason)
    return cleaning.export_counts(cleaning.export_routes(s), s.where("id % 7 <> 0"))


@query("""--with
r AS (SELECT id, label, text, [NULL, 'ood', 'dup', 'mislabel', 'strange'][id % 5 + 1] AS w FROM b)
SELECT CASE WHEN w IS NULL THEN 'train' ELSE 'excluded' END AS split, CASE WHEN w IS NULL THEN CASE WHEN label = 0 THEN 'clean' ELSE 'dusty' END WHEN w = 'strange' THEN 'mislabel' ELSE w END AS bucket,
count(text) FILTER (id % 7 <> 0) AS copied, count(*) FILTER (id % 7 = 0 OR text IS NULL) AS missing FROM r GROUP BY 1, 2""")
def exported_files(spark, d):
    reason = F.element_at(F.array(F.lit(None).cast("string"), *[F.lit(x) for x in ("ood", "dup", "mislabel", "strange")]), (F.col("id") % 5 + 1).cast("int"))
    b = _rows(spark, d).select(F.col("id").cast("string").alias("id"), F.col("id").alias("number"), "label", "text", reason.alias("exclude_reason"))
    content = F.col("text").cast("binary")
    files = b.where("number % 7 <> 0 AND text IS NOT NULL").select("id", F.octet_length(content).cast("long").alias("length"), content.alias("content"))
    return tables.export_files(cleaning.export_routes(b), files, storage.new_path(spark, "exported"), file_bytes=1 << 20)


@query("SELECT id, label, CAST(1 AS DOUBLE) AS sample_weight FROM s WHERE id % 4 <> 0")
def training_pool(spark, d):
    s = _scores(spark, d).withColumn("exclude_reason", F.when(F.col("id") % 4 == 0, "ood"))
    return cleaning.training_pool(s).select("id", "label", "sample_weight")


@query("SELECT id, CASE WHEN id % 4 = 3 THEN NULL ELSE 'img_' || id || ['', '.jpg', '.png'][id % 4 + 1] END AS path FROM (SELECT id FROM b)")
def resolved_ids(spark, d):
    b = _rows(spark, d).select("id", F.concat(F.lit("img_"), F.col("id").cast("string")).alias("name"))
    listing = b.where("id % 4 <> 3").select(F.concat("name", F.element_at(F.array(F.lit(""), F.lit(".jpg"), F.lit(".png")), (F.col("id") % 4 + 1).cast("int"))).alias("path"))
    listing = listing.unionByName(b.where("id % 4 = 0").select(F.concat("name", F.lit(".png")).alias("path")))  # the id itself goes first
    return tables.resolve_ids(b.select(F.col("name").alias("id")), listing).select(fn.first_number(F.col("id")).alias("id"), "path")


@query("SELECT id, CASE WHEN source LIKE '%.jpg' THEN source ELSE source || '.jpg' END AS file, CAST(nullif(regexp_extract(source, '[0-9]+'), '') AS BIGINT) AS number, replace(source || '.jpg', '.jpg', '') AS stem FROM b")
def file_names(spark, d):
    return _rows(spark, d).select("id", fn.with_suffix(F.col("source")).alias("file"), fn.first_number(F.col("source")).alias("number"), fn.without_suffix(F.concat("source", F.lit(".jpg"))).alias("stem"))


# ------------------------------------------------------------------ ranks
@query("SELECT id, round((row_number() OVER (ORDER BY mislabel_score, id) - 1) / (count(*) OVER () - 1 + 1e-8), 6) AS r FROM s ")
def ordinal_rank(spark, d):
    return ranking.ordinal_rank(_scores(spark, d).select("id", "mislabel_score"), "mislabel_score", "r").select("id", _r("r"))


@query(f"SELECT id, {_avg_rank('mislabel_score')} AS r FROM s ")
def average_rank(spark, d):
    return ranking.average_rank(_scores(spark, d).select("id", "mislabel_score"), "mislabel_score", "r").select("id", "r")


@query("""--with
r AS (SELECT id, rank() OVER (ORDER BY mislabel_score DESC) + (count(*) OVER (PARTITION BY mislabel_score) - 1) / 2.0 AS a, rank() OVER (ORDER BY ood_score DESC) + (count(*) OVER (PARTITION BY ood_score) - 1) / 2.0 AS z FROM s )
SELECT id, CAST(a - z AS DOUBLE) AS rank_change FROM r ORDER BY rank_change DESC, id LIMIT 15""")
def largest_rank_changes(spark, d):
    c = ranking.rank_change(_scores(spark, d), "mislabel_score", "ood_score").select("id", "rank_change")
    return ranking.top_n(c, "rank_change", 15)


@query("SELECT id, row_number() OVER (ORDER BY dup_score DESC, id) AS place FROM s ")
def positions(spark, d):
    return ranking.position(_scores(spark, d), "dup_score", "place").select("id", "place")


@query("SELECT id FROM (SELECT id, row_number() OVER (ORDER BY dup_score DESC, id) AS n FROM s WHERE dup_score > 0.9) WHERE n % 2 = 0")
def every_second_duplicate(spark, d):
    return ranking.alternate(_scores(spark, d).where("dup_score > 0.9"), "dup_score").where("__second").select("id")


@query("SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || id), id) - 1) % 5 AS INT) AS fold FROM b")
def stratified_folds(spark, d):
    return ranking.stratified_folds(_rows(spark, d).select("id", "label"), 5).select("id", "label", "fold")


@query("SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || id), id) <= round(count(*) OVER (PARTITION BY label) * 0.2) AS held_out FROM b")
def stratified_holdout(spark, d):
    return ranking.stratified_holdout(_rows(spark, d).select("id", "label")).select("id", "label", "held_out")


@query("SELECT id, ood_score FROM s ORDER BY ood_score DESC, id LIMIT 20")
def highest_scores(spark, d):
    return ranking.top_n(_scores(spark, d).select("id", "ood_score"), "ood_score", 20)


@query("SELECT id, ood_score FROM s ORDER BY ood_score, id LIMIT 20")
def lowest_scores(spark, d):
    return ranking.top_n(_scores(spark, d).select("id", "ood_score"), "ood_score", 20, descending=False)


@query("SELECT id, round(CASE WHEN max(n_chars) OVER () = min(n_chars) OVER () THEN 0 ELSE (n_chars - min(n_chars) OVER ()) / (max(n_chars) OVER () - min(n_chars) OVER ()) END, 6) AS scaled, round(1 - (ood_score - min(ood_score) OVER ()) / (max(ood_score) OVER () - min(ood_score) OVER () + 1e-8), 6) AS inverted FROM s ")
def min_max(spark, d):
    return ranking.min_max(ranking.min_max(_scores(spark, d), "n_chars", "scaled"), "ood_score", "inverted", "epsilon", True).select("id", _r("scaled"), _r("inverted"))


# ------------------------------------------------------------------ diagnostics
_Q5 = ", ".join(f"round(quantile_cont(x, {p}), 6) AS {k}" for k, p in diagnostics.QUANTILES.items())
_LONG = "l AS (SELECT 'mislabel_score' AS axis, mislabel_score AS x FROM s UNION ALL SELECT 'dup_score', dup_score FROM s UNION ALL SELECT 'ood_score', ood_score FROM s )"


@query(f"--with\n{_LONG} SELECT axis, count(x) AS n, min(x) AS min, max(x) AS max, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, {_Q5} FROM l GROUP BY axis")
def score_summary(spark, d):
    return _rounded(diagnostics.summary(_scores(spark, d), AXES), "mean", "std", *diagnostics.QUANTILES)


@query(f"""--with
{_LONG}, m AS (SELECT axis, x, count(*) AS n FROM l GROUP BY axis, x), t AS (SELECT axis, arg_max(n, x) AS n FROM m GROUP BY axis)
SELECT l.axis, stddev_samp(x) < 1e-3 AS flat, any_value(t.n) AS max_count, any_value(t.n) > 0.1 * count(*) AS tied FROM l JOIN t ON l.axis = t.axis GROUP BY l.axis""")
def flatness(spark, d):
    return diagnostics.flatness(_scores(spark, d), AXES)


# up to K rows sketches are exact, as at the scale of the comparison with SQL
@query(f"--with\n{_LONG} SELECT axis, count(x) AS n, quantile_disc(x, 0.05) AS q05, quantile_disc(x, 0.5) AS q50, quantile_disc(x, 0.95) AS q95 FROM l GROUP BY axis")
def sketched_quantiles(spark, d):
    s = _scores(spark, d)
    halves = [sketches.sketches(s.where(F.col("label") == i), AXES) for i in (0, 1)]
    return sketches.quantiles(sketches.merged(diagnostics.union_all(halves)), {"q05": 0.05, "q50": 0.5, "q95": 0.95})


@query("SELECT round(quantile_cont(l_extendedprice, 0.95), 6) AS l_extendedprice, round(quantile_cont(l_quantity, 0.9), 6) AS l_quantity FROM lineitem")
def price_quantiles(spark, d):
    t = spark.read.parquet(f"{d}/lineitem.parquet")
    return _rounded(ranking.quantiles(t, {"l_extendedprice": 0.95, "l_quantity": 0.9}), "l_extendedprice", "l_quantity")


_HIST = "least(floor((x - lo) / ((hi - lo) / {0})), {0} - 1)"


@query("""--with
e AS (SELECT CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem), m AS (SELECT min(x) AS lo, max(x) AS hi FROM e),
c AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin, count(*) AS n FROM e, m GROUP BY 1)
SELECT CAST(g.bin AS INT) AS bin, round(lo + g.bin * ((hi - lo) / 50), 4) AS lo, coalesce(c.n, 0) AS n FROM (SELECT unnest(range(50)) AS bin) g LEFT JOIN c ON g.bin = c.bin, m""")
def price_histogram(spark, d):
    t = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_extendedprice").cast("double").alias("x"))
    return diagnostics.histogram(t, "x", 50).select("bin", F.round("lo", 4).alias("lo"), "n")


@query("""--with
m AS (SELECT label, min(n_chars) AS lo, max(n_chars) AS hi FROM s GROUP BY label),
c AS (SELECT label, CAST(least(floor((n_chars - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, count(*) AS n FROM s JOIN m USING (label) GROUP BY 1, 2)
SELECT m.label, CAST(g.bin AS INT) AS bin, round(lo + g.bin * ((hi - lo) / 20), 4) AS lo, coalesce(n, 0) AS n FROM m JOIN (SELECT unnest(range(20)) AS bin) g ON true LEFT JOIN c ON m.label = c.label AND g.bin = c.bin""")
def histogram_by_label(spark, d):
    return diagnostics.histogram(_scores(spark, d), "n_chars", 20, "label").select("label", "bin", F.round("lo", 4).alias("lo"), "n")


@query("SELECT label, count(*) AS n FROM (SELECT label FROM s ORDER BY mislabel_score DESC, id LIMIT 20) GROUP BY label")
def labels_of_top(spark, d):
    return diagnostics.label_counts_of_top(_scores(spark, d), "mislabel_score")


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def value_counts(spark, d):
    return diagnostics.value_counts(spark.read.parquet(f"{d}/documents.parquet"), "lang", "source")


@query("""SELECT lang, count(n_chars) AS count, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS std, min(n_chars) AS min, round(quantile_cont(n_chars, 0.25), 6) AS q25,
round(quantile_cont(n_chars, 0.5), 6) AS q50, round(quantile_cont(n_chars, 0.75), 6) AS q75, max(n_chars) AS max FROM documents GROUP BY lang""")
def describe_by_language(spark, d):
    return _rounded(diagnostics.describe_by(spark.read.parquet(f"{d}/documents.parquet"), "lang", "n_chars"), "mean", "std", "q25", "q50", "q75")


@query("""--with
p AS (SELECT unnest([['mislabel_score', 'mislabel_score'], ['mislabel_score', 'dup_score'], ['mislabel_score', 'ood_score'], ['dup_score', 'dup_score'], ['dup_score', 'ood_score'], ['ood_score', 'ood_score']]) AS p),
k AS (SELECT corr(mislabel_score, mislabel_score) AS a, corr(mislabel_score, dup_score) AS c, corr(mislabel_score, ood_score) AS e, corr(dup_score, dup_score) AS f, corr(dup_score, ood_score) AS g, corr(ood_score, ood_score) AS i FROM s )
SELECT p[1] AS a, p[2] AS b, round(CASE p[1] || p[2] WHEN 'mislabel_scoremislabel_score' THEN k.a WHEN 'mislabel_scoredup_score' THEN c WHEN 'mislabel_scoreood_score' THEN e WHEN 'dup_scoredup_score' THEN f WHEN 'dup_scoreood_score' THEN g ELSE i END, 6) AS r FROM p, k""")
def pearson(spark, d):
    return _rounded(diagnostics.pearson(_scores(spark, d), AXES), "r")


@query(f"""--with
r AS (SELECT {_avg_rank('mislabel_score')} AS m, {_avg_rank('n_chars')} AS n, {_avg_rank('ood_score')} AS o FROM s )
SELECT 'mislabel_score' AS feature, round(corr(m, o), 6) AS rho FROM r UNION ALL SELECT 'n_chars', round(corr(n, o), 6) FROM r""")
def spearman(spark, d):
    return _rounded(diagnostics.spearman(_scores(spark, d), ["mislabel_score", "n_chars"], "ood_score"), "rho")


@query("""SELECT round(avg(CAST(mislabel_score > 0.3 AND mislabel_score < 0.7 AS INT)), 6) AS undecided, round(avg(CAST(mislabel_score > 0.9 OR mislabel_score < 0.1 AS INT)), 6) AS overconfident,
count(*) FILTER ((mislabel_score > 0.9 AND label = 0) OR (mislabel_score < 0.1 AND label = 1)) AS wrong, round(avg(CAST((mislabel_score > 0.9 AND label = 0) OR (mislabel_score < 0.1 AND label = 1) AS INT)), 6) AS wrong_share FROM s """)
def confidence(spark, d):
    return _rounded(diagnostics.confidence(_scores(spark, d), "mislabel_score"), "undecided", "overconfident", "wrong_share")


@query("""--with
t AS (SELECT * FROM s ORDER BY ood_score DESC, id LIMIT 20)
SELECT 'n_chars' AS feature, round((SELECT avg(n_chars) FROM t), 6) AS top_mean, round(avg(n_chars), 6) AS mean, round(((SELECT avg(n_chars) FROM t) - avg(n_chars)) / (abs(avg(n_chars)) + 1e-8) * 100, 6) AS diff_percent FROM s
UNION ALL SELECT 'dup_score', round((SELECT avg(dup_score) FROM t), 6), round(avg(dup_score), 6), round(((SELECT avg(dup_score) FROM t) - avg(dup_score)) / (abs(avg(dup_score)) + 1e-8) * 100, 6) FROM s """)
def top_versus_all(spark, d):
    return _rounded(diagnostics.top_versus_all(_scores(spark, d), "ood_score", ["n_chars", "dup_score"]), "top_mean", "mean", "diff_percent")


@query("SELECT count(*) FILTER (id % 10 = 0) AS n, round(avg(CAST(id % 10 = 0 AS INT)), 6) AS share, round(avg(ood_score) FILTER (id % 10 = 0), 6) AS mean_score, round(avg(ood_score), 6) AS mean_all FROM s ")
def positive_subset(spark, d):
    s = _scores(spark, d).withColumn("measure", (F.col("id") % 10 == 0).cast("int"))
    return _rounded(diagnostics.positive_subset(s, "measure", "ood_score"), "share", "mean_score", "mean_all")


@query("--with\nq AS (SELECT quantile_cont(dup_score, 0.95) AS c FROM s ) SELECT min(id) AS min_index, max(id) AS max_index, count(*) AS n FROM s, q WHERE dup_score >= c")
def index_range(spark, d):
    return diagnostics.index_range(_scores(spark, d), "id", "dup_score")


# ------------------------------------------------------------------ metrics
@query("""--with
g AS (SELECT mislabel_score AS x, sum(label) AS tp, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT tp, sum(tp) OVER (ORDER BY x DESC) AS h, sum(n) OVER (ORDER BY x DESC) AS m FROM g)
SELECT round(sum(tp * h / CAST(m AS DOUBLE)) / sum(tp), 6) AS ap FROM c""")
def average_precision(spark, d):
    return _rounded(metrics.average_precision(_scores(spark, d), "mislabel_score", "label"), "ap")


@query(f"--with\nr AS (SELECT label, {_avg_rank('mislabel_score')} AS r FROM s ) SELECT round((sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))), 6) AS auc FROM r")
def roc_auc(spark, d):
    return _rounded(metrics.roc_auc(_scores(spark, d), "mislabel_score", "label"), "auc")


@query("SELECT round(avg(CAST(CAST(mislabel_score > 0.5 AS INT) = label AS INT)), 6) AS accuracy, round(avg(-ln(greatest(1e-12, CASE WHEN label = 1 THEN mislabel_score ELSE 1 - mislabel_score END)) * dup_score), 6) AS loss FROM s ")
def accuracy_and_loss(spark, d):
    return _rounded(metrics.accuracy_and_loss(_scores(spark, d), "mislabel_score", "label", "dup_score"), "accuracy", "loss")


@query("SELECT id, round((mislabel_score + dup_score + ood_score) / 3, 6) AS p FROM s ")
def fold_mean(spark, d):
    s = _scores(spark, d)
    folds = diagnostics.union_all([s.select("id", F.col(c).alias("p")) for c in AXES])
    return _rounded(metrics.fold_mean(folds), "p")


@query("""SELECT id, round(1 / (1 + exp(n_chars % 16 - 9.0)), 6) AS near, round(1 - (n_chars % 6) / 6.0, 6) AS greedy, round(least(1, greatest(0.05, 1 - ood_score)), 6) AS weight, round(abs(mislabel_score - label), 6) AS gap,
round(1 - 2 * abs(mislabel_score - 0.5), 6) AS unsure, round(CASE WHEN id % 3 = 0 THEN greatest(mislabel_score, 0.7) ELSE mislabel_score END, 6) AS boosted, round(1 - CASE WHEN label = 1 THEN mislabel_score ELSE 1 - mislabel_score END, 6) AS self, round(1 / (1 + exp(-ood_score)), 6) AS p FROM s """)
def score_functions(spark, d):
    s, c = _scores(spark, d), F.col
    m = c("mislabel_score")
    return s.select(
        "id", _r(fn.distance_sigmoid(c("n_chars") % 16), "near"), _r(fn.greedy_suspicion(c("n_chars") % 6, 5), "greedy"), _r(fn.soft_weight(c("ood_score")), "weight"), _r(fn.mislabel_gap(m, c("label")), "gap"),
        _r(fn.uncertainty(m), "unsure"), _r(fn.boosted(m, c("id") % 3 == 0), "boosted"), _r(fn.self_confidence_gap(F.array(1 - m, m), c("label")), "self"), _r(fn.sigmoid(c("ood_score")), "p"),
    )


@query(f"SELECT doc_id, {_LEN} AS text_length FROM documents")
def text_lengths(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", fn.text_length(F.col("text")).cast("long").alias("text_length"))


@query("""--with
t AS (SELECT id % 400 AS id, CASE WHEN id % 11 = 0 THEN NULL ELSE mislabel_score END AS m, dup_score * 1.1 AS p, ood_score - 0.05 AS o FROM s )
SELECT * FROM (SELECT 'null:mislabel_score' AS rule, count(*) FILTER (m IS NULL) AS n FROM t UNION ALL SELECT 'range:dup_score', count(*) FILTER (p < 0 OR p > 1) FROM t UNION ALL SELECT 'range:ood_score', count(*) FILTER (o < 0 OR o > 1) FROM t
UNION ALL SELECT 'repeated:id', count(*) - count(DISTINCT id) FROM t) WHERE n > 0""")
def table_violations(spark, d):
    s = _scores(spark, d)
    bad = s.select((F.col("id") % 400).alias("id"), F.when(F.col("id") % 11 != 0, F.col("mislabel_score")).alias("mislabel_score"), (F.col("dup_score") * 1.1).alias("dup_score"), (F.col("ood_score") - 0.05).alias("ood_score"))
    return validate.violations(bad, "scores")


# ------------------------------------------------------------------ models and whole jobs
@query()
def mislabel_out_of_fold(spark, d):
    return mislabel.mislabel_scores(_rows(spark, d).select("id", "vec", "label"))


@query()
def mislabel_in_sample(spark, d):
    return mislabel.in_sample(_rows(spark, d))


@query()
def three_axis_scores(spark, d):
    return scoring.score_all(_rows(spark, d), features=_features(spark, d)).scores


@query(f"""--with
{_FEATURES}, {_KNN},
r AS (SELECT id, {_ord('g')} AS g, {_ord('dk')} AS dk, {_ord('sk')} AS sk, {_ord('ve')} AS ve, {_ord('w')} AS w, {_ord('o')} AS o FROM f),
p AS (SELECT *, 0.5 * g + dk - sk - ve AS panel FROM r),
q AS (SELECT id, greatest(1 - {_ord('panel')}, w, o) AS hc, w, o FROM p),
t AS (SELECT q.id, hc, w, o, knn FROM q JOIN k ON q.id = k.id),
u AS (SELECT id, greatest(0.5 * hc + 0.5 * {_ord('knn')}, w, o) AS hc FROM t),
v AS (SELECT f.id, z, o, hc FROM f JOIN u ON f.id = u.id)
SELECT id, round(greatest(0.7 * {_ord('z')} + 0.3 * {_ord('hc')}, {_ord('o')}), 6) AS ood_score, round(hc, 6) AS ood_score_handcrafted FROM v""")
def off_topic_scores(spark, d):
    return _rounded(scoring.off_topic(_features(spark, d), _rows(spark, d).select("id", "vec")), "ood_score", "ood_score_handcrafted")


@query()
def filter_pipeline(spark, d):
    rows = _rows(spark, d)
    oof = rows.select("id", ((F.col("id") * 37 % 101) / F.lit(100.0)).alias("p"))
    return scoring.filter_pipeline(rows, max_distance=1, oof=oof, bits=BITS)[0]


#: The modules of the pipeline that SQL can express, with out-of-fold probabilities that stand in.
_REMOVED = f"""{_greedy(1)},
gone AS (SELECT id, 'duplicate' AS noise_type FROM lost UNION ALL SELECT id, 'mislabel' FROM b WHERE abs(label - ((id * 37) % 101) / CAST(100 AS DOUBLE)) > 0.7)"""


def _by_rules(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = _rows(spark, d)
    oof = rows.select("id", ((F.col("id") * 37 % 101) / F.lit(100.0)).alias("p"))
    return scoring.filter_pipeline(rows, ("duplicate", "mislabel"), max_distance=1, oof=oof, bits=BITS)


@query(f"--with RECURSIVE\n{_REMOVED}\nSELECT id, label FROM b WHERE id NOT IN (SELECT id FROM gone)")
def filter_pipeline_by_rules(spark, d):
    return _by_rules(spark, d)[0]


@query(f"""--with RECURSIVE
{_REMOVED}
SELECT noise_type AS item, count(*) AS n FROM gone GROUP BY noise_type
UNION ALL SELECT 'distinct_removed', count(DISTINCT id) FROM gone
UNION ALL SELECT 'before', count(*) FROM b
UNION ALL SELECT 'after', count(*) FROM b WHERE id NOT IN (SELECT id FROM gone)""")
def filter_pipeline_report(spark, d):
    return _by_rules(spark, d)[1]


_CROSS_SET = f"""--with
tr AS (SELECT * FROM b WHERE id % 5 <> 0), te AS (SELECT * FROM b WHERE id % 5 = 0),
c AS (SELECT list(m ORDER BY i) AS vec FROM (SELECT i, avg(v) AS m FROM (SELECT unnest(vec) AS v, generate_subscripts(vec, 1) AS i FROM tr) GROUP BY i)),
k AS (SELECT id, avg(d) FILTER (n <= 5) AS knn FROM (SELECT x.id, {_DIST} AS d, row_number() OVER (PARTITION BY x.id ORDER BY {_DIST}, y.id) AS n FROM te x JOIN tr y ON x.id <> y.id) GROUP BY id),
g AS (SELECT x.id, {_DIST} AS d, {_LEN.replace('text', 'x.text')} AS l, knn FROM te x JOIN k ON x.id = k.id, c y),
m AS (SELECT id, ({_avg_rank('round(d, 9)')} + {_avg_rank('l')} + {_avg_rank('round(knn, 9)')}) / 3.0 AS o FROM g),
z AS (SELECT x.id, CAST(max(-{_HAM}) AS DOUBLE) AS u FROM h x JOIN h y ON x.id <> y.id WHERE x.id % 5 = 0 GROUP BY x.id),
j AS (SELECT m.id, u, o FROM m JOIN z ON m.id = z.id)
SELECT id, round((u - min(u) OVER ()) / (max(u) OVER () - min(u) OVER ()), 6) AS dup_score, round((o - min(o) OVER ()) / (max(o) OVER () - min(o) OVER ()), 6) AS ood_score FROM j"""


@query(_CROSS_SET)
def cross_set_scores(spark, d):
    rows = _rows(spark, d)
    return _rounded(scoring.cross_set_scores(rows.where("id % 5 <> 0"), rows.where("id % 5 = 0"), bits=BITS), "dup_score", "ood_score")


def _arrived(spark: SparkSession, d: str) -> tuple[reference.Reference, str]:
    """The training rows fitted, and a log of the others, which come in two parts."""
    rows = _rows(spark, d)
    ref = reference.fit(rows.where("id % 5 <> 0"), storage.new_path(spark, "reference"), bits=BITS)
    log = storage.new_path(spark, "arrived")
    for part in (0, 5):
        reference.absorb(ref, rows.where(f"id % 10 = {part}"), log, part)
    return ref, log


@query(_CROSS_SET)
def cross_set_scores_in_parts(spark, d):
    return _rounded(reference.current_scores(*_arrived(spark, d)), "dup_score", "ood_score")


def _arrived_signals(rows: str) -> str:
    """(id, feature, x) of ``rows`` against the training rows."""
    return f"""SELECT id, unnest(['d', 'l', 'k']) AS feature, unnest([d, l, k]) AS x FROM (
SELECT x.id, round({_DIST.replace('y.vec', 'c.vec')}, 9) AS d, CAST({_LEN.replace('text', 'any_value(x.text)')} AS DOUBLE) AS l, round(avg(nd) FILTER (n <= 5), 9) AS k
FROM {rows} x JOIN (SELECT x.id, {_DIST} AS nd, row_number() OVER (PARTITION BY x.id ORDER BY {_DIST}, y.id) AS n FROM {rows} x JOIN tr y ON x.id <> y.id) z ON x.id = z.id, c GROUP BY x.id, x.vec, c.vec)"""


@query(f"""--with
tr AS (SELECT * FROM b WHERE id % 5 <> 0), te AS (SELECT * FROM b WHERE id % 5 = 0),
c AS (SELECT list(m ORDER BY i) AS vec FROM (SELECT i, avg(v) AS m FROM (SELECT unnest(vec) AS v, generate_subscripts(vec, 1) AS i FROM tr) GROUP BY i)),
f AS ({_arrived_signals('tr')}), t AS ({_arrived_signals('te')}),
r AS (SELECT feature, x, (rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0) / count(*) OVER (PARTITION BY feature) AS share FROM f),
o AS (SELECT id, sum(share) / 3 AS ood FROM (SELECT t.id, t.feature, coalesce(max(share), 0) AS share FROM t LEFT JOIN r ON r.feature = t.feature AND r.x <= t.x GROUP BY t.id, t.feature) GROUP BY id),
z AS (SELECT x.id, CAST(max(-{_HAM}) AS DOUBLE) AS u FROM h x JOIN h y ON x.id <> y.id WHERE x.id % 5 = 0 GROUP BY x.id),
e AS (SELECT min(u) AS lo, max(u) AS hi FROM (SELECT CAST(max(-{_HAM}) AS DOUBLE) AS u FROM h x JOIN h y ON x.id <> y.id WHERE x.id % 5 <> 0 AND y.id % 5 <> 0 GROUP BY x.id))
SELECT o.id, round(CASE WHEN hi = lo THEN 0 ELSE greatest(0, least(1, (u - lo) / (hi - lo))) END, 6) AS dup_score, round(ood, 6) AS ood_score FROM o JOIN z ON o.id = z.id, e""")
def scores_against_training_set(spark, d):
    return _rounded(reference.fitted_scores(*_arrived(spark, d)), "dup_score", "ood_score")


@query()
def image_features(spark, d):
    return images.image_features(images.rasters_from_vectors(_rows(spark, d)))
