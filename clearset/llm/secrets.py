"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Patterns give the candidate spans of each text.  The hashes of their values are then
counted over the whole corpus by distinct repositories and owners: a value that several
owners hold is a copied example, one that a single owner holds looks live.  Base spans
(assignments, access keys, long hex runs) are always reported; opaque runs, which no base
pattern covers, are added where they look live.

The counts are pre-aggregated by (value, owner, repository), so that a value copied into a
third of all rows is a few rows by the time it is counted.

Defined cases: a null or empty text has no spans; a null repository is an owner of its own;
rows that repeat a doc_id with the same text share one result; spans that begin together
are listed by kind; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearset.llm.text import row_key
from clearset.storage import checked_broadcast, materialize


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Kinds in order of report, with (pattern, group of the value, least length of it).
ASSIGN = "(" + "|".join(map(_any_case, ["password", "passwd", "secret", "token", "api_?key"])) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("opaque", r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{20,}", 0, 20),
]
BASE = ("assign", "access", "hex")
#: Owners up to which a value looks live.
LIVE_OWNERS = 1


def matches(text: Column, kind: int) -> Column:
    """Array of (kind, gap, len, value, ok) of the leftmost matches that do not overlap: gap
    is the number of code points between a match and the one before it."""
    _, pattern, group, least = KINDS[kind]
    parts = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(parts.alias("p"), whole.alias("w"), values.alias("v"))
    rows = F.transform(
        F.slice(zipped, 1, F.size(whole)),
        lambda x: F.struct(F.lit(kind).alias("kind"), F.length(x["p"]).alias("gap"), F.length(x["w"]).alias("len"), x["v"].alias("value"), (F.length(x["v"]) >= least).alias("ok")),
    )
    return F.when(text.rlike(pattern), rows)


def candidates(docs: DataFrame, repo: str = "source", owner: str | None = None) -> DataFrame:
    """(doc, rk, repo, owner, kind, start, end, value) of all candidate spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    repo_col = F.coalesce(F.col(repo).cast("string"), F.lit(""))
    owner_col = F.coalesce(F.col(owner).cast("string"), F.lit("")) if owner else F.regexp_extract(repo_col, "^[^/]*", 0)
    empty = F.array().cast("array<struct<kind:int,gap:int,len:int,value:string,ok:boolean>>")
    found = F.concat(*[F.coalesce(matches(text, k), empty) for k in range(len(KINDS))])
    rows = docs.select(F.col("doc_id").alias("doc"), row_key(F.col("doc_id"), F.col("text")).alias("rk"), repo_col.alias("repo"), owner_col.alias("owner"), F.posexplode(found).alias("i", "m"))
    rows = rows.select("doc", "rk", "repo", "owner", "i", "m.*").dropDuplicates(["doc", "rk", "repo", "i"])
    before = Window.partitionBy("doc", "rk", "repo", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("len")).over(before)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("len")).where("ok")
    looks = (F.col("kind") < len(BASE)) | F.col("value").rlike("[A-Za-z]")
    return rows.where(looks).select("doc", "rk", "repo", "owner", "kind", "start", "end", "value")


def ownership(found: DataFrame) -> DataFrame:
    """(h, repos, owners): in how many distinct repositories and owners each value occurs."""
    by_repo = found.groupBy("h", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("h", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("h").agg(F.sum("repos").alias("repos"), F.count("*").alias("owners"))


def scan(docs: DataFrame, repo: str = "source", owner: str | None = None, live_owners: int = LIVE_OWNERS) -> DataFrame:
    """(doc, rk, base, added): spans (start, kind, end, repos, owners, live) of the documents
    that have any, in order; rk tells repeated ids apart."""
    # values are secrets: only their 128-bit digests are written
    found = candidates(docs, repo, owner).withColumn("h", F.substring(F.sha2(F.col("value").cast("binary"), 256), 1, 32)).drop("value")
    found = materialize(found, "secret-candidates")
    counts = materialize(ownership(found), "secret-owners")
    rated = found.join(checked_broadcast(counts), "h").withColumn("live", F.col("owners") <= live_owners).dropDuplicates(["doc", "rk", "kind", "start"])
    is_base = F.col("kind") < len(BASE)
    by_start = Window.partitionBy("doc", "rk").orderBy("start")
    # the base spans that begin before a span end, and those after it begin, outside it
    upto = F.max(F.when(is_base, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(is_base, F.col("start"))).over(by_start.rangeBetween(1, Window.unboundedFollowing))
    rated = rated.withColumn("clear", (F.coalesce(upto, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end")))
    span = F.struct("start", "kind", "end", "repos", "owners", "live")
    pick = lambda when: F.sort_array(F.collect_list(F.when(when, span)))
    return rated.groupBy("doc", "rk").agg(pick(is_base).alias("base"), pick(~is_base & F.col("live") & F.col("clear")).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secret_ownership(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    found = materialize(scan(docs), "secret-spans")
    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("__rk"))
    out = keyed.join(checked_broadcast(found), (F.col("__rk") == F.col("rk")) & F.col("doc_id").eqNullSafe(F.col("doc")), "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,repos:bigint,owners:bigint,live:boolean>>")
    base, added = F.coalesce("base", none), F.coalesce("added", none)

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return out.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.sort_array(F.concat(base, added))).alias("spans"),
        F.size(F.filter(base, lambda s: s["live"])).cast("long").alias("n_live"),
    )


_RE2 = [ASSIGN, KINDS[1][1], KINDS[2][1], "[A-Za-z0-9_+/=-]{20,}"]
OP2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS source FROM documents),
m AS (%s),
z AS (SELECT r, source, kind, unnest(p[:len(w)]) AS p, unnest(w) AS w, unnest(v) AS v, unnest(range(len(w))) AS i FROM m),
s AS (SELECT r, source, kind, v, w, sum(length(p) + length(w)) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM z),
c AS (SELECT r, source, kind, v, e - length(w) AS b, e FROM s
      WHERE length(v) >= [6, 20, 24, 20][kind + 1] AND (kind < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')))),
o AS (SELECT v, count(DISTINCT split_part(source, '/', 1)) AS owners FROM c GROUP BY v),
x AS (SELECT c.*, owners FROM c JOIN o USING (v)),
k AS (SELECT x.*, ['assign', 'access', 'hex', 'opaque'][kind + 1] || ':' || CAST(b AS BIGINT) || ':' || CAST(e AS BIGINT) AS name FROM x
      WHERE kind < 3 OR (owners <= 1 AND NOT EXISTS (SELECT 1 FROM x y WHERE y.r = x.r AND y.kind < 3 AND y.b < x.e AND x.b < y.e))),
g AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(name, ',' ORDER BY b, kind) FILTER (kind < 3) AS base, string_agg(name, ',' ORDER BY b, kind) AS spans,
             count(*) FILTER (kind < 3 AND owners <= 1) AS n_live FROM k GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN g USING (r)
""" % " UNION ALL ".join(
    f"SELECT r, source, {k} AS kind, string_split_regex(t, '{p}') AS p, regexp_extract_all(t, '{p}') AS w, regexp_extract_all(t, '{p}', {KINDS[k][2]}) AS v FROM d WHERE regexp_matches(t, '{p}')"
    for k, p in enumerate(x.replace("'", "''") for x in _RE2)
)
