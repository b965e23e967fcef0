"""URL filter: host and path rules, and a logistic regression on hashed character n-grams for what no rule decides.

A url's host is what stands between its first ``://`` and the next ``/``, ``?`` or ``#`` (A-Z lower-cased), its path
what follows up to ``?`` or ``#``.  A rule (verdict, host, path) fits a url of its host, or of a subdomain of it,
whose path starts with the rule's; the longest rule (host and path together) wins, ties go to the longer host, then
to ``block``.  Other urls get the sign of a linear score: the n-grams of 3 and 4 code points of ``^host$`` and of
``^path$`` are hashed to ``buckets`` numbers, a url being the set of its numbers at unit length.

Everything is column expressions, applied in one narrow pass: no join, no shuffle, no Python worker.  The model is
fitted on a small labelled table of urls (a parameter, at most ``MAX_LABELLED`` rows, else an error) by full-batch
gradient descent with momentum.  The labelled urls form one row, whose ``aggregate`` runs the steps, so that the weights are one
value, which the plan of the scored table takes as a scalar subquery.  One bounded row is the only thing ever held
whole; urls are never gathered.

Defined cases: a null url, or one without ``://``, has an empty host and path and no n-grams, so no rule with a
path fits it and its score is the model's constant; a url of any length is read whole, in linear time; equal rows
are judged alike; an empty table gives an empty result; further columns are kept, and those named like a result's
column are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_LABELLED = 10_000

#: Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Words of invented sites that a corpus wants to leave out, and of ordinary ones: the labelled urls are built of them.
BLOCKED_WORDS = """
casino slots jackpot poker roulette bets betting odds lottery bingo win winner bonus spins viagra cialis pills meds
pharmacy drugs cheap discount replica weightloss adult xxx sex porn nude cams escort dating hot spam farm links
backlinks seo ads adserver banner popup track tracker tracking click pixel affiliate warez crack keygen serial torrent
free cash loans payday forex profit money rich prize giftcard survey
""".split()
ALLOWED_WORDS = """
library museum courier college garden history kitchen science council weather translation tradition thought motion
nation reading station theatre mathematics street action river other rather mother then threshing health university
source data documentation astronomy castle botany family boats railway parliament language chess bird radio farmers
mountain engineer economics poetry school patient geology teacher photography orchestra legal cycling village print
physics gazette consumer dialect marine election child ceramics transport with this that there these where when which
information education collection section question nature picture culture future letter winter master minister paper
house horse north south forest harbour island bridge tower market church doctor author editor student child woman
leben zeitung schule wasser garten kirche bruder welt vie monde maison jardin livre ville eau vida mundo casa libro agua
""".split()


def labelled_urls() -> list[tuple[str, int]]:
    """``(url, 1 to block or 0)``: pairs of words under changing subdomains, domains and paths, alike for both labels."""
    out = []
    for blocked, words in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS)):
        for i, first in enumerate(words):
            for j in range(1, 5):
                k = 4 * i + j
                second = words[(i + j * 17) % len(words)]
                host = ("", "www.", "blog.", "m.")[(k + k // 4) % 4] + first + ("-", "", "-", "")[j - 1] + second
                domain = ("com", "net", "org", "example.com", "example.net", "example.org")[k % 6]
                tail = ("", "/", ".html", "/index")[(k // 3) % 4]
                out.append((f"http://{host}.{domain}/{('en', 'de', 'fr', 'es')[k // 6 % 4]}/{k * 7919 % 50000}{tail}", blocked))
    return sorted(set(out))


@dataclass(frozen=True)
class Fit:
    buckets: int = 4096
    sizes: tuple[int, ...] = (3, 4)
    steps: int = 60
    rate: float = 4.0
    decay: float = 0.0001
    momentum: float = 0.95


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ngram_buckets(host: str, path: str, fit: Fit) -> str:
    """SQL for the distinct bucket numbers of two columns; the code points are split off once, so time is linear."""
    def grams(column: str, mark: str) -> list[str]:
        chars = f"split(concat('^', {column}, '$'), '')"
        return [f"transform(array({chars}), c -> if(size(c) < {n}, array(), transform(sequence(0, size(c) - {n}), "
                f"i -> cast(conv(substr(md5(concat('{mark}', {', '.join(f'c[i + {j}]' for j in range(n))})), 1, 4), 16, 10)"
                f" as int) % {fit.buckets})))[0]" for n in fit.sizes]
    return f"array_distinct(concat({', '.join(grams(host, 'h') + grams(path, 'p'))}))"


def labelled_table(spark: SparkSession) -> DataFrame:
    """The small labelled table ``(url, blocked)``."""
    rows = ", ".join(f"('{u}', {b})" for u, b in labelled_urls())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(url, blocked)")


def train(labelled: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """One row ``(w, bias)`` from ``labelled(url, blocked)``, blocked being 1 or 0; a url is taken once a label."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.select("url", F.col("blocked").cast("double").alias("y")).distinct().select(
        "url", "y", host.alias("host"), path.alias("path"))
    rows = rows.select(F.struct("url", "y", F.expr(ngram_buckets("host", "path", fit)).alias("b")).alias("e"))
    some = rows.agg(F.expr(f"slice(collect_list(e), 1, {MAX_LABELLED})").alias("ex"), F.count(F.lit(1)).alias("n"))
    some = some.select(F.when(F.col("n") <= MAX_LABELLED, F.array_sort("ex")).otherwise(
        F.raise_error(F.lit(f"more than {MAX_LABELLED} labelled urls"))).alias("ex"))
    # limit(1) keeps the planner from merging the projections, which would build the lists again at every step
    some = some.selectExpr(
        "transform(ex, e -> struct(e.y AS y, 1 / sqrt(greatest(size(e.b), 1)) AS s, e.b AS b)) AS ex").limit(1)
    # each bucket's examples, so that a step's gradient is one pass over the pairs of example and bucket
    pairs = some.selectExpr("posexplode(ex) AS (i, e)").selectExpr("explode(e.b) AS j", "i", "e.s AS s")
    every = some.sparkSession.range(fit.buckets).selectExpr("cast(id as int) AS j", "null AS i", "null AS s")
    lists = pairs.unionByName(every).groupBy("j").agg(F.expr(
        "array_sort(collect_list(CASE WHEN i IS NOT NULL THEN struct(i, s) END))").alias("l"))
    turned = lists.agg(F.expr("transform(array_sort(collect_list(struct(j, l))), x -> x.l)").alias("inv"))
    some = some.select("ex", turned.scalar().alias("inv")).limit(1)
    residual = ("transform(ex, e -> 1 / (1 + exp(-(m.bias + e.s * aggregate(e.b, 0D, (a, b) -> a + m.w[b])))) - e.y)")
    rate = f"{fit.rate!r}D / greatest(size(ex), 1)"
    # v and vb are the steps that are taken: part of the last one, and the gradient's
    step = f"""transform(array(transform(array({residual}), r -> named_struct(
        'v', transform(inv, (l, j) -> {fit.momentum!r}D * m.v[j] - {fit.rate * fit.decay!r}D * m.w[j]
                 - {rate} * aggregate(l, 0D, (a, x) -> a + r[x.i] * x.s)),
        'vb', {fit.momentum!r}D * m.vb - {rate} * aggregate(r, 0D, (a, x) -> a + x)))[0]), g -> named_struct(
        'w', zip_with(m.w, g.v, (a, b) -> a + b), 'v', g.v, 'bias', m.bias + g.vb, 'vb', g.vb))[0]"""
    start = (f"named_struct('w', array_repeat(0D, {fit.buckets}), 'v', array_repeat(0D, {fit.buckets}), "
             f"'bias', 0D, 'vb', 0D)")
    return some.selectExpr(f"aggregate(sequence(1, {fit.steps}), {start}, (m, t) -> {step}) AS m").select("m.w", "m.bias")


def judge(pages: DataFrame, labelled: DataFrame, url_col: str = "url", rules=RULES, fit: Fit = Fit()) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits), ``verdict`` and ``score`` (null where a
    rule decides; over 0: block)."""
    host, path = host_and_path(F.col(url_col))
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r))
    model = train(labelled, fit).select(F.struct("w", "bias").alias("m"))
    found = pages.withColumns({"host": host, "path": path})
    fitting = F.lit(None)
    if order:
        table = F.array(*(F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in order))
        fitting = F.get(F.filter(table, lambda r: (
            (F.col("host") == r["host"]) | F.col("host").endswith(F.concat(F.lit("."), r["host"])))
            & F.col("path").startswith(r["path"])), F.lit(0))
        found = found.withColumn("rule", fitting)
    else:
        found = found.withColumn("rule", F.expr("cast(null as struct<verdict: string, host: string, path: string>)"))
    found = found.withColumn("score", F.when(F.col("rule").isNull(), F.struct(
        model.scalar().alias("m"), F.expr(ngram_buckets("host", "path", fit)).alias("b"))))
    found = found.withColumn("score", F.expr(
        "score.m.bias + aggregate(score.b, 0D, (a, b) -> a + score.m.w[b]) / sqrt(greatest(size(score.b), 1))"))
    verdict = F.when(F.col("rule").isNotNull(), F.col("rule.verdict")).otherwise(
        F.when(F.col("score") > 0, "block").otherwise("allow"))
    return found.withColumns({"verdict": verdict, "rule": F.concat("rule.host", "rule.path")})


def oracle_sql(pages: str, rules=RULES, fit: Fit = Fit()) -> str:
    """DuckDB SQL for :func:`judge` over ``pages``, a query of ``(page_id, url)``: rules, training and scores."""
    labelled = ", ".join(f"('{u}', {b})" for u, b in labelled_urls())
    rule_rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)

    def parts(source: str) -> str:
        rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
        return (f"SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                f"'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path "
                f"FROM (SELECT *, coalesce({rest}, '') AS rest FROM {source})")

    def buckets(source: str) -> str:
        grams = " UNION ALL ".join(
            f"SELECT host, path, unnest(list_transform(range(1, length({c}) + {3 - n} + 1), lambda i: '{c[0]}' || "
            f"substr('^' || {c} || '$', i, {n}))) AS g FROM (SELECT DISTINCT host, path FROM {source})"
            for c in ("host", "path") for n in fit.sizes)
        return (f"SELECT DISTINCT host, path, CAST('0x' || substr(md5(g), 1, 4) AS INTEGER) % {fit.buckets} AS b "
                f"FROM ({grams})")

    return f"""
WITH RECURSIVE labelled(url, y) AS (VALUES {labelled}),
  rules(verdict, host, path) AS (VALUES {rule_rows}),
  ex AS MATERIALIZED (SELECT row_number() OVER (ORDER BY url, y) AS i, y, host, path FROM ({parts("labelled")})),
  feat AS MATERIALIZED (SELECT e.i, f.b, 1 / sqrt(count(*) OVER (PARTITION BY e.i)) AS s
                        FROM ex e JOIN ({buckets("ex")}) f ON f.host = e.host AND f.path = e.path),
  packed AS MATERIALIZED (
    SELECT (SELECT list(struct_pack(y := y, s := s, b := bs) ORDER BY i) FROM (
              SELECT e.i, any_value(e.y) AS y, coalesce(any_value(f.s), 1) AS s,
                     coalesce(list(f.b ORDER BY f.b) FILTER (WHERE f.b IS NOT NULL), []) AS bs
              FROM ex e LEFT JOIN feat f ON f.i = e.i GROUP BY e.i)) AS examples,
           (SELECT list(l ORDER BY j) FROM (
              SELECT j, list(struct_pack(i := f.i, s := f.s)) FILTER (WHERE f.i IS NOT NULL) AS l
              FROM range(0, {fit.buckets}) AS r(j) LEFT JOIN feat f ON f.b = r.j GROUP BY j)) AS inv),
  fitted(t, w, v, bias, vb) AS (
    SELECT 0, list_transform(range(0, {fit.buckets}), lambda j: 0::DOUBLE),
           list_transform(range(0, {fit.buckets}), lambda j: 0::DOUBLE), 0::DOUBLE, 0::DOUBLE
    UNION ALL
    SELECT t + 1, list_transform(range(1, {fit.buckets} + 1), lambda j: w[j] + g[j]), g, bias + gb, gb
    FROM (SELECT t, w, bias, list_transform(range(1, {fit.buckets} + 1), lambda j: {fit.momentum!r}::DOUBLE * v[j]
                   - {fit.rate * fit.decay!r}::DOUBLE * w[j] - {fit.rate!r}::DOUBLE / len(r)
                   * coalesce(list_sum(list_transform(inv[j], lambda x: r[x.i] * x.s)), 0)) AS g,
                 {fit.momentum!r}::DOUBLE * vb - {fit.rate!r}::DOUBLE / len(r) * list_sum(r) AS gb
          FROM (SELECT t, w, v, bias, vb, inv, list_transform(examples, lambda e: 1 / (1 + exp(-(bias + e.s * coalesce(
                         list_sum(list_transform(e.b, lambda b: w[b + 1])), 0)))) - e.y) AS r
                FROM fitted CROSS JOIN packed WHERE t < {fit.steps}))),
  model AS MATERIALIZED (SELECT bias, w FROM fitted WHERE t = {fit.steps}),
  weights AS (SELECT unnest(range(0, {fit.buckets})) AS b, unnest(w) AS w FROM model),
  site AS MATERIALIZED ({parts(f"({pages})")}),
  places AS MATERIALIZED (SELECT DISTINCT host, path FROM site),
  matched AS (SELECT p.host, p.path, r.host || r.path AS rule, r.verdict, row_number() OVER (
                PARTITION BY p.host, p.path ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict DESC) AS k
              FROM places p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
  scored AS (SELECT f.host, f.path, sum(w.w) / sqrt(count(*)) AS s
             FROM ({buckets("places")}) f JOIN weights w ON w.b = f.b GROUP BY f.host, f.path)
SELECT s.page_id, s.host, s.path, m.rule,
       coalesce(m.verdict, CASE WHEN (SELECT bias FROM model) + coalesce(c.s, 0) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM site s LEFT JOIN matched m ON m.host = s.host AND m.path = s.path AND m.k = 1
LEFT JOIN scored c ON c.host = s.host AND c.path = s.path
"""
