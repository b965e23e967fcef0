"""Licence scan: sparse TF-IDF cosine of headers, notices and licence files to templates, then inheritance from the
nearest ancestor directory.

A file's passages are its sentences (a line is cut at stops followed by a blank), its blocks (runs of lines with
words; the first one is its header) and the whole file.  A passage is the sparse vector of its words' tf-idf weights
(document frequencies over all files).  It is evidence for the licence of a template if it holds all words that the
template requires (version numbers and the like) and their cosine reaches ``threshold``.  A file's own licence is that
of its best evidence, a reservation of rights only where there is no other.  A file speaks for its directory if its
first block is a licence's title, or if the evidence of one kind of passage holds ``file_share`` of its words or more.
A file without a licence of its own takes that of the nearest ancestor directory that has one, by joins on paths.

DataFrame functions only.  Only passages that hold all words of some template's requirement are ever exploded (exact).
Document frequencies are counted per task before the shuffle.  The templates, which don't
grow with the data, are the only thing broadcast, and the number of files the only thing collected.  A frequent word's
rows are dealt over copies of its frequency.  Directories are resolved once each, not once per file.

Defined cases: a null text has no words; a null part of a path reads ``-``; of equal cosines the licence first in
alphabet, then the smaller passage kind and the earlier passage; a directory with several files that speak takes the
best as among evidence, then the smallest path; repeated rows each get a row; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow.llm.common import stage
from dealflow.llm.license_templates import PROPRIETARY, TEMPLATES, Template
from dealflow.operators.lookup import lookup

THRESHOLD = 0.6
FILE_SHARE = 0.3
WORD_BREAK = r"[^\p{L}\p{N}]+"
SENTENCE_BREAK = r"[.!?]+[ \t]+|\n"
BLOCK_BREAK = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"
BLOCK_BREAK_RE2 = BLOCK_BREAK.replace("*+", "*").replace("++", "+")
SALTS = 16


def words(text: str) -> Counter:
    return Counter(w for w in re.split(r"[\W_]+", text.lower()) if w)


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_BREAK), "")


def anchors(templates: list[Template]) -> list[str]:
    return sorted({t.required.split()[0] for t in templates})


def passages(text: Column) -> Column:
    """``(kind, pos, body)`` of a text's sentences, blocks and the whole."""
    def numbered(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), x.alias("body")))

    start = F.regexp_replace(text, r"^[^\p{L}\p{N}]+", "")
    return F.concat(numbered("sentence", F.split(text, SENTENCE_BREAK)), numbered("block", F.split(start, BLOCK_BREAK)),
                    numbered("file", F.array(text)))


def _template_rows(templates: list[Template]) -> tuple[str, str]:
    """SQL rows ``(t, word, n, required)`` of the templates' words, and ``(t, license, kind, n_required)`` of the templates."""
    word_rows = ", ".join(f"({i}, '{w}', {n}, {int(w in t.required.split())})"
                          for i, t in enumerate(templates) for w, n in words(t.text).items())
    rows = ", ".join(f"({i}, '{t.license}', '{t.kind}', {len(set(t.required.split()))})" for i, t in enumerate(templates))
    return word_rows, rows


def comparable(text_words: Column, templates: list[Template]) -> Column:
    """Whether an array of words holds all that some template requires: one look at the words, then a pattern over the
    few of them that any template requires."""
    needs = sorted({tuple(sorted(set(t.required.split()))) for t in templates})
    held = F.array_intersect(text_words, F.array(*map(F.lit, sorted({w for n in needs for w in n}))))
    pattern = "^(?:" + "|".join("".join(f"(?=.* {w} )" for w in n) for n in needs) + ")"
    return F.concat(F.lit(" "), F.array_join(held, "  "), F.lit(" ")).rlike(pattern)


KEY = ["path", "h", "kind", "pos"]


def _passage_words(files: DataFrame, templates: list[Template]) -> DataFrame:
    """``(path, h, file_words, kind, pos, words)``: passages of ``files`` that hold all that a template requires."""
    any_anchor = F.array(*map(F.lit, anchors(templates)))
    whole = word_array(F.col("text"))
    some = files.where(F.arrays_overlap(whole, any_anchor)).where(comparable(whole, templates)).dropDuplicates(["path", "h"])
    parts = some.select("path", "h", F.size(whole).alias("file_words"), F.explode(passages(F.col("text"))).alias("p")).select(
        "path", "h", "file_words", "p.kind", "p.pos", word_array(F.col("p.body")).alias("words"))
    return parts.where(F.arrays_overlap("words", any_anchor)).where(comparable(F.col("words"), templates))


def evidence(files: DataFrame, templates: list[Template] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(path, h, kind, pos, title, license, score, n_words, file_words)``: passages of ``files(path, h, text)`` that match.

    The templates' words give a passage's products; with them and the number of its other words, which weigh 1 each
    at least, the cosine is bounded from above, and only passages that may reach the threshold get all words weighed.
    """
    spark = files.sparkSession
    word_rows, rows = _template_rows(templates)
    template_words = spark.sql(f"SELECT * FROM VALUES {word_rows} AS w(t, word, n, required)")
    template = spark.sql(f"SELECT * FROM VALUES {rows} AS t(t, license, template_kind, n_required)")
    total = F.lit(files.count())
    idf = F.log((1 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1
    seen = files.select(F.explode(F.array_distinct(word_array(F.col("text")))).alias("word"))
    freq = stage(seen.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "license-frequencies")

    vocabulary = template_words.select("word").distinct()
    vocabulary = stage(freq.join(F.broadcast(vocabulary), "word", "right").select("word", idf.alias("idf")), "license-vocabulary")
    units = template_words.join(vocabulary, "word").withColumn("x", F.col("n") * F.col("idf"))
    length = units.groupBy("t").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    units = units.join(length, "t").select("t", "word", (F.col("x") / F.col("length")).alias("unit"))

    parts = _passage_words(files, templates)
    exploded = parts.select(*KEY, "file_words", F.size("words").alias("n_words"), F.explode("words").alias("word"))
    counted = stage(exploded.join(F.broadcast(vocabulary), "word").groupBy(*KEY, "file_words", "n_words", "word", "idf").agg(
        F.count(F.lit(1)).alias("tf")).withColumn("w", F.col("tf") * F.col("idf")), "license-words")
    required = template_words.where("required = 1").join(template, "t").select("t", "word", "license", "template_kind", "n_required")
    first = (F.col("kind") == "block") & (F.col("pos") == 0)
    pairs = (counted.join(F.broadcast(required), "word").where((F.col("template_kind") != "title") | first)
             .groupBy(*KEY, "t", "license", "template_kind", "n_required").agg(F.count(F.lit(1)).alias("held"))
             .where(F.col("held") == F.col("n_required")).drop("held", "n_required"))
    inner = counted.groupBy(*KEY).agg(F.sum(F.col("w") * F.col("w")).alias("inner"), F.sum("tf").alias("n_inner"))
    dots = (counted.join(pairs, KEY).join(F.broadcast(units), ["t", "word"])
            .groupBy(*KEY, "file_words", "n_words", "t", "license", "template_kind").agg(F.sum(F.col("w") * F.col("unit")).alias("dot")))
    least = F.sqrt(F.col("inner") + F.col("n_words") - F.col("n_inner"))
    hopeful = stage(dots.join(inner, KEY).where(F.col("dot") / least >= threshold - 1e-5).drop("inner", "n_inner"), "license-hopeful")

    some = files.join(hopeful.select("path", "h").distinct(), ["path", "h"], "left_semi")
    again = _passage_words(some, templates).join(hopeful.select(*KEY).distinct(), KEY, "left_semi")
    each = stage(again.select(*KEY, F.explode("words").alias("word")).groupBy(*KEY, "word").agg(
        F.count(F.lit(1)).alias("tf")).withColumn("passage", F.xxhash64(*KEY)), "license-passages")
    known = each.select("word").distinct().join(freq, "word").select(F.col("word").alias("known"), "df")
    w = F.col("tf") * idf
    norms = lookup(each, known, [(F.col("word"), "known")], "passage", SALTS).groupBy(*KEY).agg(F.sqrt(F.sum(w * w)).alias("norm"))
    scored = hopeful.join(norms, KEY).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(
        F.col("score") >= threshold)
    order = F.struct(F.col("license") == PROPRIETARY, -F.col("score"), "license")
    return scored.groupBy(*KEY).agg(
        F.min_by(F.struct("license", "score", "n_words", "file_words"), order).alias("b"),
        F.max(F.col("template_kind") == "title").alias("title")).select(*KEY, "title", "b.*")


def parent(path: Column) -> Column:
    """The directory of a path ('' at the top)."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """A directory and those above it, nearest first."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan(files: DataFrame, id_col: str = "file_id", path_col: str = "path", text_col: str = "text",
         templates: list[Template] = TEMPLATES, threshold: float = THRESHOLD, file_share: float = FILE_SHARE) -> DataFrame:
    """``(id, path, license, score, origin, from_path)``; origin is ``own``, ``inherited`` or ``none``."""
    base = files.select(F.col(id_col).alias("id"), F.coalesce(F.col(path_col), F.lit("-")).alias("path"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    found = stage(evidence(base.select("path", "h", "text"), templates, threshold), "license-evidence")
    weak = lambda name: F.col(name) == PROPRIETARY
    share = found.groupBy("path", "h", "kind").agg((F.sum("n_words") / F.max("file_words")).alias("share"))
    share = share.groupBy("path", "h").agg(F.max("share").alias("share"))
    own = found.groupBy("path", "h").agg(
        F.min_by(F.struct("license", "score"), F.struct(weak("license"), -F.col("score"), "license", "kind", "pos")).alias("own"),
        F.max("title").alias("title")).join(share, ["path", "h"])

    speaks = own.where(F.col("title") | (F.col("share") >= file_share)).withColumn("directory", parent(F.col("path")))
    chosen = speaks.groupBy("directory").agg(
        F.min_by(F.struct("own.license", "own.score", F.col("path").alias("from_path")),
                 F.struct(weak("own.license"), -F.col("own.score"), "path", "own.license")).alias("inherited"))
    marked = base.select("id", "path", "h").join(own.select("path", "h", "own"), ["path", "h"], "left").withColumn(
        "directory", parent(F.col("path")))
    wanted = marked.where(F.col("own").isNull()).select("directory").distinct()
    steps = wanted.select("directory", F.posexplode(ancestors(F.col("directory"))).alias("up", "above"))
    nearest = (steps.join(chosen.withColumnRenamed("directory", "above"), "above").groupBy("directory")
               .agg(F.min_by("inherited", "up").alias("inherited")))
    full = marked.join(nearest, "directory", "left")
    has_own = F.col("own").isNotNull()
    return full.select(
        F.col("id").alias(id_col), F.col("path"),
        F.when(has_own, F.col("own.license")).otherwise(F.col("inherited.license")).alias("license"),
        F.when(has_own, F.col("own.score")).otherwise(F.col("inherited.score")).alias("score"),
        F.when(has_own, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(has_own, F.col("path")).otherwise(F.col("inherited.from_path")).alias("from_path"))


def oracle_sql(files: str, templates: list[Template] = TEMPLATES, threshold: float = THRESHOLD,
               file_share: float = FILE_SHARE) -> str:
    """DuckDB SQL for :func:`scan` over ``files``, a query of ``(id, path, text)`` with unique paths.

    Compares every passage of every file with every template; anchors play no part in it.
    """
    word_rows, rows = _template_rows(templates)
    return rf"""
WITH files AS ({files}),
  template_words(t, word, n, required) AS (VALUES {word_rows}),
  template(t, license, template_kind, n_required) AS (VALUES {rows}),
  cut AS (SELECT path, string_split_regex(body, '{SENTENCE_BREAK}') AS sentences, [body] AS whole,
                 string_split_regex(regexp_replace(body, '^[^\p{{L}}\p{{N}}]+', ''), '{BLOCK_BREAK_RE2}') AS blocks
          FROM (SELECT path, coalesce(text, '') AS body FROM files)),
  passages AS (SELECT path, 'sentence' AS kind, unnest(range(len(sentences))) AS pos, unnest(sentences) AS body FROM cut
               UNION ALL SELECT path, 'block', unnest(range(len(blocks))), unnest(blocks) FROM cut
               UNION ALL SELECT path, 'file', 0, unnest(whole) FROM cut),
  tokens AS (SELECT path, kind, pos, unnest(string_split_regex(lower(body), '[^\p{{L}}\p{{N}}]+')) AS word FROM passages),
  counted AS (SELECT path, kind, pos, word, count(*) AS tf FROM tokens WHERE word <> '' GROUP BY ALL),
  freq AS (SELECT word, count(*) AS df FROM counted WHERE kind = 'file' GROUP BY word),
  size AS (SELECT count(*) AS n FROM files),
  idf AS (SELECT v.word, ln((1 + s.n) / (1 + coalesce(f.df, 0))) + 1 AS idf
          FROM (SELECT word FROM template_words UNION SELECT word FROM counted) v LEFT JOIN freq f ON f.word = v.word
          CROSS JOIN size s),
  unit AS (SELECT t.t, t.word, t.required, t.n * i.idf / sqrt(sum(t.n * i.idf * t.n * i.idf) OVER (PARTITION BY t.t)) AS unit
           FROM template_words t JOIN idf i ON i.word = t.word),
  weighed AS (SELECT c.*, c.tf * i.idf AS w FROM counted c JOIN idf i ON i.word = c.word),
  norms AS (SELECT path, kind, pos, sqrt(sum(w * w)) AS norm, sum(tf) AS n_words FROM weighed GROUP BY ALL),
  dots AS (SELECT w.path, w.kind, w.pos, u.t, sum(w.w * u.unit) AS dot, sum(u.required) AS held
           FROM weighed w JOIN unit u ON u.word = w.word GROUP BY ALL),
  scored AS (SELECT d.path, d.kind, d.pos, t.license, t.template_kind = 'title' AS title, n.n_words,
                    round(d.dot / n.norm, 6) AS score
             FROM dots d JOIN template t ON t.t = d.t AND t.n_required = d.held
             JOIN norms n ON n.path = d.path AND n.kind = d.kind AND n.pos = d.pos
             WHERE t.template_kind <> 'title' OR (d.kind = 'block' AND d.pos = 0)),
  matched AS (SELECT * FROM scored WHERE score >= {threshold}),
  own AS (SELECT path, license, score FROM (
            SELECT *, row_number() OVER (PARTITION BY path ORDER BY license = '{PROPRIETARY}', score DESC, license, kind, pos) AS q
            FROM matched) WHERE q = 1),
  share AS (SELECT path, max(share) AS share FROM (
              SELECT m.path, m.kind, sum(m.n_words) / max(f.n_words) AS share
              FROM (SELECT DISTINCT path, kind, pos, n_words FROM matched) m
              JOIN norms f ON f.path = m.path AND f.kind = 'file' GROUP BY m.path, m.kind) GROUP BY path),
  titled AS (SELECT path, bool_or(title) AS title FROM matched GROUP BY path),
  speaks AS (SELECT o.*, regexp_replace(o.path, '/?[^/]*$', '') AS directory
             FROM own o JOIN share s ON s.path = o.path JOIN titled t ON t.path = o.path
             WHERE t.title OR s.share >= {file_share}),
  chosen AS (SELECT * FROM (SELECT *, row_number() OVER (
               PARTITION BY directory ORDER BY license = '{PROPRIETARY}', score DESC, path) AS r FROM speaks) WHERE r = 1),
  above AS (SELECT f.id, f.path, c.license, c.score, c.path AS from_path,
                   row_number() OVER (PARTITION BY f.path ORDER BY length(c.directory) DESC) AS r
            FROM files f JOIN chosen c ON starts_with(f.path, c.directory || '/'))
SELECT f.id AS doc_id, f.path, coalesce(o.license, a.license) AS license, coalesce(o.score, a.score) AS score,
       CASE WHEN o.path IS NOT NULL THEN 'own' WHEN a.path IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.path IS NOT NULL THEN f.path ELSE a.from_path END AS from_path
FROM files f LEFT JOIN own o ON o.path = f.path LEFT JOIN (SELECT * FROM above WHERE r = 1) a ON a.path = f.path
"""
