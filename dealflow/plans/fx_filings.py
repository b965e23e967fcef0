"""Fixture views for the filing pipeline, derived from orders, customer,
part and documents (definitions in FIXTURES.md §3).  DuckDB twins are in
``dealflow.plans.ox_filings``; every expression is written in the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.functions.timefns import iso_seconds, rfc2822
from dealflow.operators.lookup import SLOTS
from dealflow.sources.tables import table

# Fixed values for the fixtures.
FEED_OFFSET = 1_000_000_000_000          # backup entries rank after all primary ones
NBSP = " "


def letters(n: Column) -> Column:
    """A ticker from a number: digits 0-9 become letters A-J."""
    return F.translate(n.cast("string"), "0123456789", "ABCDEFGHIJ")


def _k() -> Column:
    return F.col("k")


def filings_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_orderstatus", "o_orderdate",
        "o_totalprice", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k = _k()
    cik = F.col("o_custkey").cast("string")
    cik10 = F.lpad(cik, 10, "0")
    acc18 = F.concat(cik10, F.lpad((F.year("o_orderdate") % 100).cast("string"), 2, "0"),
                     F.lpad((k % 1000000).cast("string"), 6, "0"))
    dashed = F.concat_ws("-", F.substring(acc18, 1, 10), F.substring(acc18, 11, 2), F.substring(acc18, 13, 6))
    form = F.when(F.col("o_orderstatus") == "P", F.lit("10-Q")).otherwise(F.lit("8-K"))
    tick = letters(F.col("c_custkey"))
    suffix = (F.when(k % 3 == 0, F.concat(F.lit(" ("), cik10, F.lit(") (Filer)")))
              .when(k % 3 == 1, F.concat(F.lit(" ("), tick, F.lit(")")))
              .otherwise(F.concat(F.lit(" ("), cik10, F.lit(")"))))
    arch = F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/"), cik, F.lit("/"), acc18, F.lit("/"))
    link = (F.when(k % 4 == 0, F.concat(arch, dashed, F.lit("-index.htm")))
            .when(k % 4 == 1, arch)
            .when(k % 4 == 2, F.concat(F.lit("https://www.sec.gov/cgi-bin/browse-edgar?action=view&cik="),
                                       cik, F.lit("&accession_number="), dashed))
            .otherwise(F.lit("https://www.sec.gov/cgi-bin/browse-edgar?action=getcurrent")))
    entry_id = (F.when(k % 4 == 1, F.concat(F.lit("urn:tag:sec.gov,2008:accession-number="), dashed))
                .otherwise(F.concat(F.lit("urn:tag:sec.gov,2008:entry="), k.cast("string"))))
    pub = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), (k * 37 % 1440).cast("int"), F.lit(0))
    minus5 = pub - F.make_dt_interval(F.lit(0), F.lit(5), F.lit(0), F.lit(0))
    raw = (F.when(k % 31 == 0, F.lit(""))
           .when(k % 4 == 2, F.concat(rfc2822(minus5), F.lit(" -0500")))
           .when(k % 2 == 0, F.concat(rfc2822(pub), F.lit(" +0000")))
           .otherwise(F.concat(iso_seconds(pub), F.lit("Z"))))
    return j.select(
        k, cik.alias("cik"), acc18.alias("accession18"), dashed.alias("accession_true"),
        form.alias("form"), F.concat(form, F.lit(" - "), F.upper("c_name"), suffix).alias("title"),
        link.alias("link"), entry_id.alias("entry_id"), pub.alias("published_ts"),
        raw.alias("published_raw"),
        F.concat(iso_seconds(pub), F.lit("Z")).alias("updated"),
        (k % 5 != 0).alias("in_primary"), (k % 5).isin(0, 1).alias("in_backup"),
        k.alias("feed_rank"), F.col("o_custkey").alias("custkey"), "c_name",
        "o_totalprice", "o_orderpriority")


def feed_entries_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds as landed rows: ``feed`` names the source, ``feed_rank`` the
    order within the combined scan (primary first)."""
    f = filings_fx(spark, sf_dir)
    cols = ["k", "title", "link", "entry_id", "published_raw", "updated"]
    each = F.filter(F.array(F.when(F.col("in_primary"), F.lit("primary")), F.when(F.col("in_backup"), F.lit("backup"))),
                    lambda x: x.isNotNull())
    rank = F.when(F.col("feed") == "backup", F.col("k") + F.lit(FEED_OFFSET)).otherwise(F.col("k"))
    return f.select(*cols, F.explode(each).alias("feed")).withColumn("feed_rank", rank)


def ledger_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = filings_fx(spark, sf_dir)
    k = _k()
    return f.where((k % 4 != 3) & ((k % 10 < 3) | (k % 1000 >= 960))).select(
        F.col("accession_true").alias("accession"))


def issuers_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    return c.select(ck.alias("ordinal"), ck.alias("cik_str"),
                    F.when(ck % 11 != 0, letters(ck)).alias("ticker"),
                    F.upper("c_name").alias("title"))


def submissions_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The submissions feed in tidy form: one row per listed (cik, accession)
    with its item list and the issuer's first ticker.  Filings with
    ``k % 13 = 0`` are not listed."""
    f = filings_fx(spark, sf_dir)
    k = _k()
    items = (F.when(k % 3 == 0, F.lit("1.01,9.01")).when(k % 3 == 1, F.lit("5.02")).otherwise(F.lit("")))
    ck = F.col("custkey")
    return f.where(k % 13 != 0).select(
        F.col("cik").alias("cik"), F.col("accession_true").alias("accession"), items.alias("items"),
        F.when(ck % 11 != 0, letters(ck)).alias("first_ticker"))


def names_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    suffix = (F.when(pk % 4 == 0, F.lit(" INC")).when(pk % 4 == 1, F.lit(" CORP"))
              .when(pk % 4 == 2, F.lit(" LTD")).otherwise(F.lit(" CO")))
    return p.select(pk.alias("name_id"), F.concat(F.upper("p_name"), suffix).alias("company"))


def name_quotes_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes keyed by a word ticker: the part with the lowest key for each
    first word; price 0 when ``p_size <= 10``."""
    p = table(spark, sf_dir, "part")
    word = F.upper(F.substring_index(F.col("p_name"), " ", 1))
    first = p.groupBy(word.alias("ticker")).agg(
        F.min_by(F.struct("p_size", "p_retailprice"), F.col("p_partkey")).alias("q"))
    return first.select("ticker", F.when(F.col("q.p_size") > 10, F.col("q.p_retailprice") / 10)
                        .otherwise(F.lit(0.0)).alias("regular_market_price"))


def market_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market snapshots with the reference's raw fields."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    n_part = table(spark, sf_dir, "part").count()          # from the footers
    j = c.join(p, (c.c_custkey % n_part) == p.p_partkey, "inner")
    ck = F.col("c_custkey")
    price = F.col("p_retailprice") / 10
    prev = F.col("p_retailprice") / 10 * 0.97
    shares = ((ck % 97 + 1) * 100000).cast("double")
    return j.select(
        ck.alias("custkey"),
        F.when(ck % 11 != 0, letters(ck)).alias("ticker"),
        F.when(ck % 17 != 0, price).alias("current_price"),
        F.when(ck % 2 == 1, price).alias("regular_market_price"),
        F.when(ck % 3 != 0, prev).alias("previous_close"),
        prev.alias("regular_market_previous_close"),
        shares.alias("shares_outstanding"),
        F.when(ck % 13 != 0, shares * prev).alias("market_cap"),
        F.when(ck % 19 != 0, (ck * 7919 % 400) * 1000).cast("double").alias("avg_volume"),
        ((ck * 104729 % 2000) * 1000).cast("double").alias("volume"),
        ((ck % 30) / 100).alias("short_percent"),
        ((ck % 101) / 100).alias("institutional_pct"),
        ((ck % 41) - 20).cast("double").alias("week_change_pct"),
        F.when(ck % 23 == 0, F.lit("no data")).alias("error"))


def sub_tickers_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issuer tickers of the submissions feed, one row per CIK."""
    ck = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        ck.cast("string").alias("cik"), F.when(ck % 11 != 0, letters(ck)).alias("first_ticker"))


# Sentences planted in fixture documents (keyword and money cases).
KEYWORD_SENTENCES = (
    "The parties entered into a merger agreement.",
    "The company amended its revolving credit facility and agreed a purchase price.",
    "The parties signed a definitive agreement.",
    "The executive signed an employment agreement at an offer price.",
    "The tender offer is made under an indenture.",
    "Holders of < 5% of the shares are bound by the merger" + NBSP + "agreement; the test needs > 50%.",
)
MONEY_SENTENCES = (
    "The purchase price of approximately ${n} million will be paid at closing.",
    "The total consideration of ${n},000,000 is payable at closing.",
    "The buyer will pay ${n} billion in cash.",
    "The business is valued at approximately ${n}.5 bn today.",
    "The offer price of ${n} per share is final.",
    "The purchase price of ${n},000,000 by the buyer is fixed.",
    "The aggregate" + NBSP + "consideration of $" + NBSP + "{n}" + NBSP + "million is payable.",
)


def _pick(k: Column, modulus: int, options) -> Column:
    out = F.lit(None).cast("string")
    for i in reversed(range(len(options))):
        out = F.when(k % modulus == i, options[i]).otherwise(out)
    return out


def dealt_by_document(spark: SparkSession, sf_dir: str, filings: DataFrame, number: str = "k") -> DataFrame:
    """Filings with their documents' keys ``_doc`` (their number modulo the number of documents, whose ids run from
    0), dealt out by them.

    The texts make up far more than what the shuffles of the join hold, so its partitions are as many as the session
    sets, not as few as those bytes suggest.  Filings without a number are spread over keys that no document has."""
    n_docs = table(spark, sf_dir, "documents").count()               # from the footers
    none = F.concat(F.lit("none "), F.pmod(F.xxhash64("k"), F.lit(SLOTS)).cast("string"))
    f = filings.withColumn("_doc", F.coalesce((F.col(number) % n_docs).cast("string"), none))
    return f.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_doc")


def joined_document(spark: SparkSession, sf_dir: str, dealt: DataFrame, name: str, only: Column | None = None,
                    needed: DataFrame | None = None) -> DataFrame:
    """Each dealt row's document, whole text; ``only`` where a condition holds.  The rows stay where they are.

    ``needed`` holds the numbers ``k`` of all filings whose documents are asked for, and more maybe: the texts of
    others are left out before they are sorted."""
    docs = table(spark, sf_dir, "documents")
    d = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("string").alias("_id"), F.col("text").alias(name))
    if needed is not None:
        d = d.join(needed.select((_k() % docs.count()).cast("string").alias("_id")).distinct(), "_id", "left_semi")
    same = F.col("_doc") == F.col("_id")
    return dealt.join(d, same if only is None else same & only, "left").drop("_id")


def with_document(spark: SparkSession, sf_dir: str, filings: DataFrame, name: str, number: str = "k",
                  needed: DataFrame | None = None) -> DataFrame:
    """Each filing's document, whole text."""
    dealt = dealt_by_document(spark, sf_dir, filings, number)
    return joined_document(spark, sf_dir, dealt, name, needed=needed).drop("_doc")


def filing_docs_fx(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None, need: Column | None = None,
                   analysis: bool = False, needed: DataFrame | None = None) -> DataFrame:
    """One raw filing document per fixture filing (``k % 29 = 0`` is empty).

    With ``rows`` (filing numbers ``k`` and further columns) it is ``rows`` left-joined to those documents: every row
    with its column ``raw``, null without a filing or where ``need`` (a condition over ``rows``) is false.  The rows
    meet their filings before the texts come in, so that no text goes through a shuffle once per filing.  With
    ``analysis`` they get the texts of the analysis too, dealt out once for both.  ``needed`` as in ``joined_document``."""
    f = filings_fx(spark, sf_dir).select("k", "cik", "accession_true", "custkey", "c_name")
    if rows is None:
        return _filing_docs(with_document(spark, sf_dir, f, "body")).select(
            "k", "cik", F.col("accession_true").alias("accession"), "raw")
    f = f.select(F.col("k").alias("_k"), F.col("custkey").alias("_custkey"), F.col("c_name").alias("_c_name"))
    same = F.col("k") == F.col("_k")
    j = rows.join(f, same if need is None else same & need, "left")
    if analysis:
        d = joined_document(spark, sf_dir, dealt_by_document(spark, sf_dir, j), "_body", F.col("_k").isNotNull(), needed)
        d = analysis_texts(joined_document(spark, sf_dir, d, "vbody", needed=needed))
    else:
        d = with_document(spark, sf_dir, j, "_body", "_k", needed)
    d = _filing_docs(d, "_").withColumn("raw", F.when(F.col("_k").isNotNull(), F.col("raw")))
    return d.select(*rows.columns, *(ANALYSIS_TEXTS if analysis else ()), "raw")


def _filing_docs(j: DataFrame, at: str = "") -> DataFrame:
    """``raw``, the text of a filing with its document; ``at`` begins the names of the columns it is made of."""
    k = F.col(at + "k")
    custkey, c_name, body = F.col(at + "custkey"), F.col(at + "c_name"), F.col(at + "body")
    tick = letters(custkey)
    n = (k % 900 + 1).cast("string")
    l3 = _pick(k, 5, [F.concat(F.lit("Trading Symbol: "), tick),
                      F.concat(F.lit("(NASDAQ: "), tick, F.lit(")")),
                      F.lit("Trading Symbol:"),
                      F.concat(F.lit("Trading" + NBSP + "Symbol:" + NBSP), tick)])
    l4 = _pick(k, 3, [F.lit("Item 1.01 Entry into a Material Definitive Agreement"),
                      F.lit("Item 5.02 Departure of Directors"),
                      F.lit("ITEM" + NBSP + "1.01 Entry")])
    l5 = _pick(k, len(KEYWORD_SENTENCES) + 1, [F.lit(s) for s in KEYWORD_SENTENCES])
    l6 = _pick(k, len(MONEY_SENTENCES) + 1, [F.concat(*[x for part in s.split("{n}") for x in (F.lit(part), n)][:-1])
                      for s in MONEY_SENTENCES])
    raw = F.concat_ws("\n", F.lit("<SEC-HEADER>"),
                      F.concat(F.lit("COMPANY CONFORMED NAME:   "), F.upper(c_name)),
                      l3, l4, l5, l6, body, F.lit("Item 9.01 Exhibits"), F.lit("SIGNATURES"))
    return j.withColumn("raw", F.when(k % 29 == 0, F.lit("")).otherwise(raw))


# The texts of the analysis, which hold whole documents.
ANALYSIS_TEXTS = ("reasoning", "analyst_verdict")


def analysis_texts(rows: DataFrame) -> DataFrame:
    """``rows`` (by ``k``) with the texts of the analysis, made of their documents ``vbody``."""
    k, body = _k(), F.coalesce(F.col("vbody"), F.lit(""))
    verdict_sfx = F.when(k % 11 == 0, F.lit(" $5,000")).when(k % 11 == 1, F.lit(" 12.5%")).otherwise(F.lit(""))
    return (rows.withColumn("reasoning", F.concat(F.lit("Reasoning for filing "), k.cast("string"), F.lit(". "), body))
            .withColumn("analyst_verdict", F.concat(body, verdict_sfx)).drop("vbody"))


def with_analysis_texts(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """What ``analysis_fx`` leaves out without its texts, for rows made of it."""
    return analysis_texts(with_document(spark, sf_dir, rows, "vbody"))


def analysis_fx(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """Scorer output per filing (the shape of the model's JSON answer); without ``texts`` those follow by
    ``with_analysis_texts``, for rows that go through shuffles first."""
    j = filings_fx(spark, sf_dir)
    if texts:
        j = analysis_texts(with_document(spark, sf_dir, j, "vbody"))
    n_cust = table(spark, sf_dir, "customer").count()      # from the footers
    k = _k()
    ck = F.col("custkey")
    filer = F.when(ck % 11 != 0, letters(ck))

    def arr(n_mod, prefix):
        return F.transform(F.array_repeat(F.lit(0), (k % n_mod).cast("int")),
                           lambda x, i: F.concat(F.lit(prefix), (i + 1).cast("string"),
                                                 F.lit(" of filing "), k.cast("string")))

    return j.select(
        k, F.col("accession_true").alias("accession"), filer.alias("filer_ticker"),
        F.when(k % 37 != 0, (k % 10 + 1).cast("double")).alias("impact_score"),
        ((k * 3) % 10 + 1).cast("double").alias("confidence"),
        _pick(k, 3, [F.lit("target"), F.lit("acquirer"), F.lit("unknown")]).alias("filer_role"),
        (k % 2 == 0).alias("is_full_acquisition"),
        (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("all-cash"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit("all-stock"))
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("mixed"))
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("undisclosed"))
         .otherwise(F.lit(""))).alias("deal_structure"),
        _pick(k, 4, [F.lit("acquisition"), F.lit("merger"), F.lit("partnership"), F.lit("contract")]).alias("deal_type"),
        (F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 10 == 0, filer)
         .otherwise(letters((ck * 31 + 7) % n_cust))).alias("target_ticker"),
        (F.when(k % 8 == 0, F.lit(None).cast("string")).when(k % 10 == 5, filer)
         .otherwise(letters((ck * 17 + 3) % n_cust))).alias("acquirer_ticker"),
        F.when(k % 6 != 0, F.col("o_totalprice") / 1000).alias("offer_price_per_share"),
        F.when(k % 9 != 0, F.col("o_totalprice") * 1000).alias("deal_value_usd"),
        F.when(k % 5 != 0, ((k % 120) - 10).cast("double")).alias("premium_pct"),
        F.when(k % 4 != 3, F.concat(F.lit("TARGET CO "), k.cast("string"))).alias("target_company"),
        F.concat(F.lit("BUYER "), (k % 97).cast("string")).alias("acquirer"),
        _pick(k, 5, [F.concat(F.lit("$"), F.col("o_totalprice").cast("bigint").cast("string"), F.lit("K")),
                     F.lit("undisclosed"), F.lit(None).cast("string"), F.lit(""), F.lit("None")]).alias("deal_value"),
        F.when(k % 3 == 0, F.lit("regex_confirmed")).otherwise(F.lit("document_only")).alias("deal_value_source"),
        _pick(k, 4, [F.lit("high"), F.lit("medium"), F.lit("low"), F.lit("none")]).alias("short_squeeze_risk"),
        arr(6, "point ").alias("key_points"), arr(4, "risk ").alias("risks"), arr(5, "peer ").alias("sympathy_plays"),
        (k % 13 == 0).alias("leak_detected"), F.concat(F.lit("Deal headline "), k.cast("string")).alias("alert_headline"),
        F.col("published_raw"), F.col("title"), F.col("link"), *(ANALYSIS_TEXTS if texts else ()))
