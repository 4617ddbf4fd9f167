"""Landed inputs and state tables derived from the whole test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions.text import content_hash

RUN_1 = 1_700_000_000
RUN_2 = RUN_1 + 8 * 86_400  # late enough for the purge to reach what only run 1 saw

# Job titles, location and commitment texts; a row takes one of each and fills it in.
TITLES = (
    "Senior {} Engineer", "{} Intern", "Internal {} Auditor", "Entry Level {}", "New Grad {}",
    "Jr. {}", "Junior {}", "{} jr dev", "{} Midwest Sales", "Sr. {} Director", "{} sr dev",
    "Staff {}", "Principal {}", "Lead {}", "Director of {}", "VP {}", "VP, {}",
    "Vice President {}", "Head of {}", "{}")
LOCATIONS = (
    "{}, CA", "{}, NY, US", "{}, Texas", "US, Remote, {}", "{}, ON, Canada",
    "{}, England, United Kingdom", "{}, INDONESIA, Indonesia", "", "{}, NY (HQ)", "{}, DE",
    "{}, BC, CA", "{}, NL", "New York", "ON", "{}, FR", "Remote - {}", "(Remote) {}",
    "Hybrid, {}, TX", "{}, GB", "{}, Greene, MO", "{}, Greene, Missouri", "  {} , , usa ",
    "{} (a), (b), wa", "QC, Canada")
COMMITMENTS = (
    "Full Time", "FullTime", "PartTime", "parttime", "Intern", "Contract", "permanent",
    "Temporary", "temporary", "CO-OP", "Part-time", "contractor", "")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def filled(templates: tuple[str, ...], index: Column, word: Column) -> Column:
    """The template at index (modulo their number) with word in its gap."""
    chosen = F.element_at(F.array(*map(F.lit, templates)),
                          (index % len(templates) + 1).cast("int"))
    return F.replace(chosen, F.lit("{}"), word)


def epoch(ts: Column) -> Column:
    """Seconds since 1970 at the start of the day, whatever the session time zone."""
    return F.unix_date(ts.cast("date")).cast("bigint") * 86_400


# --- pages ----------------------------------------------------------------------------


def board_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Each page's URL as a board URL: its host label becomes the company slug."""
    url = F.col("url")
    host = r"^(https?)://(.+?)\.example\.(com|net|org)/(.*)$"
    parts = table(spark, folder, "pages").select(
        "page_id", "url", F.regexp_extract(url, host, 1).alias("scheme"),
        F.regexp_extract(url, host, 2).alias("label"),
        F.regexp_extract(url, host, 3).alias("family"),
        F.regexp_extract(url, host, 4).alias("rest"))
    board = (F.when(F.col("family") == "com", "jobs.lever.co")
             .when(F.col("family") == "net", "job-boards.greenhouse.io")
             .otherwise("jobs.ashbyhq.com"))
    slug = F.when(F.col("rest").contains("?"), F.upper("label")).otherwise(F.col("label"))
    ats = (F.when(F.col("family") == "com", "lever").when(F.col("family") == "net", "greenhouse")
           .otherwise("ashby"))
    return parts.select(
        "page_id", "url", "scheme", "label", "rest", ats.alias("ats"),
        F.concat("scheme", F.lit("://"), board, F.lit("/"), slug, F.lit("/"), "rest")
        .alias("board_url"))


def page_slugs(spark: SparkSession, folder: str, scheme: str) -> DataFrame:
    """(ats, slug) of the pages of one URL scheme; repeated as often as pages do."""
    return board_urls(spark, folder).where(F.col("scheme") == scheme).select(
        "ats", F.col("label").alias("slug"))


def index_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Block index lines keyed by the reversed host; two blocks share an offset."""
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    path = F.regexp_extract("url", "^https?://[^/]+(.*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)
    shard = F.concat(F.lit("cdx-"), F.lpad((F.col("page_id") / 64).cast("bigint").cast("string"),
                                           5, "0"), F.lit(".gz"))
    offset = (F.col("page_id") / 2).cast("bigint") * 1000
    # Lines of URLs with a fragment end early, as an index cut short would.
    short = F.concat_ws("\t", F.concat(key, F.lit(" 20260101000000")), shard, offset)
    line = F.when(F.col("url").contains("#"), short).otherwise(
        F.concat_ws("\t", short, F.col("page_id") + 100, F.col("page_id")))
    return table(spark, folder, "pages").select(line.alias("line"))


def index_records(spark: SparkSession, folder: str) -> DataFrame:
    """URL index records of the board URLs."""
    return board_urls(spark, folder).select(F.concat(
        F.lit("key 20260101000000 {\"url\": \""), "board_url", F.lit("\"}")).alias("line"))


def block_records(spark: SparkSession, folder: str) -> DataFrame:
    """The same records with the block (shard, offset) that their page's index line names."""
    shard = F.concat(F.lit("cdx-"), F.lpad((F.col("page_id") / 64).cast("bigint").cast("string"), 5, "0"),
                     F.lit(".gz"))
    return board_urls(spark, folder).select(
        shard.alias("shard"), ((F.col("page_id") / 2).cast("bigint") * 1000).alias("offset"),
        F.concat(F.lit("key 20260101000000 {\"url\": \""), "board_url", F.lit("\"}")).alias("line"))


def aggregator_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Postings of an aggregator: every page is a hit of the company its host names."""
    return board_urls(spark, folder).select(
        F.col("label").alias("company_id"), F.initcap("label").alias("company_name"),
        F.col("page_id").cast("string").alias("posting_id"),
        F.length("url").alias("hit_rank"))


def redirects(spark: SparkSession, folder: str) -> DataFrame:
    return board_urls(spark, folder).select(
        F.col("page_id").cast("string").alias("posting_id"), F.col("board_url").alias("final_url"))


# --- events as probe attempts ----------------------------------------------------------


def event_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as probe attempts: the user and k name the board, the type the answer."""
    k = F.get_json_object("props", "$.k").cast("int")
    ats = F.element_at(F.array(F.lit("lever"), F.lit("greenhouse"), F.lit("ashby")),
                       (F.col("user_id") % 3 + 1).cast("int"))
    kind = F.col("event_type")
    job = F.concat(F.lit('{"id":"e'), F.col("event_id").cast("string"), F.lit('"'),
                   F.when(kind == "view", F.lit(',"isListed":false}')).otherwise(F.lit("}")))
    jobs = F.concat(F.lit("["), F.when(kind != "click", job).otherwise(F.lit("")), F.lit("]"))
    wrapped = F.concat(F.lit('{"jobs":'), jobs, F.lit("}"))
    listing = F.when(F.col("ats") == "lever", jobs).otherwise(wrapped)
    body = (F.when(F.col("value") < 1, F.lit("<html>busy</html>"))
            .when((kind == "view") & (F.col("value") < 4), F.lit('{"ok":false}'))
            .otherwise(listing))
    status = F.when(kind == "error", 503).when(kind == "signup", 404).otherwise(200)
    return table(spark, folder, "events").select(
        "event_id", "event_type", "value", ats.alias("ats"),
        F.concat_ws("-", "user_id", F.floor(k / 4)).alias("slug"),
        (k % 4).alias("attempt")).select(
        "event_id", "ats", "slug", "attempt", status.alias("status_code"), body.alias("body"))


# --- documents as boards ---------------------------------------------------------------


def lever_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as a one-posting lever board."""
    lang, doc = F.col("lang"), F.col("doc_id")
    content = F.concat(F.lit("<ul><li>"), lang, F.lit("</li><li>a &amp; b</li></ul>"))
    posting = F.struct(
        doc.cast("string").alias("id"),
        filled(TITLES, doc, F.col("source")).alias("text"),
        F.struct(filled(COMMITMENTS, doc, F.lit("")).alias("commitment"),
                 F.col("source").alias("department"),
                 F.when(lang == "en", "").otherwise(lang).alias("team"),
                 filled(LOCATIONS, doc, F.col("source")).alias("location")).alias("categories"),
        F.when(lang == "fr", lang).alias("country"),
        F.when(lang == "de", "remote").otherwise("onsite").alias("workplaceType"),
        F.col("text").alias("descriptionPlain"),
        F.array(F.struct(F.col("source").alias("text"), content.alias("content"))).alias("lists"),
        F.lit(" \n").alias("additionalPlain"),
        F.struct(F.col("n_chars").alias("min"), (F.col("n_chars") * 1.5).alias("max"))
        .alias("salaryRange"),
        F.when(lang != "en", F.concat(F.lit("https://apply/"), doc.cast("string")))
        .alias("applyUrl"))
    return _landed(table(spark, folder, "documents"), "lever", F.col("source"),
                   F.to_json(F.array(posting)))


def greenhouse_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Each page as a one-job greenhouse board; the job text is the page's HTML."""
    page = F.col("page_id")
    name = F.concat(F.lit("office "), F.when(page % 5 == 0, "REMOTE").otherwise("main"))
    job = F.struct(
        (page + 8_000_000_000).alias("id"), filled(TITLES, page, F.lit("Data")).alias("title"),
        F.when(page % 2 == 0, F.concat(F.lit("Co "), page.cast("string"))).alias("company_name"),
        F.when(page % 3 == 0, F.col("url")).alias("absolute_url"),
        F.col("html").alias("content"),
        F.struct(filled(LOCATIONS, page, F.lit("Lund")).alias("name")).alias("location"),
        F.when(page % 4 != 0, F.array(F.struct(F.lit("Eng").alias("name")),
                                      F.struct(F.lit("Ops").alias("name"))))
        .alias("departments"),
        F.array(F.struct(name.alias("name"))).alias("offices"))
    return _landed(table(spark, folder, "pages"), "greenhouse",
                   F.concat(F.lit("p"), page.cast("string")),
                   F.to_json(F.struct(F.array(job).alias("jobs"))))


def ashby_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as an ashby board of one job; Spanish ones are unlisted.

    Every seventh board has a second job, without a plain description.
    """
    lang, doc = F.col("lang"), F.col("doc_id")
    address = F.struct(F.struct(
        F.concat(F.lit("Town "), F.col("source")).alias("addressLocality"),
        F.lit("Region").alias("addressRegion"),
        F.when(lang == "en", "USA").when(lang == "fr", "Canada").when(lang == "de", "de")
        .otherwise("Spain").alias("addressCountry")).alias("postalAddress"))
    salary = F.array(
        F.struct(F.lit("Equity").alias("compensationType"), F.lit(1.0).alias("minValue"),
                 F.lit(2.0).alias("maxValue")),
        F.struct(F.lit("Salary").alias("compensationType"),
                 F.col("n_chars").cast("double").alias("minValue"),
                 F.lit(None).cast("double").alias("maxValue")))
    job = lambda job_id, text: F.struct(
        job_id.alias("id"),
        F.concat(F.lit(" "), filled(TITLES, doc, F.col("source")), F.lit("\t")).alias("title"),
        filled(LOCATIONS, doc, F.col("source")).alias("location"),
        F.when(lang == "en", "").otherwise(lang).alias("department"),
        F.col("source").alias("team"),
        filled(COMMITMENTS, doc, F.lit("")).alias("employmentType"),
        F.when(lang == "de", "Remote").otherwise("remote").alias("workplaceType"),
        (lang == "fr").alias("isRemote"),
        F.when(lang == "es", F.lit(False)).alias("isListed"),
        text.alias("descriptionPlain"),
        F.concat(F.lit("<p>"), lang, F.lit("<br>&copy; "), F.col("source"), F.lit("</p>"))
        .alias("descriptionHtml"),
        address.alias("address"), F.struct(salary.alias("summaryComponents")).alias("compensation"))
    key = doc.cast("string")
    one = job(key, F.col("text"))
    bare = job(F.concat(F.lit("n"), key), F.lit(None).cast("string"))
    jobs = F.when(doc % 7 == 3, F.array(one, bare)).otherwise(F.array(one))
    return _landed(table(spark, folder, "documents"), "ashby", F.col("source"),
                   F.to_json(F.struct(jobs.alias("jobs"))))


def _landed(rows: DataFrame, ats: str, slug: Column, body: Column) -> DataFrame:
    return rows.select(F.lit(ats).alias("ats"), slug.alias("slug"), F.lit(0).alias("attempt"),
                       F.lit(200).alias("status_code"), body.alias("body"))


def run_attempts(spark: SparkSession, folder: str, second: bool) -> DataFrame:
    """Probe attempts of two successive runs over all documents, one board per document.

    The language tells the system. Run 1 does not know the Spanish boards; in run 2 the
    boards labelled as low quality are gone. Toxic ones answer at the second attempt only.
    Every third document repeats its posting under another title and without text.
    """
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    docs = docs.select(
        "*", F.concat_ws("-", "source", "doc_id").alias("slug"),
        F.when(F.col("lang") == "en", "lever").when(F.col("lang") == "fr", "greenhouse")
        .otherwise("ashby").alias("ats"),
        F.explode(F.when(F.col("toxic") == 1, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("attempt"))
    if not second:
        docs = docs.where(F.col("lang") != "es")
    text = F.col("text")
    place = (F.when(F.col("lang") == "en", "Austin, Texas").when(F.col("lang") == "fr", "Paris, FR")
             .when(F.col("lang") == "de", "Berlin, Germany (Remote)").otherwise("Madrid, ES"))

    def postings(one) -> Column:
        first = one(F.concat(F.lit("Engineer "), F.col("source")), text)
        again = one(F.concat(F.lit("Lead "), F.col("source")), F.lit(None).cast("string"))
        return F.when(F.col("doc_id") % 3 == 0, F.array(first, again)).otherwise(F.array(first))

    doc = F.col("doc_id").cast("string").alias("id")
    lever = F.to_json(postings(lambda title, t: F.struct(
        doc, title.alias("text"), t.alias("descriptionPlain"),
        F.struct(place.alias("location")).alias("categories"))))

    def escaped(t: Column) -> Column:
        return F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    greenhouse = F.to_json(F.struct(postings(lambda title, t: F.struct(
        F.col("doc_id").alias("id"), title.alias("title"), escaped(t).alias("content"),
        F.struct(place.alias("name")).alias("location"),
        F.concat(F.lit("Company "), F.col("source")).alias("company_name"))).alias("jobs")))
    ashby = F.to_json(F.struct(postings(lambda title, t: F.struct(
        doc, title.alias("title"), t.alias("descriptionPlain"), place.alias("location")))
        .alias("jobs")))
    body = (F.when(F.col("ats") == "lever", lever).when(F.col("ats") == "greenhouse", greenhouse)
            .otherwise(ashby))
    status = F.when((F.col("toxic") == 1) & (F.col("attempt") == 0), 503).otherwise(200)
    if second:
        status = F.when(F.col("quality") == 0, 404).otherwise(status)
    return docs.select("ats", "slug", "attempt", status.alias("status_code"),
                       F.when(status == 200, body).alias("body"))


# --- orders, lineitem, customer as state and batches -------------------------------------


def order_state(spark: SparkSession, folder: str, every: bool = False) -> DataFrame:
    """Stored jobs: the orders that are open or finished, or all; open ones were hashed with a text.

    For the merges, orders in neither status are what the batch brings anew.
    """
    title, company = F.col("o_orderstatus"), F.lit("orders")
    text = F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
    orders = table(spark, folder, "orders")
    if not every:
        orders = orders.where(F.col("o_orderstatus").isin("O", "F"))
    return schemas.JOBS.conform(orders.select(
        F.concat(F.lit("lever:"), F.col("o_orderkey").cast("string")).alias("job_id"),
        F.lit("lever").alias("ats"), F.lit("lever:orders").alias("company_id"),
        F.col("o_orderkey").cast("string").alias("ats_job_id"), title.alias("title"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("company_name"),
        text.alias("description_text"), F.lit("").alias("location_raw"),
        F.lit("stored").alias("department"), F.col("o_totalprice").alias("min_salary"),
        F.lit("url").alias("apply_url"), epoch(F.col("o_orderdate")).alias("first_seen_at"),
        epoch(F.col("o_orderdate")).alias("last_seen_at"),
        content_hash(title, company, F.lit(""), text).alias("content_hash")))


def line_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of job rows that repeats ids: the line items, in line order."""
    title, text = F.col("l_linestatus"), F.when(F.col("l_returnflag") != "N", F.concat_ws(
        " ", "l_returnflag", F.col("l_partkey").cast("string")))
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("lever:"), F.col("l_orderkey").cast("string")).alias("job_id"),
        F.lit("lever").alias("ats"), F.lit("lever:orders").alias("company_id"),
        F.col("l_orderkey").cast("string").alias("ats_job_id"), title.alias("title"),
        F.lit("Lines").alias("company_name"), text.alias("description_text"),
        F.lit("").alias("location_raw"), F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"), F.lit(None).cast("string").alias("country"),
        F.lit(0).alias("is_remote"), F.col("l_suppkey").cast("string").alias("department"),
        F.lit("full-time").alias("employment_type"), F.lit("unknown").alias("experience_level"),
        F.col("l_quantity").alias("min_salary"), F.col("l_extendedprice").alias("max_salary"),
        F.lit("url").alias("apply_url"), F.lit(RUN_1).cast("bigint").alias("now"),
        content_hash(title, F.lit("orders"), F.lit(""), text).alias("content_hash"),
        F.col("l_linenumber").alias("pos"), "l_extendedprice", "l_partkey", "l_suppkey")


LINE_ORDER = ("pos", "l_extendedprice", "l_partkey", "l_suppkey")


def customer_state(spark: SparkSession, folder: str) -> DataFrame:
    """Stored companies: customers with a positive balance; one segment is marked dead."""
    known = table(spark, folder, "customer").where(F.col("c_acctbal") > 0)
    return schemas.COMPANIES.conform(known.select(
        *_company_key(),
        F.when(F.col("c_nationkey") != 3, F.col("c_name")).alias("name"),
        F.lit(RUN_1).alias("last_probed_at"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("is_dead")))


def customer_probes(spark: SparkSession, folder: str) -> DataFrame:
    """A run over all customers: furniture is dead, households answer without a name."""
    name = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.lower("c_name"))
    return table(spark, folder, "customer").select(
        *_company_key(), name.alias("name"), F.lit(RUN_2).cast("bigint").alias("last_probed_at"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "dead").otherwise("alive").alias("outcome"))


def _company_key() -> list[Column]:
    slug = F.col("c_custkey").cast("string")
    return [F.concat(F.lit("lever:"), slug).alias("company_id"), slug.alias("slug"),
            F.lit("lever").alias("ats")]


def order_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs named after their customer; orders without priority name no company."""
    name = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED",
                  F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
    return table(spark, folder, "orders").select("o_orderkey", name.alias("company_name"),
                                                 "o_orderstatus")


def external_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Another source's counts: the open orders; lookups of furniture customers failed."""
    found = order_jobs(spark, folder).where(
        (F.col("o_orderstatus") == "O") & F.col("company_name").isNotNull()
    ).groupBy("company_name").agg(F.count("*").alias("job_count"))
    customers = table(spark, folder, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("company_name"),
        (F.col("c_mktsegment") == "FURNITURE").alias("failed"))
    return customers.join(found, "company_name", "left").where(
        F.col("failed") | F.col("job_count").isNotNull()).select(
        "company_name", "job_count", "failed")
