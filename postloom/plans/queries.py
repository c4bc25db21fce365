"""Queries of the core operators over the supplied tables, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import boards, extract, predicates, scoring, urls, vocab
from postloom.functions import text as tx
from postloom.operators import curate, dedup, enrich, layout, logos, quality
from postloom.operators.lists import explode_packed
from postloom.plans import sql as q
from postloom.plans.registry import AS_OF, QUERIES, SQL, query
from postloom.session import read_table
from postloom.sources import sinks
from postloom.streaming import streams

FLAGSHIP = "prune_buckets"
LEAST_SCORE = 5


# One regex token per value: a quoted value, or a run without separators in which
# a slash is ordinary unless white space stands on both sides of it.
P2_SQL = r"""
WITH cells AS (
  SELECT row_id, 'keywords' AS field_name, keywords AS v FROM upload_rows
  UNION ALL SELECT row_id, 'skills', skills FROM upload_rows
), bare AS (
  SELECT row_id, field_name, regexp_replace(regexp_replace(v, '^\s+|\s+$', '', 'g'), '^\[(.*)\]$', '\1', 's') AS v FROM cells WHERE v IS NOT NULL
), pieces AS (
  SELECT row_id, field_name, regexp_extract_all(v, '\s*"(?:[^"]|"")*"\s*|(?:[^,;|•、\t\n\r/]|[^\s,;|•、]/|/[^\s])+') AS a FROM bare
), items AS (
  SELECT row_id, field_name, unnest(a) AS raw, generate_subscripts(a, 1) AS n FROM pieces
), clean AS (
  SELECT row_id, field_name, n, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS t FROM items
), named AS (
  SELECT row_id, field_name, n, CASE WHEN t LIKE '"%"' AND length(t) > 1 THEN regexp_replace(replace(substr(t, 2, length(t) - 2), '""', '"'), '^\s+|\s+$', '', 'g') ELSE t END AS item FROM clean
)
SELECT row_id, field_name, CAST(row_number() OVER (PARTITION BY row_id, field_name ORDER BY n) AS INTEGER) AS pos, item FROM named WHERE item <> ''
"""


@query(P2_SQL)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of keywords and skills with its place in the list."""
    return explode_packed(read_table(spark, sf_dir, "upload_rows"), ["row_id"], ["keywords", "skills"])


# ---- addresses ------------------------------------------------------------


@query(f"SELECT row_id, {q.canonical('job_link')} AS url FROM upload_rows WHERE job_link IS NOT NULL")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "upload_rows").filter("job_link is not null")
    return rows.select("row_id", urls.canonical(F.col("job_link")).alias("url"))


@query(f"""
SELECT min(row_id) AS row_id, k AS url_key, count(*) AS copies
FROM (SELECT row_id, {q.dedup_key('job_link')} AS k FROM upload_rows WHERE job_link IS NOT NULL) GROUP BY k
""")
def url_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each address without query; queries carry the number on some boards, so those collapse."""
    rows = read_table(spark, sf_dir, "upload_rows").filter("job_link is not null").withColumn("url_key", urls.dedup_key(F.col("job_link")))
    return rows.groupBy("url_key").agg(F.min("row_id").alias("row_id"), F.count("*").alias("copies"))


@query(f"""
SELECT row_id, {q.host('job_link')} AS host, {q.path('job_link')} AS path, {q.query('job_link')} AS params,
  regexp_replace({q.host('job_link')}, '^www\\.', '') AS bare_host,
  coalesce(regexp_matches({q.path('job_link')}, '/[0-9]{{5,}}(?:/|$)'), false)
    OR coalesce(len(list_filter(string_split({q.query('job_link')}, '&'), lambda p: regexp_matches(p, '(?i)^(?:{vocab.ID_PARAM})=.*\\S'))) > 0, false) AS has_id,
  coalesce(lower(regexp_replace({q.path('job_link')}, '/+$', '')) IN ({q.names(vocab.LISTING_PATHS)}), false) AS is_listing
FROM upload_rows
""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and signals of each posting's address."""
    link = F.col("job_link")
    return read_table(spark, sf_dir, "upload_rows").select(
        "row_id", urls.host(link).alias("host"), urls.path(link).alias("path"), urls.query(link).alias("params"),
        F.regexp_replace(urls.host(link), r"^www\.", "").alias("bare_host"), urls.has_id_signal(link).alias("has_id"), urls.is_listing(link).alias("is_listing"),
    )


@query(f"""
WITH h AS (SELECT DISTINCT {q.host('job_link')} AS host FROM upload_rows), l AS (SELECT host, string_split(host, '.') AS a FROM h WHERE host IS NOT NULL)
SELECT host,
  CASE WHEN len(a) <= 2 THEN host
       WHEN regexp_matches(a[len(a)], '^[a-z]{{2}}$') AND a[len(a)-1] IN ('co','com','org','net','gov','ac','edu') THEN array_to_string(a[len(a)-2:len(a)], '.')
       ELSE array_to_string(a[len(a)-1:len(a)], '.') END AS base_domain,
  CASE WHEN len(a) > 2 AND a[1] IN ({q.names(urls.CAREER_LABELS)}) THEN array_to_string(a[2:len(a)], '.') ELSE host END AS company_host
FROM l
""")
def host_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base domain and company host of each distinct host."""
    hosts = read_table(spark, sf_dir, "upload_rows").select(urls.host(F.col("job_link")).alias("host")).filter("host is not null").distinct()
    return hosts.select("host", urls.base_domain(F.col("host")).alias("base_domain"), urls.strip_career_label(F.col("host")).alias("company_host"))


@query(f"""
WITH found AS (SELECT DISTINCT {q.host('job_link')} || '/' || coalesce({q.segments('job_link')}[1], '') AS k, lower(coalesce({q.segments('job_link')}[1], '')) AS slug FROM upload_rows WHERE batch_no > 0 AND {q.is_url('job_link')}),
known AS (SELECT DISTINCT lower({q.host('job_link')} || '/' || coalesce({q.segments('job_link')}[1], '')) AS k FROM upload_rows WHERE batch_no = 0 AND {q.is_url('job_link')})
SELECT DISTINCT lower(k) AS slug_key FROM found WHERE lower(k) NOT IN (SELECT k FROM known)
  AND NOT (slug = '' OR length(slug) < 2 OR slug IN ({q.names(vocab.JUNK_SLUGS)}) OR regexp_matches(slug, '^[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}$|^[0-9]+$|\\.[a-z]{{2,5}}$'))
""")
def new_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host and tenant pairs of the new batches that history does not know."""
    rows = read_table(spark, sf_dir, "upload_rows").filter(urls.is_url(F.col("job_link")))
    keyed = rows.select("batch_no", urls.host_slug(F.col("job_link")).alias("slug_key"), F.coalesce(F.get(urls.segments(F.col("job_link")), F.lit(0)), F.lit("")).alias("slug"))
    found = keyed.filter((F.col("batch_no") > 0) & ~urls.is_junk_slug(F.col("slug"))).select("slug_key").distinct()
    return curate.unseen(found, keyed.filter("batch_no = 0"), key="slug_key")


@query(f"""
SELECT raw_id, scraped_at, CASE WHEN regexp_matches({q.trim('url')}, '{q.ABSOLUTE}') THEN {q.trim('url')}
  WHEN {q.trim('url')} = '' OR NOT {q.is_url('source_url')} THEN NULL
  WHEN starts_with({q.trim('url')}, '/') THEN {q.origin('source_url')} || {q.trim('url')}
  ELSE regexp_replace({q.origin('source_url')} || {q.path('source_url')}, '[^/]*$', '') || replace({q.trim('url')}, ' ', '%20') END AS url
FROM raw_jobs
""")
def absolute_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped addresses resolved against the page they stood on."""
    return read_table(spark, sf_dir, "raw_jobs").select("raw_id", "scraped_at", urls.absolute(F.col("url"), F.col("source_url")).alias("url"))


# ---- normalising and deduplicating ------------------------------------------


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped rows with clean title, absolute address and open fields filled; rows without either are gone."""
    raw = read_table(spark, sf_dir, "raw_jobs")
    return (
        raw.withColumns(
            {
                "title": tx.collapse(F.col("title")),
                "url": urls.absolute(tx.collapse(F.col("url")), F.col("source_url")),
                "location": F.coalesce(F.nullif(tx.collapse(F.col("location_text")), F.lit("")), F.lit("Not specified")),
                "company": F.coalesce(F.nullif(tx.collapse(F.col("company")), F.lit("")), urls.company_from_host(F.col("source_url"))),
                "ats": F.coalesce("ats", F.lit("generic")),
            }
        )
        .filter("title <> '' and url <> ''")
        .drop("location_text")
    )


def _norm_sql() -> str:
    url = q.collapse("url")
    absolute = f"""CASE WHEN regexp_matches({url}, '{q.ABSOLUTE}') THEN {url} WHEN {url} = '' OR NOT {q.is_url('source_url')} THEN NULL
      WHEN starts_with({url}, '/') THEN {q.origin('source_url')} || {url} ELSE regexp_replace({q.origin('source_url')} || {q.path('source_url')}, '[^/]*$', '') || replace({url}, ' ', '%20') END"""
    return f"""SELECT raw_id, scraped_at, source_url, {q.collapse('title')} AS title, {absolute} AS url, coalesce(nullif({q.collapse('location_text')}, ''), 'Not specified') AS location,
      coalesce(nullif({q.collapse('company')}, ''), split_part(regexp_replace({q.host('source_url')}, '^www\\.', ''), '.', 1), 'unknown') AS company, coalesce(ats, 'generic') AS ats FROM raw_jobs"""


@query(f"""
WITH n AS ({_norm_sql()}), k AS (SELECT *, row_number() OVER (PARTITION BY source_url, lower(title), lower(url) ORDER BY raw_id, coalesce(scraped_at, TIMESTAMP '1970-01-01')) AS rn FROM n WHERE title <> '' AND url <> '')
SELECT raw_id, title, url, location, company, ats FROM k WHERE rn = 1
""")
def normalize_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised rows, the first of each title and address within a source."""
    jobs = normalised(spark, sf_dir)
    order = [F.col("raw_id"), F.coalesce("scraped_at", F.lit("1970-01-01").cast("timestamp_ntz"))]
    return dedup.keep_best(jobs, [F.col("source_url"), F.lower("title"), F.lower("url")], order).select("raw_id", "title", "url", "location", "company", "ats")


@query(f"""
WITH c AS (SELECT row_id, {q.canonical('job_link')} AS url, title FROM upload_rows WHERE job_link IS NOT NULL AND title IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY lower(url), lower(title) ORDER BY row_id) AS rn FROM c) SELECT row_id, url, title FROM k WHERE rn = 1
""")
def dedup_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each canonical address and title, the address rewritten."""
    rows = read_table(spark, sf_dir, "upload_rows").filter("job_link is not null and title is not null").select("row_id", urls.canonical(F.col("job_link")).alias("url"), "title")
    return dedup.keep_first(rows, [F.lower("url"), F.lower("title")], F.col("row_id"))


@query(f"""
WITH k AS (SELECT row_id, title, company, {q.priority("coalesce(job_link, '')")} AS prio,
  row_number() OVER (PARTITION BY lower({q.trim('title')}), lower({q.trim('company')}) ORDER BY {q.priority("coalesce(job_link, '')")} DESC, row_id) AS rn
  FROM upload_rows WHERE title IS NOT NULL AND company IS NOT NULL)
SELECT row_id, title, company, prio FROM k WHERE rn = 1
""")
def dedup_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the rows of one title and company, the one with the best address."""
    rows = read_table(spark, sf_dir, "upload_rows").filter("title is not null and company is not null").select("row_id", "title", "company", urls.priority(F.coalesce("job_link", F.lit(""))).alias("prio"))
    return dedup.keep_best(rows, [F.lower(tx.trim(F.col("title"))), F.lower(tx.trim(F.col("company")))], [-F.col("prio"), F.col("row_id")])


@query("""
WITH k AS (SELECT row_id, company, company_website, row_number() OVER (PARTITION BY company ORDER BY row_id) AS rn FROM upload_rows WHERE company IS NOT NULL AND company_website IS NOT NULL)
SELECT company, company_website FROM k WHERE rn = 1
""")
def company_website(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first website that stands beside each company."""
    rows = read_table(spark, sf_dir, "upload_rows").filter("company is not null and company_website is not null")
    return rows.groupBy("company").agg(F.min_by("company_website", "row_id").alias("company_website"))


# ---- predicates -----------------------------------------------------------


@query(f"SELECT raw_id, scraped_at, {q.has('title', vocab.LOOSE_TITLE_TERMS)} AS loose, {q.strict_title(q.trim('title'))} AS strict, {q.text_score(chr(34) + 'title' + chr(34))} AS score FROM raw_jobs WHERE title IS NOT NULL")
def title_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both title filters and the text score of the title."""
    t = F.col("title")
    return read_table(spark, sf_dir, "raw_jobs").filter("title is not null").select("raw_id", "scraped_at", predicates.title_loose(t).alias("loose"), predicates.title_strict(t).alias("strict"), predicates.text_score(t).alias("score"))


_COMBINED = "(coalesce(title, '') || ' ' || coalesce(description, '') || ' ' || coalesce(job_link, ''))"


@query(f"SELECT row_id, {q.text_score(_COMBINED)} AS score, {q.strict_title(q.trim('title'))} AND {q.text_score(_COMBINED)} >= 2 AS passes FROM upload_rows")
def creative_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text score over title, description and address, and the gate."""
    c = [F.col(x) for x in ("title", "description", "job_link")]
    return read_table(spark, sf_dir, "upload_rows").select("row_id", predicates.text_score(predicates.combined(*c)).alias("score"), predicates.gate(*c).alias("passes"))


def _skip_sql(title: str, url: str) -> str:
    listing = f"coalesce(lower(regexp_replace({q.path(url)}, '/+$', '')) IN ({q.names(vocab.LISTING_PATHS)}), false)"
    ident = f"(coalesce(regexp_matches({q.path(url)}, '/[0-9]{{5,}}(?:/|$)'), false) OR coalesce(len(list_filter(string_split({q.query(url)}, '&'), lambda p: regexp_matches(p, '(?i)^(?:{vocab.ID_PARAM})=.*\\S'))) > 0, false))"
    return f"(coalesce(lower({q.trim(title)}) IN ({q.names(vocab.SKIP_TITLES)}), false) OR {q.matches(f'lower({title})', '|'.join(f'(?:{p})' for p in vocab.SKIP_PATTERNS))} OR ({listing} AND NOT {ident}))"


@query(f"SELECT row_id, title, job_link FROM upload_rows WHERE {_skip_sql('title', 'job_link')}")
def prefetch_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows not worth a fetch."""
    return read_table(spark, sf_dir, "upload_rows").filter(predicates.skip_before_fetch(F.col("title"), F.col("job_link"))).select("row_id", "title", "job_link")


def _strict_sql(title: str, url: str) -> str:
    p = f"coalesce(nullif(lower(regexp_replace({q.path(url)}, '/+$', '')), ''), '/')"
    h, qs = q.host(url), f"('?' || lower({q.query(url)}))"
    known = q.matches(h, vocab.KNOWN_HOSTS)
    depth = f"len({q.segments(url)})"
    titled = f"(coalesce(length({q.trim(title)}) BETWEEN 3 AND 180, false) AND NOT {q.matches(f'lower({q.trim(title)})', vocab.NOISE_TITLE)})"
    return f"""coalesce(CASE WHEN NOT {titled} OR NOT {q.is_url(url)} THEN false WHEN {q.matches(p, predicates.LISTING)} THEN false WHEN {q.matches(p, '/jobdetail/')} THEN true
  WHEN {q.matches(qs, '[?&](?:gh_jid|jobid|job_id|job|posting|postingid|requisition|reqid)=')} THEN true WHEN {known} AND {q.matches(p, '/jobs?/')} THEN true
  WHEN {known} AND {q.matches(h, r'jobs\.lever\.co|jobs\.smartrecruiters\.com|ashbyhq\.com')} AND {depth} >= 2 THEN true WHEN {known} AND {q.matches(h, r'myworkdayjobs\.com')} AND {q.matches(p, '/job/|/apply$')} THEN true
  WHEN {q.matches(p, '/jobs?/[^/]*[0-9][^/]*$')} THEN true WHEN {q.matches(p, '/job/[a-z0-9-]{6,}$')} THEN true WHEN {q.matches(p, '/details/[0-9]+')} THEN true
  WHEN {q.has(title, vocab.ROLE_TERMS)} AND {q.matches(p, '/jobs?/|/position/|/opening/|/requisition/')} THEN true ELSE false END, false)"""


def _loose_sql(title: str, url: str) -> str:
    p, h, qs = f"lower({q.path(url)})", q.host(url), f"('?' || lower({q.query(url)}))"
    titled = f"(coalesce(length({q.trim(title)}) BETWEEN 3 AND 180, false) AND NOT {q.matches(f'lower({q.trim(title)})', vocab.NOISE_TITLE)})"
    return f"""coalesce(CASE WHEN NOT {titled} OR NOT {q.has(title, vocab.ROLE_TERMS)} THEN false WHEN NOT {q.is_url(url)} OR lower({q.part(url, 1)}) NOT IN ('http', 'https') THEN false
  WHEN {p} = '/' OR {q.matches(p, r'/(?:privacy|terms|about|contact|news|press|investor|team|teams|locations)' + chr(92) + 'b')} THEN false WHEN {q.matches(p, predicates.LISTING_LOOSE)} THEN false
  WHEN {q.matches(h, vocab.KNOWN_HOSTS)} AND len({q.segments(url)}) >= 2 THEN true WHEN {q.matches(p, '/jobdetail/|/jobs?/[^/]*[0-9]|/job/[a-z0-9-]{6,}|/details/[0-9]+')} THEN true
  WHEN {q.matches(qs, '[?&](?:jobid|job_id|job|posting|requisition|reqid)=')} THEN true WHEN {q.matches(p, 'job|career|position|opening|opportunit|vacanc|requisition')} THEN true ELSE false END, false)"""


@query(f"SELECT row_id, {_strict_sql('title', 'job_link')} AS strict, {_loose_sql('title', 'job_link')} AS loose FROM upload_rows")
def posting_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict and the loose test for a posting."""
    t, u = F.col("title"), F.col("job_link")
    return read_table(spark, sf_dir, "upload_rows").select("row_id", predicates.posting_strict(t, u).alias("strict"), predicates.posting_loose(t, u).alias("loose"))


@query(f"""
WITH t AS (SELECT raw_id, source_url, title, coalesce(ats <> 'generic', false) AS a, {_strict_sql('title', 'url')} AS s, {_loose_sql('title', 'url')} AS l FROM raw_jobs),
g AS (SELECT source_url, bool_or(a) AS any_a, bool_or(s) AS any_s, bool_or(l) AS any_l FROM t GROUP BY source_url)
SELECT raw_id, t.source_url, title FROM t JOIN g USING (source_url) WHERE CASE WHEN any_a THEN true WHEN any_s THEN s WHEN any_l THEN l ELSE true END
""")
def selection_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each source all rows if a board's own reader found some, else the strict postings, else the loose ones, else all rows.

    The flags of a source come from one aggregate that is joined back, so a
    hot source is never held in one task.
    """
    t = read_table(spark, sf_dir, "raw_jobs").select("raw_id", "source_url", "title", F.coalesce(F.col("ats") != "generic", F.lit(False)).alias("a"), predicates.posting_strict(F.col("title"), F.col("url")).alias("s"), predicates.posting_loose(F.col("title"), F.col("url")).alias("l"))
    g = t.groupBy("source_url").agg(F.bool_or("a").alias("any_a"), F.bool_or("s").alias("any_s"), F.bool_or("l").alias("any_l"))
    chosen = F.when(F.col("any_a"), True).when(F.col("any_s"), F.col("s")).when(F.col("any_l"), F.col("l")).otherwise(True)
    return t.join(g, "source_url").filter(chosen).select("raw_id", "source_url", "title")


@query(f"SELECT raw_id, scraped_at, date_posted FROM raw_jobs WHERE date_posted IS NULL OR coalesce(coalesce(try_strptime(date_posted, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(date_posted, '%Y-%m-%d')) >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY, false)")
def recent_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last 30 days or without date; unreadable dates go."""
    cutoff = F.lit(AS_OF).cast("timestamp") - F.expr("interval 30 days")
    return read_table(spark, sf_dir, "raw_jobs").filter(predicates.recent(F.col("date_posted"), cutoff)).select("raw_id", "scraped_at", "date_posted")


@query(f"SELECT row_id, deadline FROM upload_rows WHERE try_strptime(substr({q.trim('deadline')}, 1, 10), '%Y-%m-%d') IS NULL OR try_strptime(substr({q.trim('deadline')}, 1, 10), '%Y-%m-%d') >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY")
def recent_keep_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day-wise form: blank and unreadable days stay."""
    cutoff = F.date_sub(F.lit(AS_OF).cast("date"), 30)
    return read_table(spark, sf_dir, "upload_rows").filter(predicates.recent_day(F.col("deadline"), F.lit(None).cast("string"), cutoff)).select("row_id", "deadline")


@query(f"""
WITH s AS (SELECT row_id, title, job_link, {q.matches(f"lower({q.trim('title')})", '|'.join(vocab.INVALID_TITLES))} AS bad, {q.matches('lower(job_link)', vocab.SPECIFIC_URL)} AS specific,
  list_filter({q.segments('job_link')}, lambda s: NOT regexp_matches(s, '^[0-9]+$') AND length(s) >= 5
    AND length({q.trim("regexp_replace(regexp_replace(s, '^[0-9]+-', ''), '[-_]', ' ', 'g')")}) >= 5 AND regexp_matches(regexp_replace(s, '^[0-9]+-', ''), '[a-z]')) AS good FROM upload_rows WHERE title IS NOT NULL),
f AS (SELECT *, {q.trim("regexp_replace(regexp_replace(good[len(good)], '^[0-9]+-', ''), '[-_]', ' ', 'g')")} AS slug FROM s)
SELECT row_id, CASE WHEN bad THEN array_to_string(list_transform(string_split(slug, ' '), lambda w: upper(w[1:1]) || w[2:]), ' ') ELSE title END AS title, bad AS repaired
FROM f WHERE NOT bad OR (specific AND coalesce(len(good), 0) > 0)
""")
def invalid_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of broken pages replaced from the address where that names a posting, else dropped."""
    rows = read_table(spark, sf_dir, "upload_rows").filter("title is not null")
    bad, fixed = predicates.invalid_title(F.col("title")), urls.title_from_slug(F.col("job_link"))
    kept = rows.withColumn("bad", bad).withColumn("fixed", fixed).filter(~F.col("bad") | (predicates.specific_url(F.col("job_link")) & F.col("fixed").isNotNull()))
    return kept.select("row_id", F.when(F.col("bad"), F.col("fixed")).otherwise(F.col("title")).alias("title"), F.col("bad").alias("repaired"))


@query(f"""
SELECT row_id, coalesce(regexp_matches(description, '<[^>]+>'), false) AS has_html, length(description) AS chars,
  {q.collapse("regexp_replace(description, '<[^>]+>', '', 'g')")} AS plain FROM upload_rows WHERE description IS NOT NULL
""")
def description_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of each description."""
    d = F.col("description")
    rows = read_table(spark, sf_dir, "upload_rows").filter("description is not null")
    return rows.select("row_id", F.coalesce(tx.has_html(d), F.lit(False)).alias("has_html"), F.length(d).alias("chars"), tx.collapse(F.regexp_replace(d, "<[^>]+>", "")).alias("plain"))


@query("SELECT doc_id, coalesce(regexp_matches(substr(text, 1, 5000), '\\x{fffd}|[\\x{0080}-\\x{009f}]|â€[‘’“”–—…™]|Ã[\\x{0080}-\\x{00bf}]|(?:[ÎÏ][\\x{0080}-\\x{00bf}]){3,}'), false) AS flagged FROM documents")
def mojibake_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quick flag of garbled text."""
    return read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce(tx.looks_garbled(F.col("text")), F.lit(False)).alias("flagged"))


# ---- extraction -----------------------------------------------------------


def _system_sql(x: str) -> str:
    def signs(s: str) -> str:
        return " OR ".join(f"contains(lower({x}), {q.text(one)})" for one in s.split("; "))

    return "CASE " + " ".join(f"WHEN {signs(s)} THEN '{name}'" for name, s in vocab.SYSTEM_SIGNS) + " ELSE 'generic' END"


@query(f"SELECT raw_id, scraped_at, {_system_sql('(coalesce(description, chr(10)) || chr(10) || coalesce(source_url, chr(10)) || coalesce(ats, chr(10)))')} AS system FROM raw_jobs")
def system_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hiring system by the first sign in a page and its address."""
    page = F.concat(F.coalesce("description", F.lit("\n")), F.lit("\n"), F.coalesce("source_url", F.lit("\n")), F.coalesce("ats", F.lit("\n")))
    return read_table(spark, sf_dir, "raw_jobs").select("raw_id", "scraped_at", extract.system(page).alias("system"))


_JT = "lower(concat_ws(' ', title, description))"


@query(f"""
SELECT row_id, CASE WHEN {q.matches(_JT, r'\b(?:intern|internship|temporary|fixed[- ]term|contract)\b')} THEN 'GIG' WHEN {q.matches(_JT, r'\bpart[- ]?time\b')} THEN 'PARTTIME'
  WHEN {q.matches(_JT, r'\b(?:freelance|contractor)\b')} THEN 'FREELANCE' ELSE 'FULLTIME' END AS inferred,
  CASE WHEN upper({q.trim('job_type')}) IN ({q.names(list(vocab.JOB_TYPES))}) THEN upper({q.trim('job_type')}) {' '.join(f"WHEN upper({q.trim('job_type')}) = {q.text(k)} THEN '{v}'" for k, v in vocab.JOB_TYPE_MAP.items())} ELSE 'FULLTIME' END AS typed
FROM upload_rows
""")
def job_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job type read from the text, and the typed one made uniform."""
    return read_table(spark, sf_dir, "upload_rows").select("row_id", extract.job_type(F.col("title"), F.col("description")).alias("inferred"), extract.job_type_value(F.col("job_type")).alias("typed"))


_WT = "lower(concat_ws(' ', title, description, formatted_address))"


@query(f"""
SELECT row_id, CASE WHEN {q.has(_WT, ['remote', 'work from home', 'distributed'])} THEN 'REMOTE' WHEN {q.has(_WT, ['hybrid', 'flexible office'])} THEN 'HYBRID'
  WHEN {q.matches(_WT, r'\b(?:on[- ]?site|in office|studio based)\b')} THEN 'ONSITE' END AS inferred,
  CASE WHEN upper({q.trim('work_type')}) IN ('ONSITE','HYBRID','REMOTE') THEN upper({q.trim('work_type')}) WHEN {q.matches('upper(work_type)', r'REMOTE|WORK\s*FROM\s*HOME|TELECOMMUTE')} THEN 'REMOTE'
  WHEN contains(upper(work_type), 'HYBRID') THEN 'HYBRID' WHEN {q.matches('upper(work_type)', r'ON\s*-?\s*SITE|IN\s*OFFICE')} THEN 'ONSITE' ELSE '' END AS typed
FROM upload_rows
""")
def work_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of work read from the text, and the typed one made uniform."""
    return read_table(spark, sf_dir, "upload_rows").select("row_id", extract.work_type(F.col("title"), F.col("description"), F.col("formatted_address")).alias("inferred"), extract.work_type_value(F.col("work_type")).alias("typed"))


@query(f"""
WITH d AS (SELECT row_id, {q.trim('deadline')} AS t FROM upload_rows WHERE deadline IS NOT NULL)
SELECT row_id, {q.date_forms('t')} AS day FROM d
""")
def deadline_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed deadlines as days; forms that name no day give null."""
    return read_table(spark, sf_dir, "upload_rows").filter("deadline is not null").select("row_id", extract.day(F.col("deadline")).alias("day"))


_LOW = "lower(concat_ws(' ', title, description))"


@query(f"SELECT row_id, list_filter([{', '.join(f'CASE WHEN contains({_LOW}, {q.text(t)}) THEN {q.text(t)} END' for t in vocab.KEYWORD_TERMS)}], lambda x: x IS NOT NULL)[1:20] AS keywords FROM upload_rows")
def keyword_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword terms that occur in title or description."""
    return read_table(spark, sf_dir, "upload_rows").select("row_id", extract.keyword_terms(F.col("title"), F.col("description")).alias("keywords"))


@query(f"SELECT row_id, list_filter([{', '.join(f'CASE WHEN {q.has(_LOW, w)} THEN {q.text(n)} END' for n, w in vocab.SKILL_TAXONOMY.items())}], lambda x: x IS NOT NULL) AS skills FROM upload_rows")
def skill_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills of the taxonomy whose words stand in title or description."""
    return read_table(spark, sf_dir, "upload_rows").select("row_id", extract.taxonomy_hits(F.concat_ws(" ", "title", "description")).alias("skills"))


@query()
def skills_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills by taxonomy, phrases and title pieces; the order-sensitive rule is tested against brute force."""
    from postloom.functions.skills import skills_column

    return read_table(spark, sf_dir, "raw_jobs").select("raw_id", "scraped_at", skills_column(F.col("title"), F.col("description")).alias("skills"))


_MAIL = "lower(concat_ws(chr(10), work_email, company_email, description))"


@query(f"""
WITH e AS (SELECT row_id, regexp_extract_all({_MAIL}, '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}') AS a FROM upload_rows)
SELECT row_id, list_filter(a, lambda x: NOT regexp_matches(x, '{vocab.GENERIC_MAILBOX}'))[1] AS email FROM e
""")
def email_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first mail address of a person or hiring desk."""
    return read_table(spark, sf_dir, "upload_rows").select("row_id", extract.email(F.concat_ws("\n", "work_email", "company_email", "description")).alias("email"))


@query()
def location_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed places as city, state and country; tested case by case."""
    loc = extract.location(F.col("location_text"))
    return read_table(spark, sf_dir, "raw_jobs").select("raw_id", "scraped_at", loc.alias("l")).select("raw_id", "scraped_at", "l.*")


@query(r"""
WITH m AS (SELECT row_id, regexp_extract(description, '(?i)([$€£])\s?([0-9]{2,3}(?:,[0-9]{3})*(?:\.[0-9]+)?[kKmM]?)\s*(?:-|to)\s*(?:[$€£])?\s?([0-9]{2,3}(?:,[0-9]{3})*(?:\.[0-9]+)?[kKmM]?)\s*(?:per|/)?\s*(hour|day|week|month|year|annual)?', ['sym','lo','hi','unit']) AS g FROM upload_rows WHERE description IS NOT NULL)
SELECT row_id, g.sym AS symbol, g.lo AS low, g.hi AS high FROM m WHERE g.sym <> ''
""")
def salary_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay ranges as they stand in descriptions."""
    d = F.col("description")
    rows = read_table(spark, sf_dir, "upload_rows").filter("description is not null").select("row_id", *[F.regexp_extract(d, extract.RANGE, k).alias(n) for k, n in ((1, "symbol"), (2, "low"), (3, "high"))])
    return rows.filter("symbol <> ''")


# ---- scores ---------------------------------------------------------------

_BEST = """(SELECT max(greatest(2, least(10, CAST({round} AS INTEGER)))) FROM score_weights w WHERE w.keyword IS NOT NULL AND regexp_matches(lower({text}), '\\b' || regexp_replace(lower(w.keyword), '([.*+?^${{}}()|\\[\\]\\\\])', '\\\\\\1', 'g') || '\\b'))"""


@query(f"SELECT raw_id, scraped_at, coalesce({_BEST.format(round='floor(w.weight + 0.5)', text='r.title')}, 3) AS score FROM raw_jobs r WHERE title IS NOT NULL")
def dict_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary score of the title, halves rounded up."""
    weights = scoring.weights_of(read_table(spark, sf_dir, "score_weights"))
    return read_table(spark, sf_dir, "raw_jobs").filter("title is not null").select("raw_id", "scraped_at", scoring.dictionary_score(F.col("title"), weights).alias("score"))


@query(f"SELECT raw_id, scraped_at, coalesce({_BEST.format(round='round_even(w.weight, 0)', text='(coalesce(r.title, chr(32)) || chr(32) || substr(coalesce(r.description, chr(32)), 1, 200))')}, 3) AS score FROM raw_jobs r")
def dict_score_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary score of title and description's head, halves rounded to even."""
    weights = scoring.weights_of(read_table(spark, sf_dir, "score_weights"))
    text = scoring.scored_text(F.col("title"), F.col("description"))
    return read_table(spark, sf_dir, "raw_jobs").select("raw_id", "scraped_at", scoring.dictionary_score(text, weights, half_even=True).alias("score"))


def _tier_sql(x: str) -> str:
    def one(spec: str) -> str:
        return q.matches(x, "|".join(f"(?:{p})" for p in vocab.tier_patterns(spec)))

    return "CASE " + " ".join(f"WHEN {one(spec)} THEN {value}" for value, spec in vocab.TIERS.items()) + " ELSE 3 END"


@query(f"SELECT {_tier_sql('lower(coalesce(title, chr(32)))')} AS score, count(*) AS jobs FROM raw_jobs GROUP BY 1")
def tier_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per tier score."""
    return read_table(spark, sf_dir, "raw_jobs").select(scoring.tier_score(F.col("title")).alias("score")).groupBy("score").agg(F.count("*").alias("jobs"))


@query("""
WITH p AS (SELECT DISTINCT company, lower(trim(x)) AS tag FROM (SELECT company, unnest(string_split(keywords, ',')) AS x FROM upload_rows WHERE keywords IS NOT NULL AND company IS NOT NULL) WHERE trim(x) <> ''),
t AS (SELECT count(DISTINCT company) AS n FROM p)
SELECT tag, count(*) AS users, round(ln(1 + count(*)) / ln(1 + any_value(t.n)) * 10, 2) AS weight FROM p, t GROUP BY tag HAVING count(*) >= 5
""")
def tag_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags by the number of companies that use them, floor 5, log-smoothed."""
    rows = read_table(spark, sf_dir, "upload_rows").filter("keywords is not null and company is not null")
    tags = rows.select("company", F.explode(F.split("keywords", ",")).alias("x")).filter(F.trim("x") != "").select("company", F.lower(F.trim("x")).alias("tag"))
    return curate.tag_weights(tags, "company", "tag", 5)


@query("""
WITH b AS (SELECT count(DISTINCT company) AS companies, count(DISTINCT city) AS cities FROM upload_rows WHERE batch_no = 0), a AS (SELECT count(DISTINCT company) AS companies, count(DISTINCT city) AS cities FROM upload_rows WHERE batch_no > 0)
SELECT b.companies AS companies_before, b.cities AS cities_before, a.companies AS companies_after, a.cities AS cities_after, a.companies >= b.companies * 0.5 AND a.cities >= b.cities * 0.5 AS accepted FROM a, b
""")
def drift_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the new batches keep at least half of what history had."""
    rows = read_table(spark, sf_dir, "upload_rows")
    out = quality.drift(rows.filter("batch_no = 0"), rows.filter("batch_no > 0"), {"companies": F.countDistinct("company"), "cities": F.countDistinct("city")})
    return out.select("companies_before", "cities_before", "companies_after", "cities_after", "accepted")


# ---- curation -------------------------------------------------------------


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = scoring.weights_of(read_table(spark, sf_dir, "score_weights"))
    results = read_table(spark, sf_dir, "scrape_results")
    return curate.source_stats(results, scoring.dictionary_score(F.col("job.title"), weights), LEAST_SCORE, F.col("scrape_id"))


_STATS_SQL = f"""
last AS (SELECT source_url, max_by(jobs_count, scrape_id) AS total_jobs, max_by(creative_jobs, scrape_id) AS jobs FROM scrape_results GROUP BY source_url),
titles AS (SELECT source_url, unnest(jobs).title AS title FROM last WHERE len(jobs) > 0),
scored AS (SELECT source_url, coalesce({_BEST.format(round='floor(w.weight + 0.5)', text='titles.title')}, 3) AS s FROM titles),
stats AS (SELECT l.source_url, l.total_jobs, coalesce((SELECT count(*) FROM scored s WHERE s.source_url = l.source_url AND s.s >= {LEAST_SCORE}), 0) AS quality_jobs FROM last l)
"""


@query(f"""
WITH {_STATS_SQL}, listed AS (SELECT DISTINCT source_url FROM raw_jobs)
SELECT source_url, total_jobs, quality_jobs, CASE WHEN total_jobs IS NULL THEN 'not_in_scrape' WHEN total_jobs = 0 THEN 'zero' WHEN quality_jobs = 0 THEN 'low' ELSE 'keep' END AS bucket
FROM listed LEFT JOIN stats USING (source_url)
""")
def prune_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed sources as kept, low, zero or not scraped."""
    listed = read_table(spark, sf_dir, "raw_jobs").select("source_url").distinct()
    return curate.prune(listed, _stats(spark, sf_dir))


@query(f"""
WITH {_STATS_SQL}, listed AS (SELECT DISTINCT source_url FROM raw_jobs), b AS (SELECT CASE WHEN total_jobs IS NULL THEN 'not_in_scrape' WHEN total_jobs = 0 THEN 'zero' WHEN quality_jobs = 0 THEN 'low' ELSE 'keep' END AS bucket, quality_jobs FROM listed LEFT JOIN stats USING (source_url))
SELECT bucket, count(*) AS sources, coalesce(sum(quality_jobs), 0) AS quality_jobs, round(coalesce(sum(quality_jobs), 0) / count(*), 2) AS yield_per_source FROM b GROUP BY bucket
""")
def prune_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources and quality postings of each bucket."""
    b = prune_buckets(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("sources"), F.coalesce(F.sum("quality_jobs"), F.lit(0)).alias("quality_jobs"))
    return b.withColumn("yield_per_source", F.round(F.col("quality_jobs") / F.col("sources"), 2))


@query(f"""
WITH {_STATS_SQL}, master AS (SELECT DISTINCT source_url FROM raw_jobs)
SELECT s.source_url, quality_jobs, CASE WHEN quality_jobs = 0 THEN 'rejected' WHEN m.source_url IS NOT NULL THEN 'known' ELSE 'promoted' END AS decision FROM stats s LEFT JOIN master m ON m.source_url = s.source_url
""")
def promote_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped sources as promoted, known or rejected."""
    return curate.promote(_stats(spark, sf_dir), read_table(spark, sf_dir, "raw_jobs"))


@query("""
WITH j AS (SELECT source_url, ats, unnest(creative_jobs) AS job FROM scrape_results WHERE len(creative_jobs) > 0)
SELECT source_url, ats, count(*) AS jobs, count(DISTINCT job.title) AS titles, count_if(job.date_posted IS NULL) AS undated FROM j GROUP BY source_url, ats
""")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings, titles and undated postings of each source and system."""
    j = read_table(spark, sf_dir, "scrape_results").select("source_url", "ats", F.explode("creative_jobs").alias("job"))
    return j.groupBy("source_url", "ats").agg(F.count("*").alias("jobs"), F.countDistinct("job.title").alias("titles"), F.count_if(F.col("job.date_posted").isNull()).alias("undated"))


# ---- logos ----------------------------------------------------------------


@query("""
SELECT u.row_id, coalesce(nullif(trim(u.company_logo), ''), l.logo_url, 'https://avatars.example/?company') AS logo
FROM upload_rows u LEFT JOIN logo_cache l ON l.company_key = lower(trim(u.company))
""")
def logo_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank logos filled from the cache, else a stand-in; given ones never change.

    The cache grows with the companies, so it is shuffled unless Spark finds
    it small enough to send around.
    """
    rows = read_table(spark, sf_dir, "upload_rows").select("row_id", "company_logo", F.lower(F.trim("company")).alias("company_key"))
    cache = read_table(spark, sf_dir, "logo_cache").select("company_key", "logo_url")
    filled = F.coalesce(F.nullif(F.trim("company_logo"), F.lit("")), "logo_url", F.lit("https://avatars.example/?company"))
    return rows.join(cache, "company_key", "left").select("row_id", filled.alias("logo"))


@query("SELECT DISTINCT lower(trim(company)) AS company_key FROM upload_rows WHERE trim(company) <> '' AND lower(trim(company)) NOT IN (SELECT company_key FROM logo_cache)")
def logo_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies that the cache does not know."""
    keys = read_table(spark, sf_dir, "upload_rows").filter("trim(company) <> ''").select(F.lower(F.trim("company")).alias("company_key")).distinct()
    return curate.unseen(keys, read_table(spark, sf_dir, "logo_cache"), key="company_key")


@query("SELECT count(*) AS cached, count_if(logo_source <> 'unresolved') AS resolved, count_if(logo_source = 'unresolved') AS unresolved FROM logo_cache")
def logo_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "logo_cache").agg(F.count("*").alias("cached"), F.count_if(F.col("logo_source") != "unresolved").alias("resolved"), F.count_if(F.col("logo_source") == "unresolved").alias("unresolved"))


@query(f"""
WITH c AS (SELECT DISTINCT lower({q.trim('company')}) AS company_key FROM upload_rows WHERE {q.trim('company')} <> ''),
g AS (SELECT company_key, regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(company_key, '{logos.NAME_TAIL}', ''), ',\\s*$', '')), '[^a-z0-9\\s]', '', 'g'), '\\s+', '', 'g') AS bare FROM c)
SELECT company_key, CASE WHEN length(bare) >= 2 THEN [bare || '.com', bare || '.io', bare || '.co'] ELSE [] END AS guesses FROM g
""")
def logo_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains that a company's name suggests: one legal or trade suffix off, then plain letters."""
    rows = read_table(spark, sf_dir, "upload_rows").filter(tx.trim(F.col("company")) != "")
    return rows.select(F.lower(tx.trim(F.col("company"))).alias("company_key")).distinct().select("company_key", logos.guesses(F.col("company_key")).alias("guesses"))


@query()
def logo_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains to try for each company that the cache lacks."""
    wanted = logos.candidates(read_table(spark, sf_dir, "upload_rows").select("row_id", "company", "company_website"))
    return curate.unseen(wanted, read_table(spark, sf_dir, "logo_cache"), key="company_key")


# ---- quality and reviews -----------------------------------------------------

_FIELDS = ["title", "description", "job_type", "job_link", "work_email", "deadline", "keywords", "skills", "salary_min", "company", "hiring_team"]


def _empty(f: str) -> str:
    return f"NOT coalesce({q.trim(f)} <> '', false)"


@query(f"SELECT count(*) AS rows, {', '.join(f'count_if({_empty(f)}) AS no_{f}' for f in _FIELDS)} FROM upload_rows")
def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows lack each field."""
    return quality.missing_counts(read_table(spark, sf_dir, "upload_rows"), _FIELDS)


@query(f"SELECT row_id, list_filter([{', '.join(f'CASE WHEN {_empty(f)} THEN {q.text(f)} END' for f in _FIELDS[:3] + ['hiring_team'])}], lambda x: x IS NOT NULL) AS missing FROM upload_rows WHERE {' OR '.join(_empty(f) for f in _FIELDS[:3] + ['hiring_team'])}")
def required_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without title, description, job type or hiring team, and what they lack."""
    missing = quality.missing_required([*_FIELDS[:3], "hiring_team"])
    return read_table(spark, sf_dir, "upload_rows").select("row_id", missing.alias("missing")).filter(F.size("missing") > 0)


@query(f"""
WITH e AS (SELECT {q.loose_key('url')} AS k, max_by(upper(verdict), review_id) AS verdict, count(*) AS entries FROM review_entries WHERE trim(url) <> '' GROUP BY 1), r AS (SELECT row_id, {q.loose_key('job_link')} AS k FROM upload_rows)
SELECT row_id, e.verdict, coalesce(e.entries, 0) AS entries FROM r LEFT JOIN e USING (k)
""")
def review_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row with the last verdict on its address, whatever the scheme and ``www.``; entries are counted before the join."""
    e = read_table(spark, sf_dir, "review_entries").filter("trim(url) <> ''").groupBy(urls.loose_key(F.col("url")).alias("k")).agg(F.max_by(F.upper("verdict"), "review_id").alias("verdict"), F.count("*").alias("entries"))
    r = read_table(spark, sf_dir, "upload_rows").select("row_id", urls.loose_key(F.col("job_link")).alias("k"))
    return r.join(e, "k", "left").select("row_id", "verdict", F.coalesce("entries", F.lit(0)).alias("entries"))


@query("""
WITH v AS (SELECT row_id, max_by(upper(verdict), review_id) AS verdict FROM review_entries WHERE row_id IS NOT NULL GROUP BY row_id)
SELECT coalesce(v.verdict, 'REVIEW') AS verdict, count(*) AS rows FROM upload_rows u LEFT JOIN v ON v.row_id = u.row_id GROUP BY 1
""")
def verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per verdict: the last entry counts, none means review."""
    last = read_table(spark, sf_dir, "review_entries").filter("row_id is not null").groupBy("row_id").agg(F.max_by(F.upper("verdict"), "review_id").alias("verdict"))
    rows = read_table(spark, sf_dir, "upload_rows").select("row_id").join(last, "row_id", "left")
    return rows.groupBy(F.coalesce("verdict", F.lit("REVIEW")).alias("verdict")).agg(F.count("*").alias("rows"))


@query("""
WITH l AS (SELECT row_id, max_by(title, review_id) AS title, max_by(company, review_id) AS company FROM review_entries WHERE row_id IS NOT NULL GROUP BY row_id), r AS (SELECT row_id, title, company FROM upload_rows WHERE batch_no > 0),
j AS (SELECT coalesce(l.row_id, r.row_id) AS row_id, l.row_id IS NOT NULL AS hl, r.row_id IS NOT NULL AS hr, l.title AS lt, r.title AS rt, l.company AS lc, r.company AS rc FROM l FULL JOIN r ON l.row_id = r.row_id)
SELECT row_id, 'title' AS field, CASE WHEN NOT hr THEN 'MISSING_RIGHT' WHEN NOT hl THEN 'MISSING_LEFT' WHEN lt IS NOT DISTINCT FROM rt THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM j
UNION ALL SELECT row_id, 'company', CASE WHEN NOT hr THEN 'MISSING_RIGHT' WHEN NOT hl THEN 'MISSING_LEFT' WHEN lc IS NOT DISTINCT FROM rc THEN 'MATCH' ELSE 'MISMATCH' END FROM j
""")
def field_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of reviews and rows compared one by one."""
    left = read_table(spark, sf_dir, "review_entries").filter("row_id is not null").groupBy("row_id").agg(F.max_by("title", "review_id").alias("title"), F.max_by("company", "review_id").alias("company"))
    return quality.field_audit(left, read_table(spark, sf_dir, "upload_rows").filter("batch_no > 0"), "row_id", ["title", "company"])


# ---- order and batches -------------------------------------------------------


@query("SELECT row_id, CAST(floor((row_number() OVER (ORDER BY row_id) - 1) / 30) AS BIGINT) AS batch FROM upload_rows")
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in batches of 30 by their number."""
    return layout.batches(read_table(spark, sf_dir, "upload_rows").select("row_id"), ["row_id"], 30).select("row_id", "batch")


@query("SELECT row_id, received_at FROM upload_rows WHERE received_at IS NOT NULL ORDER BY received_at DESC, row_id LIMIT 100")
def newest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred newest rows (a top-n report)."""
    rows = read_table(spark, sf_dir, "upload_rows").filter("received_at is not null").select("row_id", "received_at")
    return rows.orderBy(F.desc("received_at"), "row_id").limit(100)


@query("""
WITH n AS (SELECT row_id, nullif(lower(trim(company)), '') AS g FROM upload_rows)
SELECT row_id, CASE WHEN g IS NOT NULL THEN round((row_number() OVER (PARTITION BY g ORDER BY row_id) - 0.5) / count(*) OVER (PARTITION BY g), 9) END AS spread_key FROM n
""")
def spread_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sort keys that spread every company's rows over the whole order."""
    rows = read_table(spark, sf_dir, "upload_rows").select("row_id", "company")
    return layout.spread_key(rows, F.col("company"), ["row_id"]).select("row_id", F.round("spread_key", 9).alias("spread_key"))


@query()
def spread_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact slots of the spreading order; sequential, so tested against brute force."""
    return layout.spread(read_table(spark, sf_dir, "upload_rows").select("row_id", "company"), "company", "row_id").select("row_id", "slot")


@query("SELECT scrape_id, CAST(isoyear(scraped_at) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(scraped_at) AS VARCHAR), 2, '0') AS iso_week, strftime(scraped_at, '%Y-%m-%d_%H%M%S') || 'Z' AS run_tag FROM scrape_results")
def snapshot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week and run under which each result is kept."""
    return read_table(spark, sf_dir, "scrape_results").select("scrape_id", sinks.iso_week(F.col("scraped_at")).alias("iso_week"), sinks.run_tag(F.col("scraped_at")).alias("run_tag"))


@query("""
WITH b AS (SELECT row_id, title, company FROM upload_rows WHERE batch_no = 0), c AS (SELECT row_id, title, company FROM review_entries WHERE row_id IS NOT NULL AND title IS NOT NULL QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY review_id DESC) = 1)
SELECT row_id, title, company FROM b WHERE row_id NOT IN (SELECT row_id FROM c) UNION ALL SELECT c.row_id, c.title, coalesce(b.company, c.company) FROM c LEFT JOIN b ON b.row_id = c.row_id
""")
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed titles put into history; a row's company stays as it was."""
    base = read_table(spark, sf_dir, "upload_rows").filter("batch_no = 0").select("row_id", "title", "company")
    changes = read_table(spark, sf_dir, "review_entries").filter("row_id is not null and title is not null").groupBy("row_id").agg(F.max_by("title", "review_id").alias("title"), F.max_by("company", "review_id").alias("company"))
    return sinks.upsert(base, changes, "row_id", ["company"])


@query("""
SELECT row_id, CASE WHEN lower(trim(city)) = 'remote' THEN '' ELSE city END AS city, CASE WHEN lower(trim(city)) = 'remote' THEN 'REMOTE'
  WHEN concat(trim(city), trim(state), trim(country)) <> '' AND w IN ('REMOTE', '') THEN 'ONSITE' ELSE w END AS work_type,
  CASE WHEN try_cast(salary_min AS DOUBLE) = 0 THEN '' ELSE salary_min END AS salary_min
FROM (SELECT *, CASE upper(trim(work_type)) WHEN 'REMOTE' THEN 'REMOTE' WHEN 'HYBRID' THEN 'HYBRID' WHEN 'ON-SITE' THEN 'ONSITE' ELSE '' END AS w FROM upload_rows)
""")
def enrich_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the merge makes of rows whose reply could not be read."""
    rows = read_table(spark, sf_dir, "upload_rows").withColumn("reply", enrich.parse_reply(F.lit("no answer")))
    return enrich.merge(rows, "reply").select("row_id", "city", "work_type", "salary_min")


# ---- streams ----------------------------------------------------------------


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def event_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and values per event type, as the stream's batch form."""
    return read_table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and type."""
    return read_table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number out of a JSON field."""
    return read_table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts IS NOT NULL GROUP BY 1, 2
""")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of the events as a stream that is read to its end."""
    schema = read_table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = streams.drained(streams.windowed_counts(stream, "ts", "event_type", "value"), f"stream_windows_{uuid.uuid4().hex[:8]}", "complete")
    return counts.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


_SITE = "coalesce(job_link, company_website)"
_BASE = q.base_domain(f"regexp_replace({q.host('company_website')}, '^www\\.', '')")


@query(f"""
SELECT row_id, lower({q.host(_SITE)}) AS host, {q.matches(q.host(_SITE), '(?:' + vocab.KNOWN_HOSTS + '|phenompeople' + chr(92) + '.com)$')} OR coalesce({q.host(_SITE)} = {q.host('company_website')}, false)
  OR (coalesce({q.host(_SITE)} = {_BASE} OR {q.host(_SITE)} LIKE '%.' || {_BASE}, false) AND {q.matches(q.host(_SITE), '^(?:jobs|careers)' + chr(92) + '.')}) AS allowed
FROM upload_rows WHERE company_website IS NOT NULL
""")
def crawl_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a crawl that starts at the company's site may follow the posting's link."""
    rows = read_table(spark, sf_dir, "upload_rows").filter("company_website is not null")
    site = F.coalesce("job_link", "company_website")
    return rows.select("row_id", urls.host(site).alias("host"), boards.crawl_allowed(site, F.col("company_website")).alias("allowed"))


@query()
def pipeline_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages 1 to 3 over the scraped rows, without pages and enricher: described, distinct postings of the trade."""
    from postloom.plans import pipeline

    raw = read_table(spark, sf_dir, "raw_jobs").select(F.col("raw_id").alias("row_id"), "title", "url", F.col("location_text").alias("location"), "company", "ats", "source_url", "description", "date_posted").distinct()
    out = pipeline.run(raw)
    return out.select("row_id", "title", "url", "company", "place.city", "place.country", "job_type", "work_type", "score", "keywords", "posted")


from postloom.plans import details  # noqa: E402, F401  (registers its queries)
