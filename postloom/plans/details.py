"""Queries of the detail stage, of single functions, and of run reports, each with its SQL.

The supplied tables hold no pages and no structured data, so some queries build
them from the tables' own columns, read them with the operator, and the SQL
says from the columns what must come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import boards, extract, html, posting, predicates, urls, vocab
from postloom.functions import text as tx
from postloom.operators import curate, enrich, layout, runs
from postloom.plans import sql as q
from postloom.plans.registry import AS_OF, query
from postloom.session import read_table
from postloom.sources import readers
from postloom.streaming import streams


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "upload_rows")


def _replaced(x: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        x = f"replace({x}, {q.text(a)}, {q.text(b)})"
    return x


def _mended(x: str) -> str:
    """Garbled sequences repaired, then plain punctuation."""
    x = f"regexp_replace({_replaced(x, list(tx.REPAIRS))}, '\\x{{00e2}}\\x{{0080}}[\\x{{0090}}-\\x{{009f}}]', '-', 'g')"
    for pattern, plain in tx.PLAIN_PUNCTUATION:
        x = f"regexp_replace({x}, {q.text(pattern)}, {q.text(plain)}, 'g')"
    return x


# ---- structured data --------------------------------------------------------


def _pay_node() -> Column:
    value = F.struct(F.col("salary_min").alias("minValue"), F.col("salary_max").alias("maxValue"), F.col("salary_period").alias("unitText"))
    return F.to_json(F.struct(F.lit("JobPosting").alias("@type"), F.struct(F.col("salary_currency").alias("currency"), value.alias("value")).alias("baseSalary")))


_PERIOD = "CASE WHEN p LIKE '%hour%' THEN 'HOURLY' WHEN p LIKE '%day%' THEN 'DAILY' WHEN p LIKE '%week%' THEN 'WEEKLY' WHEN p LIKE '%month%' THEN 'MONTHLY' WHEN p LIKE '%year%' OR p LIKE '%annual%' THEN 'ANNUAL' WHEN p LIKE '%one%' OR p LIKE '%fixed%' THEN 'ONE_TIME' END"


@query(f"""
WITH n AS (SELECT row_id, TRY_CAST({q.trim('salary_min')} AS DOUBLE) AS lo, TRY_CAST({q.trim('salary_max')} AS DOUBLE) AS hi, coalesce(nullif({q.trim('salary_currency')}, ''), 'USD') AS currency, lower(coalesce(salary_period, '')) AS p FROM upload_rows)
SELECT row_id, lo AS low, hi AS high, currency, {_PERIOD} AS period FROM n WHERE lo IS NOT NULL OR hi IS NOT NULL
""")
def node_salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay out of structured data that holds the rows' own pay."""
    s = posting.salary(_pay_node(), F.lit(None).cast("string"))
    return _rows(spark, sf_dir).select("row_id", s.alias("s")).filter("s is not null").select("row_id", F.col("s.min").alias("low"), F.col("s.max").alias("high"), F.col("s.currency").alias("currency"), F.col("s.period").alias("period"))


@query("""
WITH t AS (SELECT row_id, salary_min AS lo, salary_max AS hi, salary_currency AS c, row_id % 3 AS k FROM upload_rows WHERE regexp_full_match(salary_min, '[1-9][0-9]{3,5}') AND regexp_full_match(salary_max, '[1-9][0-9]{3,5}'))
SELECT row_id, CASE k WHEN 0 THEN CAST(substr(lo, 1, 2) AS DOUBLE) * 1000 ELSE CAST(substr(lo, 1, 3) AS DOUBLE) END AS low, CASE k WHEN 0 THEN CAST(substr(hi, 1, 2) AS DOUBLE) * 1000 ELSE CAST(substr(hi, 1, 3) AS DOUBLE) END AS high,
  CASE c WHEN 'EUR' THEN 'EUR' WHEN 'GBP' THEN 'GBP' ELSE 'USD' END AS currency, CASE k WHEN 0 THEN 'ANNUAL' WHEN 1 THEN 'HOURLY' ELSE 'DAILY' END AS period FROM t
""")
def text_salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay ranges out of sentences that are made of the rows' own pay, in three ways of writing."""
    rows = _rows(spark, sf_dir).filter(F.col("salary_min").rlike("^[1-9][0-9]{3,5}$") & F.col("salary_max").rlike("^[1-9][0-9]{3,5}$"))
    sign = F.when(F.col("salary_currency") == "EUR", "€").when(F.col("salary_currency") == "GBP", "£").otherwise("$")
    lo, hi = F.col("salary_min"), F.col("salary_max")
    long = F.concat(F.lit("We pay "), sign, F.substring(lo, 1, 2), F.lit("k - "), sign, F.substring(hi, 1, 2), F.lit("K a head."))
    short = F.concat(sign, F.substring(lo, 1, 3), F.lit(" to "), F.substring(hi, 1, 3))
    text = F.when(F.col("row_id") % 3 == 0, long).when(F.col("row_id") % 3 == 1, F.concat(short, F.lit(" per hour"))).otherwise(short)
    return rows.select("row_id", extract.salary(text).alias("s")).select("row_id", F.col("s.min").alias("low"), F.col("s.max").alias("high"), F.col("s.currency").alias("currency"), F.col("s.period").alias("period"))


_LOW = "lower(concat_ws(' ', title, description))"
_TERMS = f"list_filter([{', '.join(f'CASE WHEN contains({_LOW}, {q.text(t)}) THEN {q.text(t)} END' for t in vocab.KEYWORD_TERMS if t not in vocab.KEYWORD_BLOCKLIST)}], lambda x: x IS NOT NULL)"


def _split(c: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array(coalesce({c}, ''), '[,;|]'), lambda x: lower({q.trim('x')})), lambda x: x <> '')"


@query(f"""
WITH k AS (SELECT row_id, list_filter({_split('keywords')} || (CASE WHEN {q.trim('company')} <> '' THEN [lower({q.trim('company')})] ELSE [] END), lambda x: length(x) >= 2 AND x NOT IN ({q.names(sorted(vocab.KEYWORD_BLOCKLIST))})) || {_TERMS} AS a FROM upload_rows)
SELECT row_id, list_filter(a, lambda x, i: list_position(a, x) = i)[1:20] AS keywords FROM k
""")
def node_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords out of structured data with a text and a list, then terms of the text."""
    node = F.to_json(F.struct(F.col("keywords").alias("occupationalCategory"), F.array(F.col("company")).alias("industry"), F.lit(7).alias("qualifications")))
    return _rows(spark, sf_dir).select("row_id", posting.keywords(node, F.col("title"), F.col("description")).alias("keywords"))


def _plausible(x: str) -> str:
    noise = "|".join(map(vocab.escaped, vocab.LOCATION_NOISE))
    return f"({x} <> '' AND length({x}) <= 90 AND NOT regexp_matches({x}, {q.text('(?i)' + chr(92) + 'b(?:' + noise + ')')}) AND NOT regexp_matches({x}, '[{{}}<>]') AND (len(regexp_split_to_array({x}, '\\s+')) <= 8 OR {q.has(x, ['remote'])}))"


_CODES = " ".join(f"WHEN {q.text(k)} THEN {q.text(v)}" for k, v in vocab.COUNTRIES.items())


@query(f"""
WITH p AS (SELECT row_id, coalesce({q.collapse('city')}, '') AS c, coalesce({q.collapse('state')}, '') AS s, coalesce({q.collapse('country')}, '') AS l FROM upload_rows),
a AS (SELECT *, array_to_string(list_filter([c, s, l], lambda x: x <> ''), ', ') AS address FROM p)
SELECT row_id, address, c AS city, s AS state, CASE WHEN length(l) <= 3 THEN coalesce(CASE upper(l) {_CODES} END, l) ELSE l END AS country FROM a WHERE {_plausible('address')}
""")
def node_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places out of structured data that holds the rows' own city, state and country."""
    address = F.struct(F.col("city").alias("addressLocality"), F.col("state").alias("addressRegion"), F.col("country").alias("addressCountry"))
    node = F.to_json(F.struct(F.array(F.struct(address.alias("address"))).alias("jobLocation")))
    p = posting.place(F.lit("Not specified"), node, F.lit(""))
    return _rows(spark, sf_dir).select("row_id", p.alias("p")).filter("p is not null").select("row_id", "p.address", "p.city", "p.state", "p.country")


@query(f"""
WITH t AS (SELECT row_id, {q.collapse(_mended('title'))} AS t FROM upload_rows), g AS (SELECT *, regexp_matches(t, '(?i)^.{{2,30}}\\s+(?:careers?|jobs?|openings?|opportunities)$') AS listing FROM t)
SELECT row_id, CASE WHEN row_id % 2 = 0 AND t <> '' AND NOT listing THEN t WHEN length(t) > 3 AND length(t) < 200 AND NOT listing THEN t ELSE 'seed' END AS title FROM g
""")
def title_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title of structured data (even rows only), else the heading, else the seed; titles of listings are passed over."""
    node = F.when(F.col("row_id") % 2 == 0, tx.collapse(F.col("title")))
    rows = _rows(spark, sf_dir).withColumn("h", tx.collapse(F.col("title")))
    good = F.when(F.col("h") == "", None).otherwise(F.col("h"))
    return rows.select("row_id", posting.title(node, good, F.lit("Acme careers"), F.lit("seed")).alias("title"))


def _page(title: Column, body: Column) -> Column:
    def safe(c: Column) -> Column:
        for char, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = F.replace(F.coalesce(c, F.lit("")), F.lit(char), F.lit(code))
        return c

    return F.concat(F.lit("<html><head><title>"), safe(title), F.lit(" | Board</title><script>var x = '<h1>no</h1>';</script></head><body><div class='nav'>Menu</div><div class='job-description extra'>"), safe(body), F.lit("</div></body></html>"))


@query(f"""
WITH d AS (SELECT row_id, {q.collapse("coalesce(description, '')")} AS d, {q.collapse("coalesce(title, '') || ' | Board'")} AS t FROM upload_rows)
SELECT row_id, t AS page_title, nullif(d, '') AS block, CASE WHEN length(t) BETWEEN 3 AND 180 THEN t END AS detail_title FROM d
""")
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and longest block of pages that are made of the rows' own title and description."""
    rows = _rows(spark, sf_dir).select("row_id", html.fields_column(_page(F.col("title"), F.col("description"))).alias("f"))
    return rows.select("row_id", F.col("f.page_title"), tx.collapse(F.col("f.block")).alias("block"), F.col("f.detail_title"))


@query(f"""
WITH d AS MATERIALIZED (SELECT row_id, {q.collapse("coalesce(description, '')")} AS d FROM upload_rows),
c AS MATERIALIZED (SELECT row_id, d, {' , '.join(f"CASE WHEN instr(d, {q.text(m)}) > 1 THEN instr(d, {q.text(m)}) END AS m{k}" for k, m in enumerate(tx.CUT_MARKERS))} FROM d),
k AS MATERIALIZED (SELECT row_id, d, {q.trim(f"substr(d, 1, coalesce(least({', '.join(f'm{k}' for k in range(len(tx.CUT_MARKERS)))}), length(d) + 1) - 1)")} AS t FROM c),
b AS MATERIALIZED (SELECT row_id, d, regexp_replace(regexp_replace(regexp_replace(t, '(?i)\\.remix-css-[a-z0-9-]+\\{{[^}}]*\\}}', ' ', 'g'), '\\b[A-Za-z0-9_-]+\\{{[^}}]{{0,240}}\\}}', ' ', 'g'), '(?i)\\b(?:AttachDropboxGoogle Drive|Enter manually)\\b', ' ', 'g') AS t FROM k)
SELECT row_id, CASE WHEN length(d) >= 80 THEN substr({q.collapse(_mended('t'))}, 1, 15000) ELSE 'For job details, click apply.' END AS description FROM b
""")
def best_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The description that a page without structured data gives: its longest block, or the stand-in."""
    rows = _rows(spark, sf_dir).select("row_id", html.fields_column(_page(F.lit("x"), F.col("description"))).alias("f"))
    return rows.select("row_id", posting.description(F.lit(None).cast("string"), tx.collapse(F.col("f.block")), F.col("f.summary")).alias("description"))


@query(f"""
WITH r AS (SELECT row_id, {q.collapse("coalesce(description, '')")} AS raw, {q.canonical("coalesce(job_link, '')")} AS link FROM upload_rows),
k AS (SELECT row_id, raw, length({q.collapse("regexp_replace(regexp_replace(raw, '<[^>]+>', '', 'g'), '&[a-z]+;', '.', 'g')")}) AS n,
  ({q.matches(q.host('link'), vocab.KNOWN_HOSTS)} OR {q.matches('link', '(?i)/(?:jobs?|careers?|positions?|openings?)' + chr(92) + 'b')}) AND NOT {q.matches('link', '(?i)/(?:services?|portfolio|case-studies|case-study|case-studie|blog|news|insights|articles?|about|contact)' + chr(92) + 'b')} AS posting,
  {q.matches("substr(raw, 1, 5000)", chr(92) + 'x{fffd}|[' + chr(92) + 'x{0080}-' + chr(92) + 'x{009f}]|â€[‘’“”–—…™]|Ã[' + chr(92) + 'x{0080}-' + chr(92) + 'x{00bf}]|(?:[ÎÏ][' + chr(92) + 'x{0080}-' + chr(92) + 'x{00bf}]){3,}')} AS garbled, regexp_matches(raw, '<[^>]+>') AS tagged FROM r)
SELECT row_id, CASE WHEN raw = '' OR (garbled AND posting) THEN 'placeholder' WHEN NOT tagged THEN 'as_is' WHEN n >= 40 THEN 'html' WHEN posting OR n = 0 THEN 'placeholder' ELSE 'plain' END AS kind FROM k WHERE raw NOT LIKE '%<%' OR regexp_matches(raw, '^<(?:p|div|li)>.*</(?:p|div|li)>$')
""")
def description_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the policy makes of each description that is plain text or wholly of paragraphs."""
    raw = tx.collapse(F.coalesce("description", F.lit("")))
    rows = _rows(spark, sf_dir).filter(~raw.contains("<") | raw.rlike("^<(?:p|div|li)>.*</(?:p|div|li)>$"))
    safe = html.sanitised_column(F.col("description"))
    staged = rows.select("row_id", "description", "job_link", safe.alias("safe")).select("*", html.text_column(F.col("safe")).alias("safe_plain"), html.text_column(F.col("description")).alias("plain"))
    return staged.select("row_id", posting.description_policy(F.col("description"), F.col("job_link"), F.col("safe"), F.col("safe_plain"), F.col("plain"))["kind"].alias("kind"))


@query(f"""
WITH t AS (SELECT raw_id, scraped_at, {q.collapse('title')} AS t FROM raw_jobs WHERE title IS NOT NULL)
SELECT DISTINCT raw_id, t AS title, 'https://site.example/jobs/' || raw_id AS url, 'Graz, Austria' AS location FROM t WHERE length(t) >= 3 AND raw_id >= 0
""")
def row_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of list pages with one row each that are made of the scraped titles."""
    raw = read_table(spark, sf_dir, "raw_jobs").filter("title is not null")
    text = F.replace(F.replace(F.replace("title", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    number = F.col("raw_id").cast("string")
    page = F.concat(F.lit("<table><tr><td>: Graz, Austria :</td><td><a href='/jobs/"), number, F.lit("'>"), text, F.lit("</a><a href='/x/1'>no</a></td></tr></table><ul><li><b>Leeds, England</b></li></ul>"))
    found = html.rows_to_jobs(raw.select(F.concat(F.lit("https://site.example/list?"), number).alias("url"), page.alias("html")))
    return found.select(F.substring_index("page_url", "?", -1).cast("long").alias("raw_id"), "title", "url", "location").distinct()


# ---- titles, addresses, texts -------------------------------------------------


@query(f"SELECT raw_id, scraped_at, {q.matches(q.trim('title'), '(?i)^.{2,30}' + chr(92) + 's+(?:careers?|jobs?|openings?|opportunities)$')} AS listing, lower({q.trim('title')}) IN ('job not available') AS dropped FROM raw_jobs WHERE title IS NOT NULL")
def title_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of listings, and titles that are dropped whatever the address says."""
    t = F.col("title")
    return read_table(spark, sf_dir, "raw_jobs").filter("title is not null").select("raw_id", "scraped_at", posting.careers_page_title(t).alias("listing"), predicates.always_dropped(t).alias("dropped"))


@query(f"""
SELECT row_id, NOT (coalesce(length(title) > 3, false) AND NOT {q.matches(q.trim('title'), '(?i)^(?:careers|jobs|home|404|error|cookie|login|select|current openings|open roles)')} AND NOT coalesce(lower({q.trim('title')}) = 'job not available', false))
  AND NOT {q.matches('lower(job_link)', vocab.SPECIFIC_URL)} AS honoured FROM upload_rows
""")
def drop_wishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a reply that calls a row invalid would be followed."""
    return _rows(spark, sf_dir).select("row_id", predicates.drop_honoured(F.lit("INVALID"), F.col("title"), F.col("job_link")).alias("honoured"))


@query(f"SELECT row_id, {', '.join(f'{q.matches(_LOW, p)} AS {n}' for n, p in predicates.QC_PATTERNS.items())} FROM upload_rows")
def qc_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of a quality check over title and description."""
    return _rows(spark, sf_dir).select("row_id", predicates.qc_flags(F.lower(F.concat_ws(" ", "title", "description"))).alias("f")).select("row_id", "f.*")


@query(f"""
WITH d AS (SELECT raw_id, scraped_at, date_diff('day', CAST({q.date_forms('date_posted')} AS DATE), DATE '{AS_OF}') AS age FROM raw_jobs)
SELECT raw_id, scraped_at, CASE WHEN age IS NULL THEN 'REVIEW' WHEN age > 10 THEN 'REJECT' ELSE 'PASS' END AS verdict FROM d
""")
def age_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings by age: too old, unknown, or fine."""
    day = extract.day(F.col("date_posted")).cast("date")
    return read_table(spark, sf_dir, "raw_jobs").select("raw_id", "scraped_at", predicates.age_verdict(day, F.lit(AS_OF).cast("date")).alias("verdict"))


_LABEL = "regexp_extract(" + q.host("job_link") + ", '^([^.]+)', 1)"


@query(f"""
SELECT row_id, {q.matches(q.host('job_link'), '|'.join(vocab.escaped(x) for x in predicates.SCRIPTED_HOSTS))} OR coalesce(len(string_split({q.host('job_link')}, '.')) >= 3 AND {_LABEL} IN ({q.names(predicates.SCRIPTED_LABELS)}), false) AS browser,
  CASE WHEN {q.is_url('job_link')} THEN {q.canonical('job_link')} ELSE job_link END AS retry, {q.matches('job_link', '(?i)/(?:jobs?|careers?|positions?|openings?)' + chr(92) + 'b')} AS job_path,
  {q.matches('job_link', '(?i)/(?:services?|portfolio|case-studies|case-study|case-studie|blog|news|insights|articles?|about|contact)' + chr(92) + 'b')} AS other_path,
  {q.matches(q.host('job_link'), '(?:^|' + chr(92) + '.)(?:' + '|'.join(map(vocab.escaped, urls.BOARD_DOMAINS)) + ')$')} AS board FROM upload_rows
""")
def address_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a posting's address would be fetched, and what its path and host say."""
    link = F.col("job_link")
    return _rows(spark, sf_dir).select(
        "row_id", predicates.needs_browser(link).alias("browser"), urls.retry_canonical(link).alias("retry"), predicates.job_path(link).alias("job_path"), predicates.other_path(link).alias("other_path"), urls.is_board_domain(urls.host(link)).alias("board")
    )


_SEG = q.segments("job_link")
_LAST = f"(CASE WHEN lower({_SEG}[len({_SEG})]) = 'apply' AND len({_SEG}) > 1 THEN {_SEG}[len({_SEG}) - 1] ELSE {_SEG}[len({_SEG})] END)"


@query(f"""
WITH s AS (SELECT row_id, {q.trim(f"regexp_replace(regexp_replace(regexp_replace(url_decode({_LAST}), '(?i)^xmlname-', ''), '(?i)_r[0-9]+[a-z0-9-]*$', ''), '[-_]+', ' ', 'g')")} AS t FROM upload_rows WHERE len({_SEG}) > 0)
SELECT row_id, t AS title FROM s WHERE length(t) BETWEEN 3 AND 180
""")
def crawler_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each address calls its posting."""
    return _rows(spark, sf_dir).select("row_id", urls.crawler_title(F.col("job_link")).alias("title")).filter("title is not null")


_PARAMS = f"list_transform(list_filter(string_split({q.query('job_link')}, '&'), lambda p: p <> ''), lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END)"


@query(f"""
WITH p AS (SELECT row_id, job_link, {_PARAMS} AS a FROM upload_rows WHERE {q.is_url('job_link')}),
k AS (SELECT *, list_position(list_transform(a, lambda x: starts_with(x, 'page=')), true) AS f FROM p),
n AS (SELECT *, CASE WHEN f IS NULL THEN a || ['page=2'] ELSE a[1:f - 1] || ['page=2'] || list_filter(a[f + 1:], lambda x: NOT starts_with(x, 'page=')) END AS b FROM k)
SELECT row_id, {q.origin('job_link')} || {q.path('job_link')} || '?' || array_to_string(b, '&') || {q.part('job_link', 6)} AS url FROM n
""")
def next_page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each address with its page parameter set."""
    return _rows(spark, sf_dir).select("row_id", urls.with_query(F.col("job_link"), {"page": 2}).alias("url")).filter("url is not null")


#: Addresses of five systems in which the tenant is put.
TENANT_URLS = {"greenhouse": "https://boards.greenhouse.io/{}/jobs/1", "lever": "https://jobs.lever.co/{}/x", "ashby": "https://jobs.ashbyhq.com/{}", "smartrecruiters": "https://careers.smartrecruiters.com/{}", "workable": "https://apply.workable.com/{}/j/2"}


@query(f"""
WITH c AS (SELECT DISTINCT regexp_replace(lower(company), '[^a-z0-9]', '', 'g') AS t FROM upload_rows WHERE company IS NOT NULL), s AS (SELECT unnest([{q.names(list(TENANT_URLS))}]) AS system)
SELECT system, t AS slug, t AS tenant FROM c, s WHERE t <> ''
""")
def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants read back out of the addresses that five systems give them."""
    slugs = _rows(spark, sf_dir).filter("company is not null").select(F.regexp_replace(F.lower("company"), "[^a-z0-9]", "").alias("slug")).filter("slug <> ''").distinct()
    made = F.array(*[F.struct(F.lit(n).alias("system"), F.concat(F.lit(u.split("{}")[0]), F.col("slug"), F.lit(u.split("{}")[1])).alias("url")) for n, u in TENANT_URLS.items()])
    each = slugs.select("slug", F.explode(made).alias("m")).select("slug", "m.*")
    return each.select("system", "slug", boards.tenant(F.col("system"), F.lit(""), F.col("url")).alias("tenant"))


@query(f"""
WITH h AS (SELECT DISTINCT {q.host('job_link')} AS host, {q.origin('job_link')} AS o FROM upload_rows WHERE {q.is_url('job_link')})
SELECT DISTINCT host, coalesce(nullif(split_part(regexp_replace(host, '^www\\.', ''), '.', 1), ''), 'unknown') AS first_label FROM h
""")
def host_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company that each host's first label names."""
    link = F.col("job_link")
    return _rows(spark, sf_dir).filter(urls.is_url(link)).select(urls.host(link).alias("host"), urls.company_from_host(link).alias("first_label")).distinct()


_LABELS = "string_split(regexp_replace(" + q.host("company_website") + ", '^www\\.', ''), '.')"


@query(f"""
WITH l AS (SELECT row_id, {_LABELS} AS a FROM upload_rows WHERE {q.is_url('company_website')}),
o AS (SELECT row_id, list_filter(a[1:len(a) - 1], lambda x: x NOT IN ({q.names(urls.GENERIC_LABELS + urls.SHORT_LABELS)}))[1] AS n FROM l WHERE a[len(a)] = 'example')
SELECT row_id, upper(n[1:1]) || n[2:] AS company FROM o
""")
def url_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company that a website's own labels name."""
    site = F.col("company_website")
    rows = _rows(spark, sf_dir).filter(urls.is_url(site) & urls.host(site).endswith(".example"))
    return rows.select("row_id", urls.company_from_url(site).alias("company"))


@query(f"""
WITH t AS (SELECT raw_id, scraped_at, {q.trim('title')} AS raw, regexp_replace({q.trim('title')}, '^["''“”]+|["''“”]+$', '', 'g') AS t FROM raw_jobs WHERE title IS NOT NULL),
a AS (SELECT raw_id, scraped_at, raw, regexp_replace({q.trim('t')}, '[\\x{{1F000}}-\\x{{1FFFF}}\\x{{2600}}-\\x{{27BF}}\\x{{FE00}}-\\x{{FEFF}}]', ' ', 'g') AS t FROM t),
b AS (SELECT raw_id, scraped_at, raw, regexp_replace(regexp_replace(t, '(?i)[#(]?\\b(?:req|requisition|job|jr|r)\\s*[-#]?\\s*[0-9]{{3,}}\\b\\)?', ' ', 'g'), '\\(\\s*#?\\s*[0-9]{{3,}}\\s*\\)', ' ', 'g') AS t FROM a),
c AS (SELECT raw_id, scraped_at, raw, {q.trim("regexp_replace(regexp_replace(regexp_replace(t, '\\s[-–—]\\s*[0-9]{4,}\\s*$', ' ', 'g'), '\\s{2,}', ' ', 'g'), '^[\\s\\-–—|•,]+|[\\s\\-–—|•,]+$', '', 'g')")} AS t FROM b)
SELECT raw_id, scraped_at, CASE WHEN t = '' THEN raw ELSE t END AS title FROM c
""")
def clean_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without quotes, emoji, requisition numbers and stray separators."""
    return read_table(spark, sf_dir, "raw_jobs").filter("title is not null").select("raw_id", "scraped_at", tx.clean_title(F.col("title")).alias("title"))


@query(f"""
SELECT doc_id, {_mended('text')} AS mended, {q.collapse("regexp_replace(text, '[" + chr(92) + "x{1F000}-" + chr(92) + "x{1FFFF}" + chr(92) + "x{2600}-" + chr(92) + "x{27BF}" + chr(92) + "x{FE00}-" + chr(92) + "x{FEFF}]', ' ', 'g')")} AS no_emoji,
  substr({q.collapse("regexp_replace(text, '<[^>]+>', ' ', 'g')")}, 1, 500) AS snippet FROM documents WHERE text IS NOT NULL
""")
def text_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled sequences repaired, emoji taken out, and the snippet (its 500 characters are the feature) of each text."""
    t = F.col("text")
    return read_table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", tx.fix_mojibake(t).alias("mended"), tx.strip_emoji(t).alias("no_emoji"), tx.snippet(t).alias("snippet"))


_WRAPPED = "('&lt;p&gt;' || replace(coalesce(title, ''), '&', '&amp;amp;') || '&lt;/p&gt;' || chr(10) || '<br /> <br>' || coalesce(company, '') || '</p>' || chr(10) || ' <p>')"


@query(f"""
WITH w AS (SELECT row_id, {_WRAPPED} AS h FROM upload_rows)
SELECT row_id, {_replaced('h', list(tx.ENTITIES_TAGS_FIRST))} AS tags_first, {_replaced('h', list(tx.ENTITIES_AMP_FIRST))} AS amp_first,
  {q.trim("regexp_replace(regexp_replace(regexp_replace(h, '[" + chr(92) + "r" + chr(92) + "n]+', ' ', 'g'), '>" + chr(92) + "s+<', '><', 'g'), '" + chr(92) + "s{2,}', ' ', 'g')")} AS one_line, regexp_replace(h, '(?i)(?:<br\\s*/?>\\s*){{2,}}', '</p><p>', 'g') AS spaced FROM w
""")
def html_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities decoded in both orders, HTML in one line, and doubled breaks as paragraphs."""
    h = F.concat(
        F.lit("&lt;p&gt;"), F.replace(F.coalesce("title", F.lit("")), F.lit("&"), F.lit("&amp;amp;")), F.lit("&lt;/p&gt;\n<br /> <br>"), F.coalesce("company", F.lit("")), F.lit("</p>\n <p>")
    )
    rows = _rows(spark, sf_dir).select("row_id", h.alias("h"))
    c = F.col("h")
    return rows.select("row_id", tx.decode_entities(c).alias("tags_first"), tx.decode_entities(c, True).alias("amp_first"), tx.single_line_html(c).alias("one_line"), tx.paragraph_spacing(c).alias("spaced"))


@query(f"""
WITH k AS (SELECT DISTINCT x AS raw FROM (SELECT unnest(string_split(keywords, ',')) AS x FROM upload_rows WHERE keywords IS NOT NULL))
SELECT raw, {q.trim('raw')} <> '' AND NOT regexp_matches(raw, '<[^>]+>') AND length(raw) <= 50 AND NOT regexp_matches(lower(raw), '^(?:or|and|such as|with|including|ideally|preferably) ') AS valid,
  array_to_string(list_transform(string_split({q.collapse("regexp_replace(raw, '[-_]+', ' ', 'g')")}, ' '), lambda w: upper(w[1:1]) || w[2:]), ' ') AS named,
  length(replace(raw, ' ', '_')) > 50 OR regexp_matches(replace(raw, ' ', '_'), '^(?:the|a|of|with|and|or|in|for|is|are|as|at|to|that|this|ability|while|along|including|ideally|preferably|contributing|dealing|bachelor|experience)_')
    OR regexp_matches(replace(raw, ' ', '_'), '_(?:the|a|is|are|that|this|to|for|with|and|or|in|at|of)_') OR regexp_matches(replace(raw, ' ', '_'), '^-_|degr|_why_') AS phrase FROM k
""")
def keyword_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pieces of keyword lists are keywords, which are pieces of sentences, and their spelling as a name."""
    k = _rows(spark, sf_dir).filter("keywords is not null").select(F.explode(F.split("keywords", ",", -1)).alias("raw")).distinct()
    raw = F.col("raw")
    return k.select("raw", predicates.valid_keyword(raw).alias("valid"), tx.slug_to_name(raw).alias("named"), predicates.phrase_like(F.replace(raw, F.lit(" "), F.lit("_"))).alias("phrase"))


@query(f"""
WITH h AS (SELECT row_id, repeat('<i></i>', 400) || coalesce(description, '') AS h FROM upload_rows)
SELECT row_id, length({q.collapse("regexp_replace(h, '<[^>]+>', '', 'g')")}) < 500 AS shell FROM h
""")
def script_shells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a long page with a row's description would be taken for one that scripts fill."""
    page = F.concat(F.repeat(F.lit("<i></i>"), 400), F.coalesce("description", F.lit("")))
    return _rows(spark, sf_dir).select("row_id", predicates.is_script_shell(page).alias("shell"))


@query("""
WITH n AS (SELECT row_id, TRY_CAST(trim(number_of_positions) AS INTEGER) AS n, CAST(row_id % 28 + 1 AS INTEGER) AS d FROM upload_rows)
SELECT row_id, CASE WHEN n BETWEEN 1 AND 999 THEN n END AS positions, '2026-03-' || lpad(CAST(d AS VARCHAR), 2, '0') AS deadline FROM n
""")
def notice_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions and deadline out of sentences that are made of the rows' own numbers."""
    n = F.trim("number_of_positions").try_cast("int")
    text = F.concat(F.lit("We have "), F.coalesce(n.cast("string"), F.lit("many")), F.lit(" openings. Apply by March "), (F.col("row_id") % 28 + 1).cast("string"), F.lit(", 2026"))
    return _rows(spark, sf_dir).select("row_id", extract.positions(text).alias("positions"), extract.deadline(text).alias("deadline"))


_TYPE = f"upper({q.trim('job_type')})"


@query(f"""
SELECT row_id, CASE WHEN regexp_replace({_TYPE}, '[-_ ]', '', 'g') = 'OPENCALL' THEN 'OPEN_CALL' WHEN {_TYPE} IN ({q.names(list(vocab.JOB_TYPES))}) THEN {_TYPE} {' '.join(f"WHEN {_TYPE} = {q.text(k)} THEN '{v}'" for k, v in vocab.JOB_TYPE_MAP.items())} ELSE 'FULLTIME' END AS job_type,
  CASE WHEN mail THEN '' ELSE coalesce({q.trim('job_link')}, '') END AS link, mail AS by_email, CASE WHEN mail THEN {q.trim('work_email')} ELSE '' END AS email,
  CASE WHEN TRY_CAST({q.trim('number_of_positions')} AS DOUBLE) > 0 THEN TRY_CAST({q.trim('number_of_positions')} AS DOUBLE) ELSE 1 END AS positions, sha256(description) AS digest
FROM (SELECT *, coalesce(lower({q.trim('allow_email_applications')}) IN ('true', 'yes', '1') AND {q.trim('work_email')} <> '', false) AS mail FROM upload_rows)
""")
def upload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job type, way to apply, positions and digest as an upload takes them."""
    way = extract.apply_method(F.col("job_link"), F.col("work_email"), F.col("allow_email_applications"))
    rows = _rows(spark, sf_dir).select("row_id", extract.upload_job_type(F.col("job_type")).alias("job_type"), way.alias("w"), extract.positive_number(F.col("number_of_positions"), 1).alias("positions"), extract.content_hash(F.col("description")).alias("digest"))
    return rows.select("row_id", "job_type", "w.link", "w.by_email", "w.email", "positions", "digest")


@query("""
SELECT row_id, CASE WHEN row_id % 2 = 0 THEN title ELSE 'Lead ' || row_id END AS title, 'Berlin' AS city, CASE WHEN w IN ('REMOTE', '') THEN 'ONSITE' ELSE w END AS work_type, '1200' AS salary_min
FROM (SELECT *, CASE upper(trim(work_type)) WHEN 'HYBRID' THEN 'HYBRID' WHEN 'ON-SITE' THEN 'ONSITE' WHEN 'REMOTE' THEN 'REMOTE' ELSE '' END AS w FROM upload_rows WHERE coalesce(lower(trim(city)), '') <> 'berlin')
""")
def reply_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the merge makes of readable replies that move the place, name a salary, and every second title."""
    rows = _rows(spark, sf_dir).filter("coalesce(lower(trim(city)), '') <> 'berlin'")
    title = F.when(F.col("row_id") % 2 == 0, "INVALID").otherwise(F.concat(F.lit("Lead "), F.col("row_id").cast("string")))
    reply = F.concat(F.lit("Here it is:\n```json\n"), F.to_json(F.struct(title.alias("title"), F.lit("Berlin").alias("city"), F.lit("1200").alias("salaryMin"))), F.lit("\n```"))
    return enrich.merge(rows.withColumn("reply", enrich.parse_reply(reply)), "reply").select("row_id", "title", "city", "work_type", "salary_min")


# ---- runs and reports ----------------------------------------------------------


@query(f"""
WITH d AS (SELECT try_strptime(substr(trim(date_posted), 1, 10), '%Y-%m-%d') AS d FROM raw_jobs)
SELECT count_if(d >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) AS kept, count_if(d < TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) AS dropped, count_if(d IS NULL) AS undated FROM d
""")
def recency_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept, dropped and undated rows of a recency filter."""
    return runs.recency_counts(read_table(spark, sf_dir, "raw_jobs"), F.col("date_posted"), F.date_sub(F.lit(AS_OF).cast("date"), 30))


@query(f"""
WITH k AS (SELECT row_id, {q.dedup_key('job_link')} AS u, lower({q.trim('title')}) || '|' || lower({q.trim('company')}) AS c FROM upload_rows),
f AS (SELECT CASE WHEN u IS NULL THEN CAST(row_id AS VARCHAR) || '#' ELSE u END AS u, count(*) AS n, min(c) AS c FROM k GROUP BY 1), x AS (SELECT c, sum(n) AS n, count(*) AS f FROM f GROUP BY c)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - f) AS BIGINT) AS url_repeats, CAST(sum(CASE WHEN c IS NULL THEN 0 ELSE f - 1 END) AS BIGINT) AS cross_repeats FROM x
""")
def removed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the two deduplications by address, and by title and company, take away."""
    cross = F.concat(F.lower(tx.trim(F.col("title"))), F.lit("|"), F.lower(tx.trim(F.col("company"))))
    return runs.removed_counts(_rows(spark, sf_dir), urls.dedup_key(F.col("job_link")), cross)


_SLUG = f"lower({q.host('job_link')} || '/' || coalesce({q.segments('job_link')}[1], ''))"


@query(f"""
WITH f AS (SELECT {q.host('job_link')} AS host, {_SLUG} AS k FROM upload_rows WHERE batch_no > 0 AND {q.is_url('job_link')}), o AS (SELECT DISTINCT {_SLUG} AS k FROM upload_rows WHERE batch_no = 0 AND {q.is_url('job_link')})
SELECT host, count(*) AS captured, count(DISTINCT f.k) AS "unique", count(DISTINCT CASE WHEN o.k IS NULL THEN f.k END) AS "new" FROM f LEFT JOIN o ON o.k = f.k GROUP BY host
""")
def discovery_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of the new batches by host: captured, distinct tenants, and those that history lacks."""
    rows = _rows(spark, sf_dir).filter(urls.is_url(F.col("job_link"))).select("batch_no", urls.host(F.col("job_link")).alias("host"), urls.host_slug(F.col("job_link")).alias("slug"))
    return runs.discovery_stats(rows.filter("batch_no > 0"), rows.filter("batch_no = 0"), "host", "slug")


@query("""
WITH l AS (SELECT source_url, max(CASE WHEN len(creative_jobs) > 0 THEN scrape_id END) AS f FROM scrape_results GROUP BY source_url)
SELECT s.source_url, count(*) AS empty_runs FROM scrape_results s JOIN l ON l.source_url = s.source_url WHERE f IS NULL OR scrape_id > f GROUP BY s.source_url HAVING count(*) >= 1
""")
def silent_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose latest runs brought no posting of the trade, and how many those were."""
    return runs.silent_sources(read_table(spark, sf_dir, "scrape_results"), "source_url", F.size("creative_jobs"), F.col("scrape_id"), 1)


@query("""
WITH s AS (SELECT source_url, max_by(jobs_count, scrape_id) AS n, max_by(len(creative_jobs), scrape_id) AS k FROM scrape_results GROUP BY source_url), l AS (SELECT DISTINCT source_url FROM raw_jobs)
SELECT source_url FROM l LEFT JOIN s USING (source_url) WHERE n IS NULL OR (n > 0 AND k > 0)
""")
def kept_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed sources that stay: those with postings, then those that were not scraped."""
    stats = curate.source_stats(read_table(spark, sf_dir, "scrape_results"), F.lit(1), 1, F.col("scrape_id"))
    return runs.kept_list(curate.prune(read_table(spark, sf_dir, "raw_jobs").select("source_url").distinct(), stats))


@query(f"""
WITH s AS (SELECT row_id, {q.text_score("coalesce(title, '')")} AS score FROM upload_rows) SELECT row_id, score, row_number() OVER (ORDER BY score, row_id) - 1 AS place FROM s
""")
def score_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the order of a scored file: lowest score first, ties as they came."""
    scored = _rows(spark, sf_dir).select("row_id", predicates.text_score(F.coalesce("title", F.lit(""))).alias("score"))
    return layout.with_position(scored, ["score", "row_id"], "place").select("row_id", "score", "place")


@query(f"""
WITH a AS (SELECT row_id, max_by(upper(verdict), review_id) AS v, max_by(coalesce(notes, ''), review_id) AS n FROM review_entries WHERE row_id IS NOT NULL GROUP BY row_id),
b AS (SELECT {q.loose_key('url')} AS k, max_by(upper(verdict), review_id) AS v FROM review_entries WHERE row_id IS NULL AND trim(url) <> '' GROUP BY 1)
SELECT u.row_id, coalesce(a.v, b.v, 'REVIEW') AS status, coalesce(a.n, '') AS notes FROM upload_rows u LEFT JOIN a ON a.row_id = u.row_id LEFT JOIN b ON b.k = {q.loose_key('u.job_link')}
""")
def reviewed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and notes of each row: by its number, else by its address among the entries without one, else open."""
    e = read_table(spark, sf_dir, "review_entries")
    a = e.filter("row_id is not null").groupBy("row_id").agg(F.max_by(F.upper("verdict"), "review_id").alias("v"), F.max_by(F.coalesce("notes", F.lit("")), "review_id").alias("n"))
    b = e.filter("row_id is null and trim(url) <> ''").groupBy(urls.loose_key(F.col("url")).alias("k")).agg(F.max_by(F.upper("verdict"), "review_id").alias("w"))
    rows = _rows(spark, sf_dir).select("row_id", urls.loose_key(F.col("job_link")).alias("k")).join(a, "row_id", "left").join(b, "k", "left")
    return rows.select("row_id", F.coalesce("v", "w", F.lit("REVIEW")).alias("status"), F.coalesce("n", F.lit("")).alias("notes"))


@query("SELECT DISTINCT user_id, event_type FROM events WHERE ts IS NOT NULL")
def stream_first_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user and type once, by the stream that remembers what it has seen."""
    import uuid

    schema = read_table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    first = streams.first_seen(stream.select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts")
    return streams.drained(first, f"stream_first_keys_{uuid.uuid4().hex[:8]}").select("user_id", "event_type")


@query("""
WITH j AS (SELECT unnest(creative_jobs) AS j FROM scrape_results WHERE len(creative_jobs) > 0)
SELECT j.title AS title, j.url AS url, coalesce(j.location_text, 'Not specified') AS location, coalesce(j.company, 'unknown') AS company, count(*) AS copies FROM j WHERE j.title IS NOT NULL AND regexp_matches(j.url, '(?i)^https?://') GROUP BY ALL
""")
def defaulted_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of the stored results with a title and an address, open fields filled."""
    j = read_table(spark, sf_dir, "scrape_results").select(F.explode("creative_jobs").alias("j")).select("j.*")
    filled = readers.with_defaults(j.select("title", "url", F.col("location_text").alias("location"), "company", "ats", F.col("source_url").alias("source")))
    return filled.groupBy("title", "url", "location", "company").agg(F.count("*").alias("copies"))
