"""What an address and a page say about the hiring system behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import urls, vocab
from postloom.functions.text import trim

NAME = "([a-z0-9_-]+)"
# Where each system's tenant stands, best place first.
TENANT_PLACES = {
    "greenhouse": (rf"boards\.greenhouse\.io/{NAME}", rf"job-boards\.greenhouse\.io/{NAME}", rf"embed/job_board\?for={NAME}"),
    "lever": (rf"jobs\.lever\.co/{NAME}", rf"api\.lever\.co/v0/postings/{NAME}"),
    "smartrecruiters": (rf"careers\.smartrecruiters\.com/{NAME}", rf"smartrecruiters\.com/{NAME}/jobs"),
    "workday": (rf"/wday/cxs/{NAME}/[a-z0-9_-]+/jobs", r"https?://([a-z0-9-]+)\.wd[0-9]+\.myworkdayjobs\.com", rf"myworkdayjobs\.com/{NAME}"),
    "icims": (r"//([a-z0-9-]+)\.icims\.com", "clientid=([a-z0-9-]+)"),
    "ashby": (rf"jobs\.ashbyhq\.com/{NAME}", rf"api\.ashbyhq\.com/posting-api/job-board/{NAME}"),
    "workable": (rf"apply\.workable\.com/{NAME}", rf"workable\.com/api/accounts/{NAME}", rf"jobs\.workable\.com/{NAME}", rf"{NAME}\.workable\.com"),
    "phenom": (rf'"refnum"\s*:\s*"{NAME}"', rf"content-us\.phenompeople\.com/api/{NAME}/"),
}
ENDPOINT = r"https?://[^\"'\s<>]+/wday/cxs/[^\"'\s<>]+/jobs(?:\?[^\"'\s<>]*)?"
RELATIVE_ENDPOINT = r"(?<![\w.:/-])/wday/cxs/[^\"'\s<>]+/jobs(?:\?[^\"'\s<>]*)?"


def _first(text: Column, patterns: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns])


def tenant(system: Column, html: Column, url: Column) -> Column:
    """The tenant of a page's system; the host itself where a system has none, null where nothing names one."""
    text = F.lower(F.concat_ws("\n", html, url))
    out = F.when(system == "amazon", F.regexp_replace(urls.host(url), r"^www\.", ""))
    for name, patterns in TENANT_PLACES.items():
        out = out.when(system == name, _first(text, patterns))
    return out


def tenant_of_source(jobs: DataFrame, system: str, ordinal: Column) -> DataFrame:
    """(source_url, tenant): of each source the tenant that the first job with one names."""
    named = jobs.select("source_url", ordinal.alias("o"), _first(F.lower("url"), TENANT_PLACES[system]).alias("tenant")).filter("tenant is not null")
    return named.groupBy("source_url").agg(F.min_by("tenant", "o").alias("tenant"))


def endpoints(system: Column, html: Column, url: Column, tenant_col: Column) -> Column:
    """Distinct search endpoints that a page names, or the system's usual ones for its host."""
    page = F.regexp_replace(F.replace(F.coalesce(html, F.lit("")), F.lit("\\u0026"), F.lit("&")), r"\\", "")
    named = F.array_distinct(F.concat(F.regexp_extract_all(page, F.lit(f"({ENDPOINT})"), 1), F.transform(F.regexp_extract_all(page, F.lit(f"({RELATIVE_ENDPOINT})"), 1), lambda p: F.concat(urls.origin(url), p))))
    host = urls.host(url)
    usual = F.when(host.endswith("myworkdayjobs.com") & tenant_col.isNotNull(), F.array(*[F.concat(F.lit("https://"), host, F.lit("/wday/cxs/"), tenant_col, F.lit(f"/{site}/jobs")) for site in ("External", "Careers")]))
    search = F.array_distinct(F.regexp_extract_all(page, F.lit(r"(https?://[^\"'\s<>]*icims\.com/jobs/search[^\"'\s<>]*)"), 1))
    icims = F.when(F.size(search) > 0, search).when(host.contains("icims.com"), F.array(F.concat(F.lit("https://"), host, F.lit("/jobs/search?ss=1"))))
    none = F.array().cast("array<string>")
    return F.when(system == "workday", F.when(F.size(named) > 0, named).otherwise(F.coalesce(usual, none))).when(system == "icims", F.coalesce(icims, none)).otherwise(none)


def raw_links(html: Column, base: Column) -> Column:
    """Distinct addresses of postings anywhere in a page's source, escaped ones included."""
    whole = F.regexp_extract_all(html, F.lit(r"((?i)https?:(?:\\?/){2}[^\s\"<>]+)"), 1)
    part = F.regexp_extract_all(html, F.lit(r"((?i)(?<![\w.:/-])/(?:jobs?/[0-9]{3,}[^\s\"<>]*|job/[^\s\"<>]{8,}|search/jobdetail/[^\s\"<>]+))"), 1)

    def plain(link: Column) -> Column:
        return trim(F.regexp_replace(F.regexp_replace(F.replace(link, F.lit("\\"), F.lit("")), "(?i)&quot;", ""), "(?i)&amp;", "&"))

    found = F.filter(F.transform(F.concat(whole, part), plain), lambda u: u.rlike(r"(?i)/job/|/jobs?/[0-9]|/search/jobdetail/"))
    return F.array_distinct(F.filter(F.transform(found, lambda u: urls.absolute(u, base)), lambda u: u.isNotNull()))


def crawl_allowed(candidate: Column, root: Column) -> Column:
    """The same host, a hiring system, or the jobs or careers host of the same company."""
    a, b = urls.host(candidate), urls.host(root)
    base = urls.base_domain(F.regexp_replace(b, r"^www\.", ""))
    ours = (a == base) | a.endswith(F.concat(F.lit("."), base))
    known = a.rlike(rf"(?:{vocab.KNOWN_HOSTS}|phenompeople\.com)$")
    return F.coalesce((a == b) | known | (ours & a.rlike(r"^(?:jobs|careers)\.")), F.lit(False))


def try_urls(url: Column) -> Column:
    """Distinct addresses under which a posting's page may be found, in the order of trying."""
    clean = urls.canonical(url)
    bare = F.regexp_replace(clean, r"(?i)/(?:apply|application)/?$", "")
    old_board = F.when(urls.host(clean).endswith("job-boards.greenhouse.io"), F.regexp_replace(clean, "(?i)job-boards\\.greenhouse\\.io", "boards.greenhouse.io"))
    new_board = F.when(urls.host(clean).rlike(r"(?:^|\.)boards\.greenhouse\.io$"), F.regexp_replace(clean, "(?i)//boards\\.greenhouse\\.io", "//job-boards.greenhouse.io"))
    # a board's own tracking parameters
    plain = F.regexp_replace(F.regexp_replace(clean, r"(?i)(?<=[?&])lever-(?:source|via)=[^&]*&?", ""), "[?&]$", "")
    lever = F.when(urls.host(clean).endswith("jobs.lever.co"), plain)
    tries = F.array(trim(url), clean, bare, F.regexp_replace(bare, r"\?.*$", ""), old_board, new_board, lever)
    return F.array_distinct(F.filter(tries, lambda u: u.isNotNull() & (u != "")))


def first_page(tries: DataFrame, pages: DataFrame, least: int = 200) -> DataFrame:
    """(row_id, url, html): of the addresses of each row (row_id, tries) the first whose stored page has ``least`` characters.

    An address meets its page by an equi-join; the winner is a minimum over the
    order of trying, so no task holds a row's pages together.
    """
    each = tries.select("row_id", F.posexplode("tries").alias("nth", "url"))
    held = pages.filter(F.length("html") >= least).select("url", "html")
    return each.join(held, "url").groupBy("row_id").agg(F.min_by(F.struct("url", "html"), "nth").alias("p")).select("row_id", "p.url", "p.html")


def crawl(pages: DataFrame, seeds: DataFrame, rounds: int = 8) -> DataFrame:
    """(root, url, depth): stored pages reached from the seeds over allowed links, each once at its least depth.

    ``pages`` has url and links (array of addresses); ``seeds`` has root.  A
    round joins the newest pages with their links; visited addresses leave by
    an anti-join, and each round is checkpointed.
    """
    from postloom.session import cut

    reached = cut(seeds.select("root", urls.canonical(F.col("root")).alias("url")).distinct().withColumn("depth", F.lit(0)))
    newest = reached
    links = pages.select(urls.canonical(F.col("url")).alias("url"), F.explode("links").alias("next"))
    for depth in range(1, rounds + 1):
        step = newest.join(links, "url").filter(crawl_allowed(F.col("next"), F.col("root"))).select("root", urls.canonical(F.col("next")).alias("url")).distinct()
        newest = cut(step.join(reached.select("root", "url"), ["root", "url"], "left_anti").withColumn("depth", F.lit(depth)))
        if newest.isEmpty():
            break
        reached = cut(reached.unionByName(newest))
    return reached
