"""Row predicates as Spark columns; a null input makes none of them true."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import urls, vocab
from postloom.functions.text import trim
from postloom.functions.vocab import words


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def title_loose(title: Column, terms: list[str] = vocab.LOOSE_TITLE_TERMS) -> Column:
    """A term of the trade stands in the title."""
    return _true(title.rlike(words(terms)))


def title_strict(title: Column) -> Column:
    """A term of the trade, and no other trade unless a saving term stands beside it."""
    t = trim(title)
    return _true(t.rlike(words(vocab.STRICT_TITLE_TERMS)) & ~(t.rlike(words(vocab.OTHER_TRADE_TERMS)) & ~t.rlike(words(vocab.SAVING_TERMS))))


def text_score(text: Column) -> Column:
    """From -2 to 5: terms for and against the trade anywhere in a text."""

    def has(terms: list[str], points: int) -> Column:
        return F.when(text.rlike(words(terms)), points).otherwise(0)

    return has(vocab.STRICT_TITLE_TERMS, 2) + has(vocab.SKILL_TERMS, 2) + has(vocab.GENERIC_TERMS, 1) + has(vocab.AGAINST_TERMS, -2)


def combined(title: Column, description: Column, url: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")), F.coalesce(url, F.lit("")))


def gate(title: Column, description: Column, url: Column, least: int = 2) -> Column:
    """Strict title, and enough of a text score over title, description and address."""
    return title_strict(title) & (text_score(combined(title, description, url)) >= least)


def form_text(text: Column) -> Column:
    """A description that is an application form."""
    return _true(text.rlike("(?i)apply for this job|autofill with|accepted file types"))


def known_host(url: Column) -> Column:
    return _true(urls.host(url).rlike(vocab.KNOWN_HOSTS))


def job_path(url: Column) -> Column:
    return _true(url.rlike("(?i)/(?:jobs?|careers?|positions?|openings?)(?![A-Za-z0-9_])"))


def other_path(url: Column) -> Column:
    return _true(url.rlike("(?i)/(?:services?|portfolio|case-studies|case-study|case-studie|blog|news|insights|articles?|about|contact)(?![A-Za-z0-9_])"))


def rescue(title: Column, seed: Column, description: Column, url: Column, least: int = 2) -> Column:
    """Struct of keep, title and whether the description is weak.

    What fails the gate is kept under its seed title when that is strict and
    the description is weak or the address looks like a posting.
    """
    weak = (F.length(F.coalesce(trim(description), F.lit(""))) < 60) | form_text(description)
    facts = F.struct(gate(title, description, url, least).alias("passed"), title_strict(seed).alias("strict"), weak.alias("weak"), (known_host(url) | job_path(url)).alias("posting"))

    def verdict(f: Column) -> Column:
        saved = ~f["passed"] & f["strict"] & (f["weak"] | f["posting"])
        return F.struct((f["passed"] | saved).alias("keep"), F.when(saved, seed).otherwise(title).alias("title"), (saved & f["weak"]).alias("placeholder"))

    return urls.let(facts, verdict)


def noise_title(title: Column) -> Column:
    return _true(F.lower(trim(title)).rlike(vocab.NOISE_TITLE))


def _titled(title: Column) -> Column:
    t = trim(title)
    return _true((F.length(t) >= 3) & (F.length(t) <= 180)) & ~noise_title(title)


def _path(url: Column) -> Column:
    p = F.lower(F.regexp_replace(urls.path(url), "/+$", ""))
    return F.when(p == "", "/").otherwise(p)


# Paths of listings, for the strict and the loose test.
LISTING = r"^/(?:jobs|job|careers|career|search|search-results|open-positions|opportunities|teams|departments)$|^/c/[a-z0-9-]+-jobs$"
LISTING_LOOSE = r"^/(?:jobs|job|careers|career|search|search-results|open-positions|opportunities)$|^/c/[a-z0-9-]+-jobs$"


def posting_strict(title: Column, url: Column) -> Column:
    """A row that is a posting by its address: the rules apply in this order."""
    p, h = _path(url), urls.host(url)
    q = F.concat(F.lit("?"), F.lower(urls.query(url)))
    depth = F.size(urls.segments(url))
    known = known_host(url)
    rules = (
        F.when(~_titled(title) | ~urls.is_url(url), False)
        .when(p.rlike(LISTING), False)
        .when(p.rlike("/jobdetail/"), True)
        .when(q.rlike("[?&](?:gh_jid|jobid|job_id|job|posting|postingid|requisition|reqid)="), True)
        .when(known & p.rlike("/jobs?/"), True)
        .when(known & h.rlike(r"jobs\.lever\.co|jobs\.smartrecruiters\.com|ashbyhq\.com") & (depth >= 2), True)
        .when(known & h.rlike(r"myworkdayjobs\.com") & p.rlike("/job/|/apply$"), True)
        .when(p.rlike("/jobs?/[^/]*[0-9][^/]*$"), True)
        .when(p.rlike("/job/[a-z0-9-]{6,}$"), True)
        .when(p.rlike("/details/[0-9]+"), True)
        .when(title.rlike(words(vocab.ROLE_TERMS)) & p.rlike("/jobs?/|/position/|/opening/|/requisition/"), True)
    )
    return _true(rules.otherwise(False))


def posting_loose(title: Column, url: Column) -> Column:
    """The weaker test: a role word in the title is needed, more addresses are accepted."""
    p = F.lower(urls.path(url))
    q = F.concat(F.lit("?"), F.lower(urls.query(url)))
    rules = (
        F.when(~_titled(title) | ~title.rlike(words(vocab.ROLE_TERMS)), False)
        .when(~urls.is_url(url) | ~F.coalesce(urls.scheme(url), F.lit("")).isin("http", "https"), False)
        .when((p == "/") | p.rlike("/(?:privacy|terms|about|contact|news|press|investor|team|teams|locations)(?![A-Za-z0-9_])"), False)
        .when(p.rlike(LISTING_LOOSE), False)
        .when(known_host(url) & (F.size(urls.segments(url)) >= 2), True)
        .when(p.rlike("/jobdetail/|/jobs?/[^/]*[0-9]|/job/[a-z0-9-]{6,}|/details/[0-9]+"), True)
        .when(q.rlike("[?&](?:jobid|job_id|job|posting|requisition|reqid)="), True)
        .when(p.rlike("job|career|position|opening|opportunit|vacanc|requisition"), True)
    )
    return _true(rules.otherwise(False))


def skip_before_fetch(title: Column, url: Column) -> Column:
    """Rows not worth a closer look: noise, collections, agencies, portfolios, news, listing pages without a number."""
    t = F.lower(trim(title))
    return _true(t.isin(*vocab.SKIP_TITLES)) | _true(F.lower(title).rlike("|".join(f"(?:{p})" for p in vocab.SKIP_PATTERNS))) | (urls.is_listing(url) & ~urls.has_id_signal(url))


def invalid_title(title: Column) -> Column:
    return _true(F.lower(trim(title)).rlike("|".join(vocab.INVALID_TITLES)))


def specific_url(url: Column) -> Column:
    return _true(F.lower(url).rlike(vocab.SPECIFIC_URL))


def recent(day: Column, cutoff: Column) -> Column:
    """Undated rows stay, dated ones from the cutoff on; unreadable dates go."""
    return day.isNull() | _true(F.try_to_timestamp(day) >= cutoff)


def recent_day(created: Column, posted: Column, cutoff: Column) -> Column:
    """The first ten characters of the one date or the other; unreadable dates stay."""
    day = F.coalesce(F.nullif(trim(created), F.lit("")), F.nullif(trim(posted), F.lit("")))
    parsed = F.try_to_date(F.substring(day, 1, 10), "yyyy-MM-dd")
    return parsed.isNull() | (parsed >= cutoff)


def plausible_place(text: Column) -> Column:
    noise = f"(?i){vocab.OPEN}(?:{'|'.join(map(vocab.escaped, vocab.LOCATION_NOISE))})"
    return _true((F.length(text) > 0) & (F.length(text) <= 90) & ~text.rlike(noise) & ~text.rlike("[{}<>]") & ((F.size(F.split(text, r"\s+")) <= 8) | text.rlike(words(["remote"]))))


def valid_keyword(k: Column) -> Column:
    return (trim(k) != "") & ~k.rlike("<[^>]+>") & (F.length(k) <= 50) & ~F.lower(k).rlike("^(?:or|and|such as|with|including|ideally|preferably) ")


def phrase_like(s: Column) -> Column:
    """A skill that is a piece of a sentence (words joined by underscores)."""
    return (
        (F.length(s) > 50)
        | s.rlike("^(?:the|a|of|with|and|or|in|for|is|are|as|at|to|that|this|ability|while|along|including|ideally|preferably|contributing|dealing|bachelor|experience)_")
        | s.rlike("_(?:the|a|is|are|that|this|to|for|with|and|or|in|at|of)_")
        | s.rlike("^-_|degr|_why_")
    )


def is_script_shell(html: Column) -> Column:
    """A long page with little visible text, which a script fills later."""
    from postloom.functions.text import html_to_text

    return _true((F.length(html) > 2000) & (F.length(html_to_text(html)) < 500))


# Titles that are dropped whatever the address says (a parameter of the function).
DROPPED_TITLES = ("job not available",)
# Openings of titles that name no posting.
UNREAL_TITLE = r"(?i)^(?:careers|jobs|home|404|error|cookie|login|select|current openings|open roles)"
# Patterns that a quality check flags for a closer look.
QC_PATTERNS = {
    "model_training": r"rlhf|train (?:the|our) (?:ai|model|llm)|data annotat|ai trainer|ai rater|human feedback|label images for|improve our model|outlier|scale ai|remotasks",
    "unpaid": r"unpaid|volunteer|for exposure|stipend only|no compensation",
    "not_remote": r"on-site only|onsite only|must be located in|relocation required|hybrid.{0,20}office",
}
# Hosts whose pages a script fills, and first labels of hosts that often embed them.
SCRIPTED_HOSTS = "greenhouse.io lever.co smartrecruiters.com myworkdayjobs.com workdayjobs.com icims.com ashbyhq.com phenompeople.com amazon.jobs workable.com".split()
SCRIPTED_LABELS = "careers career jobs job apply hire".split()


def always_dropped(title: Column, titles: tuple[str, ...] = DROPPED_TITLES) -> Column:
    return _true(F.lower(trim(title)).isin(*titles))


def drop_honoured(reason: Column, title: Column, url: Column, final: tuple[str, ...] = ("GENAI_COMPANY",), titles: tuple[str, ...] = DROPPED_TITLES) -> Column:
    """Whether a reply's wish to drop a row is followed: always for a final reason, else only if neither title nor address look like a posting."""
    real_title = _true(F.length(title) > 3) & ~_true(trim(title).rlike(UNREAL_TITLE)) & ~always_dropped(title, titles)
    return _true(reason.isin(*final)) | (~real_title & ~specific_url(url))


def qc_flags(text: Column) -> Column:
    """Struct of the flags of ``QC_PATTERNS``."""
    return F.struct(*[_true(text.rlike(f"(?i){p}")).alias(name) for name, p in QC_PATTERNS.items()])


def age_verdict(posted: Column, today: Column, most: int = 10) -> Column:
    """REJECT for postings of more than ``most`` days, REVIEW where the day is unknown, else PASS."""
    age = F.datediff(today, posted)
    return F.when(age.isNull(), "REVIEW").when(age > most, "REJECT").otherwise("PASS")


def needs_browser(url: Column) -> Column:
    """Whether a page of the address is usually filled by scripts."""
    h = urls.host(url)
    labels = F.split(h, r"\.")
    return _true(h.rlike("|".join(vocab.escaped(x) for x in SCRIPTED_HOSTS)) | ((F.size(labels) >= 3) & labels[0].isin(*SCRIPTED_LABELS)))
