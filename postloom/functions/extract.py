"""Fields read out of free text, as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import vocab
from postloom.functions.predicates import plausible_place
from postloom.functions.text import collapse, trim
from postloom.functions.urls import let
from postloom.functions.vocab import CLOSE, OPEN, words

# How pay ranges and dates are written.
MONEY = r"([0-9]{2,3}(?:,[0-9]{3})*(?:\.[0-9]+)?[kKmM]?)"
RANGE = rf"(?i)([$€£])\s?{MONEY}\s*(?:-|to)\s*(?:[$€£])?\s?{MONEY}\s*(?:per|/)?\s*(hour|day|week|month|year|annual)?"
DATE_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss[.SSS][.SSSSSS]X", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MMMM d, yyyy", "MMMM d yyyy", "MMM d, yyyy", "MMM d yyyy", "MMMM yyyy", "d MMM yyyy")


def system(text: Column) -> Column:
    """The hiring system whose sign comes first in the fixed order, ``generic`` without any."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = None
    for name, signs in vocab.SYSTEM_SIGNS:
        hit = None
        for sign in signs.split("; "):
            one = low.contains(sign)
            hit = one if hit is None else hit | one
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("generic")


def job_type(title: Column, description: Column, employment: Column | None = None) -> Column:
    text = F.lower(F.concat_ws(" ", *([employment] if employment is not None else []), title, description))
    return (
        F.when(text.rlike(f"{OPEN}(?:intern|internship|temporary|fixed[- ]term|contract){CLOSE}"), "GIG")
        .when(text.rlike(f"{OPEN}part[- ]?time{CLOSE}"), "PARTTIME")
        .when(text.rlike(f"{OPEN}(?:freelance|contractor){CLOSE}"), "FREELANCE")
        .otherwise("FULLTIME")
    )


def job_type_value(raw: Column) -> Column:
    """A typed job type as one of the four values; what is unknown counts as full time."""
    up = F.upper(trim(raw))
    known = F.create_map(*[F.lit(x) for pair in vocab.JOB_TYPE_MAP.items() for x in pair])
    return F.when(up.isin(*vocab.JOB_TYPES), up).otherwise(F.coalesce(F.try_element_at(known, up), F.lit("FULLTIME")))


def work_type(title: Column, description: Column, address: Column) -> Column:
    text = F.lower(F.concat_ws(" ", title, description, address))
    return (
        F.when(text.rlike(words(["remote", "work from home", "distributed"])), "REMOTE")
        .when(text.rlike(words(["hybrid", "flexible office"])), "HYBRID")
        .when(text.rlike(f"{OPEN}(?:on[- ]?site|in office|studio based){CLOSE}"), "ONSITE")
    )


def work_type_value(raw: Column) -> Column:
    up = F.upper(F.coalesce(trim(raw), F.lit("")))
    return (
        F.when(up.isin("ONSITE", "HYBRID", "REMOTE"), up)
        .when(up.rlike(r"REMOTE|WORK\s*FROM\s*HOME|TELECOMMUTE"), "REMOTE")
        .when(up.contains("HYBRID"), "HYBRID")
        .when(up.rlike(r"ON\s*-?\s*SITE|IN\s*OFFICE"), "ONSITE")
        .otherwise("")
    )


def _money(token: Column) -> Column:
    low = F.lower(F.regexp_replace(token, ",", ""))
    factor = F.when(low.endswith("k"), 1000.0).when(low.endswith("m"), 1_000_000.0).otherwise(1.0)
    return F.regexp_replace(low, "[km]$", "").try_cast("double") * factor


def salary(text: Column) -> Column:
    """Struct of min, max, currency and period of the first pay range, null without one."""
    def group(k: int) -> Column:
        return F.nullif(F.regexp_extract(text, RANGE, k), F.lit(""))

    low, high, unit = _money(group(2)), _money(group(3)), F.lower(group(4))
    period = (
        F.when(unit == "hour", "HOURLY").when(unit == "day", "DAILY").when(unit == "week", "WEEKLY").when(unit == "month", "MONTHLY").when(unit.isin("year", "annual"), "ANNUAL")
        .when(low >= 10000, "ANNUAL").when(low >= 1000, "MONTHLY").when(low >= 100, "DAILY").otherwise("HOURLY")
    )
    currency = F.when(group(1) == "€", "EUR").when(group(1) == "£", "GBP").otherwise("USD")
    return F.when(low.isNotNull(), F.struct(low.alias("min"), high.alias("max"), currency.alias("currency"), period.alias("period")))


def keyword_terms(title: Column, description: Column, limit: int = 20) -> Column:
    """Keyword terms that occur anywhere in title or description, in the list's order."""
    text = F.lower(F.concat_ws(" ", title, description))
    found = F.filter(F.array(*[F.when(text.contains(t), t) for t in vocab.KEYWORD_TERMS]), lambda t: t.isNotNull() & ~t.isin(*vocab.KEYWORD_BLOCKLIST))
    return F.slice(found, 1, limit)


def taxonomy_hits(text: Column) -> Column:
    """Skills whose words stand in the text, in the taxonomy's order."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.array(*[F.when(low.rlike(words(w)), name) for name, w in vocab.SKILL_TAXONOMY.items()]), lambda s: s.isNotNull())


def day(raw: Column) -> Column:
    """A date in one of the usual forms as ``yyyy-MM-dd``; null where it cannot be read."""
    text = trim(raw)
    return F.date_format(F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]), "yyyy-MM-dd")


def deadline(text: Column) -> Column:
    """The day after "apply by", "application deadline" or "deadline"."""
    found = F.regexp_extract(text, rf"(?i){OPEN}(?:apply by|application deadline|deadline)\s*[:\-]?\s*([A-Za-z]{{3,9}}\s+[0-9]{{1,2}},?\s+[0-9]{{4}})", 1)
    return day(F.nullif(found, F.lit("")))


def positions(text: Column) -> Column:
    found = F.regexp_extract(text, rf"(?i){OPEN}([0-9]{{1,3}})\s+(?:openings?|positions?){CLOSE}", 1).try_cast("int")
    return F.when(found > 0, found)


def email(text: Column) -> Column:
    """The first address that belongs to a person or a hiring desk: links before plain text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    links = F.regexp_extract_all(low, F.lit(r"mailto:([^\"'?\s>]+)"), 1)
    plain = F.regexp_extract_all(low, F.lit(r"([a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,})"), 1)
    return F.get(F.filter(F.array_distinct(F.concat(links, plain)), lambda e: ~e.rlike(vocab.GENERIC_MAILBOX)), F.lit(0))


def _in(values: list[str], c: Column) -> Column:
    return F.coalesce(c.isin(*values), F.lit(False))


def location(raw: Column) -> Column:
    """Struct of name, address, city, state and country of a typed place, null where it says nothing.

    Remote places keep their region; lists give their first plausible place;
    states and provinces imply their country; country codes are spelled out.
    """
    codes = F.create_map(*[F.lit(x) for pair in vocab.COUNTRIES.items() for x in pair])
    blank = F.lit("")

    def made(name: Column, address: Column, city: Column, state: Column, country: Column) -> Column:
        return F.struct(name.alias("name"), address.alias("address"), city.alias("city"), state.alias("state"), country.alias("country"))

    def filled(*parts: Column) -> Column:
        return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), ", ")

    def remote(text: Column) -> Column:
        def of(region: Column) -> Column:
            return made(
                F.when(region != "", F.concat(F.lit("Remote ("), region, F.lit(")"))).otherwise("Remote"),
                F.when(region != "", F.concat(F.lit("Remote - "), region)).otherwise("Remote"),
                F.lit("Remote"), region, F.when(region.isin("US", "USA"), "United States").otherwise(""),
            )

        return let(F.upper(F.regexp_extract(text, rf"(?i)remote\s*[-:,]?\s*({'|'.join(vocab.REMOTE_REGIONS)})", 1)), of)

    def finished(candidate: Column, city: Column, state: Column, country: Column) -> Column:
        def spelled(land: Column) -> Column:
            parsed = made(filled(city, F.when(state != "", state).otherwise(land)), candidate, city, state, land)
            whole = made(candidate, candidate, candidate, blank, blank)
            return F.when(plausible_place(filled(city, state, land)), parsed).otherwise(whole)

        return let(F.when((country != "") & (F.length(country) <= 3), F.coalesce(F.try_element_at(codes, F.upper(trim(country))), country)).otherwise(country), spelled)

    def with_tail(candidate: Column, one: Column, state: Column, country: Column) -> Column:
        """A state or country code at the end of the city, where no state is given."""

        def of(tail: Column) -> Column:
            has = (state == "") & (tail != "")
            us, ca = has & _in(vocab.US_STATES, tail), has & _in(vocab.CA_PROVINCES, tail)
            city = F.when(has, trim(F.regexp_extract(one, r"^(.+?)\s+([A-Za-z]{2,3})$", 1))).otherwise(one)
            land = F.when(us, "United States").when(ca, "Canada").when(has, F.coalesce(F.try_element_at(codes, tail), tail)).otherwise(country)
            return let(F.struct(city.alias("c"), F.when(us | ca, tail).otherwise(state).alias("s"), land.alias("l")), lambda p: finished(candidate, p["c"], p["s"], p["l"]))

        return let(F.upper(F.regexp_extract(one, r"^(.+?)\s+([A-Za-z]{2,3})$", 2)), of)

    def from_chunks(candidate: Column, chunks: Column) -> Column:
        def of(p: Column) -> Column:
            pair, up = p["n"] == 2, p["up"]
            us, ca = pair & _in(vocab.US_STATES, up), pair & _in(vocab.CA_PROVINCES, up)
            code = pair & (F.length(up) <= 3) & F.try_element_at(codes, up).isNotNull()
            long = pair & (F.length(p["two"]) > 3)
            state = F.when(us | ca, up).when(code | long, "").otherwise(p["two"])
            country = F.when(us, "United States").when(ca, "Canada").when(code, F.try_element_at(codes, up)).when(long, p["two"]).otherwise(p["three"])
            return let(F.struct(state.alias("s"), country.alias("l")), lambda x: with_tail(candidate, p["one"], x["s"], x["l"]))

        at = lambda k: F.coalesce(F.get(chunks, F.lit(k)), blank)
        return let(F.struct(F.size(chunks).alias("n"), at(0).alias("one"), at(1).alias("two"), F.upper(at(1)).alias("up"), at(2).alias("three")), of)

    def placed(candidate: Column) -> Column:
        comma = trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(candidate, "[|•]", ","), r"\s+-\s+|\s*/\s*", ","), ",+", ","))
        chunks = F.filter(F.transform(F.split(comma, ","), trim), lambda p: p != "")
        whole = made(candidate, candidate, candidate, blank, blank)
        return F.when(plausible_place(candidate), let(chunks, lambda c: F.when(F.size(c) > 0, from_chunks(candidate, c)).otherwise(whole)))

    def read(text: Column) -> Column:
        says = (text != "") & ~F.lower(text).isin("not specified", "n/a", "na")
        first = F.get(F.filter(F.transform(F.split(text, r"\s*[;|•]\s*"), trim), lambda p: (p != "") & plausible_place(p)), F.lit(0))
        return F.when(says & text.rlike(words(["remote"])), remote(text)).when(says, let(F.coalesce(first, text), placed))

    return let(collapse(raw), read)


def upload_job_type(raw: Column) -> Column:
    """A typed job type as the upload takes it: open calls are one of their own."""
    return F.when(F.regexp_replace(F.upper(trim(raw)), "[-_ ]", "") == "OPENCALL", "OPEN_CALL").otherwise(job_type_value(raw))


def apply_method(link: Column, work_email: Column, by_email: Column) -> Column:
    """Struct of link, whether applications go by mail, and their address: mail rows lose their link, others their address."""
    mail = F.coalesce((F.lower(trim(by_email)).isin("true", "yes", "1")) & (trim(work_email) != ""), F.lit(False))
    return F.struct(
        F.when(mail, "").otherwise(F.coalesce(trim(link), F.lit(""))).alias("link"), mail.alias("by_email"), F.when(mail, trim(work_email)).otherwise("").alias("email")
    )


def positive_number(raw: Column, fallback: float) -> Column:
    """A typed number above 0, else ``fallback``."""
    value = trim(raw).try_cast("double")
    return F.when((value > 0) & (value < float("inf")), value).otherwise(F.lit(float(fallback)))


def content_hash(content: Column) -> Column:
    """Digest by which equal contents are recognised; null stays null."""
    return F.sha2(content, 256)
