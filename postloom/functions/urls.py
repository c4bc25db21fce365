"""URL functions as Spark columns.

Addresses are taken apart by one pattern; a value that is no absolute address
has null parts, never an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import vocab
from postloom.functions.text import capitalised_words, split_camel, trim

ABSOLUTE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:\s]+)(:[0-9]+)?([^?#]*)(\?[^#]*)?(#.*)?$"
# Hosts of hiring systems, and labels that name no company.
SYSTEM_HOSTS = (
    "greenhouse.io lever.co workday.com myworkdayjobs.com smartrecruiters.com ashbyhq.com breezy.hr recruitee.com jobs.lever.co boards.greenhouse.io jobvite.com icims.com "
    "ultipro.com taleo.net successfactors.com applytojob.com"
).split()
GENERIC_LABELS = "careers career jobs job job-boards boards apply hire hiring recruiting recruitment work www".split()
SHORT_LABELS = "com org net io co eu us uk de fr in au ca".split()
CAREER_LABELS = "careers jobs career job hire hiring".split()
# Board domains, matched with every sub-domain.
BOARD_DOMAINS = (
    "amazon.jobs greenhouse.io lever.co smartrecruiters.com ashbyhq.com workable.com myworkdayjobs.com myworkdaysite.com icims.com jobvite.com ultipro.com schooljobs.com "
    "paycomonline.net bamboohr.com breezy.hr recruitee.com teamtailor.com applytojob.com pinpointhq.com"
).split()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _part(col: Column, group: int) -> Column:
    return F.regexp_extract(trim(col), ABSOLUTE, group)


def is_url(col: Column) -> Column:
    return F.coalesce(trim(col).rlike(ABSOLUTE), F.lit(False))


def scheme(col: Column) -> Column:
    return F.when(is_url(col), F.lower(_part(col, 1)))


def host(col: Column) -> Column:
    return F.when(is_url(col), F.lower(_part(col, 2)))


def path(col: Column) -> Column:
    p = F.replace(_part(col, 4), F.lit(" "), F.lit("%20"))
    return F.when(is_url(col), F.when(p == "", "/").otherwise(p))


def query(col: Column) -> Column:
    """The query without ``?``; empty where there is none."""
    return F.when(is_url(col), F.regexp_replace(_part(col, 5), r"^\?", ""))


def params(col: Column) -> Column:
    """Query parameters in order, each with ``=``."""
    return F.transform(F.filter(F.split(query(col), "&"), lambda p: p != ""), lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("="))))


def _origin(col: Column) -> Column:
    port = _part(col, 3)
    default = (port == ":80") & (scheme(col) == "http") | (port == ":443") & (scheme(col) == "https")
    return F.concat(scheme(col), F.lit("://"), host(col), F.when(default, "").otherwise(port))


def origin(col: Column) -> Column:
    """Scheme and host, without port."""
    return F.concat(scheme(col), F.lit("://"), host(col))


def canonical(col: Column) -> Column:
    """Without fragment and tracking parameters, the other parameters in order, one closing slash removed; other text only trimmed."""
    kept = F.filter(params(col), lambda p: ~F.regexp_replace(p, "=.*$", "").rlike(f"(?i)^(?:{vocab.TRACKING_PARAM})$"))
    whole = F.concat(_origin(col), path(col), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(is_url(col), F.regexp_replace(whole, "/$", "")).otherwise(trim(col))


def dedup_key(col: Column) -> Column:
    """Scheme, host and path in lower case, without query and closing slashes."""
    whole = F.concat(_origin(col), F.regexp_replace(path(col), "/+$", ""))
    return F.lower(F.when(is_url(col), whole).otherwise(F.regexp_replace(col, "/+$", "")))


def loose_key(col: Column) -> Column:
    """For joins across tables: without scheme, ``www.`` and closing slash."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(trim(col)), r"^[a-z][a-z0-9+.\-]*://", ""), r"^www\.", "")
    return F.regexp_replace(bare, "/+$", "")


def bare_host(col: Column) -> Column:
    """Host without ``www.``; a missing scheme is tolerated."""
    full = F.when(trim(col).contains("://"), col).otherwise(F.concat(F.lit("http://"), trim(col)))
    return F.regexp_replace(host(full), r"^www\.", "")


def base_domain(host_col: Column) -> Column:
    """Last two labels of a host, three under a country code with a general second level."""
    labels = F.split(host_col, r"\.")
    n = F.size(labels)
    country = F.element_at(labels, -1).rlike("^[a-z]{2}$") & F.when(n >= 3, F.element_at(labels, -2)).isin("co", "com", "org", "net", "gov", "ac", "edu")
    keep = F.when(F.coalesce(country, F.lit(False)), 3).otherwise(2)
    return F.when(n <= 2, host_col).otherwise(F.array_join(F.slice(labels, n - keep + 1, keep), "."))


def strip_career_label(host_col: Column) -> Column:
    labels = F.split(host_col, r"\.")
    return F.when((F.size(labels) > 2) & labels[0].isin(*CAREER_LABELS), F.array_join(F.slice(labels, F.lit(2), F.size(labels) - 1), ".")).otherwise(host_col)


def segments(col: Column) -> Column:
    return F.filter(F.split(path(col), "/"), lambda s: s != "")


def host_slug(col: Column) -> Column:
    """``host/first segment`` in lower case."""
    full = F.when(trim(col).startswith("http"), col).otherwise(F.concat(F.lit("https://"), trim(col)))
    return F.when(is_url(full), F.lower(F.concat(host(full), F.lit("/"), F.coalesce(F.get(segments(full), F.lit(0)), F.lit(""))))).otherwise(F.lower(col))


def is_junk_slug(col: Column) -> Column:
    low = F.lower(col)
    uuid = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    return F.coalesce((low == "") | low.isin(*vocab.JUNK_SLUGS) | low.rlike(f"{uuid}|^[0-9]+$|\\.[a-z]{{2,5}}$") | (F.length(low) < 2), F.lit(True))


def path_slug(col: Column, of_host: str) -> Column:
    """First path segment in lower case where the host ends with ``of_host`` and the segment names something."""
    first = F.lower(F.get(segments(col), F.lit(0)))
    return F.when(host(col).endswith(of_host) & ~is_junk_slug(first), first)


def title_from_slug(col: Column) -> Column:
    """The last path segment that reads as a title, its words capitalised."""

    def reads(s: Column) -> Column:
        return trim(F.regexp_replace(F.regexp_replace(s, "^[0-9]+-", ""), "[-_]", " "))

    good = F.filter(segments(col), lambda s: ~s.rlike("^[0-9]+$") & (F.length(s) >= 5) & (F.length(reads(s)) >= 5) & reads(s).rlike("[a-z]"))
    return F.when(F.size(good) > 0, capitalised_words(reads(F.element_at(good, -1))))


def absolute(col: Column, base: Column) -> Column:
    """An address resolved against the page it stood on; null where the page is none."""

    def resolved(link: Column, page: Column) -> Column:
        home, folder = _origin(page), F.regexp_replace(F.concat(_origin(page), path(page)), "[^/]*$", "")
        inside = (
            F.when(link.startswith("//"), F.concat(scheme(page), F.lit(":"), link))
            .when(link.startswith("/"), F.concat(home, link))
            .when(link.startswith("?"), F.concat(home, path(page), link))
            .otherwise(F.concat(folder, F.replace(link, F.lit(" "), F.lit("%20"))))
        )
        return F.when(is_url(link), link).when(is_url(page) & (link != ""), inside)

    return let(trim(col), lambda link: let(base, lambda page: resolved(link, page)))


def company_from_host(col: Column) -> Column:
    """First label of a page's host, ``unknown`` where there is none."""
    return F.coalesce(F.nullif(F.split(F.regexp_replace(host(col), r"^www\.", ""), r"\.")[0], F.lit("")), F.lit("unknown"))


def company_from_url(col: Column) -> Column:
    """A company's name as its posting's address gives it, or null."""
    bare = F.regexp_replace(host(col), r"^www\.", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    on_system = F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".").isin(*SYSTEM_HOSTS) | F.array_join(F.slice(labels, F.greatest(n - 2, F.lit(1)), 3), ".").isin(*SYSTEM_HOSTS)

    def capital(c: Column) -> Column:
        return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))

    sub = F.when((n > 2) & ~labels[0].isin(*GENERIC_LABELS), labels[0])
    first = F.get(segments(col), F.lit(0))
    seg = F.when(~F.lower(first).isin(*GENERIC_LABELS), first)
    own = F.filter(F.slice(labels, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda x: ~x.isin(*GENERIC_LABELS) & ~x.isin(*SHORT_LABELS))
    return F.when(on_system, capital(F.coalesce(sub, seg))).otherwise(split_camel(capital(F.get(own, F.lit(0)))))


def priority(col: Column) -> Column:
    """How much an address is worth among copies: 2 for career sites, 0 for hiring systems, else 1."""
    low = F.lower(col)
    return F.when(low.rlike(r"myworkdayjobs\.com|greenhouse\.io|lever\.co|smartrecruiters\.com|icims\.com|ashbyhq\.com|job-boards\."), 0).when(low.rlike(r"careers?\."), 2).otherwise(1)


def has_id_signal(col: Column) -> Column:
    """A long number in the path, or a filled parameter that names a posting."""
    named = F.exists(params(col), lambda p: p.rlike(f"(?i)^(?:{vocab.ID_PARAM})=.*\\S"))
    return F.coalesce(path(col).rlike("/[0-9]{5,}(?:/|$)") | named, F.lit(False))


def is_listing(col: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_replace(path(col), "/+$", "")).isin(*vocab.LISTING_PATHS), F.lit(False))


def is_board_domain(host_col: Column) -> Column:
    return F.coalesce(host_col.rlike(f"(?:^|\\.)(?:{'|'.join(map(vocab.escaped, BOARD_DOMAINS))})$"), F.lit(False))


def avatar(name: Column, template: str = "https://avatars.example/?name=") -> Column:
    """Address of a generated picture, the name percent-encoded."""
    code = F.replace(F.url_encode(name), F.lit("+"), F.lit("%20"))
    for enc, char in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        code = F.replace(code, F.lit(enc), F.lit(char))
    return F.concat(F.lit(template), code)


def retry_canonical(col: Column) -> Column:
    """``canonical`` for a second try: what is no address stays exactly as it was."""
    return F.when(is_url(col), canonical(col)).otherwise(col)


def crawler_title(col: Column) -> Column:
    """What a posting's address calls it: the last segment (before a closing ``apply``) decoded, without feed prefix and requisition, 3 to 180 characters."""
    parts = segments(col)
    end = F.get(parts, F.size(parts) - 1)
    last = F.when((F.lower(end) == "apply") & (F.size(parts) > 1), F.get(parts, F.size(parts) - 2)).otherwise(end)
    bare = F.regexp_replace(F.regexp_replace(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), "(?i)^xmlname-", ""), "(?i)_r[0-9]+[a-z0-9-]*$", "")
    said = trim(F.regexp_replace(bare, "[-_]+", " "))
    return F.when((F.size(parts) > 0) & (F.length(said) >= 3) & (F.length(said) <= 180), said)


def _set_param(found: Column, name: str, value: str | int) -> Column:
    """Parameters with one of them set: at its first place, its repeats gone, or added at the end."""
    pair = F.lit(f"{name}={value}")
    own = F.transform(found, lambda p: F.startswith(p, F.lit(f"{name}=")))
    first = F.array_position(own, F.lit(True))
    put = F.transform(found, lambda p, i: F.when(i + 1 == first, pair).when(~F.startswith(p, F.lit(f"{name}=")), p))
    return F.when(first > 0, F.filter(put, lambda p: p.isNotNull())).otherwise(F.concat(found, F.array(pair)))


def with_query(col: Column, values: dict[str, str | int]) -> Column:
    """The address with parameters set: a given one takes the new value at its first place, others are added; null where there is no address."""
    found = params(col)
    for name, value in values.items():
        found = _set_param(found, name, value)
    return F.when(is_url(col), F.concat(_origin(col), path(col), F.lit("?"), F.array_join(found, "&"), _part(col, 6)))
