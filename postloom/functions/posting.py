"""Fields of a posting's structured data, and choices between several sources of a field.

Structured data is one JobPosting node as JSON text (see ``functions.html``);
it is read as a variant, so fields of any shape are tolerated and whatever is
not there is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions import extract, urls, vocab
from postloom.functions import text as tx
from postloom.functions.predicates import job_path, known_host, other_path, plausible_place
from postloom.functions.vocab import OPEN

PLACEHOLDER = "For job details, click apply."
# Words of a pay unit and the period that they mean, first hit first.
PERIODS = (("hour", "HOURLY"), ("day", "DAILY"), ("week", "WEEKLY"), ("month", "MONTHLY"), ("year", "ANNUAL"), ("annual", "ANNUAL"), ("one", "ONE_TIME"), ("fixed", "ONE_TIME"))
# Fields of a node that hold keywords.
KEYWORD_FIELDS = ("occupationalCategory", "industry", "qualifications")
# A page title that names a site's listing, and the openings of a place in running text.
CAREERS_PAGE = r"(?i)^.{2,30}\s+(?:careers?|jobs?|openings?|opportunities)$"
PLACE_PHRASE = rf"(?i){OPEN}(?:location|based in|office location|work location)\s*[:\-]\s*([A-Za-z .'-]{{3,80}}(?:,\s*[A-Za-z .'-]{{2,40}}){{0,3}})"
#: Characters below which a description of HTML says too little.
LEAST_PLAIN = 40


def parsed(node: Column) -> Column:
    return F.try_parse_json(node)


def node_text(node: Column, path: str) -> Column:
    """A field of the node as text, null where it is none."""
    return F.try_variant_get(parsed(node), path, "string")


def node_terms(node: Column, field: str) -> Column:
    """Values of a field that is a text with separators or a list of texts: trimmed, in lower case, blanks left out."""
    value = F.try_variant_get(parsed(node), f"$.{field}", "variant")
    texts = F.transform(F.filter(F.try_variant_get(value, "$", "array<variant>"), lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    text = F.when(F.schema_of_variant(value) == "STRING", F.split(F.try_variant_get(value, "$", "string"), "[,;|]"))
    return F.filter(F.transform(F.coalesce(texts, text, F.array().cast("array<string>")), lambda t: F.lower(tx.trim(t))), lambda t: t != "")


def number(text: Column) -> Column:
    """A number as scripts read it: blank counts as 0, what is no finite number is null."""
    value = F.when(tx.trim(text) == "", 0.0).otherwise(tx.trim(text).try_cast("double"))
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def period(unit: Column) -> Column:
    low = F.lower(unit)
    out = F.when(low.contains(PERIODS[0][0]), PERIODS[0][1])
    for word, name in PERIODS[1:]:
        out = out.when(low.contains(word), name)
    return out


def node_salary(node: Column) -> Column:
    """Struct of min, max, currency and period, null where the node has neither bound."""
    low, high = (number(node_text(node, f"$.baseSalary.value.{k}")) for k in ("minValue", "maxValue"))
    currency = F.coalesce(tx.clean_text(node_text(node, "$.baseSalary.currency")), F.lit("USD"))
    unit = period(F.coalesce(node_text(node, "$.baseSalary.value.unitText"), F.lit("")))
    return F.when(low.isNotNull() | high.isNotNull(), F.struct(low.alias("min"), high.alias("max"), currency.alias("currency"), unit.alias("period")))


def salary(node: Column, description: Column) -> Column:
    """The node's pay, else the first range in the text."""
    return F.coalesce(node_salary(node), extract.salary(description))


def keywords(node: Column, title: Column, description: Column, limit: int = 20) -> Column:
    """The node's keywords, then terms of the text, each once, at most ``limit`` (a feature)."""
    named = F.filter(F.concat(*[node_terms(node, f) for f in KEYWORD_FIELDS]), lambda k: (F.length(k) >= 2) & ~k.isin(*vocab.KEYWORD_BLOCKLIST))
    return F.slice(F.array_distinct(F.concat(named, extract.keyword_terms(title, description, len(vocab.KEYWORD_TERMS)))), 1, limit)


def node_place(node: Column) -> Column:
    """Struct of name, address, city, state and country of the node's first place, null where it is none."""
    first = F.coalesce(F.try_variant_get(parsed(node), "$.jobLocation[0]", "variant"), F.try_variant_get(parsed(node), "$.jobLocation", "variant"))
    codes = F.create_map(*[F.lit(x) for pair in vocab.COUNTRIES.items() for x in pair])

    def part(key: str) -> Column:
        return F.coalesce(tx.clean_text(F.try_variant_get(first, f"$.address.{key}", "string")), F.lit(""))

    def joined(*parts: Column) -> Column:
        return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), ", ")

    def made(p: Column) -> Column:
        land = F.when(F.length(p["l"]) <= 3, F.coalesce(F.try_element_at(codes, F.upper(p["l"])), p["l"])).otherwise(p["l"])
        name, address = joined(p["c"], p["s"]), joined(p["c"], p["s"], p["z"], p["l"])
        place = F.struct(name.alias("name"), address.alias("address"), p["c"].alias("city"), p["s"].alias("state"), land.alias("country"))
        return F.when(plausible_place(F.when(address != "", address).otherwise(name)), place)

    return urls.let(F.struct(part("addressLocality").alias("c"), part("addressRegion").alias("s"), part("postalCode").alias("z"), part("addressCountry").alias("l")), made)


def place(seed: Column, node: Column, description: Column) -> Column:
    """The typed place, else the node's, else one that the text introduces as its location."""
    phrase = F.nullif(F.regexp_extract(description, PLACE_PHRASE, 1), F.lit(""))
    return F.coalesce(extract.location(seed), node_place(node), extract.location(phrase))


def careers_page_title(title: Column) -> Column:
    """Whether a title names a site's listing and no posting."""
    return F.coalesce(tx.trim(title).rlike(CAREERS_PAGE), F.lit(False))


def title(node_title: Column, heading: Column, page_title: Column, seed: Column) -> Column:
    """The node's title, the page's heading of 4 to 199 characters, its title, else the seed; listing titles are passed over."""

    def good(c: Column) -> Column:
        t = tx.clean_text(c)
        return F.when(~careers_page_title(t), t)

    h = good(heading)
    return F.coalesce(good(node_title), F.when((F.length(h) > 3) & (F.length(h) < 200), h), good(page_title), seed)


def description(node_description: Column, longest_block: Column, meta: Column) -> Column:
    """The node's description beyond 80 characters, else the longest block of the page from 80 on, else its summary, else the stand-in."""
    told = tx.blank_to_null(tx.collapse(node_description))
    summary = tx.page_description(tx.blank_to_null(tx.collapse(meta)))
    return F.coalesce(
        F.when(F.length(told) > 80, tx.page_description(told)),
        F.when(F.length(longest_block) >= 80, tx.page_description(longest_block)),
        F.when(~summary.rlike("(?i)^Explore corporate jobs and career programs at Amazon"), summary),
        F.lit(PLACEHOLDER),
    )


def description_policy(text: Column, link: Column, safe_html: Column, safe_plain: Column, plain: Column) -> Column:
    """Struct of kind (placeholder, html, plain, as_is) and the description that a record keeps.

    ``safe_html`` is the sanitised text, ``safe_plain`` and ``plain`` the
    visible text of it and of the original (see ``functions.html``).
    """
    raw = tx.collapse(F.coalesce(text, F.lit("")))
    clean = urls.canonical(F.coalesce(link, F.lit("")))
    posting = (known_host(clean) | job_path(clean)) & ~other_path(clean)
    kind = (
        F.when(raw == "", "placeholder")
        .when(tx.looks_garbled(raw) & posting, "placeholder")
        .when(~tx.has_html(raw), "as_is")
        .when(F.length(safe_plain) >= LEAST_PLAIN, "html")
        .when(F.length(plain) >= LEAST_PLAIN, "plain")
        .when(posting | (F.coalesce(plain, F.lit("")) == ""), "placeholder")
        .otherwise("plain")
    )
    return urls.let(kind, lambda k: F.struct(k.alias("kind"), F.when(k == "placeholder", PLACEHOLDER).when(k == "as_is", raw).when(k == "html", safe_html).otherwise(plain).alias("text")))
