"""Pages and nested JSON read in Arrow batches; only a real parser can do this.

The parser is the standard library's; it accepts anything and never fails.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.session import ship, ship_active

UNSEEN = frozenset("script style noscript svg canvas iframe".split())
# Tags that a description may keep.
KEPT_TAGS = frozenset("b strong i em u s strike br p div span ul ol li a h1 h2 h3 h4 h5 h6 blockquote code pre hr".split())
VOID = frozenset("br hr img input meta link".split())
# Hints by which links and titles are taken for postings.
LINK_HINT = re.compile(r"/(?:jobs?|careers?|positions?|openings?|requisition|vacanc|opportunit)\b|jobdetail", re.I)
TITLE_HINT = re.compile(r"\b(?:designer|design|artist|writer|producer|editor|engineer|developer|manager|director|specialist|analyst|research|intern|architect|lead)\b", re.I)
PAGE_HINT = re.compile(r"/(?:jobs|job-search|jobsearch|careers?|open-positions|opportunities|search)\b|/c/[a-z0-9-]+-jobs\b|work-with-us|join-us", re.I)
LINK_NOISE = re.compile(r"\b(?:privacy|cookie|terms|faq|help|support|investor|press|newsroom|login|sign in|apply now|learn more|home)\b", re.I)
# Keys under which records hold title, address and place.
TITLE_KEYS = "title jobTitle job_title positionTitle postingTitle requisitionTitle name text".split()
LINK_KEYS = "url applyUrl apply_url absolute_url hostedUrl jobUrl canonicalUrl externalPath job_path path href jobLink job_link".split()
PLACE_KEYS = "location locationsText city state country workplaceType".split()
MAX_DEPTH = 10
JOB_TYPE = "array<struct<title:string,url:string,location:string>>"


class _Page(HTMLParser):
    """Visible text, links, headings and scripts of a page in one pass."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.links: list[tuple[str, list[str]]] = []
        self.first: dict[str, list[str]] = {}
        self.scripts: list[str] = []
        self.meta: dict[str, str] = {}
        self._hidden = 0
        self._open: dict[str, list[str] | None] = {}
        self._link: list[str] | None = None
        self._data: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        named = dict(attrs)
        if tag in UNSEEN:
            self._hidden += 1
            if tag == "script" and ("ld+json" in (named.get("type") or "") or named.get("id") == "__NEXT_DATA__"):
                self._data = []
        elif tag == "a" and named.get("href"):
            self._link = []
            self.links.append((named["href"], self._link))
        elif tag in ("h1", "title") and tag not in self.first:
            self.first[tag] = []
            self._open[tag] = self.first[tag]
        elif tag == "meta" and named.get("property") == "og:title":
            self.meta.setdefault("og:title", named.get("content") or "")

    def handle_endtag(self, tag: str) -> None:
        if tag in UNSEEN and self._hidden:
            self._hidden -= 1
            if tag == "script" and self._data is not None:
                self.scripts.append("".join(self._data))
                self._data = None
        elif tag == "a":
            self._link = None
        self._open.pop(tag, None)

    def handle_data(self, data: str) -> None:
        if self._data is not None:
            self._data.append(data)
        if self._hidden:
            return
        if "title" not in self._open:
            self.text.append(data)
        if self._link is not None:
            self._link.append(data)
        for part in self._open.values():
            if part is not None:
                part.append(data)


def parse_page(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page


def squash(text: str) -> str:
    return " ".join(text.split())


def visible_text(html: str | None) -> str:
    """Text of a page without scripts and styles; plain text is only squashed."""
    if not html:
        return ""
    return squash("".join(parse_page(html).text)) if re.search("<[^>]+>", html) else squash(html)


class _Sanitiser(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self._hidden = 0
        self._stack: list[bool] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in UNSEEN:
            self._hidden += 1
            return
        if self._hidden or tag not in KEPT_TAGS:
            return
        if tag == "a":
            href = (dict(attrs).get("href") or "").strip()
            ok = bool(re.match("https?://", href, re.I))
            self._stack.append(ok)
            if ok:
                self.out.append(f'<a href="{entities.escape(href)}" target="_blank" rel="noopener noreferrer">')
            return
        self.out.append(f"<{tag}>")

    def handle_endtag(self, tag: str) -> None:
        if tag in UNSEEN:
            self._hidden = max(0, self._hidden - 1)
            return
        if self._hidden or tag not in KEPT_TAGS or tag in VOID:
            return
        if tag == "a" and not (self._stack.pop() if self._stack else False):
            return
        self.out.append(f"</{tag}>")

    def handle_data(self, data: str) -> None:
        if not self._hidden:
            self.out.append(entities.escape(data, quote=False))


def sanitise(html: str | None) -> str:
    """HTML with whitelisted tags only, no attributes but a link's address; empty where no text is left."""
    s = _Sanitiser()
    s.feed(html or "")
    s.close()
    clean = "".join(s.out).strip()
    return clean if visible_text(clean) else ""


def resolve(link: str, base: str) -> str | None:
    """An absolute address, or None where there is none."""
    link = link.strip()
    if re.match(r"[a-z][a-z0-9+.-]*://[^/\s]", link, re.I):
        return link
    if not link or not urlsplit(base).netloc:
        return None
    try:
        return urljoin(base, link.replace(" ", "%20"))
    except ValueError:
        return None


def link_jobs(page: _Page, base: str) -> list[dict]:
    """Links that look like postings, in page order."""
    out = []
    for href, text in page.links:
        title, url = squash("".join(text)), resolve(squash(href), base)
        if url and 3 <= len(title) <= 180 and not LINK_NOISE.search(title) and (LINK_HINT.search(url) or TITLE_HINT.search(title)):
            out.append({"title": title, "url": url, "location": None})
    return out


def next_pages(page: _Page, base: str) -> list[str]:
    """Addresses of further listing pages, distinct, in page order."""
    urls = (resolve(squash(href), base) for href, _ in page.links)
    return list(dict.fromkeys(u for u in urls if u and PAGE_HINT.search(u)))


def _first_text(record: dict, keys: list[str]) -> str | None:
    return next((record[k].strip() for k in keys if isinstance(record.get(k), str) and record[k].strip()), None)


def _place(record: dict) -> str | None:
    direct = _first_text(record, PLACE_KEYS)
    if direct:
        return direct
    nested = record.get("location")
    if isinstance(nested, dict):
        parts = [nested[k].strip() for k in ("city", "state", "region", "country") if isinstance(nested.get(k), str) and nested[k].strip()]
        return ", ".join(parts) or None
    return None


def json_jobs(data: object, base: str) -> list[dict]:
    """Records of a JSON tree that look like postings, and its JobPosting nodes; may name one twice."""
    out: list[dict] = []

    def walk(value: object, depth: int) -> None:
        if depth > MAX_DEPTH:
            return
        if isinstance(value, list):
            for item in value:
                walk(item, depth + 1)
        elif isinstance(value, dict):
            title, link = _first_text(value, TITLE_KEYS), _first_text(value, LINK_KEYS)
            url = resolve(link, base) if link else None
            if title and 3 <= len(title) <= 180 and url and (LINK_HINT.search(url) or TITLE_HINT.search(title)):
                out.append({"title": title, "url": url, "location": _place(value)})
            for nested in value.values():
                walk(nested, depth + 1)

    walk(data, 0)
    queue = deque([data])
    while queue:
        value = queue.popleft()
        if isinstance(value, list):
            queue.extend(value)
        elif isinstance(value, dict):
            if str(value.get("@type", "")).lower() == "jobposting":
                title = value["title"].strip() if isinstance(value.get("title"), str) else ""
                url = next((u for k in ("url", "sameAs") if isinstance(value.get(k), str) and (u := resolve(value[k], base))), None)
                place = value.get("jobLocation")
                address = place.get("address") if isinstance(place, dict) else None
                parts = [str(address[k]) for k in ("addressLocality", "addressRegion", "addressCountry") if address.get(k)] if isinstance(address, dict) else []
                if title and url:
                    out.append({"title": title, "url": url, "location": ", ".join(parts) or None})
            queue.extend(value.values())
    return out


def job_posting(page: _Page) -> str | None:
    """The first JobPosting node of a page's data blocks, breadth first, as JSON."""
    queue: deque[object] = deque()
    for raw in page.scripts:
        try:
            queue.append(json.loads(raw))
        except ValueError:
            continue
    while queue:
        value = queue.popleft()
        if isinstance(value, list):
            queue.extend(value)
        elif isinstance(value, dict):
            kind = value.get("@type")
            if any("jobposting" in str(k).lower() for k in (kind if isinstance(kind, list) else [kind])):
                return json.dumps(value, ensure_ascii=False)
            queue.extend(value.values())
    return None


def organisation_hosts(page: _Page) -> list[str]:
    """Hosts that a page's JobPosting nodes (top level or graph) give as the hiring organisation's own."""
    out: list[str] = []
    for raw in page.scripts:
        try:
            top = json.loads(raw)
        except ValueError:
            continue
        nodes = [n for t in (top if isinstance(top, list) else [top]) if isinstance(t, dict) for n in (t["@graph"] if isinstance(t.get("@graph"), list) else [t])]
        for node in nodes:
            kind = node.get("@type") if isinstance(node, dict) else None
            if kind != "JobPosting" and not (isinstance(kind, list) and "JobPosting" in kind):
                continue
            organisation = node.get("hiringOrganization")
            same = organisation.get("sameAs") if isinstance(organisation, dict) else None
            for link in same if isinstance(same, list) else [same]:
                if isinstance(link, str) and link.strip():
                    full = link.strip() if "://" in link else f"https://{link.strip()}"
                    host = (urlsplit(full).hostname or "").removeprefix("www.")
                    if host and not re.fullmatch(r"[0-9.]+", host):
                        out.append(host)
    return list(dict.fromkeys(out))


def page_jobs(html: str | None, base: str) -> list[dict]:
    """Postings of a stored page: its links, then its data blocks; exact repeats once."""
    page = parse_page(html)
    found = link_jobs(page, base)
    for raw in page.scripts:
        try:
            found += json_jobs(json.loads(raw), base)
        except ValueError:
            continue
    return list({(j["title"], j["url"]): j for j in reversed(found)}.values())[::-1]


def seed_paths(base: str) -> list[str]:
    """Addresses where a site may list its postings, likeliest first."""
    # Usual listing paths and their worth.
    paths = ["/jobs", "/careers/jobs", "/career/jobs", "/search", "/job-search-results", "/search-results", "/c/design-jobs", "/c/marketing-and-strategy-jobs", "/c/engineering-and-product-jobs"]
    parts = [p for p in urlsplit(base).path.split("/") if p]
    if len(parts) >= 2:
        paths += [f"/{parts[0]}/{parts[1]}{tail}" for tail in ("/jobs", "/search-results", "/careers", *paths[-3:])]

    def worth(url: str) -> int:
        bonus = ((("/us/en/search-results" in url), 120), (("/us/en/c/" in url), 110), (("/search-results" in url), 90), (bool(re.search(r"/c/[a-z0-9-]+-jobs", url)), 80), (("/us/en/jobs" in url), 70), (url.endswith("/jobs"), 60))
        return sum(points for hit, points in bonus if hit)

    urls = [u for p in dict.fromkeys(paths) if (u := resolve(p, base))]
    return sorted(urls, key=lambda u: -worth(u))


def text_column(html: Column) -> Column:
    ship_active()
    return F.pandas_udf(lambda s: pd.Series([None if x is None else visible_text(x) for x in s]), "string")(html)


def sanitised_column(html: Column) -> Column:
    ship_active()
    return F.pandas_udf(lambda s: pd.Series([None if x is None else sanitise(x) for x in s]), "string")(html)


def posting_column(html: Column) -> Column:
    ship_active()
    return F.pandas_udf(lambda s: pd.Series([job_posting(parse_page(x)) for x in s]), "string")(html)


def pages_to_jobs(pages: DataFrame) -> DataFrame:
    """(page_url, title, url, location) for the postings of stored pages (url, html)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(u, j["title"], j["url"], j["location"]) for u, h in zip(pdf["url"], pdf["html"]) if u for j in page_jobs(h, u)]
            yield pd.DataFrame(rows, columns=["page_url", "title", "url", "location"])

    ship(pages.sparkSession)
    return pages.select("url", "html").mapInPandas(run, "page_url string, title string, url string, location string")


def organisation_hosts_column(html: Column) -> Column:
    ship_active()
    return F.pandas_udf(lambda s: pd.Series([organisation_hosts(parse_page(x)) for x in s]), "array<string>")(html)


class Element:
    """One element of a page's tree."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list[Element | str] = []

    def walk(self) -> Iterator[Element]:
        """Elements below, in page order."""
        stack = [p for p in reversed(self.parts) if isinstance(p, Element)]
        while stack:
            element = stack.pop()
            yield element
            stack += [p for p in reversed(element.parts) if isinstance(p, Element)]

    def text(self) -> str:
        out, stack = [], list(reversed(self.parts))
        while stack:
            part = stack.pop()
            if isinstance(part, str):
                out.append(part)
            elif part.tag not in UNSEEN:
                stack += reversed(part.parts)
        return squash("".join(out))

    def nearest(self, tags: frozenset[str]) -> Element | None:
        element: Element | None = self
        while element is not None and element.tag not in tags:
            element = element.parent
        return element


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Element("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        element = Element(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.parts.append(element)
        if tag not in VOID:
            self.here = element

    def handle_endtag(self, tag: str) -> None:
        element: Element | None = self.here
        while element is not None and element.tag != tag:
            element = element.parent
        if element is not None and element.parent is not None:
            self.here = element.parent

    def handle_data(self, data: str) -> None:
        self.here.parts.append(data)


def parse_tree(html: str | None) -> Element:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


_STEP = re.compile(r"#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w:-]+)(?P<op>\*?=)'(?P<value>[^']*)'\]|(?P<tag>[\w-]+)")


def matches(element: Element, step: str) -> bool:
    """Whether an element meets one step of a selector: tag, #id, .class, [attribute='value'] or [attribute*='part']."""
    for m in _STEP.finditer(step):
        if m["tag"] and element.tag != m["tag"].lower() or m["id"] and element.attrs.get("id") != m["id"]:
            return False
        if m["cls"] and m["cls"] not in element.attrs.get("class", "").split():
            return False
        if m["attr"]:
            held = element.attrs.get(m["attr"])
            if held is None or (m["value"] not in held if m["op"] == "*=" else held != m["value"]):
                return False
    return True


def select(root: Element, selector: str) -> list[Element]:
    """Elements that a selector of steps, each somewhere below the one before, names; in page order."""
    *above, last = selector.split()
    out = []
    for element in root.walk():
        if not matches(element, last):
            continue
        at, steps = element.parent, list(above)
        while at is not None and steps:
            if matches(at, steps[-1]):
                steps.pop()
            at = at.parent
        if not steps:
            out.append(element)
    return out


# Where descriptions, titles and places stand in pages of postings, best known first.
BLOCK_SELECTORS = (
    "[data-automation-id='jobPostingDescription']", "[data-automation-id='job-posting-description']", "[data-automation-id='jobDescription']", ".css-kyg8or", "#job-detail-body",
    "[id*='job-detail-body']", "[id*='job-description']", "[data-qa='job-description']", "[data-testid*='description']", "[data-test*='description']", "[class*='JobDescription']",
    ".posting-description", ".job-description", ".job-details", ".iCIMS_InfoMsg_Job", "#content .content", "#content", "[class*='description']", ".description", ".section", "article", "main",
)
TITLE_SELECTOR = "[data-automation*='job-title']"
PLACE_SELECTORS = ("[data-automation*='job-location']", "[class*='location']", "[id*='location']")
PAGE_NOISE = re.compile(r"join us in empowering everyone to create\.?|search results?|careers?|home", re.I)
ROW_TAGS = frozenset("tr li div".split())
ROW_LINK = re.compile(r"/jobs/\d+", re.I)
ROW_PLACE = re.compile(r"\b(remote|[a-z .'-]+,\s*[a-z .'-]+(?:,\s*[a-z .'-]+)?)\b", re.I)
FIELDS_TYPE = "struct<heading:string,page_title:string,summary:string,block:string,detail_title:string,detail_place:string>"


def longest_block(root: Element) -> str:
    """The longest text that one of ``BLOCK_SELECTORS`` gathers; the earlier one among equals."""
    return max((squash(" ".join(e.text() for e in select(root, s))) for s in BLOCK_SELECTORS), key=len)


def page_fields(html: str | None) -> dict[str, str | None]:
    """Heading, title, summary, longest block, and the title and place of a posting's own page; null where there is none."""
    root = parse_tree(html)
    metas = [e.attrs for e in root.walk() if e.tag == "meta"]

    def first(selector: str) -> str | None:
        found = select(root, selector)
        return (found[0].text() or None) if found else None

    def meta(key: str, value: str) -> str | None:
        return next((squash(a.get("content", "")) or None for a in metas if a.get(key) == value), None)

    heading, page_title = first("h1"), first("title")
    titles = (heading, first(TITLE_SELECTOR), meta("property", "og:title"), page_title)
    title = next((t for t in titles if t and 3 <= len(t) <= 180), None)
    places = (t for s in PLACE_SELECTORS if (t := first(s)) and len(t) <= 120)
    return {
        "heading": heading, "page_title": page_title, "summary": meta("property", "og:description") or meta("name", "description"), "block": longest_block(root) or None,
        "detail_title": None if title and PAGE_NOISE.fullmatch(title) else title, "detail_place": next(places, None),
    }


def fields_column(html: Column) -> Column:
    """Struct of ``page_fields``, one parse for each page."""
    ship_active()
    return F.pandas_udf(lambda s: pd.DataFrame([page_fields(x) for x in s], columns=["heading", "page_title", "summary", "block", "detail_title", "detail_place"]), FIELDS_TYPE)(html)


def detail(fields: Column, url: Column, final_url: Column) -> Column:
    """Struct of title, url and location of a posting's own page: its title, else what the address calls it; null without either."""
    from postloom.functions import urls

    posting = r"(?i)/job/|/jobs?/[0-9]|/Search/JobDetail/|greenhouse\.io|lever\.co|smartrecruiters\.com|myworkdayjobs\.com"
    title = F.coalesce(fields["detail_title"], urls.crawler_title(url))
    known = F.when(F.coalesce(final_url.rlike(posting), F.lit(False)), final_url).otherwise(url)
    return F.when(title.isNotNull(), F.struct(F.trim(F.regexp_replace(title, r"\s+\|\s+.*$", "")).alias("title"), known.alias("url"), fields["detail_place"].alias("location")))


def row_jobs(html: str | None, base: str) -> list[dict]:
    """Postings of a page that lists one a row: links with a number, the place from the row around each."""
    out = []
    for link in select(parse_tree(html), "a"):
        href, title = squash(link.attrs.get("href", "")), link.text()
        url = resolve(href, base) if ROW_LINK.search(href) and len(title) >= 3 else None
        if url:
            row = link.nearest(ROW_TAGS)
            place = ROW_PLACE.search(row.text()) if row else None
            out.append({"title": title, "url": url, "location": place.group(1) if place else None})
    return out


def rows_to_jobs(pages: DataFrame) -> DataFrame:
    """(page_url, title, url, location) for the rows of stored list pages (url, html)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(u, j["title"], j["url"], j["location"]) for u, h in zip(pdf["url"], pdf["html"]) if u for j in row_jobs(h, u)]
            yield pd.DataFrame(rows, columns=["page_url", "title", "url", "location"])

    ship(pages.sparkSession)
    return pages.select("url", "html").mapInPandas(run, "page_url string, title string, url string, location string")
