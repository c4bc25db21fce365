"""Pieces of DuckDB SQL from which the queries' own SQL is put together."""

from __future__ import annotations

from postloom.functions import vocab

WS = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
ABSOLUTE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:\s]+)(:[0-9]+)?([^?#]*)(\?[^#]*)?(#.*)?$"


def text(pattern: str) -> str:
    """A pattern or text as an SQL string."""
    return "'" + pattern.replace("'", "''") + "'"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return trim(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def is_url(x: str) -> str:
    return f"coalesce(regexp_matches({trim(x)}, '{ABSOLUTE}'), false)"


def part(x: str, group: int) -> str:
    return f"regexp_extract({trim(x)}, '{ABSOLUTE}', {group})"


def host(x: str) -> str:
    return f"(CASE WHEN {is_url(x)} THEN lower({part(x, 2)}) END)"


def path(x: str) -> str:
    return f"(CASE WHEN {is_url(x)} THEN coalesce(nullif(replace({part(x, 4)}, ' ', '%20'), ''), '/') END)"


def query(x: str) -> str:
    return f"(CASE WHEN {is_url(x)} THEN regexp_replace({part(x, 5)}, '^\\?', '') END)"


def origin(x: str) -> str:
    """Scheme, host and port unless it is the scheme's own."""
    s = f"lower({part(x, 1)})"
    p = part(x, 3)
    return f"({s} || '://' || lower({part(x, 2)}) || CASE WHEN ({p} = ':80' AND {s} = 'http') OR ({p} = ':443' AND {s} = 'https') THEN '' ELSE {p} END)"


def canonical(x: str) -> str:
    kept = (
        f"list_filter(list_transform(list_filter(string_split({query(x)}, '&'), lambda p: p <> ''), lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END), "
        f"lambda p: NOT regexp_matches(regexp_replace(p, '=.*$', ''), '(?i)^(?:{vocab.TRACKING_PARAM})$'))"
    )
    whole = f"{origin(x)} || {path(x)} || CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END"
    return f"(CASE WHEN {is_url(x)} THEN regexp_replace({whole}, '/$', '') ELSE {trim(x)} END)"


def dedup_key(x: str) -> str:
    return f"lower(CASE WHEN {is_url(x)} THEN {origin(x)} || regexp_replace({path(x)}, '/+$', '') ELSE regexp_replace({x}, '/+$', '') END)"


def loose_key(x: str) -> str:
    bare = f"regexp_replace(regexp_replace(lower({trim(x)}), '^[a-z][a-z0-9+.\\-]*://', ''), '^www\\.', '')"
    return f"regexp_replace({bare}, '/+$', '')"


def has(x: str, terms: list[str]) -> str:
    return f"coalesce(regexp_matches({x}, '{vocab.sql_words(terms)}'), false)"


def matches(x: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({x}, {text(pattern)}), false)"


def strict_title(x: str) -> str:
    return f"({has(x, vocab.STRICT_TITLE_TERMS)} AND NOT ({has(x, vocab.OTHER_TRADE_TERMS)} AND NOT {has(x, vocab.SAVING_TERMS)}))"


def text_score(x: str) -> str:
    parts = ((vocab.STRICT_TITLE_TERMS, 2), (vocab.SKILL_TERMS, 2), (vocab.GENERIC_TERMS, 1), (vocab.AGAINST_TERMS, -2))
    return "(" + " + ".join(f"CASE WHEN {has(x, t)} THEN {n} ELSE 0 END" for t, n in parts) + ")"


def names(values: list[str]) -> str:
    return ", ".join(text(v) for v in values)


def base_domain(host_sql: str) -> str:
    """Last two labels of a host, three under a country code with a general second level."""
    a = f"string_split({host_sql}, '.')"
    general = "('co', 'com', 'org', 'net', 'gov', 'ac', 'edu')"
    return (
        f"(CASE WHEN len({a}) <= 2 THEN {host_sql} WHEN regexp_matches({a}[len({a})], '^[a-z]{{2}}$') AND {a}[len({a}) - 1] IN {general} "
        f"THEN array_to_string({a}[len({a}) - 2:len({a})], '.') ELSE array_to_string({a}[len({a}) - 1:len({a})], '.') END)"
    )


def priority(x: str) -> str:
    systems = r"myworkdayjobs\.com|greenhouse\.io|lever\.co|smartrecruiters\.com|icims\.com|ashbyhq\.com|job-boards\."
    return f"(CASE WHEN {matches(f'lower({x})', systems)} THEN 0 WHEN {matches(f'lower({x})', 'careers?' + chr(92) + '.')} THEN 2 ELSE 1 END)"


def segments(x: str) -> str:
    return f"list_filter(string_split({path(x)}, '/'), lambda s: s <> '')"


def date_forms(x: str) -> str:
    forms = ["%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.%gZ", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%B %d, %Y", "%B %d %Y", "%b %d, %Y", "%b %d %Y", "%d %b %Y"]
    tries = ", ".join(f"try_strptime({trim(x)}, '{f}')" for f in forms)
    month = f"try_strptime('1 ' || {trim(x)}, '%d %B %Y')"
    return f"strftime(coalesce({tries}, {month}), '%Y-%m-%d')"
