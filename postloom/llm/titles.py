"""Posting titles taken apart: level, field, team and role.

Everything is a pure function of one title (and its city), so it runs inside
Arrow batches without any shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.session import ship_active

# Words that state a level, and the level they state.
LEVELS = {
    "senior": "senior", "sr": "senior", "snr": "senior",
    "junior": "junior", "jr": "junior", "jnr": "junior",
    "associate": "associate", "assoc": "associate",
    "principal": "principal", "princ": "principal",
    "freelance": "freelance", "freel": "freelance",
    "lead": "lead", "staff": "staff", "ii": "ii", "iii": "iii", "iv": "iv",
}
# Fields of trade as they stand in titles.
FIELDS = frozenset(
    "architecture automotive aviation beauty cycling education energy esports fintech gardening healthcare "
    "hospitality museums nonprofit outdoor railways retail sports toys travel".split()
)
# Words that name a kind of team, after the team's own name.
TEAM_WORDS = frozenset("team crew desk hub unit squad".split())
# Places and modes of work that say nothing about the role.
MODES = frozenset("remote hybrid onsite on-site".split())
# Titles that name no occupation.
NOISE = frozenset(
    ["careers", "home", "join us", "open positions", "general application", "talent pool", "job title", "undefined", "null"]
)

PLACEHOLDER = re.compile(r"\$\{[^}]*\}|\{\{.*?\}\}|\{%.*?%\}|%\w+%|@@\w+@@|\[\[.*?\]\]|<[^<>]*>|\[(?:city|company|team|location|name|role|client|level|title|job|employer|your|insert)\b[^\]]*\]", re.I)
#: A placeholder and the joining word before it.
RESIDUE = re.compile(rf"(?:\b(?:at|in|for|bei|chez|en)\s+)?(?:{PLACEHOLDER.pattern})", re.I)
MARKS = re.compile(r"\[\s*req[^\]]*\]|\(\s*(?:m/?f/?d|m/?w/?d|f/?m/?d|h/?f|all genders)\s*\)|\(\s*\d+\s*\)|\*\s*new\s*\*|^\s*urgent\b\s*:?|\bundefined\b|\bnull\b", re.I)
CUTS = re.compile(r"\s+[-–—|/·]+\s+|[,|()\[\];–—:]")
FOLDED = str.maketrans({"ł": "l", "Ł": "l", "ø": "o", "Ø": "o", "ß": "ss", "æ": "ae", "đ": "d", "ı": "i"})


class Title(NamedTuple):
    level: str
    field: str
    team: str
    role: tuple[str, ...]


def fold(text: str) -> str:
    """Lower case without accents; compatibility forms unified."""
    text = unicodedata.normalize("NFKD", text.translate(FOLDED))
    return unicodedata.normalize("NFKC", "".join(c for c in text if not unicodedata.combining(c))).lower()


def parse_title(title: str | None, city: str | None = None) -> Title:
    """A title's parts; null, blank and noise titles have no role.

    The role comes as the pieces between commas, brackets and spaced dashes,
    in their order, each without level, field, place and reference marks.
    """
    if title is None:
        return Title("", "", "", ())
    text = MARKS.sub(" ", RESIDUE.sub(" ", title))
    text = MARKS.sub(" ", fold(text))
    place = " ".join(fold(city or "").split())
    levels, field, team, role = set(), "", "", []
    for part in CUTS.split(text):
        words = part.replace("/", " / ").split() if " / " in part else part.split()
        piece = " ".join(words).strip(" .-'*")
        if not piece or piece == place or piece in MODES:
            continue
        if words[-1] in TEAM_WORDS and len(words) <= 3:
            team = piece
            continue
        kept = []
        for word in words:
            bare = word.strip(".*'")
            if bare in LEVELS:
                levels.add(LEVELS[bare])
            elif bare in FIELDS:
                field = bare
            elif bare.strip("-–|/"):
                kept.append(bare)
        if kept and (len(kept) > 1 or kept[0] not in MODES):
            role.append(" ".join(kept))
    if ", ".join(role) in NOISE:
        role = []
    return Title("+".join(sorted(levels)), field, team, tuple(role))


def role_spellings(role: tuple[str, ...]) -> list[str]:
    """Ways to read a role's pieces: as they stand, turned round, and alone."""
    if not role:
        return []
    out = [" ".join(role)]
    if len(role) > 1:
        out += [" ".join(reversed(role)), role[0]]
    return list(dict.fromkeys(out))


PARTS_TYPE = "struct<level:string,field:string,team:string,role:string>"


def _parts(titles: pd.Series, cities: pd.Series) -> pd.DataFrame:
    rows = [parse_title(t, c) for t, c in zip(titles, cities)]
    return pd.DataFrame([(r.level, r.field, r.team, ", ".join(r.role)) for r in rows], columns=["level", "field", "team", "role"])


def title_parts(title: Column, city: Column) -> Column:
    """Level, field, team and role of a title column; the role's pieces are joined by commas."""
    ship_active()
    return F.pandas_udf(_parts, PARTS_TYPE)(title, city)
