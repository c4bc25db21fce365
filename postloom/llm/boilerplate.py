"""The main body of a page's text, told from the page around it.

Every description is read as a small tree: lines are paragraphs, runs of lines
are containers, the page is the root.  A paragraph earns points for its length
and its commas, discounted by its link density, and link text costs points.  A
container has the sum of its paragraphs' points and costs a fixed fee; the best
container and those siblings that earn their fee are kept, all other lines are
furniture.  So a heading beside the body stays with it, and the same words
among menus go with the menus.

Where a page still has its anchors, link density is the share of text inside
them.  Text that lost them is measured by a model of link text, which is
learned here from a bounded sample of pages.  It knows what a line looks like
(words, pairs of words, separators, case, length), and its labels come from the
pages themselves: lines that say what links of web pages commonly say (a short,
general list) are trusted links, lines that name the posting's own company or
run on for long are trusted body, and both labels spread to the lines that
stand beside them, over all pages of the sample, until each repeated line has
the share of links in its neighbourhood.  The clear cases teach the model, its
verdicts in their context make new clear cases, and it learns again.  The list
itself decides no line: it is not looked at when pages are scored.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.lines import anchor_share, plain
from postloom.session import spread_out

#: Rows of the sample from which link text is learned.
SAMPLE_ROWS = 8_000
#: Steps in which the trusted labels spread to neighbours, and rounds of learning.
SPREAD_STEPS = 30
ROUNDS = 3
GRADIENT_STEPS = 120
RIDGE = 1.0
#: Lines in which a feature must occur in the sample.
MIN_LINES = 3
#: Weights closer to 0 than this are dropped.
LEAST_WEIGHT = 0.02
#: Points of a paragraph from which it is trusted body in the sample.
LONG_POINTS = 1.0
#: Log odds that a neighbour of the same kind adds to a line while learning.
NEIGHBOUR = 1.4
#: Log odds that saying what links commonly say adds when pages are scored.
TRUST = 2.0
#: What a line of nothing but link text costs its container, and what a container costs.
LINK_COST = 1.0
CONTAINER_FEE = 0.5

# Labels of menus and footers of web pages in English, German, French and Spanish.
LINK_LABELS = """
home; menu; search; help; contact; about; blog; events; pricing; privacy; terms; imprint; cookies; log in; login; sign in; sign up; register; sitemap; jobs; companies; for employers; press
start; suche; hilfe; kontakt; impressum; datenschutz; agb; anmelden; registrieren; stellen; firmen; für arbeitgeber; presse
accueil; recherche; aide; contact; connexion; confidentialité; mentions légales; cgu; offres; entreprises; recruteurs
inicio; buscar; ayuda; contacto; acceder; regístrate; privacidad; aviso legal; empleos; empresas; prensa
"""
# What notices, prompts and links of web pages and job boards commonly say, anywhere in a line.
LINK_CALLS = """
skip to content; skip to main content; zum inhalt springen; aller au contenu; saltar al contenido
back to top; back to all; back to search; nach oben; zurück zu; haut de page; retour aux; volver arriba; volver a l
©; all rights reserved; alle rechte vorbehalten; tous droits réservés; todos los derechos; registered office
use cookies; uses cookies; accept cookies; about cookies; nutzt cookies; des cookies; usa cookies; your privacy; in your browser; on this site; on your device; auf deinem gerät; en tu dispositivo; audience
sign in; sign up; log in; create account; create an account; create a free account; create your account
subscribers; subscribe; newsletter abonnieren; abonnenten; abonnés; suscriptores
share this; teilen:; stelle teilen; partager; compartir; save job; report job
because you; near you; this week; similar jobs; also viewed; also like; may like; ähnliche stellen; auch interessant; offres similaires; voir aussi; empleos parecidos; te puede gustar
people applied; aufrufe; helpful?; search jobs; suche nach; rechercher; buscar empleo
"""
# The like where place or figures matter.
LINK_FORMS = r"^(?:advertisement|sponsored|anzeige|publicité|publicidad|more from .*)$|posted \d|\d views|version \d|(?:profile|vues|visitas)$|^get the .* app$|^follow .* on "

LABEL_SET = frozenset(x.strip() for x in re.split(r"[;\n]", LINK_LABELS) if x.strip())
CALLS = tuple(x.strip() for x in re.split(r"[;\n]", LINK_CALLS) if x.strip())
FORMS = re.compile(LINK_FORMS)
MENU_CUT = re.compile(r"\s*[|·•/›>»]\s*|\s{2,}")
SEPARATORS = "|·/•›>–-:"
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]")
DIGITS = re.compile(r"\d+")
NO_LETTER = re.compile(r"[\W\d_]+")


def trusted_link(text: str) -> bool:
    """Whether a line says what links commonly say; labels must make up half of its pieces."""
    low = text.lower()
    if any(x in low for x in CALLS) or FORMS.search(low):
        return True
    pieces = [p for p in MENU_CUT.split(low.strip(" |·•/")) if p]
    hits = sum(p in LABEL_SET for p in pieces)
    return hits > 0 and 2 * hits >= len(pieces)


def points(text: str) -> float:
    """What a paragraph without links passes up: for its length and its commas."""
    return 1 + min(len(text) / 100, 3) + (text.count(",") + text.count(";")) / 4


def features(text: str) -> list[str]:
    """How a line looks: its words and pairs of them, length, ends, case and separators; a short one as a whole."""
    words = ["#" if w[0].isdigit() else w for w in TOKEN.findall(text.lower())]
    if not words:
        return ["none"]
    count = len(words)
    spelt = [w[0] for w in text.split() if w[0].isalpha()]
    out = [
        *words, *map(" ".join, zip(["^", *words], [*words, "$"])), f"n:{count if count < 4 else 4 + min(8, (count - 4) // 4)}",
        "e:a" if text[-1].isalnum() else "e:" + text[-1], "b:A" if text[0].isupper() else "b:a" if text[0].isalpha() else "b:" + text[0],
        f"c:{4 * sum(map(str.isupper, spelt)) // max(1, len(spelt))}",
    ]
    if count <= 12:
        out.append("=" + " ".join(words))
    out += [f"s:{s}" for s in SEPARATORS if f" {s} " in text]
    return list(dict.fromkeys(out))


class Own(NamedTuple):
    """What a line must hold, or be, to speak of the posting itself."""

    company: str
    facts: frozenset[str]

    @classmethod
    def of(cls, company: str | None = None, *facts: str | None) -> Own:
        key = NO_LETTER.sub("", (company or "").lower())[:8]
        return cls(key if len(key) >= 5 else "", frozenset(x.strip().lower() for x in facts if x and x.strip()))

    def says(self, text: str) -> bool:
        low = text.lower()
        if self.company and self.company[:3] in low and self.company in NO_LETTER.sub("", low):
            return True
        return low in self.facts


class LinkModel:
    """Log odds that a line is link text: weights of its features, and of speaking of the posting."""

    def __init__(self, weights: dict[str, float], bias: float = 0.0, own: float = 0.0):
        self.weights, self.bias, self.own = weights, bias, own

    def odds(self, text: str) -> float:
        """Log odds of a line that does not speak of the posting.

        A model that could learn nothing (hardly any lines) takes the trusted
        links for links and all else for text.
        """
        if not self.weights:
            return 4.0 if trusted_link(text) else -4.0
        known = [w for w in map(self.weights.get, features(text)) if w is not None]
        return self.bias + (sum(known) / math.sqrt(len(known)) if known else 0.0) + (TRUST if trusted_link(text) else 0.0)

    def density(self, text: str, own: bool = False) -> float:
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, self.odds(text) + (self.own if own else 0.0)))))

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as file:
            json.dump([self.weights, self.bias, self.own], file, ensure_ascii=False)

    @classmethod
    def load(cls, path: str) -> LinkModel:
        with open(path, encoding="utf-8") as file:
            return cls(*json.load(file))


def _regress(rows: list[np.ndarray], own: np.ndarray, count: np.ndarray, share: np.ndarray, width: int) -> tuple[np.ndarray, float, float]:
    """Logistic regression of the share of links on features (mean-like sums), by adaptive gradient steps."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    norm = 1 / np.sqrt(np.maximum(1, np.bincount(at, minlength=len(rows))))
    weight, bias, own_weight = np.zeros(width), 0.0, 0.0
    seen, seen_bias, seen_own = np.full(width, 1e-8), 1e-8, 1e-8
    for _ in range(GRADIENT_STEPS):
        z = np.bincount(at, weight[what], len(rows)) * norm + bias + own_weight * own
        error = count * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - share)
        slope = np.bincount(what, (error * norm)[at], width) + RIDGE * weight
        seen += slope * slope
        weight -= slope / np.sqrt(seen)
        s, o = error.sum(), (error * own).sum()
        seen_bias, seen_own = seen_bias + s * s, seen_own + o * o
        bias, own_weight = bias - 0.5 * s / math.sqrt(seen_bias), own_weight - 0.5 * o / math.sqrt(seen_own)
    return weight, bias, own_weight


def fit(pages: Iterable[list[tuple[str, bool]]]) -> LinkModel:
    """Learn link text from pages, each a list of (text, whether it speaks of the posting).

    Digits do not matter and equal lines share what is learned of them.  Pages
    without lines teach nothing; without trusted lines of both kinds the model
    is empty.
    """
    index: dict[str, int] = {}
    ids: dict[str, int] = {}
    rows: list[np.ndarray] = []
    link, long, line, own, first, last = [], [], [], [], [], []
    for page in pages:
        for k, (text, mine) in enumerate(page):
            shape = DIGITS.sub("#", text)
            j = ids.get(shape)
            if j is None:
                j = ids[shape] = len(rows)
                rows.append(np.array([index.setdefault(f, len(index)) for f in features(shape)], dtype=np.int64))
                link.append(trusted_link(text))
                long.append(points(text) > 1 + LONG_POINTS)
            line.append(j)
            own.append(mine)
            first.append(k == 0)
            last.append(k == len(page) - 1)
    if not line:
        return LinkModel({})
    lines, mine = np.array(line), np.array(own)
    n, kinds = len(lines), 2 * len(rows)
    is_link = np.array(link)[lines] & ~mine
    is_body = mine | (np.array(long)[lines] & ~is_link)
    if not is_link.any() or not is_body.any():
        return LinkModel({})
    here = np.arange(n)
    before, after = np.where(first, here + 1, here - 1), np.where(last, here - 1, here + 1)
    lone = np.array(first) & np.array(last)
    before, after = np.where(lone, here, before), np.where(lone, here, after)
    kind = lines * 2 + mine
    times = np.maximum(1, np.bincount(kind, minlength=kinds))
    # the trusted labels spread: a repeated line takes the mean of its neighbours everywhere
    base = is_link.mean() / (is_link.mean() + is_body.mean())
    belief = np.full(n, base)
    for _ in range(SPREAD_STEPS):
        belief = np.where(is_link, 1.0, np.where(is_body, 0.0, belief))
        belief = (np.bincount(kind, 0.5 * (belief[before] + belief[after]), kinds) / times)[kind]
    high, low = base + 0.3 * (1 - base), 0.7 * base
    occurs = np.bincount(np.concatenate(rows), minlength=len(index))
    kept = [r[occurs[r] >= min(MIN_LINES, max(1, len(rows) // 100))] for r in rows]
    weight, bias, own_weight = np.zeros(len(index)), 0.0, 0.0
    for _ in range(ROUNDS):
        links = ((belief >= high) & ~is_body) | (is_link & (belief > low))
        clear = links | ((belief <= low) & ~is_link) | is_body
        names, at = np.unique(kind[clear], return_inverse=True)
        count = np.bincount(at).astype(float)
        share = np.bincount(at, links[clear].astype(float)) / count
        weight, bias, own_weight = _regress([kept[k // 2] for k in names], (names % 2).astype(float), np.sqrt(count), share, len(index))
        z = np.array([weight[r].sum() / math.sqrt(max(1, len(r))) for r in kept])[lines] + bias + own_weight * mine
        push = np.tanh(np.clip(z, -6, 6) / 2)
        belief = 1 / (1 + np.exp(-np.clip(z, -6, 6) - NEIGHBOUR * (push[before] + push[after])))
        belief = (np.bincount(kind, belief, kinds) / times)[kind]
        high, low = 0.8, 0.2
    return LinkModel({f: round(float(weight[i]), 4) for f, i in index.items() if abs(weight[i]) >= LEAST_WEIGHT}, bias, own_weight)


def body_lines(scores: list[float], fee: float = CONTAINER_FEE) -> list[bool]:
    """Which lines the best container and its paying siblings hold.

    The kept runs are those whose points less their fees are most in all; the
    first of them is the best container.  Exact, in one pass over the page.
    """
    out_best, in_best = 0.0, -fee
    steps = []
    for s in scores:
        stay_out, stay_in = out_best >= in_best, in_best >= out_best - fee
        steps.append((stay_out, stay_in))
        out_best, in_best = max(out_best, in_best), max(in_best, out_best - fee) + s
    keep, inside = [], in_best > out_best
    for stay_out, stay_in in reversed(steps):
        keep.append(inside)
        inside = stay_in if inside else not stay_out
    return keep[::-1]


def furniture_lines(description: str | None, model: LinkModel, own: Own = Own("", frozenset()), cache: dict | None = None) -> list[int]:
    """Numbers (from 1) of the lines that are page furniture; blank lines are none.

    Error messages and template residue are no furniture wherever they stand.
    """
    from postloom.llm.residue import TRUSTED_PATTERN

    if not description:
        return []
    numbers, texts, scores = [], [], []
    for number, raw in enumerate(description.split("\n"), 1):
        known = cache.get(raw) if cache is not None else None
        if known is None:
            text = plain(raw)
            shape = "\n" + DIGITS.sub("#", text)
            odds = (cache.get(shape) if cache is not None else None) or (model.odds(text) if text else 0.0)
            known = (text, points(text) if text else 0.0, odds, anchor_share(raw))
            if cache is not None:
                if len(cache) > 200_000:
                    cache.clear()
                cache[raw], cache[shape] = known, odds
        text, worth, odds, linked = known
        if not text:
            continue
        if own.says(text):
            odds += model.own
        density = max(linked, 1 / (1 + math.exp(-min(30.0, max(-30.0, odds)))))
        numbers.append(number)
        texts.append(text)
        scores.append(worth * (1 - density) - LINK_COST * density)
    out = []
    for n, text, keep in zip(numbers, texts, body_lines(scores)):
        if keep:
            continue
        broken = cache.get("\r" + text) if cache is not None else None
        if broken is None:
            broken = bool(TRUSTED_PATTERN.search(text))
            if cache is not None:
                cache["\r" + text] = broken
        if not broken:
            out.append(n)
    return out


ROW_COLUMNS = ("row_id", "description", "company", "city", "work_type")


def _needed(rows: DataFrame) -> DataFrame:
    """The columns that are read; those of the posting's own facts may be missing."""
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ROW_COLUMNS]).filter("description is not null")


def fit_sample(rows: DataFrame) -> LinkModel:
    """The model of link text of a bounded sample of rows, the same for the same table.

    A hash of the row's number decides, against the table's count, so about
    ``SAMPLE_ROWS`` rows come to the driver at every size.
    """
    pages = _needed(rows)
    count = max(1, pages.count())
    spot = F.pmod(F.xxhash64("row_id"), F.lit(1_000_003)) / 1_000_003.0
    taken = pages.filter(spot < SAMPLE_ROWS / count).orderBy("row_id", "description").limit(2 * SAMPLE_ROWS)

    def read() -> Iterator[list[tuple[str, bool]]]:
        for r in taken.toPandas().itertuples(index=False):
            own = Own.of(r.company, r.city, r.work_type)
            yield [(t, own.says(t)) for t in map(plain, r.description.split("\n")) if t]

    return fit(read())


def furniture(rows: DataFrame, model: LinkModel | None = None) -> DataFrame:
    """(row_id, line_no) of each furniture line of ``description``.

    ``company``, ``city`` and ``work_type`` tell, where the table has them,
    which lines speak of the posting.  A row without description gives nothing;
    repeated rows repeat their lines; very long texts are read whole, line by
    line.  No shuffle is needed beyond spreading a small table.
    """
    model = model or fit_sample(rows)
    shared = rows.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.own))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge, cache = LinkModel(*shared.value), {}
        for pdf in batches:
            keys, numbers = [], []
            for r in pdf.itertuples(index=False):
                hits = furniture_lines(r.description, judge, Own.of(r.company, r.city, r.work_type), cache)
                keys += [r.row_id] * len(hits)
                numbers += hits
            yield pd.DataFrame({"row_id": pd.Series(keys, dtype="int64"), "line_no": pd.Series(numbers, dtype="int32")})

    return spread_out(_needed(rows)).mapInPandas(found, "row_id long, line_no int")


def body_text(description: str | None, model: LinkModel, own: Own = Own("", frozenset())) -> str | None:
    """The description without its furniture; null stays null."""
    if description is None:
        return None
    drop = set(furniture_lines(description, model, own))
    return "\n".join(line for n, line in enumerate(description.split("\n"), 1) if n not in drop)
