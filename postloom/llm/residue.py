"""Template residue, filler and error messages instead of content.

A naive Bayes model is learned from positive and unlabelled passages by
expectation-maximisation: passages that match a short list of common error and
placeholder patterns are trusted positives, all others are unlabelled; each
round re-estimates the words of both classes, and the share of residue within
stated bounds, from the unlabelled passages' current odds.  The fitted weights
alone score every passage of every record, and a record is reported when one of
its passages is more likely residue than content.

Only the fit uses a sample, of about ``SAMPLE_ROWS`` records taken by hash over
the whole table: all those with trusted patterns, and ``UNLABELLED_ROWS`` of
the others.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.lines import plain
from postloom.session import spread_out

#: Bounds of the sample on which the model is fitted: rows that are looked
#: through for trusted patterns, and rows of them that count as unlabelled.
SAMPLE_ROWS = 24_000
UNLABELLED_ROWS = 6000
ROUNDS = 5
#: Odds from which an unlabelled passage counts for the positive class in the next round.
CONFIDENT = 0.99
#: The prior that expectation-maximisation finds lies between the trusted share of passages and so many times it.
MOST_PRIOR = 2.0
#: Passages of the common rate that each class is mixed with when it is counted.
PULL = 20
#: A feature must occur in so many passages of the sample to count.
MIN_PASSAGES = 3
SMOOTHING = 0.5
#: Weights between 0 and this are dropped: residue has to show in clear signs.
LEAST_WEIGHT = 0.3
#: Odds (log) from which a passage is residue.
THRESHOLD = 0.0

# Placeholders of common template languages, by their brackets.
SLOT = re.compile(
    r"\{\{.*?\}\}|\{%.*?%\}|\$\{.*?\}|<%.*?%>|\[\[.*?\]\]|@@.*?@@|__\w+?__|%[A-Za-z]\w*%|\$[A-Za-z]\w*\$|#[A-Z_]{3,}#|~\w+~|«[^«»]*»|\{[^{}]*\}|<[^<>]*>|\[[^\[\]]*\]"
)
# Names of fields that stand in brackets until they are filled in.
FIELD_NAMES = (
    "company|client|candidate|employer|city|location|place|deadline|level|title|job|role|position|team|department|name|date|salary|contact|url"
    "|firma|firmenname|stadt|ort|stelle|entreprise|ville|poste|intitulé|nom|empresa|puesto|ciudad|nombre"
)
# Common signs of placeholders, filler, error pages and script notices; they label the fit and judge nothing.
TRUSTED = (
    r"\{\{|\{%|\{\w+\}|\$\{|<%=|@@\w|__[A-Za-z_]+__|\[\[|%[A-Za-z]\w*%|\$[A-Za-z]\w*\$|#[A-Z_]{3,}#|\[object Object\]"
    rf"|(?i:[\[<](?:insert|enter|add|your|{FIELD_NAMES})\b)"
    r"|(?i:\blorem\b|\bipsum\b|\bamet\b|text goes here|title goes here|^untitled\b|\bsample (?:text|job)\b)|\bXXX\b|\bTODO\b|\bundefined\b"
    r"|(?i:enable javascript|activer javascript|activa javascript|aktivieren sie javascript|needs (?:scripts|javascript)|support to run)"
    r"|(?i:\b(?:http|error|status) [45]\d\d\b|^\W*[45]\d\d (?:\||–|not found|service)|bad gateway|gateway time|service (?:temporarily )?unavailable|internal server error|too many requests|access denied|upstream|^fatal:)"
    r"|(?i:you are not a robot|checking your browser|session has expired|sitzung abgelaufen|page not found|seite nicht gefunden|page introuvable|página no encontrada|something went wrong|no longer here|has been blocked)"
)
TRUSTED_PATTERN = re.compile(TRUSTED)


@lru_cache(maxsize=400_000)
def trusted_residue(passage: str) -> bool:
    """Whether a passage shows one of the signs that label the fit."""
    return bool(TRUSTED_PATTERN.search(passage))


SLOT_SIGN = re.compile(r"[{\[<@_%#~«$]")
SENTENCE = re.compile(r"(?<=[.!?…])\s+")
#: The customary note on gender, no word of its own.
GENDER = re.compile(r"\(\s*[mfwdhx](?:\s*/\s*[mfwdhx])+\s*\)", re.I)
WORD = re.compile(r"[^\W_]+|[^\w\s]")
HEX = re.compile(r"(?=.*[0-9])[0-9a-f]+")


def slot_features(slot: str) -> list[str]:
    """What a bracketed passage shows: its brackets, its words and their case."""
    inner = re.sub(r"^[\W_]+|[\W_]+$", "", slot)
    style = slot[: max(1, len(slot) - len(slot.lstrip("{[<@_%#~«$=")))]
    words = re.findall(r"[^\W_]+", inner)
    case = "upper" if inner.isupper() else "lower" if inner.islower() else "mixed"
    return [f"style:{style}", f"case:{style}{case}", *(f"slot:{w.lower()}" for w in words if not w.isdigit())]


def word_features(text: str) -> list[str]:
    """Words and pairs of neighbouring words; numbers by their kind."""
    words = WORD.findall((GENDER.sub(" ", text) if "/" in text else text).lower())
    for i, low in enumerate(words):
        if low[0] <= "9" and low[0] >= "0" or len(low) >= 8:
            if low.isdigit():
                words[i] = "#code" if len(low) == 3 and low[0] in "45" else "#"
            elif len(low) >= 8 and HEX.fullmatch(low):
                words[i] = "#hex"
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def passages(text: str) -> Iterable[tuple[str, bool]]:
    """A line's passages: each slot, and each sentence of the text around them."""
    rest = text
    if SLOT_SIGN.search(text):
        slots = SLOT.findall(text)
        if slots:
            for slot in slots:
                yield slot, True
            rest = SLOT.sub(" ", text)
    for sentence in SENTENCE.split(rest):
        if sentence.strip():
            yield sentence.strip(), False


def features(passage: str, slot: bool) -> list[str]:
    return list(dict.fromkeys(slot_features(passage) if slot else word_features(passage)))


def record_lines(title: str | None, description: str | None) -> Iterable[str]:
    if title and title.strip():
        yield plain(title)
    if description:
        for line in description.split("\n"):
            text = plain(line)
            if text:
                yield text


class Model:
    """Weights (log odds) of features; slots and sentences have a class prior each."""

    def __init__(self, slot_prior: float, text_prior: float, weights: dict[str, float]):
        self.slot_prior, self.text_prior, self.weights = slot_prior, text_prior, weights

    def odds(self, passage: str, slot: bool) -> float:
        get = self.weights.get
        return (self.slot_prior if slot else self.text_prior) + sum(get(f, 0.0) for f in features(passage, slot))

    def residue(self, passage: str, slot: bool) -> bool:
        """Whether a passage is residue, by its weights alone.

        A model that could learn nothing (hardly any passages) takes the
        trusted passages for residue.
        """
        if not self.weights:
            return trusted_residue(passage)
        return self.odds(passage, slot) > THRESHOLD

    def flags(self, line: str) -> bool:
        """Whether a passage of the line is residue."""
        return any(self.residue(p, s) for p, s in passages(line))

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as file:
            json.dump([self.slot_prior, self.text_prior, self.weights], file, ensure_ascii=False)

    @classmethod
    def load(cls, path: str) -> Model:
        with open(path, encoding="utf-8") as file:
            return cls(*json.load(file))


def _bound(feature: str) -> float:
    """Largest weight of a feature: brackets alone decide nothing."""
    return 1.0 if feature.startswith("style:") else 0.5 if feature.startswith("case:") else 8.0


def _learn(positive: Counter[str], unlabelled: Counter[str], slot: bool) -> tuple[float, dict[str, float]]:
    """Prior and weights from counted trusted and unlabelled passages."""
    items = [(p, True, n) for p, n in positive.items()] + [(p, False, n) for p, n in unlabelled.items()]
    spread: Counter[str] = Counter()
    rows = []
    for p, _, n in items:
        fs = features(p, slot)
        rows.append(fs)
        for f in fs:
            spread[f] += n
    index = {f: i for i, f in enumerate(f for f, n in spread.items() if n >= MIN_PASSAGES)}
    pairs = [(r, index[f]) for r, fs in enumerate(rows) for f in fs if f in index]
    if not pairs or not unlabelled:
        return -1.0, {}
    which, what = np.array(pairs, dtype=np.int64).T
    weight = np.array([n for _, _, n in items], dtype=float)
    known = np.array([k for _, k, _ in items])
    trusted = known | np.array([trusted_residue(p) for p, _, _ in items])
    bound = np.array([_bound(f) for f in index])
    belief = trusted.astype(float)
    free = ~known
    least = (weight[free & trusted].sum() + 1) / (weight[free].sum() + 2)
    prior = math.log(least / (1 - least))
    beta = np.zeros(len(index))
    for _ in range(ROUNDS):
        sure = np.where(belief >= CONFIDENT, belief, 0.0)
        pos, neg = weight * sure, weight * (1 - belief)
        cp, cn = np.bincount(what, pos[which], len(index)), np.bincount(what, neg[which], len(index))
        # both rates are drawn towards the common one, so a few chance meetings weigh little
        common = (cp + cn + SMOOTHING) / (pos.sum() + neg.sum() + 1)
        beta = np.log((cp + PULL * common) / (pos.sum() + PULL)) - np.log((cn + PULL * common) / (neg.sum() + PULL))
        beta = np.clip(np.where((beta > 0) & (cp < MIN_PASSAGES), 0.0, beta), -bound, bound)
        score = prior + np.bincount(which, beta[what], len(items))
        belief = np.where(trusted, 1.0, 1 / (1 + np.exp(-np.clip(score, -30, 30))))
        # the share of residue follows the beliefs, within its bounds: passages without known features must not raise it round by round
        share = (weight[free] * belief[free]).sum() / weight[free].sum()
        share = min(max(share, least), MOST_PRIOR * least, 0.5)
        prior = math.log(share / (1 - share))
    names = list(index)
    return prior, {names[i]: float(b) for i, b in enumerate(beta) if not 0 <= b < LEAST_WEIGHT}


def fit(trusted_lines: Iterable[str], unlabelled_lines: Iterable[str]) -> Model:
    """Learn from records with trusted patterns and from unlabelled ones.

    Of the former only the trusted passages count, as labelled positives; the
    latter count whole, and while fitting their trusted passages keep their label.
    """
    counts = {(kind, slot): Counter() for kind in ("p", "u") for slot in (True, False)}
    for kind, lines in (("p", trusted_lines), ("u", unlabelled_lines)):
        for line in lines:
            for passage, slot in passages(line):
                if kind == "u" or trusted_residue(passage):
                    counts[kind, slot][passage] += 1
    slot_prior, slot_weights = _learn(counts["p", True], counts["u", True], True)
    text_prior, text_weights = _learn(counts["p", False], counts["u", False], False)
    return Model(slot_prior, text_prior, slot_weights | text_weights)


def fit_sample(rows: DataFrame) -> tuple[list[str], list[str]]:
    """Lines of the bounded sample (trusted, unlabelled), the same for the same table.

    A hash of the row's number decides, against the table's count, so nothing
    is sorted and the work after the scan is the same at every size.
    """
    text = rows.select("row_id", "title", "description")
    count = max(1, rows.count())
    spot = F.pmod(F.xxhash64("row_id"), F.lit(1_000_003)) / 1_000_003.0
    taken = text.withColumn("spot", spot).filter(F.col("spot") < SAMPLE_ROWS / count)
    other = F.col("spot") < UNLABELLED_ROWS / count
    trusted = F.coalesce(F.concat_ws("\n", "title", "description").rlike("(?m)" + TRUSTED), F.lit(False))
    kept = spread_out(taken).select("title", "description", other.alias("other"), trusted.alias("trusted")).filter("other or trusted").limit(2 * SAMPLE_ROWS)
    positive: list[str] = []
    unlabelled: list[str] = []
    for r in kept.toLocalIterator():
        lines = list(record_lines(r.title, r.description))
        if r.trusted:
            positive += lines
        if r.other:
            unlabelled += lines
    return positive, unlabelled


def residue(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """(row_id) of records whose title or description holds residue.

    Each row is judged once, however many passages flag it; repeated rows stay
    repeated.  Null and blank texts hold nothing.  Texts are read whole.  Without
    ``model`` one is fitted on a sample of the rows.
    """
    model = model or fit(*fit_sample(rows))
    shared = rows.sparkSession.sparkContext.broadcast((model.slot_prior, model.text_prior, model.weights))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Model(*shared.value)
        cache: dict[str, bool] = {}
        for pdf in batches:
            hits = []
            for key, title, description in zip(pdf["row_id"], pdf["title"], pdf["description"]):
                lines = [title] if title else []
                if description:
                    lines += description.split("\n")
                for raw in lines:
                    flag = cache.get(raw)
                    if flag is None:
                        if len(cache) > 200_000:
                            cache.clear()
                        flag = cache[raw] = judge.flags(plain(raw))
                    if flag:
                        hits.append(key)
                        break
            yield pd.DataFrame({"row_id": pd.Series(hits, dtype="int64")})

    return spread_out(rows.select("row_id", "title", "description")).mapInPandas(found, "row_id long")
