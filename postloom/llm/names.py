"""Spellings of one organisation linked together.

A name is taken apart into name words, line of business and notes (legal form,
region); different spellings with the same parts collapse first, so the costly
steps see distinct forms only.  Forms meet in blocks of the phonetic codes of
their sorted words, pairs are compared by Jaro-Winkler with a table of
nicknames, and accepted pairs of complete forms are clustered by connected
components.  A form that lacks a part then joins the only cluster it fits.

An index of linked names lives on: ``extend_names`` links new names to its
clusters without reading linked names again.  A label once given never changes;
where a new spelling shows two clusters to be one, an alias row says so.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm.canonical import one_slip_apart
from postloom.llm.components import connected_components
from postloom.llm.titles import fold
from postloom.session import cut, ship

# What stands where no organisation is named.
NOBODY = frozenset(
    ["", "unknown", "confidential", "n/a", "na", "none", "null", "undefined", "anonymous", "private", "undisclosed", "not specified", "various", "tbd", "-", "company", "client", "test"]
)
# Legal forms, without points.
LEGAL = frozenset("gmbh mbh ltd limited llc inc incorporated bv nv sl sa sas sarl srl spa oy oyj ab as aps co corp corporation company plc ag kg ug pty pte llp lp kk sp zoo".split())
# Words of notes in brackets that name a region.
REGIONS = frozenset("europe eu emea uk us usa germany deutschland france spain americas asia apac international global worldwide north south".split())
# Lines of business and their short forms.
LINES = {
    "animation": "anim", "collective": "coll", "design": "des dsgn", "games": "gms game", "interactive": "intv inter",
    "media": "med", "pictures": "pics pic", "press print": "", "productions": "prod prods production",
    "publishing": "publ pub", "records": "rec recs record", "studio": "std studios", "type foundry": "foundry", "workshop": "wkshp wks",
}
# Given names and their short forms.
NICKNAMES = {
    "alexander": "alex sascha sasha xander lex", "dimitrios": "dimi dimitri mitsos jim", "elizabeth": "beth liz lizzy betty eliza ella lisa",
    "francisco": "paco cisco pancho fran kiko", "giuseppe": "beppe peppe pino", "johannes": "hannes jo johann hans", "katherine": "kate kathy katie kat kathryn",
    "margaret": "maggie peggy meg greta marge", "nicholas": "nick nico klaus nicky", "robert": "rob bob bobby robbie bert", "samuel": "sam sammy",
    "theodora": "thea dora theo", "victoria": "vicky tori vicki", "william": "will bill billy liam willy",
}


class NameTables:
    """The tables by which names are read; each may be replaced."""

    def __init__(self, nicknames: dict[str, str] = NICKNAMES, lines: dict[str, str] = LINES, legal: frozenset[str] = LEGAL, regions: frozenset[str] = REGIONS, nobody: frozenset[str] = NOBODY):
        self.given, self.lines, self.legal, self.regions, self.nobody = frozenset(nicknames), lines, legal, regions, nobody
        self.full_name = {short: full for full, shorts in nicknames.items() for short in [full, *shorts.split()]}
        self.line_of = {short: line for line, shorts in lines.items() for short in [line, *shorts.split()]}


DEFAULT = NameTables()
#: Jaro-Winkler similarity from which two words are one word with a slip.  Words with a slip
#: measure 0.78 and more, the words of different names 0.67 and less.
ALIKE = 0.75
#: Words of fewer letters must also differ by no more than one slip.
SHORT_WORD = 5


class Form(NamedTuple):
    words: tuple[str, ...]
    initial: str
    line: str
    joined: bool


def jaro_winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity, 1 for equal strings."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    used = [False] * len(b)
    hits = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    other = [b[j] for j in range(len(b)) if used[j]]
    swaps = sum(x != y for x, y in zip(hits, other)) / 2
    m = len(hits)
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


# Letters that sound alike, in the order in which they are replaced; all vowels sound as one.
SOUNDS = (
    ("tsch|sch|sh", "s"), ("ph", "f"), ("gh|ck|qu", "k"), ("th|dt", "t"), ("tz|ts", "s"), ("x", "ks"), ("c(?=[eiy])", "s"), ("[cqgk]", "k"),
    ("[zß]", "s"), ("[vw]", "f"), ("d", "t"), ("b", "p"), ("j", "y"), ("(?<=[aeiouy])h", ""), ("[aeiouy]+", "a"),
)
_SOUNDS = tuple((re.compile(a), b) for a, b in SOUNDS)


def phonetic(word: str) -> str:
    """Code of a word's sound: like letters share a sign, doubled ones count once."""
    for letters, sound in _SOUNDS:
        word = letters.sub(sound, word)
    return re.sub(r"(.)\1+", r"\1", word)


def _near_line(parts: list[str], tables: NameTables) -> tuple[int, int, str] | None:
    """(place, words, line) of a line of business with a slip in its spelling."""
    for line in tables.lines:
        words = line.split()
        for k in range(len(parts) - len(words) + 1):
            if min(map(len, parts[k : k + len(words)])) >= 4 and all(one_slip_apart(x, y) for x, y in zip(parts[k:], words)):
                return k, len(words), line
    return None


def parse_name(name: str | None, tables: NameTables = DEFAULT) -> Form | None:
    """The parts of an organisation's name; None where it names nobody.

    ``words`` are the sorted name words (given names in full), ``initial`` a
    given name cut to its first letters, ``line`` the line of business or "",
    and ``joined`` tells that the words ran together (handles, slugs).
    """
    if name is None:
        return None
    raw = name.strip()
    handle = raw.startswith("@")
    raw = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", raw.lstrip("@"))
    text = " ".join(fold(raw).split())
    if text in tables.nobody:
        return None
    slug = bool(re.fullmatch(r"[a-z]+(?:-[a-z]+)+", text)) and raw == raw.lower()
    text = re.sub(r"\b(?:[a-z]\.){2,}", lambda m: m.group().replace(".", ""), text)
    text = re.sub(r"['’]s\b", "", text)
    text = re.sub(r"\(([^)]*)\)", lambda m: " " if set(m.group(1).split()) <= tables.regions else f" {m.group(1)} ", text)
    text = re.sub(r"\bpress\s*(?:&|\+|and|-|\s)\s*pr\w{3,5}\b", " press_print ", text)
    text = re.sub(r"\btype[\s-]+found\w{2,3}\b", " type_foundry ", text)
    text = re.sub(r"^the\s+", "", text)
    parts = [w for w in re.split(r"[\s,/&+@-]+", text) if w and w != "and"]
    while len(parts) > 1 and parts[-1].strip(".") in tables.legal:
        parts.pop()
    line, words, initial = "", [], ""
    if len(parts) > 1 and not any(p.strip(".").replace("_", " ") in tables.line_of for p in parts):
        near = _near_line(parts, tables)
        if near:
            parts[near[0] : near[0] + near[1]] = [near[2].replace(" ", "_")]
    for k, part in enumerate(parts):
        bare = part.strip(".").replace("_", " ")
        found = tables.line_of.get(bare) if len(parts) > 1 else None
        if found and not line:
            line = found
        elif part.endswith(".") and len(bare) <= 3 and not initial:
            initial = bare
        elif len(bare) == 1 and not initial:
            initial = bare
        elif bare:
            words.append(tables.full_name.get(bare, bare))
    if not words:
        return None
    joined = (handle or slug) and len(words) == 1
    return Form(tuple(sorted(words)), initial, line, joined)


def complete(form: Form) -> bool:
    """Whether a form names given name, family name and line."""
    return bool(form.line) and not form.initial and len(form.words) >= 2 and not form.joined


def spellings(word: str) -> list[str]:
    """Keys of a word: its sound, itself, and it with one letter left out, which any single slip leaves in common."""
    out = [f"={phonetic(word)}", f"~{word}"]
    if len(word) >= 4:
        out += [f"~{word[:i]}{word[i + 1:]}" for i in range(len(word))]
    return out


def slip_keys(words: tuple[str, ...]) -> list[str]:
    """Keys that two lists of sorted words share if they agree in all words but one, and that one may be one word with a slip."""
    return [f"{' '.join(words[:i] + words[i + 1:])}|{key}" for i, word in enumerate(words) for key in spellings(word)]


def block_keys(form: Form, tables: NameTables = DEFAULT) -> list[str]:
    """Blocks in which a form looks for complete forms.

    Complete forms meet within their line of business and with all words but
    one the same, so common words alone bring nobody together.  Other forms
    look for what they lack: the given name behind an initial, the words that
    run together or stand alone, or the line.
    """
    if complete(form):
        keys = [f"L|{form.line}|{key}" for key in slip_keys(form.words)]
    elif form.initial:
        keys = [f"I|{form.initial[0]}|{key}" for key in slip_keys(form.words)]
    elif len(form.words) == 1:
        keys = [] if form.words[0] in tables.given else [f"S|{key}" for key in spellings(form.words[0])]
    else:
        keys = [f"W|{key}" for key in slip_keys(form.words)]
    return list(dict.fromkeys(keys))


def home_keys(form: Form, tables: NameTables = DEFAULT) -> list[str]:
    """Blocks in which a complete form is found; none for others."""
    if not complete(form):
        return []
    keys = block_keys(form, tables) + [f"W|{key}" for key in slip_keys(form.words)]
    for i, rest in enumerate(form.words):
        keys += [f"I|{rest[0]}|{key}" for key in slip_keys(form.words[:i] + form.words[i + 1 :])]
    alone = [w for w in form.words if w not in tables.given] + ["".join(form.words), "".join(form.words[::-1])]
    return list(dict.fromkeys(keys + [f"S|{key}" for word in alone for key in spellings(word)]))


def alike(a: str, b: str) -> bool:
    """Whether two words may be one word with a slip: by Jaro-Winkler, short ones by their slips as well."""
    if a == b:
        return True
    shorter = min(len(a), len(b))
    return shorter >= 4 and jaro_winkler(a, b) >= ALIKE and (shorter >= SHORT_WORD or one_slip_apart(a, b))


def same_words(a: tuple[str, ...], b: tuple[str, ...], tables: NameTables = DEFAULT) -> bool:
    """Whether the words agree in some order but for at most one, which is alike; two given names never are."""
    if len(a) != len(b):
        return False
    left, right = list(a), list(b)
    for w in a:
        if w in right:
            left.remove(w)
            right.remove(w)
    if not left:
        return True
    return len(left) == 1 and not (left[0] in tables.given and right[0] in tables.given) and alike(left[0], right[0])


def same_organisation(a: Form, b: Form, tables: NameTables = DEFAULT) -> bool:
    """Whether two complete forms name one organisation."""
    return a.line == b.line and same_words(a.words, b.words, tables)


def fits(part: Form, whole: Form, same: Callable[[str, str], bool] = alike, tables: NameTables = DEFAULT) -> bool:
    """Whether a form that lacks something may stand for a complete one; ``same`` compares words."""
    if part.line and part.line != whole.line:
        return False
    if part.initial:
        rest = list(whole.words)
        for w in part.words:
            hit = next((x for x in rest if same(w, x)), None)
            if hit is None:
                return False
            rest.remove(hit)
        return len(rest) == 1 and rest[0].startswith(part.initial)
    if len(part.words) == 1 and len(whole.words) >= 2:
        word = part.words[0]
        if word in tables.given:
            return False
        sequences = ["".join(whole.words), "".join(reversed(whole.words))]
        if any(same(word, s) for s in sequences):
            return True
        return not part.joined and any(x not in tables.given and same(word, x) for x in whole.words)
    return part.words == whole.words or (same is alike and same_words(part.words, whole.words, tables))


FORM_TYPE = "name string, form string, whole boolean, blocks array<string>, homes array<string>"


def read_form(text: str) -> Form:
    words, initial, line, joined = text.split("|")
    return Form(tuple(words.split(" ")), initial, line, joined == "1")


class NameIndex(NamedTuple):
    """Linked names that later names are linked to.

    ``names``: name, organisation; ``forms``: form, whole, blocks, homes,
    organisation, settled (whether a form that lacks a part has found its
    cluster); ``aliases``: organisation, root (clusters that turned out to be
    one).  Rows are only ever appended; an alias is followed when labels are
    compared, see ``resolved``.
    """

    names: DataFrame
    forms: DataFrame
    aliases: DataFrame

    def save(self, folder: str) -> None:
        for part, df in self._asdict().items():
            df.write.mode("overwrite").parquet(f"{folder}/{part}")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> NameIndex:
        return cls(*[spark.read.parquet(f"{folder}/{part}") for part in cls._fields])


def resolved(labelled: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rows with ``organisation`` replaced by the cluster that it belongs to."""
    others = [c for c in labelled.columns if c != "organisation"]
    return labelled.join(aliases, "organisation", "left").select(*others, F.coalesce("root", "organisation").alias("organisation"))


def _parser(tables: NameTables) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name in pdf["name"]:
                form = parse_name(name, tables)
                if form:
                    key = f"{' '.join(form.words)}|{form.initial}|{form.line}|{int(form.joined)}"
                    rows.append((name, key, complete(form), block_keys(form, tables), home_keys(form, tables)))
            yield pd.DataFrame(rows, columns=["name", "form", "whole", "blocks", "homes"])

    return parse


def _judge(tables: NameTables) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            forms = [(read_form(a), read_form(b), w) for a, b, w in zip(pdf["a"], pdf["b"], pdf["both"])]
            keep = [same_organisation(a, b, tables) if w else fits(a, b, alike, tables) for a, b, w in forms]
            exact = [k and not w and fits(a, b, operator.eq, tables) for k, (a, b, w) in zip(keep, forms)]
            yield pdf.assign(exact=exact)[keep]

    return judge


def extend_names(names: DataFrame, known: NameIndex | None = None, tables: NameTables = DEFAULT) -> NameIndex:
    """The index with the distinct values of the column ``name`` linked as well.

    Values that name nobody are left out; so is nothing else: a value without
    partners has an organisation of its own (its form), and a partial form that
    fits several clusters gets one that no other value shares.  Null values are
    ignored.  Names that the index holds are not read again; new forms meet
    each other and the forms of the index.  A new cluster that is near to an
    old one takes its label; old clusters that a new form joins get an alias to
    the smallest of them, and so does a partial form of the index that finds
    its cluster only now.
    """
    spark = names.sparkSession
    ship(spark)
    distinct = names.select("name").filter("name is not null").distinct()
    if known:
        distinct = distinct.join(known.names.select("name"), "name", "left_anti")
    parsed = cut(distinct.repartition(spark.sparkContext.defaultParallelism, "name").mapInPandas(_parser(tables), FORM_TYPE))
    forms = parsed.groupBy("form").agg(F.first("whole").alias("whole"), F.first("blocks").alias("blocks"), F.first("homes").alias("homes"))
    if known:
        forms = forms.join(known.forms.select("form"), "form", "left_anti")
        old = resolved(known.forms, known.aliases)
    forms = cut(forms)
    looking = forms.select(F.col("form").alias("a"), "whole", F.explode("blocks").alias("block"))
    found = forms.select(F.col("form").alias("b"), F.lit(None).cast("string").alias("old"), F.explode("homes").alias("block"))
    pairs = looking.join(found if not known else found.unionByName(old.select(F.col("form").alias("b"), F.col("organisation").alias("old"), F.explode("homes").alias("block"))), "block")
    if known:
        # partial forms of the index that have found nobody yet look among the new ones
        waiting = known.forms.filter("not whole and not settled").select(F.col("form").alias("a"), "whole", F.explode("blocks").alias("block"))
        pairs = pairs.unionByName(waiting.join(found, "block"))
    pairs = pairs.filter("a <> b and (not whole or old is not null or a < b)").select("a", "b", F.col("whole").alias("both"), "old").distinct()
    accepted = cut(pairs.mapInPandas(_judge(tables), "a string, b string, both boolean, old string, exact boolean"))
    # an old form stands for its cluster, so links lead to labels, and labels never change
    clusters = connected_components(accepted.filter("both").select("a", F.coalesce("old", "b").alias("b")))
    labels = accepted.filter("both and old is not null").select(F.col("old").alias("node")).distinct()
    roots = clusters.join(labels, "node").groupBy("component").agg(F.min("node").alias("root"))
    rooted = cut(clusters.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("root")))
    wholes = forms.filter("whole").join(rooted.withColumnRenamed("node", "form"), "form", "left").select("form", F.coalesce("root", "form").alias("organisation"))
    merged = rooted.join(labels, "node").filter("node <> root").select(F.col("node").alias("organisation"), "root")
    # a fit letter by letter goes before one with a slip
    homes = accepted.filter("not both").join(wholes.withColumnRenamed("form", "b"), "b", "left").withColumn("organisation", F.coalesce("organisation", "old"))
    homes = homes.join(merged.select(F.col("organisation").alias("merged"), "root"), F.col("organisation") == F.col("merged"), "left").withColumn("organisation", F.coalesce("root", "organisation"))
    exactly = F.when(F.col("exact"), F.col("organisation"))
    homes = homes.groupBy("a").agg(F.coalesce(F.min(exactly), F.min("organisation")).alias("home"), F.coalesce(F.max(exactly), F.max("organisation")).alias("last"))
    homes = cut(homes.select(F.col("a").alias("form"), "home", (F.col("home") != F.col("last")).alias("unsure")))
    parts = forms.filter("not whole").select("form").join(homes, "form", "left")
    sure = F.when(~F.col("unsure"), F.col("home"))
    placed = wholes.select("form", "organisation", F.lit(False).alias("unsure"), F.lit(True).alias("settled")).unionByName(
        parts.select("form", F.coalesce(sure, "form").alias("organisation"), F.coalesce("unsure", F.lit(False)).alias("unsure"), F.col("home").isNotNull().alias("settled"))
    )
    placed = cut(placed)
    of_form = placed.select("form", "organisation", "unsure")
    if known:
        of_form = of_form.unionByName(old.select("form", "organisation", F.lit(False).alias("unsure")))
    own = F.when(F.col("unsure"), F.concat(F.lit("?"), "name")).otherwise(F.col("organisation"))
    named = parsed.select("name", "form").join(of_form, "form").select("name", own.alias("organisation"))
    kept = forms.join(placed.drop("unsure"), "form").select("form", "whole", "blocks", "homes", "organisation", "settled")
    if not known:
        return NameIndex(named, kept, merged)
    late = homes.join(known.forms.filter("not whole and not settled").select("form", "organisation"), "form").filter("not unsure").select("organisation", F.col("home").alias("root"))
    fresh = cut(merged.unionByName(late).filter("organisation <> root").groupBy("organisation").agg(F.min("root").alias("root")))
    moved = known.aliases.join(fresh.select(F.col("organisation").alias("root"), F.col("root").alias("newer")), "root", "left").select("organisation", F.coalesce("newer", "root").alias("root"))
    return NameIndex(named.unionByName(known.names), kept.unionByName(known.forms), moved.unionByName(fresh))


def link_names(names: DataFrame, tables: NameTables = DEFAULT) -> DataFrame:
    """(name, organisation) for each distinct value of the column ``name``; see ``extend_names``."""
    return extend_names(names, None, tables).names


#: Names of one organisation that one task pairs with all others of it.
PAIR_GROUP = 512


def name_pairs(linked: DataFrame) -> DataFrame:
    """All pairs of names of one organisation, the smaller by code points first.

    An organisation of very many names is split: each of its names meets one
    slice of the others in one task.  ``linked`` itself is the membership.
    """
    sizes = linked.groupBy("organisation").agg(F.ceil(F.count("*") / PAIR_GROUP).cast("int").alias("slices")).filter("slices > 0")
    sized = linked.join(sizes, "organisation")
    a = sized.select(F.col("name").alias("name_a"), "organisation", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    b = sized.select(F.col("name").alias("name_b"), "organisation", F.pmod(F.xxhash64("name"), F.col("slices")).cast("int").alias("slice"))
    return a.join(b, ["organisation", "slice"]).filter("name_a < name_b").select("name_a", "name_b")
