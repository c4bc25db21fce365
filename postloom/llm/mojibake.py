"""Text that was read in a wrong encoding, found and restored.

For every line with characters beyond ASCII the candidate decodings are listed:
the line as it is, and what comes out when its characters go back to bytes by
one encoding and are read by another.  Each candidate is compressed with a
zstandard dictionary of its language; the candidate with the least description
length, the cost of its chain included, is taken, and the step repeats because
texts are garbled twice.  Where nothing is shorter the line stays as it is.

The dictionaries are trained here, on a bounded sample (``SAMPLE_PER_LANGUAGE``
texts of each language, by hash) of texts without signs of damage.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from postloom.session import spread_out

LANGUAGES = ("en", "de", "fr", "es", "pt", "pl", "ru", "ja")
LATIN = ("en", "de", "fr", "es", "pt", "pl")
#: Texts that are looked through for the dictionaries, and texts of each
#: language from which one is trained at most.
SAMPLE_TEXTS = 24_000
SAMPLE_PER_LANGUAGE = 800
DICTIONARY_BYTES = 64 * 1024
LEVEL = 17
#: Level of the quick first look at a decoding, and the bytes that its lengths may be off in comparison.
QUICK_LEVEL = 3
QUICK_SLACK = 6
#: Description length, in bytes, of one step to UTF-8 and of one step between other encodings.
UTF8_COST = 1.0
OTHER_COST = 6.0
#: Bytes that a capital inside a word costs, which no sound text has.
ODD_VALUE = 2.0
MAX_STEPS = 3
#: Bytes a character up to which a line is at home in its declared language; others are measured by all.
FAMILIAR = 0.4
#: Misread multi-byte text has at least one in so many characters beyond ASCII, in its line or in its own stretch.
WIDE_SHARE = 6
#: Bytes that no compressed line falls below.
SHORTEST = 9

# Names of encodings in which texts are misread; "western" is Windows-1252 with Latin-1 in its gaps.
READ_AS = ("western", "mac_roman", "cp437", "cp850", "cp1250", "iso8859_2", "cp1251", "koi8_r", "cp1254", "cp866")
# Fixed values: (misread as, really) for pairs that do not involve UTF-8.
OTHER_PAIRS = (
    ("western", "cp1251"), ("western", "koi8_r"), ("western", "cp1250"), ("western", "iso8859_2"), ("western", "mac_roman"), ("western", "cp437"), ("western", "cp850"), ("western", "cp866"),
    ("mac_roman", "cp1252"), ("mac_roman", "cp1250"), ("mac_roman", "cp1251"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1250", "cp1252"), ("iso8859_2", "cp1250"),
    ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1251"), ("cp1251", "cp1252"),
)
# Encodings of more bytes than one, misread as one of single bytes.
WIDE_PAIRS = (("western", "cp932"), ("western", "euc_jp"), ("mac_roman", "cp932"), ("mac_roman", "euc_jp"), ("cp1251", "cp932"))
UTF8_BYTES = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
HIGH = re.compile(r"[^\x00-\x7f]+")
NO_BYTE, BYTES = "\u0100", re.compile("[\x00-\xff]+")
#: Signs of damage that keep a text out of the dictionaries, and never occur in sound text.
DAMAGE = re.compile("[\x80-\x84\x86-\x9f�]|[ÃÂ][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹Œ‘’“”•–—˜™š›œžŸ]|â€|ï¿½|[ÐÑ][\x80-\xbf‚ƒ„…†‡ˆ‰]|[РС][Ѐ-Џѐ-џ°±µ·»]|√[©®†≠≥§∂º°¥ß]|[├┬]|ΓÇ|Ĺ[\x80-\xbf‚›ş]|Ă[łłĽ]")
LOST = re.compile("�|ï¿½")
QUOTES = "“”„«»\"'‘’`"


@lru_cache(maxsize=None)
def to_byte(codec: str) -> dict[str, str]:
    """Character to byte (as a Latin-1 character) of a single-byte encoding, with gaps filled."""
    out: dict[str, str] = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode("cp1252" if codec == "western" else codec)] = chr(b)
        except UnicodeDecodeError:
            pass
    for b in range(128, 256):
        out.setdefault(chr(b), chr(b)) if codec in ("western", "cp1250", "cp1251", "cp1254", "iso8859_2") and (b < 160 or codec == "western") else None
    return out


@lru_cache(maxsize=None)
def single_table(read_as: str, really: str) -> dict[int, str]:
    """Translation of characters misread by one single-byte encoding."""
    out = {}
    for char, byte in to_byte(read_as).items():
        try:
            right = bytes([ord(byte)]).decode(really)
        except UnicodeDecodeError:
            continue
        if right != char:
            out[ord(char)] = right
    return out


def _utf8(m: re.Match) -> str:
    try:
        return m.group().encode("latin-1").decode("utf-8")
    except UnicodeDecodeError:
        return m.group()


@lru_cache(maxsize=None)
def byte_table(codec: str) -> dict[int, str]:
    """Translation of a text to the bytes that a single-byte encoding gave, as Latin-1; signs that it cannot give become no byte."""
    return {b: NO_BYTE for b in range(128, 256)} | {ord(c): b for c, b in to_byte(codec).items()}


def as_utf8(line: str, read_as: str) -> str:
    """The line with every stretch that is UTF-8 when taken as bytes of ``read_as``."""
    low = line.translate(byte_table(read_as))
    hit = UTF8_BYTES.search(low)
    if not hit:
        return line
    out, at = [], 0
    for hit in UTF8_BYTES.finditer(low):
        new = _utf8(hit)
        out += [line[at : hit.start()], new if new != hit.group() else line[hit.start() : hit.end()]]
        at = hit.end()
    return "".join(out) + line[at:]


def as_wide(line: str, read_as: str, really: str) -> str:
    """The line read by a multi-byte encoding, in the stretches that allow it."""
    low = line.translate(byte_table(read_as))
    out, at = [], 0
    for part in BYTES.finditer(low):
        try:
            new = part.group().encode("latin-1").decode(really)
        except UnicodeDecodeError:
            continue
        out += [line[at : part.start()], new]
        at = part.end()
    return "".join(out) + line[at:]


def may_be_wide(stretch: str) -> bool:
    """Whether a stretch between blanks holds signs enough for two misread multi-byte characters."""
    if stretch.isascii():
        return False
    high = sum(map(len, HIGH.findall(stretch)))
    return high >= 2 and high * WIDE_SHARE >= len(stretch)


def wide_stretches(line: str, read_as: str, really: str, places: list[int] | None = None) -> str:
    """The line with the stretches that may be garbled (those at ``places``, where known) read by a multi-byte encoding, the others as they are.

    A stretch must become Japanese of two signs at least, so that sound words with accents stay.
    """
    out = line.split(" ")
    for k in [k for k, stretch in enumerate(out) if may_be_wide(stretch)] if places is None else places:
        new = as_wide(out[k], read_as, really)
        if WIDE_WORD.search(new) and not HALF_WIDTH.search(new):
            out[k] = new
    return " ".join(out)


#: Two Japanese signs together, and the half-width ones that accented letters turn into by chance.
WIDE_WORD, HALF_WIDTH = re.compile("[぀-ヿ一-鿿]{2}"), re.compile("[｡-ﾟ]")
#: What decoded text may hold beyond ASCII: Latin, Cyrillic, Japanese, marks, symbols.
FOREIGN = re.compile("[^\x00-ɏʹ-ͯЀ-ӿ\u2000-\u2bff\u3000-鿿︀-️＀-￯\U0001f000-\U0001faff]")
#: Scripts run together within one word.
MIXED = re.compile("[A-Za-zÀ-ɏ][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-zÀ-ɏ]|[Ѐ-ӿ][぀-鿿]|[぀-鿿][Ѐ-ӿ]|[0-9][Ѐ-ӿ][0-9]")
#: A capital beyond ASCII inside a word of small letters.
ODD_CASE = re.compile("[a-zà-öø-ÿ][À-ÖØ-Þ]|[а-яё][А-ЯЁ]")
CONTROL = re.compile("[\x7f-\x9f]")
#: Punctuation that a misread letter may turn out to be.
MARKS = "’‘“”–—…•€"
# Latin letters beyond ASCII of the languages for which there are dictionaries, and of neighbours' names.
LETTERS = frozenset("àâäáãåæçéèêëíîïñóôöõøœúùûüßÿąćęłńśźż" "ÀÂÄÁÃÅÇÉÈÊËÍÎÏÑÓÔÖÕØÚÙÛÜĄĆĘŁŃŚŹŻ")
LATIN_BEYOND = re.compile("[À-ÖØ-öø-ɏ]")
#: Two signs beyond ASCII in one stretch between blanks.
TWO_HIGH = re.compile("[^\x00-\x7f][^ ]*[^\x00-\x7f]")


CYRILLIC = re.compile("[Ѐ-ӿ]")
EAST = re.compile("[぀-ヿ一-鿿＀-￯]")
#: A script that a decoding brings must come as a word.
NEW_SCRIPTS = ((CYRILLIC, re.compile("[Ѐ-ӿ]{3}")), (EAST, re.compile("[぀-鿿＀-￯]{2}")))


def plausible(old: str, new: str, utf8: bool) -> bool:
    """Whether a decoding brings no script and no control sign that no text has.

    Outside UTF-8 a misread sign must become part of a word, no capital may
    appear within one, and a letter may turn into punctuation only where
    punctuation stands.
    """
    if FOREIGN.search(new) and not FOREIGN.search(old):
        return False
    if len(MIXED.findall(new)) > len(MIXED.findall(old)):
        return False
    if any(script.search(new) and not script.search(old) and not word.search(new) for script, word in NEW_SCRIPTS):
        return False
    if utf8:
        return True
    if len(CONTROL.findall(new)) > len(CONTROL.findall(old)):
        return False
    if len(old) != len(new):
        return True
    return word_signs(old, {i: b for i, (a, b) in enumerate(zip(old, new)) if a != b})


@lru_cache(maxsize=None)
def lead_signs(read_as: str, really: str) -> frozenset[str]:
    """Signs that may begin a multi-byte character of ``really`` when they are misread by ``read_as``."""
    first = (range(0x81, 0xA0), range(0xE0, 0xFD), range(0xA1, 0xE0)) if really == "cp932" else (range(0xA1, 0xFF), range(0x8E, 0x90))
    leads = {chr(b) for part in first for b in part}
    return frozenset(c for c, b in to_byte(read_as).items() if b in leads)


@lru_cache(maxsize=200_000)
def viable(chars: frozenset[str], run: int) -> tuple[tuple[str, ...], tuple[tuple[str, str], ...], tuple[tuple[str, str], ...]]:
    """Steps that a line's signs beyond ASCII, and their longest run (up to 3), allow at all: (encodings for UTF-8, other pairs, multi-byte pairs).

    UTF-8 needs a sign for a leading byte and one for a continuation together.
    A pair must change something; it is out where what ``plausible`` forbids
    follows from the signs alone, wherever they stand.  Lines share few sets of
    signs, so this is mostly remembered.
    """
    utf8 = []
    for codec in READ_AS if run >= 2 else ():
        codes = [ord(x) for x in map(to_byte(codec).get, chars) if x]
        if any(0xC2 <= b <= 0xF4 for b in codes) and any(0x80 <= b <= 0xBF for b in codes):
            utf8.append(codec)
    old = "".join(chars)
    foreign, control = bool(FOREIGN.search(old)), bool(CONTROL.search(old))
    pairs = []
    for pair in OTHER_PAIRS:
        table = single_table(*pair)
        new = {c: table[ord(c)] for c in chars if ord(c) in table}
        text = "".join(new.values())
        if not text or not foreign and FOREIGN.search(text) or not control and CONTROL.search(text):
            continue
        if any(a.isalpha() and not b.isalpha() and b not in MARKS or LATIN_BEYOND.fullmatch(b) and b not in LETTERS for a, b in new.items()):
            continue
        if not any(b.isalpha() or b == "’" for b in new.values()):
            continue
        if any(run < least and script.search(text) and not script.search(old) for script, least in ((CYRILLIC, 3), (EAST, 2))):
            continue
        pairs.append(pair)
    return tuple(utf8), tuple(pairs), tuple(pair for pair in WIDE_PAIRS if not chars.isdisjoint(lead_signs(*pair)))


def steps_of(line: str) -> tuple[tuple[str, ...], tuple[tuple[str, str], ...], tuple[tuple[str, str], ...]]:
    """The viable steps of a line; none for plain ASCII."""
    runs = HIGH.findall(line)
    return viable(frozenset("".join(runs)), min(3, max(map(len, runs)))) if runs else ((), (), ())


def utf8_candidates(line: str, codecs: tuple[str, ...]) -> Iterator[tuple[str, str, float]]:
    """(chain step, decoded line, cost) of each plausible step to UTF-8."""
    for codec in codecs:
        new = as_utf8(line, codec)
        if new != line and plausible(line, new, True):
            yield f"{codec}>utf_8", new, UTF8_COST


def word_signs(line: str, at: dict[int, str]) -> bool:
    """Whether signs of a line may be replaced as ``at`` says, by the signs beside them alone (see ``plausible``)."""
    end, word = len(line) - 1, False
    for i, b in at.items():
        before = (at.get(i - 1) or line[i - 1]) if i else " "
        after = (at.get(i + 1) or line[i + 1]) if i < end else " "
        if b.isupper() and before.islower():
            return False
        letter = b.isalpha()
        if not letter and b != "’" and line[i].isalpha() and (b not in MARKS or before.isalpha() and after.isalpha()):
            return False
        word = word or b == "’" or letter and (before.isalpha() or after.isalpha())
    return word


def pair_candidates(line: str, pairs: tuple[tuple[str, str], ...]) -> Iterator[tuple[str, str, float]]:
    """(chain step, decoded line, cost) of each plausible step between single-byte encodings."""
    spots = [(i, ord(c)) for i, c in enumerate(line) if c > "\x7f"] if pairs else []
    for read_as, really in pairs:
        table = single_table(read_as, really)
        if not word_signs(line, {i: table[c] for i, c in spots if c in table}):
            continue
        new = line.translate(table)
        if plausible(line, new, False):
            mended = len(ODD_CASE.findall(line)) - len(ODD_CASE.findall(new))
            yield f"{read_as}>{really}", new, max(UTF8_COST, OTHER_COST - ODD_VALUE * mended)


def wide_candidates(line: str, pairs: tuple[tuple[str, str], ...]) -> Iterator[tuple[str, str, float]]:
    """(chain step, decoded line, cost) of each plausible step to a multi-byte encoding."""
    if not pairs:
        return
    whole = sum(map(len, HIGH.findall(line))) * WIDE_SHARE >= len(line)
    places = [k for k, stretch in enumerate(line.split(" ")) if may_be_wide(stretch)] if not whole and TWO_HIGH.search(line) else []
    if not whole and not places:
        return
    for read_as, really in pairs:
        new = as_wide(line, read_as, really) if whole else wide_stretches(line, read_as, really, places)
        if new != line and plausible(line, new, False):
            yield f"{read_as}>{really}", new, OTHER_COST


def candidates(line: str) -> list[tuple[list[str], str, float]]:
    """(chain, decoded line, cost) of each plausible decoding of one step, or of two through UTF-8.

    Two are looked ahead, for a text garbled twice may get no shorter before
    its second step.
    """
    utf8, pairs, wide = steps_of(line)
    once = list(utf8_candidates(line, utf8))
    out = [([step], new, cost) for step, new, cost in (*once, *pair_candidates(line, pairs), *wide_candidates(line, wide))]
    return out + [([first, step], new, cost + more) for first, mid, cost in once for step, new, more in utf8_candidates(mid, steps_of(mid)[0])]


class Judge:
    """Description lengths by the dictionaries of the languages."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.by_language = {lang: self._compressor(raw, LEVEL) for lang, raw in dictionaries.items()}
        self.quick = {lang: self._compressor(raw, QUICK_LEVEL) for lang, raw in dictionaries.items()}
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    @staticmethod
    def _compressor(raw: bytes, level: int) -> zstandard.ZstdCompressor:
        kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
        data = zstandard.ZstdCompressionDict(raw, dict_type=kind)
        data.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

    def length(self, text: str, names: tuple[str, ...] | None = None, quick: bool = False) -> tuple[int, str]:
        """(bytes, language) of the text by the best dictionary, of ``names`` or of all."""
        raw = text.encode("utf-8", "surrogatepass")
        table = self.quick if quick else self.by_language
        known = {n: table[n] for n in names or table if n in table} or {"": self.plain}
        return min((len(c.compress(raw)), n) for n, c in known.items())

    def candidate_length(self, text: str, langs: tuple[str, ...], quick: bool = False) -> int:
        """Bytes of a decoding by the dictionaries that its script allows."""
        if EAST.search(text):
            langs += ("ja",)
        if CYRILLIC.search(text):
            langs += ("ru",)
        return self.length(text, tuple(dict.fromkeys(langs)), quick)[0]

    def home(self, line: str, lang: str | None, quick: bool = False) -> tuple[tuple[str, ...], int]:
        """The languages by which a line's decodings are measured, and its own length: its declared one where it is at home, else by all."""
        langs = (lang, "en") if lang else ()
        length = self.candidate_length(line, langs, quick) if lang else math.inf
        if length > FAMILIAR * len(line):
            length, best = self.length(line, None, quick)
            langs = (best, *langs)
        return langs, length


def language(lang: str | None) -> str | None:
    """Primary language of a tag, None where it says nothing."""
    low = (lang or "").strip().lower().split("-")[0].split("_")[0]
    return low if low in LANGUAGES else None


def is_mention(line: str) -> bool:
    """Whether the garbled sequences of a line are its subject: quoted, or beside what they stand for."""
    runs = [(m.group().strip(QUOTES), m.start(), m.end()) for m in HIGH.finditer(line)]
    for text, start, end in runs:
        fixed = as_utf8(text, "western")
        if fixed == text:
            continue
        if any(other == fixed and (at == 0 or not line[at - 1].isalnum()) and (stop == len(line) or not line[stop].isalnum()) for other, at, stop in runs):
            return True
        left = line.rfind(" ", 0, start) + 1
        right = line.find(" ", end)
        word = line[left : right if right >= 0 else len(line)].rstrip(",.;:!?")
        if len(word) > 2 and word[0] in "“„«\"'‘" and word[-1] in "”“»\"'’":
            return True
    return False


def restore_line(line: str, lang: str | None, judge: Judge) -> tuple[str, str]:
    """(restored line, chain); the chain is empty where the line stays as it is.

    Most sound lines have no plausible decoding and are not compressed at all;
    of the others those decodings are that may gain more than their chain costs.
    """
    current, steps = line, []
    langs: tuple[str, ...] = ()
    length = math.inf
    while len(steps) < MAX_STEPS and not current.isascii():
        options = candidates(current)
        if not options:
            break
        if not steps:
            langs, _ = judge.home(line, lang, True)
        # a quick look tells which decodings are far from winning; the others are measured
        least = judge.candidate_length(current, langs, True) + QUICK_SLACK
        options = [o for o in options if judge.candidate_length(o[1], langs, True) + o[2] < least]
        if not options:
            break
        if not steps:
            langs, length = judge.home(line, lang)
        odd = ODD_CASE.search(current)
        lengths = ((judge.candidate_length(new, langs) + cost, k) for k, (_, new, cost) in enumerate(options) if odd or cost < OTHER_COST or cost < length - SHORTEST)
        best = min(lengths, default=None)
        if best is None or best[0] >= length or (not steps and is_mention(current)):
            break
        taken, current, cost = options[best[1]]
        length = best[0] - cost
        steps += taken
    return current, "+".join(steps)


def restore(text: str | None, lang: str | None, judge: Judge, cache: dict | None = None) -> tuple[str | None, str, bool]:
    """(restored text, chains used, damaged) of a whole text, line by line.

    ``damaged`` also holds for text whose bytes are lost (replacement signs),
    which stays as it is.
    """
    if not text or text.isascii():
        return text, "", False
    lang = language(lang)
    out, chains, lost = [], set(), False
    for line in text.split("\n"):
        if line.isascii():
            out.append(line)
            continue
        key = (line, lang)
        known = cache.get(key) if cache is not None else None
        if known is None:
            known = restore_line(line, lang, judge)
            if cache is not None:
                if len(cache) > 100_000:
                    cache.clear()
                cache[key] = known
        out.append(known[0])
        if known[1]:
            chains.add(known[1])
        lost = lost or bool(LOST.search(line))
    return "\n".join(out), ",".join(sorted(chains)), bool(chains) or lost


def train(samples: dict[str, list[str]]) -> dict[str, bytes]:
    """A zstandard dictionary for each language; too few texts make a plain one."""
    out = {}
    for lang, texts in sorted(samples.items()):
        lines = [line for t in texts for line in t.split("\n") if line.strip()]
        if not lines:
            continue
        try:
            out[lang] = zstandard.train_dictionary(DICTIONARY_BYTES, [x.encode() for x in lines]).as_bytes()
        except zstandard.ZstdError:
            out[lang] = "\n".join(dict.fromkeys(lines)).encode()[:DICTIONARY_BYTES]
    return out


def sample_texts(docs: DataFrame) -> dict[str, list[str]]:
    """Bounded sample of texts without signs of damage, by language.

    A hash of the document's number decides, against the table's count, so the
    costly look for damage meets about ``SAMPLE_TEXTS`` texts at every size.
    """
    count = max(1, docs.count())
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    tag = F.lower(F.regexp_extract("lang", "^\\s*([A-Za-z]{2})(?:[-_].*)?$", 1))
    taken = docs.filter(spot < SAMPLE_TEXTS / count).select(tag.alias("tag"), "text", spot.alias("spot"))
    sound = taken.filter(F.col("tag").isin(*LANGUAGES) & (F.length("text") > 20) & (F.length("text") < 4000) & ~F.col("text").rlike(DAMAGE.pattern))
    ranked = sound.withColumn("nth", F.row_number().over(W.partitionBy("tag").orderBy("spot", "text"))).filter(F.col("nth") <= SAMPLE_PER_LANGUAGE)
    out: dict[str, list[str]] = {lang: [] for lang in LANGUAGES}
    for r in ranked.select("tag", "text").toLocalIterator():
        out[r.tag].append(r.text)
    return out


def restored(docs: DataFrame, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """(doc_id, text, chain, damaged) for every document.

    Null and empty texts come back as they are.  Texts are handled whole, line
    by line; a line that mixes sound and garbled parts is restored in the
    latter.  Nothing is shuffled.
    """
    dictionaries = dictionaries or train(sample_texts(docs))
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge, cache = Judge(shared.value), {}
        for pdf in batches:
            rows = [restore(t, lang, judge, cache) for t, lang in zip(pdf["text"], pdf["lang"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [r[0] for r in rows], "chain": [r[1] for r in rows], "damaged": [r[2] for r in rows]})

    return spread_out(docs.select("doc_id", "text", "lang")).mapInPandas(run, "doc_id long, text string, chain string, damaged boolean")
