import pytest

from postloom.llm import mojibake as m

SOUND = {
    "en": ["We’re a team of five — come and see the café on the corner.", "A naïve sketch is welcome. Budget £900–£1,200.", "Track small requests a week without losing icon families"],
    "de": ["Für unser Atelier suchen wir Verstärkung mit Gespür für Größe, Maß und Fläche.", "Über uns und deine Aufgaben in Köln und Zürich"],
    "fr": ["L’équipe préfère les croquis aux réunions dès la rentrée.", "Réponse assurée sous trois jours ouvrés, été compris."],
    "ru": ["Мы делаем книги, игры и выставки для детей и взрослых.", "Студия работает удалённо уже восемь лет."],
    "ja": ["音と光の担当者と協力して進めます。", "作品を三点と自己紹介を一行お送りください。"],
    "pl": ["W pracowni cenimy ciszę, światło i dobrą kreskę.", "Od lat tworzymy książki i gry dla najmłodszych."],
}
CHAINS = [
    ("en", "utf-8", "cp1252"), ("de", "utf-8", "cp1252"), ("de", "utf-8", "cp437"), ("fr", "utf-8", "mac_roman"), ("pl", "utf-8", "cp1250"), ("ru", "utf-8", "cp1251"), ("ru", "koi8_r", "cp1251"),
    ("ru", "cp1251", "koi8_r"), ("ru", "cp1251", "latin-1"), ("ja", "utf-8", "latin-1"), ("ja", "euc_jp", "latin-1"), ("fr", "cp1252", "cp1251"),
]


@pytest.fixture(scope="module")
def judge():
    return m.Judge(m.train({lang: lines * 30 for lang, lines in SOUND.items()}))


def garble(text, right, wrong):
    table = {v: k for k, v in m.to_byte("western").items()} if wrong == "cp1252" else None
    raw = text.encode(right)
    return "".join(chr(b) if b < 128 else table.get(chr(b), chr(b)) for b in raw) if table else raw.decode(wrong)


@pytest.mark.parametrize("lang, right, wrong", CHAINS)
def test_restores(judge, lang, right, wrong):
    for line in SOUND[lang]:
        try:
            bad = garble(line, right, wrong)
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if bad == line:
            continue
        assert m.restore(bad, lang, judge)[0] == line


def test_twice_garbled_and_mixed(judge):
    line = SOUND["de"][0]
    twice = garble(garble(line, "utf-8", "cp1252"), "utf-8", "cp1252")
    assert m.restore(twice, "de", judge)[0] == line
    text = line + "\n" + garble(SOUND["de"][1], "utf-8", "cp1252")
    assert m.restore(text, "de", judge)[0] == "\n".join(SOUND["de"])


@pytest.mark.parametrize("right, wrong", [("cp932", "cp1252"), ("euc_jp", "latin-1"), ("euc_jp", "mac_roman")])
def test_short_japanese_name_in_a_long_line(judge, right, wrong):
    name = "音光制作協力会社"
    line = "Track small requests a week without losing icon families for {}, without a café on the corner or a week of small requests, and keep the files tidy for the others"
    assert m.restore(line.format(garble(name, right, wrong)), "en", judge)[0] == line.format(name)


def test_sound_texts_and_mentions_stay(judge):
    for lang, lines in SOUND.items():
        for tag in (lang, None, "en-GB"):
            assert m.restore("\n".join(lines), tag, judge) == ("\n".join(lines), "", False)
    for line in ("Test question: which bytes turn ü into Ã¼?", "Our archive still says “cafÃ©” on one sign; a joke about encodings."):
        assert m.restore(line, "en", judge)[2] is False


def test_lost_bytes_are_damage(judge):
    assert m.restore("caf� on the corner", "en", judge) == ("caf� on the corner", "", True)


def test_table(spark):
    rows = [(1, None, "en"), (2, "", None), (3, garble(SOUND["en"][0], "utf-8", "cp1252"), "en"), (4, "plain " * 20_000, "xx"), (5, SOUND["de"][0], "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as chain", "2 as damaged")
    dictionaries = m.train({lang: lines * 30 for lang, lines in SOUND.items()})
    got = {r.doc_id: (r.text, r.damaged) for r in m.restored(df, dictionaries).collect()}
    assert got == {1: (None, False), 2: ("", False), 3: (SOUND["en"][0], True), 4: ("plain " * 20_000, False), 5: (SOUND["de"][0], False)}
    assert m.restored(df.limit(0)).count() == 0
