from hypothesis import given
from hypothesis import strategies as st

from postloom.llm import canonical as c
from postloom.llm.aliases import ALIASES
from postloom.llm.titles import parse_title


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@given(st.text("abcé ", max_size=12), st.text("abcé ", max_size=12))
def test_levenshtein(a, b):
    assert c.levenshtein(a, b) == brute_distance(a, b)


@given(st.lists(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=25), st.text("abc", max_size=6), st.integers(0, 3))
def test_tree_returns_every_entry_within_radius(words, query, radius):
    tree = c.BKTree((w, i) for i, w in enumerate(words))
    assert sorted((w, i) for _, w, i in tree.within(query, radius)) == sorted({(w, i) for i, w in enumerate(words) if brute_distance(w, query) <= radius})


def test_titles_in_parts():
    t = parse_title("URGENT: Sr. Graphic Desinger – Healthcare / Northern Hub [REQ-123] (m/f/d)", "Osaka")
    assert (t.level, t.field, t.team, t.role) == ("senior", "healthcare", "northern hub", ("graphic desinger",))
    assert parse_title("Stylist, Food – Osaka", "Osaka").role == ("stylist", "food")
    assert parse_title("Careers").role == () and parse_title(None).role == () and parse_title("").role == ()
    assert parse_title("Colorist | ${employer.name}").role == ("colorist",)


VALUES = [
    ("title", "Graphic Desinger", "Graphic Designer"), ("title", "Designer, Graphic", "Graphic Designer"), ("title", "Grafikdesigner", "Graphic Designer"), ("title", "MUA (Makeup)", "Makeup Artist"),
    ("title", "House Painter", None), ("title", "Game Theory Lecturer", None), ("title", "UX Designer", "UX Designer"), ("title", "UI Designre", "UI Designer"), ("title", " ", None),
    ("skill", "Strong Fgma skills", "Figma"), ("skill", "Typography, print", "Typography"), ("skill", "Ai (Adoeb)", "Adobe Illustrator"), ("skill", "Unity of purpose", None), ("skill", "JS", "JavaScript"),
    ("skill", "Map folding", None), ("skill", "x" * 3000, None),
]


def terms(spark):
    rows = [(1000 * (k == "skill") + i, k, n) for k in ALIASES for i, n in enumerate(ALIASES[k])]
    return spark.createDataFrame(rows, "term_id long, term_kind string, canonical_name string")


def test_map_values_broadcast_and_sharded(spark):
    table = terms(spark)
    name = {r.term_id: r.canonical_name for r in table.collect()} | {-1: None}
    entries = c.reference_entries(table, ALIASES)
    values = spark.createDataFrame([(k, v, 1) for k, v, _ in VALUES] + [("title", None, 1), (None, "x", 1), ("title", "UX Designer", 2)], "kind string, value string, term_id int")
    for shards in (1, 3):
        got = {(r.kind, r.value): name[r.term_id] for r in c.map_values(values, entries, shards).collect()}
        assert got == {(k, v): n for k, v, n in VALUES}


def test_empty_lists(spark):
    none = spark.createDataFrame([], "term_id long, term_kind string, canonical_name string")
    values = spark.createDataFrame([("title", "Colorist")], "kind string, value string")
    assert [r.term_id for r in c.map_values(values, c.reference_entries(none, ALIASES)).collect()] == [-1]
    assert c.map_values(values.limit(0), c.reference_entries(terms(spark), ALIASES)).count() == 0
