from hypothesis import given
from hypothesis import strategies as st

from postloom.llm import names
from postloom.llm.components import connected_components

SAME = [
    ["Boda Tralute Press & Print", "boda tralute press and print", "Boda-Tralute Press & Print Ltd", "Tralute Boda Press+Print", "B. Tralute Press & Print", "@bodatralute", "Boda Tralüte Press & Print (Europe)"],
    ["Theodora Pifenupuke Records", "Dora Pifenupuke Rec.", "Pifenupuke, Theodora (Records)", "THEODORA PIFENUPUKE RECORDS", "Theodora Pifenupukke Records", "T. Pifenupuke Records"],
    ["Robert Pifenupuke Records"],
    ["Theodora Pifenupuke Games GmbH"],
    ["Gime Brinole Games, L.L.C.", "GimeBrinole Games", "gimebrinole-games"],
    ["Medi Kulavo Design", "Medi Kulavo Dsgn"],
]
NOBODY = ["", "  ", "Unknown", "N/A", "confidential"]


def test_groups(spark):
    values = [(n,) for g in SAME for n in g] + [(n,) for n in NOBODY] + [(None,), ("Boda Tralute Press & Print",), ("Pifenupuke Records",)]
    linked = names.link_names(spark.createDataFrame(values, "name string").selectExpr("name", "1 as form", "2 as organisation"))
    org = {r.name: r.organisation for r in linked.collect()}
    groups = [{org[n] for n in g} for g in SAME]
    assert all(len(g) == 1 for g in groups) and len(set().union(*groups)) == len(SAME)
    assert not set(NOBODY) & set(org)
    assert org["Pifenupuke Records"] not in set().union(*groups)
    pairs = {tuple(r) for r in names.name_pairs(linked).collect()}
    want = {(a, b) for g in SAME for a in g for b in g if a < b}
    assert pairs == want


def slips(word):
    for i in range(len(word)):
        yield word[:i] + word[i + 1 :]
        yield word[:i] + "u" + word[i:]
        yield word[:i] + "x" + word[i + 1 :]
        if i:
            yield word[: i - 1] + word[i] + word[i - 1] + word[i + 1 :]


def test_any_slip_that_counts_shares_a_block():
    met = 0
    for name in ("Elizabeth Vosune Media", "Robert William Studio", "Boda Tralute Press & Print", "Francisco Brustomevi Games", "@elizabethvosune", "E. Vosune Media", "Vosune Media"):
        for slip in {slip for word in name.split() for slip in (name.replace(word, x) for x in slips(word))} | {name}:
            a = names.parse_name(slip)
            for whole in ("Elizabeth Vosune Media", "Robert William Studio", "Boda Tralute Press & Print", "Francisco Brustomevi Games"):
                b = names.parse_name(whole)
                if a and (names.same_organisation(a, b) if names.complete(a) else names.fits(a, b)):
                    met += 1
                    assert set(names.block_keys(a)) & set(names.home_keys(b)), (slip, whole)
    assert met > 100


def test_slip_in_a_short_family_name(spark):
    values = ["Elizabeth Vosune Media", "Elizabeth Vsosune Media", "Elizabeth Kadolu Media"]
    linked = names.link_names(spark.createDataFrame([(v,) for v in values], "name string"))
    assert [tuple(r) for r in names.name_pairs(linked).collect()] == [tuple(values[:2])]


def test_exact_fit_goes_before_a_slip(spark):
    values = ["Trora Pezeko Design", "Pezeko Design", "Pufo Pereko Design"]
    linked = names.link_names(spark.createDataFrame([(v,) for v in values], "name string"))
    assert [tuple(r) for r in names.name_pairs(linked).collect()] == [("Pezeko Design", "Trora Pezeko Design")]


def test_empty(spark):
    assert names.name_pairs(names.link_names(spark.createDataFrame([], "name string"))).count() == 0


def brute_components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for e in edges for x in e if e[0] != e[1]}


def test_components(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("x1", "x2"), ("x3", "x2"), ("x2", "x1"), ("z", "z")] + [("hub", f"h{i}") for i in range(50)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == brute_components(edges)
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


@given(st.text("abcd", max_size=8), st.text("abcd", max_size=8))
def test_jaro_winkler_is_symmetric_and_bounded(a, b):
    s = names.jaro_winkler(a, b)
    assert 0 <= s <= 1 and abs(s - names.jaro_winkler(b, a)) < 1e-9 and (s == 1) == (a == b)


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def labels(index):
    got = {r.name: r.organisation for r in names.resolved(index.names, index.aliases).collect()}
    assert index.names.count() == len(got)
    return got


def test_a_label_once_given_never_changes(spark, tmp_path):
    first = names.extend_names(frame(spark, ["Walter Huber Design", "Boda Tralute Media", "T. Pifenupuke Records"]))
    before = {r.name: r.organisation for r in first.names.collect()}
    first.save(str(tmp_path / "n"))
    first = names.NameIndex.load(spark, str(tmp_path / "n"))
    # a spelling that sorts lower, a new one, a name seen before, and the cluster that a partial name waited for
    second = names.extend_names(frame(spark, ["Walter Hber Design", "Aoda Kulavo Media", "Boda Tralute Media", "Theodora Pifenupuke Records", None, "n/a"]), first)
    after = {r.name: r.organisation for r in second.names.collect()}
    assert {k: after[k] for k in before} == before and len(after) == 6
    got = labels(second)
    assert got["Walter Hber Design"] == got["Walter Huber Design"] == before["Walter Huber Design"]
    assert got["T. Pifenupuke Records"] == got["Theodora Pifenupuke Records"]
    assert len(set(got.values())) == 4
    assert labels(names.extend_names(frame(spark, []), second)) == got


def test_clusters_that_turn_out_to_be_one_get_an_alias(spark):
    first = names.extend_names(frame(spark, ["Walter Hubermann Design", "Walter Hbermnn Design"]))
    assert len(set(labels(first).values())) == 2 and first.aliases.count() == 0
    second = names.extend_names(frame(spark, ["Walter Hbermann Design"]), first)
    assert len(set(labels(second).values())) == 1 and second.aliases.count() == 1
    third = names.extend_names(frame(spark, ["Walter Hubermanns Design", "W. Hubermann Design"]), second)
    assert len(set(labels(third).values())) == 1


def test_batches_of_names_equal_one_pass(spark):
    values = [n for g in SAME for n in g] + NOBODY
    whole = {frozenset(r) for r in names.name_pairs(names.link_names(frame(spark, values))).collect()}
    index = None
    for start in range(0, len(values), 7):
        index = names.extend_names(frame(spark, values[start : start + 7]), index)
    got = {frozenset(r) for r in names.name_pairs(names.resolved(index.names, index.aliases)).collect()}
    assert got == whole


def test_pairs_of_a_hot_organisation_are_split(spark, monkeypatch):
    monkeypatch.setattr(names, "PAIR_GROUP", 3)
    linked = spark.createDataFrame([(f"n{i:02}", "o") for i in range(11)] + [("x", "p")], "name string, organisation string")
    assert {tuple(r) for r in names.name_pairs(linked).collect()} == {(f"n{i:02}", f"n{j:02}") for i in range(11) for j in range(i + 1, 11)}


def test_tables_are_inputs(spark):
    tables = names.NameTables(nicknames={"bartholomew": "bart"}, lines={"brewery": "brew"})
    linked = names.link_names(frame(spark, ["Bart Halloran Brew", "Bartholomew Halloran Brewery", "Bart Halloran Design"]), tables)
    assert [tuple(r) for r in names.name_pairs(linked).collect()] == [("Bart Halloran Brew", "Bartholomew Halloran Brewery")]


def test_jaro_winkler_accepts_and_short_words_need_one_slip():
    assert names.alike("lovomo", "lxvomo") and names.alike("basazapabri", "baasazapabry") and not names.alike("robert", "samuel")
    assert names.alike("vosu", "vosi") and not names.alike("vosu", "sovu") and not names.alike("abc", "abd")
    assert names.phonetic("schmidt") == names.phonetic("shmit") and names.phonetic("phaidon") == names.phonetic("faydon") and names.phonetic("") == ""
