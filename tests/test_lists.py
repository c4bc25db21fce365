import csv
import io
import re

from hypothesis import given
from hypothesis import strategies as st

from postloom.operators.lists import explode_packed, splitting_rule

ROWS = [
    (1, "Figma; Sketch ;Maya", None),
    (2, '["a, b", "c ""d"""]', "UI/UX / Print | x"),
    (3, None, ", ;"),
    (4, "", "  "),
    (5, '12" art, "open', "a\tb\nc、d • e"),
    (5, '12" art, "open', "a\tb\nc、d • e"),
    (6, "x" * 50_000 + ",y", "é, ñ"),
]


def brute(text):
    """Character by character, without skeletons."""
    if text is None:
        return []
    text = text.strip()
    while len(text) >= 2 and text[0] == "[" and text[-1] == "]":
        text = text[1:-1].strip()
    items, at, cur = [], 0, ""
    while at < len(text):
        c = text[at]
        if c == '"' and not cur.strip():
            end, i = -1, at + 1
            while i < len(text):
                if text[i] == '"':
                    if text[i + 1 : i + 2] == '"':
                        i += 2
                        continue
                    end = i
                    break
                i += 1
            if end > 0:
                cur += text[at : end + 1]
                at = end + 1
                continue
        slash = c == "/" and text[at - 1 : at].isspace() and text[at + 1 : at + 2].isspace()
        if c in ",;|•、\t\n\r" or slash:
            items.append(cur)
            cur = ""
        else:
            cur += c
        at += 1
    items.append(cur)
    out = []
    for item in items:
        item = item.strip()
        m = re.fullmatch(r'"((?:[^"]|"")*)"', item, re.S)
        item = m.group(1).replace('""', '"').strip() if m else item
        if item:
            out.append(item)
    return out


def test_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, "row_id int, keywords string, skills string").selectExpr("*", "1 as skeleton", "'x' as rule", "2 as item")
    got = sorted(tuple(r) for r in explode_packed(df, ["row_id"], ["keywords", "skills"]).collect())
    want = sorted((i, f, p, v) for i, k, s in ROWS for f, t in (("keywords", k), ("skills", s)) for p, v in enumerate(brute(t), 1))
    assert got == want
    assert (2, "skills", 1, "UI/UX") in got and (2, "keywords", 2, 'c "d"') in got


def test_same_rows_without_broadcast(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, "row_id int, keywords string, skills string")
    near = sorted(tuple(r) for r in explode_packed(df, ["row_id"], ["keywords", "skills"]).collect())
    monkeypatch.setattr("postloom.operators.lists.small_enough", lambda *_: False)
    assert sorted(tuple(r) for r in explode_packed(df, ["row_id"], ["keywords", "skills"]).collect()) == near


def test_empty_table(spark):
    df = spark.createDataFrame([], "row_id int, keywords string")
    out = explode_packed(df, ["row_id"], ["keywords"])
    assert out.count() == 0 and dict(out.dtypes)["pos"] == "int"


@given(st.lists(st.text("ab ,;|\"", max_size=6).map(str.strip).filter(bool), max_size=6))
def test_rule_reads_back_quoted_lists(values):
    line = io.StringIO()
    csv.writer(line, quoting=csv.QUOTE_ALL, lineterminator="").writerow(values)
    assert brute(line.getvalue()) == values
    shape = re.sub(r'[^,;|"]*[^,;|"\s][^,;|"]*', "a", line.getvalue())
    assert len(splitting_rule(re.sub(r'[^a,;|"]+', "_", shape))) == len(values)
