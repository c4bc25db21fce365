import math
import random

import pytest

from postloom.llm import boilerplate as b
from postloom.llm import residue as r
from postloom.llm.lines import anchor_share

HEADS = ["Menu", "Help · Log in · Pricing", "Skip to main content", "Chi siamo · Lavora con noi", "Sign up", "Hi there, sign in for more", "Zoeken | Vacatures | Inloggen", "You are here: Jobs / Films / Leeds"]
FEET = ["Similar jobs", "© 2022 OpenNest. All rights reserved.", "Alle rechten voorbehouden", "UX Designer – Vikuri Studio – Leeds", "Art Director – Ziduzu Design – Graz", "Privacy · Terms · Imprint", "Version 4.1.7", "Volg ons op Fotoboard"]
BODY = ["{} draws posters, maps and small films for museums, schools and a ferry line in the north, and has done so for years", "Perks", "What you'll do", "Track 39 small requests a week", "Plan picture books, sound and colour with two producers; defend them in front of the whole town and its many visitors",
        "Requirements", "Comfortable with type", "We answer every letter within nine days", "{} is owned by the people who work here", "Remote"]


def corpus(pages=400):
    """Pages of a body in its order, some between menus and footers, one of them with an advert inside."""
    rng = random.Random(7)
    out = []
    for n in range(pages):
        company = f"Company{'abcdefghij'[n % 10]} House"
        body = [x.format(company) for x in BODY if rng.random() < 0.8]
        if rng.random() < 0.7:
            head, foot = rng.sample(HEADS, rng.randint(1, 4)), rng.sample(FEET, rng.randint(1, 4))
            if rng.random() < 0.3:
                body.insert(rng.randint(0, len(body)), rng.choice(FEET[3:5]))
            body = head + body + foot
        out.append((company, body))
    return out


@pytest.fixture(scope="module")
def model():
    return b.fit([(t, b.Own.of(c).says(t)) for t in lines] for c, lines in corpus())


def test_learned_links_are_found(model):
    want = {t for t in HEADS + FEET}
    hit = missed = wrong = 0
    for company, lines in corpus(500)[400:]:
        got = set(b.furniture_lines("\n".join(lines), model, b.Own.of(company)))
        true = {n for n, t in enumerate(lines, 1) if t in want}
        hit, missed, wrong = hit + len(got & true), missed + len(true - got), wrong + len(got - true)
    assert hit / (hit + missed) > 0.85 and hit / (hit + wrong) > 0.95  # four hundred pages only
    # no list names these
    for unlisted in ("Chi siamo · Lavora con noi", "UX Designer – Vikuri Studio – Leeds", "Art Director – Kanolo Design – Graz"):
        assert not b.trusted_link(unlisted) and model.density(unlisted) > 0.5


def test_tree_score_alone_decides(model):
    # the same short line, of a density between the two kinds, stays in the body and falls among menus
    body = [BODY[4], BODY[3], BODY[6], BODY[7]]
    odds = {"Words of no kind": 0.2}
    doubtful = next(iter(odds))
    model = b.LinkModel(model.weights | {f: 0.0 for f in b.features(doubtful)}, 0.2, model.own)
    menu, foot = [HEADS[1], HEADS[0], HEADS[2]], [FEET[1], FEET[5]]
    assert b.furniture_lines("\n".join([*menu, doubtful, *menu, *body, *foot]), model)[:7] == list(range(1, 8))
    assert 3 not in b.furniture_lines("\n".join([*body[:2], doubtful, *body[2:], *foot]), model)


def test_best_container_and_siblings_pay_their_fee():
    keep = b.body_lines
    assert keep([2.0, -1.0, 2.0], 0.5) == [True, False, True] and keep([2.0, -0.3, 2.0], 0.5) == [True] * 3
    assert keep([-1.0, 0.4, -1.0, 3.0], 0.5) == [False, False, False, True] and keep([-1.0, 0.6, -1.0], 0.5) == [False, True, False]
    assert keep([], 0.5) == [] and keep([-1.0], 0.5) == [False]
    rng = random.Random(3)
    for _ in range(200):
        scores = [rng.uniform(-2, 2) for _ in range(rng.randint(1, 9))]

        def value(mask):
            runs = sum(1 for i, m in enumerate(mask) if m and (i == 0 or not mask[i - 1]))
            return sum(s for s, m in zip(scores, mask) if m) - 0.5 * runs

        best = max(value([bool(k >> i & 1) for i in range(len(scores))]) for k in range(2 ** len(scores)))
        assert abs(value(keep(scores, 0.5)) - best) < 1e-9


def test_anchors_are_link_text():
    line = '<li><a href="/x">Track 39 small requests a week</a></li>'
    assert anchor_share(line) == 1.0 and anchor_share("<p>see <a href='y'>it</a></p>") < 0.5 and anchor_share("plain") == 0.0
    model = b.LinkModel({"track": -9.0}, -3.0, 0.0)
    assert b.furniture_lines("\n".join([BODY[4], line.replace("<a ", "<b ").replace("</a>", "</b>")]), model) == []
    assert b.furniture_lines("\n".join([BODY[4], line]), model) == [2]


def test_furniture_rows(spark, model):
    company, lines = "Companya House", [*HEADS[:3], "", *[x.format("Companya House") for x in BODY], "404 Not Found", "", FEET[0], FEET[1], FEET[5]]
    text = "\r\n".join(lines)
    rows = [(1, text, company), (2, None, company), (3, "", None), (4, "x" * 100_000, None), (5, "\n".join(HEADS[:3]), None), (1, text, company)]
    df = spark.createDataFrame(rows, "row_id long, description string, company string").selectExpr("*", "7 as line_no")
    want = [1, 2, 3, *range(len(lines) - 2, len(lines) + 1)]
    got = sorted(tuple(x) for x in b.furniture(df, model).collect())
    assert got == sorted([(1, n) for n in want] * 2 + [(5, n) for n in (1, 2, 3)])
    assert b.furniture(df.limit(0), model).count() == 0 and b.furniture(df.limit(0)).count() == 0
    assert b.body_text(text, model, b.Own.of(company)).split("\r\n")[0] == "" and b.body_text(None, model) is None
    # fitted on the table itself, and without the columns of the posting's facts
    assert {x.row_id for x in b.furniture(df.select("row_id", "description")).collect()} >= {5}


def test_model_is_saved_and_empty_tables_teach_nothing(model, tmp_path):
    model.save(str(tmp_path / "m.json"))
    again = b.LinkModel.load(str(tmp_path / "m.json"))
    assert [again.odds(x) for x in HEADS + BODY] == [model.odds(x) for x in HEADS + BODY]
    assert b.fit([]).weights == {} and b.fit([[("Perks", False)]]).weights == {}


BAD = ["Error 403: you do not have permission", "{{job_title}} at {{company}}", "Plan films for [city] by [deadline]", "HTTP 503 service unavailable", "Lorem ipsum dolor sit amet", "Please enable JavaScript to view this job."]
GOOD = ["You will redesign our 404 page, which today just says that nothing was found.", "(m/f/d) [hybrid] [studio in the old brewery]", "JavaScript required for two of our 22 micro-sites", "You will write placeholder copy", "Careers", "Details upon application."]


def sample(n):
    fill = [f"Track {i} small requests a week" for i in range(40)] + GOOD
    slots = [f"Apply by {{{{{w}}}}} and @@{w}@@" for w in ("deadline", "city", "contact")]
    # the unlabelled records hold some residue too, and far more ordinary brackets
    return (BAD + slots) * n, fill * n + GOOD * 5 * n + BAD + slots * n


def test_residue_learns_slots_and_spares_talk():
    model = r.fit(*sample(20))
    assert [x for x in BAD if not model.flags(x)] == []
    assert [x for x in GOOD if model.flags(x)] == []


def test_patterns_label_the_fit_and_judge_nothing():
    model = r.Model(-1.0, -1.0, {"of": -1.0})
    assert all(r.trusted_residue(x) for x in BAD[:2] + BAD[3:]) and not any(model.flags(x) for x in BAD)
    # what no pattern matches is found by the words that it shares with what is trusted
    model = r.fit(*sample(20))
    talk = "The HTTP service is 503 unavailable"
    assert not r.trusted_residue(talk) and model.flags(talk)


def test_prior_stays_within_its_bounds():
    trusted = ["Fatal: template render failed at line 3"] * 30
    unlabelled = ["Fatal: template render failed at line 3"] * 10 + ["Template render failed at line 9"] * 200 + ["Run 4 review rounds each spring"] * 790
    prior, _ = r._learn(r.Counter(trusted), r.Counter(unlabelled), False)
    assert 10 / 1000 * 0.9 <= 1 / (1 + math.exp(-prior)) <= r.MOST_PRIOR * 11 / 1002 + 1e-9


def test_residue_model_is_saved(tmp_path):
    model = r.fit(*sample(5))
    model.save(str(tmp_path / "m.json"))
    again = r.Model.load(str(tmp_path / "m.json"))
    assert [again.odds(x, False) for x in BAD + GOOD] == [model.odds(x, False) for x in BAD + GOOD]


def test_residue_rows(spark):
    model = r.fit(*sample(20))
    rows = spark.createDataFrame([(1, BAD[0], None), (2, None, "fine\n" + BAD[2]), (3, GOOD[4], GOOD[0]), (4, None, None), (5, "", "x " * 30_000), (1, BAD[0], None)], "row_id long, title string, description string").selectExpr("*", "1 as spot", "2 as other")
    assert sorted(x.row_id for x in r.residue(rows, model).collect()) == [1, 1, 2]
    assert r.residue(rows.limit(0)).count() == 0
    assert {x.row_id for x in r.residue(rows).collect()} >= {1}


def test_em_reaches_unlabelled_variants():
    trusted = ["Fatal: template render failed at line 3"] * 30
    unlabelled = ["Fatal: render failed at line 9"] * 10 + ["Run 4 review rounds each spring"] * 500
    model = r.fit(trusted, unlabelled)
    assert model.flags("Fatal: render failed at line 7") and not model.flags("Run 9 review rounds each spring")
