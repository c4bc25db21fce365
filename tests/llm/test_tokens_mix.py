from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postloom.llm import encode, mix, queries

try:
    encode.encoding()
except OSError:
    pytest.skip("no rank file here", allow_module_level=True)

TEXTS = ["Hello world", "", None, "  \n\t x", "<|endoftext|> é 漢字 🎨👩‍🎨", "a" * 60_000, "don't " * 9000 + "\r\n  end", "é​"]


@pytest.mark.parametrize("text", TEXTS)
def test_round_trip_and_whole_text(text):
    ids = encode.encode_text(text)
    assert encode.decode_ids(ids) == (text or "").encode()
    assert ids == encode.encoding().encode_ordinary(text or "")


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=80), st.integers(1, 20))
def test_pieces_do_not_change_ids(text, limit):
    parts = list(encode.pieces(text, limit))
    assert "".join(parts) == text
    if not any("\ud800" <= c <= "\udfff" for c in text):
        assert [i for p in parts for i in encode.encoding().encode_ordinary(p)] == encode.encoding().encode_ordinary(text)


def test_columns(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").selectExpr("*", "1 as ids")
    got = {r.doc_id: list(r.ids) for r in encode.encoded(df).collect()}
    assert got == {i: encode.encode_text(t) for i, t in enumerate(TEXTS)}
    assert encode.encoded(df.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 700), st.integers(0, 10**6))
def test_permutation(size, key):
    assert sorted(mix.permute(np.arange(size), size, key)) == list(range(size))


def build(spark):
    rng = np.random.default_rng(1)
    docs = [(i, ["big", "small", None, "hot"][i % 4] if i % 16 else "hot", int(rng.integers(0, 90))) for i in range(800)]
    df = spark.createDataFrame([(i, s if s != "small" or i < 60 else "big", n) for i, s, n in docs], "doc_id long, source string, n_tokens long").selectExpr("*", "1 as block", "2 as o")
    targets = spark.createDataFrame(
        [("m", "big", 3.0, 1, 0.5), ("m", "small", 1.0, 3, 0.5), ("m", "gone", 1.0, 3, 0.5), ("m", "hot", 0.0, 3, 0.5), ("z", "hot", 0.0, 2, 0.5), ("n", "hot", 2.0, 5, 0.3), ("e", None, None, None, None)],
        "mix_name string, source_name string, target_weight double, max_repeats int, corpus_fraction double",
    )
    return df, targets


def test_mix(spark):
    df, targets = build(spark)
    block = 16
    pieces, shares = mix.mixes(df, targets, block)
    rows = pieces.collect()
    held = {r.doc_id: (r.source, r.n_tokens) for r in df.collect()}
    repeats = {(t.mix_name, t.source_name): t.max_repeats for t in targets.collect()}
    used = {}
    for r in rows:
        assert held[r.doc_id][0] == r.source and 0 <= r.start and r.start + r.tokens <= held[r.doc_id][1] and 0 < r.tokens <= block
        used.setdefault((r.mix_name, r.source, r.block, r.doc_id, r.start), set()).add(r.position)
    assert all(len(p) <= repeats[k[0], k[1]] for k, p in used.items())
    for m in ("m", "n"):
        at = sorted({r.position for r in rows if r.mix_name == m})
        assert at == list(range(len(at))) and at
    report = {(r.mix_name, r.source_name): r for r in shares.collect()}
    assert len(report) == 7 and report["m", "gone"].short and report["m", "gone"].tokens == 0 and report["z", "hot"].tokens == 0
    big = report["m", "big"]
    assert abs(big.tokens - big.target_tokens) <= 2 * block and not big.short
    assert sum(r.tokens for r in rows if r.mix_name == "n") == report["n", "hot"].tokens
    assert {tuple(r) for r in pieces.collect()} == {tuple(r) for r in rows}


def test_blocks_hold_every_token_once(spark):
    df, _ = build(spark)
    got = mix.packed(df, 16).groupBy("source").sum("tokens").collect()
    want = df.filter("source is not null").groupBy("source").sum("n_tokens").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    full = mix.packed(df, 16).groupBy("source", "block").sum("tokens").toPandas()
    assert (full.groupby("source")["sum(tokens)"].apply(lambda s: (s < 16).sum()) <= 1).all()


def test_empty_mix(spark):
    df, targets = build(spark)
    pieces, shares = mix.mixes(df.limit(0), targets)
    assert pieces.count() == 0 and shares.count() == 7
    pieces, shares = mix.mixes(df, targets.limit(0))
    assert pieces.count() == 0 and shares.count() == 0


@given(st.lists(st.integers(1, 400), min_size=1, max_size=6), st.integers(0, 10**6), st.integers(0, 50))
def test_corrected_draws_meet_every_number_exactly(slots, seed, key):
    slots = np.array(slots)
    size = int(slots.sum())
    counts = mix.shard_counts("m", seed, size, slots / size)
    assert counts.sum() == size and (counts == mix.shard_counts("m", seed, size, slots / size)).all()
    source = np.repeat(np.arange(len(slots)), counts)
    number = np.concatenate([np.arange(n) for n in counts])
    to, within = mix.corrected(number, source, counts, slots, key)
    assert sorted(zip(to.tolist(), within.tolist())) == [(s, k) for s, n in enumerate(slots) for k in range(n)]
    # only what was drawn too often changes hands
    assert (to != source).sum() == np.maximum(counts - slots, 0).sum()


def test_shard_counts_are_multinomial():
    shares = np.array([0.7, 0.2, 0.1])
    counts = np.array([mix.shard_counts("m", k, 1000, shares) for k in range(400)])
    assert abs(counts.mean(axis=0) / 1000 - shares).max() < 0.01
    assert (abs(counts.var(axis=0) / (1000 * shares * (1 - shares)) - 1) < 0.3).all()


def test_slots_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(mix, "SHARD_SLOTS", 16)
    monkeypatch.setattr(mix, "SHARD_CHUNK", 3)
    plan = spark.createDataFrame([("m", "a", 500, 200), ("m", "b", 77, 80), ("m", "c", 0, 9), ("n", "a", 5, 2)], "mix_name string, source_name string, slots long, blocks long")
    rows = mix.drawn(plan).toPandas()
    assert sorted(rows[rows.mix_name == "m"].position) == list(range(577)) and (rows.shard == rows.position // 16).all()
    assert rows.groupby(["mix_name", "source"]).size().to_dict() == {("m", "a"): 500, ("m", "b"): 77, ("n", "a"): 5}
    assert not rows.duplicated(["mix_name", "source", "block", "turn"]).any() and rows[rows.source == "b"].turn.max() == 1


def test_targets_against_sql(spark):
    data = Path("/root/testdata/sf0.001")
    if not data.exists():
        pytest.skip("no tables here")
    con = duckdb.connect()
    for f in data.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    for name, sql in queries.SQL.items():
        df = queries.QUERIES[name](spark, str(data))
        want = con.execute(sql).df()[df.columns]
        assert sorted(map(tuple, df.toPandas().itertuples(index=False))) == sorted(map(tuple, want.itertuples(index=False)))
