"""The operators on a user's own DataFrame, in a session whose workers do not have the package on their path."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from test_ship import run_apart  # noqa: E402

BODIES = [
    ("from postloom.llm.names import link_names\nprint('n', link_names(spark.createDataFrame([('Boda Tralute Media',)], 'name string')).count())", "n 1"),
    ("from postloom.llm.pivots import link_parts\nprint(spark.createDataFrame([('https://h.example/1234567',)], 'l string').select(link_parts(F.col('l')).alias('p')).first().p.code)", "1234567"),
    ("from postloom.llm.boilerplate import furniture\nprint('n', furniture(spark.createDataFrame([(1, 'Menu')], 'row_id long, description string')).count())", "n 1"),
    ("from postloom.llm.mojibake import restored\nprint('n', restored(spark.createDataFrame([(1, 'x', 'en')], 'doc_id long, text string, lang string')).count())", "n 1"),
]


@pytest.mark.parametrize("body, want", BODIES)
def test_workers_get_the_package(body, want, tmp_path):
    assert want in run_apart(body, tmp_path)
