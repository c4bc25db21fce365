"""Operators on a user's own DataFrame, in a session whose workers do not have the package on their path."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
HEAD = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.driver.memory", "1g").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
"""


def run_apart(body: str, folder: Path) -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", HEAD + body], cwd=folder, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


@pytest.mark.parametrize(
    "body, want",
    [
        ("from postloom.operators.lists import explode_packed\nprint(explode_packed(spark.createDataFrame([(1, 'a, b')], 'row_id int, skills string'), ['row_id'], ['skills']).count())", "2"),
        ("from postloom.functions.skills import skills_column\nprint(spark.createDataFrame([('Figma, Blender', None)], 't string, d string').select(skills_column(F.col('t'), F.col('d')).alias('s')).first().s)", "['figma', 'blender']"),
        ("from postloom.functions.html import pages_to_jobs\nprint(pages_to_jobs(spark.createDataFrame([('https://a.example/', '<a href=/jobs/1>Art Director</a>')], 'url string, html string')).count())", "1"),
    ],
)
def test_workers_get_the_package(body, want, tmp_path):
    assert want in run_apart(body, tmp_path)


def test_a_cluster_must_name_its_checkpoint_folder(monkeypatch):
    from postloom import session

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                return Context

        @staticmethod
        def getCheckpointDir():
            return Context

        @staticmethod
        def isDefined():
            return False

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session)
