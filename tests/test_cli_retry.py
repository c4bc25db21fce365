import pytest

from postloom.__main__ import arguments, main
from postloom.sources.readers import read_csv
from postloom.sources.retry import FetchError, Retry


def test_retry_waits_and_gives_up():
    waits, errors = [], iter([FetchError("busy", 429), FetchError("down", 503)])

    def fetch():
        error = next(errors, None)
        if error:
            raise error
        return "page"

    assert Retry().run(fetch, waits.append, lambda: 0.5) == "page" and waits == [0.7 + 0.1, 1.4 + 0.1]

    def fail(error):
        raise error

    for error, tries in ((FetchError("gone", 404), 0), (FetchError("reset", code="ECONNRESET"), 2), (FetchError("odd"), 0)):
        waits.clear()
        with pytest.raises(FetchError):
            Retry().run(lambda error=error: fail(error), waits.append)
        assert len(waits) == tries
    with pytest.raises(ValueError):
        Retry(attempts=0).run(lambda: 1)


def test_command_line(spark, tmp_path, capsys):
    main(["--list"])
    assert "prune_buckets" in capsys.readouterr().out.split()
    with pytest.raises(SystemExit):
        arguments(["prune_buckets"])
    spark.createDataFrame([("a", "x", None), ("b", " ", None)], "company string, job_link string, company_website string").selectExpr("cast(1 as bigint) row_id", "*").write.parquet(str(tmp_path / "upload_rows.parquet"))
    for kind in ("parquet", "json", "csv"):
        main(["url_canonical", str(tmp_path), str(tmp_path / kind), "--format", kind], spark)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2 and {r.url for r in read_csv(spark, str(tmp_path / "csv")).collect()} == {"x", ""}
