"""The command-line jobs, end to end on small inputs (same Spark session)."""

import json

from pricemart import cli
from pricemart.operators.fill import forward_fill
from pricemart.session import job_scratch, scratch_path, staged
from tests.test_sources import PRICE_PAGE, _write


def test_cli_jobs_end_to_end(spark, capsys):
    raw = scratch_path(spark, "cli-raw")
    payloads = scratch_path(spark, "cli-payloads")
    spark.createDataFrame([(1, '{"response":{"data":[{"period":"2026-03","value":"83.5"}]}}')],
                          "doc_id long, payload string").write.parquet(payloads)
    pages = scratch_path(spark, "cli-pages")
    spark.createDataFrame([(1, "u", PRICE_PAGE)], "page_id long, url string, html string").write.parquet(pages)
    rates_csv = _write(scratch_path(spark, "cli-rates"), "date,usd_lkr\n05/03/2026,300\n06/03/2026,302\n")
    assert cli.main(["ingest-benchmark", "--payloads", payloads, "--out", f"{raw}/benchmark", "--run-date", "2026-04-01"]) == 0
    assert cli.main(["ingest-rates", "--csv", rates_csv, "--out", f"{raw}/rates", "--run-date", "2026-04-01"]) == 0
    assert cli.main(["ingest-prices", "--pages", pages, "--out", f"{raw}/prices", "--run-date", "2026-04-01"]) == 0
    assert cli.main(["etl", "--raw", raw, "--out", scratch_path(spark, "cli-mart")]) == 0
    outs = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert outs[0] == {"landed": 1, "removed": 0} and outs[1] == {"landed": 1}
    assert outs[3]["counts"]["fact"] == 6 and outs[3]["counts"]["dim_rates"] == 1


def test_a_job_removes_its_own_scratch_only(spark):
    """A caller's folder and a live DataFrame survive a job; what the job staged goes, also when it fails."""
    mine = scratch_path(spark, "mine")
    spark.range(3).write.parquet(mine)
    live = forward_fill(spark.createDataFrame([("a", 1, 2.0), ("a", 2, None)], "s string, t int, v double"), ["v"], ["t"], ["s"])
    with job_scratch(spark):
        inside = staged(spark, spark.range(5), "inside")
        path = inside.inputFiles()[0]
        assert inside.count() == 5
    assert spark.read.parquet(mine).count() == 3 and sorted(r.v for r in live.collect()) == [2.0, 2.0]
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)
    try:
        with job_scratch(spark):
            failed = staged(spark, spark.range(5), "failed").inputFiles()[0]
            raise ValueError
    except ValueError:
        folder = spark._jvm.org.apache.hadoop.fs.Path(failed)
        assert not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)
