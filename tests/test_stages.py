"""The four stages end to end, sources, sinks and streams."""

import csv
import datetime as dt
import glob
import json
from dataclasses import fields, replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from capledger.functions.filings import OFFERING_NAMESPACE
from capledger.operators import reporting, status as stage_status
from capledger.options import ExportOptions
from capledger.plans import export, stages
from capledger.schema import COMPANIES, INVESTORS, PROCESSING_STATUS, TABLES
from capledger.session import materialize
from capledger.sources import tables
from capledger.sources.company_list import read_company_list
from capledger.streaming import usage as usage_stream

T0 = dt.datetime(2024, 1, 1)


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_company_list(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_bytes("﻿company,Company,x\n Acme ,Other,1\n,Beta,2\n,,3\n\" \",,4\n\"Q, \"\"z\"\"\",,5\n".encode())
    assert [r.name for r in read_company_list(spark, str(path)).collect()] == ["Acme", "Beta", "", 'Q, "z"']
    assert [r.name for r in read_company_list(spark, str(path), limit=2).collect()] == ["Acme", "Beta"]
    other = tmp_path / "other.csv"
    other.write_text("Companies\nOne\n")
    assert [r.name for r in read_company_list(spark, str(other)).collect()] == ["One"]
    with pytest.raises(AnalysisException):
        read_company_list(spark, str(tmp_path / "missing.csv"))


def written(collected):
    """What a caller does between stages: write the tables."""
    return replace(collected, **{f.name: materialize(getattr(collected, f.name)) for f in fields(collected)})


def document(amount):
    return (
        f'<edgarSubmission xmlns="{OFFERING_NAMESPACE}"><offeringData><totalOfferingAmount>{amount}'
        "</totalOfferingAmount></offeringData></edgarSubmission>"
    )


def test_all_stages(spark, tmp_path):
    now = F.lit(T0)
    names = spark.createDataFrame([("Acme",), ("Beta",), ("Nobody",), ("Acme",)], "name STRING")
    companies, status = stages.register_companies(names, empty(spark, COMPANIES), empty(spark, PROCESSING_STATUS), now)
    companies, status = materialize(companies), materialize(status)
    assert companies.count() == 3 and status.count() == 3
    ids = {r.name: r.id for r in companies.collect()}

    directory = spark.createDataFrame([(0, "Acme Robotics", 77), (1, "Beta", 5)], "ordinal BIGINT, title STRING, cik BIGINT")
    index = json.dumps({"filings": {"recent": {
        "form": ["D", "D/A", "D"], "filingDate": ["2020-01-10", "2020-02-01"], "accessionNumber": ["1-1", "1-2", "1-3"]}}})
    indexes = spark.createDataFrame([("0000000077", index)], "cik STRING, payload STRING")
    documents = spark.createDataFrame(
        [("0000000077", "1-1", document(5000000)), ("0000000077", "1-3", document("Indefinite"))],
        "cik STRING, accession_number STRING, document STRING",
    )
    filed = written(stages.collect_filings(companies, status, empty(spark, INVESTORS), directory, indexes, documents, now))
    assert sorted((r.date, r.amount_raised_usd) for r in filed.rounds.where("date IS NOT NULL").collect()) == [("2020-01-10", 5000000.0)]
    assert sorted(r.title for r in filed.sources.collect()) == ["SEC Form D - 2020-01-10", "SEC Form D - None"]
    assert {r.name: r.cik for r in filed.companies.collect()} == {"Acme": "0000000077", "Beta": "0000000005", "Nobody": None}
    counts = {r.company_id: (r.stage2_sec_collected, r.stage2_rounds_found) for r in filed.status.collect()}
    assert counts == {ids["Acme"]: (True, 2), ids["Beta"]: (True, 0), ids["Nobody"]: (True, 0)}
    again = stages.collect_filings(filed.companies, filed.status, filed.investors, directory, indexes, documents, now)
    assert again.rounds.isEmpty()

    answer = json.dumps([
        {"round_name": "Series A", "date": "2020-02", "amount_raised_usd": 5200000, "lead_investor": "Fund",
         "all_investors": [" Fund ", "Fund", ""], "source_url": "u1"},
        {"round_name": "Seed", "date": "2015", "source_url": "u2"},
    ])
    responses = spark.createDataFrame([(ids["Acme"], f"Here: {answer}."), (ids["Beta"], "none")], "company_id BIGINT, response STRING")
    hits = spark.createDataFrame(
        [(ids["Acme"], 1, 1, "T1", "u1", "S1"), (ids["Acme"], 2, 1, "T2", "u1", "S2")],
        "company_id BIGINT, query_no INT, rank INT, title STRING, url STRING, snippet STRING",
    )
    found = written(stages.collect_search(filed.companies, filed.status, filed.investors, hits, responses, "priority", now))
    assert sorted((r.url, r.title, r.llm_provider) for r in found.sources.collect()) == [("u1", "T1", "priority"), ("u2", None, "priority")]
    assert [r.name for r in found.investors.collect()] == ["Fund"]
    assert found.round_investors.count() == 1

    rounds = filed.rounds.unionByName(found.rounds)
    merged, final = map(materialize, stages.merge_rounds(rounds, found.status, now))
    rows = {(r.source_type, r.date): r.is_duplicate for r in merged.collect()}
    assert rows == {("SEC_FORM_D", "2020-01-10"): False, ("SEC_FORM_D", None): False,
                    ("WEB_SEARCH", "2020-02"): True, ("WEB_SEARCH", "2015"): False}
    merged_counts = {r.company_id: (r.stage4_merged, r.stage4_unique_rounds) for r in final.collect()}
    assert merged_counts[ids["Acme"]] == (True, 3) and merged_counts[ids["Beta"]] == (False, 0)
    progress = stage_status.processing_progress(filed.companies, final).first()
    assert (progress.stage2_completed, progress.stage4_completed) == (3, 1)

    tables.write_table(merged, str(tmp_path), "funding_rounds")
    stored = tables.read_table(spark, str(tmp_path), "funding_rounds")
    assert stored.columns == [f.split()[0] for f in TABLES["funding_rounds"].replace("\n", " ").split(", ")]
    exported = reporting.export_rows(stored, filed.companies, found.round_investors, found.investors)
    assert exported.count() == 3 and len(exported.columns) == 13


def export_frame(spark):
    row = ("A\"b\", c", "", " Seed ", "2020", 5e7, None, None, "", "X, Y", "WEB_SEARCH", "LOW", "u", "two\nlines é")
    columns = ["Company Name", "Company CIK", "Round Name", "Date", "Amount Raised (USD)", "Pre-Money Valuation (USD)",
               "Post-Money Valuation (USD)", "Lead Investor", "All Investors", "Source Type", "Confidence Score", "Source URLs", "Notes"]
    kinds = ["DOUBLE" if "USD" in c else "STRING" for c in columns]
    return spark.createDataFrame([row], ", ".join(f"`{c}` {k}" for c, k in zip(columns, kinds))).coalesce(1)


def test_exports(spark, tmp_path):
    options = ExportOptions(output_directory=str(tmp_path))
    written = export.export_all(export_frame(spark), options, dt.datetime(2024, 5, 6, 7, 8, 9))
    assert set(written) == {"excel", "csv", "json"}
    assert written["csv"].endswith("funding_rounds_20240506_070809.csv")
    [part] = glob.glob(f"{written['csv']}/*.csv")
    with open(part, newline="", encoding="utf-8") as f:
        [row] = list(csv.DictReader(f))
    assert row["Company Name"] == 'A"b", c' and row["Notes"] == "two\nlines é"
    assert row["Amount Raised (USD)"] == "50000000.00" and row["Pre-Money Valuation (USD)"] == ""
    assert row["Round Name"] == " Seed " and row["Company CIK"] == ""
    [part] = glob.glob(f"{written['json']}/*.json")
    with open(part, encoding="utf-8") as f:
        [line] = f.read().splitlines()
    assert json.loads(line)["Post-Money Valuation (USD)"] is None and "é" in line
    assert spark.read.parquet(written["excel"]).count() == 1
    nothing = export.export_all(export_frame(spark).where("false"), options)
    assert nothing == {"excel": None, "csv": None, "json": None}


def test_restarted_usage_stream_equals_the_batch(spark, tmp_path):
    from capledger.operators.usage import daily_usage

    def land(name, hours):
        rows = [(T0 + dt.timedelta(hours=h), "p", "m", h % 3 > 0, h % 5 == 0, float(h), h, 2 * h) for h in hours]
        spark.createDataFrame(
            rows, "ts TIMESTAMP, provider_name STRING, model_name STRING, success BOOLEAN, rate_limited BOOLEAN, "
            "latency_ms DOUBLE, input_tokens INT, output_tokens INT"
        ).coalesce(1).write.parquet(f"{tmp_path}/landed/{name}")

    def drain():
        schema = spark.read.parquet(f"{tmp_path}/landed/*").schema
        calls = spark.readStream.schema(schema).parquet(f"{tmp_path}/landed/*")
        usage_stream.write_versions(
            usage_stream.daily_usage_stream(calls), f"{tmp_path}/usage", f"{tmp_path}/checkpoint"
        ).awaitTermination()

    land("a", range(0, 30))
    drain()
    land("b", range(30, 60))
    drain()
    keys = ["provider_name", "model_name", "date"]
    streamed = usage_stream.latest_versions(spark.read.parquet(f"{tmp_path}/usage"), keys)
    batch = daily_usage(spark.read.parquet(f"{tmp_path}/landed/*"))
    as_set = lambda df: {tuple(r) for r in df.select(sorted(batch.columns)).collect()}
    assert as_set(streamed) == as_set(batch)


def test_landed_batches_of_many_rows_are_several_files(spark, tmp_path, monkeypatch):
    from capledger.checks import movement

    monkeypatch.setattr(movement, "ROWS_PER_FILE", 100)
    rows = spark.range(1900).withColumn("day", F.col("id") % 400)
    arrivals = movement.landed_stream(rows, f"{tmp_path}/landed", 2, "day")
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "landed").glob("*.parquet")]
    assert len(sizes) > 10 and sum(sizes) == 1900 and max(sizes) < 400  # no task writes or reads half of all rows
    batches = []
    stream = arrivals.writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True)
    stream.foreachBatch(lambda batch, number: batches.append(batch.count())).start().awaitTermination()
    assert len(batches) == 2 and sum(batches) == 1900


def test_an_export_leaves_only_its_formats_and_no_uncompressed_copy(spark, tmp_path):
    from capledger.session import checkpoint_root

    kept = lambda: set(glob.glob(f"{checkpoint_root(spark)}/**/rdd-*", recursive=True)) | set(glob.glob(f"{checkpoint_root(spark)}/capledger-export-*"))
    before = kept()
    rows = spark.range(50).selectExpr("concat('Company ', id) AS `Company Name`", "CAST(id AS DOUBLE) AS `Amount Raised (USD)`")
    written = export.export_all(rows, ExportOptions(output_directory=str(tmp_path)), dt.datetime(2024, 1, 1))
    assert sorted(written) == ["csv", "excel", "json"] and spark.read.parquet(written["excel"]).count() == 50
    assert kept() == before
    links = spark.createDataFrame([(1, 2), (1, 2), (1, 1), (2, 2)], "round_id BIGINT, investor_id BIGINT")
    names = reporting.investor_names(links, spark.createDataFrame([(1, "B"), (2, "A")], "id BIGINT, name STRING"))
    assert {tuple(r) for r in names.collect()} == {(1, "B, A"), (2, "A")}
    assert names._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
