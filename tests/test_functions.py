"""Column expressions against plain Python, quirks included."""

import datetime as dt
import random
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from capledger.functions import dates, filings, numbers, search, text


def column(spark, values, kind, expression):
    """``expression(col)`` over a one-column frame, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def python_date(value):
    for pattern in ("%Y-%m-%d", "%Y-%m", "%Y", "%m/%d/%Y", "%d/%m/%Y"):
        try:
            return dt.datetime.strptime(value or "", pattern).date()
        except ValueError:
            continue
    return None


def test_dates_read_like_strptime(spark):
    values = [
        "2020-05-07", "2020-5-7", "2020-05- 7", "2020-05", "2020-5", "2020", "05/07/2020", "5/7/2020",
        "13/07/2020", "07/13/2020", "31/12/1999", "2020-02-30", "02/30/2020", "30/02/2020", "2020-13",
        "2020-00", "0000", "0000-01-01", "0001-01-01", "-2020", " 2020", "2020 ", "2020-05-07\n", "20200507",
        "May 2020", "2020-05-07T00:00", "2020/05/07", "", None, "12/12/12", "29/02/2020", "2019-02-29",
        " 1/05/2020", "1/ 5/2020", "00/10/2020", "2020-10-00", "2020-1-011",
    ]
    assert column(spark, values, "STRING", dates.parsed_date) == [python_date(v) for v in values]


@pytest.mark.parametrize("a,b,expected", [
    (100.0, 90.0, True), (100.0, 89.99, False), (90.0, 100.0, True), (0.0, 0.0, False),
    (None, 5.0, False), (-5.0, -80.0, True), (-5.0, 5.0, False), (float("nan"), 5.0, False),
    (float("inf"), 5.0, False), (1e-300, 1.05e-300, True),
])
def test_amount_similarity(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a DOUBLE, b DOUBLE")
    similar = numbers.amounts_are_similar(F.col("a"), F.col("b"), 0.10)
    assert df.select(similar.alias("out")).first().out is expected


@pytest.mark.parametrize("a,b,fuzzy,expected", [
    ("Seed", "Pre-Seed", True, True), ("Seed", "Pre-Seed", False, False), ("Series Alpha", "series a", True, True),
    ("\tSeries Z ", "series z", False, True), (" ", "\n", True, True), ("", "", True, False),
    (None, "Seed", True, False), ("Series A", "Series B", True, False), ("\x1cBridge ", "bridge", True, True),
])
def test_round_names(spark, a, b, fuzzy, expected):
    df = spark.createDataFrame([(a, b)], "a STRING, b STRING")
    match = text.round_names_match(F.col("a"), F.col("b"), fuzzy)
    assert df.select(match.alias("out")).first().out is expected


def test_numbers_from_text(spark):
    values = ["5", " 5.50 ", "-1e3", "1_000", ".5", "5.", "5d", "Indefinite", "", None, "1__0", "0x10", "inf", "1,000"]
    want = [5.0, 5.5, -1000.0, 1000.0, 0.5, 5.0, None, None, None, None, None, None, float("inf"), None]
    assert column(spark, values, "STRING", numbers.number_from_text) == want


def test_cik_padding_never_truncates(spark):
    assert column(spark, ["7", "12345678901"], "STRING", numbers.padded_cik) == ["0000000007", "12345678901"]
    assert column(spark, ["0000000007"], "STRING", numbers.unpadded_cik) == [7]


def test_titles(spark):
    values = ["x" * 490, "x" * 491, None]
    assert column(spark, values, "STRING", text.truncated_title) == ["x" * 490, "x" * 490 + "...", None]


def test_account_masking(spark):
    values = ["Jo jonathan@mail.example rest", "Jo a@b@c", "Jo", "jo@mail.example", "Jo  ab@x", None]
    want = ["Jo jon***@mail.example", "Jo a@b@c", "Jo", "jo@mail.example", "Jo ab***@x", None]
    assert column(spark, values, "STRING", text.masked_account) == want


def test_url_masking(spark):
    values = ["postgresql://me:secret@host:5/db?x=1", "postgresql://me@host/db", "sqlite:///file.db"]
    want = ["postgresql://me:***@host:5/db?x=1", "postgresql://me:***@host/db", "sqlite:///file.db"]
    assert column(spark, values, "STRING", text.masked_url_password) == want
    assert column(spark, values[:1], "STRING", text.url_host) == ["host:5"]
    assert column(spark, values[:1], "STRING", text.url_database) == ["db"]


def test_email_masking_in_text(spark):
    values = ["write to first.last@mail.example now", "a@b", "none"]
    assert column(spark, values, "STRING", text.masked_emails) == ["write to fir***@mail.example now", "a***@b", "none"]


def test_index_arrays_pad_with_null(spark):
    payloads = [
        '{"filings": {"recent": {"form": ["D", "D/A"], "filingDate": ["2020-01-01"], "accessionNumber": ["1", "2"]}}}',
        '{"filings": {}}', "{}", "not json",
    ]
    rows = column(spark, payloads, "STRING", filings.index_rows)
    assert [tuple(r) for r in rows[0]] == [("D", "2020-01-01", "1"), ("D/A", None, "2")]
    assert rows[1:] == [[], [], []]


def test_offering_documents(spark):
    ns = filings.OFFERING_NAMESPACE
    values = [
        f'<e xmlns="{ns}"><offeringData><s><totalOfferingAmount>12.5</totalOfferingAmount></s></offeringData></e>',
        f'<p:e xmlns:p="{ns}"><p:offeringData><p:totalOfferingAmount> 7 </p:totalOfferingAmount></p:offeringData></p:e>',
        f'<e xmlns="{ns}"><offeringData><totalOfferingAmount>Indefinite</totalOfferingAmount></offeringData></e>',
        f'<e xmlns="{ns}"><offeringData/></e>',
        f'<e xmlns="{ns}"><issuer/></e>',
        f'<e xmlns="{ns}"><offeringData></e>',
        '<e xmlns="urn:x"><offeringData><totalOfferingAmount>1</totalOfferingAmount></offeringData></e>',
        None,
    ]
    got = column(spark, values, "STRING", filings.offering)
    assert [(r.is_offering, r.amount) for r in got] == [
        (True, 12.5), (True, 7.0), (True, None), (True, None), (False, None), (False, None), (False, None), (False, None),
    ]


def test_rounds_in_answers(spark):
    values = [
        'Sure: [{"round_name": "Seed", "amount_raised_usd": 5e6, "all_investors": ["A"]}, {"date": "2020"}] ok',
        "[]", "nothing", "[{broken]", '[1, {"round_name": "Seed"}]', "] [", None,
        '[{"amount_raised_usd": "12"}]',
    ]
    got = column(spark, values, "STRING", search.response_rounds)
    assert [r.round_name for r in got[0]] == ["Seed", None]
    assert got[0][0].all_investors == ["A"]
    assert got[1] == [] and got[2:7] == [None] * 5
    assert got[7][0].amount_raised_usd == "12"


def test_prompt_numbers_hits_from_one(spark):
    block = spark.range(1).select(
        search.prompt(F.lit("Acme"), search.hit_block(F.lit(1), F.lit("T"), F.lit("U"), F.lit("S"))).alias("p")
    ).first().p
    assert "Company: Acme\n\nSearch Results:\n\n\n--- Result 1 ---\nTitle: T\nURL: U\nSnippet: S\n" in block
    assert block.endswith("JSON array:") and "{company}" not in block


def _random_document(rng):
    """Nested elements of a few names under prefixes that come, go and are bound anew; some are broken."""
    uris = [filings.OFFERING_NAMESPACE, "urn:b"]

    def element(depth):
        prefix = rng.choice(["", "", "s:", "t:"])
        name = prefix + rng.choice(["offeringData", "totalOfferingAmount", "x"])
        attributes = rng.choice(["", "", f' xmlns="{rng.choice(uris)}"', f" xmlns:s='{rng.choice(uris)}'", f' xmlns:t = "{rng.choice(uris)}" k="1>2"', ' t:k="x"'])
        if depth > 4 or rng.random() < 0.2:
            return f"<{name}{attributes}/>"
        inner = "".join(rng.choice(["<!-- <offeringData> -->", str(rng.randint(0, 99)), "a > b", element(depth + 1), element(depth + 1)]) for _ in range(rng.randint(0, 3)))
        return f"<{name}{attributes}>{inner}</{name}>"

    inner = "".join(element(1) for _ in range(3))
    text = f'<?xml version="1.0"?><!DOCTYPE e><e xmlns="{rng.choice(uris)}" xmlns:s="{rng.choice(uris)}" xmlns:t="{rng.choice(uris)}">{inner}</e>'
    return text[:-5] if rng.random() < 0.05 else text


def test_offerings_agree_with_a_namespace_aware_parser(spark):
    rng = random.Random(11)
    documents = [_random_document(rng) for _ in range(1500)] + [None, "", "plain", f'<e xmlns="{filings.OFFERING_NAMESPACE}"/>']
    space = {"o": filings.OFFERING_NAMESPACE}
    want = []
    for text in documents:
        try:
            data = ElementTree.fromstring(text or "").find(".//o:offeringData", space)
        except ElementTree.ParseError:
            data = None
        amount = None if data is None else data.find(".//o:totalOfferingAmount", space)
        try:
            number = float(amount.text)
        except (AttributeError, TypeError, ValueError):
            number = None
        want.append((data is not None, number))
    got = column(spark, documents, "STRING", filings.offering)
    assert [(r.is_offering, r.amount) for r in got] == want
    assert len({w[0] for w in want}) == 2 and sum(n is not None for _, n in want) > 10


def test_offering_documents_are_read_and_parsed_once(spark):
    from capledger.functions.filings import OFFERING_NAMESPACE, _TAG, offering

    text = f'<e xmlns="{OFFERING_NAMESPACE}"><a><offeringData><b/><totalOfferingAmount>5</totalOfferingAmount></offeringData></a></e>'
    read = spark.createDataFrame([(text,)], "document string").select(offering(F.col("document")).alias("o"))
    assert read.first().o == (True, 5.0)
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") + plan.count("xmltostructs(") == 1
    assert plan.count(_TAG) <= 2  # tags, and the text behind each
