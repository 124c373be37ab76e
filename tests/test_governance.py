from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import governance as gov


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("e1", "Ann", "IT", 10.0, date(2015, 1, 1)), ("e2", "Bob", "IT", 20.0, None)],
        "employee_id string, full_name string, department string, salary double, left_on date",
    )


def test_classes(people):
    classes = {"employee_id": gov.INTERNAL, "full_name": gov.PII, "department": gov.INTERNAL, "salary": gov.CONFIDENTIAL}
    got = {r.column_name: (r["class"], r.status, r.filled_rows) for r in gov.classify_columns(people, "employees", classes).collect()}
    assert got["full_name"] == ("PII", "PASS", 2)
    assert got["left_on"] == (None, "FAIL", 1)


def test_personas(people):
    assert gov.persona_view(people, "employees", "HR Team").columns == people.columns
    masked = gov.persona_view(people, "employees", "BI Analyst", hidden=["salary"])
    assert "salary" not in masked.columns and masked.count() == 2
    with pytest.raises(gov.AccessDenied):
        gov.persona_view(people, "employees", "BI Analyst")
    with pytest.raises(gov.AccessDenied):
        gov.persona_view(people, "employees", "Finance Team")
    with pytest.raises(gov.AccessDenied):
        gov.persona_view(people, "employees", "Executive")
    view = gov.persona_view(people, "employees", "Executive", group=["department"], measures={"pay": F.avg("salary")})
    assert [tuple(r) for r in view.collect()] == [("IT", 15.0)]
    assert gov.ACCESS["Data Engineer"]["salary_history"] == gov.READ


def test_retention(spark, tmp_path):
    as_of = date(2024, 2, 29)
    days = [date(2024, 2, 1), date(2023, 2, 28), date(2019, 2, 28), date(2019, 3, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    split = gov.retention_split(df, "d", as_of, gov.RETENTION["transactions"])
    assert [r.disposition for r in split.collect()] == ["keep", "archive", "delete", "archive", "keep"]
    assert gov.write_by_disposition(split, str(tmp_path / "r")) == 4
    assert spark.read.parquet(str(tmp_path / "r")).count() == 4
    events = gov.retention_split(df, "d", as_of, gov.RETENTION["events"])
    assert [r.disposition for r in events.collect()] == ["keep", "keep", "delete", "delete", "keep"]


def test_pseudonymise(people):
    expired = F.col("left_on") < F.lit(date(2016, 1, 1))
    one, two = gov.pseudonymise(people, ids=["employee_id"], names=["full_name"], salt="s", expired=expired).orderBy("salary").collect()
    assert len(one.employee_id) == 64 and one.full_name is None and one.department == "IT"
    assert (two.employee_id, two.full_name) == ("e2", "Bob")
    other = gov.pseudonymise(people, ids=["employee_id"], names=[], salt="t", expired=expired).orderBy("salary").first()
    assert other.employee_id != one.employee_id


def test_free_text_reads_whole_texts(spark):
    long_text = "filler " * 50_000 + "write to a.b@example.org or 10.0.0.1, call +49 123 4567"
    df = spark.createDataFrame([("s", long_text), ("s", None), ("t", "x@y.co x@y.co")], "source string, text string")
    got = {r.source: r for r in gov.free_text_audit(df, "text", "source").collect()}
    assert (got["s"].texts, got["s"].emails, got["s"].ip_addresses, got["s"].phone_numbers) == (2, 1, 1, 1)
    assert got["t"].emails == 2
