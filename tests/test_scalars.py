import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from spendloom.functions import scalars as S


def one(df, *columns):
    return df.select(*columns).first()


def test_money(rows):
    df = rows("t string", ("",), (None,), ("0.0049",), ("1.005",), ("-3.2",), ("123456.78",), ("x",),
              ("1.5E-7",), ("123456789012.345",))
    two = [r[0] for r in df.select(S.rounded(F.col("t"), 2)).collect()]
    assert two == [None, None, D("0.00"), D("1.01"), D("-3.20"), D("123456.78"), None, D("0.00"),
                   D("123456789012.35")]
    exact = [r[0] for r in df.select(S.amount(F.col("t"))).collect()]
    assert exact[2] == D("0.0049") and exact[7] == D("0.00000015") and exact[6] is None
    assert df.where(S.has_amount(df, "t")).count() == 6


def test_unit_rate(rows):
    df = rows("c decimal(28,10), u decimal(28,10)", (D(10), D(3)), (D(5), D(0)), (D(-2), D(4)))
    got = [r[0] for r in df.select(S.unit_rate(F.col("c"), F.col("u"))).collect()]
    assert got == [D("3.3333333333"), D(0), D("-0.5")]


def test_time(rows):
    df = rows("p string, i string", ("2024-12", "2024-01-05T03:00:00Z/2024-01-05T04:00:00Z"))
    r = one(df, S.period_start(F.col("p")), S.period_end(F.col("p")), S.interval_start(F.col("i")),
            S.interval_end(F.col("i")),
            S.time_interval(S.interval_start(F.col("i")), S.interval_end(F.col("i"))))
    assert tuple(r) == (dt.date(2024, 12, 1), dt.date(2025, 1, 1), dt.datetime(2024, 1, 5, 3),
                        dt.datetime(2024, 1, 5, 4), "2024-01-05T03:00:00Z/2024-01-05T04:00:00Z")
    bad = rows("t string", ("2024-01-05T03:00:00Z",), ("nope",))
    assert [r[0] for r in bad.select(S.iso_timestamp(F.col("t"))).collect()] == [dt.datetime(2024, 1, 5, 3), None]


def test_text(rows):
    df = rows("u string", ("BoxUsage:t3.micro",), ("EBS",), ("a:b:c",))
    assert [r[0] for r in df.select(S.instance_type(F.col("u"), "t3.micro")).collect()] == ["t3.micro", "t3.micro", "c"]
    arn = rows("a string", ("arn:aws:rds:us-east-1:123:db:name",), ("arn:aws:s3:::bucket",), ("x",))
    got = [tuple(r[0]) for r in arn.select(S.arn_parts(F.col("a"))).collect()]
    assert got == [("aws", "rds", "us-east-1", "123", "db:name"), ("aws", "s3", "", "", "bucket"),
                   (None, None, None, None, None)]
    assert one(rows("v string", ("abcdefghij",)), S.short_id(F.col("v")))[0] == "abcdefgh"


def test_tags(rows):
    df = rows("j string, e string, o string", ('{"Environment": "Prod", "Owner": "t"}', "dev", ""), ("", None, "me"))
    got = df.select(S.tags_from_json(F.col("j")).alias("j"),
                    S.tags_from_columns({"Environment": "e", "Owner": "o"}).alias("w")).collect()
    assert got[0]["j"] == {"Environment": "Prod", "Owner": "t"} and got[1]["j"] is None
    assert got[0]["w"] == {"Environment": "dev"} and got[1]["w"] == {"Owner": "me"}


def test_classes(rows):
    df = rows("t string", ("Usage",), ("Tax",), ("Credit",), ("Fee",), (None,))
    assert [r[0] for r in df.select(S.charge_category(F.col("t"))).collect()] == ["Usage", "Tax", "Credit", "Other", "Other"]
    costs = rows("t string, u int, n int", ("DiscountedUsage", 1, 2), ("Usage", 1, 2), (None, 1, 2))
    assert [r[0] for r in costs.select(S.effective_cost(F.col("t"), F.col("u"), F.col("n"))).collect()] == [1, 2, 2]
    s = rows("s string", ("EC2",), ("Lambda",), ("RDS",), ("S3",))
    assert [tuple(r) for r in s.select(S.service_category(F.col("s")), S.usage_unit(F.col("s"))).collect()] == [
        ("Compute", "Hours"), ("Compute", "GB"), ("Storage", "Hours"), ("Storage", "GB")]
    n = rows("s string", ("AmazonEC2",), ("AmazonS3",), (None,))
    assert [r[0] for r in n.select(S.standard_service_name("aws", F.col("s"))).collect()] == ["Compute", "AmazonS3", None]
    assert n.select(S.standard_service_name("other", F.col("s"))).first()[0] == "AmazonEC2"
    st = rows("c boolean, e string", (True, None), (False, "boom"), (False, None), (False, ""))
    assert [r[0] for r in st.select(S.load_status(F.col("c"), F.col("e"))).collect()] == ["Complete", "Failed", "In Progress", "In Progress"]
