"""Small fixed report files for tests: CSV text, manifests and their folders."""

import csv
import gzip
import io
import json
from pathlib import Path

BASE = {
    "identity/LineItemId": "a" * 49 + "1",
    "identity/TimeInterval": "2024-01-05T03:00:00Z/2024-01-05T04:00:00Z",
    "bill/BillingPeriodStartDate": "2024-01-01T00:00:00Z",
    "bill/BillingPeriodEndDate": "2024-02-01T00:00:00Z",
    "bill/PayerAccountId": "012345678901",
    "lineItem/UsageAccountId": "012345678901",
    "lineItem/LineItemType": "Usage",
    "lineItem/UsageStartDate": "2024-01-05T03:00:00Z",
    "lineItem/UsageEndDate": "2024-01-05T04:00:00Z",
    "lineItem/ProductCode": "AmazonEC2",
    "lineItem/UsageType": "BoxUsage:t3.micro",
    "lineItem/Operation": "RunInstances",
    "lineItem/AvailabilityZone": "us-east-1a",
    "lineItem/ResourceId": "arn:aws:ec2:us-east-1:123456789012:instance/i-1",
    "lineItem/UsageAmount": "2.5",
    "lineItem/UnblendedCost": "10.0000000001",
    "lineItem/BlendedCost": "9.5",
    "lineItem/CurrencyCode": "USD",
    "product/ProductName": "AmazonEC2",
    "product/servicecode": "AmazonEC2",
    "product/region": "us-east-1",
    "pricing/unit": "Hrs",
    "pricing/currency": "USD",
}


def line(**changes):
    """A line item; keyword names use __ for the slash of the column name."""
    return {**BASE, **{k.replace("__", "/"): v for k, v in changes.items()}}


def csv_text(records, columns=None):
    columns = columns or list(records[0])
    out = io.StringIO()
    writer = csv.DictWriter(out, columns)
    writer.writeheader()
    writer.writerows({c: r.get(c, "") for c in columns} for r in records)
    return out.getvalue()


def put(root, bucket, key, data):
    path = Path(root, bucket, key)
    path.parent.mkdir(parents=True, exist_ok=True)
    raw = data.encode() if isinstance(data, str) else data
    path.write_bytes(gzip.compress(raw) if key.endswith(".gz") else raw)
    return str(path)


def put_manifest_v1(root, period, version, keys, bucket="bkt", prefix="cur", export="prod", **more):
    year, month = map(int, period.split("-"))
    after = f"{year + month // 12}{month % 12 + 1:02d}01"
    key = f"{prefix}/{export}/{year}{month:02d}01-{after}/{export}-Manifest.json"
    body = {"assemblyId": version, "reportKeys": keys, "bucket": bucket, **more}
    put(root, bucket, key, json.dumps(body))
    return key


def put_manifest_v2(root, period, body, bucket="bkt", prefix="cur", export="prod"):
    key = f"{prefix}/{export}/metadata/BILLING_PERIOD={period}/{export}-Manifest.json"
    put(root, bucket, key, json.dumps(body))
    return key
