"""Fixed values of the billing formats: names and lists that results depend on."""

# --- fixed values: raw column names every billing report must carry -------------
REQUIRED_REPORT_COLUMNS = (
    "identity/LineItemId",
    "identity/TimeInterval",
    "bill/BillingPeriodStartDate",
    "bill/BillingPeriodEndDate",
    "bill/PayerAccountId",
    "lineItem/UsageAccountId",
    "lineItem/LineItemType",
    "lineItem/UsageStartDate",
    "lineItem/UsageEndDate",
    "lineItem/ProductCode",
    "lineItem/UsageType",
    "lineItem/Operation",
    "lineItem/AvailabilityZone",
    "lineItem/ResourceId",
    "lineItem/UsageAmount",
    "lineItem/UnblendedCost",
    "lineItem/BlendedCost",
    "lineItem/CurrencyCode",
    "product/ProductName",
    "product/servicecode",
    "product/region",
    "pricing/unit",
    "pricing/currency",
)

# --- fixed values: raw columns with a type other than text ----------------------
AMOUNT_COLUMNS = (
    "lineItem/UsageAmount",
    "lineItem/UnblendedRate",
    "lineItem/UnblendedCost",
    "lineItem/BlendedRate",
    "lineItem/BlendedCost",
    "lineItem/NetUnblendedCost",
    "pricing/publicOnDemandRate",
    "pricing/publicOnDemandCost",
)
TIMESTAMP_COLUMNS = (
    "bill/BillingPeriodStartDate",
    "bill/BillingPeriodEndDate",
    "lineItem/UsageStartDate",
    "lineItem/UsageEndDate",
)

# --- fixed values: column categories, in report order ---------------------------
COLUMN_CATEGORIES = (
    "identity",
    "bill",
    "lineItem",
    "product",
    "pricing",
    "reservation",
    "savingsPlans",
    "resourceTags",
)

# --- fixed values: allowed contents ---------------------------------------------
LINE_ITEM_TYPES = (
    "Usage",
    "DiscountedUsage",
    "Credit",
    "Discount",
    "Fee",
    "Tax",
    "Refund",
    "BundledDiscount",
)
PRODUCT_CODES = ("AmazonEC2", "AmazonS3", "AmazonRDS", "AmazonCloudFront", "AWSLambda")
REGIONS = (
    "us-east-1",
    "us-east-2",
    "us-west-1",
    "us-west-2",
    "eu-west-1",
    "eu-west-2",
    "eu-central-1",
    "ap-southeast-1",
    "ap-southeast-2",
    "ap-northeast-1",
)
CURRENCY = "USD"
LINE_ITEM_ID_LENGTH = 50
ARN_MIN_PARTS = 6

# --- fixed values: manifests ----------------------------------------------------
REQUIRED_MANIFEST_FIELDS = (
    "assemblyId",
    "account",
    "columns",
    "charset",
    "compression",
    "contentType",
    "reportId",
    "reportName",
    "billingPeriod",
    "bucket",
    "reportKeys",
)

# --- fixed values: FOCUS records ------------------------------------------------
FOCUS_REQUIRED_COLUMNS = (
    "BillingPeriodStart",
    "BillingPeriodEnd",
    "ServiceName",
    "ResourceId",
    "UsageQuantity",
    "BilledCost",
    "EffectiveCost",
    "BillingCurrency",
    "Provider",
)
FOCUS_SERVICES = ("EC2", "S3", "RDS", "Lambda", "DynamoDB", "CloudFront")
COMPUTE_SERVICES = ("EC2", "Lambda")
HOURLY_SERVICES = ("EC2", "RDS")

# --- fixed values: provider service names and their common name -----------------
SERVICE_NAMES = {
    ("aws", "AmazonEC2"): "Compute",
    ("azure", "Virtual Machines"): "Compute",
    ("gcp", "Compute Engine"): "Compute",
}

# --- fixed values: table names --------------------------------------------------
TABLE_NAME_LENGTH = 50
TABLE_NAME_PREFIX = "export_"
UNIFIED_SUFFIX = "_unified"
