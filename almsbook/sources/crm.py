"""CRM extracts landed as JSON lines, brought to the raw contract.

Each record carries a metadata envelope, which the explicit projections leave behind. Lines that are no records, whose values
do not fit or that have no id are in no extract: :func:`rejected` has them with the reason, so every line is in one or the other.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from almsbook.schemas import CRM_CAMPAIGNS, CRM_CONTACTS, CRM_OPPORTUNITIES
from almsbook.sources.files import CORRUPT

RECORDS = {"contacts": CRM_CONTACTS, "opportunities": CRM_OPPORTUNITIES, "campaigns": CRM_CAMPAIGNS}
NOT_JSON, MISFIT, NO_ID = "not a record", "a value does not fit its type", "no id"


def records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All lines that hold anything, with their file and, for those to be rejected, the reason.

    Lines are read as text and parsed one by one, so the original line is at hand for whatever goes wrong with it.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    checked = StructType([*schema, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "dateFormat": "yyyy-MM-dd"}
    parsed = lines.select("value", "file", F.from_json("value", checked, options).alias("record"))
    # The tokens of a line tell a broken one from one whose values are of another kind.
    is_record = F.coalesce(F.try_parse_json("value").isNotNull() & F.startswith(F.ltrim("value"), F.lit("{")), F.lit(False))
    reason = (
        F.when(~is_record, NOT_JSON)
        .when(F.col("record").isNull() | F.col("record")[CORRUPT].isNotNull(), MISFIT)
        .when(F.coalesce(F.col("record")["Id"], F.lit("")) == "", NO_ID)
    )
    return parsed.withColumn("reason", reason)


def _valid(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return records(spark, path, schema).where("reason IS NULL").select("record.*")


def rejected(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``(kind, file, reason, line)``: lines of an extract that no table gets."""
    return records(spark, path, RECORDS[kind]).where("reason IS NOT NULL").select(
        F.lit(kind).alias("kind"), "file", "reason", F.col("value").alias("line")
    )


def misfits(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``(table_name, n)``: rejected lines per extract, a row for each, as the landed tables have it."""
    counted = [
        rejected(spark, path, kind).agg(F.count("*").alias("n")).select(F.lit(f"crm {kind}").alias("table_name"), "n") for kind, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def crm_contacts(spark: SparkSession, path: str) -> DataFrame:
    """Contacts with a first gift. The extract knows no donor type."""
    found = _valid(spark, path, CRM_CONTACTS)
    return found.where(F.col("npsp__First_Gift_Date__c").isNotNull()).select(
        F.col("Id").alias("donor_id"),
        F.col("Name").alias("donor_name"),
        F.lit(None).cast("string").alias("donor_type"),
        F.col("Email").alias("email"),
        F.col("npsp__First_Gift_Date__c").alias("first_gift_date"),
        F.col("MailingState").alias("state"),
    )


def crm_opportunities(spark: SparkSession, path: str) -> DataFrame:
    """Closed gifts, newest first; the id as second key lets one busy day spread over many tasks."""
    found = _valid(spark, path, CRM_OPPORTUNITIES)
    return found.where(F.col("StageName") == "Closed Won").select(
        F.col("Id").alias("gift_id"),
        F.col("ContactId").alias("donor_id"),
        F.col("Fund__c").alias("fund_id"),
        F.col("CampaignId").alias("campaign_id"),
        F.col("CloseDate").alias("gift_date"),
        F.col("Amount").alias("gift_amount"),
        F.col("Type").alias("gift_type"),
    ).orderBy(F.desc("gift_date"), "gift_id")


def crm_campaigns(spark: SparkSession, path: str) -> DataFrame:
    return _valid(spark, path, CRM_CAMPAIGNS).select(
        F.col("Id").alias("campaign_id"),
        F.col("Name").alias("campaign_name"),
        F.col("ExpectedRevenue").alias("goal_amount"),
        F.col("StartDate").alias("start_date"),
        F.col("EndDate").alias("end_date"),
    )
