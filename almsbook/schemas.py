"""Declared schemas of the landed extracts; nothing is inferred at read time."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _schema(text: str, **typed) -> T.StructType:
    return T.StructType(
        [T.StructField(name, typed.get(name, T.StringType())) for name in text.split()]
    )


CONTACTS = _schema("donor_id donor_name donor_type email first_gift_date state", first_gift_date=T.DateType())
GIFTS = _schema(
    "gift_id donor_id fund_id campaign_id gift_date gift_amount gift_type",
    gift_date=T.DateType(), gift_amount=MONEY,
)
PLEDGES = _schema(
    "pledge_id donor_id fund_id pledge_date pledged_amount paid_amount status",
    pledge_date=T.DateType(), pledged_amount=MONEY, paid_amount=MONEY,
)
LEDGER = _schema(
    "transaction_id line_no transaction_date account_number fund_id subsidiary_id "
    "debit_amount credit_amount memo source_gift_id",
    line_no=T.IntegerType(), transaction_date=T.DateType(), debit_amount=MONEY, credit_amount=MONEY,
)
ACCOUNTS = _schema("account_number account_name account_type")
SUBSIDIARIES = _schema("subsidiary_id subsidiary_name")
FUNDS = _schema("fund_id fund_name fund_type restriction_type")
CAMPAIGNS = _schema(
    "campaign_id campaign_name goal_amount start_date end_date",
    goal_amount=MONEY, start_date=T.DateType(), end_date=T.DateType(),
)
ADJUSTMENTS = _schema("adjustment_id donor_name fund_id adjustment_amount reason", adjustment_amount=MONEY)

# Columns of the two files that the preparation of adjustments writes.
PREPARED = T.StructType([*ADJUSTMENTS, *_schema("fund_name fund_type restriction_type")])
REJECTED = T.StructType([*PREPARED, *_schema("error_reason")])

# Landed extracts by table name.
RAW = {
    "contacts": CONTACTS,
    "gifts": GIFTS,
    "pledges": PLEDGES,
    "ledger": LEDGER,
    "accounts": ACCOUNTS,
    "subsidiaries": SUBSIDIARIES,
    "funds": FUNDS,
    "campaigns": CAMPAIGNS,
    "adjustments": ADJUSTMENTS,
}

# JSON records of the CRM extract, each with the metadata envelope the service adds.
_ENVELOPE = T.StructField("attributes", T.StructType([T.StructField("type", T.StringType())]))
CRM_CONTACTS = T.StructType(
    [_ENVELOPE, *_schema("Id Name AccountId Email MailingState npsp__First_Gift_Date__c",
                         npsp__First_Gift_Date__c=T.DateType())]
)
CRM_OPPORTUNITIES = T.StructType(
    [_ENVELOPE, *_schema("Id ContactId Amount CloseDate Type StageName Fund__c CampaignId",
                         Amount=MONEY, CloseDate=T.DateType())]
)
CRM_CAMPAIGNS = T.StructType(
    [_ENVELOPE, *_schema("Id Name ExpectedRevenue StartDate EndDate",
                         ExpectedRevenue=MONEY, StartDate=T.DateType(), EndDate=T.DateType())]
)
