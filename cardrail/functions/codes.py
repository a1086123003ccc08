"""Code tables: message types, currencies, merchant categories.

The tables hold 15, 23 and 19 rows and do not grow with the data. Row functions read them as
constant maps, which keeps the record path free of joins; ``operators.lookups`` joins the same tables
(or larger ones a user brings) as DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# ISO 8583 message type indicators.
MESSAGE_TYPES = {
    "1100": "Authorization Request",
    "1101": "Authorization Request Repeat",
    "1110": "Authorization Request Response",
    "1120": "Authorization Advice",
    "1121": "Authorization Advice Repeat",
    "1130": "Authorization Advice Response",
    "1200": "Financial Request",
    "1201": "Financial Request Repeat",
    "1210": "Financial Request Response",
    "1220": "Financial Advice",
    "1221": "Financial Advice Repeat",
    "1230": "Financial Advice Response",
    "1420": "Reversal Advice",
    "1421": "Reversal Advice Repeat",
    "1430": "Reversal Advice Response",
}

# ISO 4217 numeric code, alphabetic code, name, minor units.
CURRENCIES = (
    ("008", "ALL", "Albanian Lek", 2),
    ("012", "DZD", "Algerian Dinar", 2),
    ("036", "AUD", "Australian Dollar", 2),
    ("124", "CAD", "Canadian Dollar", 2),
    ("156", "CNY", "Chinese Yuan", 2),
    ("344", "HKD", "Hong Kong Dollar", 2),
    ("356", "INR", "Indian Rupee", 2),
    ("392", "JPY", "Japanese Yen", 0),
    ("410", "KRW", "South Korean Won", 0),
    ("504", "MAD", "Moroccan Dirham", 2),
    ("643", "RUB", "Russian Ruble", 2),
    ("682", "SAR", "Saudi Riyal", 2),
    ("702", "SGD", "Singapore Dollar", 2),
    ("710", "ZAR", "South African Rand", 2),
    ("752", "SEK", "Swedish Krona", 2),
    ("756", "CHF", "Swiss Franc", 2),
    ("784", "AED", "UAE Dirham", 2),
    ("788", "TND", "Tunisian Dinar", 3),
    ("826", "GBP", "Pound Sterling", 2),
    ("840", "USD", "US Dollar", 2),
    ("971", "AFN", "Afghan Afghani", 2),
    ("978", "EUR", "Euro", 2),
    ("986", "BRL", "Brazilian Real", 2),
)
DEFAULT_MINOR_UNITS = 2

# ISO 18245 merchant category codes.
MERCHANT_CATEGORIES = {
    "3504": "Hilton International (Lodging)",
    "3681": "Conrad Hotels (Lodging)",
    "4816": "Computer Network/Information Services",
    "5411": "Grocery Stores, Supermarkets",
    "5541": "Service Stations (with or without Ancillary Services)",
    "5812": "Eating Places, Restaurants",
    "5912": "Drug Stores and Pharmacies",
    "5932": "Antique Shops",
    "5947": "Gift, Card, Novelty, and Souvenir Shops",
    "5971": "Art Dealers and Galleries",
    "5993": "Cigar Stores and Stands",
    "5999": "Miscellaneous and Specialty Retail Stores",
    "6010": "Manual Cash Disbursements - Financial Institutions",
    "6011": "Automated Cash Disbursements (ATM)",
    "6012": "Financial Institutions — Merchandise, Services",
    "6051": "Non-Financial Institutions — Foreign Currency, Money Orders",
    "7011": "Lodging — Hotels, Motels, Resorts",
    "7311": "Advertising Services",
    "8999": "Professional Services (Not Elsewhere Classified)",
}

CURRENCY_CODES = tuple(code for code, *_ in CURRENCIES)


def _constant_map(pairs) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs for x in pair))


def _lookup(pairs, code: Column) -> Column:
    return F.try_element_at(_constant_map(pairs), code)


def is_known_mti(code: Column) -> Column:
    return code.isin(*MESSAGE_TYPES)


def mti_name(code: Column) -> Column:
    return _lookup(MESSAGE_TYPES.items(), code)


def is_known_currency(code: Column) -> Column:
    return code.isin(*CURRENCY_CODES)


def currency_alpha(code: Column) -> Column:
    return _lookup(((c, alpha) for c, alpha, _, _ in CURRENCIES), code)


def currency_minor_units(code: Column) -> Column:
    units = _lookup(((c, minor) for c, _, _, minor in CURRENCIES), code)
    return F.coalesce(units, F.lit(DEFAULT_MINOR_UNITS))


def mcc_description(code: Column) -> Column:
    return _lookup(MERCHANT_CATEGORIES.items(), code)


def mti_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MESSAGE_TYPES.items()), "mti string, name string")


def currency_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(CURRENCIES), "code string, alpha string, name string, minor_units int"
    )


def mcc_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MERCHANT_CATEGORIES.items()), "mcc string, description string")
