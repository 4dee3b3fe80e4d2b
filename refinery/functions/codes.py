"""Standard labels for free-form codes."""

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label of each code.
UNKNOWN = "n/a"
MARITAL_STATUS = {"S": "Single", "M": "Married"}
CRM_GENDER = {"F": "Female", "M": "Male"}
ERP_GENDER = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}


def label(code: Column, labels: Mapping[str, str]) -> Column:
    """The label of a code, NULL if it has none."""
    return F.create_map(*map(F.lit, chain.from_iterable(labels.items())))[code]


def standard_code(raw: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code whatever its case and outer spaces; ``n/a`` for NULL and for codes without a label."""
    return F.coalesce(label(F.upper(F.trim(raw)), labels), F.lit(UNKNOWN))


def standard_country(raw: Column) -> Column:
    """Country name of a code, else the trimmed text, else ``n/a``; codes are matched in upper case only."""
    text = F.trim(raw)
    return F.coalesce(label(text, COUNTRY), F.nullif(text, F.lit("")), F.lit(UNKNOWN))


def first_known(*sources: Column) -> Column:
    """The first source that is neither NULL nor ``n/a``; ``n/a`` if there is none."""
    return F.coalesce(*[F.nullif(source, F.lit(UNKNOWN)) for source in sources], F.lit(UNKNOWN))
