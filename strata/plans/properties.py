"""Property cleaning job (L21): the reference's statement-by-statement cleanup,
composed as one DataFrame pipeline.  Order matters and is kept: the dedupe
keys use the *filled* address and the *unconverted* sale date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import part_from_right, split_first
from strata.operators.cleaning import fill_from_group, recode
from strata.operators.windows import keep_first, row_number_by
from strata.sources.sinks import materialise

# Vacancy flag recode: fixed values.
VACANT_LABELS = {"Y": "Yes", "N": "No"}
DEDUPE_KEYS = ["ParcelID", "PropertyAddress", "SalePrice", "SaleDate", "LegalReference"]
DROPPED = ["OwnerAddress", "TaxDistrict", "PropertyAddress", "SaleDate"]


def convert_date(df: DataFrame) -> DataFrame:
    return df.withColumn("SaleDateConverted", F.to_date("SaleDate"))


def fill_addresses(df: DataFrame) -> DataFrame:
    """Missing property address from another sale of the same parcel."""
    return fill_from_group(df, ["ParcelID"], "PropertyAddress")


def split_addresses(df: DataFrame) -> DataFrame:
    street, city = split_first("PropertyAddress", ",")
    return df.withColumns({
        "PropertySplitAddress": street,
        "PropertySplitCity": city,
        "OwnerSplitAddress": part_from_right("OwnerAddress", 3),
        "OwnerSplitCity": part_from_right("OwnerAddress", 2),
        "OwnerSplitState": part_from_right("OwnerAddress", 1),
    })


def recode_vacant(df: DataFrame) -> DataFrame:
    return df.withColumn("SoldAsVacant", recode("SoldAsVacant", VACANT_LABELS, default="SoldAsVacant", any_case=True))


def duplicates(df: DataFrame) -> DataFrame:
    """The rows a dedupe removes, with their row number (> 1) in the group."""
    return row_number_by(df, DEDUPE_KEYS, ["UniqueID"], name="RowNum").filter(F.col("RowNum") > 1)


def dedupe(df: DataFrame) -> DataFrame:
    """Keep one row of each duplicate group, the lowest UniqueID (NULL first)."""
    return keep_first(df, DEDUPE_KEYS, "UniqueID")


def clean_properties(df: DataFrame) -> DataFrame:
    out = convert_date(df)
    # The filled table feeds the dedupe's grouped minimum and its semi join:
    # written once instead of re-running the fill (and its source) for each.
    out = materialise(fill_addresses(out), "filled_properties")
    out = split_addresses(out)
    out = recode_vacant(out)
    out = dedupe(out)
    return out.drop(*DROPPED)
