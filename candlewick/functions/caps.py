"""Market-cap text: `$3.0T`, `$800B`, `$45M` or plain digits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Cap in billions of dollars from which a company counts as large (tier 1) or mid (tier 2).
LARGE_CAP = 100
MID_CAP = 10

# Display names of the tiers.
TIER_NAMES = {1: "대형주", 2: "중형주", 3: "소형주"}


def cap_billions(cap: Column, plain_digits: bool = True) -> Column:
    """Cap in billions of dollars; 0 where the text cannot be read.

    `plain_digits=False` reads only the T, B and M forms, as the quote router does.
    """
    text = F.regexp_replace(cap, r"^\$", "")
    number = _double(F.substring(text, F.lit(1), F.length(text) - 1))
    value = (
        F.when(text.endswith("B"), number)
        .when(text.endswith("T"), number * 1000)
        .when(text.endswith("M"), number / 1000)
    )
    if plain_digits:
        value = value.when(text.rlike(r"^[0-9.,]*[0-9][0-9.,]*$"), _double(F.replace(text, F.lit(","))) / 1e9)
    return F.coalesce(value, F.lit(0.0))


def _double(text: Column) -> Column:
    return text.try_cast("double")


def tier_of(billions: Column) -> Column:
    return F.when(billions >= LARGE_CAP, 1).when(billions >= MID_CAP, 2).otherwise(3)


def cap_tier(cap: Column, mode: str = "parsed") -> Column:
    """Tier 1-3 of a cap text.

    `parsed` reads every form; `router` leaves plain digits unread (tier 3); `scanner` only deletes the
    characters `$`, `B` and `T` before the cast, so that `$3.0T` counts as 3.
    """
    if mode == "scanner":
        return tier_of(F.regexp_replace(cap, "[$BT]", "").try_cast("decimal(18,3)"))
    return tier_of(cap_billions(cap, plain_digits=mode == "parsed"))


def tier_name(tier: Column) -> Column:
    name = F.lit(None).cast("string")
    for number, label in sorted(TIER_NAMES.items(), reverse=True):
        name = F.when(tier == number, label).otherwise(name)
    return name
