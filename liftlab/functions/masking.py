"""Masks for personal data, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a masked and an unmasked value look like.
EMAIL_LOCAL_PART = "^[^@]+"
EMAIL_MASK = "****"
ACCOUNT_MASK = "ACCT-****"
ACCOUNT_DIGITS_KEPT = 4
# A mask that stands for a whole local part; what is left is raw if it still looks like an address.
WHOLE_MASK = r"(^|[\s(<\[,;:\"'])\*{4}@"
RAW_PATTERNS = {
    # anywhere in a text; a masked account number has no five digits
    "email": r"[^@\s]@[^@\s]",
    "account_ref": "(?i)ACCT-[0-9]{5,}",
}


def looks_raw(col: Column, pattern: str) -> Column:
    """True for a value that shows personal data beside or instead of its mask."""
    return F.regexp_replace(col, WHOLE_MASK, "$1").rlike(pattern)


def mask_email(col: Column, privileged: bool = False) -> Column:
    return col if privileged else F.regexp_replace(col, EMAIL_LOCAL_PART, EMAIL_MASK)


def mask_account(col: Column, privileged: bool = False) -> Column:
    if privileged:
        return col
    return F.concat(F.lit(ACCOUNT_MASK), F.substring(col, -ACCOUNT_DIGITS_KEPT, ACCOUNT_DIGITS_KEPT))


MASKS = {"email": mask_email, "account_ref": mask_account}
