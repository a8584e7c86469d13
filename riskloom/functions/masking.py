"""Masking and row policies as column builders; the caller's rights come in as a context."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import _c

MASK_TEXT = "***MASKED***"

# Allowed tag values.
SENSITIVITY = ("PUBLIC", "INTERNAL", "PII", "RESTRICTED")
DATA_DOMAIN = ("MEMBER", "TRANSACTION", "ALERT", "INSTITUTION")
ALLOWED_TAGS = {"sensitivity": SENSITIVITY, "data_domain": DATA_DOMAIN}

# The member columns that carry personal data.
MEMBER_PII = ("ssn_hash", "email", "phone_normalized", "date_of_birth")


@dataclass(frozen=True)
class Access:
    """Who is asking: a role, and the regions the session may see (comma list, ``None`` when unset)."""

    role: str
    allowed_regions: str | None = None
    privileged: tuple[str, ...] = field(default=("ADMIN", "COMPLIANCE"))

    @property
    def is_privileged(self) -> bool:
        return self.role in self.privileged


def mask_pii(c, ctx: Access) -> Column:
    return _c(c) if ctx.is_privileged else F.lit(MASK_TEXT)


def mask_email(c, ctx: Access) -> Column:
    """Keep the first character and the domain."""
    return _c(c) if ctx.is_privileged else F.regexp_replace(_c(c), "(.)[^@]*(@.*)", "$1***$2")


def row_policy(df: DataFrame, region_col: str, ctx: Access, default_regions: str | None = "ALL") -> DataFrame:
    """Rows of the allowed regions. Without a region list ``default_regions`` applies; pass ``None`` to fail closed."""
    if ctx.is_privileged:
        return df
    regions = ctx.allowed_regions if ctx.allowed_regions is not None else default_regions
    allowed = F.split(F.lit(regions), ",")
    return df.where(F.array_contains(allowed, F.lit("ALL")) | F.array_contains(allowed, F.col(region_col)))


def tag_columns(df: DataFrame, tags: dict[str, dict[str, str]]) -> DataFrame:
    """Attach ``{column: {tag: value}}`` as column metadata after checking the allowed values."""
    for column, pairs in tags.items():
        if column not in df.columns:
            raise ValueError(f"no column {column}")
        for tag, value in pairs.items():
            if tag not in ALLOWED_TAGS or value not in ALLOWED_TAGS[tag]:
                raise ValueError(f"tag {tag}={value} on {column} is not allowed")
        df = df.withMetadata(column, {**df.schema[column].metadata, **pairs})
    return df


def tagged(df: DataFrame, tag: str, value: str) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get(tag) == value]


def apply_masks(df: DataFrame, ctx: Access, columns: Iterable[str] | None = None) -> DataFrame:
    """Mask every column tagged as personal data. A masked column becomes text, as its mask is text."""
    hide = list(columns) if columns is not None else tagged(df, "sensitivity", "PII")
    if ctx.is_privileged:
        return df
    return df.withColumns({c: mask_pii(c, ctx) for c in hide})
