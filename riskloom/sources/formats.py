"""Landing-file formats and the column contracts of the load targets.

The names, positions and tokens below are fixed values of the file interface.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Delimited:
    """A delimited text format: separator, NULL tokens, time patterns."""

    sep: str
    nulls: tuple[str, ...]
    header: bool = True
    quote: str = '"'
    date_pattern: str = "yyyy-MM-dd"
    time_pattern: str = "yyyy-MM-dd HH:mm:ss.SSS Z"


# Separators and NULL tokens.
PIPE = Delimited(sep="|", nulls=("", "NULL", "null", "\\N"))
MAINFRAME_CSV = Delimited(sep=",", nulls=("", "NULL", "SPACES", "0000000000"))


@dataclass(frozen=True)
class Field:
    """One target column. ``strict`` columns reject the row when the text does not convert."""

    name: str
    kind: str = "string"
    required: bool = False
    strict: bool = True
    max_len: int | None = None
    pattern: str | None = None
    """What the whole text must match."""


@dataclass(frozen=True)
class Contract:
    """Typed columns of a load target in file order, plus defaults for columns the file does not carry."""

    table: str
    fields: tuple[Field, ...]
    defaults: dict[str, tuple[str, str]] = field(default_factory=dict)
    time_pattern: str = "yyyy-MM-dd HH:mm:ss.SSS Z"

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def _text(columns: str) -> tuple[Field, ...]:
    """Text columns, each with its longest length."""
    pairs = (c.split(":") for c in columns.split())
    return tuple(Field(name, max_len=int(size)) for name, size in pairs)


SHA256 = "[0-9a-fA-F]{64}"

# Columns of the load targets and the longest text that each takes.
TRANSACTIONS = Contract("BRONZE.RAW_TRANSACTIONS", (
    Field("txn_id", required=True, max_len=50), Field("member_id", required=True, max_len=20),
    Field("institution_id", required=True, max_len=20),
    Field("txn_timestamp", "timestamp", required=True), Field("amount", "decimal(15,2)", required=True),
    *_text("currency_code:3 txn_type:20 channel:20 merchant_category:50 merchant_name:200 merchant_country:3 status:20 "
           "auth_code:20 card_last_four:4 ip_address:45 device_fingerprint:100"),
    Field("risk_score", "decimal(5,2)", strict=False)),
    defaults={"currency_code": ("string", "USD")})

MEMBERS = Contract("BRONZE.RAW_MEMBERS", (
    Field("member_id", required=True, max_len=20), Field("institution_id", required=True, max_len=20),
    *_text("first_name:100 last_name:100"), Field("date_of_birth", "date", strict=False),
    Field("ssn_hash", max_len=64, pattern=SHA256),
    *_text("email:200 phone:20 address_line1:200 city:100 state_code:2 zip_code:10 country_code:3"),
    Field("member_since", "date", strict=False), *_text("status:20 risk_tier:10")),
    defaults={"country_code": ("string", "US"), "address_line2": ("string", None),
              "kyc_verified": ("boolean", "false"), "last_activity_date": ("date", None)})

ALERTS = Contract("BRONZE.RAW_ALERTS", (
    Field("alert_id", required=True, max_len=50), Field("member_id", required=True, max_len=20),
    Field("institution_id", required=True, max_len=20), Field("alert_timestamp", "timestamp", required=True),
    *_text("alert_type:50 severity:10 alert_source:50 description:1000 related_txn_id:50 rule_id:50"),
    Field("confidence_score", "decimal(5,4)", strict=False), *_text("status:20 assigned_to:100")),
    defaults={"resolution_notes": ("string", None), "resolved_at": ("timestamp_ntz", None)})

INSTITUTIONS = Contract("BRONZE.RAW_INSTITUTIONS", (
    Field("institution_id", required=True, max_len=20), Field("institution_name", required=True, max_len=200),
    *_text("institution_type:50 routing_number:9 charter_type:20 regulatory_body:50 state_code:2 region:20 asset_size_tier:20"),
    Field("network_since", "date", strict=False), *_text("status:20")))

# Name, first position, length of the fixed-width member record (539 characters).
MEMBER_LAYOUT = (
    ("member_id", 1, 20), ("institution_id", 21, 20), ("first_name", 41, 50), ("last_name", 91, 50),
    ("date_of_birth", 141, 10), ("ssn_hash", 151, 64), ("email", 215, 100), ("phone", 315, 20),
    ("address_line1", 335, 100), ("city", 435, 50), ("state_code", 485, 2), ("zip_code", 487, 10),
    ("country_code", 497, 3), ("member_since", 500, 10), ("status", 510, 20), ("risk_tier", 530, 10),
)

# Keys of a delivered event, their types, and those that every event must have.
REQUIRED_EVENT_KEYS = ("event_id", "event_time", "event_type", "member_id")
EVENT_FIELDS = (
    ("event_id", "string"), ("event_time", "timestamp"), ("event_type", "string"), ("member_id", "string"),
    ("institution_id", "string"), ("amount", "decimal(15,2)"), ("channel", "string"), ("device_id", "string"),
    ("ip_address", "string"), ("geo_lat", "decimal(10,7)"), ("geo_lon", "decimal(10,7)"),
    ("risk_score", "decimal(5,2)"),
)
