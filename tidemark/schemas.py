"""Declared shapes of the four entities: names, casts, keys and required columns."""

from __future__ import annotations

from dataclasses import dataclass

LONG = "bigint"
NUMERIC = "decimal(38,9)"
#: placeholder for the timestamp flavour, chosen when an entity is staged
TIMESTAMP = "<timestamp>"


@dataclass(frozen=True)
class Column:
    """One staged column: the raw name, the staged name and the cast (``None`` keeps the type)."""

    raw: str
    staged: str
    cast: str | None = None


@dataclass(frozen=True)
class Entity:
    """A change-log table: its key and its business columns."""

    name: str
    key: str
    business: tuple[Column, ...]

    @property
    def columns(self) -> tuple[Column, ...]:
        return self.business + CHANGE_COLUMNS

    @property
    def required(self) -> tuple[str, ...]:
        """Raw columns a source must deliver."""
        return tuple(c.raw for c in self.business) + CONTRACT_VERSION_COLUMNS

    @property
    def current(self) -> tuple[str, ...]:
        """Staged columns kept once a key is reduced to its latest version."""
        return tuple(c.staged for c in self.business)


# Column names and formats of the change log, as delivered by the connector.
UPDATED_AT = "_ab_cdc_updated_at"
DELETED_AT = "_ab_cdc_deleted_at"
LSN = "_ab_cdc_lsn"
EXTRACTED_AT = "_airbyte_extracted_at"
RAW_ID = "_airbyte_raw_id"

CHANGE_COLUMNS = (
    Column(LSN, LSN, NUMERIC),
    Column(DELETED_AT, DELETED_AT),
    Column(UPDATED_AT, UPDATED_AT),
    Column(RAW_ID, RAW_ID),
    Column(EXTRACTED_AT, EXTRACTED_AT),
    Column("_airbyte_meta", "_airbyte_meta"),
    Column("_airbyte_generation_id", "_airbyte_generation_id"),
)

CONTRACT_VERSION_COLUMNS = (UPDATED_AT, DELETED_AT, LSN)

METADATA_COLUMNS = (
    "_airbyte_raw_id",
    "_airbyte_extracted_at",
    "_airbyte_loaded_at",
    "_airbyte_meta",
    "_airbyte_additional_properties",
    "_airbyte_generation_id",
    "_airbyte_emitted_at",
    "_airbyte_ab_id",
    "_ab_cdc_updated_at",
    "_ab_cdc_deleted_at",
    "_ab_cdc_lsn",
)

# The entities.
USERS = Entity(
    "users",
    "user_id",
    (
        Column("user_id", "user_id", LONG),
        Column("email", "email"),
        Column("first_name", "first_name"),
        Column("last_name", "last_name"),
        Column("country", "country"),
        Column("marital_status", "marital_status"),
        Column("kyc_status", "kyc_status"),
        Column("created_at", "created_at", TIMESTAMP),
    ),
)

ACCOUNTS = Entity(
    "accounts",
    "account_id",
    (
        Column("account_id", "account_id", LONG),
        Column("user_id", "user_id", LONG),
        Column("balance", "balance", NUMERIC),
        Column("currency", "currency"),
    ),
)

TRANSACTIONS = Entity(
    "transactions",
    "transaction_id",
    (
        Column("transaction_id", "transaction_id", LONG),
        Column("from_account", "from_account_id", LONG),
        Column("to_account", "to_account_id", LONG),
        Column("amount", "amount", NUMERIC),
        Column("type", "transaction_type"),
        Column("status", "status"),
        Column("timestamp", "transaction_timestamp", TIMESTAMP),
    ),
)

AUDIT = Entity(
    "audit",
    "log_id",
    (
        Column("log_id", "log_id", LONG),
        Column("action", "action"),
        Column("performed_by", "performed_by"),
        Column("transaction_id", "transaction_id", LONG),
        Column("timestamp", "event_timestamp", TIMESTAMP),
    ),
)

ENTITIES = {e.name: e for e in (USERS, ACCOUNTS, TRANSACTIONS, AUDIT)}

#: table -> columns every delivery must have
CONTRACT = {name: entity.required for name, entity in ENTITIES.items()}

#: column order of the transaction fact
FCT_TRANSACTIONS_COLUMNS = (
    "transaction_id",
    "from_account_id",
    "to_account_id",
    "from_user_id",
    "to_user_id",
    "amount",
    "transaction_type",
    "status",
    "transaction_timestamp",
    "transaction_date",
    "last_updated_at",
    "ingested_at",
)

FCT_AUDIT_COLUMNS = (
    "log_id",
    "action",
    "performed_by",
    "transaction_id",
    "event_timestamp",
    "event_date",
    "last_updated_at",
    "ingested_at",
)
