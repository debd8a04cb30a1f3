"""Declared table schemas: types, keys, length limits, defaults and comments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _field(name, kind, nullable=True, comment="", limit=None, default=None):
    metadata = {"comment": comment}
    if limit is not None:
        metadata["limit"] = limit
    if default is not None:
        metadata["default"] = default
    return T.StructField(name, kind, nullable, metadata)


@dataclass(frozen=True)
class TableSpec:
    """What the source databases enforce and Spark only records."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    comment: str = ""

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def limits(self) -> dict[str, int]:
        return {f.name: f.metadata["limit"] for f in self.schema if "limit" in f.metadata}

    @property
    def defaults(self) -> dict[str, str]:
        return {f.name: f.metadata["default"] for f in self.schema if "default" in f.metadata}


MONEY = T.DecimalType(18, 2)
MONEY_TOTAL = T.DecimalType(28, 2)

COMPANIES = TableSpec(
    "dct_companies",
    T.StructType([
        _field("company_id", T.IntegerType(), False, "company key"),
        _field("company_name", T.StringType(), True, "short name", 100),
        _field("company_description", T.StringType(), True, "long name"),
        _field("company_inn", T.StringType(), True, "taxpayer number", 12),
        _field("company_kpp", T.StringType(), True, "registration reason code", 12),
        _field("parent_company_id", T.IntegerType(), True, "owning company"),
        _field("dttm_start", T.TimestampNTZType(), True, "valid from", None, "1900-01-01 00:00:00"),
        _field("dttm_end", T.TimestampNTZType(), True, "valid to", None, "3000-12-31 00:00:00"),
    ]),
    ("company_id",),
    "companies, one row per tenant",
)

ACCOUNTS = TableSpec(
    "dct_accounts",
    T.StructType([
        _field("account_id", T.StringType(), False, "account code", 20),
        _field("parent_account_id", T.StringType(), True, "code of the parent account", 20),
        _field("account_description", T.StringType(), True, "account title", 200),
    ]),
    ("account_id",),
    "chart of accounts",
)

FACT = TableSpec(
    "acc_data",
    T.StructType([
        _field("transaction_id", T.LongType(), False, "operation key"),
        _field("transaction_dt", T.DateType(), False, "operation date"),
        _field("company_id", T.IntegerType(), False, "tenant"),
        _field("company_id_src", T.IntegerType(), True, "company the money comes from"),
        _field("account_id", T.StringType(), False, "account", 20),
        _field("account_id_src", T.StringType(), True, "account the money comes from", 20),
        _field("operation_type", T.StringType(), True, "kind of operation", 20),
        _field("amount", MONEY, False, "amount"),
        _field("currency_code", T.StringType(), False, "currency", 3),
        _field("custom_1", T.StringType(), True, "analytic, level 1", 20),
        _field("custom_2", T.StringType(), True, "analytic, level 2", 20),
        _field("custom_3", T.StringType(), True, "analytic, level 3", 20),
        _field("custom_4", T.StringType(), True, "analytic, level 4", 20),
        _field("custom_5", T.StringType(), True, "analytic, level 5", 20),
    ]),
    ("company_id", "transaction_id", "transaction_dt"),
    "ledger operations",
)

ROLLUP = TableSpec(
    "acc_aggregate",
    T.StructType([
        _field("company_id", T.IntegerType(), False, "tenant"),
        _field("account_id", T.StringType(), False, "account", 20),
        _field("period_dt", T.DateType(), False, "first day of the month"),
        _field("amount", MONEY_TOTAL, False, "total of the month"),
        _field("currency_code", T.StringType(), False, "currency", 3),
    ]),
    ("company_id", "account_id", "period_dt", "currency_code"),
    "monthly totals per account",
)

MEASURES = (
    "avg_temp_c", "min_temp_c", "max_temp_c", "precipitation_mm", "snow_depth_mm",
    "avg_wind_dir_deg", "avg_wind_speed_kmh", "peak_wind_gust_kmh",
    "avg_sea_level_pres_hpa", "sunshine_total_min",
)

WEATHER = TableSpec(
    "weather",
    T.StructType(
        [
            _field("station_id", T.StringType(), True, "station", 50),
            _field("city_name", T.StringType(), True, "city", 250),
            _field("dt", T.TimestampNTZType(), True, "day of observation"),
            _field("season", T.StringType(), True, "season", 50),
        ]
        + [_field(m, T.DoubleType()) for m in MEASURES]
    ),
    ("city_name", "dt"),
    "daily observations",
)

# The target of the bulk load: an integer station, a time with a zone, single precision.
LOADED_WEATHER = TableSpec(
    "weather",
    T.StructType(
        [
            _field("station_id", T.IntegerType(), True, "station"),
            _field("city_name", T.StringType(), True, "city", 250),
            _field("dt", T.TimestampType(), True, "day of observation"),
            _field("season", T.StringType(), True, "season", 50),
        ]
        + [_field(m, T.FloatType()) for m in MEASURES]
    ),
    ("station_id", "dt"),
    "daily observations, distributed by station and day",
)
