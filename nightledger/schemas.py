"""Table contracts, fixed markers and control-table names."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampNTZType()
AMT = T.DecimalType(30, 2)

# Fixed values that must equal the reference's for equal results:
#   open-row marker for effective_to: 2999-12-31 00:00:00
#   watermark seed for every history table: 1899-01-01 00:00:00
#   deleted flag values: 'N' (live) and 'Y' (deleted)
#   report event types: '1' passport, '2' contract, '3' cities, '4' amount guessing
#   closing step: new effective_from minus one second
MAXD = _dt.datetime(2999, 12, 31, 0, 0, 0)
SEED_W = _dt.datetime(1899, 1, 1, 0, 0, 0)
LIVE, DELETED = "N", "Y"
ONE_SECOND = "INTERVAL 1 SECOND"

# control-table keys (dbname, tablename)
DB = "DWH"
TERMINALS_HIST = "DIM_TERMINALS_HIST"
ACCOUNTS_HIST = "DIM_ACCOUNTS_HIST"
CARDS_HIST = "DIM_CARDS_HIST"
CLIENTS_HIST = "DIM_CLIENTS_HIST"
HIST_TABLES = (ACCOUNTS_HIST, CARDS_HIST, CLIENTS_HIST, TERMINALS_HIST)


def _struct(spec: str) -> T.StructType:
    """'a S, b T, c D, d L' -> StructType (S string, T timestamp_ntz, D decimal(30,2), L bigint)."""
    kinds = {"S": S, "T": TS, "D": AMT, "L": T.LongType()}
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, kinds[kind], True))
    return T.StructType(fields)


SCD = "effective_from T, effective_to T, deleted_flg S"

# staging (landing) tables; files are all-text
STG_TRANSACTIONS = _struct(
    "trans_id S, trans_date S, amt S, card_num S, oper_type S, oper_result S, terminal S")
STG_TERMINALS = _struct("terminal_id S, terminal_type S, terminal_city S, terminal_address S")
STG_BLACKLIST = _struct("report_dt S, passport_num S")
STG_ACCOUNTS = _struct("account_num S, valid_to T, client S, create_dt T, update_dt T")
STG_CARDS = _struct("card_num S, account S, create_dt T, update_dt T")
STG_CLIENTS = _struct(
    "client_id S, last_name S, first_name S, patronymic S, date_of_birth T, passport_num S, "
    "passport_valid_to T, phone S, create_dt T, update_dt T")
STG_DEL = _struct("id S")

# source (operational) tables, as the bank exposes them
SRC_ACCOUNTS = _struct("account S, valid_to T, client S, create_dt T, update_dt T")
SRC_CARDS = STG_CARDS
SRC_CLIENTS = STG_CLIENTS

# warehouse
DIM_ACCOUNTS_HIST = _struct(f"account_num S, valid_to T, client S, {SCD}")
DIM_CARDS_HIST = _struct(f"card_num S, account_num S, {SCD}")
DIM_CLIENTS_HIST = _struct(
    "client_id S, last_name S, first_name S, patronymic S, date_of_birth T, passport_num S, "
    f"passport_valid_to T, phone S, {SCD}")
DIM_TERMINALS_HIST = _struct(
    f"terminal_id S, terminal_type S, terminal_city S, terminal_address S, {SCD}")
FACT_BLACKLIST = _struct("passport_num S, entry_dt T")
FACT_TRANSACTIONS = _struct(
    "trans_id S, trans_date T, card_num S, oper_type S, amt D, oper_result S, terminal S")
REP_FRAUD = _struct("event_dt T, passport S, fio S, phone S, event_type S, report_dt T")
META_LOADING = _struct("dbname S, tablename S, last_update T")
REJECTS = _struct("source S, id S, line S, reason S")
RUN_COUNTS = _struct("source S, rows_read L, rows_loaded L, rows_malformed L, rows_unreadable L")
EXPORT_FILES = _struct("business_date T, kind S, file S, bytes L, lines L, digest S")

# business keys and tracked attributes of each history dimension
DIMENSIONS = {
    "terminals": dict(key="terminal_id", schema=DIM_TERMINALS_HIST, meta=TERMINALS_HIST),
    "accounts": dict(key="account_num", schema=DIM_ACCOUNTS_HIST, meta=ACCOUNTS_HIST),
    "cards": dict(key="card_num", schema=DIM_CARDS_HIST, meta=CARDS_HIST),
    "clients": dict(key="client_id", schema=DIM_CLIENTS_HIST, meta=CLIENTS_HIST),
}


def attributes(schema: T.StructType) -> list[str]:
    """History columns that describe the entity (everything but the SCD triple)."""
    scd = {"effective_from", "effective_to", "deleted_flg"}
    return [f.name for f in schema.fields if f.name not in scd]
