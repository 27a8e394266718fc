"""Who holds a card: cards -> accounts -> clients."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions.scalar import fio, ts_lit


def holders(accounts: DataFrame, clients: DataFrame, with_valid_to: bool = False,
            expired_before: _dt.datetime | None = None, passports: DataFrame | None = None) -> DataFrame:
    """DISTINCT (passport, client, phone, account[, valid_to], fio) over all versions.

    Spark places the exchanges, so adaptive execution can split a skewed account.
    """
    cli = clients
    if expired_before is not None:
        # early filter: reaches the clients scan below the join and the DISTINCT
        cli = cli.where(F.col("passport_valid_to") < ts_lit(expired_before))
    if passports is not None:
        # only these holders matter: the filter goes below the join and the DISTINCT
        cli = cli.join(passports.select("passport_num").distinct(), "passport_num", "left_semi")
    acc = accounts.select("account_num", "client", *(["valid_to"] if with_valid_to else []))
    cli = cli.select("client_id", "passport_num", "phone",
                     fio("last_name", "first_name", "patronymic").alias("fio"))
    cols = ["passport_num", "client_id", "phone", "account_num", "fio"] + \
        (["valid_to"] if with_valid_to else [])
    return (acc.join(cli, acc["client"] == cli["client_id"])
               .select(*cols)
               .distinct())


def party_info(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
               with_valid_to: bool = False,
               expired_before: _dt.datetime | None = None, passports: DataFrame | None = None) -> DataFrame:
    """card_num -> (account_num, client_id, passport_num, phone, fio[, valid_to]).

    Every history version takes part (no validity filter), exactly like the
    report's source queries; a card with k holder versions yields k rows.
    """
    h = holders(accounts, clients, with_valid_to, expired_before, passports)
    c = cards.select("card_num", "account_num")
    cols = ["card_num", "account_num", "client_id", "passport_num", "phone", "fio"] + \
        (["valid_to"] if with_valid_to else [])
    return c.join(h, "account_num").select(*cols)
