from nightledger.functions.scalar import (  # noqa: F401
    blank_to_null, closing_time, decimal_comma, fio, parse_ddmmyyyy, parse_dt, strip_blanks,
    ts_lit, within,
)
