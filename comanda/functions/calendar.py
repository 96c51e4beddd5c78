"""Calendar columns of a timestamp: parts, Spanish labels and the hour key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from comanda.constants import MONTH_NAMES, WEEKDAY_NAMES, WEEKEND_DAYS


def _label(names: tuple[str, ...], position: Column) -> Column:
    """``names[position]``, counting from 1; empty when there is no such name."""
    listed = F.array(*[F.lit(name) for name in names])
    return F.coalesce(F.get(listed, position - 1), F.lit(""))


def month_name(month: Column) -> Column:
    return _label(MONTH_NAMES, month)


def iso_weekday(date: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(date) + 1


def weekday_name(day: Column) -> Column:
    return _label(WEEKDAY_NAMES, day)


def date_hour_key(date: Column, hour: Column) -> Column:
    """YYYYMMDDhh as bigint; the year is widened first, so no year overflows."""
    return (
        F.year(date).cast("bigint") * 1000000
        + F.month(date) * 10000
        + F.dayofmonth(date) * 100
        + hour
    )


def hour_key(ts: Column) -> Column:
    return date_hour_key(ts, F.hour(ts))


def date_of_key(key: Column) -> Column:
    part = [F.floor(key / unit) for unit in (1000000, 10000, 100)]
    return F.make_date(
        part[0].cast("int"), (part[1] % 100).cast("int"), (part[2] % 100).cast("int")
    )


def hour_of_key(key: Column) -> Column:
    return (key % 100).cast("int")


def calendar_parts(date: Column, hour: Column) -> list[tuple[str, Column]]:
    """The columns of ``dim_tiempo`` by name, all functions of a date and an hour."""
    weekday = iso_weekday(date)
    return [
        ("tiempo_key", date_hour_key(date, hour)),
        ("fecha", date),
        ("anio", F.year(date)),
        ("trimestre", F.quarter(date)),
        ("mes", F.month(date)),
        ("nombre_mes", month_name(F.month(date))),
        ("semana", F.weekofyear(date)),
        ("dia", F.dayofmonth(date)),
        ("dia_semana", weekday),
        ("nombre_dia", weekday_name(weekday)),
        ("hora", hour),
        ("es_fin_semana", weekday.isin(*WEEKEND_DAYS)),
    ]


def calendar_columns(date: Column, hour: Column) -> list[Column]:
    return [column.alias(name) for name, column in calendar_parts(date, hour)]
