"""Small column expressions shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_get(m: Column | str, key: str, default: str) -> Column:
    """Map lookup with a default (a missing key yields null, even under ANSI)."""
    m = F.col(m) if isinstance(m, str) else m
    return F.coalesce(F.element_at(m, F.lit(key)), F.lit(default))


def edge_attr_map(my_champ="src_champ", his_champ="dst_champ", side="side") -> Column:
    """Edge attributes as the string map of the graph job."""
    return F.create_map(F.lit("myChampion"), F.col(my_champ), F.lit("hisChampion"), F.col(his_champ),
                        F.lit("Side"), F.col(side))


def edge_csv_line(src="my_id", dst="his_id", src_champ="my_champion", dst_champ="his_champion",
                  win="win", side="competition") -> Column:
    """``src,dst,srcChamp,dstChamp,win,side`` text of an un-oriented edge."""
    return F.concat_ws(",", F.col(src).cast("string"), F.col(dst).cast("string"), F.col(src_champ),
                       F.col(dst_champ), F.col(win).cast("string"), F.col(side))


def url_escape_blanks(name: Column | str) -> Column:
    """The account lookup escapes only blanks."""
    col = F.col(name) if isinstance(name, str) else name
    return F.replace(col, F.lit(" "), F.lit("%20"))


MICROS_PER_DAY = 86_400_000_000


def ntz_to_epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, read as UTC.

    Built from the wall-clock fields with an explicit UTC zone, so the result
    does not depend on the session time zone (a plain cast to TIMESTAMP
    would go through it, and shift values near daylight-saving changes).
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    ltz = F.make_timestamp_ltz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                               F.date_part(F.lit("SECOND"), c), F.lit("UTC"))
    return F.unix_micros(ltz)


def epoch_micros_to_ntz(micros: Column | str) -> Column:
    """TIMESTAMP_NTZ whose UTC reading is ``micros``; session-zone free."""
    m = F.col(micros) if isinstance(micros, str) else micros
    days = F.floor(m / MICROS_PER_DAY)
    tod = m - days * MICROS_PER_DAY
    d = F.date_from_unix_date(days.cast("int"))
    secs = ((tod % 60_000_000) / F.lit(1_000_000)).cast("decimal(8,6)")
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                F.floor(tod / 3_600_000_000).cast("int"),
                                F.floor((tod % 3_600_000_000) / 60_000_000).cast("int"), secs)


def ntz_as_instant(ts: Column | str) -> Column:
    """TIMESTAMP (instant) for a TIMESTAMP_NTZ read as UTC (for watermarks)."""
    return F.timestamp_micros(ntz_to_epoch_micros(ts))
