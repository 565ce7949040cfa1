"""What identifies a bar: symbol, interval, instant, archive and slot, from fields that are spelled in many ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.intervals import ms_of, nearest_slot

#: White space of any kind, hyphens and slashes. The same pattern works in Java and in RE2.
NOISE = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\p{Z}\x{200b}-\x{200d}\x{2060}\x{feff}\x{2010}\x{2011}/-]"
#: The same without hyphens and slashes.
BLANK = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\p{Z}\x{200b}-\x{200d}\x{2060}\x{feff}]"

# The same characters one by one, for functions that are much faster than patterns.
_BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]))
_NOISES = _BLANKS + "/-\u2010\u2011"

ID_COLUMNS = ["_symbol", "_interval", "_instant", "_archive"]


def canonical_symbol(c: Column) -> Column:
    """Upper case without NOISE; null when nothing is left. An underscore counts."""
    x = F.translate(F.upper(c), _NOISES, "")
    return F.when(x != "", x)


def trimmed(c: Column) -> Column:
    """Without outer white space of any kind."""
    return F.btrim(c, F.lit(_BLANKS))


def unit_factor(t: Column, to_ms: Column) -> Column:
    """to_ms brought to milliseconds by the unit that the magnitude of the epoch value t shows: below 10^11 seconds, below 10^14 milliseconds, below 10^17 microseconds, else nanoseconds. Rounds down."""
    within = lambda n: (t > -n) & (t < n)
    down = lambda n: F.call_function("div", to_ms - F.pmod(to_ms, F.lit(n)), F.lit(n))
    return F.when(within(10**11), F.try_multiply(to_ms, F.lit(1000))).when(within(10**14), to_ms).when(within(10**17), down(1000)).when(t.isNotNull(), down(1_000_000))


def canonical_archive(archive: Column, channel: Column) -> Column:
    """The file name without directories and anything after .zip, or the live channel; without letter case and outer white space. A null or blank archive falls back on the channel."""
    x = F.lower(trimmed(archive))
    # A path with slashes whose only .zip is its end needs no pattern; the others are few.
    plain = (F.instr(x, ".zip") > 0) & (F.instr(x, ".zip") == F.length(x) - 3) & (F.instr(x, "\\") == 0)
    zipped = F.when(plain, F.substring_index(x, "/", -1)).when(F.instr(x, ".zip") > 0, F.regexp_extract(x, r"([^/\\]*?\.zip)", 1)).otherwise("")
    x = F.when(zipped != "", zipped).when(x != "", x)
    return F.coalesce(x, F.when(trimmed(channel) != "", F.lower(trimmed(channel))))


def with_identity(bars: DataFrame, slots: bool = True) -> DataFrame:
    """Adds _symbol, _interval, _instant, _archive and, if asked, _ms and _slot.

    symbol comes from record_key where the row's own is null or blank. A row has no identity, and a null in _symbol or _instant, when neither has a symbol or open_time is null; such rows are kept for the caller to decide. Columns of the input that clash with these names are replaced."""
    sym = canonical_symbol(F.col("symbol"))
    if "record_key" in bars.columns:
        sym = F.coalesce(sym, canonical_symbol(F.col("record_key.symbol")))
    cols = {
        "_symbol": sym,
        "_interval": F.col("interval"),
        "_instant": unit_factor(F.col("open_time"), F.col("open_time")),
        "_archive": canonical_archive(F.col("source_archive"), F.col("archive_source")),
    }
    out = bars.withColumns(cols)
    if slots:
        out = out.withColumn("_ms", ms_of(F.col("_interval"))).withColumn("_slot", nearest_slot(F.col("_instant"), F.col("_ms")))
    return out


def number(c: Column) -> Column:
    """A double with NaN as null."""
    return F.when(~F.isnan(c), c)


# The same in DuckDB's SQL, for the oracles.
SQL_SYMBOL = f"coalesce(nullif(regexp_replace(upper(symbol), '{NOISE}', '', 'g'), ''), nullif(regexp_replace(upper(record_key.symbol), '{NOISE}', '', 'g'), ''))"
SQL_INSTANT = "case when abs(open_time) < 100000000000 then open_time * 1000 when abs(open_time) < 100000000000000 then open_time when abs(open_time) < 100000000000000000 then open_time // 1000 else open_time // 1000000 end"
SQL_TRIMMED = f"regexp_replace(source_archive, '^{BLANK}+|{BLANK}+$', '', 'g')"
SQL_ARCHIVE = rf"coalesce(nullif(regexp_extract(lower({SQL_TRIMMED}), '([^/\\]*?\.zip)', 1), ''), nullif(lower({SQL_TRIMMED}), ''), lower(trim(archive_source)))"
SQL_MS = "case interval when '1d' then 86400000 when '4h' then 14400000 when '1h' then 3600000 when '15m' then 900000 when '5m' then 300000 when '3m' then 180000 when '1m' then 60000 end"
#: Rows of klines with an identity: sym, ivl, inst, arc, ms, slot beside all columns.
SQL_KEYED = f"""keyed0 AS (SELECT *, {SQL_SYMBOL} AS sym, interval AS ivl, {SQL_INSTANT} AS inst, {SQL_ARCHIVE} AS arc, CAST({SQL_MS} AS BIGINT) AS ms FROM klines),
keyed AS (SELECT *, ((inst + ms // 2) // ms) * ms AS slot FROM keyed0 WHERE sym IS NOT NULL AND inst IS NOT NULL AND ms IS NOT NULL)"""
