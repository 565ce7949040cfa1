"""The queries of the problems in this package over the project's tables, and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.identity import SQL_KEYED, with_identity
from barloom.llm.fusion import fuse
from barloom.llm.mixing import mix, shares
from barloom.llm.packing import pack
from barloom.llm.splitting import split_long
from barloom.llm.tokens import canonical_source, capacity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- 3


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = with_identity(_table(spark, sf_dir, "klines").select("row_id", "record_key", "symbol", "interval", "open_time", "source_archive", "archive_source", "close", "volume"))
    kind = F.when(F.col("_archive").endswith(".zip"), F.when(F.col("_archive").rlike(r"-\d{4}-\d{2}\.zip$"), "monthly").otherwise("daily")).otherwise(F.split_part("_archive", F.lit(":"), F.lit(1)))
    rows = bars.where("_symbol is not null and _slot is not null").select(F.struct(F.col("_symbol").alias("symbol"), F.col("_interval").alias("interval"), F.col("_slot").alias("open_time")).alias("item"), F.col("_archive").alias("copy"), kind.alias("source"), F.col("row_id").alias("order"), "close", "volume")
    return fuse(rows, ["close", "volume"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars whose copies disagree on close or volume."""
    return _fused(spark, sf_dir).where("close_conflict or volume_conflict").select("item.symbol", "item.interval", "item.open_time")


def p3_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving bar of each group of copies."""
    return _fused(spark, sf_dir).select("item.symbol", "item.interval", "item.open_time", "n_copies", "close", "close_source", "close_belief", "volume", "volume_source", "volume_belief")


P3_FOUND_SQL = f"""WITH {SQL_KEYED},
v AS (SELECT sym, ivl, slot, coalesce(arc, '?') AS arc, CASE WHEN NOT isnan(close) THEN close END AS c, CASE WHEN NOT isnan(volume) THEN volume END AS v FROM keyed),
g AS (SELECT sym, ivl, slot, count(DISTINCT arc) AS n, count(*) AS rows, count(c) AS nc, count(v) AS nv, min(c) AS lc, max(c) AS hc, min(v) AS lv, max(v) AS hv FROM v GROUP BY ALL)
SELECT sym AS symbol, ivl AS interval, slot AS open_time FROM g WHERE n >= 2 AND ((nc > 0 AND nc < rows) OR (nv > 0 AND nv < rows) OR coalesce(hc - lc > 1e-6 * greatest(abs(hc), abs(lc)), false) OR coalesce(hv - lv > 1e-6 * greatest(abs(hv), abs(lv)), false))"""


# -- 7


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its container of the standard profile."""
    limit, _ = capacity(_table(spark, sf_dir, "size_limits"), "standard")
    return pack(_table(spark, sf_dir, "documents"), limit)


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The containers with their content in tokens and the space left."""
    limit, _ = capacity(_table(spark, sf_dir, "size_limits"), "standard")
    packed = pack(_table(spark, sf_dir, "documents"), limit)
    return packed.groupBy("container").agg(F.count(F.lit(1)).alias("items"), F.sum("n_tokens").alias("n_tokens"), (F.lit(limit) - F.sum("n_tokens")).alias("unused"))


def p7_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many characters of each text lie in containers: all of them, each once."""
    limit, _ = capacity(_table(spark, sf_dir, "size_limits"), "standard")
    return pack(_table(spark, sf_dir, "documents"), limit).groupBy("doc_id").agg(F.sum(F.col("end_char") - F.col("start_char")).alias("chars"))


def p7_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many containers hold more than their capacity: none."""
    return p7_containers(spark, sf_dir).agg(F.count(F.when(F.col("unused") < 0, 1)).alias("over_capacity"))


P7_WHOLE_SQL = "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents WHERE text <> ''"
P7_WITHIN_SQL = "SELECT CAST(0 AS BIGINT) AS over_capacity"


# -- 8


def p8_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts drawn, with their copies."""
    return mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached."""
    targets = _table(spark, sf_dir, "mix_targets")
    draw, there = mix(_table(spark, sf_dir, "documents"), targets)
    return shares(draw, there, targets)


def p8_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target sources that have texts, and whether none of their texts is drawn more often than allowed."""
    targets = _table(spark, sf_dir, "mix_targets")
    caps = targets.groupBy(canonical_source(F.col("source")).alias("source")).agg(F.max("max_repeats").alias("cap"))
    got = p8_shares(spark, sf_dir).where("tokens_there > 0").join(F.broadcast(caps), "source")  # at most a row a target source
    return got.select("source", (F.col("most_copies") <= F.col("cap")).alias("within_cap"))


_SQL_SOURCE = "regexp_replace(lower(trim(regexp_replace(source, '[\\s\\p{Z}]+', ' ', 'g'))), '[ -]', '_', 'g')"
P8_CAPS_SQL = f"SELECT DISTINCT {_SQL_SOURCE} AS source, true AS within_cap FROM mix_targets WHERE {_SQL_SOURCE} IN (SELECT {_SQL_SOURCE} FROM documents WHERE text <> '')"


# -- 9


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit, overlap = capacity(_table(spark, sf_dir, "size_limits"), "standard")
    return split_long(_table(spark, sf_dir, "documents"), limit, overlap)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that had to be cut."""
    return _pieces(spark, sf_dir).where("piece_no = 0").select("doc_id")


def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of those texts."""
    return _pieces(spark, sf_dir)


def p9_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The characters of each text that its pieces cover without their overlaps, the places where a piece doesn't go on where the one before ended, and the pieces beyond the limit; texts within it are one piece."""
    limit, overlap = capacity(_table(spark, sf_dir, "size_limits"), "standard")
    cut = split_long(_table(spark, sf_dir, "documents"), limit, overlap, keep_short=True, with_text=False)
    goes_on = F.coalesce(F.lag("end_char").over(Window.partitionBy("doc_id").orderBy("piece_no")), F.lit(0)) == F.col("core_char")
    each = cut.withColumn("breaks", F.when(goes_on, 0).otherwise(1))
    return each.groupBy("doc_id").agg(F.sum(F.col("end_char") - F.col("core_char")).alias("chars"), F.sum("breaks").alias("breaks"), F.count(F.when(F.col("n_tokens") > limit, 1)).alias("over_limit"))


P9_WHOLE_SQL = "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, CAST(0 AS BIGINT) AS breaks, CAST(0 AS BIGINT) AS over_limit FROM documents WHERE text <> ''"

QUERIES = {"p3_found": p3_found, "p3_fused": p3_fused, "p7_packed": p7_packed, "p7_containers": p7_containers, "p7_whole": p7_whole, "p7_within": p7_within, "p8_draw": p8_draw, "p8_shares": p8_shares, "p8_caps": p8_caps, "p9_found": p9_found, "p9_pieces": p9_pieces, "p9_whole": p9_whole}
SQL = {"p3_found": P3_FOUND_SQL, "p7_whole": P7_WHOLE_SQL, "p7_within": P7_WITHIN_SQL, "p8_caps": P8_CAPS_SQL, "p9_whole": P9_WHOLE_SQL}
