"""Instrument metadata: normalising exchange snapshots, rules on the records, successor chains and the universe at a point in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.asknown import iso_millis

# The fields a record must have, and the words some may hold.
REQUIRED = ["instrument_id", "symbol", "exchange", "base_asset", "quote_asset", "market_type", "status", "listed_at"]
STATUSES = ["active", "delisted", "renamed", "merged"]
DERIVATIVES = ["futures", "perpetual", "option"]
CONTRACTS = {"futures": ["linear", "inverse"], "perpetual": ["linear", "inverse"], "option": ["call", "put"]}


def positive(c: Column) -> Column:
    """Whether a text is a number above zero; Infinity is. False for null or anything else."""
    x = F.lower(F.trim(c))
    return F.coalesce(x.rlike(r"^\+?inf(inity)?$") | (x.try_cast("decimal(38,18)") > 0), F.lit(False))


def _exploded(records: DataFrame, id_column: str, rule: str, cases: list[tuple[Column, str, str]]) -> DataFrame:
    """(id, rule_id, field, reason) of the cases that hold."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(f).alias("field"), F.lit(r).alias("reason"))) for cond, f, r in cases]))
    return records.select(F.col(id_column).alias("id"), F.lit(rule).alias("rule_id"), F.explode(hits).alias("x")).select("id", "rule_id", "x.field", "x.reason")


def record_rules(records: DataFrame, id_column: str, ingestion_time: Column | None = None) -> DataFrame:
    """(id, rule_id, field, reason): every failure of the rules that look at one record: required fields, the status invariants, times in order and not after the ingestion, contract fields and sizes. One row a failure."""
    c = F.col
    blank = lambda f: c(f).isNull() | (c(f) == "")
    q1 = _exploded(records, id_column, "UM-Q1", [(blank(f), f, "missing") for f in REQUIRED])
    active, moved = c("status").eqNullSafe(F.lit("active")), F.coalesce(c("status").isin("renamed", "merged"), F.lit(False))
    q3 = _exploded(records, id_column, "UM-Q3", [(~F.coalesce(c("status").isin(STATUSES), F.lit(False)), "status", "unknown status"), (active != c("delisted_at").isNull(), "delisted_at", "delisted_at must be null for active records only"), (moved != c("successor_id").isNotNull(), "successor_id", "successor_id belongs to renamed and merged records only")])
    a, b, t = iso_millis(c("listed_at")), iso_millis(c("delisted_at")), ingestion_time if ingestion_time is not None else F.lit(None).cast("long")
    q4 = _exploded(records, id_column, "UM-Q4", [(a.isNull(), "listed_at", "invalid listed_at"), (c("delisted_at").isNotNull() & b.isNull(), "delisted_at", "invalid delisted_at"), (b < a, "delisted_at", "delisted_at before listed_at"), (a > t, "listed_at", "listed_at after ingestion_time"), (b > t, "delisted_at", "delisted_at after ingestion_time")])
    kind = c("market_type")
    wrong_contract = [(kind.isin(k) & ~F.coalesce(c("contract_type").isin(v), F.lit(False)), "contract_type", f"{k} needs one of {', '.join(v)}") for k, v in CONTRACTS.items()]
    q5 = _exploded(records, id_column, "UM-Q5", [(~F.coalesce(kind.isin("spot", *DERIVATIVES), F.lit(False)), "market_type", "unknown market_type"), ((kind == "spot") & c("contract_type").isNotNull(), "contract_type", "spot has no contract_type"), *wrong_contract, ((kind == "spot") & c("contract_size").isNotNull(), "contract_size", "spot has no contract_size"), (kind.isin(DERIVATIVES) & ~positive(c("contract_size")), "contract_size", "must be > 0"), *[(c(f).isNotNull() & ~positive(c(f)), f, "must be > 0") for f in ("tick_size", "step_size")]])
    return q1.unionByName(q3).unionByName(q4).unionByName(q5)


def uniqueness(records: DataFrame, index: str) -> DataFrame:
    """(kind, record, first_record) for every record whose instrument_id, symbol era or active symbol was seen before; index orders records and is unique. First occurrences are partial minima, so no key's records come together in one task."""
    kinds = {"instrument_id": (["instrument_id"], F.lit(True)), "symbol_era": (["exchange", "symbol", "listed_at"], F.lit(True)), "active_symbol": (["exchange", "symbol"], F.col("status") == "active")}
    out = None
    for kind, (key, cond) in kinds.items():
        rows = records.where(cond)
        first = rows.groupBy(*key).agg(F.min(index).alias("first_record"))
        on = [rows[k].eqNullSafe(first[k]) for k in key]
        hit = rows.join(first, on).where(F.col(index) > F.col("first_record")).select(F.lit(kind).alias("kind"), F.col(index).alias("record"), "first_record")
        out = hit if out is None else out.unionByName(hit)
    return out


def era_overlaps(records: DataFrame, index: str) -> DataFrame:
    """(exchange, symbol, record): eras of a symbol that begin before an earlier one ended, an open era never ending; by start and then index. A symbol's eras are few: one row a listing."""
    e = records.select("exchange", "symbol", F.col(index).alias("record"), iso_millis(F.col("listed_at")).alias("a"), F.coalesce(iso_millis(F.col("delisted_at")), F.lit((1 << 63) - 1)).alias("b")).where("a is not null")
    before = Window.partitionBy("exchange", "symbol").orderBy("a", "record").rowsBetween(Window.unboundedPreceding, -1)
    return e.withColumn("until", F.max("b").over(before)).where("until > a").select("exchange", "symbol", "record")


def missing_successors(records: DataFrame) -> DataFrame:
    """(instrument_id, successor_id, reason): successors that are the record itself or don't exist."""
    has = records.where("successor_id is not null and successor_id <> ''").select("instrument_id", "successor_id").distinct()
    own = has.where("successor_id = instrument_id").withColumn("reason", F.lit("self-reference"))
    ids = records.select(F.col("instrument_id").alias("_id")).distinct()
    lost = has.where("successor_id <> instrument_id").join(ids, F.col("successor_id") == F.col("_id"), "left_anti").withColumn("reason", F.lit("missing successor"))
    return own.unionByName(lost)


def rename_breaks(records: DataFrame) -> DataFrame:
    """instrument_id of renamed records whose successor is missing or doesn't begin when they end."""
    next_ = records.select(F.col("instrument_id").alias("_id"), iso_millis(F.col("listed_at")).alias("_from"))
    old = records.where("status = 'renamed'").select("instrument_id", "successor_id", iso_millis(F.col("delisted_at")).alias("until"))
    return old.join(next_, F.col("successor_id") == F.col("_id"), "left").where("_id is null or not (_from <=> until)").select("instrument_id").distinct()


def successor_ends(records: DataFrame, most: int = 64) -> DataFrame:
    """(instrument_id, last_id, steps, cycle) for each record with a successor: where its chain ends, after how many steps, and whether it runs in a circle (last_id is null then). A missing successor ends the chain at the last known record.

    Pointers are doubled: after k rounds a record knows the end of 2^k steps, so chains of any length up to 2^most need few joins; a pointer that still moves after as many rounds as the records allow lies on or leads to a circle."""
    from barloom.session import stored

    links = records.where("instrument_id is not null").groupBy("instrument_id").agg(F.max("successor_id").alias("s"))
    ids = links.select(F.col("instrument_id").alias("_id"))
    jump = links.join(ids, F.col("s") == F.col("_id"), "left").select(F.col("instrument_id").alias("id"), F.col("_id").alias("to"), F.when(F.col("_id").isNotNull(), 1).otherwise(0).cast("long").alias("steps"))
    jump = stored(jump, "jump")
    starts = jump.where("to is not null").select("id")
    n, rounds = jump.count(), 0
    while rounds < most and (1 << rounds) <= n:
        b = jump.select(F.col("id").alias("_b"), F.col("to").alias("_to"), F.col("steps").alias("_n"))
        jump = stored(jump.join(b, F.col("to") == F.col("_b"), "left").select("id", F.coalesce("_to", "to").alias("to"), (F.col("steps") + F.when(F.col("_to").isNotNull(), F.col("_n")).otherwise(0)).alias("steps")), "jump")
        rounds += 1
        b = jump.select(F.col("id").alias("_b"), F.col("to").alias("_to"))
        if jump.join(b, F.col("to") == F.col("_b")).where("_to is not null").limit(1).count() == 0:
            break
    b = jump.select(F.col("id").alias("_b"), F.col("to").alias("_to"))
    out = starts.join(jump, "id").join(b, F.col("to") == F.col("_b"), "left")
    circle = F.col("_to").isNotNull()
    return out.select(F.col("id").alias("instrument_id"), F.when(~circle, F.col("to")).alias("last_id"), F.when(~circle, F.col("steps")).alias("steps"), circle.alias("cycle"))


def universe_at(records: DataFrame, at_ms: int) -> DataFrame:
    """Records whose listing period [listed_at, delisted_at) holds a time."""
    a, b = iso_millis(F.col("listed_at")), iso_millis(F.col("delisted_at"))
    return records.where((a <= at_ms) & (b.isNull() | (b > at_ms)))


def safe_name(c: Column) -> Column:
    """Lower case, with anything but letters of the alphabet, digits and underscores as underscores, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9_]+", "_"), "^_+|_+$", "")


def json_text(c: Column) -> Column:
    """A text as a JSON string with characters beyond ASCII kept, as a canonical serialisation writes it."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1)


def collision_suffixes(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with instrument_id made unique: those that share one get .h and eight digits of the sha256 of the canonical JSON of base_id, listed_at, ordinal and symbol, the ordinal counting in the given order. Single ids stay."""
    n = rows.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    marked = rows.join(n, "instrument_id", "left")
    ordinal = F.row_number().over(Window.partitionBy("instrument_id").orderBy(*order))
    twice = marked.where("_n is not null").withColumn("_o", ordinal)
    text = F.concat(F.lit('{"base_id":'), json_text(F.col("instrument_id")), F.lit(',"listed_at":'), json_text(F.col("listed_at")), F.lit(',"ordinal":'), F.col("_o").cast("string"), F.lit(',"symbol":'), json_text(F.col("symbol")), F.lit("}"))
    twice = twice.withColumn("instrument_id", F.concat("instrument_id", F.lit(".h"), F.substring(F.sha2(text, 256), 1, 8))).drop("_o")
    return marked.where("_n is null").unionByName(twice).drop("_n")


def normalize_snapshot(snapshot: DataFrame, exchange: str, prefix: str) -> DataFrame:
    """Instrument records from an exchange snapshot (one row: retrieved_at and symbols, an array of structs): traded symbols only, with ids from prefix, market type, name and listing day. Raises, when run, if a listing lies after the retrieval or a size isn't above zero. No filter: null size."""
    s = snapshot.select("retrieved_at", F.explode("symbols").alias("s")).where("s.status = 'TRADING'")
    kind = F.when(F.col("s.contractType") == "PERPETUAL", "perpetual").when(F.col("s.contractType") != "", "futures").otherwise(F.raise_error(F.lit("unsupported contractType")))
    listed = F.date_format(F.timestamp_add("SECOND", F.call_function("div", F.col("s.onboardDate"), F.lit(1000)), F.expr("timestamp_ntz'1970-01-01 00:00:00'")), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def size(kind_: str, field: str) -> Column:
        v = F.try_element_at(F.filter("s.filters", lambda f: f["filterType"] == kind_), F.lit(1))[field]
        return F.when(v.isNotNull() & ~positive(v), F.raise_error(F.concat(F.lit(f"{field} must be > 0 for "), F.col("s.symbol")))).otherwise(v)

    late = F.col("s.onboardDate") > iso_millis(F.col("retrieved_at"))
    rows = s.select(
        F.concat(F.lit(f"{prefix}."), kind, F.lit("."), safe_name(F.col("s.symbol")), F.lit("."), F.regexp_replace(F.substring(listed, 1, 10), "-", "")).alias("instrument_id"),
        "s.symbol", F.lit(exchange).alias("exchange"), F.nullif(F.col("s.baseAsset"), F.lit("")).alias("base_asset"), F.nullif(F.col("s.quoteAsset"), F.lit("")).alias("quote_asset"), kind.alias("market_type"),
        F.lit("linear").alias("contract_type"), F.lit("active").alias("status"), F.when(late, F.raise_error(F.concat(F.lit("listed after the retrieval: "), F.col("s.symbol")))).otherwise(listed).alias("listed_at"),
        F.lit(None).cast("string").alias("delisted_at"), F.lit(None).cast("string").alias("successor_id"), size("PRICE_FILTER", "tickSize").alias("tick_size"), size("LOT_SIZE", "stepSize").alias("step_size"), F.lit("1").alias("contract_size"),
    )
    return collision_suffixes(rows, ["symbol", "listed_at"])


def tradable_symbols(snapshot: DataFrame, quote: str) -> DataFrame:
    """Symbols of a snapshot that trade as perpetuals in a quote asset, in order."""
    return snapshot.select(F.explode("symbols").alias("s")).where((F.col("s.status") == "TRADING") & (F.col("s.contractType") == "PERPETUAL") & (F.col("s.quoteAsset") == quote)).select("s.symbol").distinct().orderBy("symbol")


RECORDS = "instrument_id string, symbol string, exchange string, base_asset string, quote_asset string, market_type string, contract_type string, status string, listed_at string, delisted_at string, successor_id string, tick_size string, step_size string, contract_size string"


def read_records(spark, path: str) -> DataFrame:
    """Instrument records with record (their position) and ingestion_time from a JSON file: an object with records, or a bare array. Raises ValueError for anything else."""
    import json

    text = spark.read.text(path, wholetext=True).first()
    try:
        value = json.loads(text[0]) if text else None
    except ValueError as e:
        raise ValueError(f"{path} is not JSON: {e}") from e
    rows = value.get("records") if isinstance(value, dict) else value
    if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
        raise ValueError(f"{path} holds no array of records")
    names = [f.strip().split()[0] for f in RECORDS.split(",")]
    said = value.get("ingestion_time") if isinstance(value, dict) else None
    show = lambda x: None if x is None else x if isinstance(x, str) else json.dumps(x)
    return spark.createDataFrame([(i, said, *[show(r.get(n)) for n in names]) for i, r in enumerate(rows)], "record long, ingestion_time string, " + RECORDS)


def universe_verdicts(records: DataFrame) -> DataFrame:
    """(rule_id, failures, status) of all rules about a set of records (as read_records() gives them)."""
    from barloom.report import as_checks, verdicts

    each = record_rules(records, "record", iso_millis(F.col("ingestion_time"))).select("rule_id", F.col("id").cast("string").alias("what"), "field", "reason")
    one = lambda df, rule, what, field, reason: df.select(F.lit(rule).alias("rule_id"), F.col(what).cast("string").alias("what"), F.lit(field).alias("field"), (F.col(reason) if reason in df.columns else F.lit(reason)).alias("reason"))
    ends = successor_ends(records)
    last = records.select(F.col("instrument_id").alias("_l"), F.col("status").alias("_s")).distinct()
    lost = ends.join(last, F.col("last_id") == F.col("_l"), "left").where("cycle or _s not in ('active', 'delisted')").withColumn("reason", F.when(F.col("cycle"), "successor graph cycle").otherwise("successor chain must end at an active or delisted record"))
    parts = [
        each,
        one(uniqueness(records, "record"), "UM-Q2", "record", "instrument_id", "kind"),
        one(missing_successors(records), "UM-Q6", "instrument_id", "successor_id", "reason"),
        one(lost, "UM-Q6", "instrument_id", "successor_id", "reason"),
        one(era_overlaps(records, "record"), "UM-PIT", "record", "listed_at", "eras overlap"),
        one(rename_breaks(records), "UM-PIT", "instrument_id", "successor_id", "a renamed record's successor must begin when it ends"),
    ]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    checks = as_checks(found, F.col("rule_id"), F.col("reason"), F.col("field"), F.col("what"), "universe_metadata")
    return verdicts(checks, ["UM-Q1", "UM-Q2", "UM-Q3", "UM-Q4", "UM-Q5", "UM-Q6", "UM-PIT"])
