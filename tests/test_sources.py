import hashlib
import http.server
import io
import json
import threading
import urllib.error
import zipfile

import pytest
from pyspark.sql import functions as F

from barloom.operators.continuity import backfill_plan
from barloom.sources import archives, rest
from barloom.sources.lake import ensure_current, list_files, migrate_symbol, probe_files, read_bars, upsert_current, write_seed
from barloom.streaming.router import Router, backfill, rebuild

T0, M = 1_577_836_800_000, 60_000
HEAD = "open_time,open,high,low,close,volume,close_time,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,ignore"


def line(t, close=1.5):
    return f"{t},1.0,2.0,0.5,{close},10.0,{t + M - 1},15.0,3,5.0,7.5,0"


def put_zip(path, text):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("bars.CSV", text)
    return str(path)


def specs(spark, *paths):
    return spark.createDataFrame([("A", "1m", "daily", "2020-01-01", str(p)) for p in paths], "symbol string, interval string, archive_source string, archive_period string, path string")


def test_zip_archives(spark, tmp_path):
    a = put_zip(tmp_path / "a.zip", "\n".join([HEAD, line(T0), "", HEAD, line(T0 + M) + "\r"]))
    b = put_zip(tmp_path / "b.zip", line(T0)[:20] + "\n" + line(T0 + M, "x"))
    (tmp_path / "c.zip").write_bytes(b"no zip")
    got = archives.parse_lines(archives.read_zip_lines(spark, specs(spark, a))).orderBy("open_time").collect()
    assert [(r.open_time, r.close, r.trade_count, r.line_no) for r in got] == [(T0, 1.5, 3, 1), (T0 + M, 1.5, 3, 4)]
    bad = archives.parse_lines(archives.read_zip_lines(spark, specs(spark, b, tmp_path / "c.zip", tmp_path / "none.zip")), keep_errors=True)
    assert sorted(r.error.split(":")[0] for r in bad.collect()) == ["BadZipFile", "FileNotFoundError", "cannot read close in line 1", "fewer than 11 fields"]
    with pytest.raises(Exception, match="fewer than 11"):
        archives.parse_lines(archives.read_zip_lines(spark, specs(spark, b))).collect()
    assert archives.parse_lines(archives.read_zip_lines(spark, specs(spark).limit(0))).count() == 0


def test_manifest_and_checksums(spark, tmp_path):
    put_zip(tmp_path / "a.zip", line(T0))
    digest = hashlib.sha256((tmp_path / "a.zip").read_bytes()).hexdigest()
    (tmp_path / "a.sum").write_text(f"{digest}  a.zip\n")
    (tmp_path / "b.sum").write_text("00  a.zip\n")
    records = spark.createDataFrame([(str(tmp_path / z), str(tmp_path / c)) for z, c in (("a.zip", "a.sum"), ("a.zip", "b.sum"), ("a.zip", "no.sum"), ("no.zip", "a.sum"))], "local_zip_path string, local_checksum_path string")
    assert [r.checksum_status for r in archives.verify_files(spark, records).orderBy("local_zip_path", "local_checksum_path").collect()] == ["passed", "failed", "missing_checksum", "missing_zip"]
    rows = [{"symbol": "A", "interval": "1m", "archive_package_source": "daily", "archive_period": "p", "zip_name": "z.zip", "download_status": "downloaded", "checksum_status": s} for s in ("passed", "failed")]
    (tmp_path / "f.jsonl").write_text("\n\n".join(map(json.dumps, rows)))
    assert [r.path for r in archives.work_units(spark, str(tmp_path / "f.jsonl"), "/raw/").collect()] == ["/raw/daily/A/z.zip"]
    (tmp_path / "c.jsonl").write_text('{"source_path": "k/z.zip"}\n')
    assert archives.read_jsonl(spark, str(tmp_path / "c.jsonl"), "source_path string, source_checksum_path string").first()[1] == "k/z.zip.CHECKSUM"
    assert archives.split_symbols("btcusdt, ETHUSDT # no\nbtcusdt") == ["BTCUSDT", "ETHUSDT"] and archives.split_symbols('["a"]') == ["A"] and archives.split_symbols("all") == ["all"]


def page(keys, prefixes=(), more=""):
    body = "".join(f"<Contents><Key>{k}</Key><Size>3</Size></Contents>" for k in keys) + "".join(f"<CommonPrefixes><Prefix>{p}</Prefix></CommonPrefixes>" for p in prefixes)
    return f'<R xmlns="urn:x">{body}<IsTruncated>{"true" if more else "false"}</IsTruncated><NextMarker>{more}</NextMarker></R>'.encode()


def test_listing(spark):
    got = {"": page(["d/A-1m-2024-01.zip"], ["d/x/"], "m1"), "m1": page(["d/A-1m-2024-01.zip.CHECKSUM", "d/A-1m-2024-02.zip"])}
    get = lambda url: got[url.rpartition("marker=")[2]]
    rows = list(archives.list_pages("http://h", "d/", get))
    assert len(rows) == 4 and rows[1] == ("d/x/", None)
    cat = archives.catalog_records(spark.createDataFrame(rows, "key string, size long"), "monthly", "A", "1m", "/raw", "now").collect()
    assert {(r.archive_period, r.has_remote_checksum) for r in cat} == {("2024-01", True), ("2024-02", False)}
    odd = spark.createDataFrame([("d/B-1m-2024-01.zip", 3)], "key string, size long")
    with pytest.raises(Exception, match="unexpected archive name"):
        archives.catalog_records(odd, "monthly", "A", "1m", "/raw", "now").collect()


def refuse(*codes, body=b""):
    left = list(codes)

    def opener(request, timeout):
        if left:
            raise urllib.error.HTTPError(request.full_url, left.pop(0), "no", {}, io.BytesIO(body))
        return io.BytesIO(b"[[1]]")

    return opener


def test_rest_errors():
    naps = []
    assert rest.fetch("http://h", opener=refuse(429, 503), sleep=naps.append).status == "ok" and naps == [1, 2]
    assert rest.fetch("http://h", retries=1, opener=refuse(500, 500), sleep=naps.append).status == "retry_exhausted"
    assert rest.fetch("http://h", opener=refuse(400, body=b"Invalid symbol.")).status == "symbol_unavailable"
    assert rest.fetch("http://h", opener=refuse(403)).status == "error"
    with pytest.raises(rest.StopRequests):
        rest.fetch("http://h", opener=refuse(418))
    with pytest.raises(ValueError):
        rest.page_url("http://h", "/p", "all", "1m", None, None, 5)
    with pytest.raises(FileNotFoundError):
        archives.http_get("http://h", opener=refuse(404))
    with pytest.raises(archives.TransientError):
        archives.http_get("http://h", retries=1, opener=refuse(500, 500), sleep=naps.append)


def test_download(spark, tmp_path):
    put_zip(tmp_path / "good.zip", "x")
    blobs = {"/k/good.zip": (tmp_path / "good.zip").read_bytes(), "/k/bad.zip": b"zzz"}
    blobs["/k/good.zip.CHECKSUM"] = hashlib.sha256(blobs["/k/good.zip"]).hexdigest().encode() + b"  good.zip"
    blobs["/k/bad.zip.CHECKSUM"] = b"00  bad.zip"
    blobs["/k/alone.zip"] = b"a"

    class H(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            data = blobs.get(self.path)
            self.send_response(200 if data is not None else 404)
            self.end_headers()
            self.wfile.write(data or b"")

        def log_message(self, *_):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), H)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    rows = [(f"k/{n}.zip", f"k/{n}.zip.CHECKSUM", str(tmp_path / "raw" / f"{n}.zip"), str(tmp_path / "raw" / f"{n}.zip.CHECKSUM"), d) for n, d in (("good", "download"), ("bad", "download"), ("alone", "download"), ("none", "download"), ("covered", "skip"))]
    df = spark.createDataFrame(rows, "source_path string, source_checksum_path string, local_zip_path string, local_checksum_path string, download_decision string")
    run = lambda: {r.source_path[2:-4]: (r.download_status, r.checksum_status) for r in archives.download(df, f"http://127.0.0.1:{s.server_port}").collect()}
    first = run()
    assert first == {"good": ("downloaded", "passed"), "bad": ("failed", "failed"), "alone": ("failed", "missing_checksum"), "none": ("failed", "missing_zip"), "covered": ("skipped_daily_overlap", "not_attempted")}
    assert run()["good"] == ("skipped_existing_verified", "skipped_existing_verified") and sorted(p.name for p in (tmp_path / "raw").iterdir()) == ["good.zip", "good.zip.CHECKSUM"]
    s.shutdown()
    folders = spark.createDataFrame([("d/B/",), ("d/A/",), ("d/x.zip",)], "key string")
    assert [r[0] for r in archives.archive_symbols(folders, folders.limit(1)).collect()] == ["A", "B"] and archives.archive_symbols(folders, folders, 1).count() == 1


@pytest.fixture
def server():
    class H(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            q = dict(x.split("=") for x in self.path.partition("?")[2].split("&"))
            if q["symbol"] == "GONE":
                self.send_response(400)
                self.end_headers()
                self.wfile.write(b"Invalid symbol")
                return
            a, b = int(q["startTime"]), int(q["endTime"])
            times = list(range(-(-a // M) * M, b + 1, M))[: int(q["limit"])]
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps([[t, "1", "2", "0.5", "1.5", "10", t + M - 1, "15", 3, "5", "7", "0"] for t in times]).encode())

        def log_message(self, *_):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), H)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_backfill_from_api(spark, tmp_path, server):
    wanted = spark.createDataFrame([("A", "1m"), ("GONE", "1m")], "symbol string, interval string")
    state = spark.createDataFrame([("A", "1m", T0), ("GONE", "1m", T0)], "symbol string, interval string, last_closed_open_time long")
    empty = spark.createDataFrame([], "symbol string, interval string, open_time long")
    plan = backfill_plan(wanted, state, empty, T0 + 8 * M + 2000)
    spark.dataSource.register(rest.BarsApi)
    answers = spark.read.format("bars_api").option("base", server).option("limit", "3").option("ranges", rest.ranges_of(plan)).load()
    assert backfill(spark, str(tmp_path), answers, T0 + 9 * M, 0) == {"ok": 7, "symbol_unavailable": 1}
    bars = read_bars(spark, str(tmp_path / "current" / "1m"))
    assert sorted(r.open_time for r in bars.collect()) == [T0 + i * M for i in range(1, 8)]
    assert Router(spark, str(tmp_path), "rest").state().first().merged_bars == 7


def bars(spark, rows):
    """(symbol, open_time, close, arrival)"""
    df = spark.createDataFrame(rows, "symbol string, open_time long, close double, arrival long")
    fixed = {"interval": F.lit("1m"), "open": F.lit(1.0), "high": F.lit(99.0), "low": F.lit(0.5), "volume": F.lit(1.0), "close_time": F.col("open_time") + M - 1, "quote_volume": F.lit(1.0), "trade_count": F.lit(1).cast("long"), "taker_buy_base_volume": F.lit(1.0), "taker_buy_quote_volume": F.lit(1.0), "source_archive": F.lit("z"), "archive_source": F.lit("daily"), "archive_period": F.lit("p")}
    return df.withColumns(fixed)


def test_seed_current_and_pruning(spark, tmp_path):
    seed, cur = str(tmp_path / "seed"), str(tmp_path / "cur")
    year = 366 * 86_400_000
    bad = write_seed(bars(spark, [("A", T0, 2.0, 0), ("A", T0 + year, 2.0, 0), ("灵", T0, 3.0, 0), ("123", T0, 3.0, 0), ("A", T0 + 1, 2.0, 0)]), seed)
    assert bad.count() == 1 and list_files(spark, seed).count() == 4
    assert {r.symbol for r in read_bars(spark, seed, current=False).collect()} == {"A", "灵", "123"}
    assert ensure_current(spark, seed + "x", cur) == "bootstrap_required"
    assert ensure_current(spark, seed, cur, ["A"]) == "initialized" and ensure_current(spark, seed, cur, ["A"]) == "already_initialized" and ensure_current(spark, seed, cur) == "already_initialized"
    assert ensure_current(spark, seed, cur, ["A", "123"]) == "initialized"
    counts = upsert_current(spark, cur, bars(spark, [("A", T0, 7.0, 1), ("A", T0, 8.0, 2), ("A", T0 + M, 9.0, 3), ("B", T0, 4.0, 1), ("灵", T0, 6.0, 1)]))
    assert {c["symbol"]: (c["input_rows"], c["existing_rows"], c["output_rows"], c["replaced"]) for c in counts} == {"A": (3, 1, 2, 2), "B": (1, 0, 1, 0), "灵": (1, 0, 1, 0)}
    upsert_current(spark, cur, bars(spark, [("灵", T0, 5.0, 1)]))
    got = {(r.symbol, r.open_time): r.close for r in read_bars(spark, cur).collect()}
    assert got == {("A", T0): 8.0, ("A", T0 + M): 9.0, ("A", T0 + year): 2.0, ("B", T0): 4.0, ("灵", T0): 5.0, ("123", T0): 3.0}
    df = read_bars(spark, cur, ["a"], T0, T0 + 10 * M)
    filters = df._jdf.queryExecution().executedPlan().toString().partition("PartitionFilters: [")[2].partition("PushedFilters")[0]
    assert df.count() == 2 and "year" in filters and "month" in filters
    assert read_bars(spark, str(tmp_path / "nothing")).count() == 0


def test_archives_run_in_many_tasks(spark, tmp_path):
    """Files are spread by their number, though their rows are a few bytes and adaptive execution would merge them into one task."""
    paths = [put_zip(tmp_path / f"{i}.zip", line(T0 + i * M)) for i in range(12)]
    lines = archives.read_zip_lines(spark, specs(spark, *paths))
    assert lines.count() == 12 and lines.select(F.spark_partition_id().alias("p")).distinct().count() >= 5
    assert archives.spread(spark.range(5000), "id").rdd.getNumPartitions() == 5000


def test_upsert_survives_a_crash(spark, tmp_path, monkeypatch):
    """A crash anywhere in the renames leaves bars that the next writer brings in place; one before the journal changes nothing."""
    from barloom.sources import lake
    from barloom.storage import Files

    root = str(tmp_path / "cur")
    upsert_current(spark, root, bars(spark, [("A", T0, 1.0, 1), ("B", T0, 1.0, 1)]))
    state = lambda: {(r.symbol, r.open_time): r.close for r in read_bars(spark, root).collect()}
    own = Files.rename
    for k in range(4):
        left = [k]

        def rename(self, a, b, left=left):
            if not left[0]:
                raise OSError("lost")
            left[0] -= 1
            return own(self, a, b)

        monkeypatch.setattr(Files, "rename", rename)
        new = 10.0 + k
        with pytest.raises(OSError):
            upsert_current(spark, root, bars(spark, [("A", T0, new, 1), ("B", T0, new, 1)]))
        monkeypatch.setattr(Files, "rename", own)
        assert lake.recover(spark, root) == 1 and lake.recover(spark, root) == 0
        assert state() == {("A", T0): new, ("B", T0): new}
    monkeypatch.setattr(Files, "write_new", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        upsert_current(spark, root, bars(spark, [("A", T0, 99.0, 1)]))
    assert lake.recover(spark, root) == 0 and state() == {("A", T0): 13.0, ("B", T0): 13.0}


def test_migration(spark, tmp_path):
    root = str(tmp_path / "cur")
    write_seed(bars(spark, [("A", T0 + i * M, 2.0, 0) for i in range(5)] + [("B", T0, 1.0, 0)]), root)
    upsert = str(tmp_path / "new")
    upsert_current(spark, upsert, bars(spark, [("A", T0, 9.0, 1)]))
    import shutil

    shutil.copytree(next((tmp_path / "new" / "symbol=A" / "year=2020").iterdir()), tmp_path / "cur" / "symbol=A" / "year=2020" / "month=01")
    assert migrate_symbol(spark, root, "X")["status"] == "source_missing"
    plan = migrate_symbol(spark, root, "A")
    assert (plan["status"], plan["row_count"], plan["duplicates"], plan["source_status"]) == ("planned", 6, 1, "mixed_layout_needs_migration")
    done = migrate_symbol(spark, root, "A", execute=True)
    assert done["status"] == "migrated" and (tmp_path / "cur" / done["backup"] / "symbol=A").exists()
    got = {r.open_time: r.close for r in read_bars(spark, root, ["A"]).where("month is not null").collect()}
    assert len(got) == 5 and got[T0] == 2.0  # the year-only copy sorts after month=01
    assert migrate_symbol(spark, root, "A", execute=True)["status"] == "no_migration_needed"
    f = next((tmp_path / "cur" / "symbol=B" / "year=2020").glob("*.parquet"))
    f.write_bytes(f.read_bytes()[:-4])
    assert migrate_symbol(spark, root, "B", execute=True)["status"] == "source_parquet_unreadable"
    p = probe_files(spark, root).where("symbol = 'B'").first()
    assert p.head == "PAR1" and not p.readable and p.tail != "PAR1"


def message(t, close="1.5", closed=True, high="2", symbol="A", envelope=False):
    m = {"e": "kline", "s": symbol, "k": {"t": t, "T": t + M - 1, "s": symbol, "i": "1m", "o": "1", "c": close, "h": high, "l": "0.5", "v": "10", "q": "15", "V": "5", "Q": "7", "n": 3, "x": closed}}
    return json.dumps({"stream": "a@kline_1m", "data": m} if envelope else m)


def test_payloads(spark):
    from barloom.streaming.ticks import parse_messages

    flat = {"symbol": "a", "interval": "1m", "open_time": 0, "open": "1", "high": 2, "low": 0.5, "close": 1, "volume": 1, "close_time": M - 1, "quote_volume": 1, "trade_count": 1, "taker_buy_base_volume": 1, "taker_buy_quote_volume": 1}
    cases = [message(0), message(0, envelope=True), json.dumps(flat), json.dumps(flat | {"is_closed": "No"}), json.dumps({k: v for k, v in flat.items() if k not in ("open", "low")}), message(0, closed="false"), message(0, closed=None), "nonsense", "[1]", None, json.dumps(flat | {"interval": "2h"}), message(0, close="x")]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, payload string")
    got = [(r.payload_format, r.symbol, r.is_closed, r.error) for r in parse_messages(df, "webhook", F.lit(10 * M)).orderBy("i").collect()]
    assert got[0] == ("raw", "A", True, None) and got[1] == ("combined", "A", True, None) and got[2] == ("normalized", "A", True, None) and got[3][2] is False
    assert got[4][3] == "payload lacks: open, low" and got[5][2] is True and got[6][2] is False
    assert [g[3] for g in got[7:10]] == ["payload is not a JSON object"] * 3
    assert got[10][3] == "unsupported interval: 2h" and got[11][3] == "cannot read close"
    ws = parse_messages(df, "websocket", F.lit(0)).orderBy("i").collect()
    assert ws[2].error == "payload is not a kline event" and ws[0].stream == "a@kline_1m" and ws[0].archive_source == "live_websocket"


def test_stream_to_dataset(spark, tmp_path):
    src, root = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    put = lambda n, *ms: (src / f"{n}.json").write_text("\n".join(json.dumps({"payload": m, "received_ms": T0, "arrival": i}) for i, m in enumerate(ms)))
    put("0", message(T0, "1.1"), message(T0, "1.2"), message(T0 + M, closed=False), message(T0, high="0.1", symbol="B"), "junk")
    router = Router(spark, str(root), "websocket")
    stream = lambda: spark.readStream.schema("payload string, received_ms long, arrival long").option("maxFilesPerTrigger", "1").json(str(src))
    router.run(stream()).awaitTermination()
    put("1", message(T0 - 40 * 86_400_000, "1.3"), message(T0, "1.4"))  # a late bar and a redelivery
    router.run(stream()).awaitTermination()
    got = {r.open_time: r.close for r in read_bars(spark, str(root / "current" / "1m")).collect()}
    assert got == {T0: 1.4, T0 - 40 * 86_400_000: 1.3}
    s = router.state().first()
    assert (s.last_closed_open_time, s.merged_bars) == (T0, 4)
    latest = {r.symbol: (r.close, len(r.errors)) for r in router.latest().collect()}
    assert latest == {"A": (1.4, 0), "B": (1.5, 2)}
    rejects = spark.read.json(str(root / "rejects" / "batch=0"))
    assert rejects.count() == 2 and {e for r in rejects.collect() for e in r.errors} >= {"payload is not a JSON object"}
    router.process(spark.createDataFrame([(message(T0, "9"), T0, 0)], "payload string, received_ms long, arrival long"), 1)  # batch 1 again
    assert router.state().first().merged_bars == 4
    rebuild(spark, str(root), "1m", str(tmp_path / "again"))
    assert {r.open_time: r.close for r in read_bars(spark, str(tmp_path / "again")).collect()} == got


@pytest.mark.parametrize("name", ["灵焰", "a b", "a#b", "a?b", "a%3Ab", "é|{}"])
def test_places_of_any_name(spark, tmp_path, name):
    """materialized_manifest and others: names that a URI can't hold unescaped, with and without a scheme; archives of such names are read and verified."""
    from barloom.storage import arrow_place

    put_zip(tmp_path / f"{name}.zip", line(T0))
    for scheme in ("", "file:", "file://"):
        system, place = arrow_place(f"{scheme}{tmp_path}/{name}.zip")
        assert place == f"{tmp_path}/{name}.zip" and system.get_file_info(place).size > 0
    assert arrow_place("mock:///灵/a b#c%20d")[1] == "灵/a b#c d"
    path = f"file://{tmp_path}/{name}.zip"
    assert [r.open_time for r in archives.parse_lines(archives.read_zip_lines(spark, specs(spark, path))).collect()] == [T0]
    (tmp_path / f"{name}.sum").write_text(hashlib.sha256((tmp_path / f"{name}.zip").read_bytes()).hexdigest())
    records = spark.createDataFrame([(path, path[:-3] + "sum")], "local_zip_path string, local_checksum_path string")
    assert archives.verify_files(spark, records).first().checksum_status == "passed"


def test_many_archives_share_tasks(spark):
    """zip_lines, zip_checksums and others: a task costs more than reading a small archive, so many archives share some, and few have one each."""
    paths = spark.range(6400).select(F.lit("A").alias("symbol"), F.lit("1m").alias("interval"), F.lit("daily").alias("archive_source"), F.lit("p").alias("archive_period"), F.format_string("/none/%d.zip", "id").alias("path"))
    parts = lambda df: df.rdd.getNumPartitions()
    assert parts(archives.read_zip_lines(spark, paths)) == 200 and parts(archives.read_zip_lines(spark, paths.limit(70))) == 64 and parts(archives.read_zip_lines(spark, paths.limit(50))) == 50
    assert parts(archives.verify_files(spark, paths.select(F.col("path").alias("local_zip_path"), F.col("path").alias("local_checksum_path")))) == 200
    assert archives.read_zip_lines(spark, paths.limit(300)).where("error like 'FileNotFoundError%'").select("source_archive").distinct().count() == 300


def test_materialized_symbol_in_other_script(spark, tmp_path):
    """materialized_bars: the archive and the partition of a symbol in another script, to the seed and back."""
    from barloom.sources.materialize import materialize

    units = specs(spark, put_zip(tmp_path / "灵焰-1m.zip", line(T0))).withColumn("symbol", F.lit("灵焰"))
    assert materialize(spark, units, str(tmp_path / "灵"), "1m")["row_count"] == 1
    assert [(r.symbol, r.open_time) for r in read_bars(spark, str(tmp_path / "灵"), current=False).collect()] == [("灵焰", T0)]



def test_checksums_in_other_script(spark, tmp_path):
    """zip_checksums: archives and sums of symbols in another script."""
    put_zip(tmp_path / "灵.zip", line(T0))
    for n, said in (("灵.sum", hashlib.sha256((tmp_path / "灵.zip").read_bytes()).hexdigest()), ("焰.sum", "00")):
        (tmp_path / n).write_text(said)
    records = spark.createDataFrame([(f"file:{tmp_path}/灵.zip", f"file:{tmp_path}/{n}.sum") for n in ("灵", "焰", "没")], "local_zip_path string, local_checksum_path string")
    assert sorted(r.checksum_status for r in archives.verify_files(spark, records).collect()) == ["failed", "missing_checksum", "passed"]
