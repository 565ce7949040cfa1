import hashlib
import http.server
import json
import threading
import urllib.parse
import urllib.request

import pytest

from barloom import cli
from barloom.operators import validation
from barloom.report import CHECK
from barloom.sources.lake import read_bars, write_seed
from barloom.streaming import service
from barloom.streaming.endpoint import Inbox, serve
from tests.test_sources import HEAD, T0, M, bars, line, message, put_zip, server  # noqa: F401


@pytest.fixture
def say(capsys):
    return lambda *a: (cli.main(list(a)), json.loads(capsys.readouterr().out or "null"))


@pytest.fixture
def store(tmp_path):
    """An object store over HTTP: listings of data/KIND/SYMBOL/1m/ and the archives."""
    src = tmp_path / "src"
    src.mkdir()
    blobs = {}
    for kind, name in (("monthly", "A-1m-2020-01"), ("daily", "A-1m-2020-01-02"), ("daily", "A-1m-2020-02-01"), ("daily", "B-1m-2020-01-01")):
        content = open(put_zip(src / f"{name}.zip", "\n".join([HEAD, line(T0), line(T0 + M)])), "rb").read()
        key = f"data/{kind}/{name[0]}/1m/{name}.zip"
        blobs[key] = content
        blobs[key + ".CHECKSUM"] = f"{hashlib.sha256(content).hexdigest()}  {name}.zip".encode()

    class H(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            path, _, ask = self.path.partition("?")
            if ask:
                prefix = urllib.parse.parse_qs(ask)["prefix"][0]
                under = [k[len(prefix) :] for k in blobs if k.startswith(prefix)]
                tops = sorted({k.partition("/")[0] for k in under if "/" in k})
                body = "".join(f"<Contents><Key>{prefix}{k}</Key><Size>{len(blobs[prefix + k])}</Size></Contents>" for k in under if "/" not in k) + "".join(f"<CommonPrefixes><Prefix>{prefix}{t}/</Prefix></CommonPrefixes>" for t in tops)
                data = f"<R>{body}<IsTruncated>false</IsTruncated></R>".encode()
            else:
                data = blobs.get(path.lstrip("/"))
            self.send_response(200 if data is not None else 404)
            self.end_headers()
            self.wfile.write(data or b"")

        def log_message(self, *_):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), H)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", blobs
    s.shutdown()


def test_archives_from_listing_to_dataset(spark, tmp_path, say, store):
    url, blobs = store
    out, raw, seed = (str(tmp_path / n) for n in ("out", "raw", "seed"))
    code, got = say("discover", "--endpoint", url, "--base", "data", "--interval", "1m", "--raw", raw, "--out", out)
    assert code == 0 and (got["files"], got["monthly_files"], got["planned_downloads"], got["skipped_by_default"]) == (4, 1, 3, 1)
    assert say("plan", "--out", out)[1] == got
    code, done = say("download", "--url", url, "--out", out, "--dataset", "bars", "--interval", "1m")
    assert code == 0 and (done["downloaded"], done["verified"], done["skipped_overlap"], done["failed"]) == (3, 3, 1, 0)
    assert say("verify", "--out", out) == (0, {"checksums": {"passed": 3}, "unlisted": 0})
    code, judged = say("check-archives", "--manifest", f"{out}/manifest.json", "--interval", "1m", "--dataset", "bars")
    assert code == 0 and judged["not_passed"] == [] and judged["counters"]["passed"] == 12
    cover = {r.symbol: (r.archives, r.verified, r.missing, r.complete) for r in spark.read.json(f"{out}/coverage").collect()}
    assert cover == {"A": (3, 2, 0, True), "B": (1, 1, 0, True)} and spark.read.json(f"{out}/access").count() == 3
    assert say("materialize", "--interval", "1m", "--files", f"{out}/files", "--raw", raw, "--out", seed)[1]["row_count"] == 4
    code, judged = say("check-dataset", "--root", seed, "--interval", "1m", "--symbols", "A,B")
    assert code == 0 and judged["not_passed"] == []
    (tmp_path / "raw" / "daily" / "B" / "B-1m-2020-01-01.zip").write_bytes(b"x")
    assert say("verify", "--out", out) == (1, {"checksums": {"failed": 1, "passed": 2}, "unlisted": 0})
    (tmp_path / "raw" / "daily" / "B" / "B-1m-2020-01-01.zip").unlink()
    code, judged = say("check-archives", "--manifest", f"{out}/manifest.json", "--interval", "1m", "--dataset", "other")
    assert code == 1 and {r["rule_id"] for r in judged["not_passed"]} == {"KL-DATASET-ID", "KL-VARIANT-ID", "KL-REQUIRED-FILES"}


def test_rules_of_manifests(spark, tmp_path):
    failed = lambda df: {(r.rule_id, r.status) for r in df.where("status <> 'passed'").collect()}
    assert failed(validation.archive_checks(spark, str(tmp_path / "no.json"), "7m", "d", "data/\n")) == {("KL-INTERVAL-SUPPORTED", "failed"), ("KL-LOCAL-DATA-GITIGNORE", "failed"), ("KL-MANIFEST-EXISTS", "failed")}
    (tmp_path / "m.json").write_text(json.dumps({"interval": "1m"}))
    got = validation.archive_checks(spark, str(tmp_path / "m.json"), "1m", "d", "/local_data/\n")
    assert failed(got) == {(f"KL-{r}", "failed") for r in ("DATASET-ID", "VARIANT-ID", "PRIMARY-KEY", "CHECKSUM-FAILED", "DAILY-POLICY", "FILE-MANIFEST", "COVERAGE-REPORT", "RESEARCH-ACCESS")} | {("KL-REQUIRED-FILES", "skipped")}
    root = str(tmp_path / "seed")
    write_seed(bars(spark, [("A", T0, 2.0, 0)]), root)
    (tmp_path / "seed" / "left.csv").write_text("x")
    good = {"dataset_id": "bars.1m", "interval": "1m", "query_engine": "spark", "output_format": "parquet", "generated_csv_file_count": 0, "failed_symbol_count": 0, "scope": "FULL_OUTPUT", "symbols": 1, "row_count": 1, "files": 1}
    assert failed(validation.manifest_checks(spark, root, good, "1m", ["a", "B"])) == {("PQ-NO-CSV", "failed"), ("PQ-FULL-SYMBOL-COVERAGE", "failed")}
    assert failed(validation.manifest_checks(spark, root, good | {"scope": "SAMPLE_OUTPUT", "files": 2}, "1m", ["A", "B"])) == {("PQ-NO-CSV", "failed"), ("PQ-OUTPUT-SCOPE", "warning"), ("PQ-FILE-COUNT-MATCH", "failed"), ("PQ-FULL-SYMBOL-COVERAGE", "skipped")}
    assert failed(validation.manifest_checks(spark, root, None, "1m")) == {("PQ-MANIFEST-EXISTS", "failed")}
    assert failed(validation.manifest_checks(spark, str(tmp_path / "none"), good, "1m")) == {("PQ-OUTPUT-ROOT", "failed")}


def test_names(spark, tmp_path, say):
    entry = {"dataset_id": "bars.um-1m", "version": "v1.2.3", "schema_ref": "DATA_CONTRACT.md#bars-of-um", "created_at": "2026-01-01T00:00:00Z", "updated_at": "2026-01-02T03:04:05.678+00:00", "snapshot": {"snapshot_id": "bars.um/v1_0.parquet"}}
    bad = {"dataset_id": "Bars", "version": "1.2.3", "schema_ref": "x", "created_at": "2026-01-01T00:00:00", "updated_at": "2026-13-01T00:00:00Z", "snapshot": {"snapshot_id": "a b/c"}}
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"registry_version": "v0.1.0", "datasets": [entry, entry | {"snapshot": None}]}))
    code, got = say("check-names", "--registry", str(path))
    assert code == 0 and [r["status"] for r in got["not_passed"]] == ["skipped"] and got["counters"]["passed"] == 12
    path.write_text(json.dumps({"registry_version": "0.1", "datasets": [bad, {}]}))
    code, got = say("check-names", "--registry", str(path))
    by = [(r["rule_id"], r["location"]) for r in got["not_passed"] if r["status"] == "failed"]
    assert code == 1 and len(by) == 12 and sum(at == "datasets[0]" for _, at in by) == 6
    empty = validation.naming_checks(spark.createDataFrame([], validation.REGISTRY), "f")
    assert empty.count() == 0 and {n for n, _ in empty.dtypes} == {f.split()[0] for f in CHECK.split(", ")}


def test_universe_and_layout(spark, tmp_path, say):
    answer = {"symbols": [{"symbol": s, "contractType": "PERPETUAL", "status": "TRADING", "baseAsset": "B", "quoteAsset": "Q", "onboardDate": 1_704_067_200_000, "filters": [{"filterType": "PRICE_FILTER", "tickSize": "0.1"}, {"filterType": "LOT_SIZE", "stepSize": "1"}]} for s in ("AQ", "BQ")]}
    (tmp_path / "a.json").write_text(json.dumps(answer))
    code, got = say("universe", "--answer", str(tmp_path / "a.json"), "--root", str(tmp_path / "u"), "--at", "2024-06-01T00:00:00Z", "--exchange", "x")
    assert code == 0 and got["records"] == 2 and {r["status"] for r in got["rules"]} == {"passed"}
    root = str(tmp_path / "seed")
    write_seed(bars(spark, [(s, T0, 2.0, 0) for s in ("AQ", "BQ", "CQ", "D_230630")]), root)
    code, got = say("precheck-layout", "--root", root, "--leave-out", "CQ", "--batch-size", "1")
    assert code == 0 and got["files"] == 4 and {r["symbol"]: r["reason"] for r in got["left_out"]} == {"CQ": "default_excluded_symbol", "D_230630": "delivery_contract"}
    assert [(r["symbol"], r["batch_no"]) for r in got["batches"]] == [("AQ", 1), ("BQ", 2)]


def test_live(spark, tmp_path, say, server):  # noqa: F811
    seed, root = str(tmp_path / "seed"), str(tmp_path / "live")
    write_seed(bars(spark, [("A", T0, 2.0, 0)]), seed)
    now = T0 + 5 * M + 2000
    code, got = say("live-once", "--root", root, "--interval", "1m", "--symbols", "A", "--api", server, "--seed", seed, "--now-ms", str(now))
    assert code == 0 and got["pages"] == {"ok": 4}
    assert say("live-plan", "--root", root, "--interval", "1m", "--symbols", "A", "--now-ms", str(now))[1]["plan"][0]["status"] == "up_to_date"
    # The service: a webhook that came in, then the gap after it from the API.
    inbox = Inbox(f"{root}/in")
    hook = serve(inbox)
    clock = iter([now + 10 * M, now + 12 * M])
    threading.Timer(0.1, lambda: urllib.request.urlopen(urllib.request.Request(f"http://127.0.0.1:{hook.server_port}/webhook", data=message(T0 + 5 * M, "1.9").encode(), method="POST"))).start()
    wanted = spark.createDataFrame([("A", "1m")], "symbol string, interval string")
    done = service.serve(spark, root, None, wanted, "1m", server, inbox, hook, rounds=2, every=1, clock=lambda: next(clock))
    assert done["rounds"] == 2
    got = {r.open_time: r.close for r in read_bars(spark, f"{root}/current/1m").collect()}
    assert sorted(got) == [T0 + i * M for i in range(17)]
    naps, tries = [], iter([OSError(), OSError(), "line"])

    def connect():
        x = next(tries)
        if isinstance(x, OSError):
            raise x
        return x

    assert service.reconnecting(connect, sleep=naps.append) == "line" and naps == [1, 2]
