import json
import threading
import urllib.error
import urllib.request

import pytest

from barloom.operators.instruments import normalize_snapshot
from barloom.sources import snapshots
from barloom.sources.lake import read_bars, write_seed
from barloom.storage import Files
from barloom.streaming import service
from barloom.streaming.endpoint import Inbox, serve
from barloom.streaming.router import Router
from tests.test_sources import T0, M, bars, message, server  # noqa: F401


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    body = {"symbols": [{"symbol": "灵USDT", "contractType": "PERPETUAL", "status": "TRADING", "onboardDate": 1_704_067_200_000, "filters": []}], "serverTime": 1}
    name = snapshots.store(spark, root, body, "2024-06-01T00:00:00Z")
    assert snapshots.store(spark, root, dict(reversed(body.items())), "2024-06-02T00:00:00Z") == name  # the same content
    assert normalize_snapshot(snapshots.load(spark, root), "x", "x").first().instrument_id == "x.perpetual.usdt.20240101"
    p = tmp_path / name
    (tmp_path / f".{name}.crc").unlink(missing_ok=True)
    p.write_text(p.read_text().replace('"serverTime": 1', '"serverTime": 2'))
    with pytest.raises(snapshots.SnapshotError):
        snapshots.load(spark, root)
    with pytest.raises(snapshots.SnapshotError):
        snapshots.load(spark, root + "/none")
    f = Files(spark, root)
    assert snapshots.write_if_changed(f, "a", "n.txt") and not snapshots.write_if_changed(f, "a", "n.txt") and snapshots.write_if_changed(f, "b", "n.txt") and f.read_text("n.txt") == "b"


def test_once_and_fallback(spark, tmp_path, server):  # noqa: F811
    seed, root = str(tmp_path / "seed"), str(tmp_path / "live")
    write_seed(bars(spark, [("A", T0, 2.0, 0)]), seed)
    wanted = spark.createDataFrame([("A", "1m"), ("NEW", "1m")], "symbol string, interval string")
    got = service.run_once(spark, root, seed, wanted, "1m", T0 + 5 * M + 2000, 0, server)
    assert got["plan"] == {"missing": 1, "bootstrap_required": 1} and got["pages"] == {"ok": 4}
    assert sorted(r.open_time for r in read_bars(spark, f"{root}/current/1m").collect()) == [T0 + i * M for i in range(5)]
    again = service.run_once(spark, root, seed, wanted, "1m", T0 + 5 * M + 2000, 1, server)
    assert again["plan"] == {"up_to_date": 1, "bootstrap_required": 1} and "pages" not in again
    late = service.stale_fallback(spark, root, wanted.where("symbol = 'A'"), "1m", T0 + 20 * M + 2000, 2, server)
    assert late["stale"] == 1 and late["pages"] == {"ok": 15}
    assert service.stale_fallback(spark, root, wanted.where("symbol = 'A'"), "1m", T0 + 21 * M, 3, server) == {"stale": 0}
    assert service.stream_groups(["A", "B", "A", "C"], "1m", 2) == [["a@kline_1m", "b@kline_1m"], ["c@kline_1m"]]
    assert service.connection_due(0, 23 * 3_600_000) and not service.connection_due(0, 1)


def test_webhook_to_dataset(spark, tmp_path):
    inbox = Inbox(str(tmp_path / "in"))
    s = serve(inbox, max_bytes=2000)
    threading.Thread(target=s.serve_forever, daemon=True).start()

    def post(body, path="/webhook"):
        try:
            return urllib.request.urlopen(urllib.request.Request(f"http://127.0.0.1:{s.server_port}{path}", data=body, method="POST")).status
        except urllib.error.HTTPError as e:
            return e.code

    codes = [post(message(T0).encode()), post(b"x", "/other"), post(b"{"), post(b"[1]"), post(b'"' + b"x" * 3000 + b'"'), post(json.dumps({"symbol": "A"}).encode())]
    s.shutdown()
    inbox.flush()
    assert codes == [200, 404, 400, 422, 413, 200]
    router = Router(spark, str(tmp_path / "out"), "webhook")
    router.run(spark.readStream.schema("payload string, received_ms long, arrival long").json(str(tmp_path / "in"))).awaitTermination()
    assert [r.open_time for r in read_bars(spark, str(tmp_path / "out" / "current" / "1m")).collect()] == [T0]
    done = json.loads((tmp_path / "out" / "done" / "0.json").read_text())
    assert done == {"closed": 1, "rejected": 1}
