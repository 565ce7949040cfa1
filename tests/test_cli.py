import json

from barloom import cli
from barloom.operators.validation import dataset_checks
from barloom.sources import lake
from barloom.sources.materialize import read_manifest
from tests.test_sources import HEAD, T0, M, line, put_zip


def test_archives_to_dataset(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    put_zip(raw / "m.zip", "\n".join([HEAD, line(T0), line(T0 + M)]))
    put_zip(raw / "d.zip", "\n".join([line(T0), line(T0 + M, 1.75), line(T0 + 3 * M, 99)]))
    rows = [{"symbol": "A", "interval": "1m", "archive_package_source": s, "archive_period": p, "zip_name": z, "local_zip_path": str(raw / z), "download_status": "downloaded", "checksum_status": "passed"} for s, p, z in (("monthly", "2020-01", "m.zip"), ("daily", "2020-01-01", "d.zip"))]
    (tmp_path / "files.jsonl").write_text("\n".join(map(json.dumps, rows)))
    seed, cur = str(tmp_path / "seed"), str(tmp_path / "cur")
    say = lambda *a: (cli.main(list(a)), json.loads(capsys.readouterr().out or "null"))
    code, out = say("materialize", "--interval", "1m", "--files", str(tmp_path / "files.jsonl"), "--raw", str(raw), "--out", seed)
    assert code == 0 and (out["row_count"], out["files"], out["duplicates"], out["conflicts"], out["inconsistent"], out["quarantined"], out["ohlc_bad"]) == (2, 1, 1, 1, 0, 1, 1)
    again = ("materialize", "--interval", "1m", "--files", str(tmp_path / "files.jsonl"), "--raw", str(raw), "--out", seed)
    assert say(*again, "--strict")[0] == 1
    assert say(*again, "--resume")[1]["symbols"] == 0
    said = [json.loads(p.read_text()) for p in sorted((tmp_path / "seed" / "manifests").glob("*.json"))]
    assert len(said) == 2 and all((m["row_count"], m["symbols"], m["files"]) == (2, 1, 1) for m in said)  # the resumed run describes the whole dataset
    assert sorted(json.loads(p.read_text())["row_count"] for p in (tmp_path / "seed" / "manifests" / "runs").glob("*.json")) == [0, 2]
    manifest = read_manifest(spark, seed)
    checks = dataset_checks(spark, lake.read_bars(spark, seed, current=False), lake.list_files(spark, seed), manifest, "d").collect()
    assert len(checks) == 13 and {c.status for c in checks} == {"passed"}
    wrong = dataset_checks(spark, lake.read_bars(spark, seed, current=False), lake.list_files(spark, seed), manifest | {"row_count": 9, "scope": "SAMPLE_OUTPUT"}, "d")
    assert {c.rule_id: c.status for c in wrong.where("status <> 'passed'").collect()} == {"PQ-ROW-COUNT-MATCH": "failed", "PQ-OUTPUT-SCOPE": "warning"}
    assert say("validate", "--root", seed)[0] == 0
    assert say("init-current", "--seed", seed, "--root", cur)[1]["status"] == "initialized"
    code, out = say("continuity", "--root", cur, "--now-ms", str(T0 + 10 * M))
    assert out["series"][0]["rows"] == 2 and out["overall_status"] == "ok"
    assert say("audit-layout", "--root", cur)[1]["status"] == "ok"
    assert say("migrate-layout", "--root", cur, "--symbols", "A")[1]["symbols"][0]["status"] == "no_migration_needed"
    assert say("probe", "--root", cur) == (0, {"unreadable": []})
    assert cli.main(["materialize", "--interval", "2m", "--files", "x", "--raw", "x", "--out", "x"]) == 2
    assert cli.main(["no-such"]) == 2
