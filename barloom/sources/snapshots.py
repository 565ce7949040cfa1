"""Raw snapshots of an exchange's instruments, kept by content: the same content is stored once, and read only if its checksum holds."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from barloom.storage import Files

SHAPE = "retrieved_at string, symbols array<struct<symbol:string,pair:string,contractType:string,status:string,baseAsset:string,quoteAsset:string,marginAsset:string,onboardDate:long,filters:array<struct<filterType:string,tickSize:string,stepSize:string>>>>"


class SnapshotError(ValueError):
    """A snapshot that is missing or not what its checksum says."""


def canonical(value) -> bytes:
    """JSON with sorted keys, no white space and characters beyond ASCII kept."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()


def checksum(value) -> str:
    return hashlib.sha256(canonical(value)).hexdigest()


def write_if_changed(files: Files, text: str, *parts: str) -> bool:
    """Puts a small file in place unless it already says the same; whether it did."""
    if files.exists(*parts):
        if files.read_text(*parts) == text:
            return False
        files.delete(*parts)
    return files.write_new(text, *parts)


def store(spark: SparkSession, root: str, response: dict, retrieved_at: str) -> str:
    """The name of the snapshot with this response; written only if none with the same content is there."""
    files, digest = Files(spark, root), checksum(response)
    same = [n for n in files.names() if n.endswith(f"-{digest[:16]}.json")]
    if same:
        return same[0]
    name = f"{retrieved_at.replace('-', '').replace(':', '').replace('+0000', 'Z')}-{digest[:16]}.json"
    files.write_new(json.dumps({"retrieved_at": retrieved_at, "checksum": digest, "raw_response": response}, ensure_ascii=False), name)
    return name


def load(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """A snapshot, the latest by default, as one row for instruments.normalize_snapshot()."""
    files = Files(spark, root)
    names = [name] if name else [n for n in files.names() if n.endswith(".json")][-1:]
    if not names or not files.exists(names[0]):
        raise SnapshotError(f"no snapshot in {root}")
    envelope = json.loads(files.read_text(names[0]))
    if checksum(envelope["raw_response"]) != envelope["checksum"]:
        raise SnapshotError(f"the checksum of {names[0]} doesn't hold")
    row = {"retrieved_at": envelope["retrieved_at"], "symbols": envelope["raw_response"].get("symbols", [])}
    return spark.read.schema(SHAPE).json(spark.sparkContext.parallelize([json.dumps(row)], 1))
