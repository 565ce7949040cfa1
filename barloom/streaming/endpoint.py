"""A small HTTP endpoint for webhooks: each accepted payload becomes a line of a file that a stream picks up. It runs outside Spark."""

from __future__ import annotations

import http.server
import itertools
import json
import threading
import time
import uuid

from barloom.storage import arrow_place


class Inbox:
    """Collects payloads and puts them into a folder as files, each by one rename, so a stream never sees half of one. folder: on a file system that the executors of the stream share, in any notation Arrow reads; several inboxes may fill one folder."""

    def __init__(self, folder: str, most: int = 1000):
        self.most = most
        self._fs, self._place = arrow_place(folder)
        self._fs.create_dir(self._place, recursive=True)
        self._lock, self._lines, self._n = threading.Lock(), [], itertools.count(time.time_ns())

    def add(self, payload: str) -> None:
        with self._lock:
            self._lines.append(json.dumps({"payload": payload, "received_ms": time.time_ns() // 1_000_000, "arrival": next(self._n)}))
            if len(self._lines) >= self.most:
                self._flush()

    def _flush(self) -> None:
        if self._lines:
            name = f"{next(self._n)}-{uuid.uuid4().hex[:8]}.json"
            with self._fs.open_output_stream(f"{self._place}/.{name}") as f:
                f.write(("\n".join(self._lines) + "\n").encode())
            self._fs.move(f"{self._place}/.{name}", f"{self._place}/{name}")
            self._lines = []

    def flush(self) -> None:
        with self._lock:
            self._flush()


def serve(inbox: Inbox, path: str = "/webhook", host: str = "127.0.0.1", port: int = 0, max_bytes: int = 1 << 20) -> http.server.ThreadingHTTPServer:
    """A server, not started yet. 404 for another path, 411 without a length, 413 beyond max_bytes, 400 for what isn't JSON, 422 for JSON that isn't an object, else 200 with the number of bytes taken."""

    class Handler(http.server.BaseHTTPRequestHandler):
        def _say(self, code: int, **body) -> None:
            data = json.dumps(body).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_POST(self) -> None:
            if self.path != path:
                return self._say(404, error="no such path")
            length = self.headers.get("Content-Length")
            if length is None or not length.isdigit():
                return self._say(411, error="a length is needed")
            if int(length) > max_bytes:
                return self._say(413, error="too long")
            raw = self.rfile.read(int(length))
            try:
                value = json.loads(raw)
            except ValueError:
                return self._say(400, error="not JSON")
            if not isinstance(value, dict):
                return self._say(422, error="not an object")
            inbox.add(raw.decode())
            return self._say(200, accepted=len(raw))

        def log_message(self, *_) -> None:
            pass

    return http.server.ThreadingHTTPServer((host, port), Handler)
