"""The store's questions over HTTP, read only: /health, /meta, /agencies, /worst-routes, /otp-by-hour."""

from __future__ import annotations

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

from headway.serving.store import Store


def answer(store: Store, target: str) -> tuple[int, object]:
    """(status, body) of a GET."""
    url = urlsplit(target)
    asked = {k: v[-1] for k, v in parse_qs(url.query).items()}
    agency = asked.get("agency")
    routes = {
        "/health": store.health,
        "/meta": store.meta,
        "/agencies": store.agencies,
        "/worst-routes": lambda: store.worst_routes(int(asked.get("limit", 20)), agency),
        "/otp-by-hour": lambda: store.otp_by_hour(agency),
    }
    if url.path not in routes:
        return 404, {"error": "not found"}
    if url.path != "/health" and not store.health()["ok"]:
        return 503, {"error": "nothing is exported yet"}
    try:
        return 200, routes[url.path]()
    except ValueError as e:
        return 422, {"error": str(e)}


def server(path: str, port: int = 8000, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    store = Store(path)

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            status, body = answer(store, self.path)
            raw = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *_):
            pass

    return ThreadingHTTPServer((host, port), Handler)
