"""A small SQLite store of marts for serving, and what is asked of it."""

from __future__ import annotations

import sqlite3
import time
from contextlib import closing
from pathlib import Path

from pyspark.sql import DataFrame

from headway.constants import EXPORT_STALE_HOURS

#: Rows that a mart may have to be exported.
MOST_ROWS = 200_000


def export(marts: dict[str, DataFrame], path: str, meta: dict[str, str]) -> dict[str, int]:
    """Writes the marts and a table meta(key, value); the file is replaced when whole. Returns rows by mart."""
    temp, counts = Path(f"{path}.new"), {}
    temp.unlink(missing_ok=True)
    with closing(sqlite3.connect(temp)) as con:
        for name, df in marts.items():
            rows = df.limit(MOST_ROWS + 1).collect()
            if len(rows) > MOST_ROWS:
                raise ValueError(f"{name} has over {MOST_ROWS} rows: no mart to serve from one file")
            con.execute(f"create table {name} ({', '.join(df.columns)})")
            con.executemany(f"insert into {name} values ({', '.join('?' * len(df.columns))})", [tuple(r) for r in rows])
            counts[name] = len(rows)
        con.execute("create table meta (key text primary key, value text)")
        con.executemany("insert into meta values (?, ?)", sorted((meta | {"exported_at": str(int(time.time()))}).items()))
        con.commit()
    temp.replace(path)
    return counts


class Store:
    """Read-only questions to an export."""

    def __init__(self, path: str):
        self.path = path

    def _ask(self, sql: str, *args) -> list[dict]:
        with closing(sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)) as con:
            con.row_factory = sqlite3.Row
            return [dict(r) for r in con.execute(sql, args)]

    def meta(self, now: float | None = None) -> dict:
        out = {r["key"]: r["value"] for r in self._ask("select key, value from meta")}
        hours = ((now or time.time()) - int(out["exported_at"])) / 3600
        return out | {"age_hours": round(hours, 1), "stale": hours > EXPORT_STALE_HOURS}

    def health(self) -> dict:
        return {"ok": Path(self.path).exists()}

    def agencies(self) -> list[dict]:
        return self._ask("select * from mart_otp_by_agency order by n_arrivals desc, agency")

    def worst_routes(self, limit: int = 20, agency: str | None = None) -> list[dict]:
        if not 1 <= limit <= 200:
            raise ValueError("limit must be from 1 to 200")
        where, args = ("where agency = ?", [agency]) if agency else ("", [])
        return self._ask(f"select * from mart_worst_routes {where} order by worst_rank limit ?", *args, limit)

    def otp_by_hour(self, agency: str | None = None) -> list[dict]:
        where, args = ("where agency = ?", [agency]) if agency else ("", [])
        pct = lambda c: f"round(sum({c} * n_arrivals) / sum(n_arrivals), 1) as {c}"
        return self._ask(f"select hour_local, sum(n_arrivals) as n_arrivals, {pct('on_time_pct')}, {pct('late_pct')} from mart_otp_by_route_hour {where} group by hour_local order by hour_local", *args)
