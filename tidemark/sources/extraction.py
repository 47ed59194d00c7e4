"""Clients of the sources outside: resumable downloads, exchange quotes, consistent database snapshots. Driver side;
every connection is passed in, so all of it runs without a network in tests."""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from pathlib import Path


class ExtractionRefused(ValueError):
    """A response that can't be trusted."""


# --- files over WebDAV --------------------------------------------------------------------------------------------

#: Attempts at a request, statuses worth another, resumptions of a stream. (fixed values)
REQUESTS, TRANSIENT, RESUMES = 5, frozenset({500, 502, 503, 504}), 8


@dataclass(frozen=True)
class Remote:
    name: str
    size: int


@dataclass
class Response:
    status: int
    headers: dict[str, str]
    body: Iterable[bytes]


def content_range(response: Response) -> str:
    return next((v for k, v in response.headers.items() if k.lower() == "content-range"), "")


def starts_at(response: Response) -> int | None:
    """First byte that a partial answer says it holds; none if it doesn't say."""
    found = re.fullmatch(r"bytes (\d+)-\d+/(?:\d+|\*)", content_range(response).strip())
    return int(found[1]) if found else None


class WebDav:
    """Lists and downloads; `send(method, url, headers)` returns a Response and may raise OSError, in its body too."""

    def __init__(self, root: str, send: Callable[[str, str, dict], Response], pause: Callable[[float], None] = time.sleep):
        self.root, self.send, self.pause = root.rstrip("/"), send, pause

    def _request(self, method: str, path: str, headers: dict) -> Response:
        for attempt in range(REQUESTS):
            try:
                response = self.send(method, f"{self.root}/{path.lstrip('/')}", headers)
                if response.status not in TRANSIENT:
                    return response
            except OSError:
                if attempt == REQUESTS - 1:
                    raise
            if attempt < REQUESTS - 1:
                self.pause(0.5 * 2**attempt)
        raise ExtractionRefused(f"{method} {path}: no answer after {REQUESTS} attempts")

    def list_dir(self, path: str) -> list[Remote]:
        """Files of a directory with their sizes."""
        response = self._request("PROPFIND", path, {"Depth": "1"})
        if response.status != 207:
            raise ExtractionRefused(f"listing {path}: status {response.status}")
        found = []
        for item in ET.fromstring(b"".join(response.body)).iter("{DAV:}response"):
            size = item.findtext(".//{DAV:}getcontentlength")
            if size is not None:
                found.append(Remote(item.findtext("{DAV:}href", "").rstrip("/").rsplit("/", 1)[-1], int(size)))
        return sorted(found, key=lambda r: r.name)

    def download(self, path: str, target: Path, size: int) -> Path:
        """Downloads a file, resuming where a stream broke, and starting over once if the server won't; the size must be right."""
        part = target.with_name(target.name + ".part")
        target.parent.mkdir(parents=True, exist_ok=True)
        restarted = False
        for _ in range(RESUMES + 2):
            have = part.stat().st_size if part.exists() else 0
            if have == size:
                part.replace(target)
                return target
            if have > size:
                part.unlink()
                continue
            response = self._request("GET", path, {"Range": f"bytes={have}-"} if have else {})
            if have and response.status != 206:
                if restarted:
                    raise ExtractionRefused(f"{path} can't be resumed")
                restarted = True
                part.unlink()
                continue
            if response.status not in (200, 206):
                raise ExtractionRefused(f"{path}: status {response.status}")
            if response.status == 206 and starts_at(response) != have:
                raise ExtractionRefused(f"{path}: asked for bytes from {have}, the answer is {content_range(response)!r}")
            try:
                with part.open("ab") as f:
                    for block in response.body:
                        f.write(block)
            except OSError:
                continue
        raise ExtractionRefused(f"{path}: {part.stat().st_size if part.exists() else 0} of {size} bytes")


# --- exchange quotes ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Quote:
    quote_date: str
    currency: str
    data_hora_cotacao: str
    cotacao_compra: str
    cotacao_venda: str


def _rate(value, name: str) -> str:
    try:
        rate = Decimal(str(value))
    except (InvalidOperation, TypeError) as e:
        raise ExtractionRefused(f"{name} {value!r} is no number") from e
    if not rate.is_finite() or rate <= 0:
        raise ExtractionRefused(f"{name} {value!r} is no rate")
    return str(value)


def quotes_in(body: str, day: dt.date, currency: str) -> list[Quote]:
    """Quotes of one day's response; none on a day without. Publications before their quote date are refused."""
    rows = json.loads(body, parse_float=str).get("value")
    if not isinstance(rows, list):
        raise ExtractionRefused("a response without quotes or their absence")
    found = []
    for r in rows:
        try:
            published = str(r["dataHoraCotacao"])
            quote = Quote(day.isoformat(), currency, published, _rate(r["cotacaoCompra"], "buying rate"), _rate(r["cotacaoVenda"], "selling rate"))
        except KeyError as e:
            raise ExtractionRefused(f"a quote without {e}") from e
        if dt.datetime.fromisoformat(published).date() < day:
            raise ExtractionRefused(f"published {published}, for {day}")
        found.append(quote)
    return found


def sole_quote(quotes: Sequence[Quote]) -> Quote | None:
    """The day's quote: of several publications, which must agree and lie within a minute, the earliest."""
    if not quotes:
        return None
    if len({(Decimal(q.cotacao_compra), Decimal(q.cotacao_venda)) for q in quotes}) > 1:
        raise ExtractionRefused("publications that disagree")
    at = sorted(quotes, key=lambda q: dt.datetime.fromisoformat(q.data_hora_cotacao))
    gap = dt.datetime.fromisoformat(at[-1].data_hora_cotacao) - dt.datetime.fromisoformat(at[0].data_hora_cotacao)
    if gap > dt.timedelta(minutes=1):
        raise ExtractionRefused(f"publications {gap} apart")
    return at[0]


def fetch_series(get: Callable[[dt.date, str], str], first: dt.date, last: dt.date, currency: str) -> list[Quote]:
    """One request per calendar day; a span without any quote is refused."""
    if first > last:
        raise ExtractionRefused("an empty span")
    days = (first + dt.timedelta(days=i) for i in range((last - first).days + 1))
    found = [q for d in days if (q := sole_quote(quotes_in(get(d, currency), d, currency)))]
    if not found:
        raise ExtractionRefused(f"no quote from {first} to {last}")
    return found


# --- database snapshot --------------------------------------------------------------------------------------------

#: Settings that fix how values become text. (fixed values)
RENDERING = {"TimeZone": "UTC", "DateStyle": "ISO, YMD", "IntervalStyle": "iso_8601", "extra_float_digits": "3", "bytea_output": "hex"}


@dataclass(frozen=True)
class Snapshot:
    taken_at: str
    rows: list[tuple]
    watermark: str | None
    transaction: str | None = None
    log_position: str | None = None

    def records(self, columns: Sequence[str], stamped: Sequence[str] = ("_snapshot_at", "_pg_snapshot", "_pg_wal_lsn")) -> list[dict]:
        """Rows under the contract's names, each stamped with the instant, the transaction snapshot and the log position."""
        stamp = dict(zip(stamped, (self.taken_at, self.transaction, self.log_position), strict=True))
        return [dict(zip(columns, row, strict=True)) | stamp for row in self.rows]


def consistent_snapshot(connection, table: str, columns: Sequence[str], key: str, watermark: str) -> Snapshot:
    """All rows of a table as text, as of one instant, in one read-only repeatable-read transaction.

    `connection.execute(sql)` returns a cursor. Columns must be the contract's; the rows read must be all there are.
    """
    run = connection.execute
    for name, value in RENDERING.items():
        run(f"SET {name} = '{value}'")
    run("BEGIN TRANSACTION ISOLATION LEVEL REPEATABLE READ READ ONLY")
    try:
        taken = run("SELECT to_char(now() AT TIME ZONE 'UTC', 'YYYY-MM-DD\"T\"HH24:MI:SS.US\"Z\"')").fetchone()[0]
        schema, _, name = table.rpartition(".")
        held = [r[0] for r in run(f"SELECT column_name FROM information_schema.columns WHERE table_schema = '{schema or 'public'}' AND table_name = '{name}' ORDER BY ordinal_position").fetchall()]
        if held != list(columns):
            raise ExtractionRefused(f"{table} has {held}, the contract {list(columns)}")
        rows = run(f"SELECT {', '.join(f'{c}::text' for c in columns)} FROM {table} ORDER BY {key}::text COLLATE \"C\"").fetchall()
        n = run(f"SELECT count(*) FROM {table}").fetchone()[0]
        if n != len(rows):
            raise ExtractionRefused(f"{len(rows)} of {n} rows")
        newest = run(f"SELECT max({watermark})::text FROM {table}").fetchone()[0]
        transaction, position = run("SELECT pg_current_snapshot()::text, pg_current_wal_lsn()::text").fetchone()
        return Snapshot(taken, rows, newest, transaction, position)
    finally:
        run("COMMIT")


def changed_since(connection, table: str, key: str, watermark: str, since: str) -> list[str]:
    """Keys a watermark extract would deliver; kept to measure what it misses against the snapshots' difference."""
    return [r[0] for r in connection.execute(f"SELECT {key}::text FROM {table} WHERE {watermark} > '{since}' ORDER BY 1").fetchall()]


def download_parts(dav: WebDav, path: str, names: Sequence[str], into: Path) -> list[Path]:
    """Downloads the named files of a directory, each with the size its listing states; a missing one is refused first."""
    listed = {r.name: r.size for r in dav.list_dir(path)}
    missing = [n for n in names if n not in listed]
    if missing:
        raise ExtractionRefused(f"{path} lacks {missing}")
    return [dav.download(f"{path.rstrip('/')}/{n}", into / n, listed[n]) for n in names]
