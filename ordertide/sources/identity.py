"""Whether two names mean one table, or one folder holds another, told before Spark starts.

Names are brought to one form: of a database its kind, hosts, ports and name; of a table its
catalog, schema and name, without quotes; of a path its store and its parts without detours.
Where the spelling leaves it open, two names count as one: a wrong yes refuses a job, a wrong no would
empty a job's own input.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from fnmatch import fnmatchcase
from urllib.parse import parse_qsl, unquote

from ordertide.sources.settings import DEFAULT_SCHEMA

#: Ports that the databases listen on unless told otherwise.
_PORTS = {"postgresql": 5432, "mysql": 3306, "mariadb": 3306, "sqlserver": 1433, "oracle": 1521, "db2": 50000}
#: Names of the machine itself.
_HERE = {"", "localhost", "127.0.0.1", "::1"}
#: Settings of a URL that name the schema of a table without one.
_SCHEMA_SETTINGS = ("currentschema", "schema")
#: Settings that name the database.
_DATABASE_SETTINGS = ("databasename", "database")
#: Stores of several names.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "wasb"}

_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]+):(?://([^/]*))?(.*)", re.DOTALL)
_HOST = re.compile(r"(\[[^\]]*\]|[^:]*):?(\d*)")
_QUOTED = re.compile(r'"((?:[^"]|"")*)"|`((?:[^`]|``)*)`|\[([^\]]*)\]|([^."`\[\]\s]+)')


@dataclass(frozen=True)
class Database:
    kind: str
    hosts: frozenset[tuple[str, int | None]]
    name: str
    schema: str


def database(url: str) -> Database:
    """What a JDBC URL connects to; user, password and all other settings say nothing of it."""
    rest = re.sub(r"^jdbc:", "", url.strip(), flags=re.IGNORECASE)
    kind, _, rest = rest.partition(":")
    kind = kind.lower()
    place, *settings = re.split(r"[?;]", rest)
    given = {k.lower(): v for part in settings for k, v in parse_qsl(part, keep_blank_values=True)}
    if kind == "oracle":
        # thin:@//host:port/service, thin:@host:port/service or thin:@host:port:sid
        place = "//" + re.sub(r"^([^:/]*:\d+):", r"\1/", place.rpartition("@")[2].lstrip("/"))
    if place.startswith("//"):
        authority, _, name = place[2:].partition("/")
    else:
        authority, name = "", place
    hosts = set()
    for one in authority.rpartition("@")[2].split(","):
        host, port = _HOST.match(one.strip().lower()).groups()
        host = host.strip("[]").rstrip(".")
        hosts.add(("localhost" if host in _HERE else host, int(port) if port else _PORTS.get(kind)))
    name = next((given[x] for x in _DATABASE_SETTINGS if given.get(x)), unquote(name).strip("/"))
    schema = next((given[x].split(",")[0] for x in _SCHEMA_SETTINGS if given.get(x)), DEFAULT_SCHEMA)
    return Database(kind, frozenset(hosts), name.lower(), schema.strip('"`').lower())


def table_parts(name: str) -> tuple[str, ...]:
    """The parts of a table's name, unquoted and in lower case: databases differ in which case
    they read, and two names that differ in case alone count as one."""
    found = [next(x for x in match if x) for match in _QUOTED.findall(name) if any(match)]
    return tuple(x.replace('""', '"').replace("``", "`").lower() for x in found)


def _same_database(left: Database, right: Database) -> bool:
    """Databases of one name with a host in common. MySQL's two drivers speak to the same servers."""
    kinds = {"mariadb": "mysql"}
    same_kind = kinds.get(left.kind, left.kind) == kinds.get(right.kind, right.kind)
    return same_kind and bool(left.hosts & right.hosts)


def _full(of: Database, name: str) -> tuple[str, str, str]:
    """Catalog, schema and table. MySQL has no schemas within a database."""
    parts = table_parts(name)
    if of.kind in ("mysql", "mariadb"):
        return (parts[-2] if len(parts) > 1 else of.name), "", parts[-1]
    catalog, schema, table = (("", "") + parts)[-3:]
    return catalog or of.name, schema or of.schema, table


def same_table(url: str, table: str, other_url: str, other_table: str) -> bool:
    """Whether two tables are one. A query in place of a table reads each table that it names."""
    left, right = database(url), database(other_url)
    if not _same_database(left, right):
        return False
    if table.lstrip().startswith("(") or other_table.lstrip().startswith("("):
        query, named = (table, other_table) if table.lstrip().startswith("(") else (other_table, table)
        words = {x for x in re.split(r"[^\w$]+", query.lower()) if x}
        return named.lstrip().startswith("(") or table_parts(named)[-1] in words
    return _full(left, table) == _full(right, other_table)


def path_parts(path: str) -> tuple[str | None, tuple[str, ...]]:
    """The store of a path, None where the session decides it, and its parts from the root."""
    store, raw = None, path
    # As the file systems read it: nothing is percent-decoded, and ? and # belong to the name.
    if found := _SCHEME.fullmatch(path):
        scheme, authority, raw = found.groups()
        scheme = _SCHEMES.get(scheme.lower(), scheme.lower())
        if scheme != "file":
            store = f"{scheme}://{re.sub(r':[0-9]+$', '', (authority or '').lower())}"
    if store is None:
        whole = os.path.abspath(raw)
        # Links are followed as far as there are no wildcards.
        raw = whole if re.search(r"[*?\[{]", whole) else os.path.realpath(whole)
    out: list[str] = []
    for part in raw.split("/"):
        if part == "..":
            out = out[:-1]
        elif part not in ("", "."):
            out.append(part)
    return store, tuple(out)


def _fits(pattern: str, part: str) -> bool:
    """Whether one part of a path fits one of another; either may hold wildcards."""
    def alike(x: str, y: str) -> bool:
        return any(fnmatchcase(y, one) for one in _alternatives(x))

    return pattern == part or alike(pattern, part) or alike(part, pattern)


def _alternatives(pattern: str) -> list[str]:
    """A part with {a,b} written out."""
    found = re.search(r"\{([^{}]*)\}", pattern)
    if not found:
        return [pattern]
    return [
        x for one in found.group(1).split(",") for x in _alternatives(pattern[: found.start()] + one + pattern[found.end() :])
    ]


def overlapping(path: str, other: str) -> bool:
    """Whether two paths are one, or one lies within the other: an overwrite of either then takes
    files of the other. A path without a store may lie in any, so only the parts count."""
    (store, parts), (other_store, other_parts) = path_parts(path), path_parts(other)
    if store is not None and other_store is not None and store != other_store:
        return False
    return all(_fits(a, b) for a, b in zip(parts, other_parts, strict=False))
