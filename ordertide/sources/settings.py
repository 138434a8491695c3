"""Configuration and connection settings, resolved on the driver before any job."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

# Environment variables and database defaults that callers rely on.
PASSWORD_ENV = "DB_PASSWORD"
URL_ENV = "JDBC_URL"
USER_ENV = "DB_USER"
JAR_ENV = "JDBC_JAR"
DEFAULT_SCHEMA = "public"
DEFAULT_DRIVER = "org.postgresql.Driver"

SECTIONS = ("spark", "database", "tables", "paths")


def setting(value: str | None, env: str | None = None) -> str | None:
    """A given value, else the environment variable, else None. Empty means not given."""
    return value or (os.environ.get(env) if env else None) or None


def required(value: str | None, env: str | None, what: str, flag: str) -> str:
    """Like :func:`setting`, but a missing value is an error that says how to give it."""
    found = setting(value, env)
    if not found:
        hint = f"pass {flag}" + (f" or set {env}" if env else "")
        raise ValueError(f"{what} not found: {hint}")
    return found


def optional_path(path: str | Path | None) -> str | None:
    return None if path is None else os.fspath(path)


def qualified(table: str, schema: str = DEFAULT_SCHEMA) -> str:
    """``orders`` becomes ``public.orders``; a dotted name stays as it is."""
    return table if "." in table else f"{schema}.{table}"


@dataclass(frozen=True)
class Connection:
    """A JDBC database. The password stays out of ``repr`` and logs."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = DEFAULT_DRIVER


@dataclass(frozen=True)
class Settings:
    """One configuration file."""

    spark: Mapping[str, Any]
    database: Mapping[str, Any]
    tables: Mapping[str, str]
    paths: Mapping[str, str]

    def table(self, name: str) -> str:
        if name not in self.tables:
            known = ", ".join(sorted(self.tables))
            raise ValueError(f"no table {name!r} in the configuration; known: {known}")
        return self.tables[name]

    def path(self, name: str, override: str | Path | None = None) -> str:
        if override is not None:
            return os.fspath(override)
        if name not in self.paths:
            known = ", ".join(sorted(self.paths))
            raise ValueError(f"no path {name!r} in the configuration; known: {known}")
        return self.paths[name]

    def connection(
        self, password: str | None = None, password_env: str | None = None
    ) -> Connection:
        """The configured database. A password argument wins over the environment."""
        db = self.database
        env = password_env or db.get("password_env") or PASSWORD_ENV
        url = db.get("url") or f"jdbc:postgresql://{db['host']}:{db['port']}/{db['db']}"
        return Connection(
            url=url,
            user=db.get("user"),
            password=required(password, env, "database password", "--db-password"),
            driver=db.get("driver", DEFAULT_DRIVER),
        )


def load_settings(path: str | Path = "configs/base.yaml") -> Settings:
    """Read a YAML file with the sections spark, database, tables and paths.

    ``tables`` maps logical names to database names; an empty value means the
    logical name in the default schema.
    """
    with open(path, encoding="utf-8") as file:
        raw = yaml.safe_load(file) or {}
    absent = [s for s in SECTIONS if s not in raw]
    if absent:
        raise ValueError(f"{path} lacks the section {', '.join(absent)}")
    sections = {s: raw[s] or {} for s in SECTIONS}
    schema = sections["database"].get("schema", DEFAULT_SCHEMA)
    sections["tables"] = {
        name: qualified(table or name, schema) for name, table in sections["tables"].items()
    }
    return Settings(**sections)
