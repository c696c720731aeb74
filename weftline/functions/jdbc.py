"""Database name of a JDBC URL, and the relational-table name built from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The URL prefixes whose database name can be found.
DB2 = "jdbc:db2"
DERBY = "jdbc:derby"
MARIADB = "jdbc:mariadb"
MYSQL = "jdbc:mysql"
ORACLE = "jdbc:oracle"
POSTGRESQL = "jdbc:postgresql"
SQL_SERVER = "jdbc:sqlserver"
TERADATA = "jdbc:teradata"

# The keys that introduce the database name inside a URL.
SQL_SERVER_KEY = ";databaseName="
TERADATA_KEY = "/DATABASE="


def _upto(text: Column, stop: str) -> Column:
    return F.substring_index(text, stop, 1)


def _after_last(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, -1)


def _after_key(url: Column, key: str, stop: str) -> Column:
    """Text between ``key`` and ``stop``; empty when the URL lacks the key."""
    return F.when(url.contains(key), _upto(F.split_part(url, F.lit(key), F.lit(2)), stop)).otherwise("")


def database_name(url: Column) -> Column:
    """Database part of ``url``; empty for unknown drivers."""
    slash_form = _after_last(_upto(url, "?"), "/")
    derby_form = _upto(F.when(url.contains("/"), _after_last(url, "/")).otherwise(_after_last(url, ":")), ";")
    slash_driver = (
        url.startswith(DB2) | url.startswith(MARIADB) | url.startswith(MYSQL) | url.startswith(POSTGRESQL)
    )
    return (
        F.when(slash_driver, slash_form)
        .when(url.startswith(DERBY), derby_form)
        .when(url.startswith(ORACLE), _after_last(url, ":"))
        .when(url.startswith(SQL_SERVER), _after_key(url, SQL_SERVER_KEY, ";"))
        .when(url.startswith(TERADATA), _after_key(url, TERADATA_KEY, "/"))
        .otherwise("")
    )


def rdbms_name(url: Column, table: Column) -> Column:
    """``db.table`` in lower case; the host is not part of the name."""
    return F.concat(F.lower(database_name(url)), F.lit("."), F.lower(table))
