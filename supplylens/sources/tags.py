"""Tags on schemas, tables, views and columns, kept in the catalog's own properties and looked up by tag.

A table takes over the tags of its schema and a column those of its table; what is set on an asset itself goes before
what it takes over.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

PREFIX = "tag."
SCHEMA = "asset string, kind string, key string, value string, inherited boolean"


def _pairs(tags: dict[str, str], prefix: str = PREFIX) -> str:
    quote = lambda text: text.replace("\\", "\\\\").replace("'", "\\'")
    return ", ".join(f"'{quote(prefix + k)}' = '{quote(v)}'" for k, v in tags.items())


def tag_schema(spark: SparkSession, schema: str, **tags: str) -> None:
    spark.sql(f"ALTER DATABASE {schema} SET DBPROPERTIES ({_pairs(tags)})")


def tag_table(spark: SparkSession, table: str, **tags: str) -> None:
    """Tags of a table or a view."""
    kind = "VIEW" if spark.catalog.getTable(table).tableType == "VIEW" else "TABLE"
    spark.sql(f"ALTER {kind} {table} SET TBLPROPERTIES ({_pairs(tags)})")


def tag_column(spark: SparkSession, table: str, column: str, **tags: str) -> None:
    tag_table(spark, table, **{f"{column}.{k}": v for k, v in tags.items()})


def _of_schema(spark: SparkSession, schema: str) -> dict[str, str]:
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {schema}").collect()}.get("Properties", "")
    return {k[len(PREFIX) :]: v for k, v in re.findall(r"\(([^(),]+),([^()]*)\)", told) if k.startswith(PREFIX)}


def _of_table(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"][len(PREFIX) :]: r["value"] for r in rows if r["key"].startswith(PREFIX)}


def catalog_tags(spark: SparkSession, schemas: list[str], columns: bool = False) -> DataFrame:
    """Every tag of every asset as a row: asset, kind (schema, table, view or column), key, value, inherited.

    The catalog's entries are listed by the driver; there are as many rows as assets have tags.
    """
    rows = []

    def add(asset: str, kind: str, own: dict[str, str], above: dict[str, str]) -> dict[str, str]:
        held = above | own
        rows.extend((asset, kind, k, v, k not in own) for k, v in sorted(held.items()))
        return held

    for schema in schemas:
        of_schema = add(schema, "schema", _of_schema(spark, schema), {})
        for table in spark.catalog.listTables(schema):
            if table.isTemporary:
                continue
            name = f"{schema}.{table.name}"
            known, fields = _of_table(spark, name), [c.name for c in spark.catalog.listColumns(name)]
            of_column = {c: {k[len(c) + 1 :]: v for k, v in known.items() if k.startswith(f"{c}.")} for c in fields}
            own = {k: v for k, v in known.items() if not any(k.startswith(f"{c}.") for c in fields)}
            held = add(name, "view" if table.tableType == "VIEW" else "table", own, of_schema)
            if columns:
                for c in fields:
                    add(f"{name}.{c}", "column", of_column[c], held)
    return spark.createDataFrame(rows, SCHEMA)
