"""Tags of schemas, tables, views and columns."""

from supplylens.session import new_folder
from supplylens.sources import tables as T
from supplylens.sources import tags


def test_tags_are_inherited_and_overruled(spark):
    folder = new_folder(spark, "tagdb")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    T.ensure_namespace(spark, name, "case", folder)
    spark.range(3).write.saveAsTable(f"{name}.stock")
    spark.sql(f"CREATE VIEW {name}.low AS SELECT id FROM {name}.stock WHERE id < 2")
    tags.tag_schema(spark, name, domain="inventory", unit="supply chain")
    tags.tag_table(spark, f"{name}.low", domain="it's risk")
    tags.tag_column(spark, f"{name}.stock", "id", level="key")
    found = tags.catalog_tags(spark, [name], columns=True)
    got = {(r["asset"].removeprefix(name), r["kind"], r["key"], r["value"], r["inherited"]) for r in found.collect()}
    unit = [(a, k, "unit", "supply chain", a != "") for a, k in (("", "schema"), (".stock", "table"), (".low", "view"), (".stock.id", "column"), (".low.id", "column"))]
    assert got == {
        *unit,
        ("", "schema", "domain", "inventory", False),
        (".stock", "table", "domain", "inventory", True),
        (".stock.id", "column", "domain", "inventory", True),
        (".stock.id", "column", "level", "key", False),
        (".low", "view", "domain", "it's risk", False),
        (".low.id", "column", "domain", "it's risk", True),
    }
    hits = T.assets_with_tags(found, domain="inventory", unit="supply chain").collect()
    assert {r["asset"] for r in hits} == {name, f"{name}.stock", f"{name}.stock.id"}
