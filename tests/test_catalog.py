"""Latest tables of a catalog that are made anew, and several of them over one log."""

from __future__ import annotations

import pytest
from build import ITEM, at, change, log, rows

from tidemark import ChangeCatalog, sources


def land(spark, root, *changes):
    sources.write_changes(log(spark, list(changes)), f"{root}/{ITEM.name}")


def held(catalog):
    return rows(catalog.stores[ITEM.name].read())


def over(spark, root, name, latest="latest", **options):
    schemas = (f"{name}_cdc", f"{name}_views", f"{name}_{latest}")
    return ChangeCatalog(spark, [ITEM], root, *schemas, buckets=2, **options)


@pytest.mark.parametrize("by", ["create", "refresh"])
def test_a_dropped_table_is_read_from_the_start(spark, tmp_path, by):
    root, name = str(tmp_path / "changes"), f"dropped_{by}"
    catalog = over(spark, root, name)
    land(spark, root, change("c", 1, 100), change("c", 2, 200))
    catalog.create()
    land(spark, root, change("u", 1, 300, name="m"))
    catalog.refresh()
    want = [(1, "m", 0.0, at(300)), (2, "n", 0.0, at(200))]
    assert held(catalog) == want
    spark.sql(f"DROP VIEW {catalog.stores[ITEM.name].name}")
    # the same object or another one makes the table anew
    again = catalog if by == "create" else over(spark, root, name)
    getattr(again, by)()
    assert held(again) == want
    land(spark, root, change("c", 3, 400))
    catalog.refresh()
    again.refresh()
    assert held(again) == [*want, (3, "n", 0.0, at(400))]


def test_two_catalogs_over_one_root_both_read_all(spark, tmp_path):
    root = str(tmp_path / "changes")
    land(spark, root, change("c", 1, 100))
    first = over(spark, root, "two")
    first.create()
    second = over(spark, root, "two", "keywise", keywise=True)
    second.create()
    want = [(1, "n", 0.0, at(100))]
    assert held(first) == held(second) == want
    for k, order in ((2, (first, second)), (3, (second, first))):
        land(spark, root, change("c", k, 100 * k))
        for catalog in order:
            catalog.refresh()
        want.append((k, "n", 0.0, at(100 * k)))
        assert held(first) == held(second) == want


def test_a_refresh_reads_new_files_only(spark, tmp_path):
    root = str(tmp_path / "changes")
    catalog = over(spark, root, "onward", keywise=True)
    land(spark, root, change("c", 1, 100))
    catalog.create()
    noted = catalog.stores[ITEM.name].identity()
    land(spark, root, change("c", 2, 200))
    over(spark, root, "onward", keywise=True).refresh()
    assert catalog.stores[ITEM.name].identity() == noted
    progress = tmp_path / "changes" / "_progress"
    assert [p.name for p in progress.iterdir()] == [f"onward_latest.{ITEM.name}.{noted}"]
