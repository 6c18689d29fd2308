"""FX densification (LOCF) and recursive hierarchy."""

import datetime as dt
from decimal import Decimal

from ledgerline.operators.fx import densify_ffill, date_spine
from ledgerline.operators.hierarchy import resolve_hierarchy, unreachable_nodes


def d(day):
    return dt.date(2024, 1, day)


def test_densify_ffill(spark):
    q = spark.createDataFrame(
        [("USD", d(2), Decimal("1.1")), ("USD", d(5), None), ("USD", d(6), Decimal("1.3")),
         ("GBP", d(4), Decimal("0.8")), ("GBP", d(20), Decimal("0.9"))],
        "ccy string, day date, rate decimal(18,8)")
    out = {(r.ccy, r.day): r.rate for r in densify_ffill(q, ["ccy"], "day", "rate", "2024-01-01", "2024-01-08").collect()}
    assert (("USD", d(1)) not in out) and out[("USD", d(2))] == Decimal("1.1")
    assert out[("USD", d(5))] == Decimal("1.1")  # NULL does not break the carry
    assert out[("USD", d(7))] == Decimal("1.3")
    assert out[("GBP", d(7))] == Decimal("0.8") and ("GBP", d(3)) not in out
    assert len(out) == 6 + 4


def test_date_spine(spark):
    days = [r.date_day for r in date_spine(spark, "2024-02-27", "2024-03-02").collect()]
    assert days == [dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]


def test_hierarchy_paths_and_orphans(spark):
    df = spark.createDataFrame(
        [(1, None, "Loisirs"), (2, 1, "Restaurant"), (3, 2, "Fast-food"), (4, 99, "Orphan"),
         (5, 6, "CycleA"), (6, 5, "CycleB")],
        "categorie_id bigint, categorie_parent_id bigint, nom_categorie string")
    res = resolve_hierarchy(df)
    out = {r.categorie_id: (r.chemin_complet, r.id_racine) for r in res.collect()}
    assert out[3] == ("Loisirs > Restaurant > Fast-food", 1)
    assert set(out) == {1, 2, 3}
    assert sorted(r.categorie_id for r in unreachable_nodes(df, res).collect()) == [4, 5, 6]


def test_hierarchy_depth_is_never_truncated(spark):
    import pytest
    from ledgerline.operators.hierarchy import HierarchyDepthError
    chain = [(i, i - 1 if i > 1 else None, f"L{i}") for i in range(1, 5)]  # levels 0..3
    df = spark.createDataFrame(chain, "categorie_id bigint, categorie_parent_id bigint, nom_categorie string")
    assert resolve_hierarchy(df, max_depth=4).count() == 4  # exactly max_depth levels: kept whole
    with pytest.raises(HierarchyDepthError):
        resolve_hierarchy(df, max_depth=3)  # a fourth level exists: fail, do not drop it


def test_hierarchy_of_a_thousand_levels(spark, monkeypatch):
    """A chain takes log2 of its length in rounds; ids that repeat give a row
    for each path, null labels none; a loop below a root raises."""
    import pytest
    from pyspark.sql import DataFrame

    from ledgerline.operators import hierarchy
    kind = "categorie_id bigint, categorie_parent_id bigint, nom_categorie string"
    chain = [(i, i - 1 if i else None, f"L{i}") for i in range(1000)] + [(5000, 4999, "orphan"), (5001, 5000, "orphan")]
    rounds, write = [], hierarchy.remove_path
    monkeypatch.setattr(hierarchy, "remove_path", lambda *a: (rounds.append(a), write(*a)))
    res = resolve_hierarchy(spark.createDataFrame(chain, kind).repartition(3))
    got = {r.categorie_id: (r.chemin_complet, r.id_racine) for r in res.collect()}
    assert got == {i: (" > ".join(f"L{k}" for k in range(i + 1)), 0) for i in range(1000)} and len(rounds) == 10
    twice = [(1, None, "A"), (1, None, "B"), (2, 1, "C"), (3, 2, None), (4, 3, "D")]
    rows = resolve_hierarchy(spark.createDataFrame(twice, kind)).collect()
    assert sorted(str((r.categorie_id, r.chemin_complet)) for r in rows) == sorted(map(str, [
        (1, "A"), (1, "B"), (2, "A > C"), (2, "B > C"), (3, None), (3, None), (4, None), (4, None)]))
    loop = [(1, None, "A"), (1, 2, "B"), (2, 1, "C"), (7, 7, "own parent")]
    with pytest.raises(hierarchy.HierarchyCycleError):
        resolve_hierarchy(spark.createDataFrame(loop, kind))
    assert resolve_hierarchy(spark.createDataFrame(loop[3:], kind)).count() == 0
    assert isinstance(resolve_hierarchy(spark.createDataFrame([], kind)), DataFrame)
