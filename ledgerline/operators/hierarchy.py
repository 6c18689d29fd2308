"""Recursive hierarchy resolution (D2), by pointer doubling.

Every row starts with its own piece of path and a pointer to its parent. In a
round each unfinished row takes over the piece and the pointer of the row it
points at, so pieces double in length: a tree of n levels takes log2(n) rounds
of one distributed join each. A round is written once to the shared scratch
folder and replaces the one before; the driver learns counts, never rows.

Nodes that are not reachable from a root (children of a filtered-out parent,
cycles) do not appear, as in the reference; ``unreachable_nodes`` reports them.
Any depth is resolved; an id that is its own ancestor below a root raises.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import remove_path, scratch_dir


class HierarchyCycleError(RuntimeError):
    pass


HierarchyDepthError = HierarchyCycleError


def resolve_hierarchy(df: DataFrame, id_col: str = "categorie_id",
                      parent_col: str = "categorie_parent_id",
                      label_col: str = "nom_categorie", sep: str = " > ",
                      max_depth: int | None = None,
                      path_col: str = "chemin_complet", root_col: str = "id_racine") -> DataFrame:
    """``df``'s rows that hang below a root, with their path of labels (null
    below a null label) and their root's id. Rows of one id are each a node,
    and a child of that id hangs below each of them. An id that stands on its
    own path (duplicate ids that loop) raises; ``max_depth``, when given,
    raises on a deeper tree."""
    spark, cols = df.sparkSession, df.columns
    base = scratch_dir(spark, f"hierarchy-{uuid.uuid4().hex}")

    def written(rows: DataFrame, number: int) -> DataFrame:
        rows.write.parquet(f"{base}/{number}")
        return spark.read.schema(rows.schema).parquet(f"{base}/{number}")

    now = written(df.select(*cols, F.array(label_col).alias("_labels"), F.array(id_col).alias("_ids"),
                            F.col(parent_col).alias("_next")), 0)
    looped = F.size(F.array_distinct("_ids")) < F.size("_ids")
    finished, number = F.col("_next").isNull(), 0
    while True:
        found = now.agg(F.count(F.when(~finished, 1)).alias("left"), F.max(F.when(finished & looped, F.col(id_col))).alias("loop"),
                        F.max(F.when(finished, F.size("_ids"))).alias("depth")).first()
        if found["loop"] is not None:
            raise HierarchyCycleError(f"{id_col} {found['loop']} is its own ancestor")
        if max_depth is not None and (found["depth"] or 0) > max_depth:
            raise HierarchyDepthError(f"hierarchy deeper than max_depth={max_depth}")
        if not found["left"]:
            break
        above = now.select(F.col(id_col).alias("_a_id"), F.col("_labels").alias("_a_labels"), F.col("_ids").alias("_a_ids"),
                           F.col("_next").alias("_a_next"))
        joined = now.where(~finished).join(above, F.col("_next") == F.col("_a_id")).select(
            *cols, F.concat("_a_labels", "_labels").alias("_labels"), F.concat("_a_ids", "_ids").alias("_ids"),
            F.col("_a_next").alias("_next"))
        # what loops without a root stays out; a loop below a root shows when it is finished
        number += 1
        after = written(now.where(finished).unionByName(joined.where(finished | ~looped)), number)
        remove_path(spark, f"{base}/{number - 1}")
        now = after
    path = F.when(~F.exists("_labels", lambda x: x.isNull()), F.array_join("_labels", sep))
    return now.select(*cols, path.alias(path_col), F.col("_ids")[0].alias(root_col))


def dim_categories(stg_categories: DataFrame, max_depth: int | None = None) -> DataFrame:
    src = stg_categories.select("categorie_id", "nom_categorie", "type_categorie", "groupe",
                                "categorie_parent_id", "niveau_hierarchique")
    return resolve_hierarchy(src, max_depth=max_depth).select(
        "categorie_id", "nom_categorie", "type_categorie", "groupe", "categorie_parent_id",
        "niveau_hierarchique", "chemin_complet", "id_racine")


def unreachable_nodes(df: DataFrame, resolved: DataFrame, id_col: str = "categorie_id") -> DataFrame:
    """Rows of ``df`` missing from the resolved hierarchy (orphans, cycles)."""
    return df.join(resolved.select(id_col), id_col, "left_anti")
