"""Connected components of a link table, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.tables import released, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has a link.

    Each round every id takes the smallest label among itself, its neighbours and its label's own
    label; labels and links stay distributed and are written each round. Rounds grow with the
    logarithm of the longest path in practice. Repeated and reversed links and loops do no harm.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = written(both.union(both.select("y", "x")).where("x <> y").distinct(), "links")
    table = written(both.groupBy(F.col("x").alias("id")).agg(F.least(F.min("y"), F.col("x")).alias("component")), "labels")
    label = table
    while True:
        near = both.join(label, both["y"] == label["id"]).groupBy(F.col("x").alias("id")).agg(F.min("component").alias("near"))
        new = label.join(near, "id").select("id", "component", F.least("component", "near").alias("new"))
        # Roots learn what their members have seen, and members jump to their root's label.
        told = new.groupBy(F.col("component").alias("id")).agg(F.min("new").alias("told"))
        new = new.join(told, "id", "left").select("id", "component", F.least("new", F.coalesce("told", "new")).alias("new"))
        new = written(new, "labels")
        jump = new.select(F.col("id").alias("new"), F.col("new").alias("jumped"))
        after = written(
            new.join(jump, "new", "left").select("id", F.col("component").alias("old"), F.least("new", F.coalesce("jumped", "new")).alias("component")),
            "labels",
        )
        released(table, new)
        table, label = after, after.select("id", "component")
        if after.where("old <> component").isEmpty():
            released(both)
            return label
