"""Where two exports differ: stored rows by hash prefix, a tree of multiset digests over them, compared top down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.fingerprint import row_hash

_BASE = 16  # children of a node


def _prefix(part: Column, digits: int, level: int) -> Column:
    """The ancestor of a leaf at a level of the tree; level 0 is the root."""
    return F.shiftright(part, 4 * (digits - level))


def store_arm(rows: DataFrame, cols: list[str], path: str, digits: int = 2) -> None:
    """Write an arm so that it can be compared: its rows in ``16 ** digits`` folders by hash prefix, and its digest tree.

    Equal rows are stored once with their number (counted inside the tasks first), so a group of copies of any size is
    one line. A node of the tree holds the rows below it and the sum of their hashes, repeats counted, and is the sum of
    its children. Columns are compared by value; NULL equals NULL.
    """
    counted = rows.groupBy(*cols).agg(F.count("*").alias("_rows"))
    hashed = counted.withColumn("_hash", row_hash(*[F.col(c) for c in cols]).cast("decimal(28,0)"))
    leaves = _BASE**digits
    # Hash values are spread evenly, so are the folders; further digits of the hash share a folder among its writers.
    spark = rows.sparkSession
    writers = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // leaves)
    placed = hashed.withColumn("_part", F.pmod("_hash", F.lit(leaves)).cast("int"))
    share = F.pmod(F.floor(F.col("_hash") / leaves), F.lit(writers))
    placed.repartition(F.col("_part"), share).write.partitionBy("_part").parquet(f"{path}/rows")
    # The hash was stored with the rows, so the tree reads two narrow columns.
    stored = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    node = F.explode(
        F.array(*[F.struct(F.lit(level).alias("level"), _prefix(F.col("_part"), digits, level).alias("node")) for level in range(digits + 1)])
    )
    per_leaf = stored.groupBy("_part").agg(
        F.sum("_rows").alias("rows"), F.sum((F.col("_hash") * F.col("_rows")).cast("decimal(38,0)")).alias("digest")
    )
    tree = per_leaf.select(node.alias("n"), "rows", "digest").groupBy("n.level", "n.node").agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))
    tree.coalesce(1).write.parquet(f"{path}/tree")  # at most 1.07 times 16 ** digits short lines


def differing_parts(spark: SparkSession, first: str, second: str, digits: int = 2) -> list[int]:
    """The hash prefixes whose digests differ, found from the root down: only children of differing nodes are compared."""
    schema = "level int, node int, rows bigint, digest decimal(38,0)"
    one, other = (spark.read.schema(schema).parquet(f"{path}/tree") for path in (first, second))
    open_nodes = [0]
    for level in range(digits + 1):
        here = [
            t.filter((F.col("level") == level) & F.col("node").isin(open_nodes)).select("node", F.struct("rows", "digest").alias(name))
            for t, name in ((one, "a"), (other, "b"))
        ]
        both = here[0].join(here[1], "node", "full").filter(~F.col("a").eqNullSafe(F.col("b")))
        differing = sorted(r.node for r in both.select("node").collect())  # at most 16 ** digits numbers
        if not differing or level == digits:
            return differing
        open_nodes = [node * _BASE + child for node in differing for child in range(_BASE)]
    return []


def compare_stored(spark: SparkSession, first: str, second: str, schema: str, digits: int = 2) -> DataFrame:
    """The rows that two stored arms do not share: their columns, ``change`` (added or removed) and ``rows``, how many.

    ``schema`` names the compared columns. Only folders whose digests differ are scanned; equal arms read no row at all.
    """
    parts = differing_parts(spark, first, second, digits)

    def signed(path: str, sign: int) -> DataFrame:
        stored = spark.read.schema(f"{schema}, _rows bigint, _part int").parquet(f"{path}/rows")
        return stored.filter(F.col("_part").isin(parts)).withColumn("_rows", F.lit(sign) * F.col("_rows")).drop("_part")

    both = signed(first, -1).unionByName(signed(second, 1))
    cols = [c for c in both.columns if c != "_rows"]
    net = both.groupBy(*cols).agg(F.sum("_rows").alias("_net")).filter("_net != 0")
    change = F.when(F.col("_net") > 0, "added").otherwise("removed")
    return net.select(*cols, change.alias("change"), F.abs("_net").alias("rows"))
