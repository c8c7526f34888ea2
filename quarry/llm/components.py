"""Connected components as DataFrame jobs, and blocks of hot buckets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id of the undirected ``edges (u, v)``;
    the component is the smallest id reachable.

    Alternating large-star and small-star steps: each round hooks neighbours
    to the smallest neighbour, so long chains shorten geometrically.  Every
    round is a few joins and aggregates written to the shared folder; nothing
    is collected.  Self links and null ids are ignored; repeated links are
    merged."""
    ends = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    stars = materialize(ends.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(), "links")
    while not _are_stars(stars):
        # large star: every neighbour above x is linked to the smallest of x and its neighbours
        both = stars.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
            stars.select(F.col("b").alias("x"), F.col("a").alias("y"))
        )
        least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = both.join(least, "x").where("y > x AND y <> m").select(F.col("y").alias("a"), F.col("m").alias("b"))
        # small star: a and its smaller neighbours are linked to the smallest of them
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.join(lowest, "a").select(F.explode(ends).alias("e")).select("e.a", "e.b")
        after = materialize(small.where("a <> b").distinct(), "links")
        discard(stars)
        stars = after
    roots = stars.select("b").distinct()
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select(F.col("b").alias("id"), F.col("b").alias("component"))
    )


def _are_stars(links: DataFrame) -> bool:
    """True if every id is either linked once, to a smaller one, or a centre."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("n")), F.struct(F.col("b").alias("id"), F.lit(0).alias("n")))).alias("e"))
    seen = ends.groupBy("e.id").agg(F.sum("e.n").alias("links"), F.min("e.n").alias("leaf"))
    return seen.where("links > 1 OR (links = 1 AND leaf = 0)").isEmpty()


def spanning_links(u: Iterable[int], v: Iterable[int], parent: dict[int, int]) -> list[int]:
    """Positions of the links (u, v) that join two trees of ``parent``, which
    is updated: a small helper inside tasks."""

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for at, (a, b) in enumerate(zip(u, v)):
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            out.append(at)
    return out


def bucket_cells(members: DataFrame, bucket: list[str], ident: str, block_rows: int) -> DataFrame:
    """``deal_cells``, partitioned and sorted by cell."""
    return by_cell(deal_cells(members, bucket, ident, block_rows), bucket)


def by_cell(rows: DataFrame, bucket: list[str]) -> DataFrame:
    """Rows of ``deal_cells`` partitioned and sorted by cell."""
    keys = [*bucket, "cell_a", "cell_b"]
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def deal_cells(members: DataFrame, bucket: list[str], ident: str, block_rows: int) -> DataFrame:
    """Give every member of a bucket the comparisons it takes part in.

    A bucket of at most ``block_rows`` members is one cell.  A larger one is
    dealt by hash into blocks of about that size, and its members are copied
    to every cell (block, block), so each pair of members meets in exactly
    one cell and no task holds more than about two blocks.  Buckets of one
    member are dropped.  Adds ``block, cell_a, cell_b``; in a cell of two
    different blocks only members of different blocks are to be compared."""
    sizes = members.groupBy(*bucket).agg(F.count(F.lit(1)).alias("bucket_rows")).where("bucket_rows > 1")
    blocks = F.ceil(F.col("bucket_rows") / F.lit(block_rows)).cast("int")
    rows = (
        members.join(sizes, bucket)
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(F.lit(71), F.col(ident)), F.col("blocks").cast("long")).cast("int"))
    )
    cells = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(F.col("block"), j).alias("a"), F.greatest(F.col("block"), j).alias("b")),
    )
    rows = rows.withColumn("cell", F.explode(cells))
    return rows.select("*", F.col("cell.a").alias("cell_a"), F.col("cell.b").alias("cell_b")).drop("cell", "blocks", "bucket_rows")
