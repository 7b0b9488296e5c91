"""Users with very many items: their products are dealt out in tiles."""

import random

import numpy as np
import pytest

from wayfare.operators import recommend as rec


@pytest.mark.parametrize("tile", [3, 7, 1000])
def test_tiles_give_the_same_products(spark, tile):
    rnd = random.Random(4)
    pairs = [(u, f"h{h}", rnd.randint(1, 5)) for u in range(25) for h in rnd.sample(range(30), rnd.choice([1, 2, 5, 30]))]
    history = spark.createDataFrame(pairs, "user long, hotel string, bookings long")
    want: dict = {}
    for u, a, x in pairs:
        for v, b, y in pairs:
            if u == v:
                want[a, b] = want.get((a, b), 0) + x * y
    assert {(r["a"], r["b"]): r["dot"] for r in rec.item_dots(history, tile).collect()} == want


def test_no_row_grows_with_a_heavy_user(spark):
    history = spark.range(50_000).selectExpr("1L as user", "concat('h', id) as hotel", "1L as bookings")
    tiles = rec._tiles(history, rec.TILE)
    sizes = np.array(tiles.selectExpr("size(a) as a", "size(b) as b").toPandas())
    assert sizes.prod(axis=1).sum() == 50_000 ** 2 and sizes.max() < 1.3 * rec.TILE and len(sizes) == 625
    assert tiles.rdd.getNumPartitions() > 1


def test_empty_history(spark):
    assert rec.item_dots(spark.createDataFrame([], "user long, hotel string, bookings long")).count() == 0
