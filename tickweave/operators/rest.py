"""JSON order-book snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decode_rest(frames: DataFrame, payload: str = "payload", first: int | None = None) -> DataFrame:
    """frames' other columns, valid, last_update_id, n_bids, n_asks, has_bids, has_asks, bids, asks (arrays of [price, qty] text).

    Bad JSON isn't valid and has id 0 and no levels; a missing or odd id reads as 0, a side that is no
    array as empty; a cell that isn't text as '?'; a level that is no array is left out.
    first: only each side's first levels, by place, are looked at. has_<side>: the side is an array.
    """
    rest = [c for c in frames.columns if c != payload]
    out = frames.withColumn("_v", F.try_parse_json(F.col(payload).cast("string")))
    for side in ("bids", "asks"):
        out = out.withColumn(f"_{side}", F.expr(f"try_variant_get(_v, '$.{side}', 'array<variant>')"))
    cell = "CASE WHEN startswith(schema_of_variant(variant_get(x, '$[{i}]', 'variant')), 'STRING') THEN try_variant_get(x, '$[{i}]', 'string') ELSE '?' END"
    levels = "coalesce(transform(filter({s}, x -> startswith(schema_of_variant(x), 'ARRAY')), x -> array(" + cell.format(i=0) + ", " + cell.format(i=1) + ")), array())"
    number = "schema_of_variant(try_variant_get(_v, '$.lastUpdateId', 'variant')) rlike '^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL.*,0.*)'"
    return out.select(
        *rest, F.col("_v").isNotNull().alias("valid"),
        F.expr(f"coalesce(CASE WHEN {number} THEN greatest(try_variant_get(_v, '$.lastUpdateId', 'decimal(20,0)'), 0) END, 0)").alias("last_update_id"),
        F.coalesce(F.array_size("_bids"), F.lit(0)).alias("n_bids"), F.coalesce(F.array_size("_asks"), F.lit(0)).alias("n_asks"),
        *(F.col(f"_{s}").isNotNull().alias(f"has_{s}") for s in ("bids", "asks")),
        *(F.expr(levels.format(s=f"slice(_{s}, 1, {first})" if first else f"_{s}")).alias(s) for s in ("bids", "asks")),
    )
