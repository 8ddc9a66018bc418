"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Groups (equal texts) go to the shard where the dot product of the group's
(bytes, tokens, rows) with the shard's residual capacity is highest, large
groups first.  Placing is sequential, so it runs over a bounded list of items:

* a group above ``1 / HEAVY`` of a shard's capacity is an item of its own; there
  are at most 3 * shards * HEAVY of them, whatever the input;
* the other groups are bundled by hash into ``BUNDLES`` items;
* a group above a whole shard's capacity cannot stay together: hashes of its
  rows cut it into pieces of about an eighth of a shard (at most 3 * shards such
  groups).

Group totals are aggregated by Spark before they meet; only the items' sums
reach the driver, and the (item, shard) table goes back as a broadcast of
bounded size.

Defined results: a null text has size 1 and CRC 0, and all null texts are one
group, apart from empty ones; null ids and repeated rows are placed like others;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import word_array
from courtline.llm.ranks import number_within
from courtline.session import materialize

HEAVY = 256
BUNDLES = 16_384
PIECES_PER_SHARD = 8

DIMENSIONS = ("bytes", "tokens", "n")


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item.  ``items`` has a row (bytes, tokens, rows) each.

    Loads are measured in shares of a shard's capacity, which is the total over
    ``shards``.  Items go in order of their largest share.  Among the shards
    where an item fits, the highest dot product with the residual wins; if it
    fits nowhere, that rule holds over all shards with the residual that is
    left, which then sends it to the emptiest.  Ties go to the lowest shard.
    """
    total = items.sum(axis=0, dtype=np.float64)
    share = items * shards / np.where(total > 0, total, 1)
    left = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), np.int64)
    for i in np.argsort(-share.max(axis=1, initial=0), kind="stable"):
        score = left @ share[i]
        fits = (left + 1e-9 >= share[i]).all(axis=1)
        if fits.any():
            score = np.where(fits, score, -np.inf)
        out[i] = k = int(score.argmax())
        left[k] -= share[i]
    return out


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            tokens: Column | None = None) -> DataFrame:
    """doc_id, bytes (plus 1), tokens, text_crc32 and the group of each row."""
    t = F.col(text)
    tokens = F.size(word_array(F.coalesce(t, F.lit("")))) if tokens is None else tokens
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("bytes"),
        tokens.cast("long").alias("tokens"),
        F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(t, t.isNull()).alias("group"))


def shard_documents(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text",
                    tokens: Column | None = None) -> DataFrame:
    """One row per document: doc_id, bytes, tokens, text_crc32, group, shard and
    ``slot``, gapless from 0 within the shard."""
    spark = docs.sparkSession
    rows = materialize(measure(docs, doc_id, text, tokens), "measured")
    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"),
            F.count(F.lit(1)).alias("n")]
    groups = materialize(rows.groupBy("group").agg(*sums), "groups")
    total = groups.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in DIMENSIONS)).first()

    def above(share: float) -> Column:
        """Groups with more than ``share`` of a shard in some dimension."""
        return F.greatest(*(F.col(c) * F.lit(shards) / F.lit(max(total[c], 1))
                            for c in DIMENSIONS)) > share

    split = [r["group"] for r in groups.filter(above(1)).select("group").collect()]
    piece_count = max(1, shards * PIECES_PER_SHARD)
    piece = F.pmod(F.xxhash64("doc_id", "group"), F.lit(piece_count))
    kept_whole = ~F.col("group").isin(split) if split else F.lit(True)
    bundle = F.pmod(F.col("group"), F.lit(BUNDLES))

    # kind 0: bundles, 1: heavy groups, 2: pieces of split groups
    heavy = groups.filter(above(1 / HEAVY) & kept_whole).select(
        F.lit(1).alias("kind"), F.col("group").alias("item"), F.lit(0).cast("long").alias("piece"),
        *DIMENSIONS)
    light = groups.filter(~above(1 / HEAVY)).groupBy(bundle.alias("item")).agg(
        *(F.sum(c).alias(c) for c in DIMENSIONS)).select(
        F.lit(0).alias("kind"), "item", F.lit(0).cast("long").alias("piece"), *DIMENSIONS)
    pieces = rows.filter(~kept_whole).groupBy(F.col("group").alias("item"), piece.alias("piece")).agg(
        *sums).select(F.lit(2).alias("kind"), "item", "piece", *DIMENSIONS)
    items = heavy.unionByName(light).unionByName(pieces).collect()
    items.sort(key=lambda r: (r["kind"], r["item"], r["piece"]))
    where = place(np.array([[r[c] for c in DIMENSIONS] for r in items],
                           np.float64).reshape(-1, len(DIMENSIONS)), shards)
    table = spark.createDataFrame(
        [(r["kind"], r["item"], r["piece"], int(k)) for r, k in zip(items, where, strict=True)],
        "kind int, item long, item_piece long, shard int")

    # a group is heavy iff the table lists it, so light rows fall through to bundles
    own = F.broadcast(table.filter("kind = 1").select(F.col("item").alias("group"),
                                                      F.col("shard").alias("own_shard")))
    bundles = F.broadcast(table.filter("kind = 0").select(F.col("item").alias("bundle"),
                                                          F.col("shard").alias("bundle_shard")))
    cut = F.broadcast(table.filter("kind = 2").select(F.col("item").alias("group"),
                                                      F.col("item_piece").alias("piece"),
                                                      F.col("shard").alias("piece_shard")))
    placed = (rows.withColumn("bundle", bundle).withColumn("piece", piece)
              .join(own, "group", "left").join(cut, ["group", "piece"], "left")
              .join(bundles, "bundle", "left")
              .withColumn("shard", F.coalesce("own_shard", "piece_shard", "bundle_shard"))
              .select("doc_id", "bytes", "tokens", "text_crc32", "group", "shard"))
    return number_within(placed, "shard", ["doc_id", "group", "bytes"], "slot", total["n"])
