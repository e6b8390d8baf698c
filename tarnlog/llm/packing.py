"""Pack items into containers of fixed capacity by best-fit decreasing.

Items are spread over shards by a hash, so a shard holds a like share of every length; the
number of shards follows the total size and the number of items. A shard is packed on its own: in order of falling
size, each item goes into the open bin with the least room that still holds it. The open bins
stand in a segment tree over remaining capacities (a leaf for each possible remainder counts
its bins, an inner node sums its leaves), so the tightest bin is found in O(log capacity). Only
the last bins of a shard can stay poorly filled: with ``shard_tokens`` far above the capacity
the loss is a fraction of ``capacity / shard_tokens``.

An item longer than the capacity is cut into full containers and a rest; the rest is packed
like any item. Defined results: null ids are kept; sizes that are null count as 0; items of size
0 take no room and go into the tightest bin of their shard. Repeated rows are separate items.
Capacities that are null or below 1 hold nothing and are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlog.runtime import cut

#: Tokens and items that one task packs; they bound a task's memory and time at any corpus size.
SHARD_TOKENS, SHARD_ITEMS = 1 << 25, 1 << 20


class RoomTree:
    """Segment tree over the remainders 0..capacity of open bins."""

    def __init__(self, capacity: int):
        self.leaves = 1 << max(1, capacity.bit_length())
        self.count = [0] * (2 * self.leaves)
        self.bins: dict[int, list[int]] = {}

    def put(self, room: int, bin_no: int) -> None:
        self.bins.setdefault(room, []).append(bin_no)
        i = self.leaves + room
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, bin) of the tightest open bin with at least ``least`` room, removed."""
        count, leaves = self.count, self.leaves
        i = leaves + least
        if not count[i]:
            # climb until a right sibling holds bins, then descend to its first leaf
            while True:
                if i == 1:
                    return None
                if not i & 1 and count[i + 1]:
                    i += 1
                    break
                i >>= 1
            while i < leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - leaves
        bin_no = self.bins[room].pop()
        while i:
            count[i] -= 1
            i >>= 1
        return room, bin_no


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item; every size is within the capacity."""
    tree, out, n = RoomTree(capacity), np.empty(len(sizes), dtype=np.int64), 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        found = tree.take(size)
        if found is None:
            room, b, n = capacity, n, n + 1
        else:
            room, b = found
        out[k] = b
        tree.put(room - size, b)
    return out


def pack(items: DataFrame, capacities: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", shard_tokens: int = SHARD_TOKENS, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``size_name, capacity, container, doc_id, piece, start, n_tokens``: one row per piece.

    ``capacities`` (``size_name, capacity_tokens``) is a short list. ``items`` is read twice, so
    hand over a table or a checkpoint.
    """
    caps = capacities.select("size_name", F.col("capacity_tokens").cast("long").alias("capacity")).where("capacity >= 1").distinct()
    sized = items.select(F.col(id_col).alias("doc_id"), F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    total, n = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    # items without a size take a place in a shard too
    shards = int(max(total // shard_tokens, n // shard_items)) + 1
    # capacities are few by contract: the pairs are items x a short list, made without a join
    names = [(r["size_name"], r["capacity"]) for r in caps.limit(10_001).collect()]
    if len(names) > 10_000:
        raise ValueError("the list of capacities is meant to be short")
    if not names:
        return _empty(items, id_col)
    listed = F.array(*[F.struct(F.lit(n).cast("string").alias("size_name"), F.lit(c).cast("long").alias("capacity")) for n, c in names])
    # tells repeated rows apart; the items are a table or checkpoint, so the numbers are stable
    sized = sized.withColumn("item", F.monotonically_increasing_id())
    each = sized.select("item", "doc_id", "size", F.explode(listed).alias("c")).select("item", "doc_id", "size", "c.size_name", "c.capacity")
    full = F.expr("size div capacity")
    whole = (
        each.where(F.col("size") >= F.col("capacity"))
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), full)).alias("piece"))
        .select(
            "size_name",
            "capacity",
            F.concat_ws("-", F.lit("w"), F.col("item").cast("string"), F.col("piece").cast("string")).alias("container"),
            "doc_id",
            "piece",
            ((F.col("piece") - 1) * F.col("capacity")).alias("start"),
            F.col("capacity").alias("n_tokens"),
        )
    )
    rest = each.select("item", "doc_id", "size_name", "capacity", full.alias("cuts"), F.expr("size % capacity").alias("n_tokens")).where("n_tokens > 0 or cuts = 0")
    # items without an id, or with one that is repeated, are spread by their number too
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "item"), F.lit(shards)).cast("long"))

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        size_name, capacity, shard = key
        pdf = pdf.sort_values(["n_tokens", "doc_id", "cuts"], ascending=[False, True, True], kind="stable")
        bins = best_fit_decreasing(pdf["n_tokens"].to_numpy(), int(capacity))
        cuts = pdf["cuts"].to_numpy()
        return pd.DataFrame(
            {
                "size_name": size_name,
                "capacity": capacity,
                "container": [f"b-{shard}-{b}" for b in bins.tolist()],
                "doc_id": pdf["doc_id"].to_numpy(),
                "piece": cuts + 1,
                "start": cuts * int(capacity),
                "n_tokens": pdf["n_tokens"].to_numpy(),
            }
        )

    packed = rest.groupBy("size_name", "capacity", "shard").applyInPandas(one, whole.schema)
    return whole.unionByName(packed)


def _empty(items: DataFrame, id_col: str) -> DataFrame:
    kind = items.schema[id_col].dataType.simpleString()
    return items.sparkSession.createDataFrame([], f"size_name string, capacity long, container string, doc_id {kind}, piece long, start long, n_tokens long")


def pack_documents(documents: DataFrame, capacities: DataFrame, vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pack the texts of ``documents`` (``doc_id, text``), measured in tokens."""
    from tarnlog.llm.bpe import token_counts

    return pack(cut(token_counts(documents, vocabulary=vocabulary)), capacities, shard_tokens=shard_tokens)


def fill_report(packed: DataFrame) -> DataFrame:
    """Per capacity: containers, tokens, the least number of containers possible and the fill."""
    bins = packed.groupBy("size_name", "capacity", "container").agg(F.sum("n_tokens").alias("used"))
    return bins.groupBy("size_name", "capacity").agg(
        F.count("*").alias("containers"),
        F.sum("used").alias("tokens"),
        F.ceil(F.sum("used") / F.first("capacity")).alias("least_containers"),
        F.max("used").alias("fullest"),
        (F.sum("used") / (F.count("*") * F.first("capacity"))).alias("fill"),
    )


def violations(packed: DataFrame, sizes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``size_name, capacity, docs, fits, whole`` of a packing; what must hold for any.

    ``fits``: no container is over its capacity. ``whole``: every document of ``sizes`` (``doc_id,
    n_tokens``, one row an id) is there with all its tokens, in as few pieces as its size allows.
    """
    used = packed.groupBy("size_name", "capacity", "container").agg(F.sum("n_tokens").alias("used")).groupBy("size_name", "capacity").agg(F.max("used").alias("fullest"))
    each = packed.groupBy("size_name", "capacity", "doc_id").agg(F.sum("n_tokens").alias("packed"), F.count(F.lit(1)).alias("pieces"), F.max(F.col("start") + F.col("n_tokens")).alias("end"))
    want = sizes.select(F.col(id_col).alias("id"), F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("size"))
    same = each.join(want, F.col("doc_id").eqNullSafe(F.col("id")))
    right = (F.col("packed") == F.col("size")) & (F.col("end") == F.col("size")) & (F.col("pieces") == F.greatest(F.ceil(F.col("size") / F.col("capacity")), F.lit(1)))
    docs = same.groupBy("size_name", "capacity").agg(F.count(F.lit(1)).alias("docs"), F.min(right).alias("whole"))
    return docs.join(used, ["size_name", "capacity"]).select("size_name", "capacity", "docs", (F.col("fullest") <= F.col("capacity")).alias("fits"), "whole")
