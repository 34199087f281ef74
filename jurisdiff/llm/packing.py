"""Filling containers of fixed capacity with documents: bound-certified repacking.

Documents are packed partition by partition with best-fit decreasing. Dual
feasible functions give a lower bound on the containers any packing of a
partition's documents needs; a partition that meets its bound is certified and
final but for its one least filled container. The others keep their well-filled
containers. What is left over is exchanged, partition with partition, and packed
again, for a few rounds or until one partition holds it all. Partitions are of
bounded size, so no task grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurisdiff.llm.tokens import DEFAULT_TOKENIZER, clean, encoding
from jurisdiff.session import materialize

CAPACITY = 4096
#: Documents a partition holds; what one task sorts and packs.
ITEMS_A_PARTITION = 20_000
ROUNDS = 3
#: A container filled to this share of the capacity stays as it is in an exchange.
KEPT_FILL = 0.995


def lower_bound(sizes: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """No packing of the sizes (each 1..capacity, as often as counts says) needs fewer containers: the best of two families of dual feasible functions."""
    if not len(sizes):
        return 0
    order = np.argsort(sizes, kind="stable")
    x = np.asarray(sizes, dtype=np.int64)[order]
    many = np.ones(len(x), np.int64) if counts is None else np.asarray(counts, dtype=np.int64)[order]
    total, number = np.r_[0, np.cumsum(x * many)], np.r_[0, np.cumsum(many)]
    best = -(-int(total[-1]) // capacity)
    # Sizes under e count nothing, those over capacity - e count as the whole capacity.
    for e in np.unique(x[x <= capacity // 2]):
        lo, hi = np.searchsorted(x, e, "left"), np.searchsorted(x, capacity - e, "right")
        best = max(best, int(-(-(int(total[hi] - total[lo]) + int(number[-1] - number[hi]) * capacity) // capacity)))
    best = max(best, int(many[x > capacity // 2].sum()))
    # Rounded to parts of 1 / k, which favours sizes just over such a part.
    for k in range(2, 12):
        scaled = x * (k + 1)
        exact = scaled % capacity == 0
        value = np.where(exact, x * k, (scaled // capacity) * capacity)
        best = max(best, int(-(-int((value * many).sum()) // (capacity * k))))
    return best


def packing_bounds(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """parts, containers, bound, gap of a packing: how many containers it takes, no fewer than how many any packing of these parts takes, the difference.

    Parts without tokens and containers that hold nothing else don't count.
    There are at most as many sizes as the capacity, so their counts are small.
    """
    sizes = packed.where("tokens > 0").groupBy("tokens").count().orderBy("tokens").collect()
    bound = lower_bound(np.array([r["tokens"] for r in sizes], np.int64), capacity, np.array([r["count"] for r in sizes], np.int64))
    n = packed.where("tokens > 0").agg(F.count("*").alias("parts"), F.count_distinct("container").alias("containers"))
    return n.select("parts", "containers", F.lit(bound).cast("bigint").alias("bound"), (F.col("containers") - F.lit(bound)).alias("gap"))


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each size: the largest first, each where the least room is left that holds it."""
    where = np.zeros(len(sizes), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some container has exactly r left
    n = 0
    for i in np.argsort(-np.asarray(sizes), kind="stable"):
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + ((fitting & -fitting).bit_length() - 1)
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_, n = capacity, n, n + 1
        where[i] = bin_
        left = room - size
        by_room[left].append(bin_)
        rooms |= 1 << left
    return where


def token_sizes(df: DataFrame, doc_id: str, text: str, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """doc_id, tokens of every document; null and empty texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(tokenizer).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tokens": np.fromiter((len(encode(clean(s))) if isinstance(s, str) and s else 0 for s in pdf["text"].tolist()), np.int64, len(pdf))})

    kind = df.select(doc_id).schema[0].dataType.simpleString()
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, f"doc_id {kind}, tokens bigint")


def _pack_partition(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "doc_id", "part"], ascending=[False, True, True]).reset_index(drop=True)
        sizes = pdf["tokens"].to_numpy()
        filled = sizes > 0
        bins = np.zeros(len(sizes), dtype=np.int64)
        if filled.any():
            bins[filled] = best_fit_decreasing(sizes[filled], capacity)
        used = int(bins[filled].max()) + 1 if filled.any() else 1
        fill = np.bincount(bins, sizes, used)
        gap = used - lower_bound(sizes[filled], capacity) if filled.any() else 0
        pdf["bin"], pdf["fill"], pdf["gap"], pdf["loose"] = bins, fill[bins].astype(np.int64), gap, bins == int(fill.argmin())
        return pdf

    return pack


def pack_documents(sizes: DataFrame, capacity: int = CAPACITY, items_a_partition: int = ITEMS_A_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, part, tokens, container, fill: every document in one container, those over the capacity in parts.

    sizes: doc_id, tokens. A document is split only if it exceeds the capacity:
    into full containers and a rest, which is packed like a document (part
    numbers from 0). Documents without tokens take no room but are assigned.
    Repeated rows are packed as many times as they occur. fill is the number
    of tokens in the container.
    """
    parts = sizes.select("doc_id", F.posexplode(F.when(
        F.col("tokens") > capacity,
        F.concat(F.array_repeat(F.lit(capacity).cast("bigint"), F.floor(F.col("tokens") / capacity).cast("int")), F.when(F.col("tokens") % capacity > 0, F.array((F.col("tokens") % capacity).cast("bigint"))).otherwise(F.expr("cast(array() as array<bigint>)"))),
    ).otherwise(F.array(F.coalesce("tokens", F.lit(0)).cast("bigint")))).alias("part", "tokens"))
    parts = materialize(parts, "sizes")
    full = parts.where(F.col("tokens") == capacity).select("doc_id", "part", "tokens", F.concat(F.lit("full-"), F.col("doc_id").cast("string"), F.lit("-"), F.col("part").cast("string"), F.lit("-"), F.monotonically_increasing_id().cast("string")).alias("container"), F.lit(capacity).cast("bigint").alias("fill"))
    rest = parts.where(F.col("tokens") < capacity)
    count = rest.count()
    n = max(1, -(-count // items_a_partition))
    kind = sizes.select("doc_id").schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, part int, tokens bigint, pid bigint, bin bigint, fill bigint, gap bigint, loose boolean"
    spread = lambda df, r: df.withColumn("pid", F.pmod(F.xxhash64("doc_id", "part", F.monotonically_increasing_id(), F.lit(r)), F.lit(n)))  # noqa: E731 - repeated rows part, too; the tables are stored, so the numbers hold
    todo = spread(rest, -1)
    done: list[DataFrame] = [full]
    for r in range(rounds + 1):
        packed = materialize(todo.groupBy("pid").applyInPandas(_pack_partition(capacity), schema), f"packed{r}")
        final = (F.col("fill") >= int(KEPT_FILL * capacity)) | ((F.col("gap") <= 0) & ~F.col("loose"))
        last = n == 1 or r == rounds  # one partition alone has none to exchange with
        if last:
            final = F.lit(True)
        name = F.concat(F.lit(f"{r}-"), F.col("pid").cast("string"), F.lit("-"), F.col("bin").cast("string"))
        done.append(packed.where(final).select("doc_id", "part", "tokens", name.alias("container"), "fill"))
        if last:
            break
        open_items = packed.where(~final)
        n = max(1, -(-open_items.count() // items_a_partition))
        todo = spread(open_items.select("doc_id", "part", "tokens"), r)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
