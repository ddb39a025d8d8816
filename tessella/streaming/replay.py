"""The replay pool: a bounded store of earlier items from which later ones are swapped.

The first ``pool_size`` items are stored and returned. After that, an item with p > 0.5 returns what its slot holds and
takes its place; any other item is returned itself. As the slot and p of every item are columns, what an item returns is
the item that wrote its slot last: a lag over the slot's writers, in parallel by slot.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def replay(items: DataFrame, pool_size: int, seq: str = "seq", value: str = "item", p: str = "p", slot: str = "slot") -> DataFrame:
    """Items with ``returned``. ``seq`` is dense from 0, ``slot`` uniform below the pool size."""
    if pool_size == 0:
        return items.withColumn("returned", F.col(value))
    fill = F.col(seq) < pool_size
    own_slot = F.when(fill, F.col(seq)).otherwise(F.col(slot)).cast("long")
    marked = items.withColumn("_slot", own_slot).withColumn("_writes", fill | (F.col(p) > 0.5))
    last = F.lag(value).over(Window.partitionBy("_slot").orderBy(seq))
    writers = marked.filter("_writes").withColumn("_last", last)
    swapped = writers.withColumn("returned", F.when(F.col(seq) < pool_size, F.col(value)).otherwise(F.col("_last")))
    others = marked.filter("NOT _writes").withColumn("returned", F.col(value))
    return swapped.drop("_last").unionByName(others).drop("_slot", "_writes")


def replay_stream(items: DataFrame, pool_size: int, key: str) -> DataFrame:
    """The pool as a stateful stream operator, one pool for each key; items (key, seq, item, p, slot) of a batch go in order of seq.

    State is at most ``pool_size`` items for each key.
    """

    def update(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pool = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for r in rows.itertuples(index=False):
            if pool_size == 0:
                back = r.item
            elif len(pool) < pool_size:
                pool.append(r.item)
                back = r.item
            elif r.p > 0.5:
                back, pool[int(r.slot)] = pool[int(r.slot)], r.item
            else:
                back = r.item
            out.append((group[0], r.seq, back))
        state.update((pool,))
        yield pd.DataFrame(out, columns=[key, "seq", "returned"])

    kind = items.schema["item"].dataType.simpleString()
    key_type = items.schema[key].dataType.simpleString()
    return items.groupBy(key).applyInPandasWithState(
        update, f"{key} {key_type}, seq long, returned {kind}", f"pool array<{kind}>", "append", GroupStateTimeout.NoTimeout
    )


def first_in_epoch(steps: DataFrame, epoch: str = "epoch", order: str = "total_iters") -> DataFrame:
    """Steps with ``saved``: whether an earlier step of the same epoch exists, so that per-epoch flags start anew."""
    return steps.withColumn("saved", F.row_number().over(Window.partitionBy(epoch).orderBy(order)) > 1)
