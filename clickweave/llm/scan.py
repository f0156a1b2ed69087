"""Running sums over a sorted table, across partitions.

The rows are range-partitioned and sorted by (group, order). Every partition
streams its rows and adds up; the group that is open where it ends goes on in
the next one. One row for each partition, with the sums of its last group,
reaches the driver, which gives every partition what earlier ones carry into
it. So a group may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.common import checkpoint, shuffle_partitions


def _sums(batches: Iterator[pa.RecordBatch], group: list[str], values: list[str]) -> Iterator[pa.RecordBatch]:
    """Adds sum_0.. (of the group's rows of this partition up to this one), part_
    and total_ (true for one more row at the end: key and sums of the last group)."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    last, carried, whole, schema = None, np.zeros(len(values), np.int64), True, None
    for b in batches:
        schema, n = b.schema, b.num_rows
        if not n:
            continue
        keys = [b.column(g).to_numpy() for g in group]
        new = np.zeros(n, bool)
        new[0] = last is not None and any(k[0] != x for k, x in zip(keys, last))
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        whole = whole and not new.any()
        begin = np.flatnonzero(new)
        run = np.cumsum(new)  # 0: the group that was open before this batch
        sums = []
        for i, v in enumerate(values):
            x = b.column(v).to_numpy().astype(np.int64)
            total = np.cumsum(x)
            before = np.concatenate([[-carried[i]], total[begin] - x[begin]])
            sums.append(total - before[run])
        carried = np.array([s[-1] for s in sums], np.int64)
        last = [k[-1] for k in keys]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, *(pa.array(s) for s in sums), pa.array(np.full(n, part, np.int32)), pa.array(np.zeros(n, bool)),
             pa.array(np.zeros(n, bool))],
            [*schema.names, *(f"sum_{i}" for i in range(len(values))), "part_", "total_", "whole_"])
    if last is not None:
        key = dict(zip(group, last))
        cells = [pa.array([key[f.name]], f.type) if f.name in key else pa.nulls(1, f.type) for f in schema]
        yield pa.RecordBatch.from_arrays(
            [*cells, *(pa.array([c], pa.int64()) for c in carried), pa.array([part], pa.int32()), pa.array([True]), pa.array([whole])],
            [*schema.names, *(f"sum_{i}" for i in range(len(values))), "part_", "total_", "whole_"])


def running_sums(rows: DataFrame, group: list[str], order: list, values: dict[str, str]) -> DataFrame:
    """Adds for each ``name: column`` of ``values`` the sum of that column over
    the rows of the same group up to and with this one, in this order.

    ``group``: long columns without nulls (none: all rows are one group);
    ``order``: columns of any type; rows equal in them come in any order.
    Values are whole numbers without nulls. An empty table stays empty.
    """
    spark = rows.sparkSession
    names, columns = list(values), list(values.values())
    by = [*(F.col(g) for g in group), *order]
    ranged = rows.repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by)
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields]
    fields += [T.StructField(f"sum_{i}", T.LongType()) for i in range(len(names))]
    fields += [T.StructField("part_", T.IntegerType()), T.StructField("total_", T.BooleanType()), T.StructField("whole_", T.BooleanType())]
    done = checkpoint(ranged.mapInArrow(partial(_sums, group=group, values=columns), T.StructType(fields)))
    sums = [f"sum_{i}" for i in range(len(names))]
    carry, known = None, []
    for r in sorted(done.where("total_").select("part_", "whole_", *group, *sums).collect(), key=lambda r: r["part_"]):
        key, own = [r[g] for g in group], [r[s] for s in sums]
        if carry is not None:
            known.append((r["part_"], *carry[0], *carry[1]))
            if r["whole_"] and carry[0] == key:
                own = [a + b for a, b in zip(own, carry[1])]
        carry = (key, own)
    ddl = ", ".join(["part_ int", *(f"{g} long" for g in group), *(f"carry_{i} long" for i in range(len(names)))])
    offsets = spark.createDataFrame(known, ddl)  # one row for each partition
    out = done.where("not total_").join(F.broadcast(offsets), ["part_", *group], "left")
    return out.select(*rows.columns, *[(F.col(s) + F.coalesce(f"carry_{i}", F.lit(0))).alias(n)
                                       for i, (s, n) in enumerate(zip(sums, names))])
