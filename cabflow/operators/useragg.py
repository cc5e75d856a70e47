"""User aggregates in arrival order: plain functions on a small accumulator.

``UserAggregate`` is the reference's aggregate function, with the ``merge`` that lets
it run in two phases: the rows of a slot (a range of a key's order, see
``scan.slotted``) are added up as they stream by, then a key's accumulators are
merged in the order of their slots.  A hot key is spread over its slots, no task
holds a key's rows, and only accumulators meet.  ``merge`` must be associative and
may depend on the order; ``streaming.timed.JobSessions`` uses the same functions
for sessions that join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.operators.keyed import CONTAINS_PREFIX, CONTAINS_SEP
from cabflow.operators.scan import slotted
from cabflow.session import prepare


@dataclass(frozen=True)
class UserAggregate:
    """``init() -> acc``, ``add(acc, value) -> acc``, ``merge(earlier, later) -> acc`` and
    ``result(acc) -> tuple``; ``acc`` and ``result`` are tuples of the given DDL."""

    init: Callable
    add: Callable
    merge: Callable
    result: Callable
    acc_schema: str
    result_schema: str


def _runs(by: list[str], columns: list[str], start, step, finish, schema: T.StructType):
    """For ``mapInArrow`` over rows sorted by ``by``: one output row for every run of
    equal ``by``, folded as the rows stream by."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow, names = to_arrow_schema(schema), schema.names

    def run(batches):
        import pyarrow as pa

        def batch_of(rows):
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

        now, head, acc, done = None, None, None, []
        for batch in batches:
            groups = list(zip(*(batch.column(c).to_pylist() for c in by))) if by else [()] * batch.num_rows
            for group, row in zip(groups, zip(*(batch.column(c).to_pylist() for c in columns))):
                if head is not None and group == now:
                    acc = step(acc, row)
                    continue
                if head is not None:
                    done.append(finish(head, acc))
                now, head, acc = group, row, start(row)
            if len(done) > 10_000:
                yield batch_of(done)
                done = []
        if head is not None:
            done.append(finish(head, acc))
        if done:
            yield batch_of(done)
    return run


def aggregate_by(df: DataFrame, keys: list[str], order: list[str], value: str, agg: UserAggregate,
                 width: int | None = None) -> DataFrame:
    """The result of ``agg`` over every key's values in ``order``: keys and result columns."""
    prepare(df.sparkSession)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = slotted(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, width)
    place = s.by[len(keys):]
    key_fields, k = [df.schema[c] for c in keys], len(keys)

    # The values of a slot, in order.
    ins, sort = [f"_in{i}" for i in range(k + 1)], [f"_by{i}" for i in range(len(order))]
    rows = s.rows.select(*s.by, *[F.col(c).alias(a) for c, a in zip([*keys, value], ins)], *[F.col(c).alias(a) for c, a in zip(order, sort)])
    rows = rows.repartition(n, *s.by).sortWithinPartitions(*s.by, *sort)
    acc_fields = T.StructType.fromDDL(agg.acc_schema).fields
    held = [T.StructField(f"_k{i}", f.dataType) for i, f in enumerate(key_fields)] + [f for f in s.rows.schema.fields if f.name in place]
    schema = T.StructType([*held, *acc_fields])
    parts = rows.mapInArrow(_runs(s.by, [*ins[:k], *place, ins[k]], lambda r: agg.add(agg.init(), r[-1]), lambda acc, r: agg.add(acc, r[-1]),
                                  lambda head, acc: (*head[:-1], *acc), schema), schema)

    # The slots of a key, in order.
    by = [f"_k{i}" for i in range(k)]
    parts = (parts.repartition(n, *by) if by else parts.coalesce(1)).sortWithinPartitions(*by, *place)
    out = T.StructType([*key_fields, *T.StructType.fromDDL(agg.result_schema).fields])
    return parts.mapInArrow(_runs(by, [*by, *[f.name for f in acc_fields]], lambda r: r[k:], lambda acc, r: agg.merge(acc, r[k:]),
                                  lambda head, acc: (*head[:k], *agg.result(acc)), out), out)


# Fixed values of the text digest: base and modulus.
BASE, MODULUS = 257, 2_147_483_647


def text_hash(text: str) -> tuple[int, int, int]:
    """Length, hash and ``BASE ** length`` of a text's UTF-8 bytes: of two texts, those
    of their concatenation follow, whatever their length."""
    h, power = 0, 1
    for b in text.encode():
        h, power = (h * BASE + b) % MODULUS, power * BASE % MODULUS
    return len(text.encode()), h, power


def join_hashes(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], (a[1] * b[2] + b[1]) % MODULUS, a[2] * b[2] % MODULUS


def contains_text() -> UserAggregate:
    """The aggregating-state text itself: ``contains:a and b and ...``.  For keys known
    to be short; ``contains_digest`` has no such limit."""
    def join(a, b):
        return (b[0] if a[0] is None else a[0] + CONTAINS_SEP + b[0],)
    return UserAggregate(lambda: (None,), lambda acc, v: join(acc, (str(v),)), join, lambda acc: (CONTAINS_PREFIX + acc[0],), "text string", "contains string")


def contains_digest() -> UserAggregate:
    """Items, length in bytes and hash of the same text, in three numbers."""
    sep, prefix = text_hash(CONTAINS_SEP), text_hash(CONTAINS_PREFIX)

    def merge(a, b):
        return b if not a[0] else (a[0] + b[0], *join_hashes(join_hashes(a[1:], sep), b[1:]))

    def result(acc):
        length, h, _ = join_hashes(prefix, acc[1:])
        return acc[0], length, h

    return UserAggregate(lambda: (0, 0, 0, 1), lambda acc, v: merge(acc, (1, *text_hash(str(v)))), merge, result,
                         "items long, bytes long, hash long, power long", "n_items long, n_bytes long, digest long")
