"""Ordered scans per key that no hot key can stall.

The reference keeps running state per key (running count, sum, maximum, the
previous element, the watermark).  ``Window.partitionBy(key).orderBy(...)``
says that directly, but puts every row of a key into one task.  ``keyed_scan``
computes the same values over *slots*, ranges of (key, order) that follow the
data, all in Spark expressions:

1. A key is one slot unless it holds more than about twice ``slotRows`` rows; then it
   is cut at rows of its own.  A sample chosen by the hash of (key, order) is sorted
   per key, every ``slotRows``-th place of it is a boundary, and a row of such a key
   finds its slot by binary search over whole order tuples.  So a third of all
   rows in one key, in one hour of it or at one instant, is cut evenly.
   Boundaries are broadcast: one, some tens of bytes, for every ``slotRows`` rows of
   hot keys (under 100 MB at 10^12 rows; raise ``cabflow.scan.slotRows`` beyond).
2. For keys that are cut, and only for these, a partial aggregate gives every slot's
   totals without moving a row, and a window over the totals what earlier slots
   carry in.
3. Rows meet the carry of their slot (as small as the boundaries, and broadcast),
   and one window per slot adds the prefix: the rows are shuffled once.

``session_scan`` and ``pair_scan`` need the slot's own prefix before they can sum it
up; they shuffle the few columns that takes, of the keys that are cut.

There is one path whatever the size; no job runs while the query is built, and
the columns an operator carries are never touched.  The sample decides the layout
only.  The setting ``cabflow.scan.slotRows`` does not change a result, but for the
last digits of running sums of floating-point numbers, whose terms are added in
another grouping.  ``order`` must be total within a key (add a unique id); nulls
come first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = 262_144
#: Sampled rows behind every boundary.
SAMPLES = 4
PART = "_slot"


@dataclass(frozen=True)
class Agg:
    """One running aggregate: ``out`` = op(col) over the ordered prefix."""

    out: str
    op: str                      # count | sum | max | min | last
    col: str | None = None
    inclusive: bool = True       # include the current row (``last`` is always exclusive)

    def __post_init__(self):
        if self.op not in ("count", "sum", "max", "min", "last"):
            raise ValueError(f"unsupported scan op {self.op!r}")
        if self.op != "count" and self.col is None:
            raise ValueError(f"op {self.op!r} needs a column")


def _out_type(a: Agg, schema: T.StructType) -> T.DataType:
    if a.op == "count":
        return T.LongType()
    src = schema[a.col].dataType
    if a.op == "sum":
        return T.LongType() if isinstance(src, (T.IntegralType, T.BooleanType)) else T.DoubleType()
    return src


def _same(keys: list[str], others: list[str]) -> Column:
    """Rows of one key (nulls are one key, too)."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, others)], F.lit(True))


@dataclass(frozen=True)
class Slots:
    """``rows``: the input with the number of its slot, 0 where the key is not cut;
    ``cut``: those of cut keys, numbered from 1."""

    rows: DataFrame
    cut: DataFrame
    keys: list[str]
    order: list[str]

    @property
    def by(self) -> list[str]:
        return [*self.keys, PART]

    @property
    def inside(self):
        """The window over a slot's rows in order."""
        return Window.partitionBy(*self.by).orderBy(*self.order)

    @property
    def earlier(self):
        """The window over a key's slots in order."""
        return (Window.partitionBy(*self.keys) if self.keys else Window).orderBy(PART)

    def meet(self, rows: DataFrame, carry: DataFrame, columns: list[str]) -> DataFrame:
        """``rows`` with ``columns`` of their slot's carry, null for keys that are not cut."""
        names = [f"_meet{i}" for i in range(len(self.by))]
        carry = carry.select(*[F.col(c).alias(n) for c, n in zip(self.by, names)], *columns)
        return rows.join(F.broadcast(carry), _same(self.by, names), "left").drop(*names)


def slotted(df: DataFrame, keys: list[str], order: list[str], width: int | None = None) -> Slots:
    """Give every row its slot.  ``width``: rows of a slot, instead of the setting."""
    most = width or int(df.sparkSession.conf.get("cabflow.scan.slotRows", str(ROWS)))
    sampled = F.pmod(F.xxhash64(*keys, *order), F.lit(max(1, most // SAMPLES))) == 0
    each = min(SAMPLES, most)
    parts = F.ceil(F.size("s") / F.lit(each)).cast("int")
    bounds = F.array_distinct(F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.element_at("s", F.floor(i * F.size("s") / parts).cast("int") + 1)))
    names = [f"_hot{i}" for i in range(len(keys))]
    hot = df.where(sampled).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("s"))
    hot = F.broadcast(hot.where(F.size("s") >= 2 * each).select(*names, bounds.alias("_bounds")))
    here = F.struct(*order)

    def halve(a, _):
        mid = F.shiftright(a["lo"] + a["hi"], 1)
        right = F.element_at("_bounds", mid + 1) <= here
        return F.when(a["lo"] >= a["hi"], a).when(right, F.struct((mid + 1).alias("lo"), a["hi"].alias("hi"))).otherwise(F.struct(a["lo"].alias("lo"), mid.alias("hi")))

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size("_bounds") + 1)).cast("int") + 1)
    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size("_bounds").alias("hi")), halve, lambda a: a["lo"] + 1)
    rows = df.join(hot, _same(keys, names), "left").select(*df.columns, F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(found).alias(PART))
    return Slots(rows, df.join(hot, _same(keys, names)).select(*df.columns, found.alias(PART)), keys, order)


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], aggs: list[Agg], width: int | None = None) -> DataFrame:
    """Add one column per ``Agg``: its running value per key in ``order``.

    ``keys`` may be empty (one global order).  Every input row comes back with
    its columns as they were; nothing is dropped or capped."""
    types = {a.out: _out_type(a, df.schema) for a in aggs}
    s = slotted(df, keys, order, width)

    def total(a: Agg) -> Column:
        if a.op == "count":
            return F.count(F.lit(1))
        if a.op == "sum":
            return F.sum(F.col(a.col).cast(types[a.out]))
        if a.op == "last":
            return F.max_by(a.col, F.struct(*order))
        return (F.max if a.op == "max" else F.min)(a.col)

    so_far = s.earlier.rowsBetween(Window.unboundedPreceding, -1)

    def add(a: Agg, column: str) -> Column:
        """Over the totals of earlier slots."""
        if a.op == "last":
            return F.lag(column, 1).over(s.earlier)
        return (F.sum if a.op in ("count", "sum") else F.max if a.op == "max" else F.min)(column).over(so_far)

    into = [f"_into{i}" for i in range(len(aggs))]
    totals = s.cut.groupBy(*s.by).agg(*[total(a).alias(f"_total{i}") for i, a in enumerate(aggs)])
    carry = totals.select(*s.by, *[add(a, f"_total{i}").alias(n) for i, (a, n) in enumerate(zip(aggs, into))])
    inside, cols = s.inside, []
    for a, n in zip(aggs, into):
        frame = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow if a.inclusive else -1)
        none = F.lit(0).cast(types[a.out])
        if a.op == "count":
            e = F.count(F.lit(1)).over(frame) + F.coalesce(n, none)
        elif a.op == "sum":
            e = F.coalesce(F.sum(F.col(a.col).cast(types[a.out])).over(frame), none) + F.coalesce(n, none)
        elif a.op == "last":
            e = F.when(F.row_number().over(inside) == 1, F.col(n)).otherwise(F.lag(a.col, 1).over(inside))
        else:
            e = (F.greatest if a.op == "max" else F.least)((F.max if a.op == "max" else F.min)(a.col).over(frame), F.col(n))
        cols.append(e.cast(types[a.out]).alias(a.out))
    return s.meet(s.rows, carry, into).select(*[F.col(c) for c in df.columns if c not in types], *cols)


def session_scan(df: DataFrame, keys: list[str], t_col: str, end_col: str, tie: str,
                 out: str = "session_start_us", width: int | None = None) -> DataFrame:
    """Session start (epoch micros) of every row.

    ``t_col`` / ``end_col`` are epoch-micro longs (row time, row time + gap).
    A row opens a session iff ``t > max(end of earlier rows of its key)``
    (touching sessions merge, as ``session_window`` does).  Rows without a time or
    an end belong to no session.

    A slot is summed up by its largest end and the last time that opens a session
    as far as the slot knows: times grow, so if any of its rows opens one after
    what earlier slots carry in, that row does, and it is the last.
    """
    timed = F.col(t_col).isNotNull() & F.col(end_col).isNotNull()
    s = slotted(df, keys, [t_col, tie], width)
    end, t = F.when(timed, F.col(end_col)), F.col(t_col)
    before = F.max(end).over(s.inside.rowsBetween(Window.unboundedPreceding, -1))
    own = s.cut.select(*s.by, end.alias("_e"), F.when(timed & (before.isNull() | (t > before)), t).alias("_o"))
    totals = own.groupBy(*s.by).agg(F.max("_e").alias("_e"), F.max("_o").alias("_o"))
    so_far = s.earlier.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumn("_sess_e", F.max("_e").over(so_far))
    carry = carry.withColumn("_o", F.when(F.col("_sess_e").isNull() | (F.col("_o") > F.col("_sess_e")), F.col("_o")))
    carry = carry.withColumn("_sess_o", F.max("_o").over(so_far))
    d = s.meet(s.rows, carry, ["_sess_e", "_sess_o"]).withColumn("_sess_until", F.greatest(before, F.col("_sess_e")))
    opens = timed & (F.col("_sess_until").isNull() | (t > F.col("_sess_until")))
    d = d.withColumn("_sess_start", F.max(F.when(opens, t)).over(s.inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return d.select(*df.columns, F.when(timed, F.greatest("_sess_start", "_sess_o")).alias(out))


def pair_scan(df: DataFrame, keys: list[str], record: str, width: int | None = None) -> DataFrame:
    """First-come pairing over a tagged union with columns ``side`` (int 0/1),
    ``i`` (id), ``t_us`` (long arrival time) and ``record`` (any type).

    A row starts an island when it has the same side as the previous row of
    its key; the 2nd, 4th, ... rows of an island close a pair with their
    predecessor.  Adds ``closer`` and ``prev`` (the predecessor's record).
    Rows without an arrival time close nothing.

    A slot is summed up by its number of rows, its first and last side and the last
    place where an island starts inside it, from the order columns alone, and by
    its last record, a partial aggregate.
    """
    order = ["t_us", "side", "i"]
    s = slotted(df.where(F.col("t_us").isNotNull()), keys, order, width)
    n, last = F.row_number().over(s.inside), F.lag("side", 1).over(s.inside)
    own = s.cut.select(*s.by, "side", n.alias("_n"), last.alias("_l"))
    totals = own.groupBy(*s.by).agg(F.count(F.lit(1)).alias("_n"), F.max(F.when(F.col("_n") == 1, F.col("side"))).alias("_first"), F.max_by("side", "_n").alias("_last"),
                                    F.max(F.when(F.col("_l") == F.col("side"), F.col("_n"))).alias("_start"))
    ends = s.cut.groupBy(*s.by).agg(F.max_by(F.struct(F.col(record).alias("r")), F.struct(*order)).alias("_rec"))
    totals = s.meet(totals, ends, ["_rec"])
    so_far = s.earlier.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumns({"_pair_off": F.coalesce(F.sum("_n").over(so_far), F.lit(0)), "_pair_side": F.lag("_last", 1).over(s.earlier), "_pair_rec": F.lag("_rec", 1).over(s.earlier)})
    opens = F.col("_pair_side").isNull() | (F.col("_pair_side") == F.col("_first"))
    carry = carry.withColumn("_start", F.coalesce(F.col("_pair_off") + F.col("_start"), F.when(opens, F.col("_pair_off") + 1)))
    carry = carry.withColumn("_pair_island", F.max("_start").over(so_far))
    local = s.rows.withColumns({"_pair_n": n, "_pair_last": last, "_pair_prev": F.lag(F.struct(F.col(record).alias("r")), 1).over(s.inside)})
    d = s.meet(local, carry, ["_pair_off", "_pair_side", "_pair_rec", "_pair_island"])
    first = F.col("_pair_n") == 1
    before, at = F.when(first, F.col("_pair_side")).otherwise(F.col("_pair_last")), F.coalesce("_pair_off", F.lit(0)) + F.col("_pair_n")
    d = d.withColumns({"_pair_at": at, "_pair_open": F.when(before.isNull() | (before == F.col("side")), at)})
    d = d.withColumn("_pair_open", F.greatest(F.max("_pair_open").over(s.inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.col("_pair_island")))
    prev = F.when(first, F.col("_pair_rec")).otherwise(F.col("_pair_prev"))["r"]
    return d.select(*df.columns, (((F.col("_pair_at") - F.col("_pair_open")) % 2) == 1).alias("closer"), prev.alias("prev"))


def running_window(df: DataFrame, keys: list[str], order: list[str], aggs: list[Agg]) -> DataFrame:
    """The plain form of ``keyed_scan``, one ordered window per key: what the
    scan over slots is tested against."""
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    cols = []
    for a in aggs:
        t = _out_type(a, df.schema)
        frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow if a.inclusive else -1)
        if a.op == "count":
            e = F.count(F.lit(1)).over(frame)
        elif a.op == "sum":
            e = F.coalesce(F.sum(F.col(a.col).cast(t)).over(frame), F.lit(0).cast(t))
        elif a.op == "last":
            e = F.lag(a.col, 1).over(w)
        else:
            e = (F.max if a.op == "max" else F.min)(a.col).over(frame)
        cols.append(e.cast(t).alias(a.out))
    return df.select("*", *cols)
