"""Keyed state in streams, in Spark's RocksDB store."""

from __future__ import annotations

import contextlib
import datetime
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparkpipe.operators.joins import without_maps
from sparkpipe.operators.merge import INSERT, POSTIMAGE, PREIMAGE

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 1 << 16  # groups of keys that are handed to Python together
NAN = float("nan")


@contextlib.contextmanager
def rocks_store(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started in here keep their state in RocksDB."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def latest_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Of each key that a batch touches, the greatest row of all batches so far.

    A built-in aggregate holds the state, one row per key, so nothing leaves the JVM. Ties
    are settled by the remaining columns that have an order; NULL comes before any value.
    """
    rest = [c for c in without_maps(df) if c not in (*keys, *order_by)]
    whole = F.max_by(F.struct(*df.columns), F.struct(*order_by, *rest)).alias("_row")
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    checked = df.filter(F.assert_true(present, F.lit("NULL in merge key")).isNull())
    return checked.groupBy(*keys).agg(whole).select("_row.*")


def _alike(value):
    """Key values that Spark groups together as one value that can be looked up."""
    if isinstance(value, float):
        return NAN if value != value else value + 0.0
    if isinstance(value, bytearray):
        return bytes(value)
    if isinstance(value, (list, tuple)):
        return tuple(map(_alike, value))
    return value


class Latest(StatefulProcessor):
    """The latest row of each key of a bucket, and the images of every change to it.

    The state is one row per key, each read and written alone. Of the rows of a batch only
    a key's winner is compared with it, so a batch gives one change per key at most.
    """

    def __init__(
        self,
        schema: T.StructType,
        keys: Sequence[str],
        rank: Sequence[str] | None,
        ties: Sequence[str],
        keep: datetime.timedelta | None,
    ):
        self.schema, self.keys, self.rank, self.ties, self.keep = schema, keys, rank, ties, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        lifetime = int(self.keep.total_seconds() * 1000) if self.keep else None
        names = self.schema.fieldNames()
        self.at = [names.index(k) for k in self.keys]
        by = T.StructType([self.schema.fields[i] for i in self.at])
        self.latest = handle.getMapState("latest", by, self.schema, lifetime)
        self.image = Row(*names, "_change_type")

    def _place(self, row: tuple) -> tuple:
        """Order of rows; NULL comes before any value."""
        names = [*self.rank, *self.ties]
        values = (row[self.schema.fieldNames().index(n)] for n in names)
        return tuple((v is not None, v if v is not None else 0) for v in values)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best: dict[tuple, tuple] = {}
        for row in rows:
            row = tuple(row)[: len(self.schema)]
            key = tuple(_alike(row[i]) for i in self.at)
            if key not in best:
                best[key] = row
            elif not self.rank:
                raise ValueError(f"more than one row in a batch for key {key}")
            elif self._place(row) > self._place(best[key]):
                best[key] = row
        known = self.latest.exists()
        for key, row in best.items():
            held = self.latest.getValue(key) if known else None
            held = tuple(held) if held is not None else None
            if held is not None and self.rank and self._place(row) < self._place(held):
                continue
            if held is not None and held == row:
                continue
            self.latest.updateValue(key, row)
            if held is None:
                yield self.image(*row, INSERT)
            else:
                yield self.image(*held, PREIMAGE)
                yield self.image(*row, POSTIMAGE)

    def close(self) -> None:
        pass


def latest_images(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    keep: datetime.timedelta | None = None,
) -> DataFrame:
    """A stream of upserts as a stream of change rows, with the rows they replace.

    With ``order_by`` the greatest row of a key wins, ties being settled by the columns
    that have an order, and one that comes late changes nothing; without, the row of the
    latest batch wins and two rows of a key in one batch are an error. State of keys that
    nothing touched for the time ``keep`` goes; such a key counts as new.

    Keys go to Python in buckets by their hash: what a group costs to begin and end is paid
    once for all keys of a bucket, and a bucket without state is not searched. Where rows that are
    replaced are not asked for, :func:`latest_rows` does the same work without Python.
    """
    plain = [c for c in without_maps(df) if c not in (*keys, *(order_by or ()))]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    out = T.StructType([*schema, T.StructField("_change_type", T.StringType())])
    dealt = df.withColumn("_bucket", F.pmod(F.hash(*keys), F.lit(BUCKETS)))
    return dealt.groupBy("_bucket").transformWithState(
        Latest(schema, list(keys), list(order_by) if order_by else None, plain, keep),
        out,
        "Update",
        "ProcessingTime" if keep else "None",
    )
