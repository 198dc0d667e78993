"""Tables fed by micro-batches: the newest row per key, or sums that are added up when read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riverglass.sinks.registry import Registry, stored_table
from riverglass.sources.stored import newest

SPAN = 100  # batches whose folders stand together
QUERY_ID = "sql.streaming.queryId"


class OtherWriter(RuntimeError):
    """Another query writes to this table."""


class BatchTable:
    """Files under `path`: `generation=G/span=S/batch_id=N` for each batch, `generation=G/base/upto=N` for
    each compaction.

    Writing a batch again replaces its folder, so retries leave one copy. Batch ids count from 0 for each
    checkpoint, so they only mean something together with the query that gave them: the first
    query that writes starts a generation, and a batch of any other query is refused
    (`on_new_query="refuse"`) or starts the next generation, which takes over what the table shows at that time
    and shuts the earlier query out (`on_new_query="generation"`). The choice belongs to the input: a new checkpoint
    that reads its input from the start again would count it twice in a table of sums.

    Readers take the newest base and the spans after it. Nothing older is listed, so their work is
    bounded by the batches since the last `compact`. Every batch has to be written, empty ones too, as
    readers stop at the first span that is missing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str,
                 keys: Sequence[str], on_new_query: str = "refuse"):
        if on_new_query not in ("refuse", "generation"):
            raise ValueError(f"on_new_query: {on_new_query}")
        self.spark, self.path, self.keys, self.on_new_query = spark, path, list(keys), on_new_query
        empty = spark.createDataFrame([], schema)
        self.columns = empty.columns
        self.schema = T.StructType(empty.schema.fields + [T.StructField("batch_id", T.LongType())])
        # The query of each generation and the first batch it wrote, as "query@batch".
        self.writers = Registry(spark, f"{path}/writers")

    def fold(self, rows: DataFrame) -> DataFrame:
        """One row per key, with its `batch_id`."""
        raise NotImplementedError

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The `foreachBatch` sink. Rebalancing keeps a batch from leaving one small file per
        partition."""
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "no query"
        folder = f"{self._folder(self._enter(query, batch_id))}/span={batch_id // SPAN}/batch_id={batch_id}"
        batch.select(*self.columns).hint("rebalance").write.mode("overwrite").parquet(folder)

    def history(self) -> DataFrame:
        """Every stored row a reader still needs, with its batch id."""
        return self._history(*self._newest())

    def current(self) -> DataFrame:
        """One row per key."""
        return self.fold(self.history()).select(*self.columns)

    def compact(self, upto: int) -> None:
        """Fold the batches up to `upto`, which must be finished, into a new base."""
        generation, first = self._newest()
        bases = self._bases(generation)
        base = bases.current()
        if generation is None or base is not None and base.version >= upto:
            return
        folded = self.fold(self._history(generation, first).where(F.col("batch_id") <= upto))
        self._publish_base(generation, upto, folded)

    def _folder(self, generation: int) -> str:
        return f"{self.path}/generation={generation}"

    def _bases(self, generation: int | None) -> Registry:
        return Registry(self.spark, f"{self._folder(generation or 0)}/bases")

    def _newest(self) -> tuple[int | None, int]:
        writer = self.writers.current()
        return (None, 0) if writer is None else (writer.version, int(writer.path.rpartition("@")[2]))

    def _enter(self, query: str, batch_id: int) -> int:
        """The generation that a batch of this query belongs to."""
        writer = self.writers.current()
        if writer is not None and writer.path.rpartition("@")[0] == query:
            return writer.version
        if writer is None:
            generation = 0
        elif self.on_new_query == "refuse" or self._was_shut_out(query):
            raise OtherWriter(f"{self.path} is written by {writer.path}, not by {query}")
        else:
            generation = writer.version + 1
            self._publish_base(generation, batch_id - 1, self.fold(self.history()))
        self.writers.publish(generation, f"{query}@{batch_id}")
        return generation

    def _was_shut_out(self, query: str) -> bool:
        return not self.writers.versions().where(F.col("path").startswith(f"{query}@")).isEmpty()

    def _publish_base(self, generation: int, upto: int, folded: DataFrame) -> None:
        target = f"{self._folder(generation)}/base/upto={upto}"
        folded.select(*self.columns, F.lit(upto).cast("long").alias("batch_id")).write.mode("overwrite").parquet(target)
        self._bases(generation).publish(upto, target)

    def _history(self, generation: int | None, first: int) -> DataFrame:
        rows = self.spark.createDataFrame([], self.schema)
        if generation is None:
            return rows
        base = self._bases(generation).current()
        if base is not None:
            rows, first = self.spark.read.schema(self.schema).parquet(base.path), base.version + 1
        span = first // SPAN
        while (found := self._span(generation, span)) is not None:
            rows, span = rows.unionByName(found.where(F.col("batch_id") >= first)), span + 1
        return rows

    def _span(self, generation: int, span: int) -> DataFrame | None:
        folder = self._folder(generation)
        found = stored_table(self.spark, f"{folder}/span={span}", self.schema, folder)
        return None if found is None else found.select(*self.columns, "batch_id")


class KeyedTable(BatchTable):
    """A table with one visible row per key: that of the newest batch that has it.

    A batch has one row per key.
    """

    def fold(self, rows: DataFrame) -> DataFrame:
        return newest(rows, self.keys)


def _merged(kind: str, column: str) -> Column:
    return {"sum": F.sum, "min": F.min, "max": F.max, "hll": F.hll_union_agg}[kind](column)


class MergedTable(BatchTable):
    """A table of partial results per key, merged when it is read.

    Batches bring what their own rows give (`merge`: a column's kind, "sum", "min", "max" or "hll" for sketches
    of `hll_sketch_agg`), so the query that feeds it keeps no state, however many keys there are, and
    a batch that is delivered again replaces its own share.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str],
                 merge: Mapping[str, str], on_new_query: str = "refuse"):
        super().__init__(spark, path, schema, keys, on_new_query)
        if set(self.keys) | set(merge) != set(self.columns):
            raise ValueError(f"keys and merged columns do not make up {self.columns}")
        self.merge = dict(merge)

    def fold(self, rows: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in self.schema}
        return rows.groupBy(*self.keys).agg(
            *(_merged(kind, c).cast(kinds[c]).alias(c) for c, kind in self.merge.items()),
            F.max("batch_id").alias("batch_id"))
