"""Resumable ingest of page payloads: which pages landed, which requests are done, which failed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import discard, materialize
from ..sources.pages import REQUEST, complete_requests, first_stops, flatten_pages, page_stop, tag_rows
from ..sources.schemas import DONE_KEYS, page_schema

BROKEN = "_corrupt_record"
PAGE = [*REQUEST, "page"]


def ingest_pages(spark: SparkSession, landing: str, out: str, checkpoint: str, row: T.StructType,
                 multi_line: bool = False, files_per_batch: int = 1000) -> DataFrame:
    """Append the pages that are new in ``landing`` to the table ``out``, and return the table.

    The checkpoint remembers which files were taken: a second run adds only new ones and a run that
    broke off continues after its last batch of ``files_per_batch`` files, each file exactly once. Page
    files are JSON objects, one per line, or one per file with ``multi_line``.
    """
    pages = (
        spark.readStream.schema(page_schema(row)).option("multiLine", multi_line)
        .option("maxFilesPerTrigger", files_per_batch).json(landing)
    )
    query = (
        pages.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(page_schema(row)).parquet(out)


def one_payload(pages: DataFrame, *order: str) -> DataFrame:
    """One row per page of a request: of several payloads the first by ``order``, then by their own hash."""
    payload = F.struct("dados", "links")
    rank = F.struct(*order, F.xxhash64(F.to_json(payload)).alias("hash"), F.to_json(payload).alias("text"))
    return pages.groupBy(*PAGE).agg(F.min_by(payload, rank).alias("payload")).select(*PAGE, "payload.*")


def settle_pages(pages: DataFrame, rule: str = "empty") -> tuple[DataFrame, DataFrame]:
    """``(rows, done)`` of ingested pages: tagged records up to each request's stop page, and the
    (entity, year) pairs whose pages have all arrived. A page that landed twice counts once."""
    pages = one_payload(pages)
    stops = materialize(first_stops(pages, rule), "stops")
    rows = tag_rows(flatten_pages(page_stop(pages, rule, stops=stops)))
    return rows, complete_requests(pages, rule, stops=stops)


class PageStore:
    """The folder of one dataset that grows batch by batch.

    ``pages``, ``rows``, ``done`` and ``failures`` hold a folder for each batch, ``ledger`` one record for each batch
    that is complete. A batch overwrites its own folders and enters the ledger last, so one that broke off is done
    again from the start and counts once; readers see batches of the ledger only.
    """

    def __init__(self, spark: SparkSession, path: str, row: T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        pages = T.StructType([f for f in page_schema(row) if f.name != BROKEN])
        kept = [f for f in row.fields if f.name not in DONE_KEYS.names]
        self.schemas = {
            "pages": pages,
            "rows": T.StructType([*kept, *DONE_KEYS.fields]),
            "done": T.StructType([*DONE_KEYS.fields, T.StructField("rows", T.LongType()), T.StructField("failed", T.BooleanType())]),
            "failures": T.StructType([*DONE_KEYS.fields, T.StructField("page", T.LongType()), T.StructField("reason", T.StringType())]),
            "ledger": T.StructType([T.StructField(n, T.LongType()) for n in ("pages", "late", "rows", "done", "failed", "broken")]),
        }

    def write(self, name: str, df: DataFrame, batch: int) -> None:
        ordered = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schemas[name]])
        ordered.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")

    def _read(self, name: str) -> DataFrame:
        schema = T.StructType([*self.schemas[name].fields, T.StructField("batch", T.LongType())])
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        """One record per complete batch: pages taken, late pages, rows, requests done, requests failed, broken lines."""
        return self._read("ledger")

    def batches(self) -> list[int]:
        return [r["batch"] for r in self.ledger().select("batch").collect()]

    def read(self, name: str, *more: int, before: int | None = None) -> DataFrame:
        """``name`` of the complete batches (those before a number), and of ``more``."""
        wanted = [b for b in self.batches() if before is None or b < before]
        return self._read(name).where(F.col("batch").isin([*wanted, *more]))

    def done(self) -> DataFrame:
        """The done (entity, year) pairs."""
        return self.read("done").select(*DONE_KEYS.names)


def take_batch(store: PageStore, batch: DataFrame, number: int, rule: str) -> None:
    """Settle one batch: keep its pages, and write the rows and the done key of every request that is complete now.

    Only requests that the batch touches are looked at, with the pages they left in earlier batches. A request is done
    when its pages 1 to the stop page are there, or when it was reported as failed; what lands for it later is counted
    and left alone.
    """
    keys = [F.col(REQUEST[0]).alias("entity_id"), F.col(REQUEST[1]).alias("yr")]
    whole = F.col(BROKEN).isNull() & F.col(REQUEST[0]).isNotNull() & F.col(REQUEST[1]).isNotNull()
    reason = F.when(~whole, F.coalesce(BROKEN, F.lit("no request"))).otherwise(F.col("error"))
    # the batch's file scan runs once: what follows reads these two tables
    store.write("failures", batch.select(*keys, "page", reason.alias("reason")).where("reason is not null"), number)
    store.write("pages", batch.where(whole & F.col("error").isNull() & F.col("page").isNotNull()), number)
    known = store.read("done", before=number).select(*DONE_KEYS.names)
    landed = store.read("pages", number, before=number)
    names = dict(zip(REQUEST, DONE_KEYS.names))
    own = landed.where(F.col("batch") == number)
    touched = own.select(*keys).distinct().join(known, DONE_KEYS.names, "left_anti")
    open_pages = landed.withColumnsRenamed(names).join(touched, DONE_KEYS.names, "left_semi")
    pages = materialize(one_payload(open_pages.withColumnsRenamed({v: k for k, v in names.items()}), "batch"), "open-pages")
    stops = materialize(first_stops(pages, rule), "stops")
    complete = materialize(complete_requests(pages, rule, stops=stops), "complete")
    ready = page_stop(pages, rule, stops=stops).withColumnsRenamed(names).join(complete, DONE_KEYS.names, "left_semi")
    store.write("rows", tag_rows(flatten_pages(ready.withColumnsRenamed({v: k for k, v in names.items()}))), number)
    rows = store.read("rows", number, before=0)
    failed = store.read("failures", number, before=0)
    refused = failed.where("entity_id is not null and yr is not null").select(*DONE_KEYS.names).distinct()
    refused = refused.join(known, DONE_KEYS.names, "left_anti").join(complete, DONE_KEYS.names, "left_anti")
    counted = complete.join(rows.groupBy(*DONE_KEYS.names).agg(F.count("*").alias("rows")), DONE_KEYS.names, "left")
    finished = counted.select(*DONE_KEYS.names, F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(False).alias("failed"))
    store.write("done", finished.unionAll(refused.select("*", F.lit(0), F.lit(True))), number)
    done = store.read("done", number, before=0)
    late = own.withColumnsRenamed(names).join(known, DONE_KEYS.names, "left_semi")
    counts = [
        own.count(), late.count(), rows.count(), done.count(), done.where("failed").count(),
        failed.where("entity_id is null or yr is null").count(),
    ]
    store.write("ledger", store.spark.createDataFrame([counts], store.schemas["ledger"]), number)
    discard(pages, stops, complete)


def ingest_dataset(spark: SparkSession, landing: str, path: str, row: T.StructType, rule: str = "empty",
                   multi_line: bool = False, files_per_batch: int = 1000) -> PageStore:
    """Take the page files that are new in ``landing`` into the store at ``path``.

    A page file holds envelopes of ``page_schema``; one with an ``error`` text says that its request was given up,
    which ends it without rows. Lines that are no JSON are kept as failures. Run it again whenever files have landed:
    each file is taken once, and requests with gaps wait for their pages.
    """
    store = PageStore(spark, path, row)
    schema = T.StructType([*page_schema(row).fields, T.StructField("error", T.StringType()), T.StructField(BROKEN, T.StringType())])
    pages = (
        spark.readStream.schema(schema).option("multiLine", multi_line).option("columnNameOfCorruptRecord", BROKEN)
        .option("maxFilesPerTrigger", files_per_batch).json(landing)
    )
    query = (
        pages.writeStream.foreachBatch(lambda batch, number: take_batch(store, batch, number, rule))
        .option("checkpointLocation", f"{store.path}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return store
