"""Keyword document store and search (K1, K2).

The store is a table of ``(id, document, metadata, stored_batch, _row_order)``.
Upsert is an anti-join plus a union; search scores every whole document by
the number of distinct lower-case words it shares with the query and keeps
the top ``n`` with ``TakeOrderedAndProject`` (ties in stored order).

A store that is searched often can be indexed: ``write_index`` writes, for every
word, the documents that hold it, in folders by a hash of the word, so
``search_index`` reads the few folders of the query's words and no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.functions.text import WS_CLASS
from lakesmith.operators.keys import number_in_row_order
from lakesmith.sources.tables import ROW_ORDER, with_row_order

#: Folders of an index.
BUCKETS = 64


def as_store(df: DataFrame, id_col: str, text_col: str, meta_cols: list[str] | None = None,
             batch: int = 0) -> DataFrame:
    """A document table -> store rows (metadata values as text)."""
    meta = F.create_map(*[x for c in (meta_cols or []) for x in (F.lit(c), F.col(c).cast("string"))]) \
        if meta_cols else F.create_map().cast("map<string,string>")
    df = with_row_order(df)
    return df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("document"),
                     meta.alias("metadata"), F.lit(batch).cast("long").alias("stored_batch"), F.col(ROW_ORDER))


def upsert(store: DataFrame, new_docs: DataFrame) -> DataFrame:
    """K1: documents with a new id replace the stored ones and go to the end.

    Of several new documents with one id the last in row order stays.  The new
    batch is numbered after the store's largest, whatever it was given.
    """
    data = [c for c in store.columns if c != "id"]
    # one struct per row, combined map-side; the row order is its first field
    last = F.max(F.struct(F.col(ROW_ORDER).alias("__o"), F.struct(*[
        F.map_entries(c).alias(c) if c == "metadata" else F.col(c) for c in data]).alias("d")))
    latest = new_docs.groupBy("id").agg(last.alias("__l")).select("id", *[
        (F.map_from_entries("__l.d.metadata") if c == "metadata" else F.col(f"__l.d.{c}")).alias(c) for c in data])
    batch = F.coalesce(store.agg(F.max("stored_batch")).scalar(), F.lit(-1).cast("long")) + 1
    kept = store.join(latest.select("id"), "id", "left_anti")
    return kept.unionByName(latest.withColumn("stored_batch", batch).select(*store.columns))


def query_words(text: str) -> list[str]:
    return sorted(set((text or "").lower().split()))


def shared_word_count(document: Column, words: list[str]) -> Column:
    """Distinct lower-case whitespace words shared with the query."""
    if not words:
        return F.lit(0)
    # empty edge tokens never equal a query word, so the raw split is enough
    tokens = F.split(F.lower(document), f"{WS_CLASS}+")
    return F.coalesce(F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in words]))), F.lit(0))  # null: no words


def search(store: DataFrame, text: str, n: int = 5) -> DataFrame:
    """K2: top ``n`` documents by shared words; zero scores are kept."""
    scored = store.withColumn("score", shared_word_count(F.col("document"), query_words(text)))
    return scored.orderBy(F.col("score").desc(), F.col("stored_batch").asc(), F.col(ROW_ORDER).asc()).limit(n)


def _words(document: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(document), f"{WS_CLASS}+"), lambda w: w != ""))


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def write_index(store: DataFrame, path: str) -> None:
    """Index of a store: ``docs`` numbers the ids in stored order, ``postings``
    holds (word, number) for each different word of each document.

    A word of most documents fills its folder from many tasks: postings are
    dealt by word and a part of the number, never by the word alone.
    """
    ordered = store.withColumn(ROW_ORDER, F.struct(
        F.concat_ws("/", F.format_string("%019d", F.col("stored_batch")), F.col(f"{ROW_ORDER}.file")).alias("file"),
        F.col(f"{ROW_ORDER}.pos").alias("pos")))
    numbered = number_in_row_order(ordered, "no", ["id", "document"])
    numbered.select("no", "id").write.mode("overwrite").parquet(f"{path}/docs")
    postings = numbered.select("no", F.explode(_words(F.col("document"))).alias("word")).withColumn("bucket", _bucket(F.col("word")))
    (postings.repartition("bucket", F.shiftright("no", 20)).sortWithinPartitions("bucket", "word", "no")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings"))


def search_index(spark: SparkSession, path: str, text: str, n: int = 5) -> DataFrame:
    """(id, score) of the top ``n`` documents, as ``search`` finds them; documents
    without any of the words fill up in stored order."""
    words = query_words(text)
    ids = spark.read.schema("no long, id string").parquet(f"{path}/docs")
    postings = spark.read.schema("no long, word string, bucket int").parquet(f"{path}/postings")
    buckets = {r[0] for r in spark.range(1).select(F.explode(F.array(*[_bucket(F.lit(w)) for w in words]))).collect()} if words else set()
    scores = (postings.where(F.col("bucket").isin(*buckets) & F.col("word").isin(words) if words else F.lit(False))
              .groupBy("no").agg(F.count(F.lit(1)).cast("int").alias("score")))
    best = scores.orderBy(F.col("score").desc(), "no").limit(n)
    # the first n documents hold enough without any word to fill up, or all they lack are among the best
    first = ids.orderBy("no").limit(2 * n).join(best.select("no", "score"), "no", "left")
    found = best.join(ids, "no").select("no", "id", "score").unionByName(
        first.where("score is null").select("no", "id", F.lit(0).alias("score")))
    return found.orderBy(F.col("score").desc(), "no").limit(n).select("id", "score")
